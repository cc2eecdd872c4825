"""Session set-up, the shared work folder and the broadcast size check."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOTS: dict[str, str] = {}
#: Work tables by application, in the order they were written.
_WORK: dict[str, list[str]] = {}


def build_session(
    app_name: str = "tidetable",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC dates and adaptive execution.

    ``master`` and ``shuffle_partitions`` are left to the cluster when not given.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (options or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, since there the
    driver and the executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tidetable-")
    return _LOCAL_ROOTS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage with a table that outlives any executor, and lets two
    consumers share one computation.  :func:`discard_work` deletes such tables
    once the results that read them have been written.
    """
    path = new_folder(df.sparkSession, label)
    _WORK.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_tables(spark: SparkSession) -> list[str]:
    """Folders of the work tables that this application has written and not deleted."""
    return list(_WORK.get(spark.sparkContext.applicationId, []))


def discard_work(spark: SparkSession, keep: Sequence[str] = ()) -> int:
    """Delete the work tables written so far but those in ``keep``, and return how many there were.

    Results are lazy: call it when what was asked for has been written or
    collected.  A job calls :func:`work_tables` before a step and keeps these.
    """
    context = spark.sparkContext
    gone = [p for p in work_tables(spark) if p not in set(keep)]
    for folder in gone:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    _WORK[context.applicationId] = [p for p in work_tables(spark) if p not in set(gone)]
    return len(gone)


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a DataFrame, or None where it is not exposed."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def broadcast_limit(spark: SparkSession) -> int:
    try:
        return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except Exception:
        return 10 * 1024 * 1024


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the estimated size of ``df`` is below the session's broadcast limit."""
    size = plan_bytes(df)
    return size is not None and size <= broadcast_limit(df.sparkSession)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint when its size was checked, unchanged otherwise."""
    return F.broadcast(df) if fits_broadcast(df) else df
