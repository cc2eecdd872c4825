"""Partitioned Parquet layers, snapshots, and every sink."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.operators.incremental import upsert
from tidetable.operators.panel import Keys, as_list, keep_last
from tidetable.session import broadcast_if_small, materialize

LAYERS = ("bronze", "silver", "gold", "prediction", "app_output")


@dataclass(frozen=True)
class Layers:
    """Where each layer of a dataset lives below one root."""

    root: str

    def path(self, layer: str, dataset: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{dataset}"


def scan_dataset(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, partition: str | None = "year"
) -> DataFrame:
    """A partitioned dataset without its partition column; a given schema saves reading footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.drop(partition) if partition else df


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it is stored, or None when there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType, *, partition: str = "year") -> DataFrame:
    """Like :func:`scan_dataset`, but a table that no row has reached yet is an empty one."""
    df = _stored(spark, path)
    return spark.createDataFrame([], schema) if df is None else df.drop(partition)


def scan_partition(spark: SparkSession, path: str, value: int, *, partition: str = "year") -> DataFrame:
    """One partition; the plain comparison lets Spark list and read nothing else."""
    return spark.read.parquet(path).filter(F.col(partition) == value).drop(partition)


def stored_partitions(spark: SparkSession, path: str, partition: str = "year") -> DataFrame:
    """Partition values present, found from file names without reading rows."""
    return spark.read.parquet(path).select(partition).distinct()


def _near(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a directory brought together for writing.

    A rebalance, not a repartition: adaptive execution splits a directory that
    is too large for one task and joins small ones, so a small year is one file
    and a huge one many.
    """
    return df.hint("rebalance", *columns)


def write_by_year(df: DataFrame, path: str, time: str = "month", *, files_per_year: int | None = None, mode: str = "overwrite") -> None:
    """Parquet partitioned by year.

    A fixed ``files_per_year`` sends the rows of a year to that many writers by a
    hash of the row; 1 suits small tables whose readers insist on a single file.
    """
    rows = df.withColumn("year", F.year(time))
    if files_per_year is None:
        rows = _near(rows, "year")
    else:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_year))
        rows = rows.withColumn("_part", part).repartition("year", "_part").drop("_part")
    rows.write.mode(mode).partitionBy("year").parquet(path)


def replace_years(df: DataFrame, path: str, time: str = "month") -> None:
    """Overwrite only the year partitions that occur in ``df``."""
    (
        _near(df.withColumn("year", F.year(time)), "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )


def stored_years(df: DataFrame, path: str, time: str = "month") -> DataFrame | None:
    """The stored rows of the years that occur in ``df``, or None when there is no table yet.

    The list of years is bounded by the calendar, so it becomes a literal filter
    that prunes directories.
    """
    years = [r["year"] for r in df.select(F.year(time).alias("year")).distinct().collect()]
    stored = _stored(df.sparkSession, path)
    if stored is None:
        return None
    return stored.filter(F.col("year").isin(years)).select(*df.columns)


def merge_into_years(df: DataFrame, path: str, on: Keys, order: Keys, time: str = "month") -> None:
    """Upsert into a table partitioned by year: new rows win, other rows of the year stay.

    Only touched years are read.  The merged rows are written aside first, so
    the table is never overwritten by a job that still reads it; so are the new
    ones, which tell the years before they are merged.  No new rows change
    nothing and make no table.
    """
    df = materialize(df, "batch")
    if df.isEmpty():
        return
    stored = stored_years(df, path, time)
    merged = keep_last(df, on, order) if stored is None else upsert(stored, df, on, order)
    replace_years(materialize(merged, "merge"), path, time)


def write_csv(df: DataFrame, path: str, *, order: Sequence[str] = (), mode: str = "overwrite") -> None:
    """CSV with a header; sorted across files when ``order`` is given."""
    (df.orderBy(*order) if order else df).write.mode(mode).option("header", True).csv(path)


def write_documents(documents: DataFrame, path: str, key: str = "product") -> None:
    """One JSON document per row, one directory per key.

    A document is one line of text.  ``key`` becomes directories, so it should
    name products, not an unbounded id.
    """
    documents.write.mode("overwrite").partitionBy(key).json(path)


def write_raw_periods(points: DataFrame, path: str, time: str = "month") -> None:
    """Raw points split into ``year=/month=`` directories; stored periods are replaced, others stay."""
    rows = points.withColumns({"year": F.year(time), "month_no": F.month(time)})
    (
        _near(rows, "year", "month_no")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month_no")
        .json(path)
    )


def latest_snapshot(df: DataFrame, *, partition: Keys = ()) -> DataFrame:
    """Rows of the file whose name sorts last (per partition); ``df`` must be a direct file scan."""
    keys = as_list(partition)
    rows = df.withColumn("_name", F.col("_metadata.file_name"))
    names = rows.select(*keys, "_name").distinct()
    newest = names.groupBy(*keys).agg(F.max("_name").alias("_name")) if keys else names.agg(F.max("_name").alias("_name"))
    return rows.join(broadcast_if_small(newest), [*keys, "_name"], "left_semi").drop("_name")


def latest_snapshot_dir(df: DataFrame, *, group: str = r"^(.*/)[^/]+/[^/]+$", snapshot: str = r"/([^/]+)/[^/]+$") -> DataFrame:
    """Like :func:`latest_snapshot` when a snapshot is a directory of many files.

    The directory's own name decides; ``group`` keeps the snapshots of different
    parents apart.
    """
    path = F.col("_metadata.file_path")
    rows = df.withColumns({"_group": F.regexp_extract(path, group, 1), "_snap": F.regexp_extract(path, snapshot, 1)})
    newest = rows.groupBy("_group").agg(F.max("_snap").alias("_snap"))
    return rows.join(broadcast_if_small(newest), ["_group", "_snap"], "left_semi").drop("_group", "_snap")


def file_counts(df: DataFrame, partition: Keys) -> DataFrame:
    """Files per partition, with the verdict whether it is exactly one."""
    return (
        df.select(*as_list(partition), F.col("_metadata.file_path").alias("_file"))
        .groupBy(*as_list(partition))
        .agg(F.count_distinct("_file").alias("n_files"))
        .withColumn("is_single", F.col("n_files") == 1)
    )


def require_single_file(df: DataFrame, partition: Keys) -> DataFrame:
    """``df``, or a FileNotFoundError when some partition has no single source file."""
    wrong = file_counts(df, partition).filter(~F.col("is_single")).limit(5).collect()
    if wrong:
        raise FileNotFoundError(f"expected exactly one file per partition, found {wrong}")
    return df

