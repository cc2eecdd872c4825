"""Period totals, upserts and forecast settlement over a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidetable.operators.incremental import settle
from tidetable.operators.panel import Keys, as_list, keep_last
from tidetable.session import materialize
from tidetable.sources.tables import merge_into_years, replace_years, stored_years


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    recursive: bool = False,
) -> DataFrame:
    """A stream over files as they arrive; ``path`` is a folder or a glob."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)


def as_instant(wall_clock: str) -> Column:
    """A zone-free timestamp read as UTC, whatever the session zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(wall_clock)).cast("timestamp")


def as_utc_date(instant: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz")).cast("date")


def period_totals(
    events: DataFrame,
    key: Keys,
    ts: str,
    aggregates: list[Column],
    *,
    period: str = "1 day",
    late_by: str = "1 day",
) -> DataFrame:
    """Aggregates per key and period; state is dropped once the watermark has passed a period.

    Rows that come later than that are lost; where they must count, use :func:`totals_to`.
    """
    rows = events if isinstance(events.schema[ts].dataType, T.TimestampType) else events.withColumn(ts, as_instant(ts))
    return (
        rows.withWatermark(ts, late_by)
        .groupBy(*as_list(key), F.window(ts, period).alias("_w"))
        .agg(*aggregates)
        .withColumn("day", as_utc_date(F.col("_w.start")))
        .drop("_w")
    )


def run_available(
    stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None], *, mode: str = "update"
) -> StreamingQuery:
    """Work off everything that is there, batch by batch, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each_batch)
        .start()
    )
    query.awaitTermination()
    return query


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch into its own folder, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def totals_to(path: str, key: Keys, ts: str, sums: dict[str, Column]) -> Callable[[DataFrame, int], None]:
    """Sums per key and day of each batch, in a folder of its own; no row is too late, and no state is kept."""

    def write(batch: DataFrame, batch_id: int) -> None:
        instant = F.col(ts) if isinstance(batch.schema[ts].dataType, T.TimestampType) else as_instant(ts)
        totals = batch.groupBy(*as_list(key), as_utc_date(instant).alias("day")).agg(*[c.alias(n) for n, c in sums.items()])
        totals.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def late_to(path: str, key: Keys, ts: str, sums: dict[str, Column], *, period: str = "1 day", late_by: str = "1 day") -> Callable[[DataFrame, int], None]:
    """Sums of the rows that :func:`period_totals` leaves out of the same batches, in a folder for each batch.

    A window is closed for a batch if it ended before the newest event of all earlier batches less ``late_by``.  Each
    batch is read once and leaves its newest event behind; a repeated batch replaces both.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        instant = F.col(ts) if isinstance(batch.schema[ts].dataType, T.TimestampType) else as_instant(ts)
        rows = batch.withColumn("_t", instant).groupBy(*as_list(key), F.window("_t", period).alias("_w"))
        found = materialize(rows.agg(F.max("_t").alias("_newest"), *[c.alias(n) for n, c in sums.items()]), "windows")
        seen = found.agg(F.max("_newest").alias("newest"))
        seen.write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")
        before = spark.read.schema("newest timestamp, batch_id bigint").option("basePath", f"{path}/newest").parquet(f"{path}/newest")
        newest = before.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        bound = F.date_trunc("MILLISECOND", F.lit(newest).cast("timestamp")) - F.expr(f"interval {late_by}")
        late = found.filter(F.coalesce(F.col("_w.end") <= bound, F.lit(False)))
        late.select(*as_list(key), as_utc_date(F.col("_w.start")).alias("day"), *sums).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")

    return write


def totals_with_late(spark: SparkSession, windows_path: str, late_path: str, key: Keys, sums: list[str]) -> DataFrame:
    """The newest state of each window that was written in update mode, plus what came too late for it."""
    on = [*as_list(key), "day"]
    timely = latest_of_batches(spark, windows_path, on).select(*on, *sums)
    late = spark.read.parquet(f"{late_path}/late").select(*on, *sums)
    return timely.unionByName(late).groupBy(*on).agg(*[F.sum(n).alias(n) for n in sums])


def settled(
    stream: DataFrame,
    on: Keys,
    *,
    forecast: str = "forecast",
    order: str = "load_seq",
    time: str | None = None,
    expire: str | None = None,
) -> DataFrame:
    """The winner of each key as keyed state: an actual beats a forecast, then the newest arrival wins.

    In update mode a batch gives the keys that changed, and no stored table is read or rewritten; a repeated batch finds
    the state that it began with.  With ``time``, a date or timestamp among ``on``, and ``expire`` the state of a key goes
    once the stream has passed it by that much; rows that come for it later are left out.
    """
    on = as_list(on)
    rest = [c for c in stream.columns if c not in on]
    rank = F.struct((~F.col(forecast)).cast("int"), F.col(order))
    keys: list[str] = list(on)
    if time is not None and expire is not None:
        stream = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", expire)
        keys.append("_t")
    best = stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*[F.col(c) if c in on else F.col("_row")[c].alias(c) for c in stream.columns if c != "_t"])


def totals_of_batches(spark: SparkSession, path: str, key: Keys, sums: list[str]) -> DataFrame:
    """What :func:`totals_to` wrote, added up over all batches."""
    return spark.read.parquet(path).groupBy(*as_list(key), "day").agg(*[F.sum(n).alias(n) for n in sums])


def latest_of_batches(spark: SparkSession, path: str, on: Keys) -> DataFrame:
    """The newest version of each key over all batches of :func:`append_to` in update mode."""
    return keep_last(spark.read.parquet(path), on, "batch_id").drop("batch_id")


def upsert_to(path: str, on: Keys, order: Keys, time: str = "month") -> Callable[[DataFrame, int], None]:
    """Merge each batch into a table partitioned by year.

    Keeping the last by ``order`` gives the same table when a batch is repeated
    after a failure.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_into_years(batch, path, on, order, time)

    return write


def settle_to(
    path: str, on: Keys, *, forecast: str = "forecast", order: str = "load_seq", time: str = "month"
) -> Callable[[DataFrame, int], None]:
    """Like :func:`upsert_to`, but an actual always replaces a forecast of the same month.

    A batch without rows, as an empty file gives, changes nothing and makes no table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch, "batch")  # read for its years, then for its rows
        if batch.isEmpty():
            return
        stored = stored_years(batch, path, time)
        rows = batch if stored is None else stored.unionByName(batch)
        replace_years(materialize(settle(rows, on, forecast=forecast, order=order), "settle"), path, time)

    return write
