"""Helpers that the operators share: narrow selection, written work tables, distributed ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidetable.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text has remainder 0; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % folds == 0


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, key: str, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_rank``, the place of each row among those of its key (from 0), and the row count of each key.

    The rows are dealt by range of (key, order), so a key with a third of all rows fills many tasks; each task counts
    its rows by key, and the counts, a row for each task and key, give every task its first rank.
    """
    dealt = df.repartitionByRange(partitions(df), key, *order).sortWithinPartitions(key, *order)
    # the parts are written, so a task that is repeated finds the same rows in the same part
    parts = materialize(dealt.withColumn("_part", F.spark_partition_id()), label)
    counts = materialize(parts.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n")), f"{label}-counts")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    local = F.row_number().over(Window.partitionBy("_part", key).orderBy(*order)) - 1
    out = parts.withColumn("_local", local).join(first, [key, "_part"]).withColumn("_rank", F.col("_local") + F.col("_first"))
    totals = counts.groupBy(key).agg(F.sum("_n").alias("_n"))
    return out.drop("_part", "_local", "_first"), totals
