"""Snapshots of periods with a manifest: what counts, what is superseded by which, and what may be dropped.

A commit writes the rows of a snapshot below ``data/snapshot=<name>/<period>=<value>`` and then one new version of the
manifest, which lists every partition of every snapshot with the snapshot that superseded it, if there is one.  Readers
follow the newest whole version, so they see a commit at once or not at all; a commit that broke off leaves files that no
version names.  A version is whole if it holds as many rows as each of its rows says.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.session import broadcast_if_small, materialize

MANIFEST = "version bigint, entries bigint, snapshot string, period string, n_rows bigint, superseded_by string"


@dataclass(frozen=True)
class SnapshotTable:
    """A folder of snapshots whose rows are replaced period by period; ``period`` is a column of the rows."""

    spark: SparkSession
    root: str
    period: str = "year"

    def _versions(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def manifest(self) -> DataFrame | None:
        """Entries of the newest whole version, or None before the first commit."""
        versions = self._versions()
        if versions is None:
            return None
        found = versions.groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.max("entries").alias("entries")).filter("n = entries")
        newest = found.agg(F.max("version")).first()[0]
        return None if newest is None else versions.filter(F.col("version") == newest)

    def _publish(self, entries: DataFrame, before: DataFrame | None) -> None:
        last = 0 if before is None else before.agg(F.max("version")).first()[0] or 0
        entries = materialize(entries.select("snapshot", "period", "n_rows", "superseded_by"), "entries")
        number, size = F.lit(last + 1).cast("bigint"), F.lit(entries.count()).cast("bigint")
        version = entries.select(number.alias("version"), size.alias("entries"), "snapshot", "period", "n_rows", "superseded_by")
        version.write.mode("append").parquet(f"{self.root}/manifest")

    def commit(self, rows: DataFrame, name: str) -> None:
        """Add a snapshot; for the periods that it has rows of it takes the place of all earlier ones.

        A repeated commit of the same name replaces its own rows.
        """
        before = self.manifest()
        place = f"{self.root}/data/snapshot={name}"
        rows.hint("rebalance", self.period).write.mode("overwrite").partitionBy(self.period).parquet(place)
        written = self.spark.read.parquet(place).groupBy(F.col(self.period).cast("string").alias("period")).agg(F.count(F.lit(1)).alias("n_rows"))
        own = written.select(F.lit(name).alias("snapshot"), "period", "n_rows", F.lit(None).cast("string").alias("superseded_by"))
        if before is not None:
            covered = broadcast_if_small(own.select("period", F.lit(name).alias("_by")))
            kept = before.filter(F.col("snapshot") != name).join(covered, "period", "left")
            by = F.coalesce("superseded_by", "_by")
            own = kept.select("snapshot", "period", "n_rows", by.alias("superseded_by")).unionByName(own)
        self._publish(own, before)

    def read(self) -> DataFrame:
        """The rows that count, with the snapshot that each comes from."""
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no snapshot below {self.root}")
        live = manifest.filter(F.col("superseded_by").isNull()).select("snapshot", F.col("period").alias("_period"))
        data = self.spark.read.option("basePath", f"{self.root}/data").parquet(f"{self.root}/data/snapshot=*")
        data = data.withColumn("snapshot", F.col("snapshot").cast("string"))
        # both columns are folders, so the join prunes the files that are read
        same = (data["snapshot"] == live["snapshot"]) & (F.col(self.period).cast("string") == live["_period"])
        return data.join(broadcast_if_small(live), same, "left_semi")

    def superseded(self) -> DataFrame:
        """Partitions that no longer count, and what took their place."""
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no snapshot below {self.root}")
        return manifest.filter(F.col("superseded_by").isNotNull()).select("snapshot", "period", "n_rows", "superseded_by")

    def drop_superseded(self) -> list[str]:
        """Take the superseded partitions out of the manifest, then delete their folders, and return these.

        Readers of the new version never look there; the list is one entry for each period that was replaced.
        """
        before = self.manifest()
        gone = [f"{self.root}/data/snapshot={r['snapshot']}/{self.period}={r['period']}" for r in self.superseded().toLocalIterator()]
        if not gone:
            return []
        self._publish(before.filter(F.col("superseded_by").isNull()), before)
        context = self.spark.sparkContext
        for folder in gone:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        return sorted(gone)
