"""Polled snapshots as a stream source: the offset is the name of the newest snapshot.

A poll that finds nothing new gives no batch, and a restart goes on behind the last snapshot that its checkpoint holds, so
"is there anything new" is the checkpoint's own work.  Snapshots are folders whose names sort by age; a folder counts
once it holds ``_SUCCESS``, which Spark writes last.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


class _File(InputPartition):
    def __init__(self, snapshot: str, path: str):
        super().__init__(path)
        self.snapshot, self.path = snapshot, path


class SnapshotReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, root: str):
        self.schema, self.root = schema, root

    def _folder(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.root)

    def _snapshots(self) -> list[str]:
        """Names of the finished snapshots, oldest first."""
        files, base = self._folder()
        found = files.get_file_info(pafs.FileSelector(base, allow_not_found=True))
        names = sorted(f.base_name for f in found if f.type == pafs.FileType.Directory and f.base_name[:1] not in "._")
        done = files.get_file_info([f"{base}/{n}/_SUCCESS" for n in names]) if names else []
        return [n for n, f in zip(names, done) if f.type == pafs.FileType.File]

    def initialOffset(self) -> dict:
        return {"snapshot": ""}

    def latestOffset(self) -> dict:
        return {"snapshot": max(self._snapshots(), default="")}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        """A partition for each file of the snapshots behind ``start`` up to ``end``."""
        files, base = self._folder()
        out = []
        for name in self._snapshots():
            if start["snapshot"] < name <= end["snapshot"]:
                inside = files.get_file_info(pafs.FileSelector(f"{base}/{name}", recursive=True))
                out += [_File(name, f.path) for f in sorted(inside, key=lambda f: f.path) if f.type == pafs.FileType.File and f.base_name.endswith(".parquet")]
        return out

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        files, _ = self._folder()
        names = [f.name for f in self.schema.fields if f.name != "snapshot"]
        with files.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=names):
                columns = {n: batch.column(batch.schema.names.index(n)) for n in names}
                columns["snapshot"] = pa.array([partition.snapshot] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in self.schema.fields], names=[f.name for f in self.schema.fields])


class SnapshotSource(DataSource):
    """``format("snapshots")`` with the option ``path``; the schema is given and may hold a column ``snapshot``."""

    @classmethod
    def name(cls) -> str:
        return "snapshots"

    def streamReader(self, schema: StructType) -> SnapshotReader:
        return SnapshotReader(schema, self.options["path"])


def read_snapshots(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """A stream of the rows of every snapshot below ``root``, each snapshot once; ``schema`` is DDL."""
    spark.dataSource.register(SnapshotSource)
    return spark.readStream.format("snapshots").schema(schema).option("path", root).load()
