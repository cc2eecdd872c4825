"""CSV scans: typed, all text, with a preamble, after a marker, with an encoding to find."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from csv import reader

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable import schemas
from tidetable.functions import numeric
from tidetable.session import broadcast_if_small, materialize

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def scan_csv(
    spark: SparkSession,
    paths: Paths,
    schema: str,
    *,
    date_format: str = "yyyy-MM-dd",
    encoding: str = "UTF-8",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """CSV with a header and a known schema; dates are parsed, NaN becomes NULL.

    Only ``columns`` are read when given.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", date_format)
        .option("encoding", encoding)
        .csv(_paths(paths))
    )
    return numeric.nan_to_null(df.select(*columns) if columns else df)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each run of one (file, split), which a task reads in the order of the file."""
    last, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        places = pc.binary_join_element_wise(batch.column(names.index("_block")).cast(pa.string()), batch.column(names.index("_file")), " ").dictionary_encode()
        codes = np.asarray(places.indices)
        starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        line = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        first, final = places[0].as_py(), places[len(places) - 1].as_py()
        if first == last:
            line[: starts[1] if len(starts) > 1 else None] += count
        count = int(line[-1]) + 1
        last = final
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(line)], names=[*names, "_line"])


def _lines(spark: SparkSession, paths: Paths, *, as_bytes: bool = False) -> DataFrame:
    """Text lines with their file, the offset of their split and their number in it.

    A task numbers the lines as it reads them, so no second scan has to agree with the first about anything but where
    files are split.  (split, line) is the order of lines in a file without sorting.  ``as_bytes`` gives each byte as the
    character of its number.
    """
    if as_bytes:
        # one byte is one character in ISO-8859-1, so its bytes are the file's
        found = spark.read.option("encoding", "ISO-8859-1").schema("value string").option("sep", "\x01").option("quote", "").csv(_paths(paths))
    else:
        found = spark.read.text(_paths(paths))
    rows = found.select(F.col("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    return rows.mapInArrow(_numbered, "value string, _file string, _block bigint, _line bigint")


def _is_first():
    return (F.col("_block") == 0) & (F.col("_line") == 0)


def _parsed_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(batch.schema.names.index("value")).to_pylist()
        fields = [next(reader([(v or "").lstrip("\ufeff")]), []) for v in values]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index("_file")), pa.array(fields, pa.list_(pa.string()))], names=["_file", "_fields"])


def _headers(lines: DataFrame) -> DataFrame:
    """(file, fields) of every file: the inventory, as a table."""
    return lines.filter(_is_first()).select("_file", "value").mapInArrow(_parsed_header, "_file string, _fields array<string>")


def scan_csv_text(spark: SparkSession, paths: Paths, columns: Sequence[str]) -> DataFrame:
    """Every field as text, pruned to ``columns``, which are found by name in each file's own header.

    Casting happens later, so one bad field never loses its row.  File splits
    take the place of reading in chunks.  Headers are a table with a row for each
    file, which lines are joined to; the driver only learns how wide the widest is
    and whether one lacks a column.
    """
    lines = _lines(spark, paths)
    headers = materialize(_headers(lines), "headers")
    unclear = [F.when(F.size("_fields") - F.size(F.array_remove("_fields", F.lit(c))) != 1, F.lit(c)) for c in columns]
    wrong = F.coalesce(*unclear)
    width, bad = headers.agg(F.max(F.size("_fields")), F.min(F.when(wrong.isNotNull(), F.struct(F.col("_file").alias("f"), wrong.alias("c"))))).first()
    if bad is not None:
        raise ValueError(f"{bad['f']} has no column {bad['c']}, or has it twice")
    if width is None:
        return spark.createDataFrame([], schemas.all_strings(*columns))
    body = lines.filter(~_is_first() & (F.length(F.trim("value")) > 0)).join(broadcast_if_small(headers), "_file")
    row = F.from_csv("value", schemas.all_strings(*(f"_{i}" for i in range(width))), {})
    cells = body.select("_fields", row.alias("_r")).select("_fields", F.array(*[F.col(f"_r._{i}") for i in range(width)]).alias("_cells"))
    return cells.select(*[F.get("_cells", (F.array_position("_fields", F.lit(c)) - 1).cast("int")).alias(c) for c in columns])


def _parse(lines: DataFrame, schema: str, options: dict[str, str] | None) -> DataFrame:
    parsed = lines.filter(F.length(F.trim("value")) > 0).select(
        F.from_csv("value", schema, options or {}).alias("_r")
    )
    return parsed.select("_r.*")


def scan_csv_after_preamble(
    spark: SparkSession,
    paths: Paths,
    schema: str,
    *,
    skip: int,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Rows after the first ``skip`` lines of each file (preamble and header line), which its first split holds."""
    return _parse(_lines(spark, paths).filter((F.col("_block") > 0) | (F.col("_line") >= skip)), schema, options)


def scan_csv_after_marker(
    spark: SparkSession,
    paths: Paths,
    schema: str,
    *,
    marker: str,
    has_header: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Rows below the first line equal to ``marker``, and below the header line that follows it."""
    place = F.struct("_block", "_line")
    lines = _lines(spark, paths)
    marks = materialize(lines.filter(F.trim("value") == marker).groupBy("_file").agg(F.min(place).alias("_mark")), "marks")
    below = lines.join(broadcast_if_small(marks), "_file").filter(place > F.col("_mark"))
    if has_header:
        header = materialize(below.groupBy("_file").agg(F.min(place).alias("_header")), "marks")
        below = below.join(broadcast_if_small(header), "_file").filter(place > F.col("_header"))
    return _parse(below, schema, options)


def find_encodings(spark: SparkSession, paths: Paths, candidates: Sequence[str] = ("UTF-8", "ISO-8859-1")) -> DataFrame:
    """(file, encoding): the first candidate that decodes every line of the file, else the last one."""
    names = list(candidates)

    def failures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each run of lines of a file in a batch, a bit for each candidate that does not decode them."""
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(batch.schema.names.index("value")).to_pylist()
            files = batch.column(batch.schema.names.index("_file")).to_pylist()
            found: dict[str, list[str]] = {}
            for f, v in zip(files, values):
                found.setdefault(f, []).append(v or "")
            bits = []
            for lines in found.values():
                raw = "\n".join(lines).encode("iso-8859-1")
                bits.append(sum(1 << i for i, name in enumerate(names[:-1]) if not _decodes(raw, name)))
            yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array(bits, pa.int32())], names=["_file", "_bits"])

    lines = _lines(spark, paths, as_bytes=True).select("value", "_file")
    failed = lines.mapInArrow(failures, "_file string, _bits int").groupBy("_file").agg(F.bit_or("_bits").alias("_bits"))
    chosen = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        chosen = F.when(F.col("_bits").bitwiseAND(1 << i) == 0, F.lit(names[i])).otherwise(chosen)
    return failed.select("_file", chosen.alias("encoding"))


def _decodes(raw: bytes, encoding: str) -> bool:
    try:
        raw.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in the encoding of their file, without its mark of byte order."""
    for batch in batches:
        at = batch.schema.names.index("value")
        rows = zip(batch.column(at).to_pylist(), batch.column(batch.schema.names.index("encoding")).to_pylist())
        text = [None if v is None else v.encode("iso-8859-1").decode(e, "replace").lstrip("\ufeff") for v, e in rows]
        columns = [pa.array(text, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def scan_csv_any_encoding(
    spark: SparkSession,
    paths: Paths,
    schema: str,
    *,
    candidates: Sequence[str] = ("UTF-8", "ISO-8859-1"),
) -> DataFrame:
    """CSV whose encoding is chosen for each file; a byte-order mark at the start is dropped.

    Encodings are a table that lines are joined to and decoded by in their tasks.  A file whose header differs from the
    schema fails the scan.
    """
    encodings = materialize(find_encodings(spark, paths, candidates), "encodings")
    lines = _lines(spark, paths, as_bytes=True).join(broadcast_if_small(encodings), "_file")
    lines = lines.mapInArrow(_decoded, lines.schema)
    wanted = T.StructType.fromDDL(schema).names
    other = _headers(lines).filter(F.col("_fields") != F.array(*[F.lit(n) for n in wanted])).select("_file").limit(1).collect()
    if other:
        raise ValueError(f"the header of {other[0]['_file']} is not {wanted}")
    return numeric.nan_to_null(_parse(lines.filter(~_is_first()), schema, {"dateFormat": "yyyy-MM-dd"}))


def scan_tree(
    spark: SparkSession,
    root: str,
    schema: str,
    *,
    pattern: str = "*.csv",
    exclude: str = r"(?i)metadata|\.pdf$",
) -> DataFrame:
    """All matching files below ``root``; paths that match ``exclude`` are left out.

    The path comes back as ``source_file``.  A file whose header differs from the schema fails the scan.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(root)
    )
    name = F.col("_metadata.file_path")
    return df.filter(~name.rlike(exclude)).withColumn("source_file", name)
