"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs, modulo powers of two.

A paragraph (line) hashes to a vector in two parts.  The first is a wide digest, added modulo 2**64: two texts have equal
sums when they have the same paragraphs with the same frequency, in any order.  The second spreads the paragraph's
overlapping pieces of PIECE code points over signed lanes, added modulo 2**32: the angle between two such sums estimates the likeness of the
texts.  Both are sums over paragraphs, so paragraphs can be inserted into and deleted from a fingerprint without the rest
of the text, and fingerprints of parts add up.

Defined results: null and empty texts have no paragraph and the fingerprint zero, which is like itself only; empty lines
are paragraphs too; equal texts have equal fingerprints.

``dealt_by_range`` and ``neighbours`` let each document meet the next one in the same task.  Rows of equal id follow each
other in the order of their texts' hashes; null ids come last, in the same order; a document alone is its own neighbour.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.llm.arrays import mix, text_chunks
from tidetable.llm.common import partitions

DIGEST_LANES = 8  # of 64 bits
SKETCH_LANES = 256  # of 32 bits
#: Code points of the overlapping pieces of a paragraph, and of those that paragraphs of under BRIEF code points also give.
PIECE, SMALL_PIECE, BRIEF = 7, 3, 24
SIZE = 8 * DIGEST_LANES + 4 * SKETCH_LANES


def _document_sums(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both parts of the fingerprints of a chunk's documents."""
    rows, n = len(offsets) - 1, len(points)
    digests = np.zeros((rows, DIGEST_LANES), np.uint64)
    if not n:
        return digests, np.zeros((rows, SKETCH_LANES), np.uint32)
    text = points.tobytes().decode("utf-32-le")
    bounds = offsets.tolist()
    short, short_owner = [], []
    for i in range(rows):
        if bounds[i + 1] > bounds[i]:
            lines = text[bounds[i] : bounds[i + 1]].split("\n")
            wide = b"".join([hashlib.blake2b(x.encode(), digest_size=8 * DIGEST_LANES).digest() for x in lines])
            words = np.frombuffer(wide, "<u8").reshape(-1, DIGEST_LANES)
            digests[i] = words.sum(axis=0, dtype=np.uint64)
            brief = [zlib.crc32(x[j : j + SMALL_PIECE].encode()) for x in lines if 0 < len(x) < BRIEF for j in range(max(1, len(x) - SMALL_PIECE + 1))]
            short.append(np.array(brief, np.uint64))
            short_owner.append(np.full(len(brief), i))
    # the other pieces: PIECE code points that hold no line break and no border of documents
    of_row = np.repeat(np.arange(rows), np.diff(offsets))
    keys, owner = np.concatenate(short), np.concatenate(short_owner)
    if (m := n - PIECE + 1) > 0:
        breaks = np.concatenate(([0], np.cumsum(points == 10)))
        values = points.astype(np.uint64)
        h = np.zeros(m, np.uint64)
        for k in range(PIECE):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += values[k : k + m]
        whole = (breaks[PIECE:] == breaks[:m]) & (of_row[:m] == of_row[PIECE - 1 :])
        keys, owner = np.concatenate((keys, h[whole])), np.concatenate((owner, of_row[:m][whole]))
    mixed = mix(keys)
    lane = (mixed >> np.uint64(56)).astype(np.int64)
    sign = (mixed & np.uint64(1)).astype(np.float64) * 2 - 1
    sums = np.bincount(owner * SKETCH_LANES + lane, sign, minlength=rows * SKETCH_LANES)
    return digests, (sums.astype(np.int64).reshape(rows, SKETCH_LANES) & 0xFFFFFFFF).astype(np.uint32)


def fingerprints_of(texts: pa.Array) -> list[bytes]:
    """The fingerprint of each text, digest lanes first, little-endian."""
    out: list[bytes] = []
    for _, _, points, offsets in text_chunks(texts):
        digests, sketch = _document_sums(points, offsets)
        out += [d.tobytes() + s.tobytes() for d, s in zip(digests.astype("<u8"), sketch.astype("<u4"))]
    return out


def _lanes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(raw, "<u8", DIGEST_LANES), np.frombuffer(raw, "<u4", SKETCH_LANES, 8 * DIGEST_LANES)


def combine(a: bytes, b: bytes, sign: int = 1) -> bytes:
    """Fingerprint of the paragraphs of both (sign 1), or of those of ``a`` without those of ``b`` (sign -1)."""
    (da, sa), (db, sb) = _lanes(a), _lanes(b)
    return (da + db).tobytes() + (sa + sb).tobytes() if sign > 0 else (da - db).tobytes() + (sa - sb).tobytes()


def likeness(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Cosine of the signed lanes, from 0 to 1; equal fingerprints are 1, a zero one is like itself only."""
    if not a:
        return np.zeros(0)
    x, y = (np.array([_lanes(r)[1].astype(np.int32) for r in side], np.float64) for side in (a, b))
    norms = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.clip((x * y).sum(axis=1) / np.maximum(norms, 1e-12), 0, 1)
    return np.where([p == q for p, q in zip(a, b)], 1.0, cosine)


def as_text(raw: bytes) -> str:
    return base64.b64encode(raw).decode()


def fingerprint(df: DataFrame, text: str = "text", output: str = "fingerprint") -> DataFrame:
    """``df`` with the binary fingerprint of each text."""
    fields = [*(f for f in df.schema.fields if f.name != output), T.StructField(output, T.BinaryType())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                kept = [n for n in part.schema.names if n != output]
                arrays = [part.column(part.schema.names.index(n)) for n in kept]
                raw = pa.array(fingerprints_of(part.column(part.schema.names.index(text))), pa.binary())
                yield pa.RecordBatch.from_arrays([*arrays, raw], names=[*kept, output])

    return df.mapInArrow(work, T.StructType(fields))


@dataclass(frozen=True)
class Cuts:
    """Borders of ranges: ids, each the last of a range, and into how many parts by hash the rows of some ids are cut."""

    ids: np.ndarray  # rising
    parts: dict[int | None, int]  # of ids that many rows have; None stands for rows without id

    def number(self, ids: np.ndarray, known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The range of each row, in the order of falling ids and rising hashes, rows without id last."""
        many = np.array(sorted(k for k in self.parts if k is not None), np.int64)
        more = np.array([self.parts[int(k)] - 1 for k in many], np.int64)
        passed = np.concatenate((np.cumsum(more[::-1])[::-1], [0]))  # borders inside all ids from the k-th on
        out = len(self.ids) - np.searchsorted(self.ids, ids, side="right") + passed[np.searchsorted(many, ids, side="right")]
        share = (hashes.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
        for k, n in self.parts.items():
            own = ~known if k is None else known & (ids == k)
            part = (share[own] * np.uint64(n) >> np.uint64(32)).astype(np.int64)
            out[own] = (len(self.ids) + passed[0] if k is None else out[own]) + part
        if None not in self.parts:
            out[~known] = len(self.ids) + passed[0]
        return out


def dealt_by_range(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """Rows (``_range``, ``_own``, ``_id``, ``_text``) dealt and sorted by descending id, nulls last.

    The first row of each range also stands at the end of the range before, with ``_own`` false, and the first of all at
    the very end, so each range can be read alone.  The ids are read once for the bounds, of which there are a few for
    each partition, and once for the first row of each range; nothing else is gathered.  The rows of an id that fills
    several ranges, or of no id, are cut further by the hashes of their texts.
    """
    rows = df.select(F.col(row_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    count = 4 * partitions(df)
    quantiles = F.percentile_approx("_id", [k / count for k in range(1, count)], 20 * count)
    found = rows.agg(quantiles.alias("p"), F.count("_id").alias("known"), F.count(F.lit(1)).alias("all")).first()
    borders = [int(x) for x in found["p"] or []]
    parts: dict[int | None, int] = {k: n for k, n in Counter(borders).items() if n > 1}
    if (n := round(count * (found["all"] - found["known"]) / max(1, found["all"]))) > 1:
        parts[None] = n
    cuts = Cuts(np.array(sorted(set(borders)), np.int64), parts)

    @F.pandas_udf("int")
    def number(ids: pd.Series, known: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(cuts.number(ids.to_numpy(np.int64), known.to_numpy(bool), hashes.to_numpy(np.int64)).astype(np.int32))

    # without parts the ids alone tell the ranges, and the texts are not read for it
    marked = rows.withColumn("_hash", F.xxhash64("_text") if parts else F.lit(0).cast("long"))
    marked = marked.withColumn("_range", number(F.coalesce("_id", F.lit(0).cast("long")), F.col("_id").isNotNull(), F.col("_hash")))
    first = marked.groupBy("_range").agg(F.max(F.struct("_id", F.bitwise_not("_hash").alias("h"))).alias("top"))
    tops = {r["_range"]: (r["top"]["_id"], ~r["top"]["h"]) for r in first.collect()}
    order = sorted(tops)
    before = dict(zip((tops[r] for r in order[1:] + order[:1]), order))

    @F.pandas_udf("int")
    def behind(ids: pd.Series, known: pd.Series, hashes: pd.Series) -> pd.Series:
        keys = zip(ids.tolist(), known.tolist(), hashes.tolist())
        return pd.Series([before.get((i if k else None, h), -1) for i, k, h in keys], dtype="int32")

    also = behind(F.coalesce("_id", F.lit(0).cast("long")), F.col("_id").isNotNull(), F.col("_hash"))
    marked = marked.withColumn("_also", also)
    to = F.array(F.struct(F.col("_range").alias("r"), F.lit(True).alias("own")), F.when(F.col("_also") >= 0, F.struct(F.col("_also").alias("r"), F.lit(False).alias("own"))))
    spread = marked.select("_id", "_text", F.explode(F.array_compact(to)).alias("_to"))
    spread = spread.select(F.col("_to.r").alias("_range"), F.col("_to.own").alias("_own"), "_id", "_text")
    sort = ["_range", F.desc("_own"), F.desc_nulls_last("_id"), F.xxhash64("_text")]
    return spread.repartition(partitions(df), "_range").sortWithinPartitions(*sort)


@dataclass(frozen=True)
class Pair:
    """A document and the next one, with their fingerprints."""

    row_id: int | None
    text: str
    mark: bytes
    next_text: str
    next_mark: bytes


def neighbours(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[list[Pair]]:
    """Each own row of ``dealt_by_range`` with the row behind it; a range without an end row closes on itself."""
    first = held = None  # (range, own, id, text, mark)
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            names = part.schema.names
            texts = part.column(names.index("_text")).fill_null("")
            columns = [part.column(names.index(c)).to_pylist() for c in ("_range", "_own", "_id")]
            out = []
            for row in zip(*columns, texts.to_pylist(), fingerprints_of(texts)):
                if held is not None and held[1]:
                    behind = row if row[0] == held[0] else first
                    out.append(Pair(held[2], held[3], held[4], behind[3], behind[4]))
                if held is None or row[0] != held[0]:
                    first = row
                held = row
            yield out
    if held is not None and held[1]:
        yield [Pair(held[2], held[3], held[4], first[3], first[4])]
