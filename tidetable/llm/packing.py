"""Best-fit packing of tokenised texts by minimum bin slack.

Texts longer than a sequence are cut into full pieces behind a shorter first one.  Which lengths share a sequence only
depends on how many pieces each length has, so the plan is made from that histogram, which has no more entries than a
sequence has tokens, whatever the number of texts.  For one bin at a time, the longest piece left is set and a subset-sum
over bitsets of the available lengths finds the fullest combination beside it; that combination is then removed as often
as its lengths allow.  Every piece finds its place from its length and its rank among the pieces of that length.

Defined results: null and empty texts are one piece, the end id alone; repeated rows are packed as rows of their own;
an empty table gives no pieces.  Columns of the input that are asked for pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidetable.llm.bpe import _replace, _with, text_ids, vocabulary
from tidetable.llm.common import ranked
from tidetable.session import materialize

#: The split pattern of byte-level vocabularies; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary with its special strings, which stay whole inside texts."""
    vocab = vocabulary(path)
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=vocab.ranks, special_tokens=vocab.special)


def ids_of(text: str, path: str) -> np.ndarray:
    """The ids of a text; where the library's regex runs out of stack, in very long white space, by our own scan."""
    try:
        return np.array(encoder(path).encode(text, allowed_special="all"), "<u4")
    except ValueError:
        return text_ids(text, path)


def pieces(df: DataFrame, path: str, end_id: int, capacity: int, keep: list[str], text: str = "text") -> DataFrame:
    """The pieces of every text: ``piece``, ``start`` and ``length`` in ids, and the ids' ``ids_crc32``."""
    source = df.select(*dict.fromkeys([*keep, text]))
    rest = source.select(*keep)
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            for at in range(0, batch.num_rows, 256):
                row, number, start, length, crc = [], [], [], [], []
                for i, t in enumerate(column.slice(at, 256).to_pylist()):
                    ids = ids_of(t or "", path).tobytes() + end
                    n = len(ids) // 4
                    ends = range(n - (n - 1) // capacity * capacity, n + 1, capacity)
                    for k, stop in enumerate(ends):
                        begin = max(0, stop - capacity) if k else 0
                        row.append(at + i)
                        number.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        crc.append(zlib.crc32(ids[4 * begin : 4 * stop]))
                part = batch.select(keep).take(pa.array(row, pa.int64()))
                columns = {"piece": pa.array(number, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
                yield _replace(part, columns)

    fields = [T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    return source.mapInArrow(work, _with(rest, fields))


@dataclass(frozen=True)
class Bins:
    """Equal bins: how many, and how many pieces of which lengths each holds."""

    times: int
    content: tuple[tuple[int, int], ...]  # (length, copies), longest first


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, copies) with the largest total of at most ``room``, longer pieces preferred."""
    if not room:
        return []
    lengths = sorted(x for x, n in counts.items() if n and x <= room)
    mask, reach, before = (1 << (room + 1)) - 1, 1, []
    for x in lengths:
        before.append(reach)
        left, step = min(counts[x], room // x), 1
        while left:  # any number of copies, by doubling
            step = min(step, left)
            reach |= reach << (x * step) & mask
            left -= step
            step *= 2
    goal, out = reach.bit_length() - 1, []
    for x, smaller in zip(reversed(lengths), reversed(before)):
        copies = min(counts[x], goal // x)
        while not smaller >> (goal - copies * x) & 1:
            copies -= 1
        if copies:
            out.append((x, copies))
            goal -= copies * x
    return out


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Bins for all pieces of the histogram ``counts`` (length -> pieces)."""
    left = {x: n for x, n in counts.items() if n}
    out = []
    while left:
        seed = max(left)
        left[seed] -= 1
        content = dict(fullest(left, capacity - seed))
        left[seed] += 1
        content[seed] = content.get(seed, 0) + 1
        times = min(left[x] // c for x, c in content.items())
        for x, c in content.items():
            left[x] -= c * times
            if not left[x]:
                del left[x]
        out.append(Bins(times, tuple(sorted(content.items(), reverse=True))))
    return out


def _slots(plan: list[Bins]) -> dict[str, np.ndarray]:
    """A row for each length of each plan entry: the first rank it takes, its copies and bins, and where they begin."""
    used: dict[int, int] = {}
    rows, bin_base = [], 0
    for bins in plan:
        offset = 0
        for x, copies in bins.content:
            rows.append((x, used.get(x, 0), bins.times, bin_base, offset))
            used[x] = used.get(x, 0) + copies * bins.times
            offset += copies * x
        bin_base += bins.times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "times", "base", "offset"), table.T))


def pack(parts: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``; ``order`` ranks pieces of equal length, in any way that is fixed."""
    histogram = {r[length]: r["count"] for r in parts.groupBy(length).count().collect()}
    if any(x is None or not 0 < x <= capacity for x in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    slots = _slots(minimum_bin_slack(histogram, capacity))
    placed, _ = ranked(parts, length, order, "packing")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = 1 << 50
        keys = slots["length"] * span + slots["first"]
        for batch in batches:
            x, rank = (np.asarray(batch.column(batch.schema.names.index(c))) for c in (length, "_rank"))
            at = np.searchsorted(keys, x * span + rank, side="right") - 1
            own = rank - slots["first"][at]
            copy, nth = np.divmod(own, slots["times"][at])
            columns = {"sequence_id": pa.array(slots["base"][at] + nth), "offset": pa.array(slots["offset"][at] + copy * x)}
            names = [n for n in batch.schema.names if n != "_rank"]
            yield _replace(batch.select(names), columns)

    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return placed.mapInArrow(work, _with(placed.drop("_rank"), fields))


def pack_texts(df: DataFrame, path: str, end_id: int, capacity: int, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise, cut and pack the texts of ``df``; the pieces are written once, between the two steps."""
    parts = materialize(pieces(df, path, end_id, capacity, [row_id], text), "pieces")
    return pack(parts, capacity, [row_id, "start", "ids_crc32"]).select(
        row_id, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
