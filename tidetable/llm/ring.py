"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on the ring many times.  A row belongs to the arc that its key hashes into, and to the shard at the
arc's end; a shard takes no more rows than its bound, and the rows that find it full continue clockwise to the next
shard.  How many rows of each arc end where only depends on the arcs' counts, of which there are as many as virtual nodes,
so that is planned from the counts; a row then finds its shard and slot from its arc and its rank within the arc.  Rows
of equal key have neighbouring ranks, so they stay together unless a shard fills up among them, and a key that holds a
third of all rows fills one shard after another.

With no slack the bounds add up to the rows, so the shards' counts differ by one at most; with slack fewer rows move when
shards are added, and no shard is above (1 + slack) times the mean.

Defined results: null keys are keys as well, all equal; repeated rows get slots of their own; an empty table stays empty.
Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.llm.arrays import mix
from tidetable.llm.bpe import _replace, _with
from tidetable.llm.common import ranked
from tidetable.session import materialize


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions of all virtual nodes, as signed 64-bit numbers, and the shard of each.

    A shard's positions do not depend on the other shards.
    """
    number = np.repeat(np.arange(shards, dtype=np.uint64), nodes) * np.uint64(1 << 32) + np.tile(np.arange(nodes, dtype=np.uint64), shards)
    position = mix(mix(number + np.uint64(1))).view(np.int64)
    order = np.argsort(position, kind="stable")
    return position[order], (np.arange(shards * nodes) // nodes)[order]


def bounds(rows: int, shards: int, slack: float) -> list[int]:
    """How many rows each shard may take."""
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(np.ceil((1 + slack) * rows / shards))] * shards


def allocate(counts: dict[int, int], owner: np.ndarray, limits: list[int]) -> np.ndarray:
    """(arc, first rank, shard, first slot) of each stretch of rows, sorted by arc and rank.

    In step t every arc's rows that have no place yet try the shard t nodes further on, in the order of the arcs.
    """
    left, load, taken = dict(sorted(counts.items())), [0] * len(limits), dict.fromkeys(counts, 0)
    out = []
    for step in range(len(owner)):
        for arc in list(left):
            shard = int(owner[(arc + step) % len(owner)])
            n = min(left[arc], limits[shard] - load[shard])
            if n > 0:
                out.append((arc, taken[arc], shard, load[shard]))
                taken[arc] += n
                load[shard] += n
                left[arc] -= n
            if not left[arc]:
                del left[arc]
        if not left:
            break
    if left:
        raise ValueError("the bounds are smaller than the number of rows")
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def assign(df: DataFrame, key: Column, shards: int, order: list[str], nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """``df`` with ``shard`` and ``slot``; ``order`` ranks rows of equal key and may leave only equal rows tied."""
    position, owner = ring(shards, nodes)

    @F.pandas_udf("int")
    def arc_of(hashes: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(position, hashes.to_numpy(np.int64)) % len(position), dtype="int32")

    keyed = materialize(df.withColumn("_hash", F.xxhash64(key)).withColumn("_arc", arc_of("_hash")), "ring")
    placed, totals = ranked(keyed, "_arc", ["_hash", *order], "ring-ranks")
    counts = {r["_arc"]: r["_n"] for r in totals.collect()}
    table = allocate(counts, owner, bounds(sum(counts.values()), shards, slack))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = 1 << 50
        keys = table[:, 0] * span + table[:, 1]
        for batch in batches:
            names = batch.schema.names
            arc, rank = (np.asarray(batch.column(names.index(c))).astype(np.int64) for c in ("_arc", "_rank"))
            at = np.searchsorted(keys, arc * span + rank, side="right") - 1
            columns = {"shard": pa.array(table[at, 2].astype(np.int32)), "slot": pa.array(table[at, 3] + rank - table[at, 1])}
            yield _replace(batch.select([n for n in names if n not in ("_arc", "_rank", "_hash")]), columns)

    fields = [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    return placed.mapInArrow(work, _with(placed.drop("_arc", "_rank", "_hash"), fields))
