"""Exact top-k by inner product: columnar branch and bound.

Vectors are turned into integers, component by component.  A group holds a block of queries and a slice of the candidates,
which stream through it in chunks; a chunk lies in vertical layout, one row for each dimension.  Dimensions are taken in
blocks, those with the greatest mass first.  After each block the rest of a product is at most the root of what mass the
query has left times that of the candidate.  The k-th best lower bound, or the k-th score of earlier chunks, is the least
that counts, and pairs whose upper bound is below it go.  While many pairs are left, a block is added for all of them by
a matrix product; when few are, the survivors are compacted to a list and a block is added for these alone.

Query blocks and candidate slices are dealt by hash, so none grows with a key; a group takes memory for its queries, their
k best so far and one chunk.  The number of groups, and with it the copies of a row, follows the numbers of rows.

Defined results: vectors that are null or empty, or hold null or non-finite components (or ones too large to scale) take
no part, nor do rows without an id; rows of one id are one vector, the smallest by its components, and a query if one of
them is; a query only meets vectors of its own length, and never its own id.  Ties go to the smaller id.  A score beyond 64 bits is given as
the nearest 64-bit number.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidetable.llm.common import partitions
from tidetable.session import materialize


@dataclass(frozen=True)
class SearchOptions:
    """Queries of a group, least and most candidates of a slice, dimensions of a block, pairs at once, and the share of
    pairs below which they are a list."""

    queries: int = 16_384
    least_rows: int = 1024
    slice_rows: int = 1 << 24
    block: int = 8
    pairs: int = 1 << 20
    few: float = 0.125


def whole(column: pa.Array, size: int, scale: float) -> np.ndarray:
    """The vectors' components times ``scale``, rounded down, as doubles (rows x size)."""
    values = np.asarray(column.flatten().cast(pa.float64())).reshape(-1, size)
    return np.floor(values * scale)


def _order(queries: np.ndarray, candidates: np.ndarray, block: int) -> list[np.ndarray]:
    """Blocks of dimensions, those first that carry most of the products."""
    mass = (queries * queries).sum(axis=0) * (candidates * candidates).sum(axis=1)
    order = np.argsort(-mass, kind="stable")
    return [order[a : a + block] for a in range(0, len(order), block)]


def _huge(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Products of numbers that doubles do not hold, in Python's integers, cut to 64 bits."""
    exact = np.vectorize(int, otypes=[object])
    limits = np.iinfo(np.int64)
    return np.clip(exact(queries) @ exact(candidates), limits.min, limits.max).astype(np.int64)


def survivors(queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, own: np.ndarray, least: np.ndarray, k: int, options: SearchOptions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the pairs that can be among the k best of their query.

    ``candidates`` are dimensions x rows, ``ids`` and ``own`` the ids of queries and rows; ``least`` is the score a pair must reach.
    """
    top = np.sqrt((queries * queries).sum(axis=1).max(initial=0)) * np.sqrt((candidates * candidates).sum(axis=0).max(initial=0))
    other = ids[:, None] != own[None, :]
    if not top < 2.0**52:
        score = _huge(queries, candidates)
        q, c = np.nonzero(other & (score >= least[:, None]))
        return q, c, score[q, c]
    blocks = _order(queries, candidates, options.block)
    # mass that is left after each block, from the last block to the first
    left_q = np.sqrt(np.cumsum([(queries[:, b] ** 2).sum(axis=1) for b in reversed(blocks)], axis=0))[::-1]
    left_c = np.sqrt(np.cumsum([(candidates[b] ** 2).sum(axis=0) for b in reversed(blocks)], axis=0))[::-1]
    least = least.astype(np.float64)
    score = np.zeros(other.shape)
    q = c = None
    for at, b in enumerate(blocks):
        if q is None:
            score += queries[:, b] @ candidates[b]
        else:
            score += np.einsum("ij,ji->i", queries[q[:, None], b], candidates[b][:, c])
        last = at + 1 == len(blocks)
        if q is None:
            # the bounds allow for rounding; sums themselves are whole
            rest = 0.0 if last else left_q[at + 1][:, None] * left_c[at + 1][None, :] * (1 + 1e-9) + 0.5
            if own.size >= k:
                lower = np.where(other, score - rest, -np.inf)
                least = np.maximum(least, np.partition(lower, -k, axis=1)[:, -k])
            alive = other & (score + rest >= least[:, None])
            if last or alive.mean() <= options.few:
                q, c = np.nonzero(alive)
                score = score[q, c]
        else:
            rest = 0.0 if last else left_q[at + 1][q] * left_c[at + 1][c] * (1 + 1e-9) + 0.5
            order = np.lexsort((rest - score, q))
            first = np.searchsorted(q[order], np.arange(len(queries) + 1))
            full = np.flatnonzero(np.diff(first) >= k)
            least[full] = np.maximum(least[full], (score - rest)[order[first[full] + k - 1]])
            alive = score + rest >= least[q]
            q, c, score = q[alive], c[alive], score[alive]
    return q, c, score.astype(np.int64)


class Nearest:
    """A block of queries and their k best so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, options: SearchOptions):
        self.ids, self.vectors, self.k, self.options = ids, vectors, k, options
        self.q, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(ids), np.iinfo(np.int64).min)

    def meet(self, own: np.ndarray, candidates: np.ndarray) -> None:
        """Candidates as dimensions x rows."""
        step = max(1, self.options.pairs // max(1, len(own)))
        parts = [(self.q, self.id, self.score)]
        for a in range(0, len(self.ids), step):
            q, c, score = survivors(self.vectors[a : a + step], self.ids[a : a + step], candidates, own, self.least[a : a + step], self.k, self.options)
            parts.append((q + a, own[c], score))
        q, i, score = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((i, -score, q))
        q, i, score = q[order], i[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < self.k
        self.least[q[place == self.k - 1]] = score[place == self.k - 1]
        self.q, self.id, self.score = q[kept], i[kept], score[kept]

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.q]), pa.array(self.id), pa.array(self.score)], names=["query_id", "vec_id", "score"])


def _searching(k: int, scale: float, options: SearchOptions):
    """A worker of ``mapInArrow``: rows come by group, in each the queries before the candidates."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, nearest = None, [], None
        for batch in batches:
            names = batch.schema.names
            groups, sides, ids = (np.asarray(batch.column(names.index(c))) for c in ("group", "candidate", "id"))
            sizes = np.asarray(batch.column(names.index("size")))
            column = batch.column(names.index("vec"))
            border = np.flatnonzero(np.concatenate(([True], (groups[1:] != groups[:-1]) | (sides[1:] != sides[:-1]) | (sizes[1:] != sizes[:-1]), [True])))
            for a, b in zip(border[:-1].tolist(), border[1:].tolist()):
                key = (int(groups[a]), int(sizes[a]))
                if key != group:
                    if nearest:
                        yield nearest.found()
                    group, held, nearest = key, [], None
                vectors = whole(column.slice(a, b - a), int(sizes[a]), scale)
                if not sides[a]:
                    held.append((ids[a:b], vectors))
                elif held or nearest:
                    if nearest is None:
                        nearest = Nearest(*(np.concatenate(x) for x in zip(*held)), k, options)
                        held = []
                    nearest.meet(ids[a:b], np.ascontiguousarray(vectors.T))
        if nearest:
            yield nearest.found()

    return work


def search(df: DataFrame, is_query, k: int, row_id: str = "vec_id", vector: str = "embedding", scale: float = 1.0, options: SearchOptions = SearchOptions()) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k rows whose vectors, times ``scale`` and rounded
    down, have the greatest inner product with those of each row that is a query."""
    marked = df.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("vec"), is_query.alias("q"))
    fit = F.forall("vec", lambda x: x.isNotNull() & (x.cast("double") * scale - x.cast("double") * scale == 0))
    marked = marked.where(F.col("id").isNotNull() & (F.size("vec") > 0) & fit)
    vectors = materialize(marked.groupBy("id").agg(F.min("vec").alias("vec"), F.max("q").alias("q")), "vectors")
    rows, asked = vectors.agg(F.count(F.lit(1)), F.count_if("q")).first()
    tasks = 2 * partitions(df)
    blocks = max(1, -(-asked // options.queries))
    slices = max(1, min(-(-tasks // blocks), -(-rows // options.least_rows)), -(-rows // options.slice_rows))

    def dealt(side: DataFrame, own: int, others: int, as_candidate: bool) -> DataFrame:
        place = F.pmod(F.xxhash64("id", F.lit(as_candidate)), F.lit(own))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        pair = side.select("id", "vec", place.alias("own"), every.alias("other"))
        block, part = ("other", "own") if as_candidate else ("own", "other")
        number = (F.col(block) * slices + F.col(part)).alias("group")
        return pair.select(number, F.size("vec").alias("size"), F.lit(as_candidate).alias("candidate"), "id", "vec")

    both = dealt(vectors.where("q"), blocks, slices, False).unionByName(dealt(vectors, slices, blocks, True))
    groups = both.repartition(tasks, "group").sortWithinPartitions("group", "size", "candidate")
    found = groups.mapInArrow(_searching(k, scale, options), "query_id bigint, vec_id bigint, score bigint")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
