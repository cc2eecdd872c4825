"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a balanced k-means over a bounded sample; every vector is indexed.  A vector goes to the posting list
of its nearest centroid, and boundary vectors also to further lists whose centroids are nearly as near, unless one already
chosen is nearer to that centroid.  Those centroids are searched by a best-first walk over an in-memory neighbour graph.
A query reads all lists whose centroids are at most a ratio farther than its nearest one, however many these are.  Lists and their queries are dealt out
in blocks, so a list that holds a third of all vectors is many groups.  Each group returns its nearest for each query;
the first ``min_lists`` lists of a query show how near is enough, and groups of its other lists return nothing worse.

Scores are cosines in double precision on the original vectors; the selection within a group allows for rounding, and the
scores that are returned are summed in one fixed order, so equal vectors tie exactly and the smaller id wins.

Defined results: vectors that are null, zero, of another length than most of the sample, or that hold null or non-finite
components take no part, nor do rows without an id; a query never finds its own id; a table of fewer rows than ``min_lists``
lists is searched whole; an empty table gives no rows.
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
class IndexOptions:
    """Bounds and ratios: sampled rows, centroids, rows of a list, replicas, least lists of a query, rows of a block."""

    sample: int = 16_384
    centroids: int = 4096
    list_rows: int = 64
    replicas: int = 4
    boundary: float = 0.10
    min_lists: int = 16
    ratio: float = 0.28
    block: int = 4096


@dataclass(frozen=True)
class Centroids:
    points: np.ndarray  # unit length
    graph: np.ndarray  # the neighbours of all centroids, one behind the other
    bounds: np.ndarray  # where those of each centroid begin
    doors: np.ndarray  # where walks begin
    apart: np.ndarray  # distances of the centroids from each other

    def walk(self, vectors: np.ndarray, ratio: float, least: int, together: int = 32) -> np.ndarray:
        """Cosine of each unit vector with the centroids that its walk meets, -inf for others.

        A walk opens the nearest centroid that it has met and not opened yet, and meets that one's neighbours.  It ends
        when this one is more than ``1 + ratio`` times as far as the nearest, and ``least`` others are nearer than it.
        Several are opened at a time, so it may meet a few more.
        """
        rows, n = len(vectors), len(self.points)
        cosine, shut = np.full((rows, n), -np.inf), np.zeros((rows, n), bool)
        met = vectors @ self.points[self.doors].T
        cosine[:, self.doors] = met
        active = np.arange(rows)
        while len(active):
            waiting = np.where(shut[active], -np.inf, cosine[active])
            width = min(together, n)
            at = np.argpartition(-waiting, width - 1, axis=1)[:, :width]
            value = np.take_along_axis(waiting, at, 1)
            near = np.sqrt(np.maximum(0, 2 - 2 * cosine[active].max(axis=1)))
            reach = 1 - ((1 + ratio) * near) ** 2 / 2
            enough = np.partition(cosine[active], n - min(least, n), axis=1)[:, n - min(least, n)]
            go = np.isfinite(value) & (value >= np.minimum(reach, enough)[:, None])
            row, place = np.nonzero(go)
            row, here = active[row], at[row, place]
            shut[row, here] = True
            sizes = self.bounds[here + 1] - self.bounds[here]
            beside = self.graph[np.repeat(self.bounds[here] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
            pair = np.unique(np.repeat(row, sizes) * n + beside)
            row, beside = np.divmod(pair, n)
            fresh = np.isneginf(cosine[row, beside])
            row, beside = row[fresh], beside[fresh]
            cosine[row, beside] = np.einsum("ij,ij->i", vectors[row], self.points[beside])
            active = active[go.any(axis=1)]
        return cosine

    def lists_of(self, vectors: np.ndarray, options: IndexOptions) -> list[np.ndarray]:
        """The lists that hold each vector: the nearest, and boundary ones that no chosen one covers."""
        cosine = self.walk(vectors, options.boundary, 4 * options.replicas)
        width = min(4 * options.replicas, cosine.shape[1])
        ids = np.argsort(-cosine, axis=1, kind="stable")[:, :width]
        distance = np.sqrt(np.maximum(0, 2 - 2 * np.maximum(np.take_along_axis(cosine, ids, 1), -2.0)))
        out = []
        for own, d in zip(ids, distance):
            chosen = [own[0]]
            for c, far in zip(own[1:], d[1:]):
                if far > (1 + options.boundary) * d[0] or len(chosen) == options.replicas:
                    break
                if all(self.apart[c, x] >= 0.6 * far for x in chosen):
                    chosen.append(c)
            out.append(np.array(chosen))
        return out

    def lists_for(self, queries: np.ndarray, options: IndexOptions) -> list[np.ndarray]:
        """The lists that each query reads, nearest first: those within the ratio of distances, and the least number."""
        cosine = self.walk(queries, options.ratio, options.min_lists)
        order = np.argsort(-cosine, axis=1, kind="stable")
        ordered = np.take_along_axis(cosine, order, 1)
        distance = np.sqrt(np.maximum(0, 2 - 2 * np.maximum(ordered, -2.0)))
        keep = (distance <= (1 + options.ratio) * distance[:, :1]) | (np.arange(order.shape[1]) < options.min_lists)
        return [own[k] for own, k in zip(order, keep & np.isfinite(ordered))]


def unit_rows(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the rows that take part, their vectors in double precision, not normalised)."""
    rows, vectors = [], []
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    size = size or (int(np.bincount(lengths).argmax()) if len(lengths) else 0)
    values = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
    ends = np.cumsum(lengths)
    good = np.flatnonzero(lengths == size) if size else np.zeros(0, np.int64)
    for a in range(0, len(good), 4096):
        own = good[a : a + 4096]
        block = values[(ends[own] - size)[:, None] + np.arange(size)]
        fit = np.isfinite(block).all(axis=1) & (block != 0).any(axis=1)
        rows.append(own[fit])
        vectors.append(block[fit])
    return (np.concatenate(rows), np.concatenate(vectors)) if rows else (np.zeros(0, np.int64), np.zeros((0, size)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True, initial=1e-300)
    vectors = vectors / scale
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def balanced_centroids(sample: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """k-means on the sphere in which crowded centroids look farther; an empty one takes half of the largest."""
    rng = np.random.default_rng(seed)
    points = sample[np.sort(rng.choice(len(sample), k, replace=False))].copy()
    size = np.full(k, len(sample) / k)
    for _ in range(rounds):
        owner = np.empty(len(sample), np.int64)
        for a in range(0, len(sample), 4096):
            owner[a : a + 4096] = (sample[a : a + 4096] @ points.T - 0.02 * size * k / len(sample)).argmax(axis=1)
        size = np.bincount(owner, minlength=k).astype(float)
        sums = np.zeros_like(points)
        np.add.at(sums, owner, sample)
        for c in np.flatnonzero(size == 0):
            big = int(size.argmax())
            half = np.flatnonzero(owner == big)[::2]
            owner[half] = c
            sums[c] = sample[half].sum(axis=0)
            sums[big] -= sums[c]
            size[c], size[big] = len(half), size[big] - len(half)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        points = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), points)
    return points


def centroid_graph(points: np.ndarray, degree: int = 16, seed: int = 3) -> Centroids:
    """Each centroid beside its nearest ones and beside those that it is among the nearest of; a cycle through all lets
    every walk reach everything."""
    n = len(points)
    rng = np.random.default_rng(seed)
    near = points @ points.T
    apart = np.sqrt(np.maximum(0, 2 - 2 * near))
    np.fill_diagonal(near, -np.inf)
    beside = np.argsort(-near, axis=1, kind="stable")[:, : min(degree, n - 1)]
    cycle = rng.permutation(n)
    a = np.concatenate((np.repeat(np.arange(n), beside.shape[1]), cycle))
    b = np.concatenate((beside.ravel(), np.roll(cycle, 1)))
    edges = np.unique(np.concatenate((a * n + b, b * n + a)))
    a, b = np.divmod(edges, n)
    doors = np.sort(rng.choice(n, min(n, 2 * int(np.ceil(n**0.5))), replace=False))
    return Centroids(points, b, np.searchsorted(a, np.arange(n + 1)), doors, apart)


def fit(vectors: DataFrame, options: IndexOptions) -> tuple[Centroids | None, int]:
    """Centroids of a sample of (id, vec) whose size the options bound, and the vectors' length."""
    n = vectors.count()
    # copies of a row are in the sample together, and one of them is enough
    rows = vectors.withColumn("_hash", F.xxhash64("id", "vec"))
    rows = rows.where(F.pmod("_hash", F.lit(1 << 30)) < F.lit(float(1 << 30)) * min(1.0, options.sample / max(1, n)))
    got = rows.groupBy("_hash").agg(F.first("vec").alias("vec")).select("vec").toArrow().column("vec").combine_chunks()
    _, sample = unit_rows(got)
    if not len(sample):
        return None, 0
    # the order of collected rows is not fixed
    sample = _unit(sample[np.lexsort(sample.T[::-1])])
    k = max(1, min(options.centroids, n // options.list_rows, len(sample) // 4))
    return centroid_graph(balanced_centroids(sample, k)), sample.shape[1]


def _placed(vectors: DataFrame, centroids: Centroids, size: int, options: IndexOptions, as_query: bool) -> DataFrame:
    """(list, place, id, vec) of each vector's lists, or of those that it reads as a query, nearest first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                ids, column = (part.column(part.schema.names.index(c)) for c in ("id", "vec"))
                rows, found = unit_rows(column, size)
                if not len(rows):
                    continue
                lists = (centroids.lists_for if as_query else centroids.lists_of)(_unit(found), options)
                repeat = pa.array(np.repeat(rows, [len(x) for x in lists]))
                place = np.concatenate([np.arange(len(x), dtype=np.int32) for x in lists])
                arrays = [pa.array(np.concatenate(lists).astype(np.int32)), pa.array(place), ids.take(repeat), column.take(repeat)]
                yield pa.RecordBatch.from_arrays(arrays, names=["list", "place", "id", "vec"])

    return vectors.mapInArrow(work, f"list int, place int, id bigint, vec {vectors.schema['vec'].dataType.simpleString()}")


def _nearest(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """The k nearest of a block's vectors for each of its queries."""
    q_rows, q = unit_rows(queries.column("vec").combine_chunks())
    v_rows, v = unit_rows(vectors.column("vec").combine_chunks())
    q_ids = np.asarray(queries.column("id").combine_chunks())[q_rows] if len(q_rows) else np.zeros(0, np.int64)
    v_ids = np.asarray(vectors.column("id").combine_chunks())[v_rows] if len(v_rows) else np.zeros(0, np.int64)
    enough = np.asarray(queries.column("least").combine_chunks())[q_rows] if len(q_rows) else np.zeros(0)
    out_q, out_v, out_s = [], [], []
    norms = np.sqrt((v * v).sum(axis=1))
    for i in range(len(q_ids)):
        own = v_ids != q_ids[i]
        length = np.sqrt((q[i] * q[i]).sum())
        rough = np.where(own, v @ q[i] / (norms * length), -np.inf)
        if not own.any():
            continue
        least = np.partition(rough, -min(k, len(rough)))[-min(k, len(rough))]
        at = np.flatnonzero(own & (rough >= max(least - 1e-9, enough[i])))
        exact = (v[at] * q[i]).sum(axis=1) / (norms[at] * length)
        best = np.lexsort((v_ids[at], -exact))
        # copies of an id count once
        _, first = np.unique(v_ids[at][best], return_index=True)
        best = best[np.sort(first)][:k]
        out_q += [q_ids[i]] * len(best)
        out_v += v_ids[at][best].tolist()
        out_s += exact[best].tolist()
    return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})


def search(df: DataFrame, is_query, k: int, row_id: str = "vec_id", vector: str = "embedding", options: IndexOptions = IndexOptions()) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k nearest found for each row that is a query."""
    marked = df.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("vec"), is_query.alias("q")).where(F.col("id").isNotNull() & F.col("vec").isNotNull())
    vectors = marked.select("id", "vec")
    centroids, size = fit(vectors, options)
    spark = df.sparkSession
    if centroids is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    postings = materialize(_placed(vectors, centroids, size, options, False), "postings")
    asked = materialize(_placed(marked.where("q").select("id", "vec"), centroids, size, options, True), "asked")
    # as many counts as lists
    counts = {c: {r["list"]: r["count"] for r in t.groupBy("list").count().collect()} for c, t in (("v", postings), ("q", asked))}
    blocks = {c: [-(-counts[c].get(x, 0) // options.block) or 1 for x in range(len(centroids.points))] for c in counts}

    def dealt(t: DataFrame, own: str, other: str) -> DataFrame:
        n_own, n_other = (F.get(F.array(*map(F.lit, blocks[c])), F.col("list")) for c in (own, other))
        block = F.pmod(F.xxhash64("id", F.lit(own)), n_own).cast("int")
        spread = t.withColumn(f"{own}b", block).withColumn(f"{other}b", F.explode(F.sequence(F.lit(0), n_other - 1)))
        return spread.select("list", "vb", "qb", "id", "vec", "least")

    keys = ["list", "vb", "qb"]
    stored = dealt(postings.withColumn("least", F.lit(-2.0)), "v", "q")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def near(part: DataFrame) -> DataFrame:
        both = dealt(part, "q", "v").groupBy(*keys).cogroup(stored.groupBy(*keys))
        return both.applyInArrow(lambda q, v: _nearest(q, v, k), "query_id bigint, vec_id bigint, score double")

    def top(found: DataFrame) -> DataFrame:
        rows = found.repartition(partitions(df), "query_id").dropDuplicates(["query_id", "vec_id"])
        return rows.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)

    first = materialize(near(asked.where(F.col("place") < options.min_lists).withColumn("least", F.lit(-2.0))), "near")
    enough = top(first).where(F.col("rank") == k).select(F.col("query_id").alias("id"), (F.col("score") - 1e-9).alias("least"))
    rest = asked.where(F.col("place") >= options.min_lists).join(enough, "id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
    return top(first.unionByName(near(rest))).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
