"""Self-join of documents on the Jaccard similarity of their word shingles: a grouped prefix join.

A set's shingles stand in one global order: rare ones by hash, then the frequent ones by frequency.  Two sets can only be
similar if they share a shingle among the first few of each.  Equal sets are one class; classes with equal prefix and size
are one group; only a document for each group sends its prefix to the join.  There the lists of a shingle are filtered by
size and position, group pairs that are left are expanded to their members, and members are verified: by sketches that
bound what they have in common, then on their whole sets.  That is done in three rounds, each of which only looks at pairs
that are not of one component yet: every group meets the one of its lists that agrees with it the longest; then those that
stand near it in its lists; then all others, which only long lists of several components still have.  So a large group of
near copies is joined without making all its pairs.  Groups meet by their heads at first, by all their members at last.

The order only decides the speed, so the frequent shingles, at most ``FREQUENT`` of them, are found by counts that leave
out what is rare within a block of rows.  A shingle or a group that more than ``BLOCK`` sets share is dealt out as pairs
of blocks, by its count among the frequent ones or else by the counted length of its list, so no task gets all of it.  Links become components by rounds of label exchange; copies are never expanded.

Defined results: null, empty and blank texts have no shingles and link with nothing; fewer words than a shingle are one
shingle; rows of equal id are one document; rows with a null id get the component of an equal set, if there is one, else
null.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.llm.arrays import SMALL_CHUNK_BYTES, mix, run_hashes, runs, text_chunks
from tidetable.llm.common import partitions
from tidetable.session import broadcast_if_small, materialize

#: Bounds on the frequent shingles that all tasks know, and on the sets that one task compares at once.
FREQUENT, BLOCK = 100_000, 4096
#: Rows of a list that all others of it meet first, places on either side that a row meets next, and the size of the
#: filter of the documents to verify.
PIVOTS, WINDOW, FILTER_BITS = 2, 8, 1 << 26
#: Shingles that are counted at once, and how often one must occur among them to be passed on.
_COUNTED, _OFTEN = 1 << 21, 3
_U = np.uint64


@dataclass(frozen=True)
class Measure:
    """Words of a shingle, and the least similarity in hundredths."""

    words: int
    percent: int

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The least overlap of similar sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))


def shingle_sets(points: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document in rising order, and the documents' bounds among them."""
    rows = len(offsets) - 1
    points = np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)
    starts, ends, owner = runs(~((points == 32) | ((points >= 9) & (points <= 13))), offsets)
    hashes = run_hashes(points, starts, ends)
    counts = np.bincount(owner, minlength=rows)
    n = len(hashes)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    # a document of fewer words is hashed as far as it goes; other shingles must end within their document
    size = np.minimum(counts, words)[owner] if n else np.zeros(0, np.int64)
    inside = np.arange(n) - first[owner] if n else np.zeros(0, np.int64)
    valid = (inside + size <= counts[owner]) if n else np.zeros(0, bool)
    h = size.astype(_U)
    for k in range(words):
        part = np.zeros(n, _U)
        part[: max(0, n - k)] = hashes[k:]
        h = np.where(size > k, mix(h * _U(0x9E3779B97F4A7C15) + part), h)
    h, owner = h[valid], owner[valid]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))
        h, owner = h[fresh], owner[fresh]
    return h, np.searchsorted(owner, np.arange(rows + 1))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.names.index(name))


@dataclass(frozen=True)
class Frequent:
    """Hashes of frequent shingles in rising order, their places by frequency, and the counts by place."""

    hashes: np.ndarray
    places: np.ndarray
    counts: np.ndarray

    def place(self, h: np.ndarray) -> np.ndarray:
        """The place of each shingle, the most frequent last; -1 for others."""
        out = np.full(len(h), -1, np.int64)
        if len(self.hashes) and len(h):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            out[hit] = self.places[at[hit]]
        return out


def _frequent(docs: DataFrame, measure: Measure) -> Frequent:

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= _OFTEN
            return pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often])], names=["h", "n"])

        for batch in batches:
            for _, _, points, offsets in text_chunks(_column(batch, "_text"), SMALL_CHUNK_BYTES):
                h, _ = shingle_sets(points, offsets, measure.words)
                held.append(h)
                size += len(h)
                if size >= _COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    found = docs.select("_text").mapInArrow(work, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    hashes, counts = (np.asarray(top.column(c).combine_chunks())[::-1].copy() for c in ("h", "n"))
    order = np.argsort(hashes.view(_U))
    return Frequent(hashes.view(_U)[order], order, counts)


def _ordered(h: np.ndarray, bounds: np.ndarray, frequent: Frequent) -> np.ndarray:
    """The sets in the global order."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return h[np.lexsort((frequent.place(h), owner))]  # stable: those without a place keep the order of their hashes


def _sketch(h: np.ndarray) -> bytes:
    """How many shingles begin with each bit pattern, a byte for about two shingles; 255 stands for that and more."""
    bits = min(16, max(5, (len(h) // 2).bit_length()))
    return np.minimum(np.bincount((h >> _U(64 - bits)).astype(np.intp), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _plausible(a: bytes, b: bytes, least: int) -> bool:
    """Whether sets of these sketches can have ``least`` shingles in common."""
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    if x.max() == 255 or y.max() == 255:
        return True
    size = min(len(x), len(y))
    return int(np.minimum(x.reshape(size, -1).sum(axis=1), y.reshape(size, -1).sum(axis=1)).sum()) >= least


def _profiles(docs: DataFrame, measure: Measure, frequent: Frequent) -> DataFrame:
    """Size, class and group keys, prefix and sketch of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, points, offsets in text_chunks(_column(batch, "_text"), SMALL_CHUNK_BYTES):
                h, bounds = shingle_sets(points, offsets, measure.words)
                ordered = _ordered(h, bounds, frequent)
                n = np.diff(bounds)
                length = np.where(n > 0, measure.prefix(n), 0)
                sets = [h[i:j].tobytes() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                prefixes = [ordered[i : i + k].tobytes() for i, k in zip(bounds[:-1].tolist(), length.tolist())]
                digest = lambda x: hashlib.blake2b(x, digest_size=16).digest()
                columns = [
                    _column(batch, "_id").slice(a, b - a),
                    pa.array(n, pa.int64()),
                    pa.array([digest(x) if x else None for x in sets], pa.binary()),
                    pa.array([digest(x + m.to_bytes(8, "little")) if x else None for x, m in zip(prefixes, n.tolist())], pa.binary()),
                    pa.array(prefixes, pa.binary()),
                    pa.array([_sketch(h[i:j]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "class_key", "group_key", "prefix", "sketch"])

    return docs.mapInArrow(work, "id bigint, n bigint, class_key binary, group_key binary, prefix binary, sketch binary")


def _postings(groups: DataFrame, frequent: Frequent) -> DataFrame:
    """A row for each prefix shingle of each group; those of very frequent shingles are dealt to pairs of blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = (np.asarray(_column(batch, c)) for c in ("id", "n"))
            prefixes = _column(batch, "prefix").to_pylist()
            for at in range(0, len(ids), 2048):
                part = [np.frombuffer(x, _U) for x in prefixes[at : at + 2048]]
                sizes = np.array([len(x) for x in part])
                h = np.concatenate(part)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                pos = np.arange(len(h)) - np.repeat(bounds[:-1], sizes)
                who, size = (np.repeat(x[at : at + 2048], sizes) for x in (ids, n))
                place = frequent.place(h)
                before = np.where((place >= 0) & (pos > 0), np.concatenate(([_U(0)], h[:-1])), _U(0))
                blocks = np.where(place >= 0, -(-frequent.counts[place] // BLOCK), 1) if len(frequent.counts) else np.ones(len(h), np.int64)
                # a row of block b meets every block j in the list (h, least, greatest of both)
                row = np.repeat(np.arange(len(h)), blocks)
                other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                own = (mix(who[row].view(_U)) % blocks[row].astype(_U)).astype(np.int64)
                low, high = np.minimum(own, other), np.maximum(own, other)
                key = np.where(blocks[row] > 1, mix(h[row] + mix((low * 65536 + high + 1).astype(_U))), h[row])
                columns = {"key": key.view(np.int64), "id": who[row], "n": size[row].astype(np.int32), "pos": pos[row].astype(np.int32), "before": before[row].view(np.int64), "side": ((own > other) | (own == other)).astype(np.int8) + (own == other)}
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))

    return groups.mapInArrow(work, "key bigint, id bigint, n int, pos int, before bigint, side tinyint")


@dataclass(frozen=True)
class Lists:
    """Rows of whole lists, sorted by size within a list: columns of equal length, and the borders of the lists."""

    n: np.ndarray
    pos: np.ndarray
    before: np.ndarray
    side: np.ndarray
    label: np.ndarray
    apart: np.ndarray
    borders: np.ndarray

    def number(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.borders) - 1), np.diff(self.borders))


def _passes(x: Lists, i, j: np.ndarray, measure: Measure) -> np.ndarray:
    """Which rows j may be similar to row i of the same list: by size, by what is left of both sets, and not yet joined.

    Sides: 2 where both are of one block, else 0 and 1, of which only unlike ones meet.  If the shingle before is the same
    in both, the pair has met there.  Groups that stand ``apart`` have no label, so no pair with one counts as joined.
    """
    need = measure.overlap(x.n[i], x.n[j])
    least, most = np.minimum(x.n[i], x.n[j]), np.maximum(x.n[i], x.n[j])
    ok = (100 * least >= measure.percent * most) & (x.n[i] - x.pos[i] >= need) & (x.n[j] - x.pos[j] >= need)
    ok &= (x.label[i] != x.label[j]) | ((x.apart[i] | x.apart[j]) > 0)
    return ok & ((x.before[j] != x.before[i]) | (x.before[i] == 0)) & ((x.side[i] == 2) | (x.side[j] != x.side[i]))


Pairs = Iterator[tuple[np.ndarray, np.ndarray]]


def _pivot_pairs(x: Lists, measure: Measure) -> Pairs:
    """Index pairs with the rows of each list that stand in it with the most behind them, the pivot first.

    Where such a row is too small or too large for others, those have pivots of their own.
    """
    rest, number = np.arange(len(x.n)), x.number()
    while len(rest):
        order = rest[np.lexsort((rest, x.pos[rest], number[rest]))]
        first = np.flatnonzero(np.diff(number[order], prepend=-1))
        size = np.diff(np.append(first, len(order)))
        start = np.repeat(first, size)  # where the list of a row begins
        for k in range(PIVOTS):
            some = np.flatnonzero((np.repeat(size, size) > k) & (np.arange(len(order)) != start + k))
            i, j = order[start[some] + k], order[some]
            ok = _passes(x, i, j, measure)
            yield i[ok], j[ok]
        # sizes that the first pivot can meet; the others of these rows have been served by it
        pivot = order[start]
        far = 100 * np.minimum(x.n[order], x.n[pivot]) < measure.percent * np.maximum(x.n[order], x.n[pivot])
        rest = np.sort(order[far])


def _window_pairs(x: Lists, measure: Measure) -> Pairs:
    """Index pairs of the rows that stand at most ``WINDOW`` places apart in a list."""
    number = x.number()
    for k in range(1, WINDOW + 1):
        i = np.flatnonzero(number[k:] == number[:-k])
        ok = _passes(x, i, i + k, measure)
        yield i[ok], i[ok] + k


def _far_pairs(x: Lists, measure: Measure) -> Pairs:
    """Index pairs of the rows that stand more than ``WINDOW`` places apart in a list."""
    for a, b in zip(x.borders[:-1].tolist(), x.borders[1:].tolist()):
        if (x.label[a:b] == x.label[a]).all() and not x.apart[a:b].any():
            continue
        stops = a + np.searchsorted(x.n[a:b], 100 * x.n[a:b] // measure.percent, side="right")
        for i in range(a, b - WINDOW - 1):
            j = np.arange(i + WINDOW + 1, stops[i - a])
            if len(j) and (ok := _passes(x, i, j, measure)).any():
                yield np.full(int(ok.sum()), i), j[ok]


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Columns of whole lists, and the borders of the lists among them; rows come sorted by key."""
    held: list[np.ndarray] = []

    def cut(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        key = columns[0]
        return columns, np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))

    for batch in batches:
        if not batch.num_rows:
            continue
        now = [np.asarray(_column(batch, c)).astype(np.int64) for c in names]
        held = [np.concatenate(p) for p in zip(held, now)] if held else now
        # the last list may go on in the next batch
        at = int(np.searchsorted(held[0], held[0][-1], side="left"))
        if at:
            yield cut([c[:at] for c in held])
        held = [c[at:] for c in held]
    if held:
        yield cut(held)


_LIST = ("key", "n", "id", "pos", "before", "side")


def _lists(postings: DataFrame) -> DataFrame:
    """The lists of shingles that more than one group has, sorted by size within a list; a task holds no list whole."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row, which the next batch may share its key with
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
            key = np.asarray(_column(rows, "key"))
            same = key[1:] == key[:-1]
            shared = np.concatenate(([before is not None and key[0] == before], same)) | np.concatenate((same, [False]))
            yield _as_long(rows.slice(0, len(key) - 1), shared[:-1])
            before = int(key[-2]) if len(key) > 1 else before
            held = rows.slice(len(key) - 1)
        if held is not None:
            yield _as_long(held, np.array([before is not None and _column(held, "key")[0].as_py() == before]))

    dealt = postings.select(*_LIST).repartition(partitions(postings), "key").sortWithinPartitions("key", "n", "id", "pos")
    return dealt.mapInArrow(work, ", ".join(f"{c} bigint" for c in _LIST))


def _as_long(rows: pa.RecordBatch, kept: np.ndarray) -> pa.RecordBatch:
    rows = rows.filter(pa.array(kept, pa.bool_()))
    return pa.RecordBatch.from_arrays([_column(rows, c).cast(pa.int64()) for c in _LIST], names=list(_LIST))


def _split_long(lists: DataFrame) -> DataFrame:
    """Lists by their counted length: one of more than ``2 * BLOCK`` rows is dealt out as pairs of blocks.

    A list in which all meet becomes the pairs of its blocks; one whose two sides meet, the blocks of each.
    """
    long = lists.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 2 * BLOCK)
    long = materialize(long.select("key", F.ceil(F.col("_n") / BLOCK).alias("_blocks")), "long")
    if not long.limit(1).count():
        return lists
    rows = lists.join(broadcast_if_small(long), "key", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    sided = F.col("side") != 2
    low = F.when(sided, F.when(F.col("side") == 0, F.col("_own")).otherwise(F.col("_other"))).otherwise(F.least("_own", "_other"))
    high = F.when(sided, F.when(F.col("side") == 0, F.col("_other")).otherwise(F.col("_own"))).otherwise(F.greatest("_own", "_other"))
    side = F.when(sided | (F.col("_own") == F.col("_other")), F.col("side")).otherwise((F.col("_own") > F.col("_other")).cast("long"))
    key = F.when(F.col("_blocks") > 1, F.xxhash64("key", low, high)).otherwise(F.col("key"))
    return rows.select(key.alias("key"), "n", "id", "pos", "before", side.alias("side"))


def _candidates(lists: DataFrame, measure: Measure, meet, labels: DataFrame | None = None) -> DataFrame:
    """Distinct pairs of groups that share a prefix shingle, pass the filters and ``meet`` each other.

    In the round of the pivots (without ``labels``) each group meets only one other, which most of its lists name.  With
    ``labels`` (id, label), the components so far, pairs of one component are left out; a null label is of none, nor can
    it be told by any id, as the head of a group may itself name a component.
    """
    names, ordered = (*_LIST, "label", "apart"), labels is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: np.ndarray, x: list[np.ndarray], y: list[np.ndarray]) -> pa.RecordBatch:
            p, q = ids[np.concatenate(x)], ids[np.concatenate(y)]
            if ordered:
                p, q = np.minimum(p, q), np.maximum(p, q)
            pairs, times = np.unique(np.stack((p, q))[:, p != q], axis=1, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(times)], names=["a", "b", "times"])

        for (_, n, ids, *columns), borders in _runs(batches, names):
            x, y, size = [], [], 0
            for i, j in meet(Lists(n, *columns, borders), measure):
                x.append(i)
                y.append(j)
                size += len(i)
                if size > 1 << 16:
                    yield found(ids, x, y)
                    x, y, size = [], [], 0
            if x:
                yield found(ids, x, y)

    if labels is None:
        rows = lists.withColumn("label", F.col("id")).withColumn("apart", F.lit(0))
    else:
        known = labels.select("id", "label", F.col("label").isNull().cast("int").alias("apart"))
        rows = lists.join(known, "id", "left").withColumn("label", F.coalesce("label", "id")).withColumn("apart", F.coalesce("apart", F.lit(0)))
    dealt = rows.select(*names).repartition(partitions(rows), "key").sortWithinPartitions("key", "n", "id", "pos")
    pairs = dealt.mapInArrow(work, "a bigint, b bigint, times bigint")
    if ordered:
        return pairs.select("a", "b").distinct()
    named = pairs.groupBy("a", "b").agg(F.sum("times").alias("times"))
    best = named.groupBy("b").agg(F.max_by("a", F.struct("times", -F.col("a"))).alias("a"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _members_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the column ``_id`` in 64-bit words, of at most ``FILTER_BITS`` bits whatever the number of ids.

    Tasks send the words they set, and equal words are joined before the driver gets them.
    """
    bits = 1 << 16
    count = ids.count()
    while bits < min(16 * count, FILTER_BITS):
        bits *= 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate([_places(np.asarray(batch.column(0)), bits, k) for k in range(3)])
            word, first = np.unique(places >> _U(6), return_inverse=True)
            value = np.zeros(len(word), _U)
            np.bitwise_or.at(value, first, _U(1) << (places & _U(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], names=["w", "v"])

    words = ids.select("_id").mapInArrow(work, "w bigint, v bigint").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[np.asarray(words.column("w").combine_chunks())] = np.asarray(words.column("v").combine_chunks())
    return out.view(_U)


def _places(ids: np.ndarray, bits: int, k: int) -> np.ndarray:
    return mix(ids.view(_U) + _U(0x632BE59BD9B4E019 * (k + 1) & (2**64 - 1))) % _U(bits)


def _sets(docs: DataFrame, measure: Measure, wanted: np.ndarray) -> DataFrame:
    """Packed sets of the documents that pass the filter ``wanted``; a join with the ids themselves drops the others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = 64 * len(wanted)
        for batch in batches:
            ids = np.asarray(_column(batch, "_id").fill_null(0))
            hit = np.ones(len(ids), bool)
            for k in range(3):
                place = _places(ids, bits, k)
                hit &= (wanted[(place >> _U(6)).astype(np.intp)] >> (place & _U(63)) & _U(1)).astype(bool)
            kept = batch.filter(pa.array(hit))
            for a, b, points, offsets in text_chunks(_column(kept, "_text"), SMALL_CHUNK_BYTES):
                h, bounds = shingle_sets(points, offsets, measure.words)
                sets = [h[i:j].tobytes() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([_column(kept, "_id").slice(a, b - a), pa.array(sets, pa.binary())], names=["id", "set"])

    return docs.mapInArrow(work, "id bigint, set binary")


def similar(a: bytes, b: bytes, measure: Measure) -> bool:
    """Whether two packed sets are similar, counted exactly."""
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    if not len(x) or not len(y):
        return False
    both = np.sort(np.concatenate((x, y)), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= measure.percent * (len(x) + len(y) - common)


def _sketched(pairs: DataFrame, profiles: DataFrame, measure: Measure) -> DataFrame:
    """The pairs whose sketches allow enough shingles in common; sketches are a sixteenth of the sets' size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need = measure.overlap(np.asarray(_column(batch, "n")), np.asarray(_column(batch, "m"))).tolist()
            ok = [_plausible(p.as_py(), q.as_py(), k) for p, q, k in zip(_column(batch, "p"), _column(batch, "q"), need)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    first = pairs.join(profiles.select(F.col("id").alias("a"), "n", F.col("sketch").alias("p")), "a")
    both = first.join(profiles.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("q")), "b")
    return both.mapInArrow(work, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, measure: Measure) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(p.as_py(), q.as_py(), measure) for p, q in zip(_column(batch, "p"), _column(batch, "q"))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    first = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("p")), "a")
    both = first.join(sets.select(F.col("id").alias("b"), F.col("set").alias("q")), "b").select("a", "b", "p", "q")
    return both.mapInArrow(work, "a bigint, b bigint").distinct()


def _within_groups(members: DataFrame, sets: DataFrame, measure: Measure) -> DataFrame:
    """Links that join the similar members of each group, a member being compared until it is joined.

    ``members`` (group_id, id, blocks) holds groups of several classes; large ones are dealt to pairs of blocks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []  # parts: joined members, each a list of (id, set, side)
        for batch in batches:
            out = []
            for k, i, side, own in zip(*(_column(batch, c).to_pylist() for c in ("key", "id", "side", "set"))):
                if k != key:
                    key, parts = k, []
                hits = []
                for part in parts:
                    hit = next((x for x, s, t in part if (side == 2 or t != side) and similar(s, own, measure)), None)
                    if hit is not None:
                        out.append((min(hit, i), max(hit, i)))
                        hits.append(part)
                merged = [x for part in hits for x in part] + [(i, own, side)]
                parts = [p for p in parts if not any(p is h for h in hits)] + [merged]
            out = [p for p in out if p[0] != p[1]]
            yield pa.RecordBatch.from_arrays([pa.array([p[x] for p in out], pa.int64()) for x in (0, 1)], names=["a", "b"])

    own = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("own")
    dealt = members.select("group_id", "id", own, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    key = F.concat_ws("/", "group_id", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") > F.col("other"), 1).otherwise(0).cast("int")
    rows = dealt.select(key.alias("key"), "id", side.alias("side")).join(sets, "id")
    sorted_rows = rows.repartition(partitions(rows), "key").sortWithinPartitions("key", "id")
    return sorted_rows.mapInArrow(work, "a bigint, b bigint").distinct()


def components(links: DataFrame, limit: int = 100) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id it is connected with.

    Each round gives an id the smallest label among its neighbours' and its own, then the label of that label; a round is
    written before the next one reads it.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both, "edges")
    labels = materialize(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(limit):
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(near, labels["id"] == near["a"]).select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        after = materialize(moved.join(jump, "label", "left").select("id", "was", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        changed = after.where("was <> label").limit(1).count()
        labels = after.select("id", "label")
        if not changed:
            return labels.select("id", F.col("label").alias("component"))
    raise RuntimeError("components did not settle")


def _group_labels(members: DataFrame, components_: DataFrame) -> DataFrame:
    """(id, label) of the groups that are joined: the component of a group's members, null where they are of several."""
    own = members.join(components_, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = own.groupBy(F.col("group_id").alias("id")).agg(F.when(F.min("component") == F.max("component"), F.min("component")).alias("label"))
    alone = components_.join(several, "id", "left_anti").select("id", F.col("component").alias("label"))
    return alone.unionByName(several)


def near_copies(df: DataFrame, measure: Measure, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``df``."""
    docs = df.select(F.col(row_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    frequent = _frequent(docs, measure)
    profiles = materialize(_profiles(docs, measure, frequent), "profiles")
    some = profiles.where(F.col("class_key").isNotNull() & F.col("id").isNotNull())
    classes = materialize(some.groupBy("class_key").agg(F.min("id").alias("rep"), F.first("group_key").alias("group_key"), F.count(F.lit(1)).alias("copies")), "classes")
    groups = materialize(classes.groupBy("group_key").agg(F.min("rep").alias("group_id"), F.count(F.lit(1)).alias("members")), "groups")
    heads = some.join(groups.select("group_key", F.col("group_id").alias("id")), ["group_key", "id"]).select("id", "n", "prefix")
    lists = _split_long(materialize(_lists(_postings(heads, frequent)), "lists"))
    several = groups.where("members > 1")
    members = classes.join(several, "group_key").select("group_id", F.col("rep").alias("id"), F.ceil(F.col("members") / BLOCK).alias("blocks"))
    members = materialize(members, "members")
    wide = members.select(F.col("group_id").alias("id")).distinct()

    def verified(candidates: DataFrame) -> DataFrame:
        """The pairs of documents that are similar."""
        pairs = materialize(_sketched(candidates, some, measure), "pairs")
        wanted = _members_filter(pairs.select(F.col("a").alias("_id")).union(pairs.select("b")))
        return _verified(pairs, materialize(_sets(docs, measure, wanted), "sets"), measure)

    def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs whose ids do not have one label; ids without any stand alone, null labels join nothing."""
        for side in ("a", "b"):
            own = labels.select(F.col("id").alias(side), F.col("label").alias(f"_{side}"), F.lit(True).alias(f"_in_{side}"))
            pairs = pairs.join(own, side, "left").withColumn(f"_{side}", F.when(F.col(f"_in_{side}"), F.col(f"_{side}")).otherwise(F.col(side)))
        apart = F.col("_a").isNull() | F.col("_b").isNull() | (F.col("_a") != F.col("_b"))
        return pairs.where(apart).select("a", "b")

    own = _sets(docs, measure, _members_filter(members.select(F.col("id").alias("_id"))))
    links = materialize(verified(_candidates(lists, measure, _pivot_pairs)).unionByName(_within_groups(members, own, measure)), "links")
    labels = materialize(_group_labels(members, components(links)), "labels")
    near = materialize(_candidates(lists, measure, _window_pairs, labels), "near")
    links = materialize(links.unionByName(verified(near)), "links")
    joined = components(links)
    labels = materialize(_group_labels(members, joined), "labels")
    far = _candidates(lists, measure, _far_pairs, labels)
    # heads have met; where a group has more members, these have not
    met = near.join(wide.withColumnRenamed("id", "a"), "a", "left_semi").unionByName(near.join(wide.withColumnRenamed("id", "b"), "b", "left_semi"))
    rest = across(far.unionByName(met).distinct(), labels)
    for side in ("a", "b"):
        others = members.select(F.col("group_id").alias(side), F.col("id").alias("_member"))
        rest = rest.join(others, side, "left").withColumn(side, F.coalesce("_member", side)).drop("_member")
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = across(rest.join(near, ["a", "b"], "left_anti"), joined.withColumnRenamed("component", "label"))
    named = components(materialize(links.unionByName(verified(rest)), "links"))
    copied = classes.where("copies > 1").select("class_key", "rep")
    rows = profiles.select("id", "n", "class_key").join(copied, "class_key", "left").withColumn("rep", F.coalesce("rep", "id"))
    rows = rows.join(named.select(F.col("id").alias("rep"), "component"), "rep", "left")
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
