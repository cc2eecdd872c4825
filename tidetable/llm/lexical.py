"""Ranked lexical search: posting lists with range-maximum sparse tables, searched best first by document intervals.

An index row holds a document's term count, the terms that queries ask for and how often it has them.  A task takes its
rows in blocks, sorts a block by document and turns it into posting lists with the impact of each posting.  A sparse table
for each list names the posting of the greatest impact in any range.  For one query the block is an interval; the greatest
impacts of its lists within an interval, summed, bound the score of every document there.  Intervals are taken by falling
bound.  One is split at the document of the greatest impact of a list, which is scored; of the lists that one is chosen
whose document lies nearest to the middle (the middle itself if all lie near an end), so splits stay even.  Short intervals
are scored whole.  An interval is dropped if its bound cannot beat the documents found, in this block or in earlier ones of the task.

Scores are integers.  Document counts come from the same index rows, so the texts are read once.  Queries are taken in
blocks of at most ``Limits.terms`` different terms, whatever their number; each block is a pass of its own.  A term is known by a 64-bit hash of its bytes.

Defined results: null, empty and term-less texts are no documents and match nothing; every row is a document of its own,
and every query row a query of its own, so a repeated query id has rows for each; rows without an id rank behind equal scores.  Only the
id and text columns of both tables are read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidetable.llm.arrays import CHUNK_BYTES, run_hashes, runs
from tidetable.session import materialize

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_U = np.uint64
#: Whether a byte of UTF-8 belongs to a term, and its lower case.
_IN_TERM = np.array([TERM.fullmatch(bytes([b])) is not None for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Limits:
    """Different terms of a block of queries, documents and postings of a block of the index, documents of a whole-scored interval."""

    terms: int = 100_000
    documents: int = 16_384
    postings: int = 1_000_000
    leaf: int = 512


@dataclass(frozen=True)
class Corpus:
    """Documents with terms, all their terms, and how many documents hold each asked term."""

    documents: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(df) + 1))) for df in self.holding], np.int64)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """A document's length in hundredths of the mean, damped to three quarters."""
        if len(n) and 75 * int(n.max()) * self.documents < 1 << 63:
            return 25 + 75 * n * self.documents // self.terms
        return np.array([25 + 75 * int(x) * self.documents // self.terms for x in n], np.int64)


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode().translate(_LOWER.tobytes()))


def _hashes(terms: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(terms), np.uint8)
    ends = np.cumsum([len(t) for t in terms])
    return run_hashes(data, ends - [len(t) for t in terms], ends)


def _byte_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, lower-case bytes, offsets) of chunks of whole texts; null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + column.offset + 1)[column.offset :] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = min(n, max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1))
        yield row, end, _LOWER[data[offsets[row] : offsets[end]]], offsets[row : end + 1] - offsets[row]
        row = end


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    limits = pa.py_buffer((bounds * 4).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, limits, pa.py_buffer(values.astype("<i4").tobytes())])


def index(docs: DataFrame, terms: list[bytes], row_id: str, text: str) -> DataFrame:
    """``id``, ``n`` and the packed ``terms`` (places in ``terms``) and ``times`` of every document that has a term."""
    known = _hashes(terms)
    order = np.argsort(known, kind="stable")
    known = known[order]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = (batch.column(batch.schema.names.index(c)) for c in ("_id", "_text"))
            for a, b, data, offsets in _byte_chunks(column):
                starts, ends, owner = runs(_IN_TERM[data], offsets)
                n = np.bincount(owner, minlength=b - a)
                hashes = run_hashes(data, starts, ends)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                pair, times = np.unique(owner[hit] * len(known) + order[at[hit]], return_counts=True)
                row, term = np.divmod(pair, len(known))
                rows = np.flatnonzero(n)
                bounds = np.searchsorted(row, np.concatenate((rows, [b - a])))
                columns = [ids.slice(a, b - a).take(pa.array(rows)), pa.array(n[rows]), _packed(term, bounds), _packed(times, bounds)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "times"])

    return docs.select(F.col(row_id).cast("long").alias("_id"), F.col(text).alias("_text")).mapInArrow(work, "id bigint, n bigint, terms binary, times binary")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x.as_buffer()) for x in column], np.int64) // 4
    joined = b"".join(x.as_buffer().to_pybytes() for x in column)
    return np.frombuffer(joined, "<i4").astype(np.int64), np.concatenate(([0], np.cumsum(lengths)))


def statistics(rows: DataFrame, terms: int) -> Corpus:
    """Counts over all index rows: a sum for each asked term and two totals reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, total = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            found, _ = _unpacked(batch.column(batch.schema.names.index("terms")))
            holding += np.bincount(found, minlength=terms)
            documents += batch.num_rows
            total += int(np.asarray(batch.column(batch.schema.names.index("n"))).sum())
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((some, [-1, -2]))), pa.array(np.concatenate((holding[some], [documents, total])))], names=["term", "count"])

    sums = rows.select("n", "terms").mapInArrow(work, "term bigint, count bigint").groupBy("term").agg(F.sum("count").alias("count")).toArrow()
    counts = dict(zip(sums.column("term").to_pylist(), sums.column("count").to_pylist()))
    return Corpus(counts.get(-1, 0), counts.get(-2, 0), np.array([counts.get(t, 0) for t in range(terms)], np.int64))


def impacts(weights: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return weights * (1_000_000_000 * times // (1000 * times + 8 * lengths))


class Block:
    """Posting lists of some documents, with a sparse table of the greatest impacts."""

    def __init__(self, ids: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        """``ids`` rise; a posting is a term, the place of its document among ``ids`` and its impact."""
        order = np.lexsort((doc, term))
        self.ids, self.size, self.impact = ids, len(ids), impact[order]
        self.keys = term[order] * self.size + doc[order]
        n = len(self.keys)
        longest = int(np.bincount(term).max()) if n else 1
        self.table = np.empty((longest.bit_length(), n), np.int32)
        self.table[0] = np.arange(n)
        for k in range(1, len(self.table)):  # ranges that leave a list are never asked for
            half = 1 << (k - 1)
            left, right = self.table[k - 1], np.concatenate((self.table[k - 1][half:], np.full(min(half, n), n - 1, np.int32)))
            self.table[k] = np.where(self.impact[left] >= self.impact[right], left, right)
        self.log = np.concatenate(([0], np.floor(np.log2(np.arange(1, longest + 1))).astype(np.int64)))

    def ranges(self, terms: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        base = terms * self.size
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def bound(self, terms: np.ndarray, times: np.ndarray, lo: int, hi: int) -> tuple[int, np.ndarray]:
        """What the score of a document in [lo, hi) can be at most, and the documents of the greatest impacts."""
        start, stop = self.ranges(terms, lo, hi)
        some = stop > start
        start, stop, times = start[some], stop[some], times[some]
        level = self.log[stop - start]
        left, right = self.table[level, start], self.table[level, stop - (1 << level)]
        best = np.where(self.impact[left] >= self.impact[right], left, right)
        return int((times * self.impact[best]).sum()), self.keys[best] % self.size

    def scores(self, terms: np.ndarray, times: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """The scores of all documents in [lo, hi)."""
        start, stop = self.ranges(terms, lo, hi)
        length = stop - start
        ends = np.cumsum(length)
        at = np.repeat(start - ends + length, length) + np.arange(int(ends[-1]))
        # sums stay below 2**53, so doubles hold them exactly
        return np.bincount(self.keys[at] % self.size - lo, weights=self.impact[at] * np.repeat(times, length), minlength=hi - lo).astype(np.int64)


class Best:
    """The k best documents so far: greatest score, then smallest id."""

    def __init__(self, k: int):
        self.k, self.rows = k, []  # (-score, id), sorted

    def beats(self, score: int, least_id: int) -> bool:
        return score > 0 and (len(self.rows) < self.k or (-score, least_id) < self.rows[-1])

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        least = -self.rows[-1][0] if len(self.rows) == self.k else 1
        some = np.flatnonzero(scores >= max(1, least))
        if len(some):
            some = some[np.lexsort((ids[some], -scores[some]))[: self.k]]
            self.rows = sorted([*self.rows, *zip((-scores[some]).tolist(), ids[some].tolist())])[: self.k]


def search_block(block: Block, terms: np.ndarray, times: np.ndarray, best: Best, leaf: int) -> None:
    """Offer to ``best`` every document of ``block`` that can be among the best of a query."""
    if not block.size or not len(terms):
        return
    bound, tops = block.bound(terms, times, 0, block.size)
    waiting = [(-bound, 0, block.size, tops)]
    while waiting:
        bound, lo, hi, tops = heapq.heappop(waiting)
        if not best.beats(-bound, int(block.ids[lo])):
            continue
        if hi - lo <= leaf:
            best.offer(block.scores(terms, times, lo, hi), block.ids[lo:hi])
            continue
        middle = (lo + hi) // 2
        cut = int(tops[np.argmin(np.abs(tops - middle))])
        if abs(cut - middle) > 3 * (hi - lo) // 8:
            cut = middle
        best.offer(block.scores(terms, times, cut, cut + 1), block.ids[cut : cut + 1])
        for a, b in ((lo, cut), (cut + 1, hi)):
            if a == b:
                continue
            bound, tops = block.bound(terms, times, a, b)
            if best.beats(bound, int(block.ids[a])):
                heapq.heappush(waiting, (-bound, a, b, tops))


def _searching(queries: list[tuple[np.ndarray, np.ndarray]], corpus: Corpus, k: int, limits: Limits):
    """A worker of ``mapInArrow`` over index rows: the k best documents of its rows for each query."""
    weights = corpus.weights()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        held, documents, postings = [], 0, 0

        def searched() -> None:
            ids, n, term, doc, times = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            block = Block(ids[order], term, place[doc], impacts(weights[term], times, corpus.lengths(n)[doc]))
            for (terms, repeats), own in zip(queries, best):
                search_block(block, terms, repeats, own, limits.leaf)

        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                term, bounds = _unpacked(part.column(part.schema.names.index("terms")))
                times, _ = _unpacked(part.column(part.schema.names.index("times")))
                ids = np.asarray(part.column(part.schema.names.index("id")).fill_null(_NO_ID))
                doc = np.repeat(np.arange(part.num_rows), np.diff(bounds)) + documents
                held.append((ids, np.asarray(part.column(part.schema.names.index("n"))), term, doc, times))
                documents += part.num_rows
                postings += len(term)
                if documents >= limits.documents or postings >= limits.postings:
                    searched()
                    held, documents, postings = [], 0, 0
        if held:
            searched()
        rows = [(q, i, -score) for q, own in enumerate(best) for score, i in own.rows]
        columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([None if r[1] == _NO_ID else r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])

    return work


def _query_blocks(queries: DataFrame, query_id: str, text: str, limits: Limits) -> Iterator[tuple[list, list[Counter], list[bytes]]]:
    """Ids and term counts of the queries, in blocks of a bounded number of different terms."""
    ids, counts, terms = [], [], {}
    for row in queries.select(F.col(query_id).alias("i"), F.col(text).alias("t")).toLocalIterator():
        own = Counter(terms_of(row["t"]))
        if not own:
            continue
        if ids and len(terms) + len(own) > limits.terms:
            yield ids, counts, list(terms)
            ids, counts, terms = [], [], {}
        ids.append(row["i"])
        counts.append(own)
        terms.update(dict.fromkeys(own))
    if ids:
        yield ids, counts, list(terms)


def search(docs: DataFrame, queries: DataFrame, k: int, row_id: str = "doc_id", query_id: str = "item_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the k best documents of every query."""
    spark, found = docs.sparkSession, []
    for ids, counts, terms in _query_blocks(queries, query_id, text, limits):
        place = {t: i for i, t in enumerate(terms)}
        rows = materialize(index(docs, terms, row_id, text), "index")
        corpus = statistics(rows, len(terms))
        asked = [(np.array(sorted(place[t] for t in own), np.int64), np.array([own[terms[i]] for i in sorted(place[t] for t in own)], np.int64)) for own in counts]
        best = rows.mapInArrow(_searching(asked, corpus, k, limits), "query int, doc_id bigint, score bigint")
        names = spark.createDataFrame(list(enumerate(ids)), "query int, item_id bigint")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.append(ranked.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
