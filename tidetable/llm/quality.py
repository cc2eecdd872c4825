"""Quality by logistic regression over hashed word n-grams, learned with follow-the-regularised-leader updates.

Words are runs of letters and digits in lower case, and runs of other visible marks count as words of their own.  Single
words and pairs of neighbours are hashed; a word behind itself counts as a repetition, whatever the word is.  A text is
the sparse vector of its features, logarithms of their counts, of length 1; its score is the logistic function of the dot
product with the weights.

The model is fitted on a bounded sample of labelled rows of each class (``FitLimits``), weighted to stand for all.

Defined results: null and empty texts have no features, so their score is that of the bias; without labels every score
is 0.5.  Of several labels of one row the smallest counts.  Equal texts get equal scores.  Other columns pass through;
columns named like an output are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.llm.arrays import CODE_POINTS, SMALL_CHUNK_BYTES, lower_table, mix, run_hashes, segment_sums, text_chunks
from tidetable.llm.bpe import _replace, _with
from tidetable.llm.language import sample_share
from tidetable.llm.scan import WHITE

BITS = 18
_REPEAT = np.uint64(0xD1B54A32D192ED03)
_ALPHA, _BETA, _L1, _L2, _EPOCHS = 1.5, 1.0, 0.02, 0.001, 4


@dataclass(frozen=True)
class FitLimits:
    """Expected number of sampled rows of each class."""

    per_class: int = 3000


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        ids, values, bounds = sparse_rows(points, offsets)
        return 1 / (1 + np.exp(-np.clip(segment_sums(self.weights[ids] * values, bounds) + self.bias, -30, 30)))


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """0: white space, 1: part of a word, 2: another visible mark."""
    table = np.array([1 if unicodedata.category(chr(c))[0] in "LNM" else 0 if unicodedata.category(chr(c))[0] == "Z" else 2 for c in range(CODE_POINTS)], np.uint8)
    table[list(WHITE)] = 0
    return table


def word_hashes(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all documents in order, and the documents' bounds among them."""
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    kinds = _kinds()[points]
    fresh = np.empty(len(points) + 1, bool)
    fresh[0] = fresh[-1] = True
    fresh[1:-1] = kinds[1:] != kinds[:-1]
    fresh[offsets] = True
    borders = np.flatnonzero(fresh)
    starts, ends = borders[:-1], borders[1:]
    words = kinds[starts] > 0
    starts, ends = starts[words], ends[words]
    return run_hashes(lower_table()[points], starts, ends), np.searchsorted(starts, offsets)


def sparse_rows(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values of the features of each document, and the documents' bounds among them."""
    words, bounds = word_hashes(points, offsets)
    rows = len(offsets) - 1
    of_row = np.repeat(np.arange(rows), np.diff(bounds))
    alone = words >> np.uint64(64 - BITS)
    beside = np.flatnonzero(of_row[1:] == of_row[:-1]) if len(words) else np.zeros(0, np.int64)
    first, second = words[beside], words[beside + 1]
    pair = mix(np.where(first == second, _REPEAT, first * np.uint64(3) + second)) >> np.uint64(64 - BITS)
    keys = np.concatenate(((of_row.astype(np.uint64) << np.uint64(BITS)) | alone, (of_row[beside].astype(np.uint64) << np.uint64(BITS)) | pair))
    keys, counts = np.unique(keys, return_counts=True)
    ids = (keys & np.uint64((1 << BITS) - 1)).astype(np.intp)
    out = np.searchsorted(keys >> np.uint64(BITS), np.arange(rows + 1, dtype=np.uint64))
    values = np.log1p(counts)
    norm = np.sqrt(segment_sums(values**2, out))
    return ids, values / np.repeat(np.maximum(norm, 1e-12), np.diff(out)), out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, points, offsets in text_chunks(batch.column(batch.schema.names.index("text")), SMALL_CHUNK_BYTES):
            ids, values, bounds = sparse_rows(points, offsets)
            lists = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x)) for x in (ids.astype(np.int32), values.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index("_label")).slice(a, b - a), *lists], names=["_label", "ids", "vals"])


def fit(df: DataFrame, labels: DataFrame, row_id: str, label: str, text: str = "text", limits: FitLimits = FitLimits()) -> QualityModel:
    """A model of the rows of ``df`` that ``labels`` marks 0 or 1.

    Only the sampled labels are sent to all tasks, and there are no more of them than the limits say; of the rows that
    they mark, which may be more where ids repeat, four times the rows of a class are expected at most.
    """
    marked = labels.where(F.col(label).isin(0, 1) & F.col(row_id).isNotNull()).groupBy(F.col(row_id).alias("_id")).agg(F.min(label).cast("int").alias("_label"))
    counts = {r["_label"]: r["count"] for r in marked.groupBy("_label").count().collect()}
    if not counts:
        return QualityModel(np.zeros(1 << BITS), 0.0)
    share = {k: min(1.0, limits.per_class / n) for k, n in counts.items()}
    of_label = F.when(F.col("_label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    sample = marked.where(sample_share(F.xxhash64("_id"), of_label))
    rows = df.select(F.col(row_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(sample), "_id").withColumn("_hash", F.xxhash64("_id", "text"))
    # rows of one id come together: copies count once, and if different texts of it are too many, a share of them is taken
    found = rows.agg(F.approx_count_distinct("_hash")).first()[0]
    rows = rows.where(sample_share(F.xxhash64("_hash"), min(1.0, 4 * limits.per_class / max(1, found)))).dropDuplicates(["_hash"])
    got = rows.select("text", "_label").mapInArrow(_features, "_label int, ids array<int>, vals array<float>").toArrow().combine_chunks()
    return train(got, {k: 1 / s for k, s in share.items()})


def train(rows: pa.Table, weight: dict[int, float]) -> QualityModel:
    """Follow the regularised leader, one row at a time, in a fixed order."""
    z, n, w = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = bias = 0.0
    label = np.array(rows.column("_label").to_pylist(), np.int64)
    ids = [np.asarray(x.values) for x in rows.column("ids")]
    values = [np.asarray(x.values, np.float64) for x in rows.column("vals")]
    order = np.array(sorted(range(len(ids)), key=lambda i: (label[i], ids[i].tobytes(), values[i].tobytes())), np.int64)
    rng, heaviest = np.random.default_rng(5), max(weight.values(), default=1.0)
    for _ in range(_EPOCHS):
        for i in rng.permutation(order):
            at, x = ids[i], values[i]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ x + bias, -30, 30)))
            slope = (p - label[i]) * weight[int(label[i])] / heaviest
            g = slope * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / _ALPHA
            z[at] += g - step * w[at]
            n[at] += g * g
            w[at] = np.where(np.abs(z[at]) <= _L1, 0.0, -(z[at] - np.sign(z[at]) * _L1) / ((_BETA + np.sqrt(n[at])) / _ALPHA + _L2))
            zb += slope - (np.sqrt(nb + slope * slope) - np.sqrt(nb)) / _ALPHA * bias
            nb += slope * slope
            bias = -zb / ((_BETA + np.sqrt(nb)) / _ALPHA)
    return QualityModel(w, float(bias))


def score(df: DataFrame, model: QualityModel, text: str = "text", keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``score`` and ``predicted``, 1 for a score of ``threshold`` or more."""
    source = df.select(*dict.fromkeys([*(keep if keep is not None else df.columns), text]))
    rest = source if keep is None or text in keep else source.drop(text)
    columns = rest.columns
    # the weights that are not zero travel with the tasks
    at = np.flatnonzero(model.weights)
    packed, bias = (at.astype(np.int32), model.weights[at].astype(np.float32)), model.bias

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS)
        weights[packed[0]] = packed[1]
        own = QualityModel(weights, bias)
        for batch in batches:
            for a, b, points, offsets in text_chunks(batch.column(batch.schema.names.index(text)), SMALL_CHUNK_BYTES):
                s = own.score(points, offsets)
                out = {"score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}
                yield _replace(batch.slice(a, b - a).select(columns), out)

    return source.mapInArrow(work, _with(rest, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
