"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary logistic classifier over hashed character n-grams predicts
on which side the text's language stands.  A text gets the language whose codeword is nearest, where a bit that disagrees
costs its logistic loss times the trust that the bit earned in training; the second nearest shows how sure that is.

A model is fitted on a bounded sample of labelled rows (``FitLimits``); every text is scored whole, by summing the
weights of its n-grams, so memory depends on the chunk and not on the text.

Defined results: a text that is null or has no letter is ``und`` with score 0 and ambiguous; so is every text if nothing
could be learned.  With one learned language the others get it with score 1.  Equal texts get equal results.  Other
columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.llm.arrays import SMALL_CHUNK_BYTES, letter_table, lower_table, segment_sums, text_chunks
from tidetable.llm.bpe import _replace, _with

BITS = 15
ORDERS = (2, 3)
UNDETERMINED = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_SCALE = 64.0
#: Relative weights of n-grams are large numbers of small values; this many rows share a step of training.
_BATCH, _EPOCHS, _RATE = 64, 6, 0.5
#: A text with so many n-grams counts half as much as a very long one.
_EVIDENCE = 60


@dataclass(frozen=True)
class FitLimits:
    """Bounds of the sample that a model is fitted on: expected rows in all, most and least rows of a language.

    Every language is learned; the least rows of each come on top where there are more than ``rows / least`` of them.
    """

    rows: int = 8000
    per_language: int = 1500
    least: int = 20


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # language x bit, +1 or -1
    weights: np.ndarray  # bucket x bit; bucket 0 is for n-grams without letters and stays 0
    bias: np.ndarray
    trust: np.ndarray  # of each bit; sums to 1
    min_gap: float

    def margins(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signed distance of each text for each bit, and the number of its n-grams."""
        rows, bits = len(offsets) - 1, self.code.shape[1]
        sums, total = np.zeros((rows, bits), np.float64), np.zeros(rows, np.int64)
        for ids, bounds in gram_ids(points, offsets):
            sums += segment_sums(self.weights.take(ids, axis=0).astype(np.float64), bounds)
            total += segment_sums((ids > 0).astype(np.int64), bounds)
        # few n-grams say less than many of the same mean
        return _SCALE * sums / (total + _EVIDENCE)[:, None] + self.bias, total

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword, its share of the likelihood, and whether the second one is nearly as near."""
        ones = (self.code > 0).T.astype(float)
        distance = (np.logaddexp(0, -margins) * self.trust) @ ones + (np.logaddexp(0, margins) * self.trust) @ (1 - ones)
        best = distance.argmin(axis=1)
        near = np.exp(-self.code.shape[1] / 2 * (distance - distance.min(axis=1, keepdims=True)))
        nearest = np.partition(distance, 1, axis=1)[:, :2]
        return best, 1 / near.sum(axis=1), nearest[:, 1] - nearest[:, 0] < self.min_gap


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Codewords of n languages: all useful splits for up to five, else the best of some random codes."""
    if n <= 5:
        bits = range(1, 2 ** (n - 1)) if n > 1 else range(1)
        return np.array([[-1 if k and b >> (k - 1) & 1 else 1 for b in bits] for k in range(n)], np.int8)
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, widest = None, -1
    for _ in range(200 if n <= 64 else 5):
        code = rng.choice(np.array([-1, 1], np.int8), (n, length))
        alike = code.astype(np.float32) @ code.T.astype(np.float32)
        np.fill_diagonal(alike, -length)
        apart = int((length - alike.max()) // 2)
        if apart > widest and (np.abs(code.sum(axis=0)) < n).all():
            best, widest = code, apart
    return best


def gram_ids(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of all n-grams and the documents' bounds among them.

    Letters count in lower case, everything else as a gap, and each document has a gap on either side.
    """
    rows = len(offsets) - 1
    letters = np.where(letter_table()[points], lower_table()[points], 0).astype(np.uint32)
    padded = np.zeros(len(points) + 2 * rows + 2, np.uint32)
    padded[np.arange(len(points)) + 2 * (1 + np.repeat(np.arange(rows), np.diff(offsets)))] = letters
    bounds = offsets + 2 * np.arange(rows + 1)
    n = int(bounds[-1])
    for order in ORDERS:
        h, some = np.full(n, order, np.uint32), np.zeros(n, bool)
        for i in range(order):
            part = padded[i : n + i]
            h = (h ^ (h >> np.uint32(15))) + part * _FACTORS[i]
            some |= part > 0
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x7FEB352D)
        ids = (h >> np.uint32(32 - BITS)).astype(np.intp)
        ids[ids == 0] = 1
        yield np.where(some, ids, 0), bounds


def _features(text: str) -> Iterator[pa.RecordBatch]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, labels = batch.column(batch.schema.names.index(text)), batch.column(batch.schema.names.index("_label"))
            for a, b, points, offsets in text_chunks(column, SMALL_CHUNK_BYTES):
                ids, values = [], []
                grams = list(gram_ids(points, offsets))
                for i in range(b - a):
                    own = np.concatenate([g[bounds[i] : bounds[i + 1]] for g, bounds in grams])
                    found, counts = np.unique(own[own > 0], return_counts=True)
                    ids.append(found.astype(np.int32))
                    values.append((_SCALE * counts / max(1, counts.sum())).astype(np.float32))
                arrays = [labels.slice(a, b - a), pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["_label", "ids", "vals"])

    return work


def sample_share(hash_of: Column, share: Column | float) -> Column:
    """Whether a row is in a sample of this share; decided by a hash, so a repeated task takes the same rows."""
    return F.pmod(hash_of, F.lit(1 << 30)) < F.lit(float(1 << 30)) * share


def fit(df: DataFrame, text: str, lang: str, row_id: str, limits: FitLimits = FitLimits(), min_gap: float = 0.02) -> LanguageModel:
    """A model of the labelled rows of ``df``; rows without label, text or letters teach nothing."""
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("_label"), F.xxhash64(row_id, text).alias("_hash"))
    top = rows.groupBy("_label").count().collect()  # a row for each language
    names = tuple(sorted(r["_label"] for r in top))
    if not names:
        return LanguageModel((), np.ones((0, 1), np.int8), np.zeros((1 << BITS, 1), np.float32), np.zeros(1), np.ones(1), min_gap)
    most = max(limits.least, min(limits.per_language, limits.rows // len(names)))
    shares = df.sparkSession.createDataFrame([(r["_label"], min(1.0, most / r["count"])) for r in top], "_label string, _share double")
    sample = rows.join(F.broadcast(shares), "_label").where(sample_share(F.col("_hash"), F.col("_share")))
    # copies of a row share a hash, so they are in the sample together; one of them is enough
    sample = sample.dropDuplicates(["_hash", "_label"])
    got = sample.select("text", "_label").mapInArrow(_features("text"), "_label string, ids array<int>, vals array<float>").toArrow().combine_chunks()
    return train(names, got, min_gap)


def train(names: tuple[str, ...], rows: pa.Table, min_gap: float) -> LanguageModel:
    """Logistic regressions, one for each bit, by AdaGrad over the sampled rows in a fixed order."""
    code = codewords(len(names))
    bits = code.shape[1]
    weights, bias = np.zeros((1 << BITS, bits)), np.zeros(bits)
    seen, seen_bias = np.full(weights.shape, 1e-6), np.full(bits, 1e-6)
    place = {n: i for i, n in enumerate(names)}
    label = np.array([place[x] for x in rows.column("_label").to_pylist()], np.int64)
    ids = [np.asarray(x.values) for x in rows.column("ids")]
    values = [np.asarray(x.values, np.float64) for x in rows.column("vals")]
    usable = np.array([i for i, x in enumerate(ids) if len(x)], np.int64)
    # the rows come in any order; sorting by content makes the result the same each time
    usable = np.array(sorted(usable.tolist(), key=lambda i: (label[i], ids[i].tobytes(), values[i].tobytes())), np.int64)
    rng, loss = np.random.default_rng(11), np.zeros(bits)
    for epoch in range(_EPOCHS if len(names) > 1 else 0):
        loss[:] = 0
        for chosen in np.array_split(rng.permutation(usable), max(1, -(-len(usable) // _BATCH))):
            if not len(chosen):
                continue
            at = np.concatenate([ids[i] for i in chosen])
            value = np.concatenate([values[i] for i in chosen])
            sizes = np.array([len(ids[i]) for i in chosen])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            y = code[label[chosen]].astype(float)
            margin = np.add.reduceat(weights[at] * value[:, None], starts, axis=0) + bias
            loss += np.logaddexp(0, -y * margin).sum(axis=0)
            slope = -y / (1 + np.exp(np.clip(y * margin, -50, 50)))
            spread = np.repeat(slope, sizes, axis=0) * value[:, None]
            for b in range(bits):
                step = np.bincount(at, spread[:, b], minlength=1 << BITS) / len(chosen)
                seen[:, b] += step**2
                weights[:, b] -= _RATE * step / np.sqrt(seen[:, b])
            step = slope.mean(axis=0)
            seen_bias += step**2
            bias -= _RATE * step / np.sqrt(seen_bias)
    trust = np.clip(1 - loss / max(1, len(usable)) / np.log(2), 0.05, 1)
    weights[0] = 0
    return LanguageModel(names, code, weights.astype(np.float32), bias, trust / trust.sum(), min_gap)


def predict(df: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``lang_pred``, ``score`` and ``ambiguous``."""
    source = df.select(*dict.fromkeys([*(keep if keep is not None else df.columns), text]))
    rest = source if keep is None or text in keep else source.drop(text)
    columns = rest.columns
    names = np.array([*model.languages, UNDETERMINED], object)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, points, offsets in text_chunks(batch.column(batch.schema.names.index(text)), SMALL_CHUNK_BYTES):
                known = np.zeros(b - a, bool)
                best, score, doubt = np.zeros(b - a, int), np.ones(b - a), np.zeros(b - a, bool)
                if model.languages:
                    margins, total = model.margins(points, offsets)
                    known = total > 0
                    if len(model.languages) > 1:
                        best, score, doubt = model.decode(margins)
                best = np.where(known, best, len(model.languages))
                out = {
                    "lang_pred": pa.array(names[best], pa.string()),
                    "score": pa.array(np.where(known, score, 0.0)),
                    "ambiguous": pa.array(doubt | ~known),
                }
                yield _replace(batch.slice(a, b - a).select(columns), out)

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return source.mapInArrow(work, _with(rest, fields))
