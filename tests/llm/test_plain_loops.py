"""Language decoding, quality training and the shard ring against plain loops over single values."""

import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidetable.llm import language, quality, ring
from tidetable.llm.arrays import text_chunks

TEXTS = ["", " ", "a", "Ab aB", "Ünïted été, 12 naïve!", "the cat the cat the cat", "漢字 と かな", "x x x y x", "1, 2 & 3 -- go!", "Grüße aus Köln\n\tund Umgebung"]


def chunk(texts):
    ((_, _, points, offsets),) = text_chunks(pa.array(texts, pa.string()))
    return points, offsets


def grams_of(text):
    """Buckets of all letter n-grams of a text between two gaps."""
    marks = [0, 0] + [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else 0 for c in text] + [0, 0]
    out = []
    for order in language.ORDERS:
        for at in range(len(text) + 2):
            part = marks[at : at + order]
            if not any(part):
                continue
            h = order
            for value, factor in zip(part, language._FACTORS.tolist()):
                h = ((h ^ (h >> 15)) + value * factor) & 0xFFFFFFFF
            h = ((h ^ (h >> 16)) * 0x7FEB352D) & 0xFFFFFFFF
            out.append(max(1, h >> (32 - language.BITS)))
    return out


@pytest.mark.parametrize("n", [2, 4, 9])
def test_margins_and_decoding_of_languages(n):
    rng = np.random.default_rng(n)
    code = language.codewords(n)
    bits = code.shape[1]
    trust = rng.random(bits)
    weights = rng.normal(size=(1 << language.BITS, bits)).astype(np.float32)
    weights[0] = 0
    model = language.LanguageModel(tuple(map(str, range(n))), code, weights, rng.normal(size=bits) / 10, trust / trust.sum(), 0.05)
    margins, total = model.margins(*chunk(TEXTS))
    best, score, doubt = model.decode(margins)
    for i, text in enumerate(TEXTS):
        grams = grams_of(text)
        assert total[i] == len(grams)
        plain = [64 * sum(float(weights[g, b]) for g in grams) / (len(grams) + 60) + model.bias[b] for b in range(bits)]
        assert np.allclose(margins[i], plain)
        far = [sum(model.trust[b] * math.log1p(math.exp(-int(code[k, b]) * plain[b])) for b in range(bits)) for k in range(n)]
        order = sorted(range(n), key=far.__getitem__)
        assert best[i] == order[0]
        assert score[i] == pytest.approx(1 / sum(math.exp(-bits / 2 * (d - far[order[0]])) for d in far))
        assert doubt[i] == (far[order[1]] - far[order[0]] < 0.05)


def words_of(text):
    """Words and single kinds of marks in lower case; white space parts them."""
    kind = lambda c: "w" if unicodedata.category(c)[0] in "LNM" else " " if c.isspace() else "m"
    kinds = "".join(map(kind, text))
    return [text[m.start() : m.end()].lower() for m in re.finditer("w+|m+", kinds)]


def test_quality_features_count_words_and_pairs():
    _, values, bounds = quality.sparse_rows(*chunk(TEXTS))
    for i, text in enumerate(TEXTS):
        words = words_of(text)
        counts = {}
        for key in [*words, *(("again",) if a == b else (a, b) for a, b in zip(words, words[1:]))]:
            counts[key] = counts.get(key, 0) + 1
        plain = [math.log1p(c) for c in counts.values()]
        norm = math.sqrt(sum(v * v for v in plain)) or 1.0
        assert np.allclose(sorted(values[bounds[i] : bounds[i + 1]]), sorted(v / norm for v in plain))


@pytest.mark.parametrize("weight", [{0: 1.0, 1: 1.0}, {0: 4.0, 1: 1.5}])
def test_updates_follow_the_regularised_leader(weight):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(60):
        ids = np.sort(rng.choice(40, rng.integers(0, 9), replace=False)).astype(np.int32)
        rows.append((int(rng.integers(0, 2)), ids, rng.random(len(ids)).astype(np.float32)))
    table = pa.table({"_label": pa.array([r[0] for r in rows], pa.int32()), "ids": pa.array([r[1] for r in rows], pa.list_(pa.int32())), "vals": pa.array([r[2] for r in rows], pa.list_(pa.float32()))})
    model = quality.train(table.combine_chunks(), weight)

    z, n, bias_z, bias_n = {}, {}, 0.0, 0.0

    def weight_of(i):
        if abs(z.get(i, 0.0)) <= 0.02:
            return 0.0
        return -(z[i] - math.copysign(0.02, z[i])) / ((1 + math.sqrt(n[i])) / 1.5 + 0.001)

    def bias():
        return -bias_z / ((1 + math.sqrt(bias_n)) / 1.5)

    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1].tobytes(), rows[i][2].astype(np.float64).tobytes()))
    shuffle = np.random.default_rng(5)
    for _ in range(4):
        for i in shuffle.permutation(order):
            label, ids, values = rows[i]
            old = {j: weight_of(j) for j in ids.tolist()}
            p = 1 / (1 + math.exp(-(sum(old[j] * float(v) for j, v in zip(ids.tolist(), values)) + bias())))
            slope = (p - label) * weight[label] / max(weight.values())
            for j, v in zip(ids.tolist(), values):
                g, before = slope * float(v), n.get(j, 0.0)
                n[j] = before + g * g
                z[j] = z.get(j, 0.0) + g - (math.sqrt(n[j]) - math.sqrt(before)) / 1.5 * old[j]
            b, before = bias(), bias_n
            bias_n += slope * slope
            bias_z += slope - (math.sqrt(bias_n) - math.sqrt(before)) / 1.5 * b
    assert np.flatnonzero(model.weights).tolist() == sorted(j for j in z if weight_of(j))
    assert np.allclose([model.weights[j] for j in z], [weight_of(j) for j in z])
    assert model.bias == pytest.approx(bias())


@pytest.mark.parametrize(("shards", "slack"), [(1, 0.0), (5, 0.0), (5, 0.2), (8, 0.05)])
def test_rows_walk_the_ring_one_by_one(spark, shards, slack):
    keys = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise((F.col("id") % 400).cast("string"))
    df = spark.range(1500).select("id", keys.alias("k"))
    rows = [(r["h"], r["id"]) for r in df.select("id", F.xxhash64("k").alias("h")).collect()]
    position, owner = ring.ring(shards, 16)
    waiting = {}
    for h, i in sorted(rows):
        ahead = [a for a, p in enumerate(position.tolist()) if p >= h]
        waiting.setdefault(ahead[0] if ahead else 0, []).append(i)
    most = [math.ceil((1 + slack) * len(rows) / shards)] * shards if slack else [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    load, placed = [0] * shards, {}
    for step in range(len(owner)):
        for arc in sorted(waiting):
            shard, still = int(owner[(arc + step) % len(owner)]), []
            for i in waiting[arc]:
                if load[shard] < most[shard]:
                    placed[i] = (shard, load[shard])
                    load[shard] += 1
                else:
                    still.append(i)
            waiting[arc] = still
    got = ring.assign(df, F.col("k"), shards, ["id"], nodes=16, slack=slack).collect()
    assert len(got) == len(rows) and {r["id"]: (r["shard"], r["slot"]) for r in got} == placed
