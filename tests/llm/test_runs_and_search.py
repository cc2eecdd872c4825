"""Periodic runs, ranked lexical search and exact top-k, against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from tidetable.llm import columnar, lexical, periodic
from tidetable.llm.periodic import Rule
from tidetable.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def brute_runs(words, rule):
    """Maximal stretches of each period, kept where no smaller period holds throughout."""
    n, out = len(words), []
    for q in range(1, n // rule.exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= rule.least(q) and not any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def word_lists():
    rng = random.Random(5)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    yield from ([], ["x"], list("aaaaaa"), list("aaaaa"), list("ab" * 4), list("ab" * 3 + "a"), list("a" * 200), list(fibonacci[-1]))
    yield list("xaabaabaabaabay" * 5)
    for size in range(150):
        letters = "ab" if size % 3 else "abc"
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at, period = rng.randint(0, len(words)), rng.randint(1, 7)
            unit = [rng.choice(letters) for _ in range(period)]
            words[at:at] = (unit * 9)[: rng.randint(3, 6) * period + rng.randint(0, period)]
        yield words


@pytest.mark.parametrize("rule", [Rule(6, 4), Rule(2, 2), Rule(9, 3), Rule(3, 3)])
def test_runs_against_brute_force(rule):
    for words in word_lists():
        assert periodic.runs_of(words, rule) == brute_runs(words, rule), words


@pytest.mark.parametrize("rule", [Rule(6, 4), Rule(2, 2), Rule(9, 3)])
def test_stretches_lose_no_run(spark, rule):
    texts = [" ".join(w) for w in word_lists()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = {r["doc_id"]: r for r in periodic.find(docs, rule, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        words = text.split()
        runs = brute_runs(words, rule)
        assert [tuple(r) for r in rows[i]["runs"]] == runs and rows[i]["n_words"] == len(words)
        dropped = {x for s, length, p in runs for x in range(s + p, s + length)}
        assert rows[i]["collapsed"] == " ".join(w for x, w in enumerate(words) if x not in dropped)


def test_long_periodic_text_takes_steady_work():
    """A power of one word has a path of n states; segments keep the work in proportion."""
    words = ["w"] * 60_000
    assert periodic.runs_of(words, Rule()) == [(0, 60_000, 1)]
    unit = [str(i) for i in range(5000)]
    assert periodic.runs_of(unit * 9, Rule()) == [(0, 45_000, 5000)]


def test_runs_query(result, documents):
    rows = {r["doc_id"]: r for r in result("op11_periodic_runs")}
    assert set(rows) == set(documents)
    some = 0
    for i, r in rows.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", documents[i]["text"] or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[x if x < a else a + (x - a) % p] for x in range(n)]
        if n > 1500:
            continue
        runs = brute_runs(words, Rule())
        some += bool(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        milli = best[0] if best[0] is None else 1000 * best[1] // best[2]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *best, milli)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        dropped = {x for s, length, q in runs for x in range(s + q, s + length)}
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for x, w in enumerate(words) if x not in dropped).encode()).hexdigest()
    assert some > 5


def test_runs_of_odd_rows(odd_docs, no_docs, odd_rows):
    rows = periodic.find(odd_docs).collect()
    assert len(rows) == len(odd_rows) and all([tuple(x) for x in r["runs"]] == ([(0, 30_000, 19 * 97)] if len(r["text"] or "") > 1000 else []) for r in rows)
    assert {r["n_words"] for r in rows if not (r["text"] or "").strip()} == {0}
    assert periodic.find(no_docs).count() == 0


def brute_ranks(docs, items, k):
    """(query place, rank, doc_id, score) by scoring every document."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = lambda t: term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    rows = [(i, split(t)) for i, t in docs]
    rows = [(i, w) for i, w in rows if w]
    total, out = sum(len(w) for _, w in rows), []
    for q, (_, text) in enumerate(items):
        scored = []
        asked = split(text)
        weight = {t: math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * sum(t in w for _, w in rows) + 1))) for t in set(asked)}
        for i, w in rows:
            m = 25 + 75 * len(w) * len(rows) // total
            score = sum(weight[t] * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in asked if t in w)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(q, rank + 1, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda r: r[:2])


def corpus(rng, n):
    words = ["w%d" % i for i in range(40)] + ["été", "漢字", "Wörd", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=rng.randint(0, 30))) for _ in range(n)]
    return [(i, texts[rng.randrange(n)] if rng.random() < 0.2 else t) for i, t in enumerate(texts)], [(q, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for q in range(12)]


@pytest.mark.parametrize("limits", [lexical.Limits(leaf=1, documents=64), lexical.Limits(leaf=7, postings=300, terms=5), lexical.Limits()])
def test_search_against_all_scores(spark, limits):
    docs, items = corpus(random.Random(limits.leaf), 300)
    docs += [(1000, docs[0][1]), (None, docs[1][1]), (5000, None), (5001, "..."), (5002, "")]
    found = lexical.search(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), spark.createDataFrame(items, "item_id bigint, text string"), 10, limits=limits
    ).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found), key=lambda r: r[:2]) == brute_ranks(docs, items, 10)


def test_copies_and_ties_end_the_search(spark):
    """Equal documents tie, so the smallest ids win and the rest of an interval is dropped by its least id."""
    docs = [(i, "alpha beta") for i in range(3000)]
    found = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, "Beta!"), (2, None), (3, "gamma")], "item_id bigint, text string"), 10)
    assert [(r["item_id"], r["doc_id"]) for r in found.orderBy("rank").collect()] == []  # a term of all documents weighs nothing
    docs += [(i, "gamma delta") for i in range(9000, 9100)]
    found = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, "Gamma!")], "item_id bigint, text string"), 10)
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == list(range(9000, 9010))


def test_interval_bounds_hold():
    rng = np.random.default_rng(4)
    term, doc = (x.ravel() for x in np.meshgrid(np.arange(6), np.arange(200)))
    some = rng.random(len(term)) < 0.4
    block = lexical.Block(np.arange(200), term[some], doc[some], rng.integers(1, 1000, int(some.sum())))
    asked, times = np.array([0, 2, 5]), np.array([1, 3, 1])
    whole = block.scores(asked, times, 0, 200)
    for lo in range(0, 200, 7):
        for hi in range(lo + 1, 201, 13):
            assert block.bound(asked, times, lo, hi)[0] >= whole[lo:hi].max()


def test_search_query_against_sql(spark):
    assert compare(queries()["op12_ranked_intervals"](spark, SF), connect(SF), oracle_sql()["op12_ranked_intervals"]) == []


def test_search_of_odd_rows(spark, odd_docs, no_docs, odd_rows):
    items = spark.createDataFrame([(1, "the FOX", "s"), (1, "the fox", "s"), (None, "café", None), (4, None, None), (5, " ", None)], "item_id bigint, text string, score string")
    rows = lexical.search(odd_docs, items, 10).collect()
    want = brute_ranks([r[:2] for r in odd_rows], [(1, "the FOX"), (1, "the fox"), (None, "café")], 10)
    assert sorted((r["rank"], r["doc_id"] or -1, r["score"]) for r in rows) == sorted((r[1], r[2] or -1, r[3]) for r in want) and rows
    assert lexical.search(no_docs, items, 10).count() == 0 and lexical.search(odd_docs, items.where("item_id > 3"), 10).count() == 0


def brute_topk(vectors, k, every, scale):
    whole = {i: [math.floor(scale * x) for x in v] for i, v in vectors.items()}
    out = []
    for q, a in whole.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q and len(a) == len(b))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(df, k, every, scale, **options):
    rows = columnar.search(df, F.col("vec_id") % every == 0, k, scale=scale, options=columnar.SearchOptions(**options)).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


@pytest.mark.parametrize("options", [{}, {"queries": 7, "least_rows": 30, "block": 3, "few": 0.5}, {"block": 1, "few": 1.0, "pairs": 50}, {"few": 0.0}])
def test_topk_against_all_products(spark, options):
    rng = np.random.default_rng(8)
    spread = rng.normal(size=(240, 12)) * np.array([9, 5, 3, 2, 1, 1, 0.5, 0.5, 0.2, 0.1, 0.1, 0])
    spread[100:130] = spread[100]  # copies tie
    vectors = {i: [float(x) for x in v] for i, v in enumerate(spread)}
    vectors |= {1000 + i: [float(x) for x in rng.normal(size=5)] for i in range(8)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>").repartition(4)
    assert found(df, 6, 10, 8.0, **options) == brute_topk(vectors, 6, 10, 8.0)


def test_topk_prunes():
    """With falling mass most pairs go before the last block, and none of the best does."""
    rng = np.random.default_rng(2)
    decay = 64 * 0.7 ** np.arange(32)
    q, c = np.floor(rng.normal(size=(20, 32)) * decay), np.floor(rng.normal(size=(4000, 32)) * decay)
    i, j, score = columnar.survivors(q, np.arange(20), c.T, np.arange(100, 4100), np.full(20, -(1 << 60)), 5, columnar.SearchOptions())
    best = np.sort(q @ c.T, axis=1)[:, -5:]
    assert len(i) < 0.02 * 20 * 4000
    assert all(np.array_equal(np.sort(score[i == x])[-5:], best[x]) for x in range(20))


def test_topk_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], "x"), (1, None, "x"), (2, [], "x"), (3, [nan, 1.0], "x"), (4, [inf, 1.0], "x"), (5, [None, 1.0], "x"), (None, [1.0, 1.0], "x"),
            (6, [1.0, 1.0], None), (6, [1.0, 1.0], None), (6, [9.0, 9.0], None), (7, [1e300, -1e300], "x"), (8, [0.0, 0.0], "x"), (10, [1.0, 2.0], "x"), (11, [1.0, 2.0, 3.0], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    vectors = {i: v for i, v in ((0, [1.0, 2.0]), (6, [1.0, 1.0]), (8, [0.0, 0.0]), (10, [1.0, 2.0]))}
    lowest = -(1 << 63)
    got = [r for r in found(df, 4, 10, 1.0)]
    want = [*brute_topk(vectors, 4, 10, 1.0), (0, 4, 7, lowest), (10, 4, 7, lowest)]
    assert got == sorted(want)
    assert found(df.limit(0), 4, 10, 1.0) == []


def test_topk_query_against_sql(spark):
    assert compare(queries()["op13_columnar_topk"](spark, SF), connect(SF), oracle_sql()["op13_columnar_topk"]) == []
