"""The grouped prefix join against all pairs."""

import random
import re

import pytest
from oracle import compare, connect

from tidetable.llm import jaccard_join
from tidetable.llm.jaccard_join import Measure, near_copies
from tidetable.llm.queries import oracle_sql, queries


def brute(rows, measure):
    """(size, smallest reachable id) by id, from all pairs."""
    sets = {}
    for i, text in rows:
        if i is not None:
            lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
            k = measure.words
            sets[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= measure.percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def copies(rng, groups, size, most):
    """Documents in groups of edited copies, with a passage that all share, some in other case."""
    words = ["w%d" % i for i in range(400)]
    shared = rng.choices(words, k=12)
    out = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(1, 60)) + shared
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, most)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own).upper() if rng.random() < 0.2 else " ".join(own))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("measure", [Measure(4, 85), Measure(5, 80), Measure(1, 50)])
def test_against_all_pairs(spark, measure):
    rows = copies(random.Random(measure.words), 60, 8, 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_copies(docs, measure).collect()}
    want = brute(rows, measure)
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_blocks_of_hot_lists_and_groups(spark, monkeypatch):
    """With blocks of a few sets, every shared shingle and every group of equal prefix is dealt out in pairs of blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "_OFTEN", 1)
    rng = random.Random(9)
    rows = copies(rng, 6, 40, 2)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    measure = Measure(3, 70)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_copies(docs, measure).collect()}
    assert got == brute(rows, measure)


@pytest.mark.parametrize("often", [2, 10**9])
def test_long_lists_are_dealt_by_their_length(spark, monkeypatch, often):
    """Lists whose shingle is not known to be frequent, or is thought to be rarer than it is, are dealt out all the same."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "_OFTEN", often)
    monkeypatch.setattr(jaccard_join, "_COUNTED", 200)
    split, lengths = jaccard_join._split_long, []

    def spy(lists):
        out = split(lists)
        lengths.extend((t.groupBy("key").count().agg({"count": "max"}).first()[0] or 0) for t in (lists, out))
        return out

    monkeypatch.setattr(jaccard_join, "_split_long", spy)
    rows = copies(random.Random(12), 4, 60, 2)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    measure = Measure(2, 60)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_copies(docs, measure).collect()}
    assert got == brute(rows, measure)
    assert lengths[0] > 3 * lengths[1] or often == 2


def test_members_of_a_group_are_verified(spark):
    """Members that share a prefix link only if their whole sets are similar."""
    sets = {1: [1, 2, 3, 4], 2: [1, 2, 3, 5], 3: [1, 2, 9, 8], 4: [1, 2, 9, 7]}
    import numpy as np

    packed = spark.createDataFrame([(k, bytearray(np.array(v, "<u8").tobytes())) for k, v in sets.items()], "id bigint, set binary")
    for blocks in (1, 3):
        members = spark.createDataFrame([("g", k, blocks) for k in sets], "group_id string, id bigint, blocks bigint")
        links = {(r["a"], r["b"]) for r in jaccard_join._within_groups(members, packed, Measure(1, 60)).collect()}
        assert links == {(1, 2), (3, 4)}


def test_long_chains_become_one_component(spark):
    rng = random.Random(2)
    ids = rng.sample(range(1000), 60)
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(2000, 2001)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in jaccard_join.components(links).collect()}
    assert got == {**dict.fromkeys(ids, min(ids)), 2000: 2000, 2001: 2000}


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(queries()["op2_grouped_prefix_join"](spark, sf), connect(sf), oracle_sql()["op2_grouped_prefix_join"]) == []


def test_odd_rows(odd_docs, no_docs, odd_rows):
    rows = near_copies(odd_docs, Measure(4, 85)).collect()
    assert len(rows) == len(odd_rows)
    want = brute([r[:2] for r in odd_rows], Measure(4, 85))
    assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert sorted((r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is None and r["n_shingles"]) == [(want[5][0], 5)]
    assert near_copies(no_docs, Measure(4, 85)).count() == 0


def test_a_group_of_several_classes_names_no_component(spark):
    """Successive edits: a head is the smallest of its component, while a text of equal prefix joins others of it."""
    family = ["0 1 3 4 5", "0 1 2 3 4 5", "0 3 4 5", "2 3 4 5", "1 2 3 4 5", "1 2 3 5", "0 1 2 4 5", "0 1 2 5", "3 4 5", "0 2 3 4 5"]
    rows = [(i, " ".join("w" + x for x in own.split())) for i, own in enumerate(family)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_copies(docs, Measure(1, 70)).collect()}
    assert got == brute(rows, Measure(1, 70))


def test_one_family_of_copies_takes_pairs_in_proportion(spark, monkeypatch):
    """Pairs that are looked at grow with the copies, not with their square, though many miss the pivots."""
    counted, sketched = [], jaccard_join._sketched

    def count(pairs, profiles, measure):
        counted.append(pairs.count())
        return sketched(pairs, profiles, measure)

    monkeypatch.setattr(jaccard_join, "_sketched", count)
    looked = {}
    for n in (300, 1200, 4800):
        rng = random.Random(1)
        base = rng.choices(["w%d" % i for i in range(400)], k=200)
        rows = []
        for i in range(n):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = "x%d" % rng.randrange(400)
            rows.append((i, " ".join(own)))
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        assert {r["component_id"] for r in near_copies(docs, Measure(5, 70)).collect()} == {0}
        looked[n], counted[:] = list(counted), []
    assert all(sum(pairs) < 4 * n for n, pairs in looked.items()), looked
