"""Fingerprints, nearest neighbours and shards."""

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidetable.llm import fingerprints, nearest, ring


def marks(*texts):
    return fingerprints.fingerprints_of(pa.array(texts, pa.string()))


def test_fingerprints_add_up():
    a, b, both, swapped, less = marks("one line\nand two\n", "a third", "one line\nand two\n\na third", "a third\n\nand two\none line", "one line\n\nand two")
    assert fingerprints.combine(a, b) == both == swapped
    assert fingerprints.combine(both, b, -1) == a == less
    zero, null = marks("", None)
    assert zero == null == bytes(fingerprints.SIZE) and fingerprints.combine(a, zero) == a
    twice = marks("x y z\nx y z")[0]
    assert twice != marks("x y z")[0] and fingerprints.combine(*marks("x y z", "x y z")) == twice


def test_likeness_follows_the_shared_text():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(3000)]
    base = list(rng.choice(words, 400))
    shares = [0.0, 0.2, 0.5, 0.9]
    texts = [" ".join(base[: int(400 * (1 - s))] + list(rng.choice(words, int(400 * s)))) for s in shares]
    near = fingerprints.likeness(marks(*[" ".join(base)] * 4), marks(*texts))
    assert near[0] == 1 and near[1] > 0.6 and 0.3 < near[2] < 0.7 and near[3] < 0.3
    assert fingerprints.likeness(marks("", "a"), marks("", "")).tolist() == [1.0, 0.0]


def test_chunks_do_not_matter():
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abé漢 \n"), rng.integers(0, 60))) for _ in range(300)]
    assert fingerprints.fingerprints_of(pa.array(texts)) == [marks(t)[0] for t in texts]


def check_neighbours(rows, pairs):
    """rows: (id, text) in their order."""
    want = {}
    for i, (key, text) in enumerate(pairs):
        after = pairs[(i + 1) % len(pairs)][1]
        third = len(text) // 3
        want[key] = hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()
    assert {r["doc_id"]: r["edited_sha256"] for r in rows} == want and len(rows) == len(pairs)


def test_fingerprint_query(result, documents):
    rows = result("op4_multiset_fingerprints")
    check_neighbours(rows, [(k, documents[k]["text"] or "") for k in sorted(documents, reverse=True)])
    assert all(r["n_chars"] == len(documents[r["doc_id"]]["text"]) for r in rows)
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.98
    for r in rows[:20]:
        assert base64.b64decode(r["fingerprint"]) == marks(documents[r["doc_id"]]["text"])[0]


@pytest.mark.parametrize("n", [1, 2, 7])
def test_neighbours_of_few_rows(spark, n):
    from tidetable.llm import queries

    docs = spark.createDataFrame([(i, f"text {i} of some length") for i in range(n)], "doc_id bigint, text string")
    out = fingerprints.dealt_by_range(docs, "doc_id", "text").mapInArrow(queries._edited, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    check_neighbours(out.collect(), [(i, f"text {i} of some length") for i in reversed(range(n))])


def test_odd_rows_are_all_paired(odd_docs, no_docs, odd_rows):
    def count(batches):
        for pairs in fingerprints.neighbours(batches):
            yield pa.RecordBatch.from_arrays([pa.array([p.row_id for p in pairs], pa.int64())], names=["id"])

    got = fingerprints.dealt_by_range(odd_docs, "doc_id", "text").mapInArrow(count, "id bigint").collect()
    assert sorted(str(r["id"]) for r in got) == sorted(str(r[0]) for r in odd_rows)
    assert fingerprints.dealt_by_range(no_docs, "doc_id", "text").count() == 0
    only_nulls = odd_docs.where("doc_id IS NULL")
    assert fingerprints.dealt_by_range(only_nulls, "doc_id", "text").mapInArrow(count, "id bigint").count() == 2
    assert fingerprints.fingerprint(odd_docs).select("fingerprint").count() == len(odd_rows)


def exact(ids, vectors, k):
    """Nearest by cosine for every id divisible by 50, ties to smaller ids."""
    out = {}
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    for i in np.flatnonzero(ids % 50 == 0):
        score = (vectors * vectors[i]).sum(axis=1) / (norms * norms[i])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[ids[i]] = [(int(ids[j]), score[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_order(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got, want = found(nearest.search(df, F.col("vec_id") % 50 == 0, 5)), exact(ids, vectors, 5)
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 5 for q in want]
    assert set(got) == set(want) and np.mean(hits) >= 0.9
    row = {int(i): v for i, v in zip(ids, vectors)}
    for q, near in got.items():
        assert len(near) == 5 and near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - row[q] @ row[v] / np.linalg.norm(row[q]) / np.linalg.norm(row[v])) < 1e-12 for v, s in near)


def test_a_hot_vector_is_searched_in_blocks(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8)
    vectors = np.array([hot if i % 3 == 0 else rng.normal(size=8) for i in range(900)], np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    options = nearest.IndexOptions(block=50, min_lists=64)
    got, want = found(nearest.search(df, F.col("vec_id") % 50 == 0, 5, options=options)), exact(np.arange(900), vectors.astype(float), 5)
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]] or q % 3
    assert [v for v, _ in got[0]] == [3, 6, 9, 12, 15]


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (1, [0.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [1.0]), (None, [1.0, 0.5]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [3e30, 0.0]), (100, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    got = found(nearest.search(df, F.col("vec_id") % 50 == 0, 5))
    assert {q: [v for v, _ in near] for q, near in got.items()} == {0: [8, 9, 50], 50: [0, 8, 9]}
    assert nearest.search(df.where("false"), F.lit(True), 5).count() == 0


def check_shards(rows, n, shards):
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == n and set(counts) <= set(range(shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in counts.values())
    sizes = [len(counts.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shard_query(result, documents):
    rows = result("op10_bounded_ring")
    check_shards(rows, len(documents), 16)
    for r in rows:
        raw = (documents[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_shards_of_odd_rows_and_a_hot_key(odd_docs, no_docs, odd_rows, spark):
    check_shards(ring.assign(odd_docs, F.xxhash64("text"), 4, ["doc_id", "text"]).collect(), len(odd_rows), 4)
    assert ring.assign(no_docs, F.xxhash64("text"), 4, ["doc_id"]).count() == 0
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    rows = ring.assign(hot, F.col("k"), 8, ["id"]).collect()
    check_shards(rows, 3000, 8)


def test_a_new_shard_moves_few_rows(spark):
    keys = spark.range(20_000).withColumn("k", F.col("id").cast("string"))
    a, b = ({r["id"]: r["shard"] for r in ring.assign(keys, F.col("k"), n, ["id"], slack=0.1).collect()} for n in (10, 11))
    for own in (a, b):
        sizes = np.bincount(list(own.values()))
        assert sizes.max() <= np.ceil(1.1 * 20_000 / len(sizes))
    assert np.mean([a[i] != b[i] for i in a]) < 0.35  # by remainder it would be 0.91


def test_rows_run_clockwise():
    owner = np.array([0, 1, 2, 0])
    table = ring.allocate({0: 5, 1: 1, 3: 2}, owner, [3, 3, 2])
    assert table.tolist() == [[0, 0, 0, 0], [0, 3, 1, 1], [1, 0, 1, 0], [3, 0, 2, 0]]
    with pytest.raises(ValueError):
        ring.allocate({0: 9}, owner, [3, 3, 2])


def test_the_ratio_alone_chooses_the_lists_of_a_query():
    rng = np.random.default_rng(5)
    points, queries = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.normal(size=(2500, 64)), rng.normal(size=(4, 64))))
    options = nearest.IndexOptions()
    distance = np.sqrt(2 - 2 * queries @ points.T)
    want = [np.flatnonzero(d <= (1 + options.ratio) * d.min()).tolist() for d in distance]
    assert max(map(len, want)) > 1024
    assert [sorted(x.tolist()) for x in nearest.centroid_graph(points).lists_for(queries, options)] == want
