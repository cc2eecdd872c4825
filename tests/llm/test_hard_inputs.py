"""Very long uniform texts, hot ids, many classes, repeated tasks; learners and the ring against plain loops."""

import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidetable.llm import fingerprints, jaccard_join, language, nearest, packing, periodic, quality, ring, token_counts, warc
from tidetable.session import new_folder

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
UNIFORM = ["x" + " " * 1_000_000 + "y", "\n" * 300_000, "a" * 300_000, "ab <|endoftext|>" * 5_000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def uniform(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*UNIFORM, "some words of a plain text"])]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(2)


def test_ids_of_long_uniform_texts(tokenizer):
    for text in UNIFORM:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert packing.ids_of(text, JSON).tolist() == want
        assert token_counts.text_prefix_counts(text, JSON)[-1] == len(want)


def test_operators_on_long_uniform_texts(spark, uniform, tokenizer):
    from test_tokens import check_packing

    from tidetable.llm import bpe

    texts = {i: t for i, t in enumerate([*UNIFORM, "some words of a plain text"])}
    check_packing(packing.pack_texts(uniform, JSON, 2, 1024).collect(), texts, 1024, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(uniform, JSON, 1024).collect()}
    assert counts == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert all(bytes(r["decoded"]).decode() == texts[r["doc_id"]] for r in bpe.decode(bpe.encode(uniform, RANKS, packed=True), RANKS).collect())
    model = language.fit(uniform, "text", "lang", "doc_id")
    assert {r["doc_id"]: r["lang_pred"] for r in language.predict(uniform, model).collect()} == {0: "en", 1: "und", 2: "en", 3: "en", 4: "en"}
    labels = spark.createDataFrame([(0, 0), (4, 1)], "doc_id bigint, quality int")
    assert quality.score(uniform, quality.fit(uniform, labels, "doc_id", "quality")).count() == 5
    near = {r["doc_id"]: r["n_shingles"] for r in jaccard_join.near_copies(uniform, jaccard_join.Measure(4, 85)).collect()}
    assert near == {0: 1, 1: 0, 2: 1, 3: 3, 4: 3}
    runs = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.find(uniform).collect()}
    assert runs == {0: [], 1: [], 2: [], 3: [(1, 4999, 1)], 4: []}
    assert fingerprints.fingerprint(uniform).count() == 5
    assert ring.assign(uniform.select("doc_id", "text"), F.xxhash64("text"), 2, ["doc_id"]).count() == 5
    pages = uniform.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"))
    assert {r["page_id"]: r["payload_bytes"] for r in warc.round_trip(pages, "page_id", "html").collect()} == {i: len(t) for i, t in texts.items()}


def test_pipeline_stages_on_long_uniform_texts(spark, uniform):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, uniform, "/root/testdata/sf0.001").count() >= 1


def test_likeness_of_long_uniform_texts():
    """A lane of a text of one repeated piece counts beyond 16 bits."""
    whole, edited = fingerprints.fingerprints_of(pa.array(["a" * 120_000, "a" * 80_000 + "b" * 40_000]))
    assert 0.6 < fingerprints.likeness([whole], [edited])[0] < 1


@pytest.mark.parametrize("shape", ["null", "one id", "both"])
def test_hot_ids_fill_several_ranges(spark, shape):
    """Rows without id and rows of one id are cut by the hashes of their texts, and still meet the next row."""
    rng = random.Random(3)
    rows = [(i, f"text {rng.random()}") for i in range(200)]
    rows += [(None, f"null {rng.random()}") for _ in range(150 * (shape != "one id"))]
    rows += [(77, f"hot {rng.random()}") for _ in range(150 * (shape != "null"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    dealt = fingerprints.dealt_by_range(docs, "doc_id", "text")
    sizes = [r["count"] for r in dealt.where("_own").groupBy("_range").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 0.3 * len(rows)

    def texts(batches):
        for pairs in fingerprints.neighbours(batches):
            yield pa.RecordBatch.from_arrays([pa.array([p.text for p in pairs], pa.string()), pa.array([p.next_text for p in pairs], pa.string())], names=["text", "behind"])

    got = {r["text"]: r["behind"] for r in dealt.mapInArrow(texts, "text string, behind string").collect()}
    hashed = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r[1]]))]
    assert got == {t: order[(i + 1) % len(order)] for i, t in enumerate(order)}


def test_a_hundred_languages(spark):
    """Every label is learned, however many there are."""
    rng = random.Random(8)
    rows = []
    for k in range(100):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 6)
        for i in range(24):
            words = ["".join(rng.choices(letters, k=rng.randint(3, 6))) for _ in range(60)]
            rows.append((k * 100 + i, " ".join(words), f"l{k:03d}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8)
    model = language.fit(docs.where("doc_id % 100 < 20"), "text", "lang", "doc_id")
    assert len(model.languages) == 100
    held = language.predict(docs.where("doc_id % 100 >= 20"), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.9


def test_samples_stay_bounded_under_one_id(spark):
    """Rows that share an id are not in a sample all together."""
    seen = {}

    def spy(module, name, label):
        whole = getattr(module, name)
        return lambda rows, *a, **b: seen.__setitem__(label, rows.num_rows if hasattr(rows, "num_rows") else len(rows)) or whole(rows, *a, **b)

    patch = pytest.MonkeyPatch()
    try:
        patch.setattr(quality, "train", spy(quality, "train", "quality"))
        patch.setattr(nearest, "balanced_centroids", spy(nearest, "balanced_centroids", "vectors"))
        train = language.train
        patch.setattr(language, "train", lambda names, rows, gap: seen.__setitem__("language", rows.num_rows) or train(names, rows, gap))
        docs = spark.range(6000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("some words "), F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.col("id").cast("string"))).alias("text"), F.lit("en").alias("lang"))
        language.fit(docs, "text", "lang", "doc_id", language.FitLimits(rows=100, per_language=100))
        labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, quality int")
        quality.fit(docs, labels, "doc_id", "quality", limits=quality.FitLimits(per_class=50))
        vectors = spark.range(6000).select(F.lit(7).cast("long").alias("id"), F.array(F.lit(1.0), F.when(F.col("id") % 2 == 0, F.lit(1.0)).otherwise(F.col("id").cast("double"))).alias("vec"))
        nearest.fit(vectors, nearest.IndexOptions(sample=200))
    finally:
        patch.undo()
    assert seen["language"] < 200 and 50 < seen["quality"] < 400 and seen["vectors"] < 400, seen


def test_archives_of_other_attempts_are_not_read(spark):
    pages = spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(40)], "page_id bigint, html string").repartition(3)
    folder = new_folder(spark, "warc-attempts")
    manifest = warc.write(pages, folder, "page_id", "html")
    raw = b"<p>stray</p>"
    with open(folder.removeprefix("file://") + "/part-000000-999999-00000.warc.gz", "wb") as f:
        f.write(warc.Record(99, None, raw, "response", None, warc.digest32(raw)).pack())
    assert sorted(r["page_id"] for r in warc.read_written(manifest).collect()) == list(range(40))
    assert warc.read(spark, folder).where("page_id = 99").count() == 1


def test_a_foreign_header_is_read():
    body = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <x>\r\nX-Page-ID: seven\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (batch,) = warc._records("p", body, True)
    row = batch.to_pylist()[0]
    assert (row["page_id"], row["record_type"], row["payload"], row["payload_bytes"], row["failure"]) == (None, "resource", b"hi", 2, None)


def test_one_payload_of_most_pages(spark, monkeypatch):
    """Hot payloads are marked without being dealt by digest; the others by digest."""
    monkeypatch.setattr(warc, "HOT", 3)
    rows = [(i, "same" if i % 2 else "rare" if i % 10 == 0 else f"own {i}") for i in range(100)] + [(None, "same")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id bigint, html string").repartition(4), "page_id", "html").collect()
    last = {"same": 99, "rare": 90}
    want = {(i, last.get(body) if i != last.get(body) else None) for i, body in rows}
    assert {(r["page_id"], r["refers_to"]) for r in got} == want and len(got) == len(rows)


def test_decoding_against_loops():
    rng = np.random.default_rng(1)
    code = language.codewords(12)
    trust = rng.random(code.shape[1])
    model = language.LanguageModel(tuple("abcdefghijkl"), code, None, None, trust / trust.sum(), 0.02)
    margins = rng.normal(size=(40, code.shape[1]))
    best, score, doubt = model.decode(margins)
    for row, k, s, d in zip(margins, best, score, doubt):
        distance = [sum(t * math.log1p(math.exp(-c * m)) for t, c, m in zip(model.trust, word, row)) for word in code.tolist()]
        order = sorted(range(12), key=lambda i: distance[i])
        assert k == order[0] and d == (distance[order[1]] - distance[order[0]] < 0.02)
        assert abs(s - 1 / sum(math.exp(-code.shape[1] / 2 * (x - distance[order[0]])) for x in distance)) < 1e-9


def test_updates_against_a_plain_loop():
    """Follow the regularised leader, feature by feature, over the same order of rows."""
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 2)), np.sort(rng.choice(50, 6, replace=False)).astype(np.int32), rng.random(6).astype(np.float32)) for _ in range(80)]
    table = pa.table({"_label": pa.array([r[0] for r in rows], pa.int32()), "ids": pa.array([r[1] for r in rows], pa.list_(pa.int32())), "vals": pa.array([r[2] for r in rows], pa.list_(pa.float32()))}).combine_chunks()
    model = quality.train(table, {0: 2.0, 1: 1.0})
    ordered = sorted(range(80), key=lambda i: (rows[i][0], rows[i][1].tobytes(), rows[i][2].astype(float).tobytes()))
    shuffle = np.random.default_rng(5)
    z, n = {}, {}

    def weight(key, l1, l2):
        value = z.get(key, 0.0)
        return 0.0 if abs(value) <= l1 else -(value - math.copysign(l1, value)) / ((quality._BETA + math.sqrt(n.get(key, 0.0))) / quality._ALPHA + l2)

    for _ in range(quality._EPOCHS):
        for i in shuffle.permutation(np.array(ordered)):
            label, ids, values = rows[i]
            features = [(int(k), float(v), weight(int(k), quality._L1, quality._L2)) for k, v in zip(ids, values)]
            features.append(("bias", 1.0, weight("bias", 0.0, 0.0)))
            p = 1 / (1 + math.exp(-sum(v * w for _, v, w in features)))
            for key, value, w in features:
                g = (p - label) * (2.0 if label == 0 else 1.0) / 2.0 * value
                z[key] = z.get(key, 0.0) + g - (math.sqrt(n.get(key, 0.0) + g * g) - math.sqrt(n.get(key, 0.0))) / quality._ALPHA * w
                n[key] = n.get(key, 0.0) + g * g
    want = [weight(k, quality._L1, quality._L2) for k in range(50)]
    assert np.allclose(model.weights[:50], want, atol=1e-9) and abs(model.bias - weight("bias", 0.0, 0.0)) < 1e-9


@pytest.mark.parametrize("slack", [0.0, 0.3])
def test_the_ring_against_row_by_row_insertion(slack):
    rng = random.Random(int(10 * slack))
    for _ in range(30):
        shards = rng.randint(1, 6)
        _, owner = ring.ring(shards, 8)
        counts = {arc: rng.choice([1, 2, 5, 60]) for arc in rng.sample(range(len(owner)), rng.randint(1, len(owner)))}
        limits = ring.bounds(sum(counts.values()), shards, slack)
        load, where = [0] * shards, {}
        for step in range(len(owner)):
            for arc in sorted(counts):
                for rank in range(counts[arc]):
                    shard = int(owner[(arc + step) % len(owner)])
                    if (arc, rank) not in where and load[shard] < limits[shard]:
                        where[arc, rank] = (shard, load[shard])
                        load[shard] += 1
        table = ring.allocate(counts, owner, limits).tolist()
        got = {}
        for at, (arc, first, shard, slot) in enumerate(table):
            stop = table[at + 1][1] if at + 1 < len(table) and table[at + 1][0] == arc else counts[arc]
            got |= {(arc, rank): (shard, slot + rank - first) for rank in range(first, stop)}
        assert got == where


def test_walks_leave_far_centroids_alone():
    """In clustered data a walk ends at the ratio, long before it has met every centroid."""
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(60, 32))
    points = np.repeat(middles, 50, axis=0) + 0.15 * rng.normal(size=(3000, 32))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centroids = nearest.centroid_graph(points)
    queries = middles[:20] / np.linalg.norm(middles[:20], axis=1, keepdims=True)
    met = np.isfinite(centroids.walk(queries, 0.5, 16)).sum(axis=1)
    options = nearest.IndexOptions(ratio=0.5)
    lists = centroids.lists_for(queries, options)
    distance = np.sqrt(np.maximum(0, 2 - 2 * queries @ points.T))
    recall = [len(set(own) & set(np.flatnonzero(d <= 1.5 * d.min()))) / (d <= 1.5 * d.min()).sum() for own, d in zip(lists, distance)]
    assert met.mean() < 0.5 * len(points) and min(recall) >= 0.9


def test_recall_with_thousands_of_centroids():
    """Centroids and lists as the index makes them, against brute force; walks choose what is read."""
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(400, 48))
    vectors = np.concatenate([m + 0.7 * rng.normal(size=(100, 48)) for m in middles])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    options = nearest.IndexOptions()
    centroids = nearest.centroid_graph(nearest.balanced_centroids(vectors[::4][:10_000], 2048, rounds=4))
    lists = [[] for _ in range(2048)]
    for at in range(0, len(vectors), 4096):
        for i, own in enumerate(centroids.lists_of(vectors[at : at + 4096], options)):
            for c in own:
                lists[c].append(at + i)
    queries = np.arange(0, len(vectors), 500)
    found = []
    for q, own in zip(queries, centroids.lists_for(vectors[queries], options)):
        holders = np.unique(np.concatenate([np.array(lists[c], np.int64) for c in own]))
        true = np.argsort(-(vectors @ vectors[q]), kind="stable")[1:6]
        found.append(len(np.intersect1d(true, holders)) / 5)
    assert np.mean(found) >= 0.9
