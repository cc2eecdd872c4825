"""Token counts, encoding and decoding against the public libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidetable.llm import arrays, bpe, packing, scan, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LETTERS = list("abstmdrvleéß 12½²  \t\n ''''!?.漢ि😀_ thieon  ")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, size=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_scan_finds_the_borders_of_the_pattern():
    texts, pattern = random_texts(20_000), regex.compile(public_tokenizers.PATTERN)
    for a, b, points, offsets in arrays.text_chunks(pa.array(texts), 50_000):
        want = [offsets[i] + m.start() for i in range(b - a) for m in pattern.finditer(texts[a + i])]
        assert scan.token_starts(points, offsets).tolist() == want


def test_composition_is_associative():
    _, compose, functions, _ = scan.monoid()
    n = len(functions)
    table = compose.reshape(n, n)
    rng = np.random.default_rng(0)
    a, b, c = rng.integers(0, n, (3, 2000))
    assert (table[table[a, b], c] == table[a, table[b, c]]).all()


@pytest.mark.parametrize("size", [5, 49, 300, 4000])
def test_merging(library, size):
    vocab, rng = bpe.vocabulary(RANKS), random.Random(size)
    states = token_counts.PrefixStates(vocab)
    for _ in range(10):
        word = "".join(rng.choice("theinaé") for _ in range(size))
        merged = [vocab.ranks[t] for t in vocab.merge(word.encode())]
        assert merged == library.encode_ordinary(word)
        assert states.count(word.encode()) == len(merged)


def test_counts_of_every_prefix():
    tokenizer = Tokenizer.from_file(JSON)
    texts = random_texts(300, 20, 3)
    texts += [t + "<|endoftext|>" + t[:2] + "<|end" for t in texts[:40]] + ["<|endoftext|>"]
    for t in texts:
        want = [len(tokenizer.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert token_counts.text_prefix_counts(t, JSON) == want


def test_stored_prefixes_answer_budgets(spark):
    docs = spark.createDataFrame([("hello  world, it's  fine",), ("",), (None,)], "text string")
    stored = token_counts.prefix_counts(docs, JSON)
    rows = stored.select("text", "prefix_tokens", token_counts.longest_prefix(F.col("prefix_tokens"), 4).alias("fit"), token_counts.tokens_at(F.col("prefix_tokens"), 5).alias("five")).collect()
    for r in rows:
        want = [k for k, c in enumerate(r["prefix_tokens"]) if c <= 4]
        assert r["fit"] == max(want)
        assert r["five"] == (r["prefix_tokens"][5] if r["text"] else None)


def test_query_against_library(result, documents):
    tokenizer = Tokenizer.from_file(JSON)
    rows = result("op6_token_counts")
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]]["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
        assert len(tokenizer.encode(text[: r["fit_chars"]], add_special_tokens=False).ids) <= 1024


def test_round_trip_query(result, documents, library):
    rows = result("op8_bpe_round_trip")
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]]["text"] or ""
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("packed", [False, True])
def test_odd_rows_round_trip(odd_docs, no_docs, odd_rows, packed):
    out = bpe.decode(bpe.encode(odd_docs, RANKS, packed=packed), RANKS)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in rows)
    assert set(odd_docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    if not packed:
        for r in rows:
            raw = (r["text"] or "").encode()
            assert all(raw[o:].startswith(bpe.vocabulary(RANKS).tokens[i]) for i, o in zip(r["ids"], r["offsets"]))
    assert bpe.decode(bpe.encode(no_docs, RANKS, packed=packed), RANKS).count() == 0


def test_odd_rows_counts(odd_docs, no_docs, odd_rows, library):
    rows = token_counts.token_counts(odd_docs, JSON, 10).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r["n_tokens"] == len(library.encode_ordinary(r["text"] or ""))
        assert r["n_bytes"] == len((r["text"] or "").encode())
        assert r["score"] in ("s", None)
    assert token_counts.token_counts(no_docs, JSON, 10).count() == 0


def check_packing(rows, texts, capacity, encode=None):
    """Texts are cut as stated and sequences are gapless."""
    encode = encode or (lambda text: packing.encoder(JSON).encode(text, allowed_special="all"))
    by_row, by_sequence = {}, {}
    for r in rows:
        by_row.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for key, text in texts.items():
        ids = [*encode(text or ""), 2]
        parts = sorted(by_row[key], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // capacity)))
        assert all(r["length"] == capacity for r in parts[1:])
        at = 0
        for r in parts:
            import zlib

            own = ids[at : at + r["length"]]
            assert r["start"] == at and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence), sum(r["length"] for r in rows)


def test_packing_query(result, documents):
    bins, tokens = check_packing(result("op3_bin_slack_packing"), {k: r["text"] for k, r in documents.items()}, 1024)
    assert bins <= 1.02 * -(-tokens // 1024)


def test_odd_rows_packing(odd_docs, no_docs):
    own = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack_texts(own, JSON, 2, 16).collect()
    check_packing(rows, {r["doc_id"]: r["text"] for r in own.collect()}, 16)
    everything = packing.pack_texts(odd_docs, JSON, 2, 1024).collect()
    assert sum(r["doc_id"] is None for r in everything) == 2 and sum(r["doc_id"] == 5 for r in everything) == 3
    assert packing.pack_texts(no_docs, JSON, 2, 1024).count() == 0


def test_bin_slack_finds_the_fullest_combination():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(0, 60)
        items = [x for x, n in counts.items() for _ in range(n)]
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        got = packing.fullest(counts, room)
        assert all(c <= counts[x] for x, c in got)
        assert sum(x * c for x, c in got) == max(s for s in sums if s <= room)


def test_bin_slack_packs_everything_once():
    rng = random.Random(5)
    counts = {x: rng.randint(1, 5000) for x in rng.sample(range(1, 1025), 300)}
    plan = packing.minimum_bin_slack(counts, 1024)
    used = {}
    for b in plan:
        assert sum(x * c for x, c in b.content) <= 1024
        for x, c in b.content:
            used[x] = used.get(x, 0) + c * b.times
    assert used == counts
    large = sum(n for x, n in counts.items() if x > 512)
    least = max(large, -(-sum(x * n for x, n in counts.items()) // 1024))
    assert sum(b.times for b in plan) <= 1.05 * least + 1
