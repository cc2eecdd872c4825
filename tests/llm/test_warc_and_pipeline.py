"""Archives and their damage; the pipeline against its parts."""

import io
import random

import pytest
from oracle import compare, connect

import corpus_pipeline
from tidetable.llm import packing, warc
from tidetable.llm.queries import oracle_sql, queries
from tidetable.session import new_folder

SF = "/root/testdata/sf0.001"


def record(i, body=None, kind="response", refers=None):
    raw = (body if body is not None else f"<p>page {i}</p>" * (i + 1)).encode()
    return warc.Record(i, f"http://h/{i}", raw, kind, refers, warc.digest32(raw))


def test_query_against_sql(spark):
    assert compare(queries()["op9_warc_salvage"](spark, SF), connect(SF), oracle_sql()["op9_warc_salvage"]) == []


def plain(r):
    import gzip

    return gzip.decompress(r.pack())


@pytest.mark.parametrize("form", ["gzip", "plain"])
def test_every_kind_of_damage(form):
    make = (lambda r: r.pack()) if form == "gzip" else plain
    parts = [make(record(i)) for i in range(6)]
    whole = b"".join(parts)
    assert [h["x-page-id"] for _, _, h, _, f in warc.salvage(whole) if f is None] == list("012345")
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    rng = random.Random(1)
    for _ in range(60):
        k = rng.randrange(6)
        kind = rng.choice(["flip", "cut", "noise"])
        if kind == "flip":
            at = starts[k] + rng.randrange(12, len(parts[k]) - 8) if form == "gzip" else whole.index(b"<p>", starts[k]) + 1
            data = whole[:at] + bytes([whole[at] ^ 0x55]) + whole[at + 1 :]
        elif kind == "cut":
            at = starts[k] + rng.randrange(1, len(parts[k]))
            data = whole[:at] + whole[starts[k + 1] :]
        else:
            data = whole[: starts[k]] + bytes(rng.randrange(256) for _ in range(50)) + whole[starts[k] :]
        found = list(warc.salvage(data))
        assert found == list(warc.salvage(data, step=rng.choice([1, 7, 64, 300])))
        kept = [int(h["x-page-id"]) for _, _, h, _, _ in found if h]
        assert set(range(6)) - set(kept) <= ({k} if kind != "noise" else set())
        # records and gaps cover every byte once
        assert found[0][0] == 0 and found[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(found, found[1:]))
        assert any(f for *_, f in found) or kept == list(range(6))


def test_archives_without_a_record():
    assert list(warc.salvage(b"")) == []
    assert [(s, e) for s, e, *_ in warc.salvage(b"not an archive")] == [(0, 14)]


class Watched(io.BytesIO):
    """Bytes that know how many of them have been read."""

    taken = 0

    def read(self, size=-1):
        got = super().read(size)
        self.taken = max(self.taken, self.tell())
        return got


@pytest.mark.parametrize("form", ["gzip", "plain"])
def test_an_archive_is_read_as_a_stream(form):
    make = (lambda r: r.pack()) if form == "gzip" else plain
    parts = [make(record(i % 50)) for i in range(400)]
    parts[200] = make(record(7, "x" + "".join(map(str, range(60_000)))))
    bad = 150
    parts[bad] = parts[bad][5:]
    source = Watched(b"".join(parts))
    kept = gaps = longest = 0
    for start, end, head, _, failure in warc.salvage(source, step=4096):
        kept, gaps = kept + (head is not None), gaps + (failure is not None)
        longest = max(longest, end - start)
        # no more is read ahead than twice the longest record so far and a few steps
        assert source.taken <= end + 2 * longest + 4 * 4096
    assert longest > 10 * 4096
    assert (kept, gaps) == (len(parts) - 1, 1)


def test_a_record_longer_than_the_bound_is_a_gap(monkeypatch):
    parts = [plain(record(1)), plain(record(2, "y" * 5000)), plain(record(3))]
    monkeypatch.setattr(warc, "LONGEST", 1000)
    found = [(h and h["x-page-id"], f) for _, _, h, _, f in warc.salvage(b"".join(parts))]
    assert found == [("1", None), (None, "length"), ("3", None)]
    packed = [record(1).pack(), record(2, "y" * 5000).pack(), record(3).pack()]
    assert [h and h["x-page-id"] for _, _, h, _, _ in warc.salvage(b"".join(packed))] == ["1", None, "3"]


def test_large_archives_are_opened_where_they_lie(spark):
    pages = spark.createDataFrame([(i, f"<p>{i % 7}</p>" * 40) for i in range(60)], "page_id bigint, html string")
    folder = new_folder(spark, "warc-large")
    warc.write(pages.coalesce(1), folder, "page_id", "html", archive_bytes=2000)
    with open(folder.removeprefix("file://") + "/broken.warc.gz", "wb") as f:
        f.write(record(70).pack()[:-9] + b"?" * 3000 + record(71).pack())
    columns = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "start", "end", "failure"]
    whole, streamed = (sorted(map(str, warc.read(spark, folder, whole_bytes=n).select(*columns).collect())) for n in (1 << 20, 0))
    assert whole == streamed and len(whole) == 62


def test_revisits_and_gaps_in_a_folder(spark):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (None, "b"), (6, "c"), (6, "d"), (9, "é" * 100_000), (7, "a")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string").withColumn("records", pytest.importorskip("pyspark.sql.functions").lit(1))
    folder = new_folder(spark, "warc-test")
    warc.write(pages.repartition(2), folder, "page_id", "html", archive_bytes=300)
    path = folder.removeprefix("file://")
    got = {(r["page_id"], r["payload_digest"]): r for r in warc.read(spark, folder).collect()}
    assert len(got) == len(rows)
    for i, body in rows:
        raw = (body or "").encode()
        r = got[(i, warc.digest32(raw))]
        last = max(k for k, b in rows if (b or "").encode() == raw and k is not None)
        assert (r["record_type"], r["refers_to"], r["payload_bytes"]) == (("response", None) if i == last else ("revisit", last)) + (len(raw),)
        assert r["failure"] is None and (r["payload"] is None) == (r["record_type"] == "revisit")
    with open(f"{path}/broken.warc.gz", "wb") as f:
        f.write(record(20).pack() + b"\x1f\x8b\x08 no member" + record(21).pack())
    out = warc.read(spark, folder).where("path LIKE '%broken%'").collect()
    assert sorted(r["page_id"] for r in out if r["page_id"]) == [20, 21]
    gap = [r for r in out if r["failure"]]
    assert len(gap) == 1 and gap[0]["end"] - gap[0]["start"] == 13


def test_empty_table_of_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, html string"), "page_id", "html").count() == 0


def test_pipeline(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [set(documents)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append({r["doc_id"] for r in docs.collect()})
        assert kept[-1] <= kept[-2]
    good = {i for i in kept[0] if quality.get(i) == 1}
    assert len(good & kept[1]) >= 0.95 * len(good)
    assert len(kept[2]) >= 0.98 * len(kept[1])
    # the third stage keeps one of each group, as all pairs give it
    from test_near_copies import brute

    want = brute([(i, documents[i]["text"]) for i in kept[2]], corpus_pipeline.jaccard_join.Measure(5, 80))
    assert kept[3] == {i for i, (_, c) in want.items() if c == i}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in rows} == kept[3]
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows} == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF).collect()}


def test_stages_on_odd_rows(spark, odd_docs, no_docs, odd_rows):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, SF)
        assert out.schema.names == odd_docs.schema.names, name
        rows = out.collect()
        assert len(rows) <= len(odd_rows) and all(r["score"] in ("s", None) and r["shard"] in ("h", None) for r in rows)
        assert stage(spark, no_docs, SF).count() == 0
    near = corpus_pipeline.distinct_content(spark, odd_docs, SF).collect()
    assert sum(r["text"] == odd_rows[5][1] for r in near) == 1 and sum(r["text"] is None for r in near) == 2
    assert packing.pack_texts(odd_docs.select("doc_id", "text"), corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"), 2, 1024).count() >= len(odd_rows)


def test_rows_without_id_and_text_meet_no_document(spark):
    """A null text hashes to 42, and document 42 has a text of a greater hash; texts without id are still compared."""
    text = "a b c d e f g h"
    rows = [(42, "one two three four five six"), (None, None), (None, None), (7, text), (None, text), (None, "p q r s t u v"), (None, "p q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert docs.where("doc_id = 42 AND xxhash64(text) > 42").count() == 1
    near = [tuple(r) for r in corpus_pipeline.distinct_content(spark, docs, SF).collect()]
    assert sorted(near, key=str) == sorted([*rows[:4], rows[5]], key=str)
