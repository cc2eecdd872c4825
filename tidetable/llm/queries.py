"""The catalogue queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidetable.llm import bpe, columnar, fingerprints, jaccard_join, language, lexical, nearest, packing, periodic, quality, ring, token_counts, warc
from tidetable.llm.common import held_out, table

BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"


def _text_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of packed ids, written as decimals with one space between, and of decoded bytes."""
    numbers: list[bytes] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            ids, bounds = bpe.unpack(part.column(part.schema.names.index("ids")))
            if len(ids) and int(ids.max()) >= len(numbers):
                numbers = [b"%d" % i for i in range(int(ids.max()) + 1)]
            digests = [hashlib.sha256(b" ".join([numbers[i] for i in ids[a:b].tolist()])).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            decoded = part.column(part.schema.names.index("decoded"))
            columns = {
                "doc_id": part.column(part.schema.names.index("doc_id")),
                "n_tokens": pa.array(bounds[1:] - bounds[:-1], pa.int64()),
                "ids_sha256": pa.array(digests, pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in decoded], pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's fingerprint beside that of its edited text and of the next document."""
    for pairs in fingerprints.neighbours(batches):
        edited = [p.text[: len(p.text) - len(p.text) // 3] + p.next_text[: len(p.text) // 3] for p in pairs]
        marks, new, after = [p.mark for p in pairs], fingerprints.fingerprints_of(pa.array(edited, pa.string())), [p.next_mark for p in pairs]
        columns = {
            "doc_id": pa.array([p.row_id for p in pairs], pa.int64()),
            "n_chars": pa.array([len(p.text) for p in pairs], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            "fingerprint": pa.array(map(fingerprints.as_text, marks), pa.string()),
            "edited_fingerprint": pa.array(map(fingerprints.as_text, new), pa.string()),
            "near_edited": pa.array(fingerprints.likeness(marks, new)),
            "near_next": pa.array(fingerprints.likeness(marks, after)),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _made_periodic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of which each tenth, by crc32 of its id, repeats some words from a place on; a null id changes nothing."""

    def changed(doc_id: int, text: str | None) -> str | None:
        g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if rest or not (words := (text or "").encode().split()):
            return text
        n = len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]).decode()

    for batch in batches:
        ids, texts = (batch.column(batch.schema.names.index(c)) for c in ("doc_id", "text"))
        new = [t if i is None else changed(i, t) for i, t in zip(ids.to_pylist(), texts.to_pylist())]
        yield pa.RecordBatch.from_arrays([ids, pa.array(new, pa.large_string())], names=["doc_id", "text"])


def _run_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[(r["start"], r["length"], r["period"]) for r in own] for own in batch.column(batch.schema.names.index("runs")).to_pylist()]
        best = [periodic.best_run(own) for own in found]
        listed = ["".join("%d,%d,%d\n" % r for r in own) for own in found]
        long = lambda values: pa.array(values, pa.int64())
        columns = {
            "doc_id": batch.column(batch.schema.names.index("doc_id")),
            "n_runs": long([len(own) for own in found]),
            **{name: long([r and r[at] for r in best]) for at, name in enumerate(("start", "length", "period"))},
            "exponent_milli": long([r and 1000 * r[1] // r[2] for r in best]),
            "runs_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed], pa.string()),
            "collapsed_sha256": pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column(batch.schema.names.index("collapsed"))], pa.string()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def op1_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the rows outside fold 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = language.fit(docs.where(~F.col("held_out")), "text", "lang", "doc_id")
    return language.predict(docs, model, keep=["doc_id", "held_out"])


def op2_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 hundredths of their 4-word shingles."""
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"), jaccard_join.Measure(4, 85))


def op3_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts, tokenised, in sequences of at most 1024 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_texts(docs, public_tokenizers.path(BPE_JSON), 2, 1024)


def op4_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and of their edits, and how alike they are."""
    dealt = fingerprints.dealt_by_range(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(_edited, schema)


def op5_balanced_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all vectors for every fiftieth."""
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text by prefix dynamic programming, and what a budget of 1024 tokens keeps."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path(BPE_JSON), 1024, keep=["doc_id"])


def op7_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learned from the labels outside fold 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = quality.fit(docs, labels, "doc_id", "quality")
    return quality.score(docs, model, keep=["doc_id", "held_out"])


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and their decoding, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(BPE_RANKS)
    encode, decode = bpe.encoding(path, ["doc_id"], packed=True), bpe.decoding(path)
    digests = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.mapInArrow(lambda batches: _text_digests(decode(encode(batches))), digests)


def op9_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back from the archives."""
    records = warc.round_trip(table(spark, sf_dir, "pages"), "page_id", "html", "url").where("failure IS NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts; equal texts have one key."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_key")
    )
    placed = ring.assign(docs, F.col("_key"), 16, ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least six words and four periods in every whole text, of which each tenth is made periodic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.detecting(periodic.Rule(6, 4), ["doc_id"])
    digests = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    return docs.mapInArrow(lambda batches: _run_digests(found(_made_periodic(batches))), digests)


def op12_ranked_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op13_columnar_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty greatest inner products of whole vectors for every twentieth."""
    return columnar.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20, scale=64.0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_codes, op2_grouped_prefix_join, op3_bin_slack_packing, op4_multiset_fingerprints, op5_balanced_postings, op6_token_counts,
    op7_quality_ftrl, op8_bpe_round_trip, op9_warc_salvage, op10_bounded_ring, op11_periodic_runs, op12_ranked_intervals,
    op13_columnar_topk,
)}
SQL: dict[str, str] = {
    "op2_grouped_prefix_join": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM sets d JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, d.s
""",
    "op9_warc_salvage": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex, max(page_id) OVER (PARTITION BY sha1(body)) AS last FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
         16 * strpos('0123456789abcdef', substr(hex, CAST(i * 5 // 4 + 1 AS INT), 1)) - 16
         + coalesce(nullif(strpos('0123456789abcdef', substr(hex || '0', CAST(i * 5 // 4 + 2 AS INT), 1)), 0), 1) - 1
       ) AS INT) // (8 // CAST(power(2, i * 5 % 4) AS INT)) % 32, 1) FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM h
""",
    "op12_ranked_intervals": """
WITH t AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
  FROM documents),
sizes AS (SELECT d, doc_id, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
items AS (
  SELECT row_number() OVER () AS q, item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
  FROM benchmark),
asked AS (SELECT q, item_id, term, count(*) AS times FROM items GROUP BY ALL),
words AS (SELECT d, unnest(w) AS term FROM t),
tf AS (SELECT d, term, CAST(count(*) AS BIGINT) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs),
impact AS (
  SELECT tf.d, s.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * s.n * total.docs) // total.terms))) AS i
  FROM tf JOIN sizes s ON s.d = tf.d JOIN weights w ON w.term = tf.term, total),
scores AS (SELECT a.q, a.item_id, i.d, i.doc_id, CAST(sum(a.times * i.i) AS BIGINT) AS score FROM asked a JOIN impact i ON i.term = a.term GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op13_columnar_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
