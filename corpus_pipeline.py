"""Four stages from raw documents to packed sequences: quality, language, near copies, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what it keeps.  All but the last
return the columns of ``docs`` unchanged, whatever they are called.  ``run`` writes each stage's result and reads it back,
so a lost executor costs no more than the stage it was in.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidetable.llm import jaccard_join, language, packing, quality
from tidetable.llm.common import held_out, partitions, table
from tidetable.session import materialize

#: A score below this is low quality; words of a shingle and the least similarity of near copies in hundredths.
QUALITY, WORDS, PERCENT = 0.3, 5, 80
CAPACITY, END_ID = 1024, 2


def _private(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns renamed by position, so that no stage meets a name twice, and the names to give back."""
    return docs.toDF(*(f"_c{i}" for i in range(len(docs.columns)))), docs.columns


def _named(docs: DataFrame, name: str) -> str:
    return f"_c{docs.columns.index(name)}"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is high enough; the model learns from labels outside fold 0."""
    rows, names = _private(docs)
    doc_id, text = _named(docs, "doc_id"), _named(docs, "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias(doc_id), "quality")
    model = quality.fit(rows, labels, doc_id, "quality", text)
    kept = quality.score(rows, model, text, threshold=QUALITY).where("predicted = 1")
    return kept.select(*rows.columns).toDF(*names)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is not ambiguous; the model learns from ``lang`` outside fold 0."""
    rows, names = _private(docs)
    doc_id, text, lang = (_named(docs, c) for c in ("doc_id", "text", "lang"))
    model = language.fit(rows.where(~held_out(F.col(doc_id))), text, lang, doc_id)
    kept = language.predict(rows, model, text).where(~F.col("ambiguous"))
    return kept.select(*rows.columns).toDF(*names)


def _numbered(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``_id`` in place of ``_own``: one number for each ``_own``, in their order, then for each text without one."""
    digest = F.when(F.col("_own").isNull(), F.sha2(F.col(text), 256))
    keys = rows.select(F.col("_own").alias("_key"), digest.alias("_digest")).distinct()
    order = [F.asc_nulls_last("_key"), F.col("_digest")]
    dealt = keys.repartitionByRange(partitions(rows), *order).sortWithinPartitions(*order)
    # the numbers are written, so a repeated task finds the same ones
    numbers = materialize(dealt.withColumn("_id", F.monotonically_increasing_id()), "numbers")
    same = F.col("_own").eqNullSafe(F.col("_key")) & digest.eqNullSafe(F.col("_digest"))
    return materialize(rows.join(numbers, same).drop("_own", "_key", "_digest"), "numbered")


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id.

    Rows of one id are one document, of which the text with the smallest hash stays; a document without an id goes by its
    text and stands behind all ids.  Rows without id and text have nothing to compare and stay.
    """
    rows, names = _private(docs)
    doc_id, text = _named(docs, "doc_id"), _named(docs, "text")
    bare = F.col(doc_id).isNull() & F.col(text).isNull()
    rest, rows = rows.where(bare), rows.where(~bare).withColumn("_own", F.col(doc_id).cast("long"))
    if rows.where("_own IS NULL").limit(1).count():
        rows = _numbered(rows, text)
    else:
        rows = rows.withColumnRenamed("_own", "_id")
    found = jaccard_join.near_copies(rows, jaccard_join.Measure(WORDS, PERCENT), "_id", text)
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    first = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64(text)))
    kept = rows.join(stays, "_id", "left_semi").withColumn("_first", first).where("_first = 1")
    return kept.drop("_id", "_first").select(*rest.columns).unionByName(rest).toDF(*names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most ``CAPACITY`` ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_texts(docs.select("doc_id", "text"), path, END_ID, CAPACITY)


STAGES = [("quality", good_quality), ("language", known_language), ("near copies", distinct_content), ("packing", packed)]

#: No SQL: the models and the tokeniser have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
