import pytest

from tidetable.llm.queries import queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, label string, _id string, piece string, ids string, shard string, quality int"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like outputs."""
    extra = ("s", "l", "i", "p", "x", "h", 1)
    words = "the quick brown fox jumps over the lazy dog and then it sleeps under an old tree near a river".split()
    long = " ".join(words[i % 19] + str(i % 97) for i in range(30_000))
    texts = [None, "", "   \n\t ", "12 34", "one", " ".join(words), " ".join(words), " ".join(words) + " today", long, "naïve café 漢字 😀\n\nनमस्ते"]
    rows = [(i, t, "en" if i % 2 else "fr", "src", 1, *extra) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, texts[5], None, None, None, *[None] * 7), (None, None, None, None, None, *[None] * 7)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def result(spark):
    """Rows of a registered query over the small tables, run once."""
    done = {}

    def rows(name):
        if name not in done:
            done[name] = queries()[name](spark, SF_DIR).collect()
        return done[name]

    return rows
