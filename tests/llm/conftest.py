import pytest

LONG = "word " * 30_000 + "end"
PROSE = "the quick brown fox jumps over the lazy dog while nine old wizards quietly boil some very strange green soup tonight"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, repeated ids, clashing column names."""
    rows = [
        (1, PROSE, "en", "a"),
        (1, PROSE, "en", "a"),
        (1, PROSE + " indeed", "en", "a"),
        (2, PROSE, None, None),
        (3, "", "en", "b"),
        (4, None, "fr", "b"),
        (5, " \n\t ", "fr", None),
        (6, LONG, "en", "a"),
        (7, "é à ü 漢字   \U0001f600 x", "de", "c"),
        (None, PROSE, "en", "c"),
        (None, None, None, None),
        (8, "one\ntwo\none", "en", "c"),
    ]
    clash = "1 as id, 2 as block, 3 as row, 4 as key, 5 as h, 6 as size, 7 as n, 8 as place, 9 as class, 10 as digest, 11 as shard, 12 as at, 13 as words, 14 as __id, 15 as __digest, 16 as __source, 17 as __shard, 18 as __order, 19 as pick_id, 20 as gone_id, 21 as pick_order, 22 as gone_digest, 23 as source_size"
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def plain_documents(documents):
    """(doc_id, text, source) of all documents, by id."""
    return [(r.doc_id, r.text, r.source) for r in documents.orderBy("doc_id").collect()]
