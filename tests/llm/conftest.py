import pytest

SF = "/root/testdata/sf0.001"

# doc_id, text, lang, extra column whose name an operator writes
EDGES = [
    (None, None, None, 1),
    (1, None, "en", 2),
    (2, "", "en", 3),
    (3, "   \n\t\n ", "en", 4),
    (4, "one", "en", 5),
    (5, "the same words of a text\nthat has three lines\nin all of them\nand a fourth", "en", 6),
    (5, "the same words of a text\nthat has three lines\nin all of them\nand a fourth", "en", 6),
    (6, "the same words of a text\nthat has three lines\nin all of them\nand a fourth", None, 7),
    (7, "日本語のテキスト " * 30 + "🙂 ß Σ", "ja", 8),
    (8, "a" * 30_000, "en", 9),
    (9, " ".join(["word"] * 20_000), "en", 10),
    (None, "a text without an id that still has five words or more", "en", 11),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, kept int"


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, EDGE_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """(doc_id, text, lang) of the small documents table."""
    return [(r["doc_id"], r["text"], r["lang"]) for r in documents.collect()]
