import duckdb
import pytest

SF = "/root/testdata/sf0.01"

# Null, empty, blank, one word, repeated row, non-ASCII, control characters, a very long text.
EDGE = [(None, "no id", "en"), (1, None, "en"), (2, "", None), (3, "  \n\t ", "fr"), (4, "one", "en"), (5, "twin row of text", "en"),
        (5, "twin row of text", "en"), (6, "Ünïcödé ẞ ﬁ 🙂 à — “q”", None), (7, "tab\tvt\x0bnul\x00nbsp  end", "de"),
        (8, "word " * 30_000, "en"), (9, "<|endoftext|> don't </w>\r\nx", "en")]


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows, with extra columns named like outputs of the operators."""
    rows = [(*r, 1, "clash", 2.5) for r in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, ids string, score double")


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.where("doc_id = -99")
