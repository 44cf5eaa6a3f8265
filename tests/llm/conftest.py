import pytest

SF = "/root/testdata/sf0.001"

#: rows with nulls in every column, empty and blank texts, a repeated row, and a clashing extra column
EDGE = [(None, "a b c d e f"), (1, None), (2, ""), (3, " \t\n "), (4, "a b c d e f g"), (4, "a b c d e f g"), (5, "x" * 20000), (6, "ü" * 3000 + " é ö")]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").persist()


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture()
def edge(spark):
    rows = [(i, t, "en", None if k % 2 else "s", 1, "clash") for k, (i, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, id string")


@pytest.fixture()
def empty(edge):
    return edge.where("false")
