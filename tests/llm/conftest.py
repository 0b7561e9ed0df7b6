import pytest

from tests.conftest import SF001

LONG = "lorem ipsum dolor " * 9000          # some 160,000 characters


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from ledgerline.llm.ship import ship
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """{doc_id: text} of the small fixture."""
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


EDGE_ROWS = [
    (1, "one two three four five six seven eight nine ten"),
    (2, "ONE two  three four\tfive six seven eight nine ten"),
    (2, "ONE two  three four\tfive six seven eight nine ten"),          # a repeated row
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "short"),
    (7, "short"),
    (None, "one two three four five six seven eight nine ten"),
    (None, None),
    (8, LONG),
    (9, LONG + "end"),
    (2 ** 60 + 1, "ids beyond the integers that doubles hold"),
    (2 ** 60 + 3, "ids beyond the integers that doubles hold, and a neighbour of one"),
    (10, "naïve café — 東京 🙂 déjà vu naïve café — 東京 🙂 déjà vu and some more words to pass fifty bytes"),
    (11, "x naïve café — 東京 🙂 déjà vu naïve café — 東京 🙂 déjà vu and some more words to pass fifty bytes"),
]
CLASHING = ["grp", "kind", "bucket", "hub", "n", "id", "docs", "part", "source", "score", "component_id", "toks", "text2"]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with our own names."""
    rows = [(i, t, *[f"{c}-{k}" if k % 3 else None for c in CLASHING]) for k, (i, t) in enumerate(EDGE_ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING))


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
