import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"
# Extra columns named like those that operators work with.
EXTRA = ["score", "fp", "component_id", "position", "slot", "lane", "number", "rank", "part", "__text", "label"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def edge_rows():
    long = " ".join(f"wort{i % 977} und die katze{i % 13}" for i in range(30_000))
    texts = [
        (0, "the cat sat on the mat and the dog sat on the cat", "en", "src0"),
        (1, None, None, None),
        (2, "", "en", "src1"),
        (3, " \t\n\x0b ", "en", ""),
        (4, "1234 5678 !!!", "de", "src0"),
        (5, long, "de", "src0"),
        (6, "the cat sat on the mat and the dog sat on the cat", "en", "src2"),
        (6, "the cat sat on the mat and the dog sat on the cat", "en", "src2"),
        (None, "die katze und der hund sind im haus und die maus ist im garten", "de", None),
        (-7, "Ünïcödé \U0001f600 ẞ straße é  x <|endoftext|> 'S don't", "xx", "src0"),
        (8, "a", None, "src5"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *["clash"] * len(EXTRA)) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def edge_docs(spark: SparkSession):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    return spark.read.parquet(f"{SF}/documents.parquet")


def roots(links, nodes):
    """The smallest node reachable from each node, by brute force."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="session")
def brute_roots():
    return roots
