import duckdb
import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# A documents table with further columns whose names the operators use themselves.
EXTRA = ["fp", "block", "size", "row", "token", "_n", "label", "words", "digest", "kind", "seq"]
SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
     StructField("source", StringType()), StructField("n_chars", LongType())]
    + [StructField(n, DoubleType()) for n in EXTRA])

LONG = "word " * 60_000 + "Idiot! mail a.b@c.de MIT License " + "x" * 50_000
TEXTS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta", "en", "a"),
    (2, "alpha  beta\tgamma delta\nepsilon zeta eta theta", "en", "a"),
    (2, "alpha  beta\tgamma delta\nepsilon zeta eta theta", "en", "a"),
    (3, "", "en", None),
    (4, None, None, "b"),
    (5, " \t\n\x0b\x0c\r ", "de", "b"),
    (6, LONG, "en", "c"),
    (None, "no id at all, but a text", "fr", "a"),
    (None, None, None, None),
    (7, "one", "es", "c"),
    (8, "one two", "es", "c"),
    (-9, "é è 😀   ß\x1c\x85", "fr", "é"),
    (10, "Alphabetagammadeltaepsilonzetaetatheta", "en", "a"),
    (9_007_199_254_740_993, "call +1 (017) 555-7713 or 1.2.3.4, 4111 1111 1111 1111", "en", "b"),
]


def rows_of(texts):
    return [(i, t, lang, source, len(t or ""), *[1.5] * len(EXTRA)) for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    nulls = [(None,) * len(SCHEMA)]
    return spark.createDataFrame(rows_of(TEXTS) + nulls, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="session")
def db(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con
