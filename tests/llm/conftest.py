import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
    ]
)
#: Names that operators use for their own columns.
CLASHES = ["size", "kept", "row", "fp", "piece", "k", "t", "s", "c", "p", "h", "key", "spans", "sig", "part", "a.b", "copies", "target", "rank"]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) with clashing extra columns."""

    def build(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src", None) for r in rows]
        if not extra:
            return spark.createDataFrame(full, DOCS)
        schema = T.StructType(DOCS.fields + [T.StructField(n, T.StringType()) for n in CLASHES])
        return spark.createDataFrame([r + ("x",) * len(CLASHES) for r in full], schema)

    return build


@pytest.fixture(scope="session")
def duck():
    from tools.check_oracle import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()
