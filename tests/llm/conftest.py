import pytest
from pyspark.sql import DataFrame

DATA = "/root/testdata/sf0.001"


def documents(spark, rows, more="") -> DataFrame:
    """Documents of (doc_id, text, lang) rows, or of (doc_id, text)."""
    rows = [(*r, "en")[:3] for r in rows]
    return spark.createDataFrame([(i, t, lang, "src", None if t is None else len(t)) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture()
def docs(spark):
    return lambda rows: documents(spark, rows)


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the small test table."""
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
