"""Small tables of the tests."""

from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class long, row string, _words string"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def odd_documents(spark, rows):
    """Documents (doc_id, text) with columns whose names the operators use inside."""
    full = [(i, t, "en", f"s{(i or 0) % 2}", len(t or ""), 5, "x", "y") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
