import pytest


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Makes documents with columns whose names an operator might use itself."""
    def make(rows, more="key string, size string, id string, row string, score string, words string, spans string"):
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {more}"
        extra = len(more.split(","))
        return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) + ("x",) * extra for i, t, lang, s in rows], schema)
    return make
