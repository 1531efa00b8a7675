import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) pairs; other columns may be given by name."""

    def make(rows, **columns):
        full = [(i, t, "en", None, len(t) if t is not None else None) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F

        return df.withColumns({k: F.lit(v) for k, v in columns.items()}) if columns else df

    return make
