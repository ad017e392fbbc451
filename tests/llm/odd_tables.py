import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A small documents table from ``(doc_id, text[, source])`` rows, with columns whose names operators use inside."""
    def make(rows, extra=False):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            from pyspark.sql import functions as F
            for name in ("row", "id", "d", "line", "key", "fp", "token", "tokens", "quality", "_gone", "_id", "nth", "copies",
                         "component_id", "spans", "_spans", "kept", "size", "target", "ids", "decoded", "x", "h"):
                df = df.withColumn(name, F.lit(name))
        return df
    return make
