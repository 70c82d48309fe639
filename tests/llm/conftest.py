import zlib

import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents table from (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""
    def build(rows, **extra):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        from pyspark.sql import functions as F
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df.repartition(3)
    return build


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
