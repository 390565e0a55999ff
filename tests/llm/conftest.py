import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(id, text)`` pairs, with clashing extra columns where wanted."""
    from pyspark.sql import functions as F

    def build(rows, extra=False, lang="en"):
        rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(rows, SCHEMA)
        if extra:
            for name in ("row", "u", "h", "k", "score", "spans", "items", "words", "family", "share", "doc", "label", "next", "part"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return build


ODD = [(None, "lost words"), (None, None), (1, None), (2, ""), (2, ""), (3, "!!! ???"), (4, "word"), (5, "x" * 200_000), (6, "a b " * 20_000)]


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and very long texts, repeated rows and ties."""
    return ODD
