import pytest
from llm_texts import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use inside.
CLASH = ["_id", "_text", "_row", "_range", "_key", "_n", "score", "start", "class_id", "a", "b", "_rep", "_kept", "spans"]


@pytest.fixture
def docs(spark):
    """make(texts or (id, text) pairs, clash=False) -> documents"""
    def make(rows, clash=False):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
        if clash:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit("clash").alias(c) for c in CLASH])
        return df.repartition(3)
    return make


@pytest.fixture
def odd():
    """Null, empty, blank, tiny and very long texts, ties and repeated rows."""
    return [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three four"), (6, prose(1, 60)), (6, prose(1, 60)),
            (7, prose(1, 60)), (8, prose(2, 9000)), (None, prose(3, 30)), (9, "é\U0001F642 " * 50), (10, "x" * 50_000)]
