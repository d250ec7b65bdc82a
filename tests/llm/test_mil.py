import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from skytrace.llm import mil

LABELS = "doc_id long, quality int, toxic int"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, at, y = rng.normal(size=(11, 7)), np.array([0, 1, 5, 11]), np.array([1.0, 0.0, 1.0])
    m = mil.Attention(np.zeros(7), np.ones(7))

    def loss():
        s, _ = m.forward(x, at)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name, g in m.gradients(x, at, y).items():
        for i in list(np.ndindex(g.shape))[::5]:
            old = m.p[name][i]
            m.p[name][i] = old + 1e-5
            up = loss()
            m.p[name][i] = old - 1e-5
            down = loss()
            m.p[name][i] = old
            assert g[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_passages_do_not_depend_on_the_batch():
    texts = ["", prose(1, 10), prose(2, 100) + "\n\n", "  " + prose(3, 64), "x", "é!! " * 70, " "]
    every, at = mil.passages(pa.array(texts))
    assert np.diff(at).tolist() == [1, 1, 4, 2, 1, 3, 1]
    for k, t in enumerate(texts):
        alone, own = mil.passages(pa.array([t]))
        assert np.allclose(alone, every[at[k]:at[k + 1]]) and own[-1] == at[k + 1] - at[k]


def test_learns_labels_and_scores_all_rows(spark, docs, odd):
    good = [(i, prose(i, 40 + i % 90)) for i in range(1000, 1200)]
    bad = [(i, prose(i, 40 + i % 90).upper().replace(" ", "!! ")) for i in range(2000, 2200)]
    df = docs(good + bad + odd, clash=True)
    labels = [(i, int(i < 2000), 0) for i, _ in good + bad] + [(None, 1, 0), (1000, None, 0), (5, 7, 0), (99_999, 1, 0)]
    known = spark.createDataFrame(labels, LABELS)
    model = mil.train(df, known, known["doc_id"] % 4 != 2)
    out = mil.score(df, model).collect()
    assert len(out) == len(good) + len(bad) + len(odd) and all(0 <= r._score <= 1 for r in out)
    held = [r for r in out if r._row.doc_id is not None and r._row.doc_id >= 1000 and r._row.doc_id % 4 == 2]
    assert np.mean([(r._score >= 0.7) == (r._row.doc_id < 2000) for r in held]) > 0.97
    texts = {}
    for r in out:
        assert texts.setdefault(r._row.text or "", r._score) == pytest.approx(r._score)
    kept = mil.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r._score >= 0.7 for r in out)


def test_without_labels(spark, docs):
    df = docs([(1, "a"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    assert mil.train(df, none, F.lit(True)) == 0.5
    one = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert [r._score for r in mil.score(df, mil.train(df, one, F.lit(True))).collect()] == [1.0, 1.0]
    assert mil.score(df.limit(0), 0.5).count() == 0
