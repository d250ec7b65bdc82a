import numpy as np
import pytest
from pyspark.sql import functions as F

from skytrace.llm import vamana as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)


def brute(rows, k):
    """Exact answers of the rows whose id is divisible by 20, over distinct (id, vector) rows that take part."""
    good = {(i, tuple(np.float32(x) + np.float32(0) for x in v)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    out = {}
    for i in {i for i, _ in good if i % 20 == 0}:
        best = {}
        for a in [v for j, v in good if j == i]:
            for j, b in good:
                if j != i and len(a) == len(b):
                    s = float(np.dot(np.array(a, float), np.array(b, float)))
                    best[j] = max(s, best.get(j, -np.inf))
        out[i] = sorted(((-s, j) for j, s in best.items()))[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def ask(spark, rows, k=20, **kw):
    return answers(V.nearest(frame(spark, rows), F.col("_id") % 20 == 0, k, **kw))


def test_recall_and_scores_over_shards(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 24)) * r.uniform(0.2, 3, size=(3000, 1))  # lengths differ, so distance and product do
    x[1000:2000] = x[1000] + r.normal(size=(1000, 24)) * 0.05  # a third are near copies
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got, want = ask(spark, rows, shard=700), brute(rows, 20)
    assert got.keys() == want.keys() and all(len(a) == 20 for a in got.values())
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.95
    for q in list(want)[:40]:
        for s, j in got[q]:
            assert s == pytest.approx(-np.dot(np.float32(x[q]).astype(float), np.float32(x[j]).astype(float)), abs=1e-9)


def test_odd_rows_and_copies(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in r.integers(-3, 4, 4)]) for i in range(60)]
    rows += [(i, [1.0, 2.0, 0.0, -1.0]) for i in range(100, 160)]  # one group of copies, with queries inside
    rows += [(100, [1.0, 2.0, 0.0, -1.0]), (200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 0.0, 0.0]),
             (280, [1.0, float("nan"), 0.0, 0.0]), (300, [1.0, float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]),
             (320, [1.0, 2.0]), (321, [2.0, -1.0]), (340, [5.0, 5.0, 5.0]), (40, [0.5, 0.5, -0.0, 0.0]), (41, [0.5, 0.5, 0.0, 0.0])]
    want = brute(rows, 20)
    want = {q: a for q, a in want.items() if a}  # the only vector of its length finds nothing
    got = ask(spark, rows)
    assert got == want
    assert [j for _, j in got[120]][0] != 120 and len(got[320]) == 1


def test_no_rows_and_clashing_columns(spark):
    assert V.nearest(frame(spark, []), F.col("_id") % 20 == 0).collect() == []
    rows = [(i, [float(i + 1), 1.0]) for i in range(30)]
    df = frame(spark, rows).select("*", *[F.lit(1).alias(c) for c in ("_id", "_vector", "a.b", "my-col", "rank")])
    assert answers(V.nearest(df, F.col("_id") % 20 == 0, 5)) == brute(rows, 5)


def test_every_point_is_reached():
    r = np.random.default_rng(1)
    points = np.concatenate([r.normal(size=(300, 8)) * 1e-3 + c for c in (0, 50, -80)]).astype(np.float32)
    graph = V.build_graph(points)
    seen, front = set(), {graph.entry}
    while front:
        seen |= front
        front = {int(j) for i in front for j in graph.edges[i] if j >= 0} - seen
    assert len(seen) == len(points)


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [5, 0]], np.float32)
    ids = np.array([[4, 2, 1, 3, 0, -1]])
    dist = ((points[np.maximum(ids, 0)] - points[0]) ** 2).sum(2)
    kept = V.robust_prune(points, np.array([0]), ids, dist, 4, 1.2)[0].tolist()
    assert kept == [1, 3, -1, -1]  # 2 and 4 lie behind 1
