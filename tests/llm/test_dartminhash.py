import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from skytrace.llm import dartminhash as dmh
from skytrace.llm import graph
from skytrace.llm.graph import components


def bag(text, size=5):
    ws = (text or "").lower().split()
    return Counter(tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))) if ws else Counter()


def likeness(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows, threshold=0.8):
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if rows[i][0] == rows[j][0] or bags[i] and likeness(bags[i], bags[j]) >= threshold:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, least.get(find(i)) if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


def changed(text, n, seed):
    r, ws = random.Random(seed), text.split()
    for i in r.sample(range(len(ws)), n):
        ws[i] = f"new{seed}_{i}"
    return " ".join(ws)


def test_signature_agreement_estimates_weighted_jaccard():
    base = prose(1, 500) + " " + prose(2, 40) * 3
    for n in (0, 4, 12, 40):
        other = changed(base, n, n)
        e, at, k1, _ = dmh.shingles(pa.array([base, other]))
        s = dmh.sketch(e, at, 2048)
        assert abs((s[0] == s[1]).mean() - likeness(bag(base), bag(other))) < 0.05
        assert (k1[0] == k1[1]) == (n == 0)


def test_signature_does_not_depend_on_the_batch_and_takes_parts_of_a_weight():
    e, at, _, _ = dmh.shingles(pa.array([prose(3, 300), "a", prose(4, 3000), ""]))
    every = dmh.sketch(e, at, 64)
    assert not every[3].any() and every[1].all()
    for k in range(3):
        own = e[at[k]:at[k + 1]]
        assert (dmh.sketch(own, np.array([0, len(own)]), 64, work=100)[0] == every[k]).all()
    # halving all weights of one side leaves half of the weighted Jaccard similarity
    n = at[1]
    both = np.concatenate([e[:n], e[:n]])
    s = dmh.sketch(both, np.array([0, n, 2 * n]), 4096, part=np.append(np.ones(n), np.full(n, 0.5)))
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.05


@pytest.mark.parametrize("rows_bands", [(8, 64), (2, 40)])
def test_classes_match_brute_force(docs, odd, rows_bands):
    rows = list(odd)
    for g in range(6):  # groups of copies and near copies around a base, some just below the threshold
        base = prose(50 + g, 200)
        rows += [(100 * g + 20 + i, changed(base, n, 31 * g + i)) for i, n in enumerate([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 30])]
    random.Random(5).shuffle(rows)
    out = dmh.near_duplicates(docs(rows, clash=True), rows=rows_bands[0], bands=rows_bands[1]).collect()
    assert sorted(((r.doc_id, r.class_id) for r in out), key=str) == brute(rows)


def test_a_row_without_id_does_not_take_the_bands_of_its_copies(docs):
    base = prose(9, 200)
    rows = [(None, base), (1, base), (2, base), (3, changed(base, 2, 1))]
    out = dmh.near_duplicates(docs(rows).coalesce(1).orderBy(F.asc_nulls_first("doc_id"))).collect()
    assert sorted(((r.doc_id, r.class_id) for r in out), key=str) == brute(rows)


def test_a_large_group_of_near_copies_costs_leaders_not_pairs(docs, spark):
    base = prose(9, 150)
    rows = [(i, changed(base, 2, i)) for i in range(400)]
    sent = []
    original = dmh.verify
    dmh.verify = lambda pairs, *rest: (sent.append(pairs.count()), original(pairs, *rest))[1]
    try:
        out = dmh.near_duplicates(docs(rows)).collect()
    finally:
        dmh.verify = original
    assert {r.class_id for r in out} == {0} and sum(sent) < 20 * len(rows)


def test_keep_one(docs, odd):
    kept = dmh.keep_one(docs(odd, clash=True))
    assert kept.columns == docs(odd, clash=True).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, 8, None, 9, 10], key=str)
    assert dmh.keep_one(docs(odd).limit(0)).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)] + [(200, 200)]
    edges += [(300 + r.randint(0, 30), 300 + r.randint(0, 30)) for _ in range(25)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_copies_are_no_edges_of_the_component_rounds(docs, monkeypatch):
    base, sent = prose(9, 150), []
    original = dmh.components
    monkeypatch.setattr(dmh, "components", lambda edges: (sent.append(edges.count()), original(edges))[1])
    rows = [(i, base) for i in range(300)] + [(400 + i, changed(base, 2, i)) for i in range(5)] + [(400, prose(10, 150)), (500, prose(10, 150))]
    out = dmh.near_duplicates(docs(rows)).collect()
    assert {(r.doc_id, r.class_id) for r in out} == {(i, 0) for i, _ in rows} and sum(sent) < 60


def test_stars_end_the_component_rounds_at_once(spark, monkeypatch):
    written = []
    original = graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, name: (written.append(name), original(df, name))[1])
    got = graph.components(spark.createDataFrame([(i // 10 * 10, i) for i in range(100)] * 3, "a long, b long"))
    assert {(r.node, r.root) for r in got.collect()} == {(i, i // 10 * 10) for i in range(100)} and got.count() == 100
    assert len(written) == 2  # the edges, and the round that finds them to be stars


def test_a_sketch_holds_little_beside_its_texts():
    texts = [prose(i, 3000) for i in range(150)]  # 3 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["_id", "_text"])
    for _ in dmh._sketches(5, 8, 64)(iter([batch.slice(0, 50)])):  # the kept tables of powers
        pass
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in dmh._sketches(5, 8, 64)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(texts) and peak < 40e6
