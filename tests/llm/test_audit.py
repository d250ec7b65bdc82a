from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skytrace.llm import audit as A

LABELS = "doc_id long, quality int, toxic int"
BLANKS = " \t\n\v\f\r"


def words(t):
    for c in BLANKS[1:]:
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w]


def brute(rows, labels):
    """rows: (doc_id, text, lang)"""
    docs = []
    for i, t, lang in rows:
        t, ws = t or "", words(t or "")
        bad = {"A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws),
               "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
               "E": any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in rows)}
        mine = [x for x in labels if x[0] == i and i is not None]
        docs.append((lang or "", {k for k, v in bad.items() if v}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total = {}
        for o in permutations("ABCDE"):
            for k, f in enumerate(o):
                before = set(o[:k])
                removed = [d for d in own if f in d[1] and not d[1] & before]
                out[part, "".join(o), k + 1] = [sum(not d[1] & (before | {f}) for d in own), len(removed),
                                               sum(f in d[1] and bool(d[1] & before) for d in own), sum(d[1] == {f} for d in own),
                                               sum(d[2] for d in removed), sum(d[3] for d in removed)]
                total[f] = total.get(f, 0) + len(removed)
        for (p, o, k), v in out.items():
            if p == part:
                v.append(total[o[k - 1]])
    return out


def found(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "s", 0) for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_audit_equals_brute_force(spark):
    rich = " ".join(f"word{k}" for k in range(300))
    rows = [(1, rich, "en"), (2, rich, "en"), (2, rich, "en"), (3, rich, None), (4, rich + " $", "de"), (5, None, "en"), (6, "", "en"),
            (None, rich, "en"), (None, "", ""), (7, "a b c " * 100, "de"), (8, "ABC " + rich, "en"), (9, "Ä" * 3 + "A", "fr"),
            (10, "x" * 200_000, "fr"), (11, rich.upper(), "fr"), (0, "\v\f a\x1cb " + rich, "en"), (12, "c|", "fr")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, None), (5, 0, 1), (7, 1, 0), (None, 1, 1), (99, 1, 1), (11, None, 1)]
    df = frame(spark, rows).select("*", *[F.lit("x").alias(c) for c in ("_id", "_mask", "a.b", "my-col", "quality", "part")]).repartition(3)
    got = A.audit(df, spark.createDataFrame(labels, LABELS).withColumn("a.b", F.lit(1)))
    assert found(got) == brute(rows, labels)
    assert len(found(got)) == 600 * 4


def test_empty_tables(spark):
    rows = [(1, "one", "en")]
    assert A.audit(frame(spark, []), spark.createDataFrame([], LABELS)).count() == 0
    assert found(A.audit(frame(spark, rows), spark.createDataFrame([], LABELS))) == brute(rows, [])


def test_copies_across_parts_count_once_as_original(spark):
    rows = [(k, "same text", "en" if k % 2 else "de") for k in range(40)]
    got = found(A.audit(frame(spark, rows).repartition(7), spark.createDataFrame([], LABELS)))
    assert got["en", "EABCD", 1][1] == 20 and got["de", "EABCD", 1][1] == 19


@pytest.mark.parametrize("text", ["", " ", "a", " a\tb  a", "é É x", "ab" * 30 + " " + "ab" * 30 + "c", "\x1f a", "A#b C$"])
def test_transducer_counts(text):
    c = A.text_counts(pa.array([text, None, text + " "]))
    for k in (0, 2):
        assert c["words"][k] == len(words(text)) and c["distinct"][k] == len(set(words(text)))
        assert c["capitals"][k] == sum("A" <= x <= "Z" for x in text)
        assert c["points"][k] == len(text) + (k == 2) and c["symbols"][k] == sum(x in "#$%&*|" for x in text)
    assert not any(c[x][1] for x in c)


def test_hash_table_tells_words_of_one_hash_apart():
    """Entries are verified: with the same hash for all words, distinct ones stay distinct."""
    r = np.random.default_rng(1)
    ws = ["w" * int(r.integers(1, 20)) + str(r.integers(3)) for _ in range(200)]
    data = np.frombuffer(" ".join(ws).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = ends - [len(w) for w in ws]
    row = np.arange(200) // 100
    holds = A.first_of_row(data, starts, ends, row, np.zeros(200, np.uint64))
    for k in (0, 1):
        own = [w for w, h, x in zip(ws, holds, row, strict=True) if h and x == k]
        assert sorted(own) == sorted(set(ws[k * 100:k * 100 + 100]))


def test_a_copy_carries_the_mask_of_its_text_and_the_copy_bit(spark):
    rows = A.failures(frame(spark, [(1, "a", "en"), (2, "a", "en")]), spark.createDataFrame([], LABELS)).collect()
    assert sorted((r._mask, r._n) for r in rows) == [(1, 1), (17, 1)]
