import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytrace.llm import fmindex as FM
from skytrace.llm import variants as V


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    if len(a) == len(b):
        return k < len(a) and a[k + 1:] == b[k + 1:]
    return len(b) - len(a) == 1 and a[k:] == b[k + 1:]


def brute_words(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute(rows):
    n = brute_words(rows)
    by_key = {}
    for w in n:  # words one edit apart share a word less one code point
        for k in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_key.setdefault(k, set()).add(w)
    out, form = {}, {}
    for w in n:
        others = {v for k in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for v in by_key[k] if near(w, v)}
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
        out[w] = [form[w], None, n[w], len(others), n[form[w]] if form[w] else None]
    for w, r in out.items():
        root = w
        while form[root]:
            root = form[root]
        r[1] = root
    return {w: tuple(r) for w, r in out.items()}


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def edited(w, r):
    k, c = r.randrange(len(w) + 1), r.choice("abcàÿ×")
    return r.choice([w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]])


def corpus(seed=1, stems=60):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdéß") for _ in range(r.randint(6, 14))) for _ in range(stems)]
    rows = []
    for i in range(120):
        ws = []
        for _ in range(150):
            w = base[int(len(base) * r.random() ** 3)]
            for _ in range(r.choice([0] * 12 + [1, 1, 2])):
                w = edited(w, r)
            ws.append(w.title() if r.random() < 0.2 else w)
        rows.append((i, " 1".join(ws)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_variants_equal_brute_force(spark):
    rows = corpus() + [(None, "variant " * 3), (500, None), (501, ""), (7, "repeats " * 30), (7, "repeats " * 30), (8, "repeat repeaXs repeaxs " * 3),
                       (9, "z" * 30_000 + " " + "z" * 30_000 + " " + "z" * 29_999), (10, "z" * 30_000), (11, "z" * 29_999)]
    df = frame(spark, rows).select("*", *[F.lit("x").alias(c) for c in ("word", "n", "_id", "a.b", "my-col")])
    want = brute(rows)
    assert any(r[0] and r[1] != r[0] for r in want.values())  # a chain of two forms
    assert found(V.variants(df)) == want


def test_split_halves_lose_nothing(spark):
    """A half shared by more words than a block holds is dealt over several blocks."""
    r = random.Random(5)
    ws = {"commonprefix" + "".join(r.choice("ab") for _ in range(r.randint(7, 9))) for _ in range(400)}
    ws |= {"".join(r.choice("ab") for _ in range(r.randint(3, 5))) + "ending" for _ in range(60)}
    vocabulary = spark.createDataFrame([(w, 2) for w in ws], "word string, n long")
    got = sorted((x.word, x.near) for x in V.near_pairs(vocabulary, block=16).collect())
    assert got == sorted((a, b) for a in ws for b in ws if near(a, b))


def test_long_chains_write_no_tables_of_their_own(spark, monkeypatch):
    """Chains of 1 to 4 links, a hub, and two words without a form; only the vocabulary and the forms are written."""
    chain = ["chainab", "chainabc", "chainabcd", "chainabcde", "chainabcdef"]
    times = [(w, 2 * 10 ** i) for i, w in enumerate(chain)] + [("hubword" + c, 2) for c in "abcde"] + [("hubwords", 20), ("aloneone", 19), ("aloneon", 2)]
    rows = [(i, " ".join([w.upper() if i % 2 else w] * n)) for i, (w, n) in enumerate((w, n) for w, n in times)]
    monkeypatch.setattr(V, "EDIT_ONE_IN", 1 << 31)
    written, materialise = [], V.materialise
    monkeypatch.setattr(V, "materialise", lambda df, name, **kw: written.append(name) or materialise(df, name, **kw))
    got = found(V.variants(frame(spark, rows)))
    assert [got[w][:2] for w in chain] == [(form, chain[-1]) for form in [*chain[1:], None]]
    assert got["hubworda"][:2] == ("hubwords", "hubwords") and got["aloneon"][:2] == (None, "aloneon")
    assert written == ["vocabulary", "forms"]


def test_no_documents(spark):
    assert V.variants(frame(spark, [(1, None)]).filter("doc_id > 1")).collect() == []
    assert V.variants(frame(spark, [(1, None)])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_words_with_an_exact_half_and_one_error(seed):
    r = random.Random(seed)
    ws = sorted({bytes(r.choice(b"ab" if seed % 2 else b"abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(300)})
    index = FM.Index(FM.Words.of(ws))
    assert [ws[i] for i in index.number] == ws
    asked = ws[::3] + [b"a", b"abababab"]
    exact = np.array([r.randint(0, len(w)) for w in asked])
    q, w = FM.one_error(index, FM.Words.of(asked), exact)
    got = sorted(zip(q.tolist(), w.tolist(), strict=True))

    def ends(a, b, k):
        return k == 0 or b[-k:] == a[-k:] and near(a[:-k], b[:-k]) if k <= len(b) else False

    want = sorted((i, j) for i, a in enumerate(asked) for j, b in enumerate(ws)
                  if (near(a, b) if exact[i] == 0 else ends(a, b, exact[i])))
    assert got == want


def test_crc_of_spans():
    raw = ("word " * 5 + "x" * 100 + " é").encode()
    data = np.frombuffer(raw, np.uint8)
    starts, sizes = np.array([0, 5, 25, 126, 3]), np.array([4, 0, 100, 2, 1])
    before = np.array([zlib.crc32(b"7:"), 0, 5, zlib.crc32(b":"), 1], np.uint32)
    want = [zlib.crc32(raw[s:s + n], int(b)) for s, n, b in zip(starts, sizes, before, strict=True)]
    assert V.crc32_spans(data, starts, sizes, before).tolist() == want
