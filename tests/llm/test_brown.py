import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from skytrace.llm import brown


def tokens(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in (text or "").split()] + [None]


def test_scores_match_brute_force(docs, odd, monkeypatch):
    monkeypatch.setattr(brown, "KNOWN", 40)  # most words go by the join
    rows = list(odd) + [(i, prose(i, 30, vocabulary=150).title()) for i in range(1001, 1060)]
    df = docs(rows, clash=True)
    out = brown.score(df, df["doc_id"] % 3 != 0).collect()
    counts = Counter(w for i, t in rows if i is not None and i % 3 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want.append((i, i is not None and i % 3 != 0, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    got = [(r.doc_id, r.training, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.score < 0 for r in out)
    same = {}
    for r, (i, t) in zip(sorted(out, key=lambda r: str(r.doc_id)), sorted(rows, key=lambda x: str(x[0])), strict=True):
        assert r.doc_id == i and same.setdefault(t or "", r.score) == pytest.approx(r.score)


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    n = rng.poisson(0.02, (brown.N_TYPES, brown.N_TYPES)).astype(float)
    m = brown.Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), n, n.sum(0), (n.sum(0) > 0).astype(float), int(n.sum()), 5)
    assert np.allclose((10 ** m.step).sum(1), 1)


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(3)
    types, classes = 60, 4  # the end token and three classes that follow each other in turn
    truth = np.append(rng.integers(1, 4, types - 1), 0)
    follow = {0: 1, 1: 2, 2: 3, 3: 1}
    n = np.array([[rng.poisson(5 if follow[a] == b else 0.2) for b in truth] for a in truth], float)
    cls = brown.exchange(n, classes=classes, sweeps=20)
    assert cls[-1] == 0 and (cls[:-1] > 0).all()
    for c in (1, 2, 3):
        assert len(set(cls[:-1][truth[:-1] == c])) == 1

    def gain(c):
        g = np.zeros((classes, classes))
        np.add.at(g, (c[:, None].repeat(types, 1), c[None].repeat(types, 0)), n)
        x = lambda a: (a * np.log(np.maximum(a, 1e-300))).sum()
        return x(g) - x(g.sum(0)) - x(g.sum(1))

    assert gain(cls) >= gain(truth) - 1e-6


def test_nothing_to_learn_from(docs):
    out = brown.score(docs([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in sorted(out)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert brown.score(docs([(1, "a")]).limit(0), F.lit(True)).count() == 0


def test_words_move_to_the_class_of_most_likelihood():
    rng = np.random.default_rng(5)
    types, top = 40, 6
    n = rng.poisson(0.7, (types, types)).astype(float)
    cls = np.append(rng.integers(1, top, types - 1), 0)

    def matrix(c):
        g = np.zeros((brown.CLASSES, brown.CLASSES))
        np.add.at(g, (c[:, None].repeat(types, 1), c[None].repeat(types, 0)), n)
        return g

    word, code, count = [], [], []
    for w in range(types - 1):
        for v in range(types):
            word += [w, w]
            code += [cls[v], brown.CLASSES + cls[v]]
            count += [n[w, v], n[v, w]]
        word, code, count = word + [w], code + [brown._OWN], count + [n[w, w]]
    got = brown.best_classes(matrix(cls), cls[:-1], np.array(word), np.array(code), np.array(count))
    for w in range(types - 1):
        def at(c, w=w):
            other = cls.copy()
            other[w] = c
            return brown._likelihood(matrix(other))

        assert at(got[w]) == pytest.approx(max(at(c) for c in range(1, top)))


def test_rare_words_of_one_ending_get_classes_by_their_successions(docs, spark, monkeypatch):
    monkeypatch.setattr(brown, "KNOWN", 40)  # nearly all words with the ending "ing" are beyond the commonest
    rng = np.random.default_rng(2)
    pair = lambda i: f"the n{i}ing" if rng.random() < 0.5 else f"they v{i}ing"
    texts = [" ".join(pair(rng.integers(rng.choice([15, 300]))) for _ in range(60)) for _ in range(60)]
    model, others = brown.fit(docs(texts).select(F.col("text").alias("_text")), spark)
    cls = {r["_key"]: r["_cls"] for r in others.collect()}
    seen = sorted({w for t in texts for w in t.split() if w.endswith("ing")})
    keys, _, _ = brown._words(pa.array([" ".join(seen)]))
    of = {w: cls[k] for w, k in zip(seen, keys.view(np.int64).tolist(), strict=True) if k in cls}
    nouns, verbs = ({c for w, c in of.items() if w[0] == x} for x in "nv")
    assert len(of) > 400 and not nouns & verbs
    df = docs(texts + [texts[0]])
    assert all(math.isfinite(r.score) and r.score < 0 for r in brown.score(df, F.lit(True)).collect())


def test_score_equals_brute_force_from_the_fitted_classes(docs, spark, monkeypatch):
    """The fitted classes of all words, with transitions, sizes and probabilities counted anew from the texts."""
    monkeypatch.setattr(brown, "KNOWN", 30)
    rows = [(i, prose(i, 40, vocabulary=120)) for i in range(60)] + [(61, None), (62, prose(3, 40) + " ahead unseen ahead")]
    train = [(i, t) for i, t in rows if i % 4]
    model, others = brown.fit(docs(train).select(F.coalesce("text", F.lit("")).alias("_text")), spark)
    counts = Counter(w for _, t in train for w in tokens(t))
    words = sorted(w for w in counts if w)
    key = dict(zip(words, brown._words(pa.array([" ".join(words)]))[0].tolist(), strict=True))
    of = dict(zip(model.known.tolist(), model.word_cls.tolist(), strict=True))
    of |= {r["_key"] % (1 << 64): r["_cls"] for r in others.collect()}
    cls = {w: of[k] for w, k in key.items()} | {None: 0}  # every training word has a class
    g, size, many = np.zeros((brown.CLASSES, brown.CLASSES)), np.zeros(brown.CLASSES), np.zeros(brown.CLASSES)
    for _, t in train:
        ts = tokens(t)
        for a, b in zip([None, *ts], ts, strict=False):
            g[cls[a], cls[b]] += 1
    for w, c in counts.items():
        size[cls[w]] += c
        many[cls[w]] += 1
    share = (g.sum(0) + 1 / brown.CLASSES) / (g.sum() + 1)
    step = (g + brown.BETA * share) / (g.sum(1, keepdims=True) + brown.BETA)

    def unseen(w):
        e = brown._words(pa.array([w]))[1][0]
        return model.cls[brown.FREQUENT + e]

    df = docs(rows)
    for r in brown.score(df, F.col("doc_id") % 4 != 0).collect():
        want, before = 0.0, 0
        for w in tokens(dict(rows)[r.doc_id]):
            c = cls[w] if w in cls else unseen(w)
            want += math.log10(step[before, c] * (counts[w] + 0.1) / (size[c] + 0.1 * (many[c] + 1)))
            before = c
        assert r.score == pytest.approx(want, rel=1e-9)


def test_the_commonest_words_are_exact_in_a_flat_vocabulary(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-2 ** 63, 2 ** 63 - 1, 3000)
    rows = [(int(k), 0, int(n)) for k, n in zip(keys, rng.choice([1, 5, 5, 5, 300], 3000), strict=True)] + [(brown._END, -1, 9)]
    table = spark.createDataFrame(rows, "_key long, _ending int, _n long")
    order = sorted((-n, k) for k, _, n in rows if k != brown._END)
    for most in (0, 1, 700, 2000, 5000):
        got = {r["_key"] for r in brown.commonest(table, most).collect()}
        assert got == {k for _, k in order[:most]}


def test_words_are_found_by_the_prefixes_of_their_hashes():
    r = np.random.default_rng(3)
    for size in (0, 1, 2, 700):
        known = np.unique(np.concatenate([r.integers(0, 1 << 64, size, np.uint64), np.arange(min(size, 5), dtype=np.uint64),
                                          np.uint64((1 << 64) - 1) - np.arange(min(size, 9), dtype=np.uint64)]))
        keys = np.concatenate([known, r.integers(0, 1 << 64, 300, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
        place = {int(k): i for i, k in enumerate(known)}
        assert brown._find(known, brown._index(known), keys).tolist() == [place.get(int(k), -1) for k in keys]


@pytest.mark.parametrize("blocks", [1, 2, 3, 7, 50])
def test_keys_go_by_block_and_ascend_in_it(blocks):
    key = np.random.default_rng(4).integers(-(1 << 63), 1 << 63, 500)
    key = np.concatenate([key, key[:40], [0, -1, (1 << 63) - 1, -(1 << 63)]])
    by = brown._block_order(key, blocks)
    assert (key[by] == key[np.lexsort((key, brown._block_of(key, blocks)))]).all()
    assert sorted(by) == list(range(len(key)))


def test_single_words_choose_by_a_table_as_others_do():
    """A word with one occurrence moves where the full comparison of its two cells moves it, whatever shares its block."""
    rng = np.random.default_rng(6)
    g = rng.poisson(rng.choice([0, 1, 40], (brown.CLASSES, brown.CLASSES))).astype(float) + 1
    g[7] = g[:, 7] = 0  # an empty class
    heads = rng.integers(0, brown.CLASSES, 50)
    heads[heads == 7] = 8
    words = 600
    n = np.where(np.arange(words) % 3, 1, 2)
    cls = rng.integers(8, brown.CLASSES, words)
    of = np.repeat(np.arange(words), 2)
    h = np.empty(2 * words, brown._HEAD)
    h["head"] = rng.integers(0, 50, 2 * words) * 2 + np.tile([0, 1], words)
    h["n"] = n[of]
    by_message = (of % 5 == 0) & (h["head"] & 1 == 1)  # what stands before is another word beyond the known ones
    cells = np.empty(by_message.sum(), brown._CELL)
    cells["code"], cells["n"] = brown.CLASSES + heads[h["head"][by_message] >> 1], h["n"][by_message]
    for w, c in zip(of, brown.CLASSES * (h["head"] & 1) + heads[h["head"] >> 1], strict=True):  # the matrix has the words in it
        a, b = (cls[w], c) if c < brown.CLASSES else (c - brown.CLASSES, cls[w])
        g[a, b] += n[w]
    key = np.sort(rng.integers(-(1 << 63), 1 << 63, words))
    block = brown._Block(key, n, cls, of[~by_message], h[~by_message], np.zeros(0, np.int64), np.zeros(0, brown._OTHER), of[by_message], cells)

    class State:
        value = None, heads, g, brown.single_classes(g)

    code = (h["head"] & 1) * brown.CLASSES + heads[h["head"] >> 1]
    want = brown.best_classes(g, cls, of, code, h["n"])
    for share in (1, 4):
        move = brown._may_move(key.view(np.uint64), 2, share)
        got = brown._choose_tails(State, 2, share)(block)
        assert (got == np.where(move, want, cls)).all() and (got != cls).sum() > 50


def test_packed_rows_leave_a_task_many_to_a_batch():
    """One batch for each small row made the rows' way out of Python dearer than the work on them."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(3000)]
    texts = pa.array([" ".join(rng.choice(words, 200)) for _ in range(300)])

    class Known:
        value = np.unique(brown._words(pa.array([" ".join(words[:1000])]))[0])

    found = list(brown._collect_pairs(Known, 700)(iter([pa.RecordBatch.from_arrays([texts], names=["_text"])])))
    rows = [r for b in found for r in b.to_pylist()]
    assert len({r["_block"] for r in rows} - {None}) > 600 and len({r["_range"] for r in rows} - {None}) == 4
    assert len(found) <= 2 + sum(len(r["_packed"]) + brown._ROW_BYTES for r in rows) // brown.WORK_BYTES
    of = sorted((r for r in rows if r["_block"] is not None), key=lambda r: r["_block"])
    whole = [brown._Block.unpack(r["_packed"]) for r in of]
    counted = sum(int((b.heads["n"] * (b.heads["head"] & 1 == 0)).sum() + (b.others["n"] >> 10)[(b.others["n"] & 1) == 0].sum()) for b in whole)
    assert counted == sum(w not in set(words[:1000]) for t in texts.to_pylist() for w in t.split())


def test_words_met_apart_in_a_text_count_once_each(docs, monkeypatch):
    """Scoring sorts words by part of their hash: results do not hang on where equal words stand."""
    monkeypatch.setattr(brown, "KNOWN", 5)
    a, b = (" ".join(["x y z q v"] * 40 + w) for w in (["r1", "r2"] * 30, ["r1"] * 30 + ["r2"] * 30))
    rows = [(i, " ".join(["x y z q v"] * 40)) for i in range(3)] + [(3, a), (4, b), (5, "r1 r2 r3")]
    got = {r.doc_id: r for r in brown.score(docs(rows), F.col("doc_id") != 5).collect()}
    assert got[3].n_known == got[4].n_known == 261 and got[3].base_score == pytest.approx(got[4].base_score, rel=1e-12)
    assert (got[5].n_tokens, got[5].n_known) == (4, 3)


@pytest.mark.parametrize("most", [1, 255, 256, 70_000, 1 << 40])
def test_counts_are_packed_as_wide_as_they_need(most):
    rng = np.random.default_rng(8)
    code = np.unique(np.append(rng.integers(0, 1 << 24, 500), [0, (1 << 24) - 1]))
    n = rng.integers(1, most + 1, len(code))
    n[3] = most
    got = brown._unpacked(len(code), brown._packed_counts(code, n))
    assert (got[0] == code).all() and (got[1] == n).all() and got[0].dtype == got[1].dtype == np.int64


@pytest.mark.parametrize("high,most", [(9, 1), (1 << 30, 300), (1 << 50, 1 << 20)])
def test_counts_of_equal_codes_are_summed(high, most):
    rng = np.random.default_rng(9)
    code, n = rng.integers(0, high, 400), rng.integers(0, most + 1, 400)
    code[50:90] = code[10]
    want = Counter()
    for c, m in zip(code.tolist(), n.tolist(), strict=True):
        want[c] += m
    got = brown._summed(code, n)
    assert dict(zip(*(x.tolist() for x in got), strict=True)) == want and (np.diff(got[0]) > 0).all()
    assert [len(x) for x in brown._summed(code[:0], n[:0])] == [0, 0]
