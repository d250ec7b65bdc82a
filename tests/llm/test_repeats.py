import random

import pytest

from llm_texts import prose

from skytrace.llm import repeats


def brute(rows, window):
    words = [(-(1 << 63) if i is None else i, (t or "").split(), i) for i, t in rows]
    first = {}
    for i, ws, _ in words:
        for p in range(len(ws) - window + 1):
            k = tuple(ws[p:p + window])
            first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, ws, own in words:
        gone = [False] * len(ws)
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p:p + window])] != (i, p):
                gone[p:p + window] = [True] * window
        out.append((own, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "gram"), [(20, 8), (6, 3), (4, 4)])
def test_matches_brute_force(docs, odd, window, gram):
    r = random.Random(window)
    shared = [prose(100 + i, 40) for i in range(4)]
    rows = list(odd)
    for i in range(20, 60):  # passages shared by many, at any place, and shuffled runs of few words
        parts = [prose(i, r.randint(0, 50)), r.choice(shared), prose(1000 + i, r.randint(0, 9)), r.choice(shared)[5:-9]]
        rows.append((i, " ".join(parts) if i % 3 else prose(i, 120, vocabulary=3)))
    out = repeats.remove_repeats(docs(rows, clash=True), window=window, gram=gram).collect()
    assert sorted(((x.doc_id, x.n_words, x.n_removed, x.kept) for x in out), key=str) == brute(rows, window)
    for x in out:
        assert sum(s.end - s.start for s in x.repeats) == x.n_removed
        assert all(s.end - s.start >= window for s in x.repeats)


def test_empty_table(docs):
    assert repeats.remove_repeats(docs([(1, "x")]).limit(0)).count() == 0
