import random
import re

import pytest
from llm_texts import prose

from skytrace.llm import suffix

ITEM = "item_id long, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    ws, hit, found = words(text), set(), set()
    for name, t in items:
        iw = words(t)
        n = min(13, len(iw))
        for p in range(len(iw) - n + 1 if n else 0):
            for q in range(len(ws) - n + 1):
                if ws[q:q + n] == iw[p:p + n]:
                    hit.update(range(q, q + n))
                    found.add(str(name) if name is not None else "null")
    return len(ws), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(ws)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_matches_brute_force(spark, docs, odd, block_bytes):
    r = random.Random(3)
    items = [(i, prose(500 + i, n)) for i, n in enumerate([0, 1, 5, 12, 13, 14, 30, 60])]
    items += [(None, prose(600, 20)), (6, prose(601, 15)), (50, None), (51, "the É-x 1a"), (52, "same " * 20), (2, items[2][1])]
    rows = [x for x in odd if x[0] != 8]
    for i in range(100, 130):
        a = r.choice(items)[1] or ""
        cut = a.split()[r.randint(0, 3):]
        rows.append((i, f"{prose(i, r.randint(0, 60))}, {' - '.join(cut).upper()}! {prose(i + 1, 9)} {' '.join(cut[:13])}"))
    rows.append((200, "same " * 40 + "other"))
    out = suffix.contamination(docs(rows, clash=True), spark.createDataFrame(items, ITEM), block_bytes=block_bytes).collect()
    got = sorted(((x._row.doc_id, x.n_words, x.n_hit, sorted({m.item_id for m in x.matches}), x.contaminated) for x in out), key=str)
    assert got == sorted(((i, *brute(t, items)) for i, t in rows), key=str)
    by = {str(i) if i is not None else "null": t for i, t in items if i not in (6, 2)}
    texts = dict(rows)
    for x in out:
        if x._row.doc_id == 6:
            continue
        for m in x.matches:  # verbatim and not extendable to the right
            if m.item_id in by:
                d, t = words(texts[x._row.doc_id]), words(by[m.item_id])
                assert d[m.doc_pos:m.doc_pos + m.length] == t[m.item_pos:m.item_pos + m.length]
                assert d[m.doc_pos:m.doc_pos + m.length + 1] != t[m.item_pos:m.item_pos + m.length + 1] or \
                    m.item_pos + m.length >= len(t) or m.doc_pos + m.length >= len(d)


def test_decontaminate_keeps_columns_and_clean_rows(spark, docs):
    passage = prose(7, 30)
    rows = [(1, passage), (2, prose(8, 50)), (3, prose(9, 900) + " " + passage), (4, None), (4, None)]
    df = docs(rows, clash=True)
    kept = suffix.decontaminate(df, spark.createDataFrame([(1, passage)], ITEM))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 4]
    assert suffix.decontaminate(df, spark.createDataFrame([], ITEM)).count() == 5
    assert suffix.decontaminate(df.limit(0), spark.createDataFrame([(1, passage)], ITEM)).count() == 0
