import hashlib

import numpy as np
import pyarrow as pa

from llm_texts import prose

from skytrace.llm import cdc
from skytrace.llm.common import text_buffer


def plain_chunks(raw: bytes):
    """Chunk ends by the definition, one byte at a time."""
    ends, at = [], 0
    gear = lambda i: sum(int(cdc._GEAR[raw[i - j]]) << j for j in range(cdc.WINDOW)) & 0xFFFFFFFF
    while at < len(raw):
        end = min(at + cdc.MAX, len(raw))
        for i in range(at + cdc.MIN - 1, end):
            if not gear(i) & int(cdc.STRICT if i < at + cdc.NORMAL - 1 else cdc.LOOSE):
                end = i + 1
                break
        ends.append(end)
        at = end
    return ends


def test_chunks_by_definition():
    texts = [prose(i, n).encode() for i, n in enumerate([0, 1, 5, 80, 300])] + [b"a" * 1000, b""]
    digests, lengths, at = cdc.chunk(*text_buffer(pa.array(texts, pa.binary())))
    for k, t in enumerate(texts):
        assert np.cumsum(lengths[at[k]:at[k + 1]]).tolist() == plain_chunks(t)
    alone, _, _ = cdc.chunk(*text_buffer(pa.array([texts[3]], pa.binary())))
    assert alone.tolist() == digests[at[3]:at[4]].tolist()


def test_edits_match_brute_force(docs, odd):
    rows = [r for r in odd if r[0] is not None]
    out = cdc.fingerprint_edits(docs(rows, clash=True)).collect()
    order = sorted(rows, key=lambda r: -r[0])
    # the two equal rows of one id follow each other
    texts = [t or "" for _, t in order]
    want = sorted((i, len(t), hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest())
                  for (i, _), t, n in zip(order, texts, texts[1:] + texts[:1], strict=True))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == want
    by = {r.doc_id: r for r in out}
    assert by[6].fingerprint == by[7].fingerprint and by[7].near_next == 1.0
    assert by[1].fingerprint == "" and by[2].near_next == 1.0 and by[3].near_next == 0.0
    assert 0.5 < by[8].near_edited < 0.75 and by[8].near_next < 0.1
    same = {r.doc_id: r.fingerprint for r in cdc.fingerprints(docs(rows)).collect()}
    assert all(same[i] == r.fingerprint for i, r in by.items())


def test_order_runs_over_ranges_and_null_ids(docs):
    rows = [(i, prose(i, 20)) for i in range(0, 300, 3)] + [(None, "lowest")]
    out = {r.doc_id: r for r in cdc.fingerprint_edits(docs(rows)).collect()}
    assert len(out) == len(rows)
    for (i, t), (_, n) in zip(reversed(rows[:-1]), [*reversed(rows[:-2])] + [rows[-1]], strict=False):
        k = len(t) // 3
        assert out[i].edited_sha256 == hashlib.sha256((t[:len(t) - k] + n[:k]).encode()).hexdigest()
    assert out[None].edited_sha256 == hashlib.sha256(("lowe" + rows[-2][1][:2]).encode()).hexdigest()


def test_one_row_and_empty_table(docs, spark):
    one = cdc.fingerprint_edits(docs([(5, "abcdef")])).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(5, hashlib.sha256(b"abcdab").hexdigest())]
    assert cdc.fingerprint_edits(docs([(1, "x")]).limit(0)).count() == 0
