import random
import zlib

import numpy as np
import pytest
from llm_texts import prose

from skytrace.llm import queries, rans


@pytest.mark.parametrize(("n", "kinds"), [(0, 1), (1, 1), (5, 3), (3000, 1), (70_000, 50_000), (200_000, 300), (4096, 2)])
def test_segment_round_trip(n, kinds):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % kinds).astype(np.uint32) if n else np.zeros(0, np.uint32)
    ends = np.unique(np.append(rng.integers(1, n + 1, 40) if n else [], n)).astype(np.int64)
    raw = rans.write_segment(ids, ends, block=7000)
    parts = list(rans.read_segment(raw))
    assert np.concatenate([p for p, _ in parts]).tolist() == ids.tolist()
    base, back = 0, []
    for p, e in parts:
        back += (base + e).tolist()
        base += len(p)
    assert back == ends.tolist()
    last = len(parts) - 1
    assert next(rans.read_segment(raw, only=[last]))[0].tolist() == parts[last][0].tolist()
    for spot in {3, 25, len(raw) // 2, len(raw) - 1}:  # damage is noticed
        bad = bytearray(raw)
        bad[spot] ^= 1
        with pytest.raises(ValueError):
            list(rans.read_segment(bytes(bad)))


def test_frequencies_sum_and_stay_positive():
    for counts in ([1], [10 ** 12, 1], [1] * 60_000, list(range(1, 50_000))):
        f = rans.scaled(np.array(counts))
        assert f.sum() == 1 << rans.SCALE and f.min() >= 1


def test_files_hold_the_library_ids(docs, odd):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    r = random.Random(1)
    alphabet = "ab  \n\t'sé  　\U0001F6421,.X\x1c\x85"
    rows = list(odd) + [(100 + i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))) for i in range(400)]
    rows += [(999, "a <|endoftext|> b<|endoftext|>"), (1000, prose(3, 2000))]
    got = rans.token_files(docs(rows, clash=True), path, 2).collect()
    ids = {(i, t): tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted(((g.doc_id, g.n_tokens, g.ids_crc32) for g in got), key=str) == sorted(
        ((i, len(ids[i, t]), crc(ids[i, t])) for i, t in rows), key=str)
    at = 0
    for g in sorted(got, key=lambda g: g.start):
        assert g.start == at
        at += g.n_tokens
    order = [g.doc_id for g in sorted(got, key=lambda g: g.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])


def test_small_segments_and_empty_table(docs):
    path = queries.vocabulary("byte_bpe_50k.json")
    d = docs([(i, prose(i, 50)) for i in range(40)])
    small = rans.write_tokens(d, path, 2, segment=100)
    assert small.filter("_segment > 0").count() > 0
    by = lambda s: sorted(map(tuple, rans.read_documents(s).collect()))
    assert by(small) == by(rans.write_tokens(d, path, 2))
    assert rans.token_files(d.limit(0), path, 2).count() == 0
