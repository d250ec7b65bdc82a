import random
import struct

import numpy as np
import pytest
import sentencepiece

from skytrace.llm import queries, wfst


@pytest.fixture(scope="module")
def model_file():
    return queries.vocabulary("piece_bpe_32k.model")


def texts():
    r = random.Random(1)
    out = ["", " ", "  ", "\n", "Hello world", " x  y   z ", "a" * 3000, "▁a b", "日本語 \U0001F642\U0001F642\n\n\tz", "<s> </s> <0x41>"]
    for alphabet in ("abcde tion er in the an \n日é\U0001F6420123.,   ", "ab", "aaab "):
        out += ["".join(r.choice(alphabet) for _ in range(r.randint(0, 70))) for _ in range(800)]
    return out


def test_ids_are_the_library_s(model_file):
    with open(model_file, "rb") as f:
        e = wfst.Encoder(wfst.Model(f.read()), cache=3000)  # small, so that it is emptied on the way
    library = sentencepiece.SentencePieceProcessor(model_file=model_file)
    t = texts()
    for k in range(0, len(t), 500):
        ids, at = e(t[k:k + 500])
        back = e.model.decode(ids, at)
        for i, s in enumerate(t[k:k + 500]):
            assert ids[at[i]:at[i + 1]].tolist() == library.encode(s)
            assert back[i] == s.replace("▁", " ")


def field(number, value):
    if isinstance(value, int):
        return bytes([number << 3, value])
    return bytes([number << 3 | 2]) + struct.pack("B", len(value)) + value


def tiny(pieces, squeeze=1):
    """A unigram model file with <unk> and these (piece, score)."""
    raw = field(1, field(1, b"<unk>") + field(3, wfst.UNKNOWN))
    for p, s in pieces:
        raw += field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s))
    return raw + field(2, field(3, 1)) + field(3, field(3, 1) + field(4, squeeze))


def test_unigram_paths_are_shortest():
    pieces = [("▁", -2.0), ("a", -3.0), ("b", -3.5), ("ab", -4.0), ("▁a", -4.5), ("ba", -3.0), ("bab", -7.5), ("aab", -6.0)]
    m = wfst.Model(tiny(pieces))
    cost = {p: -s for p, s in pieces}
    bare = 10 - min(s for _, s in pieces)

    def best(s):
        path = [(0.0, ())] + [(np.inf, ())] * len(s)
        for j in range(1, len(s) + 1):
            for i in range(j):
                w = cost.get(s[i:j], bare if j == i + 1 else np.inf)
                path[j] = min(path[j], (path[i][0] + w, path[i][1] + (s[i:j],)))
        return path[-1]

    r = random.Random(2)
    words = ["".join(r.choice("abx▁") for _ in range(r.randint(1, 12))) for _ in range(300)]
    ids, at = m.solve(words)
    for k, w in enumerate(words):
        got = [m.pieces[i] for i in ids[at[k]:at[k + 1]]]
        assert sum(cost.get(p, bare) for p in got) == pytest.approx(best(w)[0])
    assert m.normalise("  a   b ") == "▁a▁b"


def test_compiled_character_maps():
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    spec = dict(wfst._fields(normaliser.serialized_model_proto()))[3]
    raw = tiny([("a", -1.0)], squeeze=0)
    m = wfst.Model(raw)
    m.map = wfst.charsmap(dict(wfst._fields(spec))[2])
    assert len(m.map) > 1000
    for s in ["ﬁne ｶﾞ ①² Ａ é", "é", "plain", "㍿ ½"]:
        assert m.normalise(s).replace("▁", " ").strip() == normaliser.normalize(s).replace("▁", " ").strip()


def test_encode_and_decode_rows(docs, odd, model_file):
    df = docs(odd, clash=True)
    out = wfst.encode(df, model_file, keep=("doc_id", "score"))
    assert out.columns == ["doc_id", "score", "n_pieces", "ids", "decoded_sha256", "lossless"]
    library = sentencepiece.SentencePieceProcessor(model_file=model_file)
    rows = out.collect()
    assert sorted(((r.doc_id, r.ids) for r in rows), key=str) == sorted(((i, library.encode(t or "")) for i, t in odd), key=str)
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in rows)
    back = wfst.decode(out, model_file).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in odd), key=str)
    assert wfst.encode(df.limit(0), model_file).count() == 0
