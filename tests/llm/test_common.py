"""What several operators rest on: hashes, names, ranges in id order, components with a hub."""

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from skytrace.llm import common as C
from skytrace.llm import dartminhash, mil, pii, rans, suffix, wfst
from skytrace.llm.graph import components

#: Two words of 1,024 bytes that every polynomial hash modulo 2**64 takes as equal, and their complement.
THUE_MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
COMPLEMENT = THUE_MORSE.translate({97: "b", 98: "a"})


def test_hashes_of_structured_words_differ():
    words = [THUE_MORSE, COMPLEMENT, THUE_MORSE[:512], THUE_MORSE + "a", "a" * 8, "a" * 9, "", "a", "a" * 5000, "a" * 5001]
    data, offs = C.text_buffer(pa.array(words))
    h = C.byte_hashes(data, offs[:-1], offs[1:])
    assert len(set(h.tolist())) == len(words)
    again, offs2 = C.text_buffer(pa.array(["x" * 3, *reversed(words)]))
    assert C.byte_hashes(again, offs2[1:-1], offs2[2:]).tolist() == h.tolist()[::-1]


def test_structured_words_are_told_apart_by_the_operators(docs, tokenizer):
    texts = [THUE_MORSE, COMPLEMENT, THUE_MORSE]
    rows = rans.token_files(docs(texts), tokenizer, 2).orderBy("doc_id").collect()
    assert rows[0].ids_crc32 == rows[2].ids_crc32 != rows[1].ids_crc32
    items = docs([THUE_MORSE]).select(F.lit("i").alias("item_id"), "text")
    hit = {r["_row"].doc_id: r.n_hit for r in suffix.contamination(docs(texts), items).collect()}
    assert hit == {0: 1, 1: 0, 2: 1}


@pytest.fixture
def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("symbols", [1, 1000, 131_072, 140_000, 300_000])
def test_segments_of_any_vocabulary(symbols):
    ids = np.concatenate([np.arange(symbols), np.zeros(50, np.int64)]).astype(np.uint32)
    raw = rans.write_segment(ids, np.array([10, len(ids)]) if symbols > 10 else np.array([len(ids)]))
    back = np.concatenate([x for x, _ in rans.read_segment(raw)])
    assert (back == ids).all()


def _pairs_model():
    """Two models of equal size that allow different neighbours."""
    import struct

    def piece(text, score, kind=1):
        body = b"\x0a" + bytes([len(text.encode())]) + text.encode() + b"\x15" + struct.pack("<f", score) + b"\x18" + bytes([kind])
        return b"\x0a" + bytes([len(body)]) + body

    special = piece("<unk>", 0, 2)
    letters = [piece(x, -9.0) for x in ("▁", "a", "b")]
    trainer = b"\x12\x02\x18\x02"
    plain = b"\x1a\x02\x18\x00"
    return (special + piece("ab", -1.0) + b"".join(letters) + trainer + plain,
            special + piece("ba", -1.0) + b"".join(letters) + trainer + plain)


def test_two_models_in_one_worker_do_not_mix():
    first, second = _pairs_model()
    alone = [wfst.Encoder(wfst.Model(m))(["ab ba", "ba"])[0].tolist() for m in (first, second)]
    a, b = wfst.Encoder(wfst.Model(first)), wfst.Encoder(wfst.Model(second))
    for _ in range(2):
        assert [a(["ab ba", "ba"])[0].tolist(), b(["ab ba", "ba"])[0].tolist()] == alone
    assert alone[0] != alone[1]


def test_extra_columns_of_any_name_pass_through(docs, spark):
    names = ["my-col", "a.b", "x`y", "two words", "_row"]
    df = docs([(i, prose(i, 60)) for i in range(4)]).select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])

    class Half:
        def forward(self, *_):
            return np.full(len(_[-1]) - 1, 0.9), None

    items = spark.createDataFrame([("i", "nothing of it")], "item_id string, text string")
    for kept in (dartminhash.keep_one(df), suffix.decontaminate(df, items), pii.redact(df)):
        assert kept.columns == df.columns and kept.count() == 4
        assert {tuple(r)[-len(names):] for r in kept.collect()} == {(0, 1, 2, 3, 4)}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    kept = mil.keep_good(df, mil.train(df, labels, F.lit(True)), least=0.0)
    assert kept.columns == df.columns and kept.count() == 4


def test_partitions_ascend_with_the_ids(docs):
    df = C.in_id_order(C.id_text(docs([(i * 7 % 101, f"t{i}") for i in range(101)] + [(None, "n")])))
    rows = df.select(F.spark_partition_id().alias("p"), "_id").collect()
    order = [r["_id"] for r in sorted(rows, key=lambda r: (r.p, -1 if r["_id"] is None else r["_id"]))]
    assert order == [None, *range(101)] and len({r.p for r in rows}) > 4


def test_a_hub_and_a_chain_are_components(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(5000 + i, 5001 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert got == {i: 0 for i in range(3000)} | {5000 + i: 5000 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_task_gets_a_text_once(docs):
    df = docs([(1, "a"), (2, None), (3, "")], clash=True)
    rows = C.row_and_text(df, "text")
    assert rows.columns == ["_row"]  # the text is in it
    got = [b.to_pydict() for b in C.with_text(iter(rows.toArrow().to_batches()), "text")]
    assert sorted(zip([r["doc_id"] for b in got for r in b["_row"]], [t for b in got for t in b["_text"]], strict=True)) \
        == [(1, "a"), (2, None), (3, "")]
    assert C.row_and_text(df.withColumn("text", df["text"].cast("binary")), "text").columns == ["_row", "_text"]
