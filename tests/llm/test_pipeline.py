import importlib
import subprocess
import sys
import textwrap
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from llm_texts import prose
from pyspark.sql import functions as F

import corpus_pipeline
from skytrace.llm import queries

ROOT = Path(__file__).resolve().parents[2]


def tables(folder):
    """documents, labels and benchmark with cases planted for every stage."""
    passage = prose(9000, 40)
    docs = [(i, prose(i, 60 + i % 50)) for i in range(200)]
    docs += [(i, prose(i, 60).upper().replace(" ", "!! ")) for i in range(1000, 1200)]
    docs += [(2000, docs[5][1]), (2001, docs[6][1] + " tail"), (2002, prose(7, 20) + " " + passage),
             (2003, f"{prose(8, 40)} write to a.b@c.org or +49 30 1234567"), (2004, prose(3000, 1500) + " " + passage[:90]),
             (2005, docs[5][1])]
    rows = {"doc_id": [i for i, _ in docs], "text": [t for _, t in docs], "lang": ["en"] * len(docs),
            "source": ["s"] * len(docs), "n_chars": [len(t) for _, t in docs]}
    pq.write_table(pa.table(rows), f"{folder}/documents.parquet")
    known = [i for i, _ in docs if i < 1200]
    pq.write_table(pa.table({"doc_id": known, "quality": pa.array([int(i < 1000) for i in known], pa.int32()),
                             "toxic": pa.array([0] * len(known), pa.int32())}), f"{folder}/labels.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [passage]}), f"{folder}/benchmark.parquet")
    return dict(docs)


def test_run_catches_planted_cases_and_leaves_clean_documents_alone(spark, tmp_path):
    docs = tables(tmp_path)
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == {*range(200), 2003, 2004}  # junk, copies and the contaminated document are gone
    library = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    docs[2003] = docs[2003].replace("a.b@c.org", "[EMAIL]").replace("+49 30 1234567", "[PHONE]")
    assert all(r.ids == library.encode(docs[i]) for i, r in out.items())


def test_stages_keep_the_columns(spark, tmp_path):
    tables(tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "personal_data", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[2:4]:
        assert stage(spark, docs, str(tmp_path)).schema == docs.schema


def test_entry_works_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "skytrace"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = """
        import sys
        sys.modules["skytrace.llm"] = None
        import __spark_entry__ as e
        assert not [k for k in e.queries() if k.startswith("op") or k == "pipeline"] and e.queries() and e.oracle_sql()
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, check=True)


def test_all_queries_are_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_stages_on_odd_rows_and_names(spark, tmp_path, odd):
    """Nulls, empty, blank and very long texts, repeated rows, copies, and columns of any name, through every stage."""
    texts = tables(tmp_path)
    rows = list(texts.items()) + [(None if i is None else 100_000 + i, t and t.replace("w", "q")) for i, t in odd]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(["my-col", "a.b", "_row", "class_id"])]).repartition(3)
    seen = Counter((r.doc_id, r.text) for r in df.collect())
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        if name == "sentencepiece":
            got = out.collect()
            assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, (i for i, _ in rows)))
            by_id = dict(rows)
            assert all(r.n_pieces == 0 if not by_id[r.doc_id] else r.n_pieces > 0 or not by_id[r.doc_id].strip() for r in got)
            continue
        assert out.columns == df.columns
        got = out.collect()
        assert all(tuple(r)[5:] == (0, 1, 2, 3) for r in got)
        kept = Counter((r.doc_id, r.text) for r in got)
        if name == "personal_data":
            assert sum(kept.values()) == len(rows)
            assert {i for i, t in kept if t and "[EMAIL]" in t} == {2003} and all(r.n_chars == (r.text and len(r.text)) or not r.text for r in got)
        elif name == "near_dedup":  # one row of each id, copies in favour of the least id; rows without id stay
            assert kept == Counter({k: 1 for k in seen if k[0] not in (2000, 2001, 2005, 100_007)}) | Counter({k: n for k, n in seen.items() if k[0] is None})
        elif name == "decontaminate":
            assert kept == seen - Counter({k: n for k, n in seen.items() if k[0] == 2002})
        else:
            assert all(seen[k] == n for k, n in kept.items())
            ids = {i for i, _ in kept}
            assert {*range(200), 2000, 2003} <= ids and not ids & set(range(1000, 1200))


def test_stages_on_an_empty_table(spark, tmp_path):
    tables(tmp_path)
    none = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, str(tmp_path))
        assert out.count() == 0 and (name == "sentencepiece" or out.columns == none.columns)
