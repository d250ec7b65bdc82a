"""The corpus pipeline: documents to training token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last keep the columns
of documents; a stage's result is written and read again before the next one starts, so a lost
executor repeats only tasks of one stage.

Defined cases, for every stage: an empty table gives an empty table. Null and empty texts have the results their operator
states: the classifier's score of an empty text decides whether they stay, they are like no other text, not
contaminated, hold no personal data and have no pieces. Repeated rows of one id are one group in near_dedup, of
which one row stays; a row without id stays there. Texts of any length are whole. Columns of any other name
pass through all stages but the last, which returns doc_id, lang, source and the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.llm import dartminhash, mil, pii, queries, suffix, wfst
from skytrace.llm.common import named, table
from skytrace.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the classifier, fitted on this stage's input, scores below 0.7."""
    model = queries.quality_model(docs, table(spark, sf_dir, "labels"))
    return mil.keep_good(docs, model, least=queries.QUALITY_AT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each class of near-duplicates."""
    return dartminhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents of which 5 percent of the words or more stand in benchmark passages."""
    return suffix.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the text (null for a null text)."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*[named(c) for c in docs.columns])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text."""
    return wfst.encode(docs, queries.vocabulary("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("personal_data", personal_data), ("sentencepiece", sentencepiece)]

#: A trained classifier, connected components and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
