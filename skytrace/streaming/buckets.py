"""Keyed streaming state, many keys a group.

A call of a stateful Python operator costs milliseconds whatever it is given, so with a group for each key a micro-batch
costs a call for each key it holds. Here rows are grouped by a hash of their key: a micro-batch makes at most
``BUCKETS`` calls, each with the rows and the state of its keys, which are worked on together.

A key's rows of a micro-batch are in one task as before. A bucket's state is its share of the keys; the number
of buckets belongs to a checkpoint and is chosen when a stream is first started.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.thinning import fold_runs

BUCKETS = 1024
_NULL = "_null_"
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def dense(df: DataFrame, asis: tuple = ()) -> DataFrame:
    """Numbers without nulls, and flags where nulls were: pandas would turn a column of longs with a null into doubles.
    Columns named in ``asis`` stay as they are."""
    numbers = [c for c, t in df.dtypes if t in _NUMBERS and c not in asis]
    return df.select(*[F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c) if c in numbers else F.col(c) for c, t in df.dtypes],
                     *[F.col(c).isNull().alias(_NULL + c) for c in numbers])


def restored(rows: DataFrame, df: DataFrame, *more) -> DataFrame:
    """The columns of ``df`` from ``dense`` rows, and ``more`` of theirs as they are."""
    return rows.select(*[F.when(~F.col(_NULL + c), F.col(c)).alias(c) if t in _NUMBERS else F.col(c) for c, t in df.dtypes], *more)


def bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    known = [k for k in keys if _NULL + k in rows.columns]
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys, *[_NULL + k for k in known]), F.lit(buckets)).cast("int"))


class Keys:
    """The keys of a bucket: their columns (flags of ``dense`` included), and the state columns that hold them."""

    def __init__(self, columns: list[str], kinds: dict[str, str], keys: list[str]):
        self.columns = [*keys, *[_NULL + k for k in keys if _NULL + k in columns]]
        self.state = ", ".join(f"`{c}` array<{kinds[c]}>" for c in self.columns)

    def held(self, state) -> dict[tuple, int]:
        """Key -> its place in the state."""
        if state is None:
            return {}
        return {k: i for i, k in enumerate(zip(*state[:len(self.columns)], strict=True))}

    def places(self, known: dict[tuple, int], pdf: pd.DataFrame) -> np.ndarray:
        """The place of each row's key; new keys are added to ``known``."""
        rows = zip(*[pdf[c].tolist() for c in self.columns], strict=True)
        return np.fromiter((known.setdefault(k, len(known)) for k in rows), np.int64, len(pdf))

    def columns_of(self, known: dict[tuple, int]) -> list[list]:
        return [list(c) for c in zip(*known, strict=True)] or [[] for _ in self.columns]


def in_order(pdf: pd.DataFrame, at: np.ndarray, order: str) -> np.ndarray:
    """Positions of the rows by key place and order, nulls of the order last; stable."""
    nulls = pdf[_NULL + order].to_numpy(bool) if _NULL + order in pdf else np.zeros(len(pdf), bool)
    ranks = pdf[order].to_numpy() if pdf[order].dtype != object else pdf[order].rank(method="dense").to_numpy()
    return np.lexsort((ranks, nulls, at))


class Thinned:
    """Thinning of a bucket: the state is the last kept time of each of its keys."""

    def __init__(self, columns: list[str], kinds: dict[str, str], keys: list[str], order: str, ts: str, gap: int):
        self.columns, self.order, self.ts, self.gap = columns, order, ts, gap
        self.keys = Keys(columns, kinds, keys)
        self.state = f"{self.keys.state}, last array<bigint>"

    def fold(self, pdfs: list[pd.DataFrame], state) -> tuple[pd.DataFrame, tuple]:
        """(kept rows, state after them)"""
        pdf = pd.concat(pdfs, ignore_index=True)
        pdf.columns = self.columns  # names with a leading underscore come numbered
        known = self.keys.held(state)
        last = np.array([] if state is None else state[len(self.keys.columns)], np.int64)
        at = self.keys.places(known, pdf)
        last = np.append(last, np.zeros(len(known) - len(last), np.int64))
        by = in_order(pdf, at, self.order)
        at = at[by]
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        keep, after = fold_runs(pdf[self.ts].to_numpy(np.int64)[by], starts, last[at[starts]], self.gap)
        last[at[starts]] = after
        return pdf.iloc[by[keep]], (*self.keys.columns_of(known), last.tolist())
