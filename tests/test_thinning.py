"""Greedy minimum-gap thinning: fixtures, random property checks, partition invariance."""

import random

import numpy as np
import pytest

from skytrace.operators.thinning import fold_keep, rate_to_gap_us, thin

CASES = [
    ([1000000, 1000040, 1000100, 1000150, 1000200], 100, [1000000, 1000100, 1000200]),
    ([1000000, 1000060, 1000120, 1000170, 1000230], 100, [1000000, 1000120, 1000230]),
    ([1000000, 1000050, 999990, 1000080, 1000090], 100, [1000000, 999990, 1000090]),
    ([1000000, 1000000, 1000000], 0, [1000000] * 3),
    ([1000000, 1000000, 1000001], 1, [1000000, 1000001]),
    ([0, 0, 0], 1, []),
]


def sequential(ts, gap):
    last, out = 0, []
    for t in ts:
        if gap <= 0 or t < last or t - last >= gap:
            out.append(t)
            last = t
    return out


@pytest.mark.parametrize("ts,gap,exp", CASES)
def test_fixture_fold(ts, gap, exp):
    k = fold_keep(np.array(ts), gap)
    assert [t for t, x in zip(ts, k) if x] == exp


@pytest.mark.parametrize("ts,gap,exp", CASES)
def test_fixture_spark(spark, ts, gap, exp):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(ts)], "device_id long, seq long, ts_us long")
    got = [r.ts_us for r in thin(df, ["device_id"], "seq", "ts_us", gap).orderBy("seq").collect()]
    assert got == exp


def test_random_vs_sequential(spark):
    rng = random.Random(7)
    rows, expect = [], {}
    for dev in range(40):
        t, ts = rng.randint(0, 50), []
        for _ in range(rng.randint(1, 120)):
            t += rng.choice([0, 1, 3, 7, 20, 60, -5, -40])
            ts.append(max(t, 0))
        expect[dev] = sequential(ts, 25)
        rows += [(dev, i, x) for i, x in enumerate(ts)]
    df = spark.createDataFrame(rows, "device_id long, seq long, ts_us long")
    for parts in (1, 4, 64):
        got = {}
        for r in thin(df.repartition(parts), ["device_id"], "seq", "ts_us", 25).orderBy("device_id", "seq").collect():
            got.setdefault(r.device_id, []).append(r.ts_us)
        assert {d: got.get(d, []) for d in expect} == expect


def test_rate_to_gap():
    assert rate_to_gap_us(0) == 0 and rate_to_gap_us(1) == 1_000_000 and rate_to_gap_us(3) == 333_334


def test_events_counts(spark):
    from pyspark.sql import functions as F
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").alias("device_id"), F.col("event_id").alias("seq"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))
    assert thin(ev, ["device_id"], "seq", "ts_us", 6 * 3_600_000_000).count() == 645


@pytest.mark.parametrize("stretch_rows", [1, 3, 17, 1 << 18])
def test_stitched_vs_sequential(spark, stretch_rows):
    rng = random.Random(11 + stretch_rows)
    rows, expect = [], {}
    devices = [None, *(2 ** 53 + i for i in range(5)), -3, 0]
    for dev in devices:
        t, ts = rng.randint(0, 50), []
        mono = dev is None or dev % 2 == 0
        for _ in range(rng.randint(1, 300)):
            t += rng.choice([0, 1, 3, 7, 20, 60] if mono else [0, 1, 3, 7, 20, 60, -5, -40])
            ts.append(max(t, 0))
        expect[dev] = sequential(ts, 25)
        rows += [(dev, 1000 + i if i else -10 ** 15, x) for i, x in enumerate(ts)]
    df = spark.createDataFrame(rows, "device_id long, seq long, ts_us long").repartition(5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
        got = {}
        for r in thin(df, ["device_id"], "seq", "ts_us", 25, stretch_rows).collect():
            got.setdefault(r.device_id, []).append((r.seq, r.ts_us))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {d: [x for _, x in sorted(got.get(d, []))] for d in devices} == expect


@pytest.mark.parametrize(("gap", "mono"), [(500_000, False), (10 ** 9, True), (30, True)])
def test_one_hot_key_is_cut_into_ranges(spark, gap, mono):
    """A non-monotone key of 200,000 rows, an outlying order value, a gap longer than a stretch."""
    from pyspark.sql import functions as F

    from skytrace.operators import thinning

    rng = np.random.default_rng(5)
    ts = np.sort(rng.integers(0, 10 ** 7, 200_000)) if mono else rng.integers(0, 10 ** 6, 200_000)
    last, expect = 0, []
    for t in ts.tolist():
        if t < last or t - last >= gap:
            last = t
            expect.append(t)
    import pandas as pd
    seq = np.arange(len(ts))
    seq[-1] = 2 ** 60
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "seq": seq, "ts_us": ts})).repartition(8)
    sizes = []
    original = thinning.materialise

    def spy(d, name):
        out = original(d, name)
        rows = out.filter("_mark < 3") if "_mark" in out.columns else out  # without the summaries
        sizes.extend(r["count"] for r in rows.groupBy(F.input_file_name()).count().collect())
        return out

    thinning.materialise = spy
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = thin(df, ["k"], "seq", "ts_us", gap, stretch_rows=4096).orderBy("seq").collect()
    finally:
        thinning.materialise = original
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.ts_us for r in got] == expect
    assert max(sizes) < len(ts) / 4  # the hot key is spread evenly over the ranges


def test_rows_without_time_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 50), (None, None, 70), (1, 3, 60)], "device_id long, seq long, ts_us long")
    got = sorted((tuple(r) for r in thin(df, ["device_id"], "seq", "ts_us", 20).collect()), key=str)
    assert got == [(1, 2, 50), (None, None, 70)]
    assert thin(df.limit(0), ["device_id"], "seq", "ts_us", 20).count() == 0


def test_further_columns_are_joined_back_and_do_not_change_the_choice(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(3), i, rng.randrange(10 ** 6), f"row {i}") for i in range(500)]
    rows += rows[:40]  # repeated rows
    df = spark.createDataFrame(rows, "k long, seq long, ts_us long, body string").repartition(5)
    narrow = thin(df.drop("body"), ["k"], "seq", "ts_us", 50_000)
    wide = thin(df, ["k"], "seq", "ts_us", 50_000)
    assert wide.columns == df.columns
    assert sorted(map(tuple, wide.drop("body").collect())) == sorted(map(tuple, narrow.collect()))
    assert all(r.body == f"row {r.seq}" for r in wide.collect())


def test_the_input_is_evaluated_once(spark):
    """The checksum UDF is in the written input alone, neither in the sampling of ranges nor behind it."""
    from skytrace.plans import registry as R
    got = thin(R._ok_series(spark, "/root/testdata/sf0.001"), ["device_id", "message"], "seq", "ts_us", 10 ** 9)
    plan = got._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_ranges_cut_anywhere_give_the_fold(spark):
    """Many small ranges of few keys: open, decided and summary rows of every kind."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rng = random.Random(9)
        for keys, gap in ((1, 700), (2, 5), (40, 300)):
            rows = [(rng.randrange(keys), i, rng.choice([i * 10, rng.randrange(4000)])) for i in range(400)]
            df = spark.createDataFrame(rows, "k long, seq long, ts_us long")
            want = []
            for k in range(keys):
                mine = [(s, t) for q, s, t in rows if q == k]
                want += [(k, s, t) for (s, t), keep in zip(mine, sequential([t for _, t in mine], gap), strict=True) if keep]
            assert sorted(map(tuple, thin(df, ["k"], "seq", "ts_us", gap, stretch_rows=3).collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_further_columns_are_joined_back_and_do_not_change_the_choice(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(3), i, rng.randrange(10 ** 6), f"row {i}") for i in range(500)]
    rows += rows[:40]  # repeated rows
    df = spark.createDataFrame(rows, "k long, seq long, ts_us long, body string").repartition(5)
    narrow = thin(df.drop("body"), ["k"], "seq", "ts_us", 50_000)
    wide = thin(df, ["k"], "seq", "ts_us", 50_000)
    assert wide.columns == df.columns
    assert sorted(map(tuple, wide.drop("body").collect())) == sorted(map(tuple, narrow.collect()))
    assert all(r.body == f"row {r.seq}" for r in wide.collect())


def test_the_input_is_evaluated_once(spark):
    """The checksum UDF is in the written input alone, neither in the sampling of ranges nor behind it."""
    from skytrace.plans import registry as R
    got = thin(R._ok_series(spark, "/root/testdata/sf0.001"), ["device_id", "message"], "seq", "ts_us", 10 ** 9)
    plan = got._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_ranges_cut_anywhere_give_the_fold(spark):
    """Many small ranges of few keys: open, decided and summary rows of every kind."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rng = random.Random(9)
        for keys, gap in ((1, 700), (2, 5), (40, 300)):
            rows = [(rng.randrange(keys), i, rng.choice([i * 10, rng.randrange(4000)])) for i in range(400)]
            df = spark.createDataFrame(rows, "k long, seq long, ts_us long")
            want = []
            for k in range(keys):
                mine = [(s, t) for q, s, t in rows if q == k]
                keep = fold_keep(np.array([t for _, t in mine]), gap)
                assert [t for (_, t), f in zip(mine, keep, strict=True) if f] == sequential([t for _, t in mine], gap)
                want += [(k, s, t) for (s, t), f in zip(mine, keep, strict=True) if f]
            assert sorted(map(tuple, thin(df, ["k"], "seq", "ts_us", gap, stretch_rows=3).collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
