"""Latest-known state: the scan over ranges equals a running fold; elapsed time."""

import random

import pytest

from skytrace.functions import fields as FT
from skytrace.functions import sqltext
from skytrace.operators import scan
from skytrace.operators.classify import classify
from skytrace.operators.scan import running_last
from skytrace.operators.state import elapsed_us, latest_state
from skytrace.sources.derive import frames_from_events

SEL = {"GGA": ["latitude", "fix", "age_of_correction"], "GSA": ["mode"], "NAV_PVT": ["lon", "magAcc"],
       "NAV_VELNED": ["speed"]}


def _cls(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return classify(frames_from_events(ev)).cache()


def _ranges(spark, n, f):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return sorted(map(tuple, f().collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_any_ranges_carry_the_same_state(spark):
    c = _cls(spark)
    for per_field in (True, False):
        got = [_ranges(spark, n, lambda p=per_field: latest_state(c, SEL, per_field=p)) for n in (1, 13)]
        assert got[0] == got[1] and len(got[0]) == 1000


def test_prefix_scan_equals_a_running_fold(spark):
    """A hot key over several ranges, null keys, any order values, values of every kind."""
    rng = random.Random(7)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([i, 2 ** 60 + i]), rng.choice([None, None, i / 7]),
             rng.choice([None, None, None, f"s{i}"]), rng.choice([None, None, (i, None)])) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, seq long, a double, b string, c struct<x:long,y:string>").repartition(5)
    want, last = [], {}
    for k, seq, *values in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        now = last.setdefault(k, [None] * 3)
        last[k] = now = [old if v is None else v for old, v in zip(now, values, strict=True)]
        want.append((k, seq, *now))
    for n in (1, 4, 11):
        got = _ranges(spark, n, lambda: running_last(df, ["k"], "seq", ["a", "b", "c"]).select("k", "seq", "a", "b", "c"))
        assert [(*r[:4], r[4] and tuple(r[4])) for r in got] == sorted(want, key=repr)
    assert running_last(df.limit(0), ["k"], "seq", ["a"]).collect() == []


def test_per_field_carries_missing_tokens(spark):
    c = _cls(spark)
    rows = latest_state(c, {"GGA": ["age_of_correction", "fix"]}, per_field=True).orderBy("device_id", "seq").collect()
    seen = {}
    for r in rows:  # once a device has a fix, a later sentence with missing tokens keeps it
        if r.GGA_fix is not None:
            seen[r.device_id] = True
        else:
            assert r.device_id not in seen


def test_elapsed(spark):
    df = spark.createDataFrame([(1, 1, 100), (1, 2, 150), (2, 5, 7), (1, 3, 90)], "device_id long, seq long, ts_us long")
    got = {(r.device_id, r.seq): r.elapsed_us for r in elapsed_us(df).collect()}
    assert got == {(1, 1): 0, (1, 2): 50, (1, 3): -10, (2, 5): 0}


def test_hot_keys_are_cut_into_chunks(spark, monkeypatch):
    """Chunks of about eight rows: null keys, null and equal orders, columns that are null throughout a chunk."""
    rng = random.Random(11)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([i, i, 2 ** 60 + i]), rng.choice([None] * 9 + [i / 7]),
             rng.choice([None, f"s{i}"]), rng.choice([None] * 20 + [(i, None)])) for i in range(400)]
    rows += [(1, None, 0.5, "first", None), (9, 5, 1.0, None, None)]
    rows += [(1, 200, i / 3, None, (i, "tie")) for i in range(30)]
    df = spark.createDataFrame(rows, "k long, seq long, a double, b string, c struct<x:long,y:string>").repartition(5)
    whole = sorted(map(tuple, running_last(df, ["k"], "seq", ["a", "b", "c"]).collect()), key=repr)
    monkeypatch.setattr(scan, "CHUNK", 8)
    cut = running_last(df, ["k"], "seq", ["a", "b", "c"])
    assert sorted(map(tuple, cut.collect()), key=repr) == whole and "_scan_chunk" in cut._jdf.queryExecution().toString()
    ties = [r for r in whole if r[:2] == (1, 200)]
    assert len(whole) == len(rows) and len({r[2] for r in ties}) >= 30  # every tied row is a step of the fold
    want, last = [], {}
    for k, seq, *values in sorted((r for r in rows if r[1] != 200), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        now = last.setdefault(k, [None] * 3)
        last[k] = now = [old if v is None else v for old, v in zip(now, values, strict=True)]
        if seq is None or seq < 200:
            want.append((k, seq, *now))
    got = [(*r[:4], r[4] and tuple(r[4])) for r in whole if r[1] is None or r[1] < 200]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert running_last(df.limit(0), ["k"], "seq", ["a"]).collect() == []


def test_state_is_kept_over_any_number_of_rows(spark):
    """A key with more rows than an Arrow batch holds (10,000) in one task: the carry lost its state between batches."""
    df = spark.range(0, 12_000, 1, 1).selectExpr("1L AS k", "id AS seq", "CASE WHEN id IN (3, 11000) THEN id END AS a")
    got = running_last(df, ["k"], "seq", ["a"]).groupBy("a").count().collect()
    assert {(r.a, r["count"]) for r in got} == {(None, 3), (3, 10_997), (11_000, 1000)}


@pytest.mark.parametrize("per_field", [True, False])
def test_frames_are_decoded_and_carried_in_the_jvm(spark, per_field):
    """All 105 fields: no row goes through Python, and the decode text names no value twice."""
    df = latest_state(_cls(spark), {m: FT.columns(m) for m in FT.ALL_MESSAGES}, per_field=per_field)
    assert "MapInArrow" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sqltext.ubx_values("NAV_PVT")["velN"].count("body") == 4  # one substr a byte


def test_fields_of_a_ubx_frame_are_never_null(spark):
    """Also where the frame is short: bytes beyond its end are zeros. So a message is carried as one struct."""
    ubx = {m: FT.columns(m) for m in FT.UBX_FIELDS}
    rows = [(i, i, 1, m, "OK", bytes([1, 7, 0, 0, *[255] * n])) for i, (m, n) in enumerate((m, n) for m in ubx for n in (0, 1, 7, 23, 300))]
    c = spark.createDataFrame(rows, "device_id long, seq long, ts_us long, message string, parse_result string, body binary")
    one, other = (sorted(map(tuple, latest_state(c, ubx, per_field=p).collect())) for p in (True, False))
    assert one == other and len(one) == len(rows)
    for r in one:
        own = [r[3 + i] for i, (m, f) in enumerate((m, f) for m in ubx for f in ubx[m]) if m == rows[r[0]][3]]
        assert None not in own
