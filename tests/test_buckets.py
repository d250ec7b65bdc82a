"""State of many keys a group: results of a fold per key, and calls bounded by the number of buckets."""

import random

import pytest
from pyspark.sql import functions as F

from skytrace.functions import fields as FT
from skytrace.operators.state import latest_state
from skytrace.operators.thinning import fold_keep
from skytrace.session import scratch_path
from skytrace.streaming import state
from skytrace.streaming.state import current_records, latest_records, latest_state_stream, rocksdb_state, thin_events
from skytrace.streaming.stream import thin_stream

GAP, BUCKETS = 25, 8
SCHEMA = "device_id long, message string, seq long, ts_us long, body binary"


@pytest.fixture(scope="module")
def rows():
    """Three drops of frames of 300 keys: null keys, ids that a float would merge, times that go back."""
    rng = random.Random(5)
    devices = [None, *[2 ** 53 + d for d in range(149)]]
    out = [(rng.choice(devices), rng.choice(["GGA", None]), 2 ** 60 + i, 10 * i % 997 + rng.randrange(60), b"b%d" % i) for i in range(2400)]
    return [out[i:i + 800] for i in (0, 800, 1600)]


def _run(spark, rows, name, work):
    """Files of one drop a micro-batch -> (rows written, most rows of state, rows of each micro-batch)."""
    land, out, ck = (scratch_path(spark, f"t-{name}-{x}") for x in ("land", "out", "ck"))
    for drop in rows:
        spark.createDataFrame(drop, SCHEMA).coalesce(1).write.mode("append").parquet(land)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(land)
    with rocksdb_state(spark):
        q = work(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.parquet(out), max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"])


def _by_key(rows):
    out = {}
    for r in sum(rows, []):
        out.setdefault(r[:2], []).append(r)
    return out


def _key(r):
    return str(tuple(r))


@pytest.mark.parametrize("events", [False, True])
def test_thinning_of_buckets_equals_a_fold_per_key(spark, rows, events):
    def work(df):
        if not events:
            return thin_stream(df, ["device_id", "message"], "seq", "ts_us", GAP, buckets=BUCKETS)
        timed = df.withColumn("_et", F.timestamp_micros("ts_us")).withWatermark("_et", "1 hour")
        return thin_events(timed, ["device_id", "message"], "seq", GAP, "_et", buckets=BUCKETS).drop("_et")

    got, state = _run(spark, rows, f"thin-{events}", work)
    want = []
    for own in _by_key(rows).values():
        want += [r for r, k in zip(own, fold_keep([r[3] for r in own], GAP), strict=True) if k]
    assert sorted(((r.device_id, r.message, r.seq, r.ts_us, bytes(r.body)) for r in got.collect()), key=_key) == sorted(want, key=_key)
    assert state <= BUCKETS  # groups of a micro-batch; one a key before


def test_newest_records_of_buckets(spark, rows):
    got, state = _run(spark, rows, "ring", lambda df: latest_records(df, ["device_id", "message"], "seq", 3, buckets=BUCKETS))
    assert got.columns == ["device_id", "message", "_order", "_row", "_entered"]
    keys = ["device_id", "message"]
    gone = [(*r[:2], r[2]) for r in got.filter("not _entered").collect()]
    kept = [(r.device_id, r.message, r._row.seq, r._row.ts_us, bytes(r._row.body)) for r in got.filter("_entered").collect()]
    assert sorted((r for r in kept if r[:3] not in set(gone)), key=_key) == sorted(sum((own[-3:] for own in _by_key(rows).values()), []), key=_key)
    assert state <= BUCKETS
    now = [(r.device_id, r.message, r.seq, r.idx) for r in current_records(got, keys).collect()]
    assert sorted(now, key=_key) == sorted(((*r[:3], i) for own in _by_key(rows).values() for i, r in enumerate(own[-3:])), key=_key)


@pytest.mark.parametrize("per_field", [True, False])
def test_latest_state_of_buckets_equals_the_batch(spark, monkeypatch, per_field):
    """All fields over three micro-batches, many keys a group: missing tokens, NaN, null devices, frames that do not
    parse, rows that leave in several pieces."""
    monkeypatch.setattr(state, "_PIECE", 16)
    rng = random.Random(3)
    sentences = [b"GGA,1", b"GGA,101010.00,4503.1,N,00700.5,E,4,08,nan,2.5,M,46.9,M,,0000", b"GGA,,,,,", b"VTG,nan,T,3.5,M,1,N,7,K", b"VTG",
                 b"GSA,A,3,01,02,,,,,,,,,,,1.5,inf,2", b"GSA,"]
    messages = [*FT.UBX_FIELDS, "UBX", "GGA", "GGA", "GGA", "VTG", "GSA", None]
    rows = []
    for i in range(1500):
        m = rng.choice(messages)
        body = rng.randbytes(rng.choice([6, 40, 100])) if m in FT.UBX_FIELDS else rng.choice([s for s in sentences if m and s[:3] == m.encode()] or [b"x"])
        rows.append((rng.choice([None, *[2 ** 53 + d for d in range(60)]]), m, 2 ** 60 + i, rng.choice([None, 2 ** 55 + i]), body))
    drops = [rows[i:i + 500] for i in (0, 500, 1000)]

    def parsed(df):
        return df.withColumn("parse_result", F.when(F.col("seq") % 7 != 0, "OK").otherwise("CHECKSUM"))

    every = {m: FT.columns(m) for m in FT.ALL_MESSAGES}
    got, kept = _run(spark, drops, f"latest-{per_field}", lambda df: latest_state_stream(parsed(df), every, per_field, buckets=BUCKETS))
    want = latest_state(parsed(spark.createDataFrame(rows, SCHEMA)), every, per_field)
    assert got.dtypes == want.dtypes
    got, want = (sorted(map(_key, df.collect())) for df in (got, want))
    assert got == want and len(got) == len(rows)
    assert sum("nan" in r for r in got) > 50
    assert kept <= BUCKETS  # one a key before
