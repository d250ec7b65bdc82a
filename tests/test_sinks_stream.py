"""CSV outputs (header + C-format rows), raw re-emission, and batch = stream."""

import glob
import os

from pyspark.sql import functions as F

from skytrace.plans import registry as R
from skytrace.session import local_fs_path, scratch_path
from skytrace.sinks.csv import csv_fanout, format_rows, header_line, write_frame_lake

SF = "/root/testdata/sf0.001"


def test_csv_files_have_header_and_c_rows(spark):
    lake, out = scratch_path(spark, "t-lake"), scratch_path(spark, "t-csv")
    write_frame_lake(R.classified(spark, SF), lake)
    paths = csv_fanout(spark, lake, out)
    assert sorted(paths) == sorted(["GGA", "VTG", "GSA", "NAV_DOP", "NAV_PVT", "NAV_HPPOSECEF", "NAV_HPPOSLLH",
                                    "NAV_RELPOSNED", "NAV_VELNED"])
    lines = []
    for f in sorted(glob.glob(os.path.join(local_fs_path(paths["NAV_DOP"]), "part-*.csv"))):
        with open(f, encoding="latin-1") as fh:
            content = fh.read().splitlines()
        if content:
            assert content[0] == header_line("NAV_DOP")
            lines += content[1:]
    from skytrace.operators.decode import decode
    want = [r.line for r in format_rows(decode(R.classified(spark, SF), "NAV_DOP"), "NAV_DOP").collect()]
    assert sorted(lines) == sorted(want) and len(want) > 0
    gga = format_rows(decode(R.classified(spark, SF), "GGA"), "GGA").collect()[0].line
    assert gga.split(",")[1].startswith('"') and gga.split(",")[1].endswith('"')


def test_raw_reemit_nmea_has_crlf(spark):
    rows = R.q_raw_reemit(spark, SF).collect()
    nmea = [r.raw_hex for r in rows if r.raw_hex.startswith("24")]
    assert nmea and all(h.endswith("0D0A") for h in nmea)


def test_stream_equals_batch(spark):
    batch = {tuple(r) for r in R.q_decode_quality(spark, SF).collect()}
    stream = {tuple(r) for r in R.q_stream_decode(spark, SF).select(*R.q_decode_quality(spark, SF).columns).collect()}
    assert batch == stream
    assert R.q_stream_thin(spark, SF).count() == 645
    kept_batch = {r.seq for r in R.thin(R._device_series(spark, SF), ["device_id"], "seq", "ts_us",
                                        6 * 3_600_000_000).collect()}
    assert {r.seq for r in R.q_stream_thin(spark, SF).collect()} == kept_batch


def test_stream_packs_equal_batch_packs(spark):
    from skytrace.operators.classify import classify
    from skytrace.operators.pack import pack_build, pack_sizes
    from skytrace.streaming.stream import FRAME_SCHEMA, pack_stream, read_frames_stream

    land = R._landing(spark, SF, "t-land-pack")
    # fixture frame far in the future: moves the watermark past every real window
    closer = spark.createDataFrame([(-1, 10 ** 12, 4_102_444_800_000_000, "NMEA", b"$GP", b"GGA,1", 5, False, "OK")],
                                   FRAME_SCHEMA)
    out, ck = scratch_path(spark, "t-pack-out"), scratch_path(spark, "t-pack-ck")
    packs = pack_stream(classify(read_frames_stream(spark, land, max_files_per_trigger=2)))
    q = (packs.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    # a later drop moves the watermark; the following no-data batch emits the closed windows
    closer.write.mode("append").parquet(land)
    q = (packs.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(map(tuple, pack_sizes(spark.read.parquet(out).filter("device_id >= 0")).collect()))
    want = sorted(map(tuple, pack_sizes(pack_build(R.classified(spark, SF), R.PACK_US)).collect()))
    assert got == want and len(want) > 0


def test_decimals_are_rounded_from_the_binary_value(spark):
    """Ties and near ties as C rounds them: Python's % operator is the same correctly rounded printf."""
    import random

    from skytrace.sinks.csv import fixed_text
    rng = random.Random(3)
    xs = [0.125, 1.005, 0.5, 1.5, 2.5, -0.0, 0.0, -1e-12, 1e-7, 0.0000005, 0.0000015, 2.0 ** -20, 123456789.123456789, 0.9999999999, 999999.9999995,
          -3.0000005, 2.0 ** 52 + 0.5, 2.0 ** 62, 1 / 3, 5e-324, float("nan"), float("inf"), float("-inf"), None]
    xs += [rng.choice([1, -1]) * rng.getrandbits(53) * 2.0 ** -rng.randrange(20, 80) for _ in range(3000)]
    xs += [(2 * rng.getrandbits(30) + 1) / 2 ** rng.randrange(1, 11) for _ in range(3000)]  # many exact ties
    xs += [float(f"{rng.randrange(10 ** 6)}.{rng.randrange(10 ** 7):07d}5") for _ in range(2000)]
    df = spark.createDataFrame([(i, x, x, x) for i, x in enumerate(xs)], "i int, a double, b double, c double")
    for r in fixed_text(df, {"a": 6, "b": 9, "c": 1}).collect():
        x = xs[r.i]
        want = [None] * 3 if x is None else [f % x for f in ("%.6f", "%.9f", "%.1f")]
        assert [r.a, r.b, r.c] == want, x


def test_a_changed_offset_in_the_engine_shows(spark, monkeypatch):
    """The oracle and the frames are stated apart from the engine's tables."""
    import dataclasses

    from oracle_check import compare

    from skytrace.functions import fields as FT
    assert compare(spark, SF, ["decode_velned"])["decode_velned"][0] == "OK"
    wrong = [dataclasses.replace(f, offset=f.offset + 1) if f.name == "speed" else f for f in FT.UBX_FIELDS["NAV_VELNED"]]
    monkeypatch.setitem(FT.UBX_FIELDS, "NAV_VELNED", wrong)
    assert compare(spark, SF, ["decode_velned"])["decode_velned"][0] == "MISMATCH"
