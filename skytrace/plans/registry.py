"""Registered queries: each takes (spark, sf_dir), reads the given tables and returns a DataFrame.

All GNSS frames are derived from ``events`` (see ``sources.derive``), so every query's work
grows with the table. Binary and nested values are returned as hex text / flat rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fields as FT
from ..functions import sqltext
from ..functions.binary import ubx_checksum_ok_vectorized, ubx_header
from ..functions.names import fix_mode_name, message_code, message_name, parse_result_name
from ..functions.text import latin1, nmea_checksum_ok, tokenize
from ..operators.classify import classify
from ..operators.decode import decode
from ..operators.pack import pack_build, pack_entries, pack_long, pack_sizes
from ..operators.report import decode_quality
from ..operators.reshape import aligned_series, series_long, series_pivot, series_slice, unpack_series
from ..operators.state import buffer_readout, elapsed_us, latest_n, latest_state, trim_series
from ..operators.thinning import downsample_rate, resample, thin
from ..session import scratch_path
from ..sinks.csv import csv_fanout, format_rows, header_line, write_clustered, write_frame_lake
from ..sinks.raw import capture_record, grow_captures, raw_frame, write_captures
from ..sources.capture import deframe, scan_captures, stream_captures
from ..sources.capture_source import RANGE_BYTES
from ..sources.derive import frames_from_events
from ..streaming.state import current_records, latest_records, latest_state_stream, rate_packs, run_to_table
from ..streaming.stream import (FRAME_SCHEMA, csv_fanout_stream, decode_stream, latest_report, read_frames_stream,
                                report_stream, run_available_now, thin_stream)

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
SERIES_N = 3           # ring capacity used by the checks, small so that rows are evicted (the engine default is 2000)
RESAMPLE_US = 6 * HOUR_US
STREAM_GAP_US = 6 * HOUR_US
LANDING_FILES = 2      # files per drop and per trigger of the streaming checks
LANDING_GROUP = 8 << 20
DOWNSAMPLE_HZ = 1.0 / 3600.0
PACK_US = DAY_US


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")


_FRAME_TABLES: dict[tuple, str] = {}


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """The frame table derived from ``events``, written once per session to the shared folder.

    Every operator starts from a frame table; materialising the derived one keeps each
    query's plan to the operator itself and cuts the lineage back to ``events``.
    """
    key = _version(spark, sf)
    path = _FRAME_TABLES.get(key)
    if path is None:
        path = scratch_path(spark, "frames")
        # the derivation is one very wide projection: whole-stage codegen only burns time compiling it before
        # falling back, so it is off in the session of this write
        own = spark.newSession()
        for k, v in (("spark.sql.codegen.wholeStage", "false"), ("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))):
            own.conf.set(k, v)
        frames_from_events(events(own, sf)).write.parquet(path)
        _FRAME_TABLES[key] = path
    return spark.read.parquet(path)


def _version(spark: SparkSession, sf: str) -> tuple:
    """What a derived table is kept under: the application, the table's path, and when and how large it was written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/events.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.sparkContext.applicationId, sf.rstrip("/"), fs.getFileStatus(path).getModificationTime(), fs.getContentSummary(path).getLength()


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify(frames(spark, sf))


_LAKES: dict[tuple, str] = {}


def lake(spark: SparkSession, sf: str) -> DataFrame:
    """Classified frames written once per session, partitioned by message.

    Per-message operators (reshape, packs, CSV fan-out) read it with partition pruning.
    """
    key = _version(spark, sf)
    path = _LAKES.get(key)
    if path is None:
        path = scratch_path(spark, "lake")
        write_frame_lake(classified(spark, sf), path)
        _LAKES[key] = path
    return spark.read.parquet(path)


# --------------------------------------------------------------------- classify / report
def q_decode_quality(spark, sf):
    return decode_quality(classified(spark, sf))


def q_parse_status(spark, sf):
    return classified(spark, sf).select("device_id", "seq", "protocol", "message", "parse_result")


def q_match_nmea(spark, sf):
    """NMEA message match, plus the sentence checksum as a diagnostic column (never a filter)."""
    c = classified(spark, sf).filter(F.col("protocol") == "NMEA")
    return c.select("device_id", "seq", "message",
                    nmea_checksum_ok(F.col("start_seq"), latin1(F.col("body"))).alias("nmea_checksum_ok"))


def q_match_ubx(spark, sf):
    c = classified(spark, sf).filter(F.col("protocol") == "UBX")
    return c.select("device_id", "seq", _le(0, "u1").alias("cls"), _le(1, "u1").alias("msg_id"), "message")


def q_match_unsupported(spark, sf):
    return (classified(spark, sf).filter(F.col("parse_result") == "NO_MATCH")
            .select("device_id", "seq", "protocol"))


def q_ubx_checksum(spark, sf):
    c = frames(spark, sf).filter(F.col("protocol") == "UBX")
    return c.select("device_id", "seq", ubx_header(F.col("body"))["length"].cast("bigint").alias("length"),
                    ubx_checksum_ok_vectorized(F.col("body")).alias("checksum_ok"))


def q_ubx_header(spark, sf):
    h = ubx_header(F.col("body"))
    return (frames(spark, sf).filter(F.col("protocol") == "UBX")
            .select("device_id", "seq", h["cls"].cast("bigint").alias("cls"), h["id"].cast("bigint").alias("msg_id"),
                    h["length"].cast("bigint").alias("length"), h["ck_a"].cast("bigint").alias("ck_a"),
                    h["ck_b"].cast("bigint").alias("ck_b")))


def q_message_names(spark, sf):
    c = classified(spark, sf)
    code = message_code(F.col("protocol"), F.col("message"))
    return c.select("device_id", "seq", "protocol", code.cast("bigint").alias("code"),
                    message_name(F.col("protocol"), code).alias("name"))


def q_parse_result_names(spark, sf):
    c = classified(spark, sf)
    code = F.array_position(F.array(*[F.lit(x) for x in FT.PARSE_RESULTS]), F.col("parse_result")) - 1
    return (c.groupBy(code.cast("bigint").alias("parse_code")).agg(F.count(F.lit(1)).alias("frames"))
            .select("parse_code", parse_result_name(F.col("parse_code")).alias("parse_result"), "frames"))


def _le(offset: int, wire: str) -> F.Column:
    return F.expr(sqltext.le_int("body", offset, wire))


def _decode_query(message):
    def q(spark, sf):
        return decode(classified(spark, sf), message)
    return q


def q_le_fields(spark, sf):
    c = classified(spark, sf).filter((F.col("protocol") == "UBX") & (F.col("parse_result") == "OK"))
    return c.select("device_id", "seq", _le(0, "u1").alias("u1_0"), _le(2, "u2").alias("u2_2"), _le(4, "u4").alias("u4_4"),
                    _le(4, "i4").alias("i4_4"), _le(4, "i1").alias("i1_4"), _le(5, "i2").alias("i2_5"))


def _nmea_tokens(spark, sf):
    c = frames(spark, sf).filter(F.col("protocol") == "NMEA")
    return c.select("device_id", "seq", F.posexplode(tokenize(latin1(F.col("body")))).alias("k", "token"))


def q_tokenize_sentence(spark, sf):
    return _nmea_tokens(spark, sf).select("device_id", "seq", F.col("k").cast("bigint").alias("k"), "token")


def q_numeric_prefix(spark, sf):
    t = _nmea_tokens(spark, sf).filter(F.col("k") >= 1)
    return t.select("device_id", "seq", F.col("k").cast("bigint").alias("k"), F.expr(sqltext.numeric_prefix("token")).alias("value"))


def q_deg_min_to_deg(spark, sf):
    c = classified(spark, sf).filter(F.col("message") == "GGA").withColumn("tokens", tokenize(latin1(F.col("body"))))
    t = c.select("device_id", "seq", F.col("tokens")[2].alias("t2"), F.col("tokens")[4].alias("t4"))
    t = t.select("device_id", "seq", F.expr(sqltext.numeric_prefix("t2")).alias("lat_raw"), F.expr(sqltext.numeric_prefix("t4")).alias("lon_raw"))
    return t.select("*", F.expr(sqltext.deg_min_to_deg("lat_raw")).alias("latitude"), F.expr(sqltext.deg_min_to_deg("lon_raw")).alias("longitude"))


def q_fix_state_name(spark, sf):
    return decode(classified(spark, sf), "GGA").select("device_id", "seq", "fix", "fix_state")


def q_fix_mode_name(spark, sf):
    c = classified(spark, sf).filter(F.col("message") == "GSA")
    c = c.withColumn("token", tokenize(latin1(F.col("body")))[2])
    mode = F.expr(sqltext.numeric_prefix("token")).cast("bigint")
    return c.select("device_id", "seq", mode.alias("fix_mode"), fix_mode_name(mode).alias("fix_mode_name"))


# ------------------------------------------------------------------------------ thinning
def _device_series(spark, sf):
    return frames(spark, sf).select("device_id", "seq", "ts_us")


def _thin_query(gap_us):
    def q(spark, sf):
        return thin(_device_series(spark, sf), ["device_id"], "seq", "ts_us", gap_us)
    return q


CHECK_STRETCH_ROWS = 8   # short stretches, so that keys are stitched from many at test scale


def q_thin_48h_chunked(spark, sf):
    """thin_48h with every device's series stitched from stretches of about 8 rows."""
    return thin(_device_series(spark, sf), ["device_id"], "seq", "ts_us", 48 * HOUR_US,
                stretch_rows=CHECK_STRETCH_ROWS)


ID_OFFSET = 1 << 53    # ids that a float key would merge


def q_thin_null_keys(spark, sf):
    """Thinning with a null device (one hot key made of every seventh) and ids above 2**53."""
    wide = F.when(F.col("device_id") % 7 != 0, F.col("device_id") + F.lit(ID_OFFSET))
    return thin(_device_series(spark, sf).withColumn("device_id", wide), ["device_id"], "seq", "ts_us", HOUR_US)


def _ok_series(spark, sf):
    return (classified(spark, sf).filter(F.col("parse_result") == "OK")
            .select("device_id", "message", "seq", "ts_us"))


def q_downsample_rate(spark, sf):
    return downsample_rate(_ok_series(spark, sf), DOWNSAMPLE_HZ)


def q_resample_us(spark, sf):
    return resample(_ok_series(spark, sf), RESAMPLE_US)


def _landing(spark, sf, name):
    """Frames written to a landing folder in three arrival-ordered drops (one per 10 days)."""
    land = scratch_path(spark, name)
    f = frames(spark, sf)
    lo = F.unix_micros(F.lit("2024-01-11 00:00:00").cast("timestamp"))
    hi = F.unix_micros(F.lit("2024-01-21 00:00:00").cast("timestamp"))
    # frames without a time (a live source's) arrive first
    for cond in [F.col("ts_us").isNull() | (F.col("ts_us") < lo), (F.col("ts_us") >= lo) & (F.col("ts_us") < hi), F.col("ts_us") >= hi]:
        # small row groups: a file is read by many tasks
        f.filter(cond).repartition(2).write.option("parquet.block.size", LANDING_GROUP).mode("append").parquet(land)
    return land


def q_stream_thin(spark, sf):
    land = _landing(spark, sf, "land-thin")
    out, ck = scratch_path(spark, "thin-out"), scratch_path(spark, "thin-ck")
    stream = read_frames_stream(spark, land, max_files_per_trigger=2).select("device_id", "seq", "ts_us")
    kept = thin_stream(stream, ["device_id"], "seq", "ts_us", STREAM_GAP_US)
    q = (kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def q_stream_thin_message(spark, sf):
    """Streaming thinning per device and message of the frames that decode."""
    land = _landing(spark, sf, "land-thin-message")
    out, ck = scratch_path(spark, "thin-message-out"), scratch_path(spark, "thin-message-ck")
    stream = classify(read_frames_stream(spark, land, max_files_per_trigger=LANDING_FILES))
    ok = stream.filter(F.col("parse_result") == "OK").select("device_id", "message", "seq", "ts_us")
    kept = thin_stream(ok, ["device_id", "message"], "seq", "ts_us", STREAM_GAP_US)
    q = (kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def q_stream_decode(spark, sf):
    land = _landing(spark, sf, "land-decode")
    out, ck = scratch_path(spark, "decode-out"), scratch_path(spark, "decode-ck")
    decode_stream(spark, land, out, ck, max_files_per_trigger=2)
    return (spark.read.parquet(out).groupBy("device_id", "protocol", "message", "parse_result")
            .agg(F.count(F.lit(1)).alias("frames")))


def q_stream_quality(spark, sf):
    land = _landing(spark, sf, "land-report")
    out, ck = scratch_path(spark, "report-out"), scratch_path(spark, "report-ck")
    report_stream(spark, land, out, ck, max_files_per_trigger=2)
    return latest_report(spark, out)


def q_stream_latest_n(spark, sf):
    """The newest SERIES_N whole records per device and message, kept in list state."""
    land = _landing(spark, sf, "land-ring")
    out, ck = scratch_path(spark, "ring-out"), scratch_path(spark, "ring-ck")
    stream = classify(read_frames_stream(spark, land, max_files_per_trigger=2)).filter(F.col("parse_result") == "OK")
    rows = stream.select("device_id", "message", "seq", "ts_us", "protocol", F.hex("body").alias("body_hex"))
    run_to_table(latest_records(rows, ["device_id", "message"], "seq", SERIES_N), out, ck)
    return current_records(spark.read.parquet(out), ["device_id", "message"])


def _all_fields():
    return {m: FT.columns(m) for m in FT.ALL_MESSAGES}


def q_stream_latest_state(spark, sf):
    """latest_state over all fields of the nine messages, as a stream of several micro-batches."""
    land = _landing(spark, sf, "land-latest")
    out, ck = scratch_path(spark, "latest-out"), scratch_path(spark, "latest-ck")
    frames_in = classify(read_frames_stream(spark, land, max_files_per_trigger=2))
    run_to_table(latest_state_stream(frames_in, _all_fields(), per_field=True), out, ck)
    return spark.read.parquet(out)


def q_stream_packs_rate(spark, sf):
    """Streaming packs of rate-limited records; a frame far in the future closes the last windows."""
    land = _landing(spark, sf, "land-packs")
    out, ck = scratch_path(spark, "packs-out"), scratch_path(spark, "packs-ck")
    packs = rate_packs(classify(read_frames_stream(spark, land, max_files_per_trigger=2)), DOWNSAMPLE_HZ)
    run_to_table(packs, out, ck)
    later = (frames(spark, sf).groupBy().agg(F.max("ts_us").alias("last")).select(
        F.lit(-1).cast("bigint").alias("device_id"), F.lit(-1).cast("bigint").alias("seq"),
        (F.col("last") + F.lit(10 * DAY_US)).alias("ts_us"), F.lit("NMEA").alias("protocol"), F.lit(b"$GP").alias("start_seq"),
        F.lit(b"GGA,1").alias("body"), F.lit(5).alias("body_len"), F.lit(False).alias("truncated"), F.lit("OK").alias("status")))
    later.write.mode("append").parquet(land)
    run_to_table(packs, out, ck)
    return pack_long(spark.read.parquet(out).filter("device_id >= 0"))


def q_stream_arrival(spark, sf):
    """Frames of a live source carry no time: every fifth has its time removed and is stamped at arrival."""
    land, out, ck = scratch_path(spark, "land-live"), scratch_path(spark, "live-out"), scratch_path(spark, "live-ck")
    given = F.when(F.col("seq") % 5 != 0, F.col("ts_us"))
    frames(spark, sf).withColumn("ts_us", given).repartition(4).write.parquet(land)
    began = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    run_available_now(read_frames_stream(spark, land, max_files_per_trigger=2), out, ck)
    late = F.unix_micros(F.current_timestamp())
    stamped = (F.col("ts_us") >= F.lit(began)) & (F.col("ts_us") <= late)
    return spark.read.schema(FRAME_SCHEMA).parquet(out).select(
        "device_id", "seq", stamped.alias("stamped"), F.when(~stamped, F.col("ts_us")).alias("ts_us"))


GROWTH = [0.31, 0.67, 1.0]     # shares of a capture after each step of its growth; cuts fall inside frames


def q_stream_capture(spark, sf):
    """Captures that grow while a stream reads them, in steps that end in the middle of frames."""
    whole = _write_captures(spark, sf, "cap-whole")
    land, out, ck = scratch_path(spark, "cap-live"), scratch_path(spark, "cap-live-out"), scratch_path(spark, "cap-live-ck")
    for share in GROWTH:
        grow_captures(spark, whole, land, share)
        run_available_now(stream_captures(spark, land, range_bytes=SMALL_RANGE), out, ck)
    rows = deframe(_device(spark.read.parquet(out)))
    return rows.select("device_id", "ts_us", "protocol", F.hex("start_seq").alias("start_hex"), F.hex("body").alias("body_hex"),
                       F.col("body_len").cast("bigint").alias("body_len"), "truncated", "status")


UNFINISHED_EVERY, LOST_BYTES = 5, 8


def q_capture_unfinished(spark, sf):
    """Every fifth UBX frame loses its last bytes: a frame is read by its declared length, so the record behind it is lost."""
    whole = raw_frame(F.col("start_seq"), F.col("body"), F.col("protocol"))
    cut = (F.col("protocol") == "UBX") & (F.col("seq") % UNFINISHED_EVERY == 0)
    raw = F.when(cut, F.substring(whole, F.lit(1), F.octet_length(whole) - LOST_BYTES)).otherwise(whole)
    r = _captures(spark, sf, "cap-unfinished", raw=raw, split=True)
    d = deframe(r)
    return d.select("device_id", "rec_no", "ts_us", F.hex("raw").alias("raw_hex"), "status")


def q_stream_csv_fanout(spark, sf):
    land = _landing(spark, sf, "land-csv")
    out, ck = scratch_path(spark, "csvs-out"), scratch_path(spark, "csvs-ck")
    csv_fanout_stream(spark, land, out, ck, max_files_per_trigger=2)
    return _csv_lines(spark, out)


# ------------------------------------------------------------------------- state / series
LATEST_SELECTION = {
    "GGA": ["latitude", "fix", "age_of_correction"],
    "VTG": ["speed_kmh"],
    "GSA": ["mode"],
    "NAV_DOP": ["gDOP"],
    "NAV_PVT": ["lon"],
    "NAV_HPPOSECEF": ["ecefX"],
    "NAV_HPPOSLLH": ["lat"],
    "NAV_RELPOSNED": ["relPosN"],
    "NAV_VELNED": ["speed"],
}


def q_latest_state(spark, sf):
    return latest_state(lake(spark, sf), LATEST_SELECTION, per_field=True)


def q_latest_state_all(spark, sf):
    """Every field of the nine messages, each carried forward on its own."""
    return latest_state(lake(spark, sf), _all_fields(), per_field=True)


def q_latest_record_all(spark, sf):
    """Every field of the nine messages, of the latest record of each message as a whole."""
    return latest_state(lake(spark, sf), _all_fields(), per_field=False)


def q_latest_n(spark, sf):
    return latest_n(_ok_series(spark, sf), capacity=SERIES_N).select("device_id", "message", "seq", "idx")


def q_buffer_readout(spark, sf):
    return buffer_readout(_ok_series(spark, sf), "ts_us", capacity=SERIES_N, at_index=1)


def q_trim_series(spark, sf):
    return (trim_series(_ok_series(spark, sf), capacity=SERIES_N, drop_oldest=1, drop_newest=1)
            .select("device_id", "message", "seq", "idx"))


def q_elapsed_us(spark, sf):
    return elapsed_us(_device_series(spark, sf)).select("device_id", "seq", "elapsed_us")


BUCKETS = 8
_CLUSTERED: dict[tuple, str] = {}


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """The frames that decode, bucketed by device and sorted by arrival."""
    key = _version(spark, sf)
    if key not in _CLUSTERED:
        path = scratch_path(spark, "by-device")
        name = "frames_" + path.rsplit("-", 1)[-1]
        write_clustered(lake(spark, sf).filter(F.col("parse_result") == "OK").select("device_id", "message", "seq", "ts_us", "body"),
                        path, name, ["device_id"], "seq", BUCKETS)
        _CLUSTERED[key] = name
    return spark.table(_CLUSTERED[key])


def q_elapsed_us_clustered(spark, sf):
    """elapsed_us of the frames that decode, over the clustered table: no exchange of frames."""
    return elapsed_us(clustered(spark, sf).select("device_id", "seq", "ts_us")).select("device_id", "seq", "elapsed_us")


def q_latest_n_clustered(spark, sf):
    """latest_n over the clustered table: no exchange of frames."""
    return latest_n(clustered(spark, sf).select("device_id", "message", "seq"), capacity=SERIES_N)


def q_signals_long(spark, sf):
    return series_long(lake(spark, sf), "signals")


def q_strings_long(spark, sf):
    return series_long(lake(spark, sf), "strings")


def q_enums_long(spark, sf):
    return series_long(lake(spark, sf), "enums")


def q_series_pivot(spark, sf):
    return series_pivot(series_long(lake(spark, sf), "signals", messages=["NAV_DOP"]), "NAV_DOP")


def _pivot_query(message):
    def q(spark, sf):
        return series_pivot(series_long(lake(spark, sf), "signals", messages=[message]), message)
    return q


def q_aligned_series(spark, sf):
    """The aligned series of every device, flattened; ``timestamp`` is the aligned element of ``_timestamp``."""
    rows = aligned_series(lake(spark, sf), capacity=SERIES_N).select("device_id", F.explode("series").alias("message", "fields"))
    rows = rows.select("device_id", "message", F.col("fields")["_timestamp"].alias("_times"), F.explode("fields").alias("field", "_values"))
    rows = rows.select("device_id", "message", "field", "_times", F.posexplode("_values").alias("idx", "value"))
    return rows.select("device_id", "message", "field", F.col("idx").cast("bigint").alias("idx"), F.col("_times")[F.col("idx")].alias("timestamp"), "value")


def q_series_slice(spark, sf):
    """Lookup by slice: two elements from position 1 of a few fields of every device."""
    rows = aligned_series(lake(spark, sf), capacity=SERIES_N)
    wanted = [("GGA", "latitude"), ("PVT", "lon"), ("DOP", "gDOP"), ("VELNED", "speed")]
    parts = [F.struct(F.lit(m).alias("message"), F.lit(f).alias("field"), series_slice(F.col("series"), m, f, 1, 2).alias("vs")) for m, f in wanted]
    rows = rows.select("device_id", F.inline(F.array(*parts)))
    return rows.select("device_id", "message", "field", F.posexplode("vs").alias("k", "value")).withColumn("k", F.col("k").cast("bigint"))


# ---------------------------------------------------------------------------------- packs
def q_pack_sizes(spark, sf):
    return pack_sizes(pack_build(lake(spark, sf), PACK_US))


def q_pack_build(spark, sf):
    return _pack_ends(pack_build(lake(spark, sf), PACK_US))


def q_pack_build_rate(spark, sf):
    """Packs of rate-limited records."""
    return _pack_ends(pack_build(lake(spark, sf), PACK_US, DOWNSAMPLE_HZ))


def _pack_long_query(rate_hz):
    """Packs written, read back, and every field of every packed record listed."""
    def q(spark, sf):
        path = scratch_path(spark, "packs")
        pack_build(lake(spark, sf), PACK_US, rate_hz).write.parquet(path)
        return pack_long(spark.read.parquet(path))
    return q


def _unpack_query(kind):
    """Packs -> resample -> newest SERIES_N per device and message -> long series."""
    def q(spark, sf):
        path = scratch_path(spark, "packs")
        pack_build(lake(spark, sf), PACK_US).write.parquet(path)
        return unpack_series(spark.read.parquet(path), kind, RESAMPLE_US, SERIES_N)
    return q


def _pack_ends(packs):
    parts = []
    for m in FT.ALL_MESSAGES:
        lst = F.col(FT.PACK_LIST[m])
        parts.append(F.struct(F.lit(m).alias("message"), F.size(lst).cast("bigint").alias("n"),
                              F.try_element_at(lst, F.lit(1))["_inner_timestamp"].alias("first_ts"),
                              F.try_element_at(lst, F.lit(-1))["_inner_timestamp"].alias("last_ts")))
    return (packs.select("device_id", "pack_id", F.inline(F.array(*parts)))
            .filter(F.col("n") > 0))


def q_pack_explode(spark, sf):
    path = scratch_path(spark, "packs")
    pack_build(lake(spark, sf), PACK_US).write.mode("overwrite").parquet(path)
    return pack_entries(spark.read.parquet(path))


# ---------------------------------------------------------------------------------- sinks
def q_csv_fanout(spark, sf):
    out = scratch_path(spark, "csv")
    lake(spark, sf)
    csv_fanout(spark, _LAKES[_version(spark, sf)], out)
    return _csv_lines(spark, out)


def _csv_lines(spark, out):
    """(output, line) of the nine CSV outputs: the header once, and all rows."""
    lines = None
    for m in FT.ALL_MESSAGES:
        text = spark.read.option("recursiveFileLookup", True).text(f"{out}/GPS_{m}.csv")
        head = F.col("value") == header_line(m)
        both = text.filter(head).distinct().unionByName(text.filter(~head))
        part = both.select(F.lit(f"GPS_{m}.csv").alias("output"), F.col("value").alias("line"))
        lines = part if lines is None else lines.unionByName(part)
    return lines


def _format_query(message):
    def q(spark, sf):
        return format_rows(decode(classified(spark, sf), message), message)
    return q


def q_raw_reemit(spark, sf):
    f = frames(spark, sf)
    return f.select("device_id", "seq", F.hex(raw_frame(F.col("start_seq"), F.col("body"), F.col("protocol")))
                    .alias("raw_hex"))


SMALL_RANGE = 4096     # bytes of a read range of the _split queries, so that a capture is many ranges at test scale


def _write_captures(spark, sf, name, raw: F.Column | None = None, cut_last: bool = False) -> str:
    """Captures ``dev<device_id>.cap`` of all frames in a new folder."""
    f = frames(spark, sf)
    raw = raw if raw is not None else raw_frame(F.col("start_seq"), F.col("body"), F.col("protocol"))
    rec = capture_record(F.col("ts_us"), raw)
    if cut_last:
        # the last record of every capture loses the second half of its frame
        last_seq = f.groupBy("device_id").agg(F.max("seq").alias("_last_seq"))
        rec = F.when(F.col("seq") == F.col("_last_seq"),
                     F.expr("substring(_rec, 1, 18 + (octet_length(_rec) - 18) div 2)")).otherwise(F.col("_rec"))
        f = f.join(last_seq, "device_id").withColumn("_rec", capture_record(F.col("ts_us"), raw))
    d = scratch_path(spark, name)
    write_captures(f.select(F.format_string("dev%d", F.col("device_id")).alias("capture_id"), "seq", rec.alias("record"))
                   .filter(F.col("record").isNotNull()), d)
    return d


def _device(records):
    return records.withColumn("device_id", F.regexp_extract("capture_id", r"(\d+)$", 1).cast("bigint"))


def _captures(spark, sf, name, raw: F.Column | None = None, cut_last: bool = False, split: bool = False):
    d = _write_captures(spark, sf, name, raw, cut_last)
    return _device(scan_captures(spark, d, range_bytes=SMALL_RANGE if split else RANGE_BYTES))


def q_capture_scan(spark, sf):
    r = _captures(spark, sf, "cap-scan")
    return r.select("device_id", "rec_no", "ts_us", F.hex("raw").alias("raw_hex"))


def q_capture_scan_split(spark, sf):
    r = _captures(spark, sf, "cap-split", split=True)
    return r.select("device_id", "rec_no", "ts_us", F.hex("raw").alias("raw_hex"))


HEADER_LIKE = b"(1234567890123456)"


def _payload_headers(spark, sf, split):
    """Captures whose longer UBX payloads begin with bytes that look like a record header."""
    body = F.when((F.col("protocol") == "UBX") & (F.octet_length("body") >= 24), F.concat(
        F.substring("body", 1, 4), F.lit(HEADER_LIKE), F.expr("substring(body, 23)"))).otherwise(F.col("body"))
    r = _captures(spark, sf, "cap-headers", raw=raw_frame(F.col("start_seq"), body, F.col("protocol")), split=split)
    return r.select("device_id", "rec_no", "ts_us", F.hex("raw").alias("raw_hex"))


def q_capture_headers(spark, sf):
    return _payload_headers(spark, sf, split=False)


def q_capture_headers_split(spark, sf):
    return _payload_headers(spark, sf, split=True)


def q_deframe(spark, sf):
    d = deframe(_captures(spark, sf, "cap-deframe"))
    return d.select("device_id", "rec_no", "ts_us", "protocol", F.hex("start_seq").alias("start_hex"),
                    F.hex("body").alias("body_hex"), F.col("body_len").cast("bigint").alias("body_len"),
                    "truncated", "status")


def q_deframe_split(spark, sf):
    """deframe over the splittable capture reader (large captures)."""
    d = deframe(_captures(spark, sf, "cap-deframe-split", split=True))
    return d.select("device_id", "rec_no", "ts_us", "protocol", F.hex("start_seq").alias("start_hex"),
                    F.hex("body").alias("body_hex"), F.col("body_len").cast("bigint").alias("body_len"),
                    "truncated", "status")


def q_deframe_truncate(spark, sf):
    text = "repeat('Z', 200 + cast(pmod(seq * 7, 150) as int))"
    pad = F.expr(text)
    # a UBX frame grows in its payload, with the length it declares
    le16 = F.expr("unhex(lpad(hex(octet_length(body) - 6 + octet_length(" + text + ")), 4, '0'))")
    ubx = F.concat(F.col("start_seq"), F.substring("body", 1, 2), F.substring(le16, 2, 1), F.substring(le16, 1, 1),
                   F.expr("substring(body, 5, octet_length(body) - 6)"), F.encode(pad, "ISO-8859-1"),
                   F.expr("substring(body, octet_length(body) - 1, 2)"))
    raw = F.when(F.col("protocol") == "NMEA",
                 F.concat(F.col("start_seq"), F.col("body"), F.encode(F.concat(F.lit(","), pad), "ISO-8859-1"),
                          F.lit(bytes([13, 10])))).otherwise(ubx)
    d = deframe(_captures(spark, sf, "cap-trunc", raw=raw))
    return d.select("device_id", "rec_no", F.col("body_len").cast("bigint").alias("body_len"), "truncated", "status")


def q_deframe_incomplete(spark, sf):
    d = deframe(_captures(spark, sf, "cap-incomplete", cut_last=True))
    return d.groupBy("device_id", "status").agg(F.count(F.lit(1)).alias("records"))


# ------------------------------------------------------------------------------- registry
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {
        "decode_quality": q_decode_quality,
        "parse_status": q_parse_status,
        "match_nmea": q_match_nmea,
        "match_ubx": q_match_ubx,
        "match_unsupported": q_match_unsupported,
        "ubx_checksum": q_ubx_checksum,
        "ubx_header": q_ubx_header,
        "message_names": q_message_names,
        "parse_result_names": q_parse_result_names,
        "le_fields": q_le_fields,
        "tokenize_sentence": q_tokenize_sentence,
        "numeric_prefix": q_numeric_prefix,
        "deg_min_to_deg": q_deg_min_to_deg,
        "fix_state_name": q_fix_state_name,
        "fix_mode_name": q_fix_mode_name,
    }
    for m in FT.ALL_MESSAGES:
        q["decode_" + m.replace("NAV_", "").lower()] = _decode_query(m)
    q.update({
        "thin_1h": _thin_query(HOUR_US),
        "thin_48h": _thin_query(48 * HOUR_US),
        "thin_all": _thin_query(1000 * HOUR_US),
        "thin_48h_chunked": q_thin_48h_chunked,
        "thin_null_keys": q_thin_null_keys,
        "stream_thin_message": q_stream_thin_message,
        "downsample_rate": q_downsample_rate,
        "resample_us": q_resample_us,
        "stream_thin": q_stream_thin,
        "stream_decode": q_stream_decode,
        "stream_quality": q_stream_quality,
        "stream_latest_n": q_stream_latest_n,
        "stream_latest_state": q_stream_latest_state,
        "stream_packs_rate": q_stream_packs_rate,
        "stream_arrival": q_stream_arrival,
        "stream_capture": q_stream_capture,
        "capture_unfinished": q_capture_unfinished,
        "stream_csv_fanout": q_stream_csv_fanout,
        "latest_state": q_latest_state,
        "latest_state_all": q_latest_state_all,
        "latest_record_all": q_latest_record_all,
        "latest_n": q_latest_n,
        "buffer_readout": q_buffer_readout,
        "trim_series": q_trim_series,
        "elapsed_us": q_elapsed_us,
        "elapsed_us_clustered": q_elapsed_us_clustered,
        "latest_n_clustered": q_latest_n_clustered,
        "signals_long": q_signals_long,
        "strings_long": q_strings_long,
        "enums_long": q_enums_long,
        "series_pivot": q_series_pivot,
        "aligned_series": q_aligned_series,
        "series_slice": q_series_slice,
        "pack_fields": _pack_long_query(0),
        "pack_fields_rate": _pack_long_query(DOWNSAMPLE_HZ),
        "pack_build": q_pack_build,
        "pack_build_rate": q_pack_build_rate,
        "unpack_signals": _unpack_query("signals"),
        "unpack_strings": _unpack_query("strings"),
        "unpack_enums": _unpack_query("enums"),
        "pack_sizes": q_pack_sizes,
        "pack_explode": q_pack_explode,
        "csv_fanout": q_csv_fanout,
        "raw_reemit": q_raw_reemit,
        "capture_scan": q_capture_scan,
        "capture_headers": q_capture_headers,
        "capture_headers_split": q_capture_headers_split,
        "capture_scan_split": q_capture_scan_split,
        "deframe": q_deframe,
        "deframe_split": q_deframe_split,
        "deframe_truncate": q_deframe_truncate,
        "deframe_incomplete": q_deframe_incomplete,
    })
    for m in FT.ALL_MESSAGES:
        if m != "NAV_DOP":
            q["series_pivot_" + m.replace("NAV_", "").lower()] = _pivot_query(m)
        q["format_" + m.replace("NAV_", "").lower()] = _format_query(m)
    return q
