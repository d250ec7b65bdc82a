"""Capture-file scan and deframing.

``scan_captures`` reads captures through the byte-range data source (``capture_source``), so a file of any
size is many tasks; ``deframe`` takes the first frame of each record with one possessive regular
expression that reproduces the byte-wise sync search of a receiver parser, including its resync quirk (after a
first sync byte the next byte is consumed even when it does not match, so ``B5 B5 62`` and ``$$G`` are missed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .capture_source import RANGE_BYTES, CaptureSource
from .records import BODY_MAX

# possessive skip of non-sync bytes, then the UBX (B5 62) or NMEA ($ G|P x) start sequence
_TO_SYNC = "(?s)^(?:[^µ$]++|µ[^b]|\\$[^GP])*+(?:µb|\\$[GP].)"


def _source(reader, path: str, glob: str, range_bytes: int):
    return reader.format("capture").option("path", path).option("glob", glob).option("rangeBytes", str(range_bytes))


def scan_captures(spark: SparkSession, path: str, glob: str = "*.cap", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records ``(capture_id, rec_no, ts_us, raw BINARY)`` of every capture file under ``path``.

    ``rec_no`` counts a file's records from 0: a first pass counts the records of each range, and the running sum over
    a file's ranges (16 bytes a range, one range for ``range_bytes`` of input) is broadcast to the second.
    """
    spark.dataSource.register(CaptureSource)
    recs = _source(spark.read, path, glob, range_bytes).load()
    counts = _source(spark.read, path, glob, range_bytes).option("counts", "true").load()
    before = Window.partitionBy("file_key").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("file_key", "range_start", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("_first"))
    return (recs.join(F.broadcast(first), ["file_key", "range_start"])
            .select("capture_id", (F.col("_first") + F.col("nth")).alias("rec_no"), "ts_us", "raw"))


def stream_captures(spark: SparkSession, path: str, glob: str = "*.cap", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Stream of the records ``(capture_id, offset, ts_us, raw)`` of growing captures. ``offset`` is the header's place
    in the file, hence the arrival order. A record is delivered when the next one has begun or its frame is
    complete at the file's end; bytes behind a frame delivered so are not part of ``raw``."""
    spark.dataSource.register(CaptureSource)
    return _source(spark.readStream, path, glob, range_bytes).load().select("capture_id", "offset", "ts_us", "raw")


def deframe(records: DataFrame) -> DataFrame:
    """First frame of each record: adds ``protocol, start_seq, body, body_len, truncated, status``.

    status: OK, NO_FRAME (no start sequence), INCOMPLETE (record ends inside the frame).
    UBX body = class, id, length, payload, checksum (length + 6 bytes; cut at 299 bytes).
    NMEA body = text after the 3-byte start up to the first CR LF; every CR is dropped, an LF
    without CR is content; cut at 299 bytes.
    """
    # each step is a column of its own, so that the one match is evaluated once
    r = records.withColumn("_r", F.decode("raw", "ISO-8859-1"))
    r = r.withColumn("_to", F.regexp_extract("_r", _TO_SYNC, 0))
    r = r.withColumn("_rest", F.expr("substring(_r, length(_to) + 1)")).withColumn(
        "protocol", F.when(F.col("_to").endswith("µb"), F.lit("UBX")).when(F.col("_to") != "", F.lit("NMEA")))
    is_ubx, is_nmea = F.col("protocol") == "UBX", F.col("protocol") == "NMEA"
    # UBX length from rest chars 3-4 (little endian)
    length = F.expr("ascii(substring(_rest, 3, 1)) + 256 * ascii(substring(_rest, 4, 1))")
    r = r.withColumn("_need", F.when(is_ubx, length + 6)).withColumn("_term", F.when(is_nmea, F.instr("_rest", "\r\n")))
    content = F.expr("CASE WHEN _term > 0 THEN substring(_rest, 1, _term - 1) ELSE _rest END")
    r = r.withColumn("_text", F.when(is_nmea, F.regexp_replace(content, "\r", "")))
    cut = F.least("_need", F.lit(BODY_MAX))
    ubx_ok = (F.length("_rest") >= 4) & (F.length("_rest") >= cut)
    long = F.length("_text") >= BODY_MAX
    r = r.withColumn("status", F.when(F.col("protocol").isNull(), F.lit("NO_FRAME"))
                     .when(is_ubx & ~ubx_ok | is_nmea & ~((F.col("_term") > 0) | long), F.lit("INCOMPLETE")).otherwise(F.lit("OK")))
    whole = F.col("status") == "OK"
    body = F.when(is_ubx, F.substring("_rest", F.lit(1), cut)).otherwise(F.substring("_text", 1, BODY_MAX))
    return (r.withColumn("start_seq", F.when(is_ubx, F.lit(b"\xb5b"))
                         .when(is_nmea, F.encode(F.expr("right(_to, 3)"), "ISO-8859-1")))
            .withColumn("body", F.when(whole, F.encode(body, "ISO-8859-1")))
            .withColumn("truncated", F.when(whole, F.when(is_ubx, F.col("_need") > BODY_MAX).otherwise(long)))
            .withColumn("body_len", F.octet_length("body"))
            .drop("_r", "_to", "_rest", "_need", "_term", "_text")
            .select(*records.columns, "status", "protocol", "start_seq", "body", "truncated", "body_len"))
