"""Structured Streaming: continuous decode of a frame landing folder and stateful thinning.

* ``decode_stream``: ``readStream`` over Parquet frame files -> the same classification
  expressions as batch -> a Parquet sink (exactly-once through the sink's metadata log).
  Frames without an embedded time are stamped at arrival.
* ``thin_stream``: greedy minimum-gap thinning with the state ``last`` of every key kept by
  ``applyInPandasWithState``, many keys a group (``streaming.buckets``); rows are sorted by arrival key inside
  each micro-batch and the state survives across micro-batches, so the result equals the batch
  fold when files arrive in arrival order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.classify import classify
from .buckets import BUCKETS, Thinned, bucketed, dense, restored

FRAME_SCHEMA = ("device_id bigint, seq bigint, ts_us bigint, protocol string, start_seq binary, "
                "body binary, body_len int, truncated boolean, status string")


def read_frames_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(FRAME_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(landing)
    # live sources carry no embedded time: stamp at arrival
    return df.withColumn("ts_us", F.coalesce(F.col("ts_us"), F.unix_micros(F.current_timestamp())))


def run_available_now(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available now into a Parquet sink, then stop."""
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()


def decode_stream(spark: SparkSession, landing: str, out: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> None:
    """Classify streamed frames into ``(device_id, seq, ts_us, protocol, message, parse_result)``."""
    frames = read_frames_stream(spark, landing, max_files_per_trigger)
    cls = classify(frames).select("device_id", "seq", "ts_us", "protocol", "message", "parse_result")
    run_available_now(cls, out, checkpoint)


def thin_stream(df: DataFrame, keys: list[str], order: str, ts: str, gap_us: int, buckets: int = BUCKETS) -> DataFrame:
    """Streaming greedy thinning per ``keys``; state = last kept timestamp of each key (absent = 0)."""
    rows = bucketed(dense(df), keys, buckets)
    cols = rows.columns
    spec = Thinned(cols, dict(rows.dtypes), keys, order, ts, int(gap_us))

    def fold(key, pdfs, state):
        keep, after = spec.fold(list(pdfs), state.get if state.exists else None)
        state.update(after)
        yield keep

    kept = (rows.groupBy("_bucket")
            .applyInPandasWithState(fold, rows.schema, spec.state, "append", GroupStateTimeout.NoTimeout))
    return restored(kept, df)


def report_stream(spark: SparkSession, landing: str, out: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> None:
    """Decode-quality report as a streaming aggregate (complete mode).

    The state is one count per (device, protocol, message, result): bounded by the number of
    groups, not by the data. Each micro-batch writes a report of its own (``epoch=<n>``), so that there is a whole
    one at any time; ``latest_report`` reads the last that was finished.
    """
    frames = read_frames_stream(spark, landing, max_files_per_trigger)
    agg = (classify(frames).groupBy("device_id", "protocol", "message", "parse_result")
           .agg(F.count(F.lit(1)).alias("frames")))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/epoch={epoch}")

    (agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def latest_report(spark: SparkSession, out: str) -> DataFrame:
    """The report of the last micro-batch that was written to its end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/epoch=*/_SUCCESS")
    done = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    epochs = [int(f.getPath().getParent().getName().split("=")[1]) for f in done]
    return spark.read.parquet(f"{out.rstrip('/')}/epoch={max(epochs)}")


def csv_fanout_stream(spark: SparkSession, landing: str, out: str, checkpoint: str,
                      max_files_per_trigger: int | None = None) -> None:
    """Per-message CSV outputs ``GPS_<NAME>.csv``, one folder per micro-batch (``foreachBatch``): a
    micro-batch that is run again overwrites what it wrote."""
    from ..functions import fields as FT
    from ..operators.decode import decode
    from ..sinks.csv import format_rows, header_line

    frames = read_frames_stream(spark, landing, max_files_per_trigger)

    def write(batch: DataFrame, epoch: int) -> None:
        cls = classify(batch).persist()
        for m in FT.ALL_MESSAGES:
            rows = format_rows(decode(cls, m), m).select(F.col("line").alias(header_line(m)))
            (rows.write.mode("overwrite").option("header", True).option("sep", "\u0001")
             .option("quote", "\u0000").option("escapeQuotes", False)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .csv(f"{out.rstrip('/')}/GPS_{m}.csv/batch-{epoch}"))
        cls.unpersist()

    (frames.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def pack_stream(classified: DataFrame, pack: str = "1 day", delay: str = "1 hour",
                compat: bool = True) -> DataFrame:
    """Streaming pack build: event-time windows of ``pack`` per device, closed by a watermark.

    Append mode emits each (device, window) pack once, when the watermark passes the window
    end; the state is the set of open windows, bounded by ``delay`` and the pack size.
    Output schema = batch ``pack_build`` (``pack_id`` = window start in whole packs).
    """
    ok = (classified.filter((F.col("parse_result") == "OK") & F.col("message").isNotNull())
          .withColumn("_et", F.timestamp_micros(F.col("ts_us")))
          .withWatermark("_et", delay))
    return _windowed_packs(ok, pack, compat)


def _windowed_packs(ok: DataFrame, pack: str, compat: bool) -> DataFrame:
    """Packs of the event-time (``_et``) windows of a watermarked stream."""
    from ..functions import fields as FT
    from ..operators.reshape import pack_record

    pack_us = int(spark_interval_us(pack))
    aggs = []
    for m in FT.ALL_MESSAGES:
        rec = pack_record(m, F.col("body"), F.col("ts_us"), compat)
        item = F.when(F.col("message") == m, F.struct(F.col("seq").alias("seq"), rec.alias("rec")))
        aggs.append(F.collect_list(item).alias(FT.PACK_LIST[m]))
    grouped = ok.groupBy("device_id", F.window("_et", pack).alias("_w")).agg(*aggs)
    return grouped.select(
        "device_id",
        F.floor(F.unix_micros(F.col("_w.start")) / F.lit(pack_us)).cast("bigint").alias("pack_id"),
        *[F.transform(F.sort_array(F.col(FT.PACK_LIST[m])), lambda x: x["rec"]).alias(FT.PACK_LIST[m])
          for m in FT.ALL_MESSAGES])


def spark_interval_us(text: str) -> int:
    """'1 day' / '6 hours' / '30 minutes' / '10 seconds' -> microseconds."""
    n, unit = text.split()
    scale = {"day": 86_400, "hour": 3_600, "minute": 60, "second": 1}[unit.rstrip("s")]
    return int(n) * scale * 1_000_000
