"""Raw frame re-emission and binary capture files.

Captures are written by the ``capture`` data source: the frame table is hash-partitioned by capture and sorted by
arrival inside each partition, every task streams its captures to a folder of its own attempt, and when all
tasks have succeeded the files are moved to ``<dir>/<capture_id>.cap``. A task that fails or is run twice
leaves no file.
"""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.capture_source import CaptureSource

CRLF = bytes([13, 10])


def raw_frame(start_seq: Column, body: Column, protocol: Column) -> Column:
    """start sequence + body (+ CR LF for NMEA): the bytes as they came off the receiver."""
    return F.concat(start_seq, body, F.when(protocol == "NMEA", F.lit(CRLF)).otherwise(F.lit(b"")))


def capture_record(ts_us: Column, raw: Column) -> Column:
    """``(`` + 16 decimal digits of µs + ``)`` + frame bytes."""
    return F.concat(F.encode(F.format_string("(%016d)", ts_us), "ISO-8859-1"), raw)


def write_captures(frames: DataFrame, out_dir: str, capture_col: str = "capture_id",
                   order: str = "seq", record_col: str = "record") -> None:
    """Write one capture file per ``capture_col`` value under ``out_dir``; files of other captures there stay.

    ``frames`` must carry ``capture_col``, ``order`` and a BINARY ``record_col`` holding the
    full capture record.
    """
    frames.sparkSession.dataSource.register(CaptureSource)
    rows = frames.select(F.col(capture_col).cast("string").alias("capture_id"), F.col(order).alias("_order"),
                         F.col(record_col).alias("record"))
    (rows.repartition("capture_id").sortWithinPartitions("capture_id", "_order").select("capture_id", "record")
     .write.format("capture").option("path", out_dir).mode("append").save())


def grow_captures(spark: SparkSession, source: str, target: str, share: float) -> None:
    """Bring every capture of ``target`` to the first ``share`` of its bytes in ``source``, each file at once (written
    beside, then moved). For trials of growing captures."""
    def copy(batches):
        for pdf in batches:
            fs, root = pafs.FileSystem.from_uri(target)
            fs.create_dir(root, recursive=True)
            for path, size in zip(pdf["path"], pdf["length"], strict=True):
                here, name = pafs.FileSystem.from_uri(path)
                part = f"{root}/_part-{TaskContext.get().taskAttemptId()}"
                left = int(size * share)
                with here.open_input_stream(name) as src, fs.open_output_stream(part) as out:
                    while left and (block := src.read(min(left, 1 << 20))):
                        out.write(block)
                        left -= len(block)
                fs.move(part, f"{root}/{name.rsplit('/', 1)[-1]}")
            yield pdf[["path"]]

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.cap").load(source).select("path", "length")
    files.repartition(8).mapInPandas(copy, "path string").write.format("noop").mode("overwrite").save()
