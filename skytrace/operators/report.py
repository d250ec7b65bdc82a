"""Decode-quality report: frame counts by device, protocol, message and parse result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode_quality(classified: DataFrame) -> DataFrame:
    """One row per (device_id, protocol, message, parse_result) with the frame count.

    A plain groupBy: Spark aggregates partially on the map side, so only one small row per
    group and partition crosses the shuffle, however skewed a device is.
    """
    return (classified.groupBy("device_id", "protocol", "message", "parse_result")
            .agg(F.count(F.lit(1)).alias("frames")))
