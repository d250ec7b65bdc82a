"""Typed decoding of the nine message types with native column expressions.

UBX fields come from the field table (offset, wire type, scale); NMEA fields from the
comma tokens. The expressions are generated as SQL text (``functions.sqltext``). Unused columns are pruned by Catalyst because each field is an independent
expression: selecting two columns of NAV_PVT evaluates two slices, not 31.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext

KEY_COLUMNS = ["device_id", "seq", "_timestamp"]


def message_columns(message: str, body: Column, compat: bool = True) -> list[Column]:
    """Decoded columns of one message, in output order (``body`` must be the column ``body``)."""
    return [F.expr(sql).alias(name) for name, sql in sqltext.values(message, compat).items()]


def decode(classified: DataFrame, message: str, compat: bool = True) -> DataFrame:
    """Rows of one message type that parsed OK, as ``device_id, seq, _timestamp, <fields>``."""
    rows = classified.filter((F.col("message") == message) & (F.col("parse_result") == "OK"))
    return rows.select(F.col("device_id"), F.col("seq"), F.col("ts_us").alias("_timestamp"),
                       *message_columns(message, F.col("body"), compat))
