"""Code -> name lookups (fix state, fix mode, message names, parse results).

Small fixed dimensions are expressed as literal CASE expressions: no join, no shuffle,
evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fields import (FIX_MODE_NAMES, FIX_MODE_UNKNOWN, FIX_STATE_NAMES, FIX_STATE_UNKNOWN, NMEA_MESSAGES,
                     NMEA_UNKNOWN, PARSE_RESULT_UNKNOWN, PARSE_RESULTS, UBX_MESSAGES, UBX_UNKNOWN)


def _case(code: Column, table: dict, default: str) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(code == F.lit(k), F.lit(v)) if expr is None else expr.when(code == F.lit(k), F.lit(v))
    return F.when(code.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(default)))


def fix_state_name(fix: Column) -> Column:
    return _case(fix, FIX_STATE_NAMES, FIX_STATE_UNKNOWN)


def fix_mode_name(mode: Column) -> Column:
    return _case(mode, FIX_MODE_NAMES, FIX_MODE_UNKNOWN)


def nmea_message_name(code: Column) -> Column:
    return _case(code, dict(enumerate(NMEA_MESSAGES)), NMEA_UNKNOWN)


def ubx_message_name(code: Column) -> Column:
    return _case(code, dict(enumerate(UBX_MESSAGES)), UBX_UNKNOWN)


def message_name(protocol: Column, code: Column) -> Column:
    """Name of a message code by protocol (NULL for an unknown protocol)."""
    return (F.when(protocol == "NMEA", nmea_message_name(code))
            .when(protocol == "UBX", ubx_message_name(code)))


def parse_result_name(code: Column) -> Column:
    return _case(code, dict(enumerate(PARSE_RESULTS)), PARSE_RESULT_UNKNOWN)


def message_code(protocol: Column, message: Column) -> Column:
    """Inverse of message_name: enum position of a message within its protocol, -1 if unmatched."""
    expr = F.when(message.isNull(), F.lit(-1))
    for i, m in enumerate(NMEA_MESSAGES):
        expr = expr.when((protocol == "NMEA") & (message == m), F.lit(i))
    for i, m in enumerate(UBX_MESSAGES):
        expr = expr.when((protocol == "UBX") & (message == m), F.lit(i))
    return expr.otherwise(F.lit(-1))
