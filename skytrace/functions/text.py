"""Sentence text as Spark column expressions: bytes as characters, tokens, the diagnostic NMEA checksum.
(Numbers in tokens are read by ``sqltext``.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def latin1(body: Column) -> Column:
    """Frame bytes as a string with one character per byte."""
    return F.decode(body, "ISO-8859-1")


def tokenize(line: Column) -> Column:
    """Comma tokens of a sentence; token 0 is the sentence id, empty tokens count."""
    return F.split(line, ",", -1)


def token(tokens: Column, k: int) -> Column:
    """k-th token or NULL when the sentence has fewer tokens."""
    return F.try_element_at(tokens, F.lit(k + 1))


def nmea_checksum_ok(start_seq: Column, line: Column) -> Column:
    """Diagnostic only: XOR of the characters between '$' and '*' equals the hex after '*'."""
    text = F.concat(F.substring(latin1(start_seq), 2, 2), line)
    star = F.instr(text, "*")
    payload = F.when(star > 0, F.substring(text, F.lit(1), star - 1))
    want = F.when(star > 0, F.conv(F.substring(text, star + 1, 2), 16, 10).try_cast("int"))
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(payload), F.lit(1))),
                        lambda i: F.ascii(F.substring(payload, i, 1)))
    x = F.aggregate(chars, F.lit(0), lambda a, c: a.bitwiseXOR(c))
    return F.when(star > 1, x == want).otherwise(F.lit(False))
