"""Personal data in texts, in DataFrame operations only.

Regular expressions propose spans, validators confirm them (address parts, Luhn for cards,
digit counts for phones, mod-97 for IBANs), and words near a span adjust its score.

A kind's matches come from ``regexp_extract_all`` and the gaps between them from ``split`` on
the same pattern, so the offsets are running sums of lengths; Spark counts code points. The
patterns use possessive quantifiers and start only where a run of their first class starts
or the match before ended. That gives the same leftmost matches as the plain patterns, in
time linear in the text and without recursion.

Defined cases: null and empty texts have no spans. Kinds are matched independently, so spans of
two kinds may overlap. Repeated rows keep one row each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_row

#: Kinds of the base contract, in its order; iban is what the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
}
#: What every match contains: texts without it are not searched.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: Score of a confirmed span, and words that raise it when they stand within NEAR characters.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {"email": "(?i)mail|contact|write|kontakt|correo|courriel", "ip": r"(?i)\bip\b|server|host|adress",
           "card": "(?i)card|visa|master|credit|karte|tarjeta|carte", "phone": r"(?i)phone|call|\btel|mobil|fax",
           "iban": "(?i)iban|bank|konto|account|cuenta|compte"}
NEAR, BOOST, BLOCK = 40, 0.1, 256
_SPANS = "array<struct<kind:string,start:int,`end`:int,score:double,match:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def term(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks passes the mod-97 check."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def step(acc, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, acc * 100 + c - 55).otherwise(acc * 10 + c - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        def small(part):
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))
        return F.forall(F.split(m, r"\."), small)
    if kind == "card":
        return F.when(F.length(_digits(m)).between(16, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        bare = F.replace(m, F.lit(" "))
        return F.when(F.length(bare).between(15, 34), mod97(bare)).otherwise(False)
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, score, match) of the confirmed spans of one kind in a text.

    The running sum goes in blocks of BLOCK matches, so that its cost stays near linear in them.
    """
    none, nothing = F.expr(f"cast(array() as {_SPANS})"), F.expr(f"cast(array() as array<{_SPANS}>)")

    def step(acc, x):
        b = acc["at"] + F.length(x["gap"])
        e = b + F.length(x["match"])
        near = F.concat(F.right(x["gap"], F.lit(NEAR)), F.lit(" "), F.left(x["after"], F.lit(NEAR)))
        score = F.lit(BASE_SCORE[kind]) + F.when(F.rlike(near, F.lit(CONTEXT[kind])), BOOST).otherwise(0.0)
        span = F.struct(F.lit(kind).alias("kind"), b.alias("start"), e.alias("end"), score.alias("score"),
                        x["match"].alias("match"))
        kept = x["match"].isNotNull() & _confirmed(kind, x["match"])
        return F.struct(F.coalesce(e, b).alias("at"),
                        F.when(kept, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
                        .cast(_SPANS).alias("spans"))

    def block(rows, acc, k):
        done = F.aggregate(F.slice(rows, k * BLOCK + 1, F.lit(BLOCK)),
                           F.struct(acc["at"].alias("at"), none.alias("spans")), step)
        return F.transform(F.array(done), lambda d: F.struct(
            d["at"].alias("at"), F.concat(acc["blocks"], F.array(d["spans"])).alias("blocks")))[0]

    def all_blocks(gaps, matches):
        rows = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("after"))
        return F.transform(F.array(rows), lambda r: F.flatten(F.aggregate(
            F.sequence(F.lit(0), F.ceil(F.size(r) / BLOCK).cast("int") - 1),
            F.struct(F.lit(0).alias("at"), nothing.alias("blocks")), lambda acc, k: block(r, acc, k),
            lambda acc: acc["blocks"])))[0]

    # a lambda's variable holds what is used twice, so that it is computed once
    found = F.transform(F.array(F.split(text, PATTERNS[kind], -1)), lambda gaps: all_blocks(
        gaps, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))))[0]
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none) if kind in NEEDS else found


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and ``spans``, by kind as in KINDS, then by start."""
    text = F.coalesce(docs[text_col], F.lit(""))
    per_kind = docs.select(docs[id_col].alias("_id"), *[spans_of(text, k).alias(f"_{k}") for k in KINDS])
    return per_kind.select(F.col("_id").alias(id_col), F.concat(*[F.col(f"_{k}") for k in KINDS]).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with each confirmed span replaced by its kind in brackets. Overlapping spans
    become one replacement, named by the one that starts first. Null texts stay null."""
    text = F.col("_text")
    rows = docs.select(whole_row(docs), docs[text_col].alias("_text"))
    spans = F.array_sort(F.transform(F.concat(*[spans_of(text, k) for k in KINDS]),
                                     lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                        s["kind"].alias("kind"))))
    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap, tag)))
                        .otherwise(acc["out"]).alias("out"))

    cut = rows.withColumn("_spans", spans).withColumn("_cut", F.aggregate("_spans", first, step))
    tail = F.substring(text, F.col("_cut.at") + 1, F.length(text))
    changed = F.when(F.size("_cut.out") > 0, F.concat(F.array_join("_cut.out", ""), tail)).otherwise(text)
    return cut.select(*[changed.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns])
