"""URL rules by a sort-merge range join, in DataFrame operations only.

Every rule ``host/path`` is written as one canonical binary key: the host's labels reversed
(``org.example.www``), a slash, then the path prefix. All urls the rule covers on that exact
host then lie in one interval ``[key, key + 0xFF)``, because 0xFF occurs in no UTF-8 text.
Subdomains are covered by giving each distinct url one key for every suffix of its host.

1. The rules' interval ends are swept in key order with a stack: after a start, the rule is
   on top; after an end, its parent is again. The top after each end is the last start at the
   same depth, so the stack is one window per depth. Only rules of one host nest, so hosts are
   swept apart. This yields break points ``(key, top rule from here on)``.
2. Break points and url keys are sorted together by range partitioning on (key, kind, url),
   which also cuts through a hot host or key, and written once, since the ranges must stay as
   they were drawn. Each range carries the last break point forward;
   what a range inherits from the ranges before it is a prefix over one row per range.
3. Per url, the longest of the rules found for its host suffixes wins.

Only distinct urls are swept; copies of a url get its result back by a join.

Defined cases: a null url or one without ``://`` has empty host and path. A url no rule fits gets
a null rule and the default verdict. Of rules with the same host and path, one that blocks wins.
Null hosts or paths in rules count as empty, rules with an empty host fit no url, and rules
without a verdict are ignored. Repeated pages keep one row each. Urls of any length are whole. No pages: no
rows; no rules: every url gets the default verdict. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(host: Column, path: Column) -> Column:
    return F.concat(F.encode(F.concat(host, F.lit("/")), "UTF-8"), F.encode(path, "UTF-8"))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def break_points(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) -> rows (_key, _rule) in whose order the top of the stack of
    active nested rules changes to ``_rule`` (null: no rule is active)."""
    r = (rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("_h"),
                      F.coalesce("path", F.lit("")).alias("_p"), F.col("verdict").alias("_v"))
         .filter("_v in ('allow', 'block') and _h != ''")
         .groupBy("_h", "_p").agg(F.max("_v").alias("_v"))
         .select("_h", _key(_reversed(F.col("_h")), F.col("_p")).alias("_k"),
                 F.struct(F.length(F.concat("_h", "_p")).alias("size"),
                          F.concat("_h", "_p").alias("rule"), F.col("_v").alias("verdict")).alias("_r")))
    none = F.lit(None).cast(r.schema["_r"].dataType)
    ends = (r.select("_h", F.col("_k").alias("_key"), F.lit(1).alias("_step"), F.col("_r").alias("_top"))
            .unionByName(r.select("_h", F.concat("_k", F.unhex(F.lit("FF"))).alias("_key"),
                                  F.lit(-1).alias("_step"), none.alias("_top"))))
    # no two rules of a host share a start or an end, and no start is an end
    order = Window.partitionBy("_h").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("_h", "_depth").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    depth = ends.withColumn("_depth", F.sum("_step").over(order))
    return depth.select("_key", F.when(F.col("_depth") > 0, F.last("_top", ignorenulls=True).over(level))
                        .otherwise(none).alias("_rule"))


def _sweep(keys: DataFrame, points: DataFrame) -> DataFrame:
    """For every (_key, _url) the rule of the last break point at or before its key."""
    both = (points.select("_key", F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("_url"), "_rule")
            .unionByName(keys.select("_key", F.lit(1).alias("_kind"), "_url",
                                     F.lit(None).cast(points.schema["_rule"].dataType).alias("_rule"))))
    ranges = materialise(both.repartitionByRange("_key", "_kind", "_url")
                         .withColumn("_range", F.spark_partition_id()), "url-ranges")
    inside = Window.partitionBy("_range").orderBy("_key", "_kind", "_url").rowsBetween(Window.unboundedPreceding, 0)
    # a break point always carries a struct, so that "no rule" is told apart from "none seen yet"
    point = F.when(F.col("_kind") == 0, F.struct(F.col("_rule").alias("rule")))
    swept = ranges.withColumn("_seen", F.last(point, ignorenulls=True).over(inside))
    last = (ranges.filter("_kind = 0").groupBy("_range")
            .agg(F.max_by(F.struct(F.col("_rule").alias("rule")), "_key").alias("_last")))
    bounds = ranges.select("_range").distinct().join(last, "_range", "left")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = bounds.select("_range", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    return (swept.filter("_kind = 1").join(carried, "_range")
            .select("_url", F.coalesce("_seen", "_carry")["rule"].alias("_rule")))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct urls (column _url) that some rule fits -> (_url, rule struct), longest rule first."""
    labels = F.reverse(F.split("_host", r"\."))
    keys = (urls.select("_url", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
            .select("_url", "_path", labels.alias("_labels"))
            .select("_url", "_path", "_labels", F.explode(F.sequence(F.lit(1), F.size("_labels"))).alias("_n"))
            .select("_url", _key(F.array_join(F.slice("_labels", F.lit(1), F.col("_n")), "."),
                                 F.col("_path")).alias("_key")))
    return (_sweep(keys, break_points(rules)).filter("_rule is not null")
            .groupBy("_url").agg(F.max("_rule").alias("_rule")))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule and verdict.

    ``rules`` has columns host, path and verdict (allow or block). The longest fitting rule (host
    and path together) decides, ties by the rule's text; ``default`` holds where none fits.
    """
    p = pages.select(pages[id_col].alias("_page"), F.coalesce(pages[url_col], F.lit("")).alias("_url"))
    found = match_rules(p.select("_url").distinct(), rules)
    return (p.join(found, "_url", "left")
            .select(F.col("_page").alias(id_col), host_of(F.col("_url")).alias("host"),
                    path_of(F.col("_url")).alias("path"), F.col("_rule.rule").alias("rule"),
                    F.coalesce("_rule.verdict", F.lit(default)).alias("verdict")))
