"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import audit, brown, cdc, dartminhash, mil, pii, rans, repeats, suffix, urls, vamana, variants, wfst
from .common import crc_mod, table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file, as installed on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_substring_dedup(spark, sf_dir):
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL3 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p, ws FROM d WHERE len(ws) >= 20),
keyed AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 19], ' ')) AS k FROM w),
late AS (SELECT doc_id, p FROM (SELECT doc_id, p, rank() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM keyed) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM late),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, len(ws)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

QUALITY_AT = 0.7


def quality_model(docs, labels):
    """Fitted on the labelled rows outside the held-out quarter."""
    return mil.train(docs, labels, crc_mod(labels["doc_id"], 4) != 2)


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = mil.score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("_row.doc_id").alias("doc_id"), (crc_mod(F.col("_row.doc_id"), 4) == 2).alias("held_out"),
                      F.col("_score").alias("score"), (F.col("_score") >= QUALITY_AT).cast("int").alias("predicted"))


def op6_class_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = brown.score(docs, crc_mod(docs["doc_id"], 10) != 0)
    return out.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op4_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


def op1_near_dedup(spark, sf_dir):
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark, sf_dir):
    return cdc.fingerprint_edits(table(spark, sf_dir, "documents"))


SQL4 = """
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, r.host || r.path DESC) AS k
  FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE k = 1
"""

def op7_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix.contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select(F.col("_row.doc_id").alias("doc_id"), "n_words", "n_hit",
                        F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
                        F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0))
                        .cast("long").alias("longest"))


SQL7 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT item, least(len(ws), 13) AS n, unnest(range(1, greatest(len(ws) - 12, least(len(ws), 1)) + 1)) AS p, ws FROM i),
win AS (SELECT item, p AS item_pos, n, ws[p:p + n - 1] AS seq FROM iw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS p, ws FROM w, sizes WHERE len(ws) >= n),
occ AS (SELECT d.doc_id, d.p, d.n, x.item, x.item_pos FROM dw d JOIN win x ON x.n = d.n AND d.ws[d.p:d.p + d.n - 1] = x.seq),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS k FROM occ) GROUP BY doc_id),
runs AS (SELECT doc_id, item, n, p, p - row_number() OVER (PARTITION BY doc_id, item, p - item_pos ORDER BY p) AS g, p - item_pos AS dg FROM occ),
best AS (SELECT doc_id, max(len) AS longest FROM (SELECT doc_id, max(p) + max(n) - min(p) AS len FROM runs GROUP BY doc_id, item, dg, g) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated,
  coalesce(longest, 0)::BIGINT AS longest
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN best USING (doc_id)
"""


def op8_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    mark = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS],
                        F.sha2(F.array_join(F.transform(base, mark), ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", mark), ",").alias("spans"))


SQL8 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
kinds(o, kind, p) AS (VALUES (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
  (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), (3, 'card', '[0-9]([\x20-]?[0-9])+'),
  (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'),
  (5, 'iban', '[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?')),
found AS (SELECT doc_id, o, kind, string_split_regex(t, p) AS gaps, regexp_extract_all(t, p, 0) AS ms FROM d, kinds),
flat AS (SELECT doc_id, o, kind, gaps, ms, unnest(range(1, len(ms) + 1)) AS i FROM found),
placed AS (SELECT doc_id, o, kind, ms[i] AS m, regexp_replace(ms[i], '[^0-9]', '', 'g') AS digits,
    replace(ms[i], ' ', '') AS bare, (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s FROM flat),
good AS (SELECT doc_id, o, kind, s, s + length(m) AS e FROM placed WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(m, '.'), lambda x: x::HUGEINT <= 255))
    WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
      lambda k: CASE WHEN (length(digits) - k) % 2 = 1 THEN (2 * digits[k]::INT) // 10 + (2 * digits[k]::INT) % 10
      ELSE digits[k]::INT END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
    ELSE length(bare) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0::BIGINT, list_transform(range(0, length(bare)),
      lambda k: ascii(bare[(k + 4) % length(bare) + 1])::BIGINT)),
      lambda a, c: (CASE WHEN c >= 65 THEN a * 100 + c - 55 ELSE a * 10 + c - 48 END) % 97) = 1 END),
joined AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) FILTER (o < 5), '') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) AS spans FROM good GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (doc_id)
"""

def op9_token_files(spark, sf_dir):
    return rans.token_files(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 2)


def op10_sentencepiece(spark, sf_dir):
    return wfst.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_neighbours(spark, sf_dir):
    return vamana.nearest(table(spark, sf_dir, "embeddings"), F.col("_id") % 20 == 0, 20)


def op12_filter_audit(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL12 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > first, false)::INT AS m
  FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id),
masks AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, m),
f(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o, [a.b, b.b, c.b, d.b, e.b] AS bits FROM f a, f b, f c, f d, f e
  WHERE a.b | b.b | c.b | d.b | e.b = 31),
steps AS (SELECT o, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS prior
  FROM (SELECT o, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
done AS (SELECT part, o AS filter_order, step::INT AS step, own,
    sum(n) FILTER (m & (prior | own) = 0) AS kept, sum(n) FILTER (m & own > 0 AND m & prior = 0) AS removed,
    sum(n) FILTER (m & own > 0 AND m & prior > 0) AS redundant, sum(n) FILTER (m = own) AS unique_fails,
    sum(good) FILTER (m & own > 0 AND m & prior = 0) AS good_lost,
    sum(toxic) FILTER (m & own > 0 AND m & prior = 0) AS toxic_lost
  FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM done
"""


def op13_spelling(spark, sf_dir):
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_fingerprints, op3_substring_dedup, op4_url_rules, op5_quality,
                                   op6_class_lm, op7_decontamination, op8_pii, op9_token_files, op10_sentencepiece,
                                   op11_neighbours, op12_filter_audit, op13_spelling)}
SQL = {"op3_substring_dedup": SQL3, "op7_decontamination": SQL7, "op4_url_rules": SQL4, "op8_pii": SQL8,
       "op12_filter_audit": SQL12}
