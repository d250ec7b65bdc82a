import itertools
import random

from skytrace.llm import urls

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if h and v in ("allow", "block") and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


def test_rules_match_brute_force(spark):
    r = random.Random(4)
    hosts = ["org", "a.org", "b.a.org", "ab.org", "com", "x.com", "org.com", "a.org.", ""]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/é", "/a\U0010FFFF"]
    rules = sorted({(h, p): v for h, p, v in
                    ((r.choice(hosts), r.choice(paths), r.choice(["allow", "block"])) for _ in range(25))}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [("org", None, None), (None, "/", "block")]
    pages = [f"{s}{h.upper() if i % 2 else h}{p}{q}" for i, (s, h, p, q) in enumerate(itertools.product(
        ["http://", "", "x://y://"], hosts, paths, ["", "?a=/b", "#f"]))] + [None, "", "://", "no scheme", "http://org/a\nb"]
    rows = [(i, u) for i, u in enumerate(pages)] + [(0, pages[0]), (None, pages[7])]
    df = spark.createDataFrame([(*x, "h", "clash") for x in rows], "page_id long, url string, html string, _url string").repartition(4)
    got = urls.judge_urls(df, spark.createDataFrame([(h, p or "", v) for h, p, v in rules], RULES)).collect()
    clean = [(h or "", p or "", v) for h, p, v in rules]
    assert sorted(map(tuple, got), key=str) == sorted([(i, *brute(u, clean)) for i, u in rows], key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([("org", "/", "block")], RULES)
    assert urls.judge_urls(none, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert urls.judge_urls(one, rules.limit(0), default="block").collect()[0][3:] == (None, "block")
