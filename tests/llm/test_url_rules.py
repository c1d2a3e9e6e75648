import random

from blocklot.llm import url_rules as ur


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, after = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = after[:min([after.find(c) for c in "?#" if c in after] or [len(after)])]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[3], best[4]) if best else (host, path, None, default)


def test_split_and_rules_equal_brute_force(spark):
    random.seed(1)
    labels = ["a", "b", "com", "org", "x-1", "é", "A"]
    hosts = [".".join(random.choices(labels, k=random.randint(1, 4))) for _ in range(60)] + ["", "a.", ".a", "a..b"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab?x=/y#z", "#t", "?q", "/é/1", "//x"]
    urls = [random.choice(["http://", "HTTPS://", "", "x://y://"]) + random.choice(hosts) + random.choice(paths)
            for _ in range(3000)] + [None, "", "://", "nothing", "http://COM/A"]
    rules = [(random.choice(hosts).lower(), random.choice(["", "/", "/a", "/a/", "/é"]), random.choice(["allow", "block"]))
             for _ in range(150)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(5)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in ur.judge(pages, table).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        assert got[i] == brute(url, rules), url


def test_a_hot_host_spreads_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these tables are too small to need it
    pages = spark.createDataFrame([(i, "http://hot.example.org/es/1") for i in range(4000)], "page_id long, url string")
    rules = spark.createDataFrame(ur.RULES, "host string, path string, verdict string")
    out = ur.judge(pages.repartition(8), rules)
    assert {(r.rule, r.verdict) for r in out.collect()} == {("example.org/es/", "block")} and out.count() == 4000
    sizes = [len(p) for p in out.select("page_id").rdd.glom().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 2000


def test_empty_tables_nulls_and_repeats(spark):
    rules = spark.createDataFrame([("org", "/", "block"), ("org", "/", "allow"), (None, None, "block")],
                                  "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://org/"), (1, "http://org/"), (None, None)], "page_id long, url string")
    got = sorted(map(repr, map(tuple, ur.judge(pages, rules).collect())))
    assert got == sorted(map(repr, [(1, "org", "/", "org/", "block")] * 2 + [(None, "", "", "", "block")]))
    assert ur.judge(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in ur.judge(pages, rules.where("false")).collect()} == {"allow"}


def test_a_rule_without_a_verdict_is_no_rule(spark):
    rules = spark.createDataFrame([("org", "/", None), ("org", "/a", "block"), (None, None, None)],
                                  "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://org/"), (2, "http://org/a"), (3, None)], "page_id long, url string")
    got = sorted((r.page_id, r.rule, r.verdict) for r in ur.judge(pages, rules).collect())
    assert got == [(1, None, "allow"), (2, "org/a", "block"), (3, None, "allow")]
