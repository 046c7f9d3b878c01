"""The sweep over sorted keys against a plain search through all rules."""

import random

import pytest
from compare import connect, differences

from ledgerline.llm import urlrules


def plain(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h), len(p), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2] + best[3], best[4] if best else default


def judged(spark, urls, rules, parts=5):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, key string, rule string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges, however small
    try:
        found = {r.page_id: tuple(r)[1:] for r in urlrules.judge(pages, urlrules.rule_table(spark, tuple(rules))).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return [found[i] for i in range(len(urls))]


ODD = [
    None, "", "example.org/es/", "://", "http://", "http://org", "http://org/", "HTTP://WWW.Example.ORG/es/x?a#b", "https://example.org?x=/es/",
    "https://badexample.org/es/", "https://example.org/es", "https://example.org/ES/1", "https://a.b.c.example.org/en/1234", "ftp://x.com/fr/#", "http://x.com/de",
    "http://x.com:80/de/", "http://u@x.com/de/1", "http://example.org./es/", "http://.org/", "http://..", "a://b://c.org/", "http://ÉXAMPLE.org/\n/es/", "http://org/" + "a" * 100_000,
    "http://" + "a." * 500 + "com/fr/", "http://x.org/\U0010ffff", "http://com\U0010ffff/fr/", "http://example.org/es/é",
]


def test_odd_urls(spark):
    assert judged(spark, ODD, urlrules.RULES) == [plain(u, urlrules.RULES) for u in ODD]


@pytest.mark.parametrize("seed", range(3))
def test_nested_rules_over_many_ranges(spark, seed):
    """Rules nested in host and path, so many URLs that ranges begin inside open rules."""
    mix = random.Random(seed)
    labels, steps = ["a", "b", "ab", "é"], ["/", "x", "y/", "xx", "/é"]

    def host():
        return ".".join(mix.choice(labels) for _ in range(mix.randint(1, 4)))

    def path():
        return "".join(mix.choice(steps) for _ in range(mix.randint(0, 4)))

    rules = list({(host(), path()): mix.choice(["allow", "block"]) for _ in range(40)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{host()}{'/' + path() if mix.random() < 0.9 else ''}" for _ in range(600)] + ["http://a.b/x"] * 300
    assert judged(spark, urls, rules, 17) == [plain(u, rules) for u in urls]


def test_rules_given_twice_and_tables_without_rows(spark):
    rules = [("a", "/", "allow"), ("a", "/", "block"), ("A", "/", "allow"), (None, "/", "block"), ("b", None, "block")]
    assert judged(spark, ["http://a/", "http://b/"], rules) == [("a", "/", "a/", "block"), ("b", "/", None, "allow")]
    pages = spark.createDataFrame([(None, "http://x.org/"), (1, None), (1, None)], "page_id long, url string")
    every = urlrules.rule_table(spark)
    assert urlrules.judge(pages.filter("false"), every).count() == 0
    assert sorted(map(str, urlrules.judge(pages, every.filter("false")).collect())) == sorted(
        ["Row(page_id=None, host='x.org', path='/', rule=None, verdict='allow')"] + 2 * ["Row(page_id=1, host='', path='', rule=None, verdict='allow')"]
    )


def test_plan_is_native(spark, tables):
    plan = urlrules.op12_urlrules(spark, tables)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "html" not in plan.split("Physical Plan")[-1]


def test_query_equals_its_sql(spark, tables):
    df = urlrules.op12_urlrules(spark, tables)
    assert differences(df.collect(), df.columns, connect(tables), urlrules.ORACLE) == ""
