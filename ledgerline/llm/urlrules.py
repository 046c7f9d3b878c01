"""Allow and block rules on URLs, joined as ranges by a sorted sweep of built-in expressions.

A host with its labels reversed ("org.example.") is a prefix of the keys of all its subdomains,
and a reversed host with a path is a prefix of the keys of all paths below it: such a prefix is
an interval of sorted keys, and two intervals are nested or apart. Rule starts, rule ends and
URLs are laid out in ranges of the sorted keys; each range sweeps through its events, and the
number of open rules is the height of a stack whose top is the last rule opened at that height.
A range begins by opening again, outermost first, the rules that the ranges before it left open.

Two sweeps follow each other: one over distinct hosts, which finds the hosts of rules around
each of them, and one over the paths below each of these hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written
from ledgerline.operators.relational import join_lookup

# (host, path, verdict) of the dealt query.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# What a URL gets that no rule fits: a list of rules names what is taken out.
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Order of events with the same key; an end has a key of its own (0xFF is no byte of UTF-8).
_START, _POINT, _END = 0, 1, 2


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for NULL and for text without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels reversed, a dot after each: a prefix of the keys of all subdomains and of no other host."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def innermost(points: DataFrame, rules: DataFrame) -> DataFrame:
    """All columns of ``points`` and ``rule``: that of the longest rule key that begins the point's key.

    Both have a binary ``key`` (UTF-8); rules are distinct by key and carry ``rule``; ``tie``
    of the points spreads those with one key over several ranges. NULL where no rule fits.
    """
    nothing = F.lit(None).cast(rules.schema["rule"].dataType)
    no_point = F.lit(None).cast(points.select(F.struct(*points.columns)).schema[0].dataType)

    def event(key: Column | str, kind: int, step: int, point: Column, rule: Column, tie: Column | str) -> list[Column]:
        key, tie = (F.col(x) if isinstance(x, str) else x for x in (key, tie))
        return [key.alias("key"), F.lit(kind).alias("kind"), F.lit(step).alias("step"), point.alias("point"), rule.alias("rule"), tie.alias("tie")]

    blank = F.lit("")
    starts = rules.select(*event("key", _START, 1, no_point, F.col("rule"), blank))
    ends = rules.select(*event(F.concat("key", F.lit(b"\xff")), _END, -1, no_point, nothing, blank))
    asked = points.select(*event("key", _POINT, 0, F.struct(*points.columns), nothing, "tie"))
    ranged = asked.unionByName(starts).unionByName(ends).repartitionByRange("key", "kind", "tie")
    laid = written(ranged.drop("tie").withColumn("part", F.spark_partition_id()), "sweep")

    # Rules left open where a range begins: the proper prefixes of its first key among the rules.
    lengths = rules.agg(F.collect_set(F.length("key"))).scalar()
    lows = laid.groupBy("part").agg(F.min(F.struct("key", "kind")).alias("low"))
    cut = lows.withColumn("lengths", lengths).withColumn("length", F.explode("lengths")).filter("length <= length(low.key)")
    heads = cut.select("part", "low", F.substr(F.col("low.key"), F.lit(1), F.col("length")).alias("key"))
    before = (F.col("key") < F.col("low.key")) | (F.col("low.kind") > _START)
    reopened = heads.filter(before).join(rules, "key").select(
        "key", F.lit(_START).alias("kind"), F.lit(1).alias("step"), no_point.alias("point"), "rule", "part"
    )

    order = [F.col("key"), F.col("kind")]
    so_far = (Window.unboundedPreceding, Window.currentRow)
    height = F.sum("step").over(Window.partitionBy("part").orderBy(*order).rowsBetween(*so_far))
    top = F.last(F.when(F.col("kind") == _START, F.col("rule")), ignorenulls=True)
    stack = Window.partitionBy("part", "height").orderBy(*order).rowsBetween(*so_far)
    swept = laid.unionByName(reopened).withColumn("height", height).withColumn("top", top.over(stack))
    return swept.filter(F.col("kind") == _POINT).select("point.*", F.col("top").alias("rule"))


def chains(rules: DataFrame) -> DataFrame:
    """host, chain: every host of a rule with the hosts of rules it lies below, itself included."""
    hosts = rules.select("host").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    above = hosts.select(F.col("host").alias("below"), F.explode(suffixes).alias("host")).join(hosts, "host")
    return above.groupBy("below").agg(F.collect_set("host").alias("chain")).withColumnRenamed("below", "host")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url).

    ``rules`` (host, path, verdict) fit their host and all its subdomains where the URL's path
    starts with theirs, letter for letter; the longest host wins, then the longest path. A rule
    given as allow and as block blocks; repeated rules count once; rules with a NULL part are
    left out. ``rule`` is host and path of the rule as one text, NULL where none fits, and the
    verdict then is ``default``.

    A NULL url or one without ``://`` has empty host and path, which only a rule on the empty
    host and path fits. NULL page_id stays NULL; repeated rows stay; URLs of any length are
    judged whole; other columns of ``pages`` are not read; no pages give no rows.
    """
    rules = (
        rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna()
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    )
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = written(rows.select("host", "path").distinct(), "urls")

    hosts = urls.select("host").distinct().select("host", host_key(F.col("host")).cast("binary").alias("key"), F.lit("").alias("tie"))
    around = chains(rules).select(host_key(F.col("host")).cast("binary").alias("key"), F.col("chain").alias("rule"))
    chained = innermost(hosts, around).filter("rule is not null").select("host", F.col("rule").alias("chain"))

    below = join_lookup(urls, chained, ["host"], "inner").select("host", "path", F.explode("chain").alias("group"))
    points = below.select("host", "path", F.concat(host_key(F.col("group")), F.col("path")).cast("binary").alias("key"), F.col("host").alias("tie"))
    paths = rules.select(
        F.concat(host_key(F.col("host")), F.col("path")).cast("binary").alias("key"),
        F.struct(F.length("host").alias("a"), F.length("path").alias("b"), "host", "path", "verdict").alias("rule"),
    )
    best = innermost(points, paths).filter("rule is not null").groupBy("host", "path").agg(F.max("rule").alias("rule"))
    return join_lookup(rows, best, ["host", "path"]).select(
        "page_id", "host", "path", F.concat("rule.host", "rule.path").alias("rule"),
        F.coalesce("rule.verdict", F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Rules given as tuples, as a table."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def op12_urlrules(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL by the dealt rules."""
    return judge(table(spark, folder, "pages"), rule_table(spark))


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE = f"""
WITH rules(host, path, verdict) AS (VALUES {_VALUES}),
cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
    SELECT row_number() OVER () AS row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), fitting AS (
    SELECT u.row, r.*, row_number() OVER (PARTITION BY u.row ORDER BY length(r.host) DESC, length(r.path) DESC) AS n
    FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT u.page_id, coalesce(u.host, '') AS host, coalesce(u.path, '') AS path, f.host || f.path AS rule,
    coalesce(f.verdict, '{DEFAULT}') AS verdict
FROM urls u LEFT JOIN fitting f ON f.row = u.row AND f.n = 1
"""
