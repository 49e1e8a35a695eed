"""URL filters by expressions: every URL is expanded into host suffixes joined with
path prefixes, the expressions meet the rules on a short hash prefix, full
digests confirm the pairs, and the longest rule that fits decides.

Only expressions of a shape that some rule has (labels of the host, slashes of
the path, characters after the last slash) are formed, so a URL of a thousand
labels gives no more of them than a short one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import looked_up, read_table, stored, typed

# The rules of the contract as (verdict, host, path).
BASE_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Names that are no public sites, and well-known hosts of adverts.
OWN_RULES = (
    ("block", "invalid", "/"),
    ("block", "localhost", "/"),
    ("block", "onion", "/"),
    ("block", "test", "/"),
    ("block", "doubleclick.net", "/"),
    ("block", "googleadservices.com", "/"),
    ("block", "googlesyndication.com", "/"),
)
#: Verdict where no rule fits; hex digits of the hash prefix; rules that are broadcast at most.
DEFAULT, PREFIX_DIGITS, BROADCAST_RULES = "allow", 8, 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_frame(spark: SparkSession, rules, own: bool) -> DataFrame:
    return spark.createDataFrame([(*r, own) for r in rules], "verdict string, host string, path string, own boolean")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _shape(host: str, path: str) -> list[Column]:
    """Labels of the host, slashes of the path, characters after the last slash."""
    return [F.size(F.split(host, r"\.")), F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
            F.length(F.substring_index(path, "/", -1))]


def prepared(rules: DataFrame) -> DataFrame:
    """Rules with their expression, digest and shape. Rows without a host, a path or
    a verdict are no rules."""
    host = F.translate("host", UPPER, LOWER)
    kept = typed(rules, verdict="string", host="string", path="string", own="boolean").where(
        (F.length("host") > 0) & F.col("path").isNotNull() & F.col("verdict").isin("allow", "block"))
    return (kept.withColumn("rule", F.concat(host, "path")).withColumn("host_length", F.length("host"))
            .withColumn("digest", _digest(F.col("rule")))
            .select("rule", "verdict", F.coalesce("own", F.lit(False)).alias("own"), "host_length", "digest",
                    F.substring("digest", 1, PREFIX_DIGITS).alias("prefix"), F.array(*_shape("host", "path")).alias("shape")))


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` of ``url``; both empty where it's null or has no ``://``."""
    after = F.when(F.locate("://", F.col("url")) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    after = F.coalesce(after, F.lit(""))
    return (pages.withColumn("host", F.translate(F.regexp_extract(after, "^[^/?#]*", 0), UPPER, LOWER))
            .withColumn("path", F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)))


def expressions(shapes: list[list[int]]) -> Column:
    """The expressions of ``host`` and ``path`` in the given shapes."""
    labels, steps = F.split("host", r"\."), F.split("path", "/")

    def one(shape: Column) -> Column:
        k, slashes, rest = shape[0], shape[1], shape[2]
        name = F.array_join(F.slice(labels, -k, k), ".")
        folder = F.array_join(F.slice(steps, F.lit(1), slashes + 1), "/")
        step = F.length(F.get(steps, slashes))
        return F.when((k <= F.size(labels)) & (slashes < F.size(steps)) & (rest <= step), F.concat(
            name, F.substring(folder, F.lit(1), F.length(folder) - step + rest)))

    wanted = F.array(*[F.array(*[F.lit(x) for x in s]) for s in shapes])
    return F.filter(F.transform(wanted, one), lambda e: e.isNotNull())


def judge(pages: DataFrame, rules: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url).

    ``rules`` (verdict, host, path): a rule fits its host and all subdomains where
    the URL's path starts with the rule's. The longest one wins (characters of
    host and path; then the longer host, then block). ``rule`` is null where none
    fits; then the longest of ``own`` (as ``own_rule``) gives the verdict, else
    DEFAULT. Every text is a URL, also an empty or very long one; a null one, or
    one without ``://``, has an empty host and path, which no rule fits. Null
    page_ids stay null, repeated rows each give a row, extra columns are ignored,
    an empty table gives an empty result, and without rules all get DEFAULT.

    URLs are judged once for each distinct host and path. Rules are broadcast up
    to BROADCAST_RULES (counted); more are joined by shuffle, where expressions
    held by many URLs are dealt out. Shapes reach the driver: at most the
    product of the longest rule's labels, slashes and last step.
    """
    pages = with_host_and_path(typed(pages, page_id="bigint", url="string")).select(
        "page_id", "host", "path", F.concat("host", "path").alias("site"))
    all_rules = rules if own is None else rules.select("verdict", "host", "path").withColumn("own", F.lit(False)).unionByName(
        own.select("verdict", "host", "path").withColumn("own", F.lit(True)))
    table = prepared(all_rules)
    shapes = [list(r["shape"]) for r in table.select("shape").distinct().collect()]
    if not shapes:
        none = F.lit(None).cast("string")
        return pages.select("page_id", "host", "path", none.alias("rule"), F.lit(DEFAULT).alias("verdict"), none.alias("own_rule"))
    sites = pages.groupBy("site", "host", "path").agg(F.count(F.lit(1)).alias("copies"))
    met = (sites.select("site", "copies", F.explode(expressions(sorted(shapes))).alias("expression"))
           .select("site", "copies", _digest(F.col("expression")).alias("full"))
           .withColumn("prefix", F.substring("full", 1, PREFIX_DIGITS)))
    table = table.drop("shape")
    if table.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        pairs = met.join(F.broadcast(table), "prefix")
    else:
        met = stored(met, "expressions")
        held = met.groupBy("prefix").agg(F.count(F.lit(1)).alias("held"))
        pairs = looked_up(met, stored(table.join(held, "prefix"), "rules"), "prefix", "held", "inner")

    def longest(of: Column) -> Column:
        return F.max(F.when(of, F.struct(F.length("rule").alias("size"), F.col("host_length"), F.col("verdict").alias("verdict"),
                                         F.col("rule").alias("rule"))))

    best = (pairs.where(F.col("full") == F.col("digest")).groupBy("site", "copies")
            .agg(longest(~F.col("own")).alias("base"), longest(F.col("own")).alias("more")))
    judged = looked_up(pages, stored(best, "judged"), "site", "copies")
    return judged.select("page_id", "host", "path", F.col("base.rule").alias("rule"),
                         F.coalesce("base.verdict", "more.verdict", F.lit(DEFAULT)).alias("verdict"),
                         F.col("more.rule").alias("own_rule"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), rules_frame(spark, BASE_RULES, False),
                 rules_frame(spark, OWN_RULES, True))


def _values() -> str:
    return ", ".join(f"('{verdict}', '{host}', '{path}', {str(own).lower()})"
                     for rules, own in ((BASE_RULES, False), (OWN_RULES, True)) for verdict, host, path in rules)


SQL = rf"""
WITH rests AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
rules AS (SELECT * FROM (VALUES {_values()}) AS t(verdict, name, start, own)),
fits AS (
  SELECT rid, name || start AS rule, verdict, own,
         row_number() OVER (PARTITION BY rid, own ORDER BY length(name || start) DESC, length(name) DESC, verdict DESC) AS place
  FROM parts JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start))
SELECT page_id, host, path, base.rule AS rule, coalesce(base.verdict, more.verdict, '{DEFAULT}') AS verdict,
       more.rule AS own_rule
FROM parts LEFT JOIN (FROM fits WHERE place = 1 AND NOT own) AS base USING (rid)
LEFT JOIN (FROM fits WHERE place = 1 AND own) AS more USING (rid)
"""
