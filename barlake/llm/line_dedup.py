"""Removal of lines that spread over many sites, with DataFrame functions only.

A HyperLogLog sketch of the sites of each line is built by aggregation, so
partial sketches merge before and after the shuffle. Lines whose estimate is
near the threshold get an exact distinct count. Lines at or above it are cross-site
boilerplate: only their first occurrence stays in the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import read_table, stored, typed

#: Distinct sites from which a line counts as boilerplate.
MIN_SITES = 5
#: log2 of the sketch's registers; its standard error is about 1.04 / sqrt(2^12) = 1.6 %.
LOG_REGISTERS = 12
#: Estimates within this share of the threshold are counted exactly (six standard errors).
NEAR = 0.1
BLANKS = " \t\r"

_KEY = ["line_a", "line_b"]


def lines_of(docs: DataFrame) -> DataFrame:
    """A row for each line that isn't blank: its document, place, site, and a
    128-bit hash of the line without outer blanks."""
    line = F.trim(F.col("line"), F.lit(BLANKS))
    return (docs.select("doc_id", "version", F.coalesce("source", F.lit("")).alias("site"),
                        F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
            .where(F.length(line) > 0)
            .select("doc_id", "version", "site", "place", F.xxhash64(line).alias("line_a"),
                    F.xxhash64(F.lit(17), line).alias("line_b")))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Lines (hash, first occurrence) at ``min_sites`` or more distinct sites."""
    low, high = min_sites * (1 - NEAR), min_sites * (1 + NEAR)
    sketched = (lines.groupBy(*_KEY)
                .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites"),
                     F.count(F.lit(1)).alias("n"),
                     F.min(F.struct("doc_id", "version", "place")).alias("first"))
                # fewer occurrences than the threshold can't reach it
                .where((F.col("n") >= min_sites) & (F.col("sites") >= low)).drop("n"))
    sketched = stored(sketched, "line-spread")
    near = sketched.where(F.col("sites") <= high)
    exact = (lines.join(near.select(*_KEY), _KEY, "left_semi").groupBy(*_KEY, "site").agg(F.lit(1).alias("one"))
             .groupBy(*_KEY).agg(F.count(F.lit(1)).alias("exact")).where(F.col("exact") >= min_sites))
    return (sketched.where(F.col("sites") > high)
            .unionByName(near.join(exact.select(*_KEY), _KEY, "left_semi")).select(*_KEY, "first"))


def deduplicated(docs: DataFrame, min_sites: int = MIN_SITES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): the text without
    boilerplate lines, the number of lines, of those removed, and the columns
    named in ``carry`` as the struct ``carried``.

    The first occurrence by doc_id, text hash and place stays, so no line
    leaves the corpus. Blank lines are never removed. A null source is a site of
    its own; a null text has no lines and stays null; a null doc_id sorts first.
    Repeated rows share the same result, extra columns are ignored, an empty
    table gives an empty result. A text is split once, whatever its lines.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("version"),
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("carried"))
    lines = stored(lines_of(docs), "lines")
    first = F.struct(*[F.col(f"lines.{c}") for c in ("doc_id", "version", "place")])
    cut = (lines.alias("lines").join(spread_lines(lines, min_sites).alias("spread"), _KEY)
           .where(~first.eqNullSafe(F.col("first")))
           .groupBy(F.col("lines.doc_id").alias("cut_id"), F.col("version").alias("cut_version"))
           .agg(F.collect_set("place").alias("gone")))
    parts = F.split("text", "\n", -1)

    def without(p: F.Column) -> F.Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col("gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(p, i)), "\n")

    # a list of one split text: the split is done once, not for each line
    kept_text = F.get(F.transform(F.array(parts), without), 0)
    return (docs.join(cut, F.col("doc_id").eqNullSafe(F.col("cut_id"))
                      & (F.col("version") == F.col("cut_version")), "left")
            .withColumn("n_lines", F.coalesce(F.size(parts), F.lit(0)).cast("bigint"))
            .withColumn("n_removed", F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint"))
            .withColumn("text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept_text))
            .select("doc_id", "text", "source", "carried", "n_lines", "n_removed"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines removed, and length and SHA-256 of what stays."""
    return deduplicated(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars_kept"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text, coalesce(source, '') AS site FROM documents),
parts AS (SELECT rid, doc_id, site, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS place FROM docs),
lines AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM parts),
spread AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT site) >= {MIN_SITES}),
ranked AS (SELECT l.*, s.key IS NOT NULL AND row_number() OVER (PARTITION BY l.key ORDER BY doc_id, place) > 1 AS gone
           FROM lines l LEFT JOIN spread s ON l.key = s.key),
kept AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
                coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text FROM ranked GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(length(kept.text), 0)::BIGINT AS n_chars_kept, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""
