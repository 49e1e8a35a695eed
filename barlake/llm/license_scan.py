"""License scan by diagonal voting, with DataFrame functions only.

All rolling word pairs of the documents are hashed and joined to the pairs of
license templates. A hit votes for the diagonal ``place in document - place in
template``. A base phrase stands wherever all its pairs vote for one diagonal.
For the longer notices neighbouring diagonals are merged, so that an inserted or
dropped word doesn't part a match, and the merged span is verified by the share
of the notice's pairs it holds and by its length. The hash only finds the
partner: each joined pair is compared as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import read_table, stored, typed

# The phrases of the contract with their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Opening words of well-known public notices.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
)
#: Diagonals at most this far apart belong to one match; share of a notice's
#: pairs that a match must hold; longest span as a multiple of the notice.
NEAR_DIAGONALS, MIN_COVER, MAX_STRETCH = 2, 0.75, 1.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TEMPLATES = [(i, words, label, i < len(BASE_PHRASES))
              for i, (words, label) in enumerate(BASE_PHRASES + NOTICES)]


def template_pairs(spark: SparkSession) -> DataFrame:
    """A row for each word pair of each template: a few hundred at most."""
    rows = [(i, len(words.split()) - 1, at, " ".join(words.split()[at:at + 2]))
            for i, words, _, _ in _TEMPLATES for at in range(len(words.split()) - 1)]
    return (spark.createDataFrame(rows, "template int, pairs int, at int, expected string")
            .withColumn("hash", F.xxhash64("expected")))


def _label(column: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(label) for _, _, label, _ in _TEMPLATES]), F.col(column) + 1)


def _joined(labels: Sequence[F.Column] | F.Column) -> F.Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    n_base counts all places of the base phrases, first_word and last_word are
    their smallest and largest start (null without one). ``labels`` adds those
    of verified notices; ``score`` is 1 with a base phrase, else the largest
    share of a notice's pairs on merged diagonals. A null text counts as empty:
    no words, no labels, score 0. Null doc_ids stay null, repeated rows each
    give the same row, extra columns are ignored, an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    # the words are read twice, for the pairs and for their number: found once
    docs = stored(typed(docs, doc_id="bigint", text="string").select(
        "doc_id", F.xxhash64("text").alias("version"),
        F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)).alias("words")), "words")
    pairs = F.transform("words", lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1)))
    hits = (docs.select("doc_id", "version", F.posexplode(pairs).alias("place", "pair"))
            .join(F.broadcast(template_pairs(spark)),
                  (F.xxhash64("pair") == F.col("hash")) & (F.col("pair") == F.col("expected")))
            .withColumn("diagonal", F.col("place") - F.col("at")))
    key = ["doc_id", "version", "template", "pairs"]
    votes = hits.groupBy(*key, "diagonal").agg(F.collect_set("at").alias("voted"))
    by_template = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_template) > NEAR_DIAGONALS
    spans = (votes.withColumn("fresh", F.when(apart, 1).otherwise(0))
             .withColumn("match", F.sum("fresh").over(by_template))
             .groupBy(*key, "match")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("held"),
                  F.sum(F.when(F.size("voted") == F.col("pairs"), 1).otherwise(0)).alias("exact"),
                  F.min(F.when(F.size("voted") == F.col("pairs"), F.col("diagonal"))).alias("first"),
                  F.max(F.when(F.size("voted") == F.col("pairs"), F.col("diagonal"))).alias("last"),
                  F.min(F.col("diagonal") + F.array_min("voted")).alias("start"),
                  F.max(F.col("diagonal") + F.array_max("voted") + 2).alias("stop")))
    base = F.col("template") < len(BASE_PHRASES)
    cover = F.col("held") / F.col("pairs")
    verified = ~base & (cover >= MIN_COVER) & (
        F.col("stop") - F.col("start") <= MAX_STRETCH * (F.col("pairs") + 1))
    found = spans.groupBy("doc_id", "version").agg(
        F.sum(F.when(base, F.col("exact")).otherwise(0)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("last"))).alias("last_word"),
        F.collect_set(F.when(base & (F.col("exact") > 0), _label("template"))).alias("base_found"),
        F.collect_set(F.when(verified, _label("template"))).alias("more_found"),
        F.max(F.when(~base, F.least(cover, F.lit(1.0)))).alias("best"))
    counted = docs.select("doc_id", "version", F.size("words").cast("bigint").alias("n_words"))
    found = found.withColumnRenamed("doc_id", "found_id").withColumnRenamed("version", "found_version")
    none = F.array().cast("array<string>")
    return (counted.join(found, F.col("doc_id").eqNullSafe(F.col("found_id"))
                         & (F.col("version") == F.col("found_version")), "left")
            .select("doc_id", "n_words",
                    F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
                    F.col("first_word").cast("bigint").alias("first_word"),
                    F.col("last_word").cast("bigint").alias("last_word"),
                    _joined(F.coalesce("base_found", none)).alias("base_labels"),
                    _joined(F.concat(F.coalesce("base_found", none), F.coalesce("more_found", none))).alias("labels"),
                    F.when(F.coalesce("n_base", F.lit(0)) > 0, 1.0)
                    .otherwise(F.coalesce("best", F.lit(0.0))).alias("score")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def _values() -> str:
    return ", ".join(f"({i}, '{words}', '{label}', {str(base).lower()})" for i, words, label, base in _TEMPLATES)


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
templates AS (SELECT tid, string_split(phrase, ' ') AS words, label, base
              FROM (VALUES {_values()}) AS t(tid, phrase, label, base)),
places AS (SELECT rid, words, unnest(range(len(words))) AS place FROM docs),
pairs AS (SELECT rid, place, words[place + 1] || ' ' || words[place + 2] AS pair FROM places WHERE place + 1 < len(words)),
wanted AS (SELECT tid, len(words) - 1 AS pairs, label, base, spot, words[spot + 1] || ' ' || words[spot + 2] AS pair
           FROM (SELECT *, unnest(range(len(words) - 1)) AS spot FROM templates)),
votes AS (SELECT rid, tid, pairs, label, base, place - spot AS diagonal, list(DISTINCT spot) AS voted
          FROM pairs JOIN wanted USING (pair) GROUP BY ALL),
cut AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, tid ORDER BY diagonal) > {NEAR_DIAGONALS}
                       THEN 1 ELSE 0 END AS fresh FROM votes),
merged AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, tid ORDER BY diagonal) AS grp FROM cut),
spans AS (
  SELECT rid, tid, pairs, label, base, grp, len(list_distinct(flatten(list(voted)))) AS held,
         count(*) FILTER (len(voted) = pairs) AS exact,
         min(diagonal) FILTER (len(voted) = pairs) AS lo, max(diagonal) FILTER (len(voted) = pairs) AS hi,
         min(diagonal + list_min(voted)) AS start, max(diagonal + list_max(voted) + 2) AS stop
  FROM merged GROUP BY ALL),
judged AS (SELECT *, NOT base AND held / pairs >= {MIN_COVER} AND stop - start <= {MAX_STRETCH} * (pairs + 1) AS verified
           FROM spans),
found AS (
  SELECT rid, sum(exact) FILTER (base) AS n_base, min(lo) FILTER (base) AS first_word, max(hi) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND exact > 0) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND exact > 0 OR verified) AS labels,
         max(held / pairs) FILTER (NOT base) AS best
  FROM judged GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM docs LEFT JOIN found USING (rid)
"""
