"""Corpus pipeline over ``documents``: each stage works on what the one before kept.

All stages but the last return the columns of their input; stages that filter
compare documents by doc_id and a hash of the text, so ids may repeat or be null.
A null text has no language and goes with the first stage. Repeated rows stay until
the n-gram join, which keeps one. Columns beyond those of ``documents`` pass
through under any name, but for the last stage. An empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers as public
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import bpe, decontam, langid, line_dedup, ngram_join
from barlake.llm.common import read_table, stored

#: Least posterior probability of a document's language.
MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is found with at least MIN_SCORE; texts
    without a letter have none."""
    found = langid.with_language(docs, public.path("piece_bpe_32k.model"), tuple(docs.columns))
    return (found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
            .select(*[F.col("carried").getField(c).alias(c) for c in docs.columns]))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate lines out of the texts; a document of nothing
    else goes (its lines stay where they stood first). ``n_chars`` follows the text."""
    done = line_dedup.deduplicated(docs, carry=tuple(c for c in docs.columns if c != "text"))
    gone = (F.col("n_removed") > 0) & (F.length(F.trim(F.col("text"), F.lit(line_dedup.BLANKS + "\n"))) == 0)

    def column(name: str):
        if name == "text":
            return F.col("text")
        own = F.col("carried").getField(name)
        if name != "n_chars":
            return own.alias(name)
        return F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(own).alias(name)

    return done.where(~F.coalesce(gone, F.lit(False))).select(*[column(c) for c in docs.columns])


def _by_version(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of documents with (doc_id, version) keys, by qualified names:
    any column of the documents may bear the keys' names."""
    keys = keys.select("doc_id", "version").distinct().alias("_found")
    version = F.xxhash64(F.col("_docs.text").cast("string"))
    same = F.col("_docs.doc_id").cast("bigint").eqNullSafe(F.col("_found.doc_id")) & (version == F.col("_found.version"))
    return docs.alias("_docs").join(keys, same, how)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of the n-gram join: that of the
    smallest id."""
    found = ngram_join.components(docs).where("first")
    return _by_version(docs, found, "left_semi").dropDuplicates(["doc_id", "text"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = decontam.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    return _by_version(docs, found, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the proof that they decode to its text."""
    return bpe.encode_documents(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN, keep_ids=True)


STAGES = [("language ID", language), ("line dedup", lines), ("n-gram join", near_copies),
          ("decontamination", decontaminate), ("byte-level BPE", encode)]

#: SQL can't express the learned and tokenising stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
