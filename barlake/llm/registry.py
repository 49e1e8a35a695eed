"""Queries of this subpackage and their DuckDB SQL (none where SQL can't say it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import (alignment, bpe, chat, decontam, html_extract, langid, license_scan, line_dedup, ngram_join,
                         pii, quality, url_filter, vector_codes)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_decontamination": decontam.op3_decontamination,
    "op4_language_id": langid.op4_language_id,
    "op5_pii": pii.op5_pii,
    "op6_html_extraction": html_extract.op6_html_extraction,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op9_ngram_links": ngram_join.op9_ngram_links,
    "op10_byte_bpe": bpe.op10_byte_bpe,
    "op11_tokenizer_alignment": alignment.op11_tokenizer_alignment,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_url_filter": url_filter.op13_url_filter,
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": license_scan.SQL,
    "op2_chat_formatting": chat.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op9_ngram_join": ngram_join.SQL,
    "op9_ngram_links": ngram_join.LINKS_SQL,
    "op12_vector_codes": vector_codes.SQL,
    "op13_url_filter": url_filter.SQL,
}
