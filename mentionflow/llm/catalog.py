"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mentionflow.llm import bm25_search, bpe, chat_format, curve_search, decontamination, license_scan, line_dedup, packing, prefix_trie, simhash, toxicity, url_filter, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.op1_packing,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_curve_search": curve_search.op3_curve_search,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_bm25_search": bm25_search.op6_bm25_search,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_chat_format": chat_format.op8_chat_format,
    "op9_simhash": simhash.op9_simhash,
    "op10_bpe_codec": bpe.op10_bpe_codec,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_whitening": whitening.op12_whitening,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

CHECKS: dict[str, str] = {
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op5_url_filter": url_filter.OP5_SQL,
    "op6_bm25_search": bm25_search.OP6_SQL,
    "op7_license_scan": license_scan.OP7_SQL,
    "op11_decontamination": decontamination.OP11_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
