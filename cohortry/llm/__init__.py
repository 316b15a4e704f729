"""Operators for large training-data pipelines. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from cohortry.llm import bpe_codec, conversation_trie, decontaminate, html_text, jaccard_join, language_id, pii, quality_rules, secret_scan, span_dedup, spelling_variants, token_counts, topk_search

_MODULES = (decontaminate, token_counts, quality_rules, pii, secret_scan, html_text, language_id, jaccard_join, bpe_codec, span_dedup, topk_search, spelling_variants, conversation_trie)


def queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE", {}).items()}
