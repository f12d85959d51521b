"""The registered queries of this package and the SQL they are checked against."""

from __future__ import annotations

from starloom.llm import byte_bpe, chat_format, hard_negatives, language_id, near_dedup, packing, pii, quality_model, quality_rules, topk_search, toxicity, warc, whitening

MODULES = (language_id, topk_search, near_dedup, quality_model, packing, warc, pii, quality_rules, toxicity, byte_bpe, chat_format, whitening, hard_negatives)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in getattr(module, "ORACLE_SQL", {}).items()}
