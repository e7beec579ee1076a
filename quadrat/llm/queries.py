"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quadrat.llm import byte_bpe, embedding_dedup, lm_score, near_dedup, packing, quality_classifier, quality_rules, secrets, sharding, url_filter

_MODULES = (sharding, byte_bpe, embedding_dedup, lm_score, near_dedup, url_filter, quality_classifier, quality_rules, secrets, packing)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
