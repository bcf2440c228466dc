"""Queries and oracles of this subpackage."""

from __future__ import annotations

from . import byte_bpe, exact_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, secrets, toxicity, url_filter

MODULES = (url_filter, quality_rules, ngram_join, secrets, quality_classifier, exact_dedup, packing, toxicity, byte_bpe, pii)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in MODULES for k, s in m.ORACLES.items()}
