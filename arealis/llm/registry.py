"""Checked queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from arealis.llm import alignment, exact_dedup, language, license_scan, mixing, near_dedup, packing, quality_classifier, quality_rules, secret_scan, suffix_dedup, token_counts, whitening

_MODULES = (alignment, exact_dedup, language, license_scan, mixing, near_dedup, packing, quality_classifier, quality_rules, secret_scan, suffix_dedup, token_counts, whitening)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
