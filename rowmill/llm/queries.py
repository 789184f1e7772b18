"""All queries of this folder, by name, and their SQL equivalents."""

from __future__ import annotations

from rowmill.llm import bpe, chat, decontamination, html_extraction, lexical_search, near_dedup, quality_classifier, quality_rules, sharding, suffix_dedup, token_counts, toxicity, whitening  # noqa: F401
from rowmill.llm.common import QUERIES, SQL  # noqa: F401
