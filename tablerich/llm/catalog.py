"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tablerich.llm import chat, collocations, exact, host_rules, mixing, packing, pivots, quality, repair, simhash, substrings, suffix_array, token_files  # noqa: F401
from tablerich.llm.common import ORACLE, QUERIES, Query


def load() -> tuple[dict[str, Query], dict[str, str]]:
    return QUERIES, ORACLE
