"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from gapscope.llm import (
    chat_views,
    decontamination,
    html_extract,
    jaccard_join,
    merkle_manifest,
    mixing,
    phrase_mining,
    piece_stream,
    posting_lists,
    quality_rules,
    quality_votes,
    secrets,
    token_counts,
)

_MODULES = (quality_votes, chat_views, html_extract, piece_stream, jaccard_join, token_counts, quality_rules, secrets, posting_lists, mixing, phrase_mining, merkle_manifest, decontamination)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE", {}).items()}
