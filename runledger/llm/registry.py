"""Queries of this subpackage and the SQL that they equal, by name."""

from __future__ import annotations

from . import (
    backoff_lm, bin_slack, bpe_codec, conversation_repair, embed_join, line_spread, prefix_chat, rule_ledger, secret_scan, shingle_join, spelling_groups, token_rollup, url_digest,
)

MODULES = (
    embed_join, backoff_lm, bpe_codec, line_spread, bin_slack, token_rollup, url_digest, rule_ledger, prefix_chat, shingle_join,
    secret_scan, spelling_groups, conversation_repair,
)

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
