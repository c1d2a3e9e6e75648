"""Queries of the training-data operators, and the SQL that checks those SQL can express."""

from __future__ import annotations

from . import (bpe, chat, decontaminate, exact_dedup, hard_negatives, language, merkle, packed_ids, pii, quality_fm, simhash, url_rules, warc)

_MODULES = [language, pii, decontaminate, packed_ids, simhash, quality_fm, url_rules, exact_dedup, chat, bpe, hard_negatives, warc, merkle]

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
