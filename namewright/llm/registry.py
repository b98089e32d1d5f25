"""The queries of this subpackage and the SQL each must agree with."""

from __future__ import annotations

from namewright.llm import duck_bpe, exact_dedup, lexical, minhash, packing, pii, quality, quotes, runs, sentencepieces
from namewright.llm import substring_dedup, toxicity, url_filter

_MODULES = (
    substring_dedup,
    minhash,
    pii,
    toxicity,
    url_filter,
    exact_dedup,
    packing,
    sentencepieces,
    quotes,
    quality,
    runs,
    lexical,
    duck_bpe,
)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
