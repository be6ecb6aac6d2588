"""The package's registered queries and their SQL."""

from __future__ import annotations

from matchstats.llm import (
    conversations,
    decontaminate,
    embeddings,
    language,
    language_model,
    merkle,
    mixing,
    pieces,
    secrets,
    sharding,
    simhash,
    token_counts,
    token_files,
)
from matchstats.llm.common import shipped

_MODULES = (
    token_files, sharding, language, token_counts, embeddings, decontaminate, simhash, language_model, secrets, pieces,
    conversations, merkle, mixing,
)


def registered() -> dict:
    return {name: shipped(query) for module in _MODULES for name, query in module.QUERIES.items()}


def registered_sql() -> dict:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
