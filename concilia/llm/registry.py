"""Queries and SQL of all operators of this subpackage."""

from __future__ import annotations

from . import bpe, codes, embeddings, fingerprints, jaccard, language, merkle, packing, pii, quality, secrets, sharding, suffixes

MODULES = [embeddings, sharding, bpe, pii, fingerprints, suffixes, jaccard, quality, secrets, packing, merkle, language, codes]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
