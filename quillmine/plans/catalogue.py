"""Every query of the engine by name, and the SQL that gives the same rows."""

from __future__ import annotations

from quillmine.plans import corpus, graphs, listings, texts

QUERIES = corpus.QUERIES | texts.QUERIES | listings.QUERIES | graphs.QUERIES
ORACLE_SQL = corpus.ORACLE_SQL | texts.ORACLE_SQL | listings.ORACLE_SQL | graphs.ORACLE_SQL
