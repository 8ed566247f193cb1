"""All queries and their SQL equivalents, by name."""

from __future__ import annotations

from queries import decompose, grow, learn, prepare

_MODULES = (prepare, decompose, learn, grow)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: text for m in _MODULES for name, text in m.ORACLES.items()}
