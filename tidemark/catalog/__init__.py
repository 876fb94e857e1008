"""Named queries over the star-schema test tables, each with the SQL that describes its result independently."""

from tidemark.catalog import checks, flows, gold, history, layers, measured, stars  # noqa: F401  (they register their queries)
from tidemark.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
