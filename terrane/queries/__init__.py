"""Named queries over the driver tables, each with the SQL that states its result."""

from terrane.queries import bronze, gold, learning, profile, silver, upkeep  # noqa: F401
from terrane.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
