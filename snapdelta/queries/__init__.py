"""The registered queries: each runs an operator over whole given tables, most beside an equal SQL text."""

from snapdelta.queries import (  # noqa: F401  (importing a module registers its queries)
    cursors,
    failures,
    incremental,
    landing,
    loadlog,
    projections,
    scalars,
    scans,
    schemas,
    state,
)
from snapdelta.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
