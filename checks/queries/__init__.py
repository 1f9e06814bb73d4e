"""All registered queries."""

from checks.queries import (  # noqa: F401
    columns,
    explore,
    jobs,
    models,
    reports,
    sets,
    storage,
    text,
)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
