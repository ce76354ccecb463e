"""The registered queries over the test tables, each next to the SQL that checks it."""

from workbench import (  # noqa: F401
    history_queries,
    model_queries,
    operator_queries,
    quality_queries,
    storage_queries,
)
from workbench.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
