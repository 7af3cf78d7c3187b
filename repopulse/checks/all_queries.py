"""Importing this module registers every query."""

from repopulse.checks import (  # noqa: F401
    activity_queries,
    cleaning_queries,
    forecast_queries,
    quality_queries,
    text_queries,
)
from repopulse.checks.registry import RUNS, SQL  # noqa: F401
