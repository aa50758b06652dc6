"""Retention: rows older than a horizon leave the roll-up tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clicktrail.functions.temporal import AsOf
from clicktrail.operators.reports import since

KEEP = "2 days"


def retain(table: DataFrame, as_of: AsOf, keep: str = KEEP) -> DataFrame:
    """Rows exactly ``keep`` old stay, older ones go."""
    return since(table, as_of, keep)
