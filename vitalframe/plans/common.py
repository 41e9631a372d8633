"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round double outputs to 6 places so both engines hash the same text."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})
