"""Filters between the raw change log and the checked one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESCUED = "_rescued_data"


def drop_deletes(df: DataFrame, operation: str = "cdc_operation", delete_code: str = "D") -> DataFrame:
    """Keep inserts and updates. A row with a NULL operation goes too, as in any SQL filter."""
    return df.filter(F.col(operation) != delete_code)


def keep_active(df: DataFrame, flag: str = "is_active") -> DataFrame:
    """Keep rows whose flag is true; false and NULL go."""
    return df.filter(F.col(flag))


def drop_rescued(df: DataFrame) -> DataFrame:
    """Remove the column some file sources use for values that did not fit, if present."""
    return df.drop(RESCUED)
