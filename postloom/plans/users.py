"""The user dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import to_long_or_zero
from postloom.schemas import USER


def user_dim(users: DataFrame) -> DataFrame:
    """id, sex and zan_count as whole numbers; missing values, and missing columns, become 0."""
    return users.select(
        *[
            to_long_or_zero(F.col(c).cast("string") if c in users.columns else F.lit(None).cast("string")).alias(c)
            for c in USER
        ]
    )
