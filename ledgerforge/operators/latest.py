"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_latest(
    df: DataFrame, key_columns: Sequence[str], order_columns: Sequence[str]
) -> DataFrame:
    """Keep one row per key: the greatest by order_columns, then by all other columns.

    The remaining columns break ties, so the winner does not depend on partitioning; rows
    equal in every column are interchangeable. The `== 1` filter lets the planner keep one
    row per key and task before the shuffle, so a key with very many copies stays cheap.
    """
    ranked = [*key_columns, *order_columns]
    ties = [
        field.name
        for field in df.schema
        if field.name not in ranked and not isinstance(field.dataType, (T.MapType, T.VariantType))
    ]
    newest_first = [F.col(name).desc_nulls_last() for name in [*order_columns, *ties]]
    window = Window.partitionBy(*key_columns).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def top_per_group(
    df: DataFrame, group_columns: Sequence[str], order: Sequence, count: int, rank_column: str
) -> DataFrame:
    """The first `count` rows of each group with their rank; limited per task before the shuffle."""
    window = Window.partitionBy(*group_columns).orderBy(*order)
    return df.withColumn(rank_column, F.row_number().over(window)).filter(
        F.col(rank_column) <= count
    )
