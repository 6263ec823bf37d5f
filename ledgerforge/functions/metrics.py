"""Named metrics of the Gold tables.

Sums over whole tables are decimals of 38 digits: the sum of a long column may leave the long range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric names and definitions per Gold table, and the table's date column.
METRICS = {
    "transactions": {
        "transaction_count": "count(*)",
        "total_fee_sats": "sum(cast(fee_sats AS decimal(28,0)))",
        "average_fee_sats": "avg(fee_sats)",
        "average_fee_rate_sats_per_byte": "avg(fee_rate_sats_per_byte)",
        "total_output_sats": "sum(cast(total_output_sats AS decimal(28,0)))",
    },
    "outputs": {
        "output_count": "count(*)",
        "total_output_sats": "sum(cast(value_sats AS decimal(28,0)))",
        "spend_discrepancy_count": "count_if(spend_discrepancy)",
        "canonical_spent_count": "count_if(canonical_spent)",
    },
    "inputs": {
        "input_count": "count(*)",
        "total_input_sats": "sum(cast(value_sats AS decimal(28,0)))",
        "double_spend_count": "count_if(double_spend_detected)",
    },
    "blocks": {
        "block_count": "count(*)",
        "total_fee_sats": "sum(cast(total_fee_sats AS decimal(28,0)))",
        "observed_transaction_count": "sum(observed_transaction_count)",
        "average_difficulty": "avg(difficulty)",
    },
}
DATE_COLUMNS = {
    "transactions": "transaction_date",
    "outputs": "output_date",
    "inputs": "spend_date",
    "blocks": "block_date",
}


def metric(table: str, name: str) -> Column:
    return F.expr(METRICS[table][name]).alias(name)


def exact_sum(column: str) -> Column:
    """Sum of a whole-number column as decimal(38,0)."""
    return F.sum(F.col(column).cast("decimal(28,0)"))


def summed(column: str) -> Column:
    """Ad-hoc metric: the sum of any column."""
    return exact_sum(column).alias(f"sum_{column}")


def measure(
    df: DataFrame, table: str, names: Sequence[str] = (), by: Sequence[str] = ()
) -> DataFrame:
    """The named metrics (all of the table's, if none are named), overall or per group."""
    return df.groupBy(*by).agg(*[metric(table, name) for name in names or METRICS[table]])
