"""Reporting queries over the Gold, reject and Bronze tables.

Every report aggregates map-side before its one shuffle. `start` and `end` restrict the
table's date column and reach the scan as pushed filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.functions.expressions import short_hash, transaction_shape, within_dates
from ledgerforge.functions.metrics import DATE_COLUMNS, exact_sum, measure, metric, summed
from ledgerforge.operators.quality import ERRORS


def _dated(df: DataFrame, table: str, start, end) -> DataFrame:
    return within_dates(df, DATE_COLUMNS[table], start, end)


def total_transactions(transactions: DataFrame, start=None, end=None) -> DataFrame:
    return measure(_dated(transactions, "transactions", start, end), "transactions", ["transaction_count"])


def total_fees(transactions: DataFrame, start=None, end=None) -> DataFrame:
    return measure(_dated(transactions, "transactions", start, end), "transactions", ["total_fee_sats"])


def average_fee_rate(transactions: DataFrame, start=None, end=None) -> DataFrame:
    names = ["average_fee_rate_sats_per_byte"]
    return measure(_dated(transactions, "transactions", start, end), "transactions", names)


def blocks_processed(blocks: DataFrame, start=None, end=None) -> DataFrame:
    return measure(_dated(blocks, "blocks", start, end), "blocks", ["block_count"])


def headline(transactions: DataFrame, blocks: DataFrame, start=None, end=None) -> DataFrame:
    """The four headline numbers in one row, each in its own type."""
    names = ["transaction_count", "total_fee_sats", "average_fee_rate_sats_per_byte"]
    dated = _dated(transactions, "transactions", start, end)
    return measure(dated, "transactions", names).withColumn(
        "block_count", blocks_processed(blocks, start, end).scalar()
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value; the last is closed.

    The bounds are scalar subqueries, so no row leaves the executors to find them.
    """
    values = df.select(F.col(column).cast("double").alias("value")).dropna()
    low = values.select(F.min("value")).scalar()
    high = values.select(F.max("value")).scalar()
    width = (high - low) / bins
    position = F.when(width > 0, F.floor((F.col("value") - low) / width)).otherwise(0)
    return (
        values.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
        .select("bin", (low + F.col("bin") * width).alias("bin_start"), "count")
    )


def fee_rate_histogram(transactions: DataFrame, start=None, end=None) -> DataFrame:
    return histogram(_dated(transactions, "transactions", start, end), "fee_rate_sats_per_byte")


def fee_versus_size(transactions: DataFrame, start=None, end=None) -> DataFrame:
    return (
        _dated(transactions, "transactions", start, end)
        .groupBy("tx_hash")
        .agg(summed("size_bytes"), summed("fee_sats"), F.count("*").alias("count"))
    )


def shape_composition(transactions: DataFrame, start=None, end=None) -> DataFrame:
    shaped = _dated(transactions, "transactions", start, end).withColumn(
        "transaction_shape", transaction_shape()
    )
    return measure(shaped, "transactions", ["transaction_count"], ["transaction_shape"])


def top_fees(transactions: DataFrame, count: int = 20, start=None, end=None) -> DataFrame:
    """Highest fees first; equal fees by transaction hash. Each task keeps only `count` rows."""
    return (
        _dated(transactions, "transactions", start, end)
        .orderBy(F.col("fee_sats").desc(), "tx_hash")
        .limit(count)
        .select(
            short_hash().alias("short_tx_hash"),
            "fee_sats",
            "size_bytes",
            "fee_rate_sats_per_byte",
            "input_count",
            "output_count",
        )
    )


def on_dates(df: DataFrame, table: str, dates: DataFrame) -> DataFrame:
    """Rows whose date is in the one column of `dates`, a short list that a query decides.

    Over a table partitioned by that date, the list is evaluated first and only its partitions are read.
    """
    column = DATE_COLUMNS[table]
    wanted = dates.select(F.col(dates.columns[0]).alias(column))
    return df.join(wanted, column, "left_semi")


def daily_trend(transactions: DataFrame, start=None, end=None) -> DataFrame:
    names = ["transaction_count", "total_fee_sats", "average_fee_rate_sats_per_byte"]
    dated = _dated(transactions, "transactions", start, end)
    return measure(dated, "transactions", names, ["transaction_date"])


def output_reconciliation_summary(outputs: DataFrame, start=None, end=None) -> DataFrame:
    return (
        _dated(outputs, "outputs", start, end)
        .groupBy("canonical_spent", "spend_discrepancy")
        .agg(F.count("*").alias("output_count"), exact_sum("value_sats").alias("total_value_sats"))
    )


def resolution_summary(inputs: DataFrame, start=None, end=None) -> DataFrame:
    return (
        _dated(inputs, "inputs", start, end)
        .groupBy("resolution_status", "is_genesis_input")
        .agg(
            F.count("*").alias("input_count"),
            exact_sum("value_sats").alias("total_value_sats"),
            metric("inputs", "double_spend_count"),
        )
    )


def reconciliation_kpis(
    blocks: DataFrame, transactions: DataFrame, inputs: DataFrame, outputs: DataFrame
) -> DataFrame:
    """One row per indicator and table, so that the four scans need no join."""
    indicators = {
        "blocks": (blocks, {"transaction_count_mismatches": "NOT transaction_count_matches"}),
        "transactions": (
            transactions,
            {
                "input_count_mismatches": "NOT input_count_matches",
                "output_count_mismatches": "NOT output_count_matches",
                "input_value_mismatches": "NOT input_value_matches",
                "output_value_mismatches": "NOT output_value_matches",
                "any_mismatch": "NOT (input_count_matches AND output_count_matches"
                " AND input_value_matches AND output_value_matches)",
            },
        ),
        "inputs": (inputs, {"double_spends": "double_spend_detected"}),
        "outputs": (outputs, {"spend_discrepancies": "spend_discrepancy"}),
    }
    frames = []
    for table, (df, conditions) in indicators.items():
        counts = [F.count_if(F.expr(sql)).alias(name) for name, sql in conditions.items()]
        pairs = ", ".join(f"'{name}', {name}" for name in conditions)
        frames.append(
            df.agg(*counts).select(
                F.lit(table).alias("table_name"),
                F.expr(f"stack({len(conditions)}, {pairs}) AS (indicator, row_count)"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def time_to_spend_histogram(outputs: DataFrame, start=None, end=None) -> DataFrame:
    return (
        _dated(outputs, "outputs", start, end)
        .filter("time_to_spend_days IS NOT NULL")
        .groupBy("time_to_spend_days")
        .agg(F.count("*").alias("output_count"))
    )


def rejects_by_reason(rejects: dict[str, DataFrame]) -> DataFrame:
    """Rejected rows per entity, batch and code; a row with several codes counts in each."""
    frames = [
        df.select(F.lit(entity).alias("entity"), "batch_id", F.explode(ERRORS).alias("reason"))
        for entity, df in rejects.items()
    ]
    return (
        reduce(DataFrame.unionByName, frames)
        .groupBy("entity", "batch_id", "reason")
        .agg(F.count("*").alias("row_count"))
    )


def ingestion_audit(bronze: dict[str, DataFrame]) -> DataFrame:
    frames = [
        df.select(F.lit(entity).alias("entity"), "batch_id", "source_file")
        for entity, df in bronze.items()
    ]
    return (
        reduce(DataFrame.unionByName, frames)
        .groupBy("entity", "batch_id", "source_file")
        .agg(F.count("*").alias("row_count"))
    )


def miner_comparison(blocks: DataFrame, start=None, end=None) -> DataFrame:
    dated = _dated(blocks, "blocks", start, end)
    matched = F.count_if(F.col("transaction_count_matches")).alias("matching_block_count")
    metrics = ["block_count", "total_fee_sats", "observed_transaction_count", "average_difficulty"]
    return dated.groupBy("miner").agg(*[metric("blocks", name) for name in metrics], matched)


def sql_report(query: str, **tables: DataFrame) -> DataFrame:
    """Read-only SQL over named frames, written as {name} in the query."""
    return next(iter(tables.values())).sparkSession.sql(query, **tables)
