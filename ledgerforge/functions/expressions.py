"""Column expressions shared by the plans. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the previous_tx_hash of an input that creates coins.
GENESIS = "genesis"


def trimmed(*names: str) -> dict[str, Column]:
    return {name: F.trim(F.col(name)) for name in names}


def parsed(kind: str, *names: str) -> dict[str, Column]:
    """Cast text columns; text that does not parse becomes NULL instead of failing the job."""
    return {name: F.col(name).try_cast(kind) for name in names}


def fee_rate(fee: str = "fee_sats", size: str = "size_bytes") -> Column:
    return F.when(F.col(size) != 0, F.col(fee) / F.col(size))


def days_between(start: str, end: str) -> Column:
    return F.datediff(F.to_date(F.col(end)), F.to_date(F.col(start)))


def is_genesis(previous: str = "previous_tx_hash") -> Column:
    return F.col(previous) == F.lit(GENESIS)


def transaction_shape(inputs: str = "input_count", outputs: str = "output_count") -> Column:
    # The four labels.
    one_in, one_out = F.col(inputs) == 1, F.col(outputs) == 1
    return (
        F.when(one_in & one_out, "1 input / 1 output")
        .when(one_in, "1 input / many outputs")
        .when(one_out, "many inputs / 1 output")
        .otherwise("many inputs / many outputs")
    )


def short_hash(name: str = "tx_hash", length: int = 12) -> Column:
    return F.substring(F.col(name), 1, length)


def within_dates(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Keep rows with start <= column < end; either bound may be left out."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) < F.lit(end).cast("date"))
    return df
