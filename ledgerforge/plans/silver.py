"""Silver jobs: Bronze frames in, accepted and rejected frames out.

Each job judges Bronze rows where they lie and writes only those that fail a rule. It shuffles
its wide rows once, to find the latest record per key, and writes that result. Set checks are
decided per key, and the written rows are separated by the written list of problem keys.

With `buckets` that one shuffle deals rows into as many buckets by tx_hash, and the result is written so. Totals,
references and all later joins by transaction then find the rows where they lie. All rows of a transaction
share a task there, so it is for ledgers whose transactions are of bounded size, as a protocol's
block limit makes them; without it, adaptive execution splits a key that is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.functions.expressions import parsed, trimmed
from ledgerforge.operators.latest import keep_latest
from ledgerforge.operators.quality import (
    finalize_rejections,
    id_collisions,
    missing_references,
    quarantine,
    separate,
    total_problems,
    validate,
)
from ledgerforge.plans.rules import (
    ACCOUNTING_RULES,
    BLOCK_RULES,
    INPUT_RULES,
    OUTPUT_RULES,
    TRANSACTION_RULES,
)
from ledgerforge.sources.schemas import KEYS
from ledgerforge.sources.staging import Staging

NEWEST = ("ingested_at", "batch_id", "source_file")

# Codes of the set checks.
BLOCK_NOT_FOUND = "BLOCK_NOT_FOUND"
TRANSACTION_NOT_FOUND = "TRANSACTION_NOT_FOUND"
OUTPUT_ID_COLLISION = "OUTPUT_ID_COLLISION"
SET_CODES_AFTER_LATEST = (
    BLOCK_NOT_FOUND,
    TRANSACTION_NOT_FOUND,
    "INPUT_VALUE_TOTAL_MISMATCH",
    "INPUT_COUNT_MISMATCH",
    "OUTPUT_VALUE_TOTAL_MISMATCH",
    "OUTPUT_COUNT_MISMATCH",
)


@dataclass(frozen=True)
class Checked:
    """`marked` is every Bronze row, `candidates` the rows that entered the latest step and `latest`
    those that left it: accepted plus the rows that later set checks rejected."""

    accepted: DataFrame
    rejected: DataFrame
    latest: DataFrame
    candidates: DataFrame
    marked: DataFrame


def canonical_inputs(df: DataFrame) -> DataFrame:
    return df.withColumns(
        trimmed("input_id", "tx_hash", "previous_tx_hash", "address")
        | parsed("int", "input_index", "previous_output_index")
        | parsed("bigint", "value_sats")
    )


def canonical_outputs(df: DataFrame) -> DataFrame:
    return df.withColumns(
        trimmed("output_id", "tx_hash", "address")
        | parsed("int", "output_index")
        | parsed("bigint", "value_sats")
        | parsed("boolean", "spent")
    )


def canonical_transactions(df: DataFrame) -> DataFrame:
    """Trim before checking, so that padded hashes meet their block and their duplicates."""
    return df.withColumns(trimmed("tx_hash", "block_hash"))


def canonical_blocks(df: DataFrame) -> DataFrame:
    return df.withColumn("miner", F.lower(F.trim("miner")))


def dated_blocks(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "block_date": F.to_date("timestamp"),
            "block_year": F.year("timestamp"),
            "block_month": F.month("timestamp"),
            "block_hour": F.hour("timestamp"),
        }
    )


def validate_blocks(df: DataFrame) -> DataFrame:
    return validate(df, BLOCK_RULES)


def validate_transactions(df: DataFrame) -> DataFrame:
    return validate(df, TRANSACTION_RULES)


def validate_inputs(df: DataFrame) -> DataFrame:
    return validate(df, INPUT_RULES)


def validate_outputs(df: DataFrame) -> DataFrame:
    return validate(df, OUTPUT_RULES)


def _separate(
    rows: DataFrame, problems: DataFrame, on: str, name: str, stage: Staging
) -> tuple[DataFrame, DataFrame]:
    return separate(rows, stage.keep(problems, name), [on])


def _judge(df: DataFrame, entity: str, stage: Staging, *steps) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(passing rows, failing rows, all rows). Only the failing ones are written; the others stay where Bronze has them."""
    passing, failing = quarantine(df, *steps)
    return passing, stage.keep(failing, f"failing_{entity}"), df


def _newest(df: DataFrame, entity: str, order: Sequence[str]) -> DataFrame:
    return keep_latest(df, KEYS[entity], order)


def silver_blocks(bronze: DataFrame, stage: Staging, rejected_at: datetime | None = None) -> Checked:
    valid, rejected, marked = _judge(bronze, "blocks", stage, BLOCK_RULES)
    latest = _newest(canonical_blocks(valid), "blocks", NEWEST[:2])
    accepted = stage.keep(dated_blocks(latest), "silver_blocks")
    rejects = finalize_rejections(rejected, rejected_at=rejected_at)
    return Checked(accepted, rejects, accepted, valid, marked)


def _kept_latest(valid: DataFrame, entity: str, stage: Staging, buckets: int | None) -> DataFrame:
    """The latest rows, written; with `buckets` dealt by tx_hash once for this and all that follows."""
    if buckets is None:
        return stage.keep(_newest(valid, entity, NEWEST), f"latest_{entity}")
    dealt = valid.repartition(buckets, "tx_hash")
    return stage.keep(_newest(dealt, entity, NEWEST), f"latest_{entity}", bucket=(buckets, *KEYS[entity]))


def silver_transactions(
    bronze: DataFrame,
    blocks: DataFrame,
    stage: Staging,
    rejected_at: datetime | None = None,
    buckets: int | None = None,
) -> Checked:
    rows = canonical_transactions(bronze)
    valid, rejected, marked = _judge(rows, "transactions", stage, TRANSACTION_RULES, ACCOUNTING_RULES)
    latest = _kept_latest(valid, "transactions", stage, buckets)
    unknown = missing_references(latest, blocks, ["block_hash"], BLOCK_NOT_FOUND)
    accepted, orphans = _separate(latest, unknown, "block_hash", "unknown_blocks", stage)
    rejects = finalize_rejections(rejected, orphans, rejected_at=rejected_at)
    return Checked(accepted, rejects, latest, valid, marked)


def _against_transactions(
    latest: DataFrame, transactions: DataFrame, side: str, stage: Staging
) -> tuple[DataFrame, DataFrame]:
    problems = total_problems(
        latest,
        transactions,
        key="tx_hash",
        value="value_sats",
        declared_total=f"total_{side}_sats",
        declared_count=f"{side}_count",
        total_code=f"{side.upper()}_VALUE_TOTAL_MISMATCH",
        count_code=f"{side.upper()}_COUNT_MISMATCH",
        missing_code=TRANSACTION_NOT_FOUND,
    )
    return _separate(latest, problems, "tx_hash", f"{side}_problems", stage)


def silver_inputs(
    bronze: DataFrame,
    transactions: DataFrame,
    stage: Staging,
    rejected_at: datetime | None = None,
    buckets: int | None = None,
) -> Checked:
    valid, rejected, marked = _judge(canonical_inputs(bronze), "inputs", stage, INPUT_RULES)
    latest = _kept_latest(valid, "inputs", stage, buckets)
    accepted, failed = _against_transactions(latest, transactions, "input", stage)
    rejects = finalize_rejections(rejected, failed, rejected_at=rejected_at)
    return Checked(accepted, rejects, latest, valid, marked)


def silver_outputs(
    bronze: DataFrame,
    transactions: DataFrame,
    stage: Staging,
    rejected_at: datetime | None = None,
    buckets: int | None = None,
) -> Checked:
    valid, rejected, marked = _judge(canonical_outputs(bronze), "outputs", stage, OUTPUT_RULES)
    collisions = id_collisions(valid, "output_id", KEYS["outputs"], OUTPUT_ID_COLLISION)
    owned, collided = _separate(valid, collisions, "output_id", "output_id_collisions", stage)
    collided = stage.keep(collided, "collided_outputs")
    latest = _kept_latest(owned, "outputs", stage, buckets)
    accepted, failed = _against_transactions(latest, transactions, "output", stage)
    rejects = finalize_rejections(rejected, collided, failed, rejected_at=rejected_at)
    return Checked(accepted, rejects, latest, owned, marked)
