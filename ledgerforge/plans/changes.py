"""Silver blocks and transactions brought up to date with some batches, by the keys that these touch.

The tables are partitioned by day, or by a longer period if days hold little. Of what they hold, only keys and periods are read in full; whole rows are read
and written for the periods in which a touched key lies or comes to lie, and every other one keeps its files.
What a full rebuild would give is kept exactly: the latest row of a key among all valid ones, and a transaction
as soon as its block is known. A transaction whose block is unknown waits in a table of its own and is judged
again when blocks arrive.

Batches only add rows to Bronze. They are given whole, so applying one again, after a run that
stopped anywhere or for late files of it, replaces what it gave before. Each table changes by a commit of its own, transactions before
those that wait, so a stopped run loses none; readers in between may see a transaction in both. Inputs and
outputs have no date to lie by and are rebuilt by `plans/batch.py`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.operators.latest import keep_latest
from ledgerforge.operators.quality import finalize_rejections, missing_references, quarantine, separate
from ledgerforge.plans import silver
from ledgerforge.plans.batch import Warehouse
from ledgerforge.plans.rules import ACCOUNTING_RULES, BLOCK_RULES, TRANSACTION_RULES
from ledgerforge.session import namespace, session_settings
from ledgerforge.sources.staging import Staging
from ledgerforge.sources.tables import write_table

BLOCKS, TRANSACTIONS, WAITING = "blocks_by_date", "transactions_by_date", "transactions_waiting"
PERIOD = "period"  # the partition: first date of a day, week, month, quarter or year


@dataclass(frozen=True)
class Change:
    """Periods whose files were replaced, the rows written for them, and how many of these were judged anew."""

    periods: tuple[date, ...]
    written: int
    judged: int


def _periods(df: DataFrame) -> set[date]:
    """The periods that occur; at most one value per day of the calendar comes to the driver."""
    return {row[0] for row in df.select(PERIOD).distinct().collect()}


def with_period(df: DataFrame, unit: str) -> DataFrame:
    return df.withColumn(PERIOD, F.date_trunc(unit, "timestamp").cast("date"))


class DatedTable:
    """A table of the session catalog, partitioned by period, whose rows are replaced by key."""

    def __init__(self, name: str, like: DataFrame, key: str):
        self.spark, self.name, self.key = like.sparkSession, name, key
        if not self.spark.catalog.tableExists(name):
            write_table(like.limit(0), name, partition_by=[PERIOD])
        self.rows = self.spark.table(name)

    def periods_of(self, keys: DataFrame) -> set[date]:
        """Periods that hold one of the keys; reads the key column only."""
        return _periods(self.rows.select(self.key, PERIOD).join(keys, self.key, "left_semi"))

    def within(self, periods: set[date]) -> DataFrame:
        return self.rows.filter(F.col(PERIOD).isin(sorted(periods)) if periods else F.lit(False))

    def of_keys(self, keys: DataFrame) -> DataFrame:
        return self.within(self.periods_of(keys)).join(keys, self.key, "left_semi").select(*self.rows.columns)

    def replace(self, keys: DataFrame, new: DataFrame, stage: Staging) -> Change:
        """Take the rows of `keys` out and put `new` in; a period left without rows loses its partition."""
        periods = self.periods_of(keys) | _periods(new)
        if not periods:
            return Change((), 0, 0)
        rest = self.within(periods).join(keys, self.key, "left_anti").select(*self.rows.columns)
        label = f"next_{self.name.rpartition('.')[2]}"
        written = stage.keep(rest.unionByName(new.select(*self.rows.columns)), label)
        # Few files per period, while adaptive execution splits one that is too large.
        write_table(written.hint("rebalance", F.col(PERIOD)), self.name, mode="overwrite_partitions")
        for empty in sorted(periods - _periods(written)):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PERIOD} = DATE '{empty}')")
        self.spark.catalog.refreshTable(self.name)
        self.rows = self.spark.table(self.name)
        return Change(tuple(sorted(periods)), written.count(), new.count())


def _judged(
    house: Warehouse, delivered: DataFrame, entity: str, stage: Staging, *rules: Sequence
) -> DataFrame:
    """Rows that pass; the others replace the rejects of their batches."""
    valid, failed = quarantine(delivered, *rules, keep=lambda df: stage.keep(df, f"marked_{entity}"))
    rejects = finalize_rejections(failed, rejected_at=house.run_at)
    name = house.name("silver_rejects", f"{entity}_by_batch")
    rejects = rejects.hint("rebalance", F.col("batch_id"))
    write_table(rejects, name, mode="overwrite_partitions", partition_by=["batch_id"])
    return valid


def update_blocks(house: Warehouse, delivered: DataFrame, stage: Staging, unit: str = "day") -> Change:
    valid = silver.canonical_blocks(_judged(house, delivered, "blocks", stage, BLOCK_RULES))

    def finished(rows: DataFrame) -> DataFrame:
        return with_period(silver.dated_blocks(rows), unit)

    table = DatedTable(house.name("silver", BLOCKS), finished(valid), "block_hash")
    keys = stage.keep(valid.select("block_hash").distinct(), "block_keys")
    held = table.of_keys(keys).select(*valid.columns)
    latest = keep_latest(valid.unionByName(held), ["block_hash"], silver.NEWEST[:2])
    return table.replace(keys, stage.keep(finished(latest), "judged_blocks"), stage)


def update_transactions(
    house: Warehouse, delivered: DataFrame, stage: Staging, unit: str = "day"
) -> dict[str, Change]:
    """By the blocks known now; call it after `update_blocks`, also without transactions."""
    rows = silver.canonical_transactions(delivered)
    valid = _judged(house, rows, "transactions", stage, TRANSACTION_RULES, ACCOUNTING_RULES)
    accepted, waiting = (
        DatedTable(house.name(layer, entity), with_period(valid, unit), "tx_hash")
        for layer, entity in (("silver", TRANSACTIONS), ("silver_rejects", WAITING))
    )
    blocks = house.spark.table(house.name("silver", BLOCKS)).select("block_hash")
    keys = stage.keep(valid.select("tx_hash").distinct(), "transaction_keys")
    held = [table.of_keys(keys).select(*valid.columns) for table in (accepted, waiting)]
    latest = keep_latest(reduce(DataFrame.unionByName, [valid, *held]), ["tx_hash"], silver.NEWEST)
    untouched = waiting.rows.join(keys, "tx_hash", "left_anti").join(blocks, "block_hash", "left_semi")
    again = latest.unionByName(untouched.select(*valid.columns))
    again = stage.keep(with_period(again, unit), "judged_transactions")
    unknown = missing_references(again, blocks, ["block_hash"], silver.BLOCK_NOT_FOUND)
    known, orphans = separate(again, stage.keep(unknown, "unknown_blocks"), ["block_hash"])
    every = again.select("tx_hash")
    return {
        TRANSACTIONS: accepted.replace(every, known, stage),
        WAITING: waiting.replace(every, orphans.select(*again.columns), stage),
    }


def bring_up_to_date(house: Warehouse, batches: Sequence[str], unit: str = "day") -> dict[str, Change]:
    """Apply the named Bronze batches, in any order of batches; what changed in each table.

    `unit` is the partitions' period (day, week, month, quarter or year) and must stay the same for a warehouse.
    """
    with session_settings(house.spark, {"spark.sql.session.timeZone": "UTC"}):
        blocks, transactions = (
            house.read("bronze", entity).filter(F.col("batch_id").isin(list(batches)))
            for entity in ("blocks", "transactions")
        )
        with Staging(house.spark, namespace=namespace("silver", None, house.prefix), bounded=True) as stage:
            changed = {BLOCKS: update_blocks(house, blocks, stage, unit)}
            return changed | update_transactions(house, transactions, stage, unit)
