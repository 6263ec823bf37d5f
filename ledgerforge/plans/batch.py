"""One delivery through all layers, in dependency order; the first failure stops the run and publishes nothing."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.metrics import DATE_COLUMNS
from ledgerforge.operators.quality import ERRORS, check_conservation
from ledgerforge.operators.utxo import SPENT_KEY, enrich_outputs, resolve_inputs
from ledgerforge.plans import gold, silver
from ledgerforge.session import (
    INITIAL_PARTITIONS,
    ensure_namespaces,
    namespace,
    session_settings,
    shuffle_settings,
    table_name,
    task_settings,
)
from ledgerforge.sources.delivery import add_lineage, delivery_files, file_bytes, read_delivery
from ledgerforge.sources.schemas import ENTITIES, KEYS, SCHEMAS
from ledgerforge.sources.publication import Publication, recover
from ledgerforge.sources.staging import Staging
from ledgerforge.sources.tables import in_other_catalog, write_table

logger = logging.getLogger(__name__)


#: Tables that come out of their job dealt by tx_hash, so that buckets cost no shuffle, and what their files are sorted by.
BUCKETED = {("silver", entity): KEYS[entity] for entity in ("transactions", "inputs", "outputs")}
BUCKETED[("silver", "outputs_enriched")] = KEYS["outputs"]
#: Widest shuffles move about three bytes per byte of compressed Bronze.
BRONZE_BYTES_PER_PARTITION = 16 << 20
#: Tables that lie by transaction meet where they lie; buckets of one file are read as sorted as they were written.
BUCKET_JOINS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


@dataclass
class Warehouse:
    """Layer tables of one catalog, with the instant that stamps everything a run writes.

    The instant carries its zone, so neither the driver's zone nor the session's shifts it. Tables that a run
    replaces in the session catalog are published together, by `commit`; until then only this object reads
    them. Other catalogs commit each table by themselves. A `prefix` gives a run layers of its own. `buckets`
    deals the tables of BUCKETED by tx_hash, in the session catalog.
    """

    spark: SparkSession
    catalog: str | None = None
    run_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    prefix: str = ""
    buckets: int | None = None

    def __post_init__(self):
        self.publication = Publication(self.spark, namespace("silver", None, self.prefix))

    def name(self, layer: str, entity: str) -> str:
        return table_name(layer, entity, self.catalog, self.prefix)

    def read(self, layer: str, entity: str) -> DataFrame:
        name = self.name(layer, entity)
        return self.spark.table(name) if in_other_catalog(name) else self.publication.read(name)

    def replace(self, layer: str, entity: str, df: DataFrame, partition_by: tuple = ()) -> None:
        name = self.name(layer, entity)
        if in_other_catalog(name):
            write_table(df, name, mode="create_or_replace", partition_by=partition_by)
        else:
            order = BUCKETED.get((layer, entity))
            bucket = (self.buckets, *order) if self.buckets and order else None
            self.publication.write(name, df, partition_by, bucket)
        logger.info("Wrote %s", name)

    def commit(self) -> None:
        self.publication.commit()


def land_bronze(house: Warehouse, entity: str, path: str, batch_id: str, replace: bool) -> None:
    """Append one delivered file.

    With `replace`, tables partitioned by batch_id swap that one partition, so that delivering
    a batch again does not add its rows twice.
    """
    rows = add_lineage(read_delivery(house.spark, path, SCHEMAS[entity]), batch_id, house.run_at)
    write_table(
        rows,
        house.name("bronze", entity),
        mode="overwrite_partitions" if replace else "append",
        merge_schema=True,
        partition_by=["batch_id"],
    )


def _publish(house: Warehouse, entity: str, checked: silver.Checked) -> dict[str, int]:
    """Write both tables and check that no row was lost or multiplied on the way.

    Bronze = accepted + rejected + duplicates, where duplicates are the rows that the latest step
    dropped. All counts read footers and the error column of written files: exact, and unlike
    accumulators not affected by retried tasks.
    """
    house.replace("silver", entity, checked.accepted)
    house.replace("silver_rejects", entity, checked.rejected)
    late = F.arrays_overlap(ERRORS, F.array(*map(F.lit, silver.SET_CODES_AFTER_LATEST)))
    rejects = house.read("silver_rejects", entity)
    rejected, after_latest = rejects.agg(F.count("*"), F.count_if(late)).first()
    bronze = house.read("bronze", entity).count()
    candidates, latest = checked.candidates.count(), checked.latest.count()
    accepted = house.read("silver", entity).count()
    before_latest = {"candidates": candidates, "rejected before": rejected - after_latest}
    check_conservation(checked.marked.count(), {"bronze": bronze}, f"the marked rows of {entity}")
    check_conservation(bronze, before_latest, f"bronze.{entity}")
    check_conservation(latest, {"accepted": accepted, "rejected after": after_latest}, f"silver.{entity}")
    counts = {
        "bronze": bronze,
        "candidates": candidates,
        "duplicates": candidates - latest,
        "accepted": accepted,
        "rejected": rejected,
    }
    logger.info("silver.%s %s", entity, counts)
    return counts


def _staging(house: Warehouse) -> Staging:
    return Staging(house.spark, namespace=namespace("silver", None, house.prefix), bounded=True)


Parts = tuple[DataFrame, DataFrame]


def _timed_inputs(house: Warehouse, stage: Staging) -> Parts:
    """Inputs dealt to what they refer to, once for the reconciliation, Gold inputs and all that is asked per output."""
    tables = [house.read("silver", entity) for entity in ("inputs", "outputs", "transactions")]
    referencing, others = gold.timed_at_outputs(*tables, house.buckets)
    kept = stage.keep(referencing, "timed_inputs", bucket=(house.buckets, *SPENT_KEY))
    return kept, stage.keep(others, "timed_others")


def build_silver(house: Warehouse, kept: Staging) -> tuple[dict[str, dict[str, int]], Parts | None]:
    """Row counts and, of a house with buckets, the timed inputs that `kept` holds for Gold."""
    report, timed = {}, None
    with _staging(house) as stage:
        blocks = silver.silver_blocks(house.read("bronze", "blocks"), stage, house.run_at)
        report["blocks"] = _publish(house, "blocks", blocks)
        transactions = silver.silver_transactions(
            house.read("bronze", "transactions"),
            house.read("silver", "blocks"),
            stage,
            house.run_at,
            house.buckets,
        )
        report["transactions"] = _publish(house, "transactions", transactions)
        known = house.read("silver", "transactions")
        for entity, job in (("inputs", silver.silver_inputs), ("outputs", silver.silver_outputs)):
            checked = job(house.read("bronze", entity), known, stage, house.run_at, house.buckets)
            report[entity] = _publish(house, entity, checked)
        outputs = house.read("silver", "outputs")
        if house.buckets:
            timed = _timed_inputs(house, kept)
            referencing, others = map(gold.reconciled_part, timed)
            house.replace("silver", "utxo_reconciliation", referencing.unionByName(others))
        else:
            inputs = house.read("silver", "inputs")
            house.replace("silver", "utxo_reconciliation", resolve_inputs(inputs, outputs, unique_outputs=True, stage=stage))
    observed = timed[0] if timed else house.read("silver", "utxo_reconciliation")
    house.replace("silver", "outputs_enriched", enrich_outputs(outputs, observed))
    return report, timed


def build_gold(house: Warehouse, partition_by_date: bool = False, timed: Parts | None = None) -> None:
    """Gold inputs come straight from the reconciliation table, or the timed inputs that it was taken from: either holds
    every input once with all its columns. Gold outputs reuse the spend times that gold inputs looked up."""

    def publish(entity: str, df: DataFrame) -> None:
        if not partition_by_date:
            house.replace("gold", entity, df)
            return
        # Few files per date, while adaptive execution splits a date that is too large.
        date = DATE_COLUMNS[entity]
        house.replace("gold", entity, df.hint("rebalance", F.col(date)), (date,))

    blocks, transactions = house.read("silver", "blocks"), house.read("silver", "transactions")
    inputs, outputs = house.read("silver", "inputs"), house.read("silver", "outputs")
    publish("blocks", gold.gold_blocks(blocks, transactions))
    publish("transactions", gold.gold_transactions(transactions, inputs, outputs))
    if timed:
        referencing, others = map(gold.aged_part, timed)
        publish("inputs", referencing.unionByName(others))
    else:
        reconciled = house.read("silver", "utxo_reconciliation").drop("matching_output_count")
        publish("inputs", gold.age_inputs(reconciled, transactions))
    enriched = house.read("silver", "outputs_enriched")
    spends = timed[0] if timed else house.read("gold", "inputs")
    publish("outputs", gold.gold_outputs(enriched, transactions, spends))


def run_batch(
    spark: SparkSession,
    raw_root: str,
    batch_id: str,
    *,
    catalog: str | None = None,
    replace_batch: bool = False,
    partition_gold_by_date: bool = False,
    prefix: str = "",
    run_at: datetime | None = None,
    buckets: int | None = None,
) -> dict[str, dict[str, int]]:
    """Land one delivery and rebuild Silver and Gold; returns row counts per entity.

    Texts are parsed and dates derived in UTC, whatever the session's zone. Silver, its rejects and Gold
    are published together at the end: a run that fails leaves those of the run before. `run_at` is the instant
    that stamps the run, by default now. With `buckets`, Silver is dealt by tx_hash into that many files, which
    later joins by transaction do not deal again (see plans/silver.py for when to use it).
    """
    files = delivery_files(spark, raw_root, batch_id)
    ensure_namespaces(spark, catalog, prefix)
    house = Warehouse(spark, catalog, **({"run_at": run_at} if run_at else {}), prefix=prefix, buckets=buckets)
    with session_settings(spark, {"spark.sql.session.timeZone": "UTC"}):
        for entity in ENTITIES:
            land_bronze(house, entity, files[entity], batch_id, replace_batch)
        return rebuild(house, partition_gold_by_date)


def rebuild(house: Warehouse, partition_gold_by_date: bool = False) -> dict[str, dict[str, int]]:
    """Silver and Gold from all of Bronze, published by one commit."""
    if house.catalog is None:
        recover(house.spark, house.publication.home)
    tables = [house.read("bronze", entity) for entity in ENTITIES]
    settings = shuffle_settings(house.spark, sum(map(file_bytes, tables)), BRONZE_BYTES_PER_PARTITION)
    settings |= task_settings(house.spark)
    if house.buckets and house.spark.conf.get(INITIAL_PARTITIONS, None) is None:
        # Of two sides the one in more pieces stays where it is.
        settings[INITIAL_PARTITIONS] = str(house.buckets)
    with session_settings(house.spark, settings | (BUCKET_JOINS if house.buckets else {})):
        with _staging(house) as kept, house.publication:
            report, timed = build_silver(house, kept)
            build_gold(house, partition_gold_by_date, timed)
    return report
