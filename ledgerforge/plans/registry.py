"""Named queries over a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.functions.metrics import measure
from ledgerforge.operators.quality import quarantine
from ledgerforge.operators.utxo import check_chain_links, resolve_inputs
from ledgerforge.plans import changes, exercises, reports, silver
from ledgerforge.plans.batch import Warehouse, run_batch
from ledgerforge.plans.corruption import inject_corruption
from ledgerforge.plans.rules import INPUT_RULES, OUTPUT_RULES
from ledgerforge.plans.sample_ledger import SampleLedger
from ledgerforge.session import drop_namespaces, ensure_namespaces, session_settings, task_settings
from ledgerforge.sources.delivery import add_lineage, read_delivery
from ledgerforge.sources.schemas import ENTITIES, KEYS, LINEAGE, SCHEMAS, conform
from ledgerforge.sources.tables import write_table
from ledgerforge.streaming.incremental import run_increment

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Dates, times and code lists as text and ratios rounded, so engines print them alike."""
    columns = []
    for f in df.schema:
        value = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            value = F.array_join(value, ",")
        elif isinstance(f.dataType, T.DoubleType) and f.name.startswith(("average", "bin")):
            value = F.round(value, 6)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def _ledger(build: Callable[[SampleLedger], DataFrame]) -> Query:
    """A query over the tables of the sample ledger, which are written once per application."""
    return lambda spark, folder: portable(build(SampleLedger.shared(spark, folder)))


def _job(name: str, part: str | None = None) -> Query:
    """The job that makes one table, run anew."""

    def build(ledger: SampleLedger) -> DataFrame:
        made = ledger.run_again(name)
        return getattr(made, part) if part else made

    return _ledger(build)


def _plain(build: Query) -> Query:
    return lambda spark, folder: portable(build(spark, folder))


def _rejected(name: str) -> Callable[[SampleLedger], DataFrame]:
    return lambda ledger: ledger.run_again(name).rejected.drop("rejected_at")


def _all_rejects(ledger: SampleLedger) -> dict[str, DataFrame]:
    return {entity: getattr(ledger, entity).rejected for entity in ENTITIES}


def _raw_reconciliation(ledger: SampleLedger) -> DataFrame:
    """Resolution against every valid delivery, second deliveries included."""
    inputs, _ = quarantine(silver.canonical_inputs(ledger.bronze_inputs), INPUT_RULES)
    outputs, _ = quarantine(silver.canonical_outputs(ledger.bronze_outputs), OUTPUT_RULES)
    return resolve_inputs(inputs, outputs)


def _kpis_in_range(ledger: SampleLedger) -> DataFrame:
    """The date-range slot of the reports: metrics of one half year."""
    return reports.daily_trend(ledger.gold_transactions, **HALF_YEAR)


HALF_YEAR = {"start": "1996-01-01", "end": "1996-07-01"}


def _rounded_trend(transactions: DataFrame, **dates: str) -> DataFrame:
    average = "average_fee_rate_sats_per_byte"
    return reports.daily_trend(transactions, **dates).withColumn(average, F.round(average, 6))


def _trend_of_partitions(ledger: SampleLedger) -> DataFrame:
    return _rounded_trend(ledger.gold_transactions_by_date, **HALF_YEAR)


def _trend_of_hard_days(ledger: SampleLedger) -> DataFrame:
    """The daily trend on the dates of the most difficult blocks."""
    hard = ledger.gold_blocks.filter("difficulty >= 88").select("block_date")
    return _rounded_trend(reports.on_dates(ledger.gold_transactions_by_date, "transactions", hard))


def _double_spends(ledger: SampleLedger) -> DataFrame:
    return ledger.reconciliation.filter("double_spend_detected").select(
        "tx_hash", "input_index", "previous_tx_hash", "previous_output_index", "value_sats"
    )


BATCH = "1995-01-01"
RUN_AT = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
QUOTING = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
PACKED = {**QUOTING, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _file_name() -> Column:
    return F.regexp_extract("source_file", r"/(\w+\.csv)/[^/]*$", 1).alias("source_file")


def _landed(entity: str) -> Callable[[SampleLedger], DataFrame]:
    """An entity written as a CSV delivery and landed from it, with its batch and the file's base name."""

    def land(ledger: SampleLedger) -> DataFrame:
        delivered = ledger.bronze_table(entity).select(*SCHEMAS[entity].names)
        path = f"{ledger.stage.folder}/ingest_{BATCH}/{entity}.csv"
        delivered.write.mode("overwrite").options(**QUOTING).csv(path)
        landed = add_lineage(read_delivery(ledger.spark, path, SCHEMAS[entity]), BATCH)
        return landed.withColumn("source_file", _file_name()).drop("ingested_at")

    return land


def _deliver(ledger: SampleLedger, root: str, batch_id: str = BATCH, where: str = "true") -> None:
    """Rows of all entities as packed CSV. Those of one key share a file, so that the file's name decides between no two of them.

    They are dealt by the first column of the key, which keeps alike rows together and so packs well.
    """
    with session_settings(ledger.spark, {**task_settings(ledger.spark), **ledger.stage.settings}):
        for entity in ENTITIES:
            key = F.trim(F.col(KEYS[entity][0]).cast("string"))
            delivered = ledger.bronze[entity].filter(where).select(*SCHEMAS[entity].names).repartition(key)
            delivered.write.options(**PACKED).csv(f"{root}/ingest_{batch_id}/{entity}.csv")


def _batch(ledger: SampleLedger) -> dict[str, DataFrame]:
    """Counts, rejects and Gold outputs of one batch run from CSV, in layers of its own that are dropped after it."""
    kept = ledger.__dict__.setdefault("batch", {})
    if kept:
        return kept
    spark, prefix, root = ledger.spark, f"run_{uuid4().hex[:12]}_", f"{ledger.stage.folder}/delivered"
    _deliver(ledger, root)
    try:
        counts = run_batch(spark, root, BATCH, prefix=prefix, run_at=RUN_AT, buckets=ledger.buckets)
        house = Warehouse(spark, prefix=prefix)
        counted = spark.createDataFrame([(entity, *own.values()) for entity, own in counts.items()], COUNTED)
        outputs = house.read("gold", "outputs")
        outputs = outputs.withColumn("source_file", _file_name())
        rejects = [
            house.read("silver_rejects", entity).select(
                F.lit(entity).alias("entity"), F.explode("validation_errors").alias("reason"), "batch_id", "ingested_at", "rejected_at"
            )
            for entity in ENTITIES
        ]
        stamped = reduce(DataFrame.unionByName, rejects).groupBy("entity", "reason", "batch_id", "ingested_at", "rejected_at")
        made = {"counts": counted, "outputs": outputs, "rejects": stamped.agg(F.count("*").alias("row_count"))}
        kept.update({name: ledger.stage.keep(df, f"batch_{name}") for name, df in made.items()})
    finally:
        drop_namespaces(spark, prefix)
    return kept


def _increments(ledger: SampleLedger) -> dict[str, DataFrame]:
    """Counts and Silver outputs after two deliveries that a file stream landed one after the other."""
    kept = ledger.__dict__.setdefault("increments", {})
    if kept:
        return kept
    spark, prefix, root = ledger.spark, f"run_{uuid4().hex[:12]}_", f"{ledger.stage.folder}/arriving"
    checkpoint = f"{ledger.stage.folder}/arrived"
    try:
        for batch_id, run_at, where in DELIVERIES:
            _deliver(ledger, root, batch_id, where)
            last = batch_id == DELIVERIES[-1][0]
            counts = run_increment(spark, root, checkpoint, run_at=run_at, prefix=prefix, build=last, buckets=ledger.buckets)
        counted = spark.createDataFrame([(entity, *own.values()) for entity, own in counts.items()], COUNTED)
        outputs = Warehouse(spark, prefix=prefix).read("silver", "outputs").withColumn("source_file", _file_name())
        kept.update({name: ledger.stage.keep(df, f"increments_{name}") for name, df in (("counts", counted), ("outputs", outputs))})
    finally:
        drop_namespaces(spark, prefix)
    return kept


def _changes(ledger: SampleLedger) -> dict[str, DataFrame]:
    """Silver blocks and transactions after the months were applied in three turns, later ones before earlier ones."""
    kept = ledger.__dict__.setdefault("changes", {})
    if kept:
        return kept
    prefix = f"run_{uuid4().hex[:12]}_"
    ensure_namespaces(ledger.spark, prefix=prefix)
    house = Warehouse(ledger.spark, prefix=prefix, run_at=RUN_AT)
    try:
        months: set[str] = set()
        for entity in ("blocks", "transactions"):
            bronze = ledger.bronze_table(entity)
            rows = bronze.hint("rebalance", F.col("batch_id"))
            write_table(rows, house.name("bronze", entity), partition_by=["batch_id"])
            months.update(row.batch_id for row in bronze.select("batch_id").distinct().collect())
        last_first = sorted(months, reverse=True)
        for turn in range(3):
            changes.bring_up_to_date(house, last_first[turn::3], "year")
        tables = {"blocks": ("silver", changes.BLOCKS), "transactions": ("silver", changes.TRANSACTIONS)}
        tables["waiting"] = ("silver_rejects", changes.WAITING)
        for name, table in tables.items():
            rows = house.spark.table(house.name(*table)).drop(changes.PERIOD)
            kept[name] = ledger.stage.keep(rows, f"changes_{name}")
    finally:
        drop_namespaces(ledger.spark, prefix)
    return kept


#: Batch, instant of its run, and the rows it delivers.
DELIVERIES = (
    ("2026-01-01", datetime(2026, 1, 1, 6, tzinfo=timezone.utc), "batch_id < '1995-01-01'"),
    ("2026-01-02", datetime(2026, 1, 2, 6, tzinfo=timezone.utc), "batch_id >= '1995-01-01'"),
)
COUNTED = "entity string, bronze bigint, candidates bigint, duplicates bigint, accepted bigint, rejected bigint"


def _run_part(run: Callable[[SampleLedger], dict[str, DataFrame]], name: str) -> Query:
    return lambda spark, folder: run(SampleLedger.shared(spark, folder))[name]


def _roundtrip(ledger: SampleLedger) -> DataFrame:
    return _landed("outputs")(ledger).drop("source_file")


def _corrupted(ledger: SampleLedger, scenario: str) -> SampleLedger:
    """The ledger's delivery, corrupted and parsed again; Silver is built when it is read."""
    corrupted = ledger.__dict__.setdefault("corrupted", {})
    if scenario not in corrupted:
        corrupted[scenario] = _corrupt(ledger, scenario)
    return corrupted[scenario]


def _corrupt(ledger: SampleLedger, scenario: str) -> SampleLedger:
    plain = {entity: df.drop(*LINEAGE) for entity, df in ledger.bronze.items()}
    landed = {
        "ingested_at": F.lit("2026-01-01 00:00:00").cast("timestamp"),
        "batch_id": F.lit("2026-01-01"),
    }
    again = SampleLedger(ledger.spark, ledger.folder)
    corrupted = inject_corruption(plain, scenario, rate=0.02, seed=7, stage=again.stage)
    ledger.__dict__.setdefault("job_stages", []).append(again.stage)
    for entity, df in corrupted.items():
        rows = conform(df, entity).withColumns({**landed, "source_file": F.lit(f"{entity}.csv")})
        # The damaged text is written; it is parsed where it is read.
        setattr(again, f"bronze_{entity}", rows)
    return again


def _corruption_rejects(scenario: str) -> Callable[[SampleLedger], DataFrame]:
    return lambda ledger: reports.rejects_by_reason(_all_rejects(_corrupted(ledger, scenario)))


def _corruption_effects(ledger: SampleLedger) -> DataFrame:
    """What the damaged rows that pass the row rules do to resolution and spent state."""
    again = _corrupted(ledger, "mixed")
    found = again.reconciliation.groupBy("resolution_status", "address_matches").agg(
        F.count("*").alias("row_count")
    )
    states = again.enriched_outputs.groupBy("spend_discrepancy").agg(F.count("*").alias("row_count"))
    return found.unionByName(states, allowMissingColumns=True)


def _conservation(ledger: SampleLedger) -> DataFrame:
    """Rows of each entity: Bronze = accepted + rejected + duplicates."""
    rows = []
    for entity in ENTITIES:
        checked = getattr(ledger, entity)
        frames = {"bronze": ledger.bronze[entity], "candidates": checked.candidates, "latest": checked.latest}
        frames |= {"accepted": checked.accepted, "rejected": checked.rejected}
        counts = [df.select(F.count("*").alias(name)).scalar().alias(name) for name, df in frames.items()]
        rows.append(ledger.spark.range(1).select(F.lit(entity).alias("entity"), *counts))
    counted = reduce(DataFrame.unionByName, rows)
    return counted.withColumn("duplicates", F.col("candidates") - F.col("latest")).drop("latest")


BUSIEST_MINER_DAYS = """
    SELECT b.miner, t.transaction_date, count(*) AS transaction_count,
           sum(cast(t.fee_sats AS decimal(28,0))) AS total_fee_sats
    FROM {transactions} t JOIN {blocks} b ON b.block_hash = t.block_hash
    GROUP BY b.miner, t.transaction_date HAVING count(*) >= 5
"""


def _sql_over_gold(ledger: SampleLedger) -> DataFrame:
    return reports.sql_report(
        BUSIEST_MINER_DAYS, transactions=ledger.gold_transactions, blocks=ledger.gold_blocks
    )


QUERIES: dict[str, Query] = {
    # Bronze
    **{f"bronze_{e}": _ledger(_landed(e)) for e in ENTITIES},
    "bronze_roundtrip": _ledger(_roundtrip),
    "inferred_csv_copy": _plain(exercises.inferred_csv_copy),
    "table_write_modes": _plain(exercises.table_write_modes),
    # Operators on plain tables
    "latest_by_key": _plain(exercises.latest_lines),
    "reference_valid": _plain(exercises.reference_valid),
    "reference_missing": _plain(exercises.reference_missing),
    "id_collisions": _plain(exercises.line_id_collisions),
    "total_reconciliation": _plain(exercises.total_reconciliation),
    "row_quarantine": _plain(exercises.part_quarantine),
    "window_total": _plain(exercises.window_total),
    "top_per_group": _plain(exercises.top_orders_per_customer),
    "top_n": _plain(exercises.top_orders),
    "union_by_name": _plain(exercises.union_by_name),
    "union_by_position": _plain(exercises.union_by_position),
    "distinct": _plain(exercises.distinct_pairs),
    "chain": _plain(exercises.filter_to_sort_chain),
    # Silver
    "silver_blocks": _job("blocks", "accepted"),
    "silver_transactions": _job("transactions", "accepted"),
    "silver_inputs": _job("inputs", "accepted"),
    "silver_outputs": _job("outputs", "accepted"),
    **{f"reject_{e}": _ledger(_rejected(e)) for e in ENTITIES},
    "silver_conservation": _ledger(_conservation),
    # The same with dates, times and arrays as such.
    "silver_blocks_native": lambda spark, folder: SampleLedger.shared(spark, folder).run_again("blocks").accepted,
    "reject_inputs_native": lambda spark, folder: _rejected("inputs")(SampleLedger.shared(spark, folder)),
    # The whole run from delivered files, with the stamps of the run.
    "batch_counts": _run_part(_batch, "counts"),
    "batch_rejects": _run_part(_batch, "rejects"),
    "batch_gold_outputs": _run_part(_batch, "outputs"),
    "incremental_counts": _run_part(_increments, "counts"),
    "incremental_silver_outputs": _run_part(_increments, "outputs"),
    # Only the keys that a batch touches, by date.
    "changed_silver_blocks": _run_part(_changes, "blocks"),
    "changed_silver_transactions": _run_part(_changes, "transactions"),
    "changed_waiting_transactions": _run_part(_changes, "waiting"),
    "utxo_reconciliation": _ledger(_raw_reconciliation),
    "utxo_reconciliation_dedup": _job("reconciliation"),
    "double_spends": _ledger(_double_spends),
    "outputs_enriched": _job("enriched_outputs"),
    "chain_links": _ledger(lambda ledger: check_chain_links(ledger.blocks.accepted)),
    # Gold
    "gold_blocks": _job("gold_blocks"),
    "gold_transactions": _job("gold_transactions"),
    "gold_inputs": _job("gold_inputs"),
    "gold_inputs_from_tables": _job("gold_inputs_from_tables"),
    "gold_outputs": _job("gold_outputs"),
    # Reports
    "q_kpis": _ledger(lambda ledger: reports.headline(ledger.gold_transactions, ledger.gold_blocks)),
    "q_fee_rate_histogram": _ledger(
        lambda ledger: reports.fee_rate_histogram(ledger.gold_transactions)
    ),
    "q_fee_vs_size": _ledger(lambda ledger: reports.fee_versus_size(ledger.gold_transactions)),
    "q_tx_shape": _ledger(lambda ledger: reports.shape_composition(ledger.gold_transactions)),
    "q_top_fee": _ledger(lambda ledger: reports.top_fees(ledger.gold_transactions)),
    **{
        f"q_metrics_{e}": _ledger(lambda ledger, e=e: measure(getattr(ledger, f"gold_{e}"), e))
        for e in ENTITIES
    },
    "q_daily_trend": _ledger(lambda ledger: reports.daily_trend(ledger.gold_transactions)),
    "q_trend_in_range": _ledger(_kpis_in_range),
    "q_trend_in_range_partitioned": lambda spark, folder: _trend_of_partitions(SampleLedger.shared(spark, folder)),
    "q_trend_on_dates": lambda spark, folder: _trend_of_hard_days(SampleLedger.shared(spark, folder)),
    "q_output_recon_summary": _ledger(
        lambda ledger: reports.output_reconciliation_summary(ledger.gold_outputs)
    ),
    "q_utxo_summary": _ledger(lambda ledger: reports.resolution_summary(ledger.gold_inputs)),
    "q_recon_kpis": _job("reconciliation_kpis"),
    "q_time_to_spend_hist": _ledger(
        lambda ledger: reports.time_to_spend_histogram(ledger.gold_outputs)
    ),
    "q_rejects_by_reason": _ledger(
        lambda ledger: reports.rejects_by_reason(_all_rejects(ledger))
    ),
    "q_ingest_audit": _ledger(lambda ledger: reports.ingestion_audit(ledger.bronze)),
    "q_miners": _ledger(lambda ledger: reports.miner_comparison(ledger.gold_blocks)),
    "q_sql_over_gold": _ledger(_sql_over_gold),
    # Corruption
    "corruption_rejects_quality": _ledger(_corruption_rejects("data_quality")),
    "corruption_rejects_relationships": _ledger(_corruption_rejects("relationships")),
    "corruption_rejects": _ledger(_corruption_rejects("mixed")),
    "corruption_effects": _ledger(_corruption_effects),
}
