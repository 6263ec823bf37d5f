"""What the plans of the ledger frames must and must not contain."""

import pytest

from ledgerforge.operators.utxo import resolve_inputs
from ledgerforge.plans import exercises, reports
from ledgerforge.plans.sample_ledger import SampleLedger
from ledgerforge.session import session_settings
from ledgerforge.sources.schemas import ENTITIES
from ledgerforge.sources.staging import Staging

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ledger(spark):
    return SampleLedger(spark, "/root/testdata/sf0.001")


def frames(ledger):
    yield from (getattr(ledger, f"gold_{e}") for e in ENTITIES)
    yield ledger.enriched_outputs
    for entity in ENTITIES:
        checked = getattr(ledger, entity)
        yield from (checked.accepted, checked.rejected)
    yield reports.fee_rate_histogram(ledger.gold_transactions)
    yield reports.rejects_by_reason({e: getattr(ledger, e).rejected for e in ENTITIES})


def test_no_cross_join_python_or_global_window(ledger):
    for df in frames(ledger):
        text = plan(df)
        assert not any(name in text for name in FORBIDDEN), text
        assert "Window" not in text or "SinglePartition" not in text, text


def test_hash_aggregates_and_single_scans(spark, ledger):
    folder = ledger.folder
    assert "SortAggregate" not in plan(exercises.line_id_collisions(spark, folder))
    assert "SortAggregate" not in plan(resolve_inputs(ledger.bronze_inputs, ledger.bronze_outputs))
    for side in (exercises.reference_valid, exercises.reference_missing):
        assert plan(side(spark, folder)).count("FileScan") == 2


@pytest.mark.parametrize("threshold", ["-1", "64MB"])
def test_silver_jobs_read_bronze_once(spark, ledger, threshold):
    """Whether problem lists are short enough to broadcast or not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        fresh = SampleLedger(spark, folder=ledger.folder)
        for entity in ENTITIES:
            fresh.__dict__[f"bronze_{entity}"] = ledger.bronze_table(entity)
        for entity in ENTITIES:
            checked = getattr(fresh, entity)
            bronze = set(ledger.bronze_table(entity).inputFiles())
            for df in (checked.accepted, checked.rejected, checked.latest):
                assert not bronze & set(df.inputFiles()), entity
            accepted = sorted(map(repr, checked.accepted.collect()))
            assert accepted == sorted(map(repr, getattr(ledger, entity).accepted.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_reference_is_split(spark, frame):
    """Half of all inputs refer to one output; adaptive execution cuts that key's rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "50",
    }
    inputs = spark.range(0, 20000, 1, 8).selectExpr(
        "concat('i', id) AS input_id", "concat('t', id) AS tx_hash", "0 AS input_index", "if(id % 2 = 0, 'hot', concat('p', id)) AS previous_tx_hash", "0 AS previous_output_index",
        "'a' AS address", "1L AS value_sats",
    )
    outputs = spark.sql("SELECT 'o' AS output_id, 'hot' AS tx_hash, 0 AS output_index, 'a' AS address, 1L AS value_sats")
    with session_settings(spark, settings), Staging(spark) as stage:
        resolved = resolve_inputs(inputs, outputs, stage=stage)
        assert resolved.filter("resolution_status = 'resolved'").count() == 10000
        resolved.collect()
        assert "skew=true" in plan(resolved)


def test_date_range_reaches_the_scan(spark, ledger):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # print the filters in full
    text = plan(reports.daily_trend(ledger.gold_transactions, start="1996-01-01", end="1996-07-01"))
    assert "GreaterThanOrEqual(transaction_date" in text and "LessThan(transaction_date" in text
    schema = text[text.index("ReadSchema") :]
    assert "fee_rate_sats_per_byte" in schema and "total_input_sats" not in schema


def scans(df):
    """(partition filters, folders read, files read) of each scan, after the query ran."""
    df.collect()
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            left.append(node.plan())
        elif name == "FileSourceScanExec":
            metrics = {key: node.metrics().apply(key).value() for key in ("numFiles", "numPartitions") if node.metrics().contains(key)}
            found.append((node.partitionFilters().toString(), metrics.get("numPartitions"), metrics["numFiles"]))
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def test_only_partitions_in_the_range_are_read(ledger):
    by_date = ledger.gold_transactions_by_date
    days = by_date.filter("transaction_date >= '1996-01-01' AND transaction_date < '1996-07-01'").select("transaction_date").distinct().count()
    [(filters, folders, files)] = scans(reports.daily_trend(by_date, start="1996-01-01", end="1996-07-01"))
    assert "transaction_date" in filters and folders == days > 50
    assert days <= files < len(by_date.inputFiles()) / 5


def test_a_list_of_dates_prunes_partitions_when_it_is_known(ledger):
    by_date = ledger.gold_transactions_by_date
    hard = ledger.gold_blocks.filter("difficulty >= 88").select("block_date")
    wanted = {r.block_date for r in hard.distinct().collect()}
    days = {r.transaction_date for r in by_date.select("transaction_date").distinct().collect()}
    found = reports.daily_trend(reports.on_dates(by_date, "transactions", hard))
    pruned = [scan for scan in scans(found) if "dynamicpruning" in scan[0]]
    assert len(pruned) == 1 and pruned[0][1] == len(wanted & days) < len(days) / 3
    assert {r.transaction_date for r in found.collect()} == wanted & days
