"""Silver dealt by tx_hash once: later joins by transaction leave the large side where it lies."""

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerforge.operators.quality import total_problems
from ledgerforge.operators.utxo import enrich_outputs
from ledgerforge.plans import gold
from ledgerforge.plans.batch import BUCKET_JOINS, BUCKETED, Warehouse, run_batch
from ledgerforge.plans.corruption import as_text
from ledgerforge.session import drop_namespaces, session_settings
from tests.test_batch import FIRST, clean_tables, deliver

BUCKETS = 4


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """The same corrupted delivery without and with buckets."""
    root = str(tmp_path_factory.mktemp("raw"))
    tables = {entity: as_text(df) for entity, df in clean_tables(spark).items()}
    for entity, key, column in (("inputs", "input_id = 'i12-0'", "value_sats"), ("outputs", "output_id = 'o5-0'", "tx_hash")):
        bad = F.when(F.expr(key), "lost").otherwise(F.col(column))
        tables[entity] = tables[entity].withColumn(column, bad).union(tables[entity].filter("tx_hash = 'tx3'"))
    deliver(tables, root)
    houses = {}
    for buckets in (None, BUCKETS):
        prefix = f"b{uuid.uuid4().hex[:8]}_"
        report = run_batch(spark, root, FIRST, prefix=prefix, buckets=buckets)
        houses[buckets] = (Warehouse(spark, prefix=prefix, buckets=buckets), report)
    yield houses
    for house, _ in houses.values():
        drop_namespaces(spark, house.prefix)


def rows(df):
    df = df.drop("ingested_at", "rejected_at")
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_buckets_change_no_row(spark, runs):
    (plain, report), (dealt, dealt_report) = runs.values()
    assert report == dealt_report and report["outputs"]["rejected"] > 0
    for layer in ("silver", "silver_rejects", "gold"):
        names = {t.name for t in spark.catalog.listTables(plain.prefix + layer)}
        assert names == {t.name for t in spark.catalog.listTables(dealt.prefix + layer)}
        for name in names:
            assert rows(plain.read(layer, name)) == rows(dealt.read(layer, name)), name


def test_each_bucket_is_one_file(spark, runs):
    house, _ = runs[BUCKETS]
    for layer, name in BUCKETED:
        files = house.read(layer, name).inputFiles()
        assert 0 < len(files) <= BUCKETS, (name, files)


def moved(df):
    """Tables whose rows an exchange of the plan deals anew, if they are not reduced to keys first."""
    df.collect()
    found = set()

    def walk(node, under, reduced):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan(), under, reduced)
        if name.endswith("QueryStageExec"):
            return walk(node.plan(), under, reduced)
        if name in ("ShuffleExchangeExec", "BroadcastExchangeExec"):
            under, reduced = True, False
        reduced = reduced or "Aggregate" in name
        if name == "FileSourceScanExec" and under and not reduced:
            found.add(node.tableIdentifier().get().table().split("_")[0] if node.tableIdentifier().isDefined() else "files")
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), under, reduced)

    walk(df._jdf.queryExecution().executedPlan(), False, False)
    return found


def test_joins_by_transaction_move_no_large_table(spark, runs):
    house, _ = runs[BUCKETS]
    silver = {name: house.read("silver", name) for name in ("transactions", "inputs", "outputs", "outputs_enriched")}
    reconciled = house.read("silver", "utxo_reconciliation")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", **BUCKET_JOINS}
    totals = {"declared_total": "total_output_sats", "declared_count": "output_count"}
    codes = {"total_code": "A", "count_code": "B", "missing_code": "C"}
    with session_settings(spark, settings):
        jobs = {
            "totals": total_problems(silver["outputs"], silver["transactions"], key="tx_hash", value="value_sats", **totals, **codes),
            "transactions": gold.gold_transactions(silver["transactions"], silver["inputs"], silver["outputs"]),
            "enriched": enrich_outputs(silver["outputs"], reconciled),
            "outputs": gold.gold_outputs(silver["outputs_enriched"], silver["transactions"], house.read("gold", "inputs")),
        }
        for name, job in jobs.items():
            assert not moved(job) & {"transactions", "outputs"}, name
        assert moved(jobs["transactions"]) == set()
