"""A run with buckets sorts what lies sorted no second time, deals its inputs once more, and packs its files."""

import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerforge.operators.quality import separate, total_problems
from ledgerforge.operators.utxo import resolve_inputs
from ledgerforge.plans import batch, gold
from ledgerforge.plans.batch import BUCKET_JOINS, Warehouse, run_batch
from ledgerforge.plans.corruption import as_text
from ledgerforge.session import INITIAL_PARTITIONS, drop_namespaces, session_settings
from ledgerforge.sources.staging import Staging
from tests.test_batch import FIRST, clean_tables, deliver

BUCKETS = 4
JOINED = {"spark.sql.autoBroadcastJoinThreshold": "-1", INITIAL_PARTITIONS: str(BUCKETS), **BUCKET_JOINS}


def nodes(df, kind):
    return df._jdf.queryExecution().executedPlan().toString().count(kind)


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    tables = {entity: as_text(df) for entity, df in clean_tables(spark).items()}
    tables["inputs"] = tables["inputs"].unionByName(tables["inputs"].filter("tx_hash = 'tx3'").withColumn("tx_hash", F.lit("lost")))
    deliver(tables, root)
    prefix = f"d{uuid.uuid4().hex[:8]}_"
    seen, plain = [], batch.Staging.keep
    patch = pytest.MonkeyPatch()
    patch.setattr(batch.Staging, "keep", lambda self, df, name, *a, **b: seen.append(name) or plain(self, df, name, *a, **b))
    run_batch(spark, root, FIRST, prefix=prefix, buckets=BUCKETS)
    patch.undo()
    made = Warehouse(spark, prefix=prefix, buckets=BUCKETS)
    yield made, seen
    drop_namespaces(spark, prefix)


def test_problems_are_found_and_separated_without_sorting_rows(spark, house):
    house, _ = house
    outputs, known = house.read("silver", "outputs"), house.read("silver", "transactions")
    totals = {"declared_total": "total_output_sats", "declared_count": "output_count"}
    codes = {"total_code": "A", "count_code": "B", "missing_code": "C"}
    with session_settings(spark, JOINED):
        problems = total_problems(outputs, known, key="tx_hash", value="value_sats", **totals, **codes)
        assert nodes(problems, "Sort [") == nodes(problems, "Exchange") == 0
        assert problems.count() == 0
        few = spark.range(1).selectExpr("'tx3' AS tx_hash", "array('A') AS validation_errors")
        kept, failed = separate(outputs, few, ["tx_hash"])
        # Only the list of problems is dealt and sorted.
        assert nodes(kept, "Sort [") <= 1 and nodes(failed, "Sort [") <= 1
        assert failed.count() > 0 and kept.count() + failed.count() == outputs.count()
        gold_rows = gold.gold_transactions(known, house.read("silver", "inputs"), outputs)
        assert nodes(gold_rows, "Sort [") == nodes(gold_rows, "Exchange") == 0 and gold_rows.count() == known.count()


def test_inputs_are_dealt_once_for_reconciliation_and_gold(spark, house):
    house, seen = house
    assert "timed_inputs" in seen and "verdicts" not in seen
    silver = {name: house.read("silver", name) for name in ("inputs", "outputs", "transactions")}

    def rows(df):
        return sorted(map(repr, df.select(*sorted(df.columns)).collect()))

    resolved = resolve_inputs(silver["inputs"], silver["outputs"], unique_outputs=True)
    written = house.read("silver", "utxo_reconciliation")
    assert written.columns == resolved.columns and rows(written) == rows(resolved) and written.count() > 0
    aged = gold.age_inputs(resolved.drop("matching_output_count"), silver["transactions"])
    assert house.read("gold", "inputs").columns == aged.columns
    assert rows(house.read("gold", "inputs")) == rows(aged)


def test_nothing_staged_is_left(spark, house):
    house, _ = house
    assert not [t.name for t in spark.catalog.listTables(f"{house.prefix}silver") if "staged" in t.name]


def column(file, name):
    meta = pq.ParquetFile(file.removeprefix("file:").replace("//", "/")).metadata.row_group(0)
    return next(c for c in map(meta.column, range(meta.num_columns)) if c.path_in_schema == name)


def test_files_are_packed_without_dictionaries_of_values_that_hardly_repeat(spark, house):
    house, _ = house
    frames = [house.read("bronze", "outputs"), house.read("silver", "outputs"), house.read("gold", "outputs")]
    with Staging(spark, bounded=True) as stage:
        frames.append(stage.keep(frames[0], "copy"))
        for df in frames:
            found = column(df.inputFiles()[0], "tx_hash")
            assert found.compression == "ZSTD" and not any("DICTIONARY" in e for e in found.encodings)
            assert any("DICTIONARY" in e for e in column(df.inputFiles()[0], "source_file").encodings)
