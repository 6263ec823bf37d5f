"""CSV files on disk through Bronze, Silver and Gold, clean and corrupted."""

import pytest
from pyspark.sql import functions as F

from ledgerforge.plans import silver
from ledgerforge.plans.batch import run_batch
from ledgerforge.plans.corruption import as_text, inject_corruption
from ledgerforge.sources.schemas import ENTITIES, KEYS, SCHEMAS

FIRST, LAST = "2026-01-01", 40


def clean_tables(spark):
    """A balanced ledger: transaction n spends both outputs of n - 1, the first spends genesis."""
    ids = spark.range(LAST)
    blocks = ids.filter("id % 10 = 0").selectExpr(
        "concat('block', id div 10) AS block_hash", "cast(id div 10 AS int) AS block_height",
        "concat('block', id div 10 - 1) AS previous_block_hash",
        "timestamp '2026-01-01 00:00:00' + make_dt_interval(cast(id div 10 AS int)) AS timestamp",
        "'Miner' AS miner", "75.5D AS difficulty", "id AS nonce", "1000 AS size_bytes", "10 AS transaction_count",
    )
    total = "100000 - 10 * id"
    transactions = ids.selectExpr(
        "concat('tx', id) AS tx_hash", "concat('block', id div 10) AS block_hash",
        "timestamp '2026-01-01 00:00:00' + make_dt_interval(cast(id div 10 AS int)) AS timestamp",
        "10L AS fee_sats", "100 AS size_bytes", "if(id = 0, 1, 2) AS input_count", "2 AS output_count",
        f"{total} AS total_input_sats", f"{total} - 10 AS total_output_sats",
    )
    outputs = ids.selectExpr("*", "explode(array(0, 1)) AS n").selectExpr(
        "concat('o', id, '-', n) AS output_id", "concat('tx', id) AS tx_hash", "n AS output_index",
        "concat('addr', id) AS address", f"if(n = 0, 1000L, {total} - 1010) AS value_sats", f"id < {LAST - 1} AS spent",
    )
    inputs = ids.filter("id > 0").selectExpr("*", "explode(array(0, 1)) AS n").selectExpr(
        "concat('i', id, '-', n) AS input_id", "concat('tx', id) AS tx_hash", "n AS input_index",
        "concat('tx', id - 1) AS previous_tx_hash", "cast(n AS string) AS previous_output_index",
        "concat('addr', id - 1) AS address", "if(n = 0, 1000L, 100000 - 10 * (id - 1) - 1010) AS value_sats",
    ).union(spark.sql("SELECT 'i0', 'tx0', 0, 'genesis', '0', 'addr', 100000L"))
    return {"blocks": blocks, "transactions": transactions, "inputs": inputs, "outputs": outputs}


def deliver(tables, root, batch_id=FIRST):
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for entity, df in tables.items():
        text = as_text(df).select(*SCHEMAS[entity].names)
        text.coalesce(1).write.options(**keep).csv(f"{root}/ingest_{batch_id}/{entity}.csv")


@pytest.fixture
def fresh_layers(spark):
    for layer in ("bronze", "silver", "silver_rejects", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def snapshot(spark, layers=("silver", "gold")):
    found = {}
    for layer in layers:
        for table in spark.catalog.listTables(layer):
            df = spark.table(f"{layer}.{table.name}")
            df = df.drop("ingested_at", "source_file", "batch_id")
            found[f"{layer}.{table.name}"] = sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    return found


def reasons(spark, entity):
    df = spark.table(f"silver_rejects.{entity}")
    return {r.reason: r["count"] for r in df.select(F.explode("validation_errors").alias("reason")).groupBy("reason").count().collect()}


def test_clean_batch(spark, tmp_path, fresh_layers):
    deliver(clean_tables(spark), tmp_path)
    report = run_batch(spark, str(tmp_path), FIRST, replace_batch=True, partition_gold_by_date=True)
    assert report == {
        entity: {"bronze": n, "candidates": n, "duplicates": 0, "accepted": n, "rejected": 0}
        for entity, n in {"blocks": 4, "transactions": LAST, "inputs": 2 * LAST - 1, "outputs": 2 * LAST}.items()
    }
    gold = {e: spark.table(f"gold.{e}") for e in ENTITIES}
    assert gold["blocks"].filter("transaction_count_matches").count() == 4
    matched = "input_count_matches AND output_count_matches AND input_value_matches AND output_value_matches"
    assert gold["transactions"].filter(matched).count() == LAST
    status = {r.resolution_status: r["count"] for r in gold["inputs"].groupBy("resolution_status").count().collect()}
    assert status == {"genesis": 1, "resolved": 2 * LAST - 2}
    assert gold["outputs"].filter("spend_discrepancy OR has_multiple_spend_attempts").count() == 0
    assert gold["outputs"].filter("canonical_spent").count() == 2 * LAST - 2
    assert spark.table("silver.blocks").first().miner == "miner"

    # Delivering again changes nothing but the lineage: replaced batch or duplicate rows alike.
    before = snapshot(spark)
    run_batch(spark, str(tmp_path), FIRST, replace_batch=True, partition_gold_by_date=True)
    assert spark.table("bronze.outputs").count() == 2 * LAST
    assert snapshot(spark) == before
    report = run_batch(spark, str(tmp_path), FIRST, partition_gold_by_date=True)
    assert spark.table("bronze.outputs").count() == 4 * LAST
    assert report["outputs"] == {
        "bronze": 4 * LAST, "candidates": 4 * LAST, "duplicates": 2 * LAST, "accepted": 2 * LAST, "rejected": 0,
    }
    assert snapshot(spark) == before


def test_named_mutations_give_the_expected_codes(spark, tmp_path, fresh_layers):
    """One damaged row each, chosen far apart so that the effects do not mix."""
    tables = {e: as_text(df) for e, df in clean_tables(spark).items()}

    def change(entity, where, **values):
        df = tables[entity]
        tables[entity] = df.withColumns({c: F.when(F.expr(where), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})

    change("transactions", "tx_hash = 'tx35'", timestamp="not-a-timestamp")
    change("transactions", "tx_hash = 'tx30'", input_count="3")
    change("transactions", "tx_hash = 'tx25'", total_output_sats="1")
    change("transactions", "tx_hash = 'tx20'", block_hash="unknown")
    change("inputs", "input_id = 'i15-0'", tx_hash="unknown")
    change("inputs", "input_id = 'i12-0'", previous_tx_hash="unknown")
    change("inputs", "input_id = 'i10-0'", address="bc1corruptedaddress")
    change("outputs", "output_id = 'o5-0'", tx_hash="unknown")
    change("outputs", "output_id = 'o2-0'", spent="not-a-boolean")
    change("outputs", "output_id = 'o1-0'", value_sats="not-a-number")
    deliver(tables, tmp_path)
    run_batch(spark, str(tmp_path), FIRST)
    assert reasons(spark, "transactions") == {"TIMESTAMP_MISSING": 1, "ACCOUNTING_MISMATCH": 1, "BLOCK_NOT_FOUND": 1}
    assert reasons(spark, "inputs") == {
        "TRANSACTION_NOT_FOUND": 7,  # two each under tx35, tx25, tx20, and i15-0
        "INPUT_COUNT_MISMATCH": 3,  # both inputs of tx30, i15-1
        "INPUT_VALUE_TOTAL_MISMATCH": 1,  # i15-1
    }
    assert reasons(spark, "outputs") == {
        "TRANSACTION_NOT_FOUND": 7,  # tx35, tx25, tx20, and o5-0
        "VALUE_SATS_INVALID": 1,
        "OUTPUT_COUNT_MISMATCH": 2,  # o5-1, o1-1
        "OUTPUT_VALUE_TOTAL_MISMATCH": 2,
    }
    inputs = {r.input_id: r for r in spark.table("gold.inputs").collect()}
    assert inputs["i12-0"].resolution_status == "unresolved"
    assert inputs["i10-0"].address_matches is False
    unresolved = {k for k, r in inputs.items() if r.resolution_status == "unresolved"}
    assert unresolved == {"i12-0", *(f"i{n}-{k}" for n in (36, 26, 21, 6, 2) for k in (0, 1))}
    outputs = {r.output_id: r for r in spark.table("gold.outputs").collect()}
    assert outputs["o2-0"].source_spent is None and outputs["o2-0"].spend_discrepancy


def test_a_lost_row_fails_the_run(spark, tmp_path, fresh_layers, monkeypatch):
    """Whichever step loses it: the row rules, or the search for the latest record."""
    deliver(clean_tables(spark), tmp_path)
    judge, newest = silver._judge, silver._newest

    def forgetful(df, entity, stage, *steps):
        valid, rejected, marked = judge(df, entity, stage, *steps)
        return valid.limit(valid.count() - 1) if entity == "outputs" else valid, rejected, marked

    monkeypatch.setattr(silver, "_judge", forgetful)
    with pytest.raises(RuntimeError, match="bronze.outputs"):
        run_batch(spark, str(tmp_path), FIRST, replace_batch=True)
    monkeypatch.setattr(silver, "_judge", judge)
    keep = "_separate"
    separate = getattr(silver, keep)
    monkeypatch.setattr(silver, keep, lambda rows, *rest: tuple(df.filter("true") if n else df.filter("tx_hash <> 'tx3'") for n, df in enumerate(separate(rows, *rest))))
    with pytest.raises(RuntimeError, match="silver.transactions"):
        run_batch(spark, str(tmp_path), FIRST, replace_batch=True)
    assert newest is silver._newest


def test_bad_arguments(spark):
    tables = {e: spark.createDataFrame([], SCHEMAS[e]) for e in ENTITIES}
    with pytest.raises(ValueError):
        inject_corruption(tables, "other")
    with pytest.raises(ValueError):
        inject_corruption(tables, "mixed", rate=0)


def test_corruption_shares_rows_out_evenly(spark):
    rows = spark.range(12000).selectExpr("concat('i', id) AS input_id", "concat('t', id) AS tx_hash", "0 AS input_index",
        "'p' AS previous_tx_hash", "'0' AS previous_output_index", "'a' AS address", "1L AS value_sats")
    tables = {e: spark.createDataFrame([], SCHEMAS[e]) for e in ENTITIES} | {"inputs": rows}
    damaged = inject_corruption(tables, "data_quality", 1.0)["inputs"]
    counts = damaged.selectExpr("count_if(input_id = '')", "count_if(address = '   ')", "count_if(value_sats = 'not-a-number')").first()
    assert sum(counts) >= 12000 and max(counts) - min(counts) < 400


def test_corruption_is_seeded_and_scaled(spark):
    tables = clean_tables(spark)
    untouched = inject_corruption(tables, "clean")
    assert all(untouched[e].count() == tables[e].count() for e in ENTITIES)
    order = lambda df: sorted(map(repr, df.collect()))
    once, twice, other = (inject_corruption(tables, "mixed", 0.3, seed)["inputs"] for seed in (1, 1, 2))
    assert order(once) == order(twice) != order(other)
    everything = inject_corruption(tables, "data_quality", 1.0)
    for entity in ENTITIES:
        assert everything[entity].count() == tables[entity].count() + 1
    damaged = everything["inputs"].filter("input_id = '' OR address = '   ' OR value_sats = 'not-a-number'")
    assert damaged.count() == tables["inputs"].count() + 1
    unspent = inject_corruption(tables, "relationships", 1e-9)["outputs"].filter("spent = 'False'")
    assert [r.output_id for r in unspent.collect()] == ["o0-0"]
    assert KEYS["outputs"] == ["tx_hash", "output_index"]
