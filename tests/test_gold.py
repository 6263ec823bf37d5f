from datetime import datetime

import pytest

from ledgerforge.functions.metrics import measure, summed
from ledgerforge.plans import gold, reports
from tests.conftest import rows_by


@pytest.fixture
def transactions(frame):
    """Two in block north, one in a block that nobody delivered."""
    return frame(
        [
            ("p", "north", datetime(2031, 3, 5, 23, 59), 30, 120, 2, 1, 500, 470),
            ("q", "north", datetime(2031, 3, 6), 7, 40, 1, 3, 90, 83),
            ("r", "astray", datetime(2031, 3, 9), 1, 0, 1, 1, 2, 1),
        ],
        "tx_hash string, block_hash string, timestamp timestamp, fee_sats long, size_bytes int, input_count int,"
        " output_count int, total_input_sats long, total_output_sats long",
    )


TIMES = "tx_hash string, block_hash string, timestamp timestamp"
CHILD = "tx_hash string, value_sats long"


def test_blocks(frame, transactions):
    blocks = frame([("north", 2), ("south", 0), ("west", 5)], "block_hash string, transaction_count int")
    found = rows_by(gold.gold_blocks(blocks, transactions), "block_hash")
    assert {n: (r.observed_transaction_count, r.total_fee_sats, r.transaction_count_matches) for n, r in found.items()} == {
        "north": (2, 37, True),
        "south": (0, 0, True),
        "west": (0, 0, False),
    }
    assert found["north"].total_transaction_size_bytes == 160 and found["north"].total_output_sats == 553


def test_transactions(frame, transactions):
    inputs = frame([("p", 480), ("p", 20), ("q", 91)], CHILD)
    outputs = frame([("p", 470), ("q", 80), ("q", 3)], CHILD)
    found = rows_by(gold.gold_transactions(transactions, inputs, outputs), "tx_hash")
    flags = lambda r: (r.input_count_matches, r.input_value_matches, r.output_count_matches, r.output_value_matches)
    assert flags(found["p"]) == (True, True, True, True) and flags(found["q"]) == (True, False, False, True)
    assert (found["r"].observed_input_count, found["r"].observed_total_output_sats) == (0, 0)
    assert found["p"].fee_rate_sats_per_byte == 0.25 and found["r"].fee_rate_sats_per_byte is None
    assert [str(found[n].transaction_date) for n in "pqr"] == ["2031-03-05", "2031-03-06", "2031-03-09"]


def test_inputs_from_separate_tables(frame):
    inputs = frame(
        [("q", 1, "p", 4), ("q", 2, "genesis", 0), ("p", 7, "z", 1)],
        "tx_hash string, input_index int, previous_tx_hash string, previous_output_index int",
    )
    times = frame([("q", "north", datetime(2031, 3, 9, 1)), ("p", "south", datetime(2031, 2, 27, 22))], TIMES)
    kinds = dict.fromkeys(gold.RECONCILED_FIELDS, "string") | {
        "referenced_output_index": "int", "referenced_value_sats": "long",
        "address_matches": "boolean", "value_matches": "boolean", "double_spend_detected": "boolean",
    }
    schema = ", ".join(f"{n} {t}" for n, t in ({"tx_hash": "string", "input_index": "int"} | kinds).items())
    reconciliation = frame([("q", 1, "resolved", "p", 4, "out-5", "x9", 31, False, True, True)], schema)
    found = rows_by(gold.gold_inputs(inputs, times, reconciliation), "input_index")
    assert found[1].coin_age_days == 10 and found[1].double_spend_detected and not found[1].is_genesis_input
    assert found[1].spending_block_hash == "north" and str(found[1].spend_date) == "2031-03-09"
    assert found[2].is_genesis_input and found[2].coin_age_days is None and found[2].resolution_status == "not_reconciled"
    assert found[7].double_spend_detected is False and found[7].spending_block_hash == "south"


def test_outputs(frame):
    outputs = frame(
        [("p", 4, True), ("p", 5, True), ("q", 0, False)], "tx_hash string, output_index int, canonical_spent boolean"
    )
    times = frame(
        [("p", "south", datetime(2031, 2, 27)), ("q", "north", datetime(2031, 3, 9)), ("s", "east", datetime(2031, 3, 1))],
        TIMES,
    )
    reconciliation = frame(
        [("q", "p", 4, "resolved"), ("s", "p", 4, "resolved"), ("s", "p", 5, "resolved"), ("s", "q", 0, "ambiguous")],
        "tx_hash string, previous_tx_hash string, previous_output_index int, resolution_status string",
    )
    made = gold.gold_outputs(outputs, times, gold.timed_spends(reconciliation, times))
    found = {(r.tx_hash, r.output_index): r for r in made.collect()}
    spends = {k: (r.observed_spend_count, r.has_multiple_spend_attempts, r.time_to_spend_days) for k, r in found.items()}
    assert spends == {("p", 4): (2, True, 2), ("p", 5): (1, False, 2), ("q", 0): (0, False, None)}
    assert found["q", 0].creating_block_hash == "north" and str(found["p", 4].first_spend_date) == "2031-03-01"


def test_sums_go_beyond_the_long_range(frame):
    huge = 2**62
    outputs = frame([(huge, True, False)] * 3, "value_sats long, canonical_spent boolean, spend_discrepancy boolean")
    assert measure(outputs, "outputs", ["total_output_sats"]).first()[0] == 3 * huge
    assert outputs.agg(summed("value_sats")).first()[0] == 3 * huge
    assert reports.output_reconciliation_summary(outputs).first().total_value_sats == 3 * huge
    fees = frame([(2**53 + 1, 0.5)], "fee_sats long, fee_rate_sats_per_byte double")
    assert reports.headline(fees, frame([(1,)], "n int")).first().total_fee_sats == 2**53 + 1


def test_histogram_closes_the_last_bin_and_handles_one_value(spark):
    values = spark.range(101).selectExpr("cast(id AS double) AS v").union(spark.sql("SELECT cast(null AS double)"))
    bins = {r.bin: r["count"] for r in reports.histogram(values, "v", 20).collect()}
    assert set(bins) == set(range(20)) and bins[0] == 5 and bins[19] == 6 and sum(bins.values()) == 101
    same = spark.range(5).selectExpr("1.5D AS v")
    assert [tuple(r) for r in reports.histogram(same, "v").collect()] == [(0, 1.5, 5)]


def test_top_fees_plan_keeps_few_rows_per_task(frame, transactions):
    rated = transactions.selectExpr("*", "0.5D AS fee_rate_sats_per_byte")
    plan = reports.top_fees(rated)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_sums_beyond_a_long(frame):
    most = 2**62
    blocks = frame([("b", 2)], "block_hash string, transaction_count int")
    schema = "block_hash string, fee_sats long, size_bytes int, total_input_sats long, total_output_sats long"
    found = gold.gold_blocks(blocks, frame([("b", most, 2**31 - 1, most, most)] * 2, schema)).first()
    assert (found.total_fee_sats, found.total_input_sats, found.total_output_sats) == (2 * most,) * 3
    assert found.total_transaction_size_bytes == 2**32 - 2 and found.transaction_count_matches
