"""Registered queries against DuckDB on the whole sf0.001 tables.

By default a selection that covers every layer runs; ALL_QUERIES=1 runs them all (the same
check as `python -m tests.compare FOLDER`).
"""

import os

import pytest

from __spark_entry__ import entry
from ledgerforge.plans.registry import QUERIES
from oracle.registry import ORACLE_SQL
from tests.compare import connect, difference, oracle_result, spark_result

FOLDER = "/root/testdata/sf0.001"
USUAL = (
    "bronze_blocks bronze_inputs silver_blocks_native reject_inputs_native silver_conservation union_by_position gold_inputs_from_tables q_kpis q_metrics_inputs"
    " q_utxo_summary q_miners latest_by_key reference_missing id_collisions total_reconciliation row_quarantine"
    " window_total top_per_group chain table_write_modes silver_blocks reject_transactions reject_outputs"
    " utxo_reconciliation gold_outputs q_fee_rate_histogram corruption_effects"
).split()
NAMES = list(QUERIES) if os.environ.get("ALL_QUERIES") else USUAL

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    assert difference(spark_result(spark, name, FOLDER), oracle_result(duck, name)) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "transaction_date" and df.count() > 0
