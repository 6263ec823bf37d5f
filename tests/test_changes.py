"""Silver by changed keys against a full rebuild, and what it reads and writes."""

import uuid
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerforge.plans import changes, silver
from ledgerforge.plans.batch import Warehouse
from ledgerforge.session import drop_namespaces, ensure_namespaces
from ledgerforge.sources.delivery import add_lineage
from ledgerforge.sources.staging import Staging
from ledgerforge.sources.tables import write_table
from ledgerforge.streaming.incremental import run_changes
from tests.test_batch import LAST, clean_tables, deliver

BATCHES = ("2026-01-01", "2026-01-02", "2026-01-03")


@pytest.fixture
def house(spark):
    prefix = f"c{uuid.uuid4().hex[:8]}_"
    ensure_namespaces(spark, prefix=prefix)
    yield Warehouse(spark, prefix=prefix, run_at=datetime(2026, 2, 1, tzinfo=timezone.utc))
    drop_namespaces(spark, prefix)


def land(house, batch_id, **tables):
    for entity, df in tables.items():
        stamp = datetime.fromisoformat(batch_id).replace(tzinfo=timezone.utc)
        rows = add_lineage(df, batch_id, stamp).withColumn("source_file", F.lit(f"{batch_id}/{entity}.csv"))
        write_table(rows, house.name("bronze", entity), partition_by=["batch_id"])


def deliveries(house):
    """Blocks 0, 1, 3 first; then transactions that move to another block and date, a damaged one and one that
    came twice; then the missing block 2, and block 3 again, a day later."""
    tables = clean_tables(house.spark)
    blocks, transactions = tables["blocks"], tables["transactions"]
    number = F.regexp_extract("tx_hash", r"(\d+)", 1).cast("int")
    moved = transactions.filter(number.between(30, 39)).withColumns(
        {"block_hash": F.lit("block0"), "timestamp": F.col("timestamp") - F.expr("interval 3 days")}
    )
    damaged = transactions.filter(number == 5).withColumn("fee_sats", F.lit(-1).cast("bigint"))
    again = transactions.filter(number == 7)
    nowhere = transactions.filter(number == 8).withColumn("block_hash", F.lit("nowhere"))
    land(house, BATCHES[0], blocks=blocks.filter("block_hash <> 'block2'"), transactions=transactions)
    second = moved.unionByName(damaged).unionByName(again).unionByName(again).unionByName(nowhere)
    land(house, BATCHES[1], transactions=second)
    late = blocks.filter("block_hash = 'block3'").withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 day"))
    land(house, BATCHES[2], blocks=blocks.filter("block_hash = 'block2'").unionByName(late))


def listed(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def check_against_rebuild(house, batches):
    bronze = {e: house.read("bronze", e).filter(F.col("batch_id").isin(list(batches))) for e in ("blocks", "transactions")}
    with Staging(house.spark) as stage:
        blocks = silver.silver_blocks(bronze["blocks"], stage, house.run_at)
        whole = silver.silver_transactions(bronze["transactions"], blocks.accepted, stage, house.run_at)
        table = lambda layer, name: house.spark.table(house.name(layer, name))
        assert listed(table("silver", changes.BLOCKS).drop(changes.PERIOD)) == listed(blocks.accepted)
        found = table("silver", changes.TRANSACTIONS).drop(changes.PERIOD)
        assert listed(found) == listed(whole.accepted)
        late = F.array_contains("validation_errors", silver.BLOCK_NOT_FOUND)
        waiting = table("silver_rejects", changes.WAITING).drop(changes.PERIOD)
        assert listed(waiting) == listed(whole.rejected.filter(late).drop("validation_errors", "rejected_at"))
        failed = table("silver_rejects", "transactions_by_batch")
        assert listed(failed) == listed(whole.rejected.filter(~late))
        assert listed(table("silver_rejects", "blocks_by_batch")) == listed(blocks.rejected)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_batches_by_changed_keys_equal_a_rebuild_in_any_order(house, order):
    deliveries(house)
    for turn in range(1, 4):
        applied = [BATCHES[i] for i in order[:turn]]
        changes.bring_up_to_date(house, applied[-1:])
        if turn > 1:
            check_against_rebuild(house, applied)


def partitions(house, entity, day):
    name = house.name("silver", entity)
    files = house.spark.table(name).select(day, F.col("_metadata.file_path").alias("file")).distinct().collect()
    found = {}
    for row in files:
        found.setdefault(row[day], set()).add(row.file)
    return found


def test_only_dates_of_changed_keys_are_read_and_written(house):
    deliveries(house)
    first = changes.bring_up_to_date(house, BATCHES[:1])[changes.TRANSACTIONS]
    assert first.periods == tuple(date(2026, 1, d) for d in (1, 2, 4)) and first.written == 30
    before = partitions(house, changes.TRANSACTIONS, changes.PERIOD)
    assert sorted(before) == [date(2026, 1, d) for d in (1, 2, 4)]  # the third waits for its block
    second = changes.bring_up_to_date(house, BATCHES[1:2])
    moved = second[changes.TRANSACTIONS]
    after = partitions(house, changes.TRANSACTIONS, changes.PERIOD)
    assert after[date(2026, 1, 2)] == before[date(2026, 1, 2)]  # untouched
    assert date(2026, 1, 4) not in after  # all its rows moved
    assert after[date(2026, 1, 1)] != before[date(2026, 1, 1)]
    assert moved.periods == (date(2026, 1, 1), date(2026, 1, 4))
    assert moved.written == 19 and moved.judged == 11  # ten of that day less one that waits now, and ten moved ones
    assert second[changes.BLOCKS] == changes.Change((), 0, 0)


def test_rows_of_other_dates_are_not_scanned(house):
    from tests.test_plans import scans

    deliveries(house)
    changes.bring_up_to_date(house, BATCHES)
    rows = house.spark.table(house.name("silver", changes.TRANSACTIONS))
    table = changes.DatedTable(house.name("silver", changes.TRANSACTIONS), rows, "tx_hash")
    [(filters, folders, _)] = scans(table.within({date(2026, 1, 2)}))
    assert changes.PERIOD in filters and folders == 1
    assert table.within(set()).isEmpty()


def test_a_run_that_stops_between_tables_is_repeated(house, monkeypatch):
    deliveries(house)
    changes.bring_up_to_date(house, BATCHES[:1])
    real, calls = changes.DatedTable.replace, []

    def stops(self, *args):
        calls.append(self.name)
        if self.name.endswith(changes.WAITING):
            raise RuntimeError("lost")
        return real(self, *args)

    monkeypatch.setattr(changes.DatedTable, "replace", stops)
    with pytest.raises(RuntimeError):
        changes.bring_up_to_date(house, BATCHES[1:])
    monkeypatch.setattr(changes.DatedTable, "replace", real)
    changes.bring_up_to_date(house, BATCHES[1:])
    check_against_rebuild(house, BATCHES)


def test_deliveries_that_arrive_are_applied_by_key(spark, house, tmp_path):
    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    tables = clean_tables(spark)
    run = lambda **more: run_changes(spark, root, checkpoint, prefix=house.prefix, run_at=house.run_at, **more)
    deliver({"blocks": tables["blocks"]}, root, BATCHES[0])
    assert run() == {}  # transactions have not been delivered yet
    early = tables["transactions"].filter("timestamp < timestamp '2026-01-03 00:00:00'")
    deliver({"transactions": early}, root, BATCHES[1])
    assert run()[changes.TRANSACTIONS].written == early.count()  # the blocks of the first run are applied too
    assert run() == {}
    late = tables["transactions"].filter("timestamp >= timestamp '2026-01-03 00:00:00'")
    deliver({"transactions": late}, root, BATCHES[2])
    change = run()[changes.TRANSACTIONS]
    assert change.periods == (date(2026, 1, 3), date(2026, 1, 4)) and change.written == late.count()
    assert spark.table(house.name("silver", changes.TRANSACTIONS)).count() == LAST
    assert run(again=[BATCHES[2]])[changes.TRANSACTIONS].judged == late.count()
    check_against_rebuild(house, BATCHES)
