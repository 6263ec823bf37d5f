import os
import time
from datetime import datetime, timezone
from uuid import uuid4

import pytest

from ledgerforge.operators.quality import finalize_rejections
from ledgerforge.plans.batch import Warehouse
from ledgerforge.session import (
    ensure_namespaces,
    session_settings,
    settings_from_environment,
    shuffle_settings,
    table_name,
)
from ledgerforge.sources.delivery import add_lineage, csv_to_parquet, delivery_files, file_bytes, read_delivery
from ledgerforge.sources.schemas import SCHEMAS
from ledgerforge.sources.staging import Staging, shared_folder
from ledgerforge.sources.tables import write_table


@pytest.fixture
def database(spark):
    name = f"db_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_delivery_schemas():
    assert SCHEMAS["inputs"]["previous_output_index"].dataType.simpleString() == "string"
    assert SCHEMAS["transactions"]["total_input_sats"].dataType.simpleString() == "bigint"
    assert SCHEMAS["outputs"].names == ["output_id", "tx_hash", "output_index", "address", "value_sats", "spent"]
    assert [len(SCHEMAS[e]) for e in ("blocks", "transactions", "inputs", "outputs")] == [9, 9, 7, 6]


def test_csv_fields_that_do_not_parse_become_null(spark, tmp_path):
    path = tmp_path / "outputs.csv"
    path.write_text(
        "output_id,tx_hash,output_index,address,value_sats,spent\n"
        "o1,t1,0,a,5000000000,True\n"
        ",t2,x,   ,not-a-number,not-a-boolean\n"
    )
    first, second = read_delivery(spark, str(path), SCHEMAS["outputs"]).collect()
    assert tuple(first) == ("o1", "t1", 0, "a", 5_000_000_000, True)
    assert tuple(second) == (None, "t2", None, "   ", None, None)


@pytest.mark.parametrize("text", ["2026-01-02T03:04:05", "2026-01-02 03:04:05", "2026-01-02T03:04:05Z"])
def test_csv_timestamps(spark, tmp_path, text):
    path = tmp_path / "transactions.csv"
    path.write_text(",".join(SCHEMAS["transactions"].names) + f"\nt,b,{text},1,1,1,1,1,1\n")
    assert read_delivery(spark, str(path), SCHEMAS["transactions"]).first().timestamp == datetime(2026, 1, 2, 3, 4, 5)


def test_lineage(spark, tmp_path):
    path = tmp_path / "blocks.csv"
    path.write_text("block_hash\nblock-1\n")
    df = add_lineage(spark.read.option("header", True).csv(str(path)), "batch-42", datetime(2026, 1, 1))
    row = df.first()
    assert df.columns == ["block_hash", "ingested_at", "source_file", "batch_id"]
    assert (row.batch_id, row.ingested_at) == ("batch-42", datetime(2026, 1, 1))
    assert row.source_file.endswith("blocks.csv")


def test_delivery_precondition(spark, tmp_path):
    with pytest.raises(ValueError):
        delivery_files(spark, str(tmp_path), "2026-1-1")
    folder = tmp_path / "ingest_2026-01-01"
    folder.mkdir()
    with pytest.raises(FileNotFoundError):
        delivery_files(spark, str(tmp_path), "2026-01-01")
    for entity in SCHEMAS:
        (folder / f"{entity}.csv").write_text("x\n")
    assert set(delivery_files(spark, str(tmp_path), "2026-01-01")) == set(SCHEMAS)


def test_inferred_csv_copy(spark, tmp_path):
    source, target = tmp_path / "x.csv", str(tmp_path / "x.parquet")
    source.write_text("a,b\n1,x\n2,y\n")
    for _ in range(2):
        csv_to_parquet(spark, str(source), target)
    copied = spark.read.parquet(target)
    assert copied.schema["a"].dataType.simpleString() == "int" and rows(copied) == [(1, "x"), (2, "y")]


def test_create_if_missing_in_every_mode(spark, database, frame):
    df = frame([(1, "x")], "id int, part string")
    for mode in ("append", "overwrite_partitions", "create_or_replace"):
        write_table(df, f"{database}.{mode}", mode=mode)
        assert rows(spark.table(f"{database}.{mode}")) == [(1, "x")]


def test_append_matches_columns_by_name(spark, database, frame):
    name = f"{database}.t"
    write_table(frame([(1, "x")], "id int, part string"), name)
    write_table(frame([("y", 2)], "part string, id int"), name)
    assert rows(spark.table(name)) == [(1, "x"), (2, "y")]


def test_append_refuses_or_merges_new_columns(spark, database, frame):
    name = f"{database}.t"
    write_table(frame([(1, "x")], "id int, part string"), name)
    wider = frame([(2, "y", 5)], "id int, part string, extra long")
    with pytest.raises(ValueError):
        write_table(wider, name)
    write_table(wider, name, merge_schema=True)
    write_table(frame([(3,)], "id int"), name, merge_schema=True)
    found = spark.table(name).collect()
    assert sorted(((r.id, r.part, r.extra) for r in found)) == [(1, "x", None), (2, "y", 5), (3, None, None)]


def test_overwrite_partitions(spark, database, frame):
    name = f"{database}.t"
    write_table(frame([(1, "x"), (2, "y")], "id int, part string"), name, partition_by=["part"])
    write_table(frame([(9, "y")], "id int, part string"), name, mode="overwrite_partitions")
    assert rows(spark.table(name)) == [(1, "x"), (9, "y")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_create_or_replace_changes_schema(spark, database, frame):
    name = f"{database}.t"
    write_table(frame([(1, "x")], "id int, part string"), name)
    write_table(frame([(2,)], "other long"), name, mode="create_or_replace")
    assert spark.table(name).columns == ["other"] and rows(spark.table(name)) == [(2,)]


def test_unknown_mode(frame):
    with pytest.raises(ValueError):
        write_table(frame([(1,)], "id int"), "db.t", mode="upsert")


def test_staging_keeps_and_releases(spark, frame):
    with Staging(spark) as stage:
        assert stage.folder.startswith(shared_folder(spark))
        kept = stage.keep(frame([(1, "x")], "id int, part string"), "t")
        assert rows(kept) == [(1, "x")]
        with pytest.raises(ValueError):
            stage.keep(kept, "t")
    with pytest.raises(Exception):
        kept.collect()


def test_shuffles_are_sized_for_the_input(spark, database):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert shuffle_settings(spark, 64 << 30) == {key: "1024"}
    assert shuffle_settings(spark, 100 << 40) == {key: str((100 << 40) // (64 << 20))}
    name = f"{database}.small"
    write_table(spark.range(1000).selectExpr("id", "id % 3 AS part"), name, partition_by=["part"])
    size = file_bytes(spark.table(name))
    assert 0 < size < 1 << 20 and shuffle_settings(spark, size) == {}
    with session_settings(spark, {key: "7"}):
        assert shuffle_settings(spark, 64 << 30) == {} and spark.conf.get(key) == "7"
    assert spark.conf.get(key, None) is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_stamps_are_instants_in_any_zone(spark, zone):
    """A stamp carries its zone, so the driver process may run in any."""
    at = datetime(2026, 3, 4, 5, 6, 7, tzinfo=timezone.utc)
    before = os.environ.get("TZ")
    os.environ["TZ"] = zone
    time.tzset()
    try:
        stamped = add_lineage(spark.range(1), "2026-03-04", at).selectExpr("unix_timestamp(ingested_at) AS s").first().s
        rejected = spark.range(1).selectExpr("id", "array('X') AS validation_errors")
        late = finalize_rejections(rejected, rejected_at=at).selectExpr("unix_timestamp(rejected_at) AS s").first().s
        assert Warehouse(spark).run_at.tzinfo is not None
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    assert stamped == late == int(at.timestamp())


def test_names_and_settings(spark):
    assert table_name("silver", "blocks") == "silver.blocks"
    assert table_name("gold", "inputs", "lake") == "lake.gold.inputs"
    with pytest.raises(ValueError):
        table_name("platinum", "blocks")
    ensure_namespaces(spark)
    assert {"bronze", "silver", "silver_rejects", "gold"} <= {d.name for d in spark.catalog.listDatabases()}
    settings = settings_from_environment({"SPARK_MASTER_URL": "local", "ICEBERG_CATALOG": "lake", "ICEBERG_CATALOG_TYPE": "hive"})
    assert settings["spark.master"] == "local" and settings["spark.sql.catalog.lake.type"] == "hive"
    assert settings["spark.sql.session.timeZone"] == "UTC"


@pytest.mark.parametrize("mode", ["append", "overwrite_partitions", "create_or_replace"])
@pytest.mark.parametrize("exists", [False, True])
def test_other_catalogs_use_the_v2_writer(mode, exists):
    """No other catalog is installed here, so the calls are checked on a stand-in."""
    from unittest.mock import MagicMock

    df = MagicMock()
    df.sparkSession.catalog.tableExists.return_value = exists
    writer = df.writeTo.return_value
    writer.option.return_value = writer
    write_table(df, "lake.silver.blocks", mode=mode, merge_schema=True)
    df.writeTo.assert_called_once_with("lake.silver.blocks")
    writer.option.assert_called_once_with("mergeSchema", "true")
    used = {"append": writer.append, "overwrite_partitions": writer.overwritePartitions, "create_or_replace": writer.createOrReplace}
    (used[mode] if exists else writer.create).assert_called_once_with()
