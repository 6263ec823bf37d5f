"""Tables that change together: all of them, or none."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerforge.plans import batch
from ledgerforge.session import LAYERS, drop_namespaces, ensure_namespaces, table_name
from ledgerforge.sources import publication
from ledgerforge.sources.publication import Publication, delete_folder, namespace_location, published, recover
from ledgerforge.sources.tables import write_table
from tests.test_batch import FIRST, clean_tables, deliver


@pytest.fixture
def prefix(spark):
    name = f"t{uuid.uuid4().hex[:8]}_"
    ensure_namespaces(spark, prefix=name)
    yield name
    drop_namespaces(spark, name)


def numbers(spark, *values, **columns):
    return spark.createDataFrame([(v,) for v in values], "n int").withColumns({k: F.lit(v) for k, v in columns.items()})


def held(df):
    return sorted(r.n for r in df.collect())


def pair(prefix):
    return f"{prefix}silver", [f"{prefix}silver.x", f"{prefix}silver_rejects.x"]


def test_both_or_none(spark, prefix):
    home, names = pair(prefix)
    with Publication(spark, home) as run:
        for name in names:
            run.write(name, numbers(spark, 1))
        assert held(run.read(names[0])) == [1] and not spark.catalog.tableExists(names[0])
    assert [held(spark.table(name)) for name in names] == [[1], [1]]

    broken = numbers(spark, 2).withColumn("n", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        with Publication(spark, home) as run:
            run.write(names[0], numbers(spark, 2))
            run.write(names[1], broken)
    for read in (spark.table, lambda name: published(spark, home, name)):
        assert [held(read(name)) for name in names] == [[1], [1]]
    assert {t.name for layer in ("silver", "silver_rejects") for t in spark.catalog.listTables(prefix + layer)} == {"x"}
    folders = os.listdir(f"{namespace_location(spark, home).removeprefix('file:')}/{publication.VERSIONS}")
    assert len(folders) == 1  # what the failed run wrote is gone


@pytest.mark.parametrize("columns", [{}, {"extra": "a"}])
def test_a_commit_that_stops_halfway_is_whole_to_readers(spark, prefix, monkeypatch, columns):
    home, names = pair(prefix)
    with Publication(spark, home) as run:
        for name in names:
            run.write(name, numbers(spark, 1))
    run = Publication(spark, home)
    for name in names:
        run.write(name, numbers(spark, 2, **columns))
    switch, calls = publication._switch, []

    def stops(session, name, beside):
        calls.append(name)
        if len(calls) == 2:
            raise OSError("the driver is lost")
        return switch(session, name, beside)

    monkeypatch.setattr(publication, "_switch", stops)
    with pytest.raises(OSError):
        run.commit()
    monkeypatch.undo()
    assert [held(spark.table(name)) for name in names] == [[2], [1]]  # the catalog alone is half-way
    assert [held(published(spark, home, name)) for name in names] == [[2], [2]]
    assert recover(spark, home) == names[1:] and recover(spark, home) == []
    assert [held(spark.table(name)) for name in names] == [[2], [2]]


def test_a_second_publisher_waits_for_recovery(spark, prefix, monkeypatch):
    home, names = pair(prefix)
    monkeypatch.setattr(publication, "recover", lambda *_: [])
    for attempt in range(2):
        run = Publication(spark, home)
        run.write(names[0], numbers(spark, attempt))
        if attempt:
            with pytest.raises(RuntimeError, match="recover"):
                run.commit()
        else:
            run.commit()


def test_readers_of_the_version_before(spark, prefix):
    name = f"{prefix}gold.x"
    before = []
    for value in range(3):
        write_table(numbers(spark, value), name, mode="create_or_replace")
        before.append(spark.table(name))
    assert held(before[2]) == [2]
    folder = f"{namespace_location(spark, f'{prefix}gold')}/{publication.VERSIONS}".removeprefix("file:")
    assert len(os.listdir(folder)) == 2  # this version and the one before
    assert held(spark.table(name)) == [2]


def test_layouts_can_change(spark, prefix):
    name = f"{prefix}gold.x"
    rows = numbers(spark, 1, 2, 3).withColumn("even", F.col("n") % 2 == 0)
    write_table(rows, name, mode="create_or_replace")
    for partition_by in (["even"], ["even"], []):
        write_table(rows, name, mode="create_or_replace", partition_by=partition_by)
        assert held(spark.table(name)) == [1, 2, 3] and held(spark.table(name).filter("even")) == [2]
        assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == partition_by
    write_table(numbers(spark, 7), name, mode="append", merge_schema=True)
    assert held(spark.table(name)) == [1, 2, 3, 7]
    with Publication(spark, f"{prefix}gold") as run:
        run.write(name, rows, bucket=(4, "n"))
    assert held(spark.table(name).filter("n = 3")) == [3]
    assert publication._details(spark, name)["Num Buckets"] == "4"


def test_a_failing_run_keeps_the_run_before(spark, prefix, tmp_path, monkeypatch):
    deliver(clean_tables(spark), tmp_path)
    options = {"prefix": prefix, "replace_batch": True}
    report = batch.run_batch(spark, str(tmp_path), FIRST, **options)
    names = [table_name(layer, t.name, prefix=prefix) for layer in LAYERS[1:] for t in spark.catalog.listTables(prefix + layer)]
    stamp = spark.table(f"{prefix}silver.blocks").first().ingested_at

    monkeypatch.setattr(batch.gold, "gold_outputs", lambda *_: numbers(spark, 1).select(F.raise_error(F.lit("stopped"))))
    with pytest.raises(Exception, match="stopped"):
        batch.run_batch(spark, str(tmp_path), FIRST, **options)
    monkeypatch.undo()
    assert spark.table(f"{prefix}silver.blocks").first().ingested_at == stamp
    assert len(names) == 14 and report["outputs"]["accepted"] == spark.table(f"{prefix}gold.outputs").count()


def test_only_prefixed_layers_are_dropped(spark):
    with pytest.raises(ValueError):
        drop_namespaces(spark, "")


def test_deleting_a_folder_twice(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for _ in range(2):
        delete_folder(spark, str(tmp_path / "x"))
    assert not (tmp_path / "x").exists()
