"""Point lookups and short joins by transaction read few row groups."""

import uuid

import duckdb
import pytest

from ledgerforge.plans.batch import Warehouse
from ledgerforge.session import drop_namespaces, ensure_namespaces
from ledgerforge.sources.publication import bloom_filters


def rows_scanned(df):
    """Rows that the file scans gave out, after the query ran: those of the row groups that were read."""
    df.collect()
    total, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            left.append(node.plan())
        elif name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return total


ROWS, FILES = 40_000, 8


@pytest.fixture
def hashes(spark):
    """Hashes in no order, so that every file spans all of them."""
    return spark.range(ROWS).selectExpr("sha2(cast(id AS string), 256) AS tx_hash", "id").repartition(FILES, "id")


def test_a_lookup_reads_the_row_group_that_holds_the_key(spark, hashes, tmp_path):
    plain, filtered = str(tmp_path / "plain"), str(tmp_path / "filtered")
    # A dictionary would list all values of so small a row group; real ones hold too many for it.
    for path, options in ((plain, {}), (filtered, bloom_filters("tx_hash"))):
        hashes.write.option("parquet.enable.dictionary", "false").options(**options).parquet(path)
    for key in (17, 39_999):
        where = f"tx_hash = sha2('{key}', 256)"
        assert [row.id for row in spark.read.parquet(filtered).filter(where).collect()] == [key]
        assert rows_scanned(spark.read.parquet(plain).filter(where)) == ROWS
        assert rows_scanned(spark.read.parquet(filtered).filter(where)) <= ROWS * 2 / FILES
    absent = "tx_hash = sha2('none', 256)"
    assert rows_scanned(spark.read.parquet(filtered).filter(absent)) <= ROWS / FILES
    few = "tx_hash IN (sha2('1', 256), sha2('2', 256), sha2('none', 256))"
    assert rows_scanned(spark.read.parquet(filtered).filter(few)) <= ROWS * 3 / FILES
    assert spark.read.parquet(filtered).filter(few).count() == 2


def test_published_tables_carry_filters(spark, hashes):
    prefix = f"l{uuid.uuid4().hex[:8]}_"
    ensure_namespaces(spark, prefix=prefix)
    try:
        house = Warehouse(spark, prefix=prefix)
        house.replace("silver", "transactions", hashes.selectExpr("tx_hash", "id AS fee_sats"))
        house.replace("silver", "blocks", spark.range(10).selectExpr("id AS block_height"))
        house.commit()
        table = house.read("silver", "transactions")
        assert table.count() == ROWS
        folder = table.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0].replace("///", "/")
        found = duckdb.execute(
            "SELECT path_in_schema, bool_and(bloom_filter_offset IS NOT NULL), max(bloom_filter_length)"
            f" FROM parquet_metadata('{folder}/*.parquet') GROUP BY 1 ORDER BY 1"
        ).fetchall()
        assert [row[:2] for row in found] == [("fee_sats", False), ("tx_hash", True)]
        # The writer tries sizes from 1 MiB down by halves; the smallest, 64 KiB and a header, does for so few values.
        assert found[1][2] < 128 * 1024
        assert house.read("silver", "blocks").count() == 10
    finally:
        drop_namespaces(spark, prefix)
