"""The operators on plain order tables, and stock DataFrame chains."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.operators.latest import keep_latest, top_per_group
from ledgerforge.operators.quality import (
    Rule,
    id_collisions,
    partition_by_reference,
    split,
    total_problems,
    validate,
)
from ledgerforge.plans.sample_ledger import SampleLedger
from ledgerforge.sources.delivery import csv_to_parquet
from ledgerforge.sources.staging import Staging
from ledgerforge.sources.tables import write_table

LINE_KEY = ["l_orderkey", "l_linenumber"]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


def latest_lines(spark, folder) -> DataFrame:
    columns = [*LINE_KEY, "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return keep_latest(read(spark, folder, "lineitem").select(*columns), LINE_KEY, ["l_shipdate"])


def _orders_with_lines(spark, folder) -> tuple[DataFrame, DataFrame]:
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return partition_by_reference(orders, lines, ["o_orderkey"], "LINES_MISSING")


def reference_valid(spark, folder) -> DataFrame:
    return _orders_with_lines(spark, folder)[0]


def reference_missing(spark, folder) -> DataFrame:
    return _orders_with_lines(spark, folder)[1]


def line_id_collisions(spark, folder) -> DataFrame:
    """Line ids that were delivered for more than one part and supplier."""
    lines = read(spark, folder, "lineitem").withColumn("line_id", F.concat_ws("-", *LINE_KEY))
    return id_collisions(lines, "line_id", ["l_partkey", "l_suppkey"], "LINE_ID_COLLISION")


def total_reconciliation(spark, folder) -> DataFrame:
    """Orders whose delivered lines, second deliveries included, miss the declared totals."""
    ledger = SampleLedger.shared(spark, folder)
    return total_problems(
        ledger.delivered_lines,
        ledger.balances,
        key="k",
        value="value_sats",
        declared_total="o",
        declared_count="no",
        total_code="TOTAL_MISMATCH",
        count_code="COUNT_MISMATCH",
        missing_code="ORDER_NOT_FOUND",
    )


PART_RULES = (
    Rule("PRICE_LOW", "p_retailprice < 950"),
    Rule("SIZE_LARGE", "p_size > 25"),
    Rule("TYPE_ECONOMY", "p_type = 'ECONOMY'"),
)


def part_quarantine(spark, folder) -> DataFrame:
    """Both sides of a quarantine split, told apart by their errors."""
    checked = validate(read(spark, folder, "part").select("p_partkey", "p_type", "p_size", "p_retailprice"), PART_RULES)
    valid, rejected = split(checked)
    return valid.withColumn("outcome", F.lit("valid")).unionByName(
        rejected.withColumn("outcome", F.lit("rejected"))
    )


def window_total(spark, folder) -> DataFrame:
    """Every order with its customer's total: an aggregate looked up, not a window, so that a
    customer with very many orders is summed per task first."""
    orders = read(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", cents("o_totalprice").alias("price_cents")
    )
    totals = orders.groupBy("o_custkey").agg(F.sum("price_cents").alias("customer_total_cents"))
    return orders.join(totals, "o_custkey", "left")


def top_orders_per_customer(spark, folder) -> DataFrame:
    orders = read(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", cents("o_totalprice").alias("price_cents")
    )
    order = [F.col("price_cents").desc(), F.col("o_orderkey")]
    return top_per_group(orders, ["o_custkey"], order, 3, "customer_rank")


def top_orders(spark, folder) -> DataFrame:
    return (
        read(spark, folder, "orders")
        .select("o_orderkey", cents("o_totalprice").alias("price_cents"))
        .orderBy(F.col("price_cents").desc(), "o_orderkey")
        .limit(20)
    )


def union_by_name(spark, folder) -> DataFrame:
    customers = read(spark, folder, "customer").select(
        F.lit("customer").alias("party"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name")
    )
    suppliers = read(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.lit("supplier").alias("party"), F.col("s_nationkey").alias("nation")
    )
    return customers.unionByName(suppliers)


def union_by_position(spark, folder) -> DataFrame:
    """Columns of the second side follow the order of the first, whatever their names."""
    regions = read(spark, folder, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    return regions.union(read(spark, folder, "nation").select("n_nationkey", "n_name"))


def distinct_pairs(spark, folder) -> DataFrame:
    return read(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()


def filter_to_sort_chain(spark, folder) -> DataFrame:
    """Filter, project, aggregate, filter groups, join, sort."""
    nations = read(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        read(spark, folder, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select("c_nationkey", F.upper("c_mktsegment").alias("segment"), cents("c_acctbal").alias("balance_cents"))
        .groupBy("c_nationkey", "segment")
        .agg(F.sum("balance_cents").alias("balance_cents"), F.count("*").alias("customer_count"))
        .filter("customer_count >= 2")
        .join(nations, "c_nationkey", "left")
        .select("n_name", "segment", "balance_cents", "customer_count")
        .orderBy(F.col("balance_cents").desc(), "n_name", "segment")
    )


def inferred_csv_copy(spark, folder) -> DataFrame:
    """Orders written as CSV, copied with inferred types to Parquet, read back."""
    stage = Staging(spark, "inferred")
    source, target = f"{stage.folder}/orders-csv", f"{stage.folder}/orders-parquet"
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    read(spark, folder, "orders").select(*columns).write.option("header", True).csv(source)
    csv_to_parquet(spark, source, target)
    copied = spark.read.parquet(target)
    return copied.select(*[F.col(c).cast("long") if c.endswith("key") else F.col(c) for c in columns])


def table_write_modes(spark, folder) -> DataFrame:
    """Create, append, overwrite one partition, merge a new column; returns the final table."""
    stage = Staging(spark, "modes")
    database = f"modes_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{stage.folder}/{database}'")
    name = f"{database}.orders"
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    by_status = {"partition_by": ["o_orderstatus"]}
    write_table(orders.filter("o_orderstatus = 'X'"), name, mode="append", **by_status)
    write_table(orders, name, mode="create_or_replace", **by_status)
    write_table(orders.filter("o_orderstatus = 'F'"), name, mode="append")
    write_table(
        orders.filter("o_orderstatus = 'P'").withColumn("o_custkey", F.col("o_custkey") + 1),
        name,
        mode="overwrite_partitions",
    )
    marked = orders.filter("o_orderstatus = 'O'").withColumn("note", F.lit("again"))
    write_table(marked, name, mode="append", merge_schema=True)
    return spark.table(name).select("o_orderkey", "o_custkey", "o_orderstatus", "note")
