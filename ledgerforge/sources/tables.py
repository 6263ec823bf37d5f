"""Catalog table writer."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.sources.publication import ROW_GROUPS, Publication

MODES = ("append", "overwrite_partitions", "create_or_replace")
SESSION_CATALOG = "spark_catalog"


def write_table(
    df: DataFrame,
    name: str,
    *,
    mode: str = "append",
    merge_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Create the table if it does not exist, otherwise write it in the given mode.

    append               add rows, matched by column name
    overwrite_partitions replace only the partitions present in df (all, if unpartitioned)
    create_or_replace    replace data and schema

    merge_schema lets append and overwrite_partitions add the frame's new columns to the
    table. Tables of other catalogs (`catalog.layer.entity`) go through the v2 writer and get
    that format's atomic commit; the session catalog keeps Parquet tables, whose replacement is
    written beside the old files first, so that a failed write changes nothing.
    """
    if mode not in MODES:
        raise ValueError(f"Unsupported write mode: {mode}")
    if in_other_catalog(name):
        _write_v2(df, name, mode, merge_schema, partition_by)
    else:
        _write_session(df, name, mode, merge_schema, partition_by)


def in_other_catalog(name: str) -> bool:
    parts = name.split(".")
    return len(parts) > 2 and parts[0] != SESSION_CATALOG


def _write_v2(df, name, mode, merge_schema, partition_by) -> None:
    writer = df.writeTo(name)
    if merge_schema:
        writer = writer.option("mergeSchema", "true")
    exists = df.sparkSession.catalog.tableExists(name)
    if partition_by and (not exists or mode == "create_or_replace"):
        writer = writer.partitionedBy(*[F.col(column) for column in partition_by])
    if not exists:
        writer.create()
    elif mode == "append":
        writer.append()
    elif mode == "overwrite_partitions":
        writer.overwritePartitions()
    else:
        writer.createOrReplace()


def _write_session(df, name, mode, merge_schema, partition_by) -> None:
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and mode == "create_or_replace":
        qualified = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"
        with Publication(spark, qualified.rpartition(".")[0]) as publication:
            publication.write(qualified, df, partition_by)
        return
    if not exists:
        writer = df.write.format("parquet").options(**ROW_GROUPS).mode("error")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
        return
    if merge_schema:
        df = _merge_columns(df, name)
    aligned = df.select(*spark.table(name).columns)
    if len(aligned.columns) != len(df.columns):
        raise ValueError(f"Columns not in {name}: {sorted(set(df.columns) - set(aligned.columns))}")
    if mode == "append":
        aligned.write.insertInto(name)
    else:
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            aligned.write.insertInto(name, overwrite=True)


@contextmanager
def _setting(spark, key: str, value: str):
    """Insert commands take this mode from the session only, so set it for one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _merge_columns(df: DataFrame, name: str) -> DataFrame:
    """Add the frame's new columns to the table and pad the frame with the ones it lacks."""
    spark = df.sparkSession
    table = spark.table(name).schema
    known = {field.name for field in table}
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    absent = {f.name: F.lit(None).cast(f.dataType) for f in table if f.name not in df.columns}
    return df.withColumns(absent) if absent else df
