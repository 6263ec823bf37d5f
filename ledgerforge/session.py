"""Session settings and layer namespaces."""

from __future__ import annotations

import os
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

LAYERS = ("bronze", "silver", "silver_rejects", "gold")

# Environment variable -> Spark setting it overrides.
SETTING_BY_VARIABLE = {
    "SPARK_MASTER_URL": "spark.master",
    "SPARK_CORES_MAX": "spark.cores.max",
    "SPARK_EXECUTOR_CORES": "spark.executor.cores",
    "SPARK_EXECUTOR_MEMORY": "spark.executor.memory",
    "SPARK_DRIVER_MEMORY": "spark.driver.memory",
}
# The same for the settings of a catalog.
CATALOG_VARIABLES = {
    "ICEBERG_CATALOG_TYPE": "type",
    "ICEBERG_CATALOG_URI": "uri",
    "ICEBERG_WAREHOUSE": "warehouse",
}
ICEBERG_CATALOG_CLASS = "org.apache.iceberg.spark.SparkCatalog"

BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def settings_from_environment(environ: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Spark settings for the variables that are set; anything unset is left to spark-submit."""
    settings = dict(BASE_SETTINGS)
    for variable, setting in SETTING_BY_VARIABLE.items():
        if environ.get(variable):
            settings[setting] = environ[variable]
    catalog = environ.get("ICEBERG_CATALOG")
    if catalog:
        prefix = f"spark.sql.catalog.{catalog}"
        settings[prefix] = ICEBERG_CATALOG_CLASS
        for variable, suffix in CATALOG_VARIABLES.items():
            if environ.get(variable):
                settings[f"{prefix}.{suffix}"] = environ[variable]
    return settings


def ledger_session(
    app_name: str, extra: Mapping[str, str] | None = None, environ: Mapping[str, str] = os.environ
) -> SparkSession:
    """Build (or join) the session, set its log level and create the layer namespaces."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**settings_from_environment(environ), **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(environ.get("SPARK_LOG_LEVEL", "WARN"))
    ensure_namespaces(spark, environ.get("ICEBERG_CATALOG"))
    return spark


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INPUT_BYTES_PER_PARTITION = 64 << 20


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]):
    """Set session settings for a while and put back what was there."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffle_settings(
    spark: SparkSession, input_bytes: int, per_partition: int = INPUT_BYTES_PER_PARTITION
) -> dict[str, str]:
    """Enough initial shuffle partitions for the input; adaptive execution merges spare ones.

    A value the caller set, or a larger spark.sql.shuffle.partitions, is left alone.
    """
    wanted = -(-input_bytes // per_partition)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get(INITIAL_PARTITIONS, None) is not None or wanted <= usual:
        return {}
    return {INITIAL_PARTITIONS: str(wanted)}


TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 4 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20,
}


def task_settings(spark: SparkSession) -> dict[str, str]:
    """Few enough bytes of a file or shuffle per task that what it sorts or groups fits in its memory.

    Columnar files hold many rows in few bytes; a smaller size that the caller set is left alone.
    """
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return {key: str(most) for key, most in TASK_BYTES.items() if in_bytes(spark.conf.get(key)) > most}


def namespace(layer: str, catalog: str | None = None, prefix: str = "") -> str:
    """`catalog.layer`, or `layer` in the session catalog; a prefix gives a run layers of its own."""
    if layer not in LAYERS:
        raise ValueError(f"Unknown layer: {layer}")
    return ".".join(part for part in (catalog, prefix + layer) if part)


def table_name(layer: str, entity: str, catalog: str | None = None, prefix: str = "") -> str:
    return f"{namespace(layer, catalog, prefix)}.{entity}"


def ensure_namespaces(spark: SparkSession, catalog: str | None = None, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace(layer, catalog, prefix)}")


def drop_namespaces(spark: SparkSession, prefix: str, catalog: str | None = None) -> None:
    """Drop the layers that a prefix named, with their tables; the layers without a prefix stay."""
    if not prefix:
        raise ValueError("Only layers with a prefix can be dropped.")
    for layer in LAYERS:
        spark.sql(f"DROP NAMESPACE IF EXISTS {namespace(layer, catalog, prefix)} CASCADE")
