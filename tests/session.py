"""The session that tests, comparison and bench share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(**settings: str) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="run-")
    options = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/checkpoints",
        **settings,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("ledgerforge")
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
