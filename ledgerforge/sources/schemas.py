"""Delivered columns of the four entities, in file order, and their key columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITIES = ("blocks", "transactions", "inputs", "outputs")

TEXT, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
STAMP, REAL, FLAG = T.TimestampType(), T.DoubleType(), T.BooleanType()

# The delivery contract. Amounts are long; previous_output_index lands as text.
FIELDS = {
    "blocks": {
        "block_hash": TEXT,
        "block_height": INT,
        "previous_block_hash": TEXT,
        "timestamp": STAMP,
        "miner": TEXT,
        "difficulty": REAL,
        "nonce": LONG,
        "size_bytes": INT,
        "transaction_count": INT,
    },
    "transactions": {
        "tx_hash": TEXT,
        "block_hash": TEXT,
        "timestamp": STAMP,
        "fee_sats": LONG,
        "size_bytes": INT,
        "input_count": INT,
        "output_count": INT,
        "total_input_sats": LONG,
        "total_output_sats": LONG,
    },
    "inputs": {
        "input_id": TEXT,
        "tx_hash": TEXT,
        "input_index": INT,
        "previous_tx_hash": TEXT,
        "previous_output_index": TEXT,
        "address": TEXT,
        "value_sats": LONG,
    },
    "outputs": {
        "output_id": TEXT,
        "tx_hash": TEXT,
        "output_index": INT,
        "address": TEXT,
        "value_sats": LONG,
        "spent": FLAG,
    },
}

SCHEMAS = {
    entity: T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
    for entity, fields in FIELDS.items()
}

KEYS = {
    "blocks": ["block_hash"],
    "transactions": ["tx_hash"],
    "inputs": ["tx_hash", "input_index"],
    "outputs": ["tx_hash", "output_index"],
}

LINEAGE = ("ingested_at", "source_file", "batch_id")


def conform(df: DataFrame, entity: str) -> DataFrame:
    """Parse text columns into the delivery types; text that does not parse becomes NULL."""
    return df.withColumns(
        {f.name: F.col(f.name).try_cast(f.dataType) for f in SCHEMAS[entity] if f.name in df.columns}
    )
