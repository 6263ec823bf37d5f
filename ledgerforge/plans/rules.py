"""Validation rules of the four entities.

Fixed values: the codes, their order and the failure conditions are the data contract.
"""

from __future__ import annotations

from ledgerforge.operators.quality import Rule, below, missing, null, null_or_below

BLOCK_RULES = (
    Rule("BLOCK_HASH_MISSING", missing("block_hash")),
    Rule("BLOCK_HEIGHT_INVALID", null_or_below("block_height", 0)),
    Rule("NONCE_INVALID", null_or_below("nonce", 0)),
    Rule("SIZE_INVALID", null_or_below("size_bytes", 0)),
    Rule("TRANSACTION_COUNT_INVALID", null_or_below("transaction_count", 0)),
    Rule("DIFFICULTY_INVALID", "difficulty IS NULL OR difficulty <= 0"),
    Rule("TIMESTAMP_MISSING", null("timestamp")),
)

TRANSACTION_RULES = (
    Rule("TX_HASH_MISSING", missing("tx_hash")),
    Rule("BLOCK_HASH_MISSING", missing("block_hash")),
    Rule("TIMESTAMP_MISSING", null("timestamp")),
    Rule("FEE_INVALID", null_or_below("fee_sats", 0)),
    Rule("SIZE_INVALID", null_or_below("size_bytes", 0)),
    Rule("INPUT_COUNT_INVALID", null_or_below("input_count", 1)),
    Rule("OUTPUT_COUNT_INVALID", null_or_below("output_count", 1)),
    Rule("TOTAL_INPUT_INVALID", null_or_below("total_input_sats", 0)),
    Rule("TOTAL_OUTPUT_INVALID", null_or_below("total_output_sats", 0)),
)

# Checked on rows that pass the rules above; a sum beyond the long range cannot match.
ACCOUNTING_RULES = (
    Rule(
        "ACCOUNTING_MISMATCH",
        "coalesce(total_input_sats <> try_add(total_output_sats, fee_sats), true)",
    ),
)

INPUT_RULES = (
    Rule("INPUT_ID_MISSING", missing("input_id")),
    Rule("TX_HASH_MISSING", missing("tx_hash")),
    Rule("INPUT_INDEX_MISSING", null("input_index")),
    Rule("INPUT_INDEX_INVALID", below("input_index", 0)),
    Rule("OUTPUT_INDEX_INVALID", null_or_below("previous_output_index", 0)),
    Rule("VALUE_SATS_INVALID", null_or_below("value_sats", 1)),
)

OUTPUT_RULES = (
    Rule("OUTPUT_ID_MISSING", missing("output_id")),
    Rule("TX_HASH_MISSING", missing("tx_hash")),
    Rule("OUTPUT_INDEX_MISSING", null("output_index")),
    Rule("OUTPUT_INDEX_INVALID", below("output_index", 0)),
    Rule("VALUE_SATS_INVALID", null_or_below("value_sats", 1)),
)
