"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from oracle.ledger_sql import (
    enriched_table,
    gold_outputs_table,
    resolution_table,
    silver_tables,
    table,
    with_tables,
)

STAMPS = {
    "timestamp", "ingested_at", "spending_timestamp", "referenced_transaction_timestamp",
    "first_spent_timestamp", "created_timestamp",
}
DATES = {
    "block_date", "transaction_date", "spend_date", "output_date", "first_spend_date",
}

BLOCKS = (
    "block_hash block_height previous_block_hash timestamp miner difficulty nonce size_bytes"
    " transaction_count ingested_at source_file batch_id"
).split()
TRANSACTIONS = (
    "tx_hash block_hash timestamp fee_sats size_bytes input_count output_count total_input_sats"
    " total_output_sats ingested_at source_file batch_id"
).split()
INPUTS = (
    "input_id tx_hash input_index previous_tx_hash previous_output_index address value_sats"
    " ingested_at source_file batch_id"
).split()
OUTPUTS = (
    "output_id tx_hash output_index address value_sats spent ingested_at source_file batch_id"
).split()
RAW = {"blocks": BLOCKS, "transactions": TRANSACTIONS, "inputs": INPUTS, "outputs": OUTPUTS}

SILVER_BLOCKS = [*BLOCKS, "block_date", "block_year", "block_month", "block_hour"]
REFERENCE = (
    "referenced_tx_hash referenced_output_index referenced_output_id referenced_address"
    " referenced_value_sats resolution_status address_matches value_matches double_spend_detected"
).split()
RECONCILIATION = [*INPUTS, "matching_output_count", *REFERENCE]
ENRICHED = [c for c in OUTPUTS if c != "spent"] + (
    "source_spent observed_spent canonical_spent spend_discrepancy"
).split()
GOLD_BLOCKS = SILVER_BLOCKS + (
    "observed_transaction_count total_fee_sats total_transaction_size_bytes total_input_sats"
    " total_output_sats transaction_count_matches"
).split()
GOLD_TRANSACTIONS = TRANSACTIONS + (
    "observed_input_count observed_total_input_sats observed_output_count"
    " observed_total_output_sats fee_rate_sats_per_byte input_count_matches output_count_matches"
    " input_value_matches output_value_matches transaction_date"
).split()
GOLD_INPUTS = INPUTS + REFERENCE + (
    "spending_block_hash spending_timestamp referenced_transaction_timestamp is_genesis_input"
    " spend_date coin_age_days"
).split()
GOLD_OUTPUTS = ENRICHED + (
    "observed_spend_count first_spent_timestamp creating_block_hash created_timestamp output_date"
    " first_spend_date has_multiple_spend_attempts time_to_spend_days"
).split()


def _text(column: str) -> str:
    if column in STAMPS:
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"
    if column in DATES:
        return f"CAST({column} AS VARCHAR) AS {column}"
    return column


def export(name: str, columns: list[str], where: str = "") -> str:
    return f"{with_tables(name)}SELECT {', '.join(map(_text, columns))} FROM {name} {where}"


def rejects(entity: str) -> str:
    name = f"reject_{entity}"
    columns = [*map(_text, RAW[entity]), "array_to_string(errors, ',') AS validation_errors"]
    return f"{with_tables(name)}SELECT {', '.join(columns)} FROM {name}"


def landed(entity: str) -> str:
    columns = [c for c in RAW[entity] if c not in ("ingested_at", "source_file", "batch_id")]
    listed = ", ".join(map(_text, columns))
    return f"""{with_tables(f"bronze_{entity}")}
SELECT {listed}, '{entity}.csv' AS source_file, '1995-01-01' AS batch_id FROM bronze_{entity}"""


def conservation(prefix: str = "") -> str:
    """Every Bronze row is accepted, rejected, or an older delivery of a key that was judged."""
    late = "'BLOCK_NOT_FOUND', 'TRANSACTION_NOT_FOUND'" + "".join(
        f", '{side}_{what}_MISMATCH'" for side in ("INPUT", "OUTPUT") for what in ("VALUE_TOTAL", "COUNT")
    )
    parts = [
        f"""SELECT '{e}' AS entity, (SELECT count(*) FROM {prefix}bronze_{e}) AS bronze,
  (SELECT count(*) FROM {prefix}bronze_{e})
    - (SELECT count(*) FROM {prefix}reject_{e} WHERE NOT list_has_any(errors, [{late}])) AS candidates,
  (SELECT count(*) FROM {prefix}silver_{e}) AS accepted, (SELECT count(*) FROM {prefix}reject_{e}) AS rejected"""
        for e in RAW
    ]
    names = [f"{prefix}{layer}_{e}" for e in RAW for layer in ("bronze", "silver", "reject")]
    return f"""{with_tables(*names)}
SELECT *, bronze - accepted - rejected AS duplicates FROM ({' UNION ALL '.join(parts)})"""


def over(select: str, *names: str) -> str:
    return with_tables(*names) + select.strip()


def reasons(prefix: str = "") -> str:
    parts = [
        f"SELECT '{e}' AS entity, batch_id, unnest(errors) AS reason FROM {prefix}reject_{e}" for e in RAW
    ]
    select = f"""
SELECT entity, batch_id, reason, count(*) AS row_count FROM ({' UNION ALL '.join(parts)})
GROUP BY ALL"""
    return over(select, *[f"{prefix}reject_{e}" for e in RAW])


# ---------------------------------------------------------------- corruption

KEY = {
    "blocks": ["block_hash"],
    "transactions": ["tx_hash"],
    "inputs": ["tx_hash", "input_index"],
    "outputs": ["tx_hash", "output_index"],
}
TYPES = {
    "block_height": "INTEGER", "timestamp": "TIMESTAMP", "difficulty": "DOUBLE", "nonce": "BIGINT",
    "size_bytes": "INTEGER", "transaction_count": "INTEGER", "fee_sats": "BIGINT", "input_count": "INTEGER",
    "output_count": "INTEGER", "total_input_sats": "BIGINT", "total_output_sats": "BIGINT",
    "input_index": "INTEGER", "value_sats": "BIGINT", "output_index": "INTEGER", "spent": "BOOLEAN",
}
RATE, SEED = 0.02, 7


def mutate(name: str, source: str, entity: str, step: str, cases: list[tuple[str, str]]) -> None:
    """Row n of `cases` replaces one column in the selected rows of variant n."""
    content = ", ".join(f"coalesce({c}, '~')" for c in RAW[entity] if c not in ("ingested_at", "source_file", "batch_id"))
    replaced = ", ".join(
        f"CASE WHEN place <= least(n, greatest(1, round_even(n * {RATE}, 0))) AND"
        f" CAST('0x' || substr(mark, 9, 8) AS BIGINT) % {len(cases)} = {number}"
        f" THEN {value} ELSE {column} END AS {column}"
        for number, (column, value) in enumerate(cases)
    )
    table(name, source)(f"""
SELECT * EXCLUDE (mark, place, n) REPLACE ({replaced})
FROM (SELECT *, row_number() OVER (ORDER BY mark) AS place, count(*) OVER () AS n
      FROM (SELECT *, md5(concat_ws(':', {content}, '{step}', '{SEED}')) AS mark FROM {source}))""")


def duplicate(name: str, source: str, entity: str) -> None:
    key = ", ".join(KEY[entity])
    present = " AND ".join(f"trim({column}) <> ''" for column in KEY[entity])
    table(name, source)(f"""
SELECT * FROM {source} UNION ALL
SELECT * FROM {source} WHERE ({key}) = (SELECT ({key}) FROM {source} WHERE {present} ORDER BY {key} LIMIT 1)""")


def unknown(column: str) -> str:
    return f"sha256(concat_ws(':', 'unknown', {column}))"


def plus_one(column: str) -> str:
    return f"coalesce(CAST(TRY_CAST({column} AS BIGINT) + 1 AS VARCHAR), {column})"


QUALITY_CASES = {
    "blocks": [("miner", "'  ' || lower(miner) || '  '")],
    "transactions": [
        ("tx_hash", "''"), ("block_hash", "'   '"), ("timestamp", "'not-a-timestamp'"), ("fee_sats", "'not-a-number'"),
    ],
    "inputs": [("input_id", "''"), ("address", "'   '"), ("value_sats", "'not-a-number'")],
    "outputs": [("output_id", "''"), ("value_sats", "'not-a-number'"), ("spent", "'not-a-boolean'")],
}
RELATION_CASES = {
    "transactions": [
        ("block_hash", unknown("tx_hash")), ("input_count", plus_one("input_count")),
        ("total_output_sats", plus_one("total_output_sats")),
    ],
    "inputs": [
        ("tx_hash", unknown("input_id")), ("previous_tx_hash", unknown("input_id")),
        ("address", "'bc1corruptedaddress'"),
    ],
    "outputs": [("tx_hash", unknown("output_id"))],
}


def corruption_tables(prefix: str, quality: bool, relations: bool) -> None:
    for entity, columns in RAW.items():
        delivered = [c for c in columns if c not in ("ingested_at", "source_file", "batch_id")]
        as_text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in delivered)
        source = f"{prefix}text_{entity}"
        table(source, f"bronze_{entity}")(f"SELECT {as_text} FROM bronze_{entity}")
        if quality:
            mutate(f"{prefix}q_{entity}", source, entity, "data_quality", QUALITY_CASES[entity])
            duplicate(f"{prefix}d_{entity}", f"{prefix}q_{entity}", entity)
            source = f"{prefix}d_{entity}"
        if relations and entity in RELATION_CASES:
            mutate(f"{prefix}r_{entity}", source, entity, "relationships", RELATION_CASES[entity])
            source = f"{prefix}r_{entity}"
        if relations and entity == "outputs":
            table(f"{prefix}u_outputs", source, f"{prefix}r_inputs")(f"""
SELECT * REPLACE (CASE WHEN (tx_hash, output_index) = (
    SELECT (o.tx_hash, o.output_index) FROM {source} o
    WHERE EXISTS (SELECT 1 FROM {prefix}r_inputs i WHERE i.previous_tx_hash <> 'genesis'
                  AND i.previous_tx_hash = o.tx_hash AND i.previous_output_index = o.output_index)
    ORDER BY o.tx_hash, o.output_index LIMIT 1) THEN 'False' ELSE spent END AS spent)
FROM {source}""")
            source = f"{prefix}u_outputs"
        parsed = ", ".join(
            f"TRY_CAST({c} AS {TYPES[c]}) AS {c}" if c in TYPES else c for c in delivered
        )
        table(f"{prefix}bronze_{entity}", source)(f"""
SELECT {parsed}, TIMESTAMP '2026-01-01 00:00:00' AS ingested_at, '{entity}.csv' AS source_file,
       '2026-01-01' AS batch_id FROM {source}""")
    silver_tables(prefix)


corruption_tables("dq_", quality=True, relations=False)
corruption_tables("rel_", quality=False, relations=True)
corruption_tables("mix_", quality=True, relations=True)
resolution_table("mix_reconciliation", "mix_silver_inputs", "mix_silver_outputs")
table("mix_enriched", "mix_silver_outputs", "mix_reconciliation")("""
SELECT o.*, spent IS DISTINCT FROM EXISTS (SELECT 1 FROM mix_reconciliation r WHERE r.resolution_status = 'resolved'
    AND r.previous_tx_hash = o.tx_hash AND r.previous_output_index = o.output_index) AS spend_discrepancy
FROM mix_silver_outputs o
""")

RUN_AT = "TIMESTAMP '2026-01-02 03:04:05'"


def delivered_tables(prefix: str, run_at: str = RUN_AT, batch_id: str = "'1995-01-01'") -> None:
    """The Bronze rows as delivered by a run, through all layers."""
    for entity, columns in RAW.items():
        delivered = ", ".join(c for c in columns if c not in ("ingested_at", "source_file", "batch_id"))
        table(f"{prefix}bronze_{entity}", f"bronze_{entity}")(f"""
SELECT {delivered}, {run_at} AS ingested_at, '{entity}.csv' AS source_file, {batch_id} AS batch_id FROM bronze_{entity}""")
    silver_tables(prefix)
    resolution_table(f"{prefix}reconciliation", f"{prefix}silver_inputs", f"{prefix}silver_outputs")
    enriched_table(prefix)
    gold_outputs_table(prefix)


delivered_tables("batch_")
EARLY = "CASE WHEN batch_id < '1995-01-01' THEN {} ELSE {} END".format
delivered_tables(
    "step_",
    EARLY("TIMESTAMP '2026-01-01 06:00:00'", "TIMESTAMP '2026-01-02 06:00:00'"),
    EARLY("'2026-01-01'", "'2026-01-02'"),
)


def stamped_rejects(prefix: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, unnest(errors) AS reason, batch_id, ingested_at FROM {prefix}reject_{e}" for e in RAW
    )
    return f"""{with_tables(*(f"{prefix}reject_{e}" for e in RAW))}
SELECT entity, reason, batch_id, ingested_at, {RUN_AT} AS rejected_at, count(*) AS row_count FROM ({parts}) GROUP BY ALL"""


# ---------------------------------------------------------------- queries

NATIVE_TREND = """
SELECT transaction_date, count(*) AS transaction_count, CAST(sum(fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats,
       round(avg(fee_rate_sats_per_byte), 6) AS average_fee_rate_sats_per_byte
FROM gold_transactions"""
CENTS = "CAST(round({0} * 100) AS BIGINT)"

ORACLE_SQL: dict[str, str] = {
    **{f"bronze_{e}": landed(e) for e in RAW},
    "bronze_roundtrip": over(
        """
SELECT output_id, tx_hash, output_index, address, value_sats, spent, '1995-01-01' AS batch_id FROM bronze_outputs""",
        "bronze_outputs",
    ),
    "inferred_csv_copy": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
    "table_write_modes": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS VARCHAR) AS note FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, NULL FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey + 1, o_orderstatus, NULL FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 'again' FROM orders WHERE o_orderstatus = 'O'""",
    "latest_by_key": """
SELECT * EXCLUDE (rn) REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "reference_valid": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "reference_missing": """
SELECT o_orderkey, o_custkey, o_orderstatus, 'LINES_MISSING' AS validation_errors FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "id_collisions": """
SELECT l_orderkey || '-' || l_linenumber AS line_id, 'LINE_ID_COLLISION' AS validation_errors
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "total_reconciliation": over(
        """
SELECT d.k, array_to_string(list_filter([
    CASE WHEN d.total <> b.o THEN 'TOTAL_MISMATCH' END, CASE WHEN d.n <> b.no THEN 'COUNT_MISMATCH' END],
    lambda x: x IS NOT NULL), ',') AS validation_errors
FROM (SELECT k, sum(value_sats) AS total, count(*) AS n FROM dlines GROUP BY k) d JOIN bal b ON b.k = d.k
WHERE d.total <> b.o OR d.n <> b.no""",
        "dlines",
        "bal",
    ),
    "row_quarantine": """
SELECT *, CASE WHEN validation_errors = '' THEN 'valid' ELSE 'rejected' END AS outcome FROM (
  SELECT p_partkey, p_type, p_size, p_retailprice, array_to_string(list_filter([
    CASE WHEN p_retailprice < 950 THEN 'PRICE_LOW' END, CASE WHEN p_size > 25 THEN 'SIZE_LARGE' END,
    CASE WHEN p_type = 'ECONOMY' THEN 'TYPE_ECONOMY' END], lambda x: x IS NOT NULL), ',') AS validation_errors
  FROM part)""",
    "window_total": f"""
SELECT o_orderkey, o_custkey, {CENTS.format('o_totalprice')} AS price_cents,
       CAST(sum({CENTS.format('o_totalprice')}) OVER (PARTITION BY o_custkey) AS BIGINT) AS customer_total_cents
FROM orders""",
    "top_per_group": f"""
SELECT o_custkey, o_orderkey, price_cents, CAST(rn AS INTEGER) AS customer_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY price_cents DESC, o_orderkey) AS rn
  FROM (SELECT o_custkey, o_orderkey, {CENTS.format('o_totalprice')} AS price_cents FROM orders)) WHERE rn <= 3""",
    "top_n": f"""
SELECT o_orderkey, {CENTS.format('o_totalprice')} AS price_cents FROM orders
ORDER BY price_cents DESC, o_orderkey LIMIT 20""",
    "union_by_name": """
SELECT 'customer' AS party, c_nationkey AS nation, c_name AS name FROM customer
UNION ALL SELECT 'supplier', s_nationkey, s_name FROM supplier""",
    "union_by_position": """
SELECT r_regionkey AS key, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation""",
    "distinct": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "chain": f"""
SELECT n_name, segment, balance_cents, customer_count FROM (
  SELECT c_nationkey, upper(c_mktsegment) AS segment, CAST(sum({CENTS.format('c_acctbal')}) AS BIGINT) AS balance_cents,
         count(*) AS customer_count
  FROM customer WHERE c_acctbal > 0 GROUP BY 1, 2 HAVING count(*) >= 2)
LEFT JOIN nation ON n_nationkey = c_nationkey ORDER BY balance_cents DESC, n_name, segment""",
    "silver_blocks": export("silver_blocks", SILVER_BLOCKS),
    "silver_transactions": export("silver_transactions", TRANSACTIONS),
    "silver_inputs": export("silver_inputs", INPUTS),
    "silver_outputs": export("silver_outputs", OUTPUTS),
    **{f"reject_{e}": rejects(e) for e in RAW},
    "silver_conservation": conservation(),
    "batch_counts": conservation("batch_"),
    "incremental_counts": conservation("step_"),
    "incremental_silver_outputs": f"{with_tables('step_silver_outputs')}SELECT {', '.join(OUTPUTS)} FROM step_silver_outputs",
    "changed_silver_blocks": f"{with_tables('silver_blocks')}SELECT {', '.join(SILVER_BLOCKS)} FROM silver_blocks",
    "changed_silver_transactions": f"{with_tables('silver_transactions')}SELECT {', '.join(TRANSACTIONS)} FROM silver_transactions",
    "changed_waiting_transactions": f"""{with_tables('reject_transactions')}
SELECT {', '.join(TRANSACTIONS)} FROM reject_transactions WHERE list_contains(errors, 'BLOCK_NOT_FOUND')""",
    "batch_rejects": stamped_rejects("batch_"),
    "batch_gold_outputs": f"{with_tables('batch_gold_outputs')}SELECT {', '.join(GOLD_OUTPUTS)} FROM batch_gold_outputs",
    "silver_blocks_native": over(f"SELECT {', '.join(SILVER_BLOCKS)} FROM silver_blocks", "silver_blocks"),
    "reject_inputs_native": over(
        f"SELECT {', '.join(INPUTS)}, errors AS validation_errors FROM reject_inputs", "reject_inputs"
    ),
    "utxo_reconciliation": export("raw_reconciliation", RECONCILIATION),
    "utxo_reconciliation_dedup": export("reconciliation", RECONCILIATION),
    "double_spends": export(
        "reconciliation",
        ["tx_hash", "input_index", "previous_tx_hash", "previous_output_index", "value_sats"],
        "WHERE double_spend_detected",
    ),
    "outputs_enriched": export("outputs_enriched", ENRICHED),
    "chain_links": over(
        f"""
SELECT {', '.join(_text(c) for c in SILVER_BLOCKS)},
  CASE WHEN block_height = (SELECT min(block_height) FROM silver_blocks) THEN 'first'
       WHEN EXISTS (SELECT 1 FROM silver_blocks p WHERE p.block_height = b.block_height - 1
                    AND p.block_hash = b.previous_block_hash) THEN 'linked'
       WHEN EXISTS (SELECT 1 FROM silver_blocks p WHERE p.block_height = b.block_height - 1) THEN 'broken'
       ELSE 'gap' END AS link_status
FROM silver_blocks b""",
        "silver_blocks",
    ),
    "gold_blocks": export("gold_blocks", GOLD_BLOCKS),
    "gold_transactions": export("gold_transactions", GOLD_TRANSACTIONS),
    "gold_inputs": export("gold_inputs", GOLD_INPUTS),
    "gold_inputs_from_tables": export("gold_inputs", GOLD_INPUTS),
    "gold_outputs": export("gold_outputs", GOLD_OUTPUTS),
    "q_kpis": over(
        """
SELECT count(*) AS transaction_count, CAST(sum(fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats,
       round(avg(fee_rate_sats_per_byte), 6) AS average_fee_rate_sats_per_byte,
       (SELECT count(*) FROM gold_blocks) AS block_count FROM gold_transactions""",
        "gold_transactions",
        "gold_blocks",
    ),
    "q_fee_rate_histogram": over(
        """
SELECT bin, round(lo + bin * ((hi - lo) / 20), 6) AS bin_start, count(*) AS count FROM (
  SELECT lo, hi, CAST(least(floor((v - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin
  FROM (SELECT fee_rate_sats_per_byte AS v FROM gold_transactions WHERE fee_rate_sats_per_byte IS NOT NULL),
       (SELECT min(fee_rate_sats_per_byte) AS lo, max(fee_rate_sats_per_byte) AS hi FROM gold_transactions))
GROUP BY bin, lo, hi""",
        "gold_transactions",
    ),
    "q_fee_vs_size": over(
        """
SELECT tx_hash, CAST(sum(size_bytes) AS DECIMAL(38, 0)) AS sum_size_bytes, CAST(sum(fee_sats) AS DECIMAL(38, 0)) AS sum_fee_sats,
       count(*) AS count
FROM gold_transactions GROUP BY tx_hash""",
        "gold_transactions",
    ),
    "q_tx_shape": over(
        """
SELECT CASE WHEN input_count = 1 AND output_count = 1 THEN '1 input / 1 output'
            WHEN input_count = 1 THEN '1 input / many outputs'
            WHEN output_count = 1 THEN 'many inputs / 1 output'
            ELSE 'many inputs / many outputs' END AS transaction_shape, count(*) AS transaction_count
FROM gold_transactions GROUP BY 1""",
        "gold_transactions",
    ),
    "q_top_fee": over(
        """
SELECT substr(tx_hash, 1, 12) AS short_tx_hash, fee_sats, size_bytes, fee_rate_sats_per_byte, input_count, output_count
FROM gold_transactions ORDER BY fee_sats DESC, tx_hash LIMIT 20""",
        "gold_transactions",
    ),
    "q_metrics_transactions": over(
        """
SELECT count(*) AS transaction_count, CAST(sum(fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats,
       round(avg(fee_sats), 6) AS average_fee_sats,
       round(avg(fee_rate_sats_per_byte), 6) AS average_fee_rate_sats_per_byte,
       CAST(sum(total_output_sats) AS DECIMAL(38, 0)) AS total_output_sats FROM gold_transactions""",
        "gold_transactions",
    ),
    "q_metrics_outputs": over(
        """
SELECT count(*) AS output_count, CAST(sum(value_sats) AS DECIMAL(38, 0)) AS total_output_sats,
       CAST(count_if(spend_discrepancy) AS BIGINT) AS spend_discrepancy_count,
       CAST(count_if(canonical_spent) AS BIGINT) AS canonical_spent_count FROM gold_outputs""",
        "gold_outputs",
    ),
    "q_metrics_inputs": over(
        """
SELECT count(*) AS input_count, CAST(sum(value_sats) AS DECIMAL(38, 0)) AS total_input_sats,
       CAST(count_if(double_spend_detected) AS BIGINT) AS double_spend_count FROM gold_inputs""",
        "gold_inputs",
    ),
    "q_metrics_blocks": over(
        """
SELECT count(*) AS block_count, CAST(sum(total_fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats,
       CAST(sum(observed_transaction_count) AS BIGINT) AS observed_transaction_count,
       round(avg(difficulty), 6) AS average_difficulty FROM gold_blocks""",
        "gold_blocks",
    ),
    "q_daily_trend": over(
        """
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, count(*) AS transaction_count,
       CAST(sum(fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats,
       round(avg(fee_rate_sats_per_byte), 6) AS average_fee_rate_sats_per_byte
FROM gold_transactions GROUP BY 1""",
        "gold_transactions",
    ),
    "q_trend_in_range_partitioned": over(
        f"{NATIVE_TREND} WHERE transaction_date >= DATE '1996-01-01' AND transaction_date < DATE '1996-07-01' GROUP BY 1",
        "gold_transactions",
    ),
    "q_trend_on_dates": over(
        f"{NATIVE_TREND} WHERE transaction_date IN (SELECT block_date FROM gold_blocks WHERE difficulty >= 88) GROUP BY 1",
        "gold_transactions",
        "gold_blocks",
    ),
    "q_trend_in_range": over(
        """
SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, count(*) AS transaction_count,
       CAST(sum(fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats,
       round(avg(fee_rate_sats_per_byte), 6) AS average_fee_rate_sats_per_byte
FROM gold_transactions WHERE transaction_date >= DATE '1996-01-01' AND transaction_date < DATE '1996-07-01'
GROUP BY 1""",
        "gold_transactions",
    ),
    "q_output_recon_summary": over(
        """
SELECT canonical_spent, spend_discrepancy, count(*) AS output_count, CAST(sum(value_sats) AS DECIMAL(38, 0)) AS total_value_sats
FROM gold_outputs GROUP BY 1, 2""",
        "gold_outputs",
    ),
    "q_utxo_summary": over(
        """
SELECT resolution_status, is_genesis_input, count(*) AS input_count, CAST(sum(value_sats) AS DECIMAL(38, 0)) AS total_value_sats,
       CAST(count_if(double_spend_detected) AS BIGINT) AS double_spend_count
FROM gold_inputs GROUP BY 1, 2""",
        "gold_inputs",
    ),
    "q_recon_kpis": over(
        """
SELECT 'blocks' AS table_name, 'transaction_count_mismatches' AS indicator,
       CAST(count_if(NOT transaction_count_matches) AS BIGINT) AS row_count FROM gold_blocks
UNION ALL SELECT 'transactions', 'input_count_mismatches', count_if(NOT input_count_matches) FROM gold_transactions
UNION ALL SELECT 'transactions', 'output_count_mismatches', count_if(NOT output_count_matches) FROM gold_transactions
UNION ALL SELECT 'transactions', 'input_value_mismatches', count_if(NOT input_value_matches) FROM gold_transactions
UNION ALL SELECT 'transactions', 'output_value_mismatches', count_if(NOT output_value_matches) FROM gold_transactions
UNION ALL SELECT 'transactions', 'any_mismatch', count_if(NOT (input_count_matches AND output_count_matches
    AND input_value_matches AND output_value_matches)) FROM gold_transactions
UNION ALL SELECT 'inputs', 'double_spends', count_if(double_spend_detected) FROM gold_inputs
UNION ALL SELECT 'outputs', 'spend_discrepancies', count_if(spend_discrepancy) FROM gold_outputs""",
        "gold_blocks",
        "gold_transactions",
        "gold_inputs",
        "gold_outputs",
    ),
    "q_time_to_spend_hist": over(
        """
SELECT time_to_spend_days, count(*) AS output_count FROM gold_outputs WHERE time_to_spend_days IS NOT NULL GROUP BY 1""",
        "gold_outputs",
    ),
    "q_rejects_by_reason": reasons(),
    "q_ingest_audit": over(
        "\nUNION ALL\n".join(
            f"SELECT '{e}' AS entity, batch_id, source_file, count(*) AS row_count FROM bronze_{e} GROUP BY ALL"
            for e in RAW
        ),
        *[f"bronze_{e}" for e in RAW],
    ),
    "q_miners": over(
        """
SELECT miner, count(*) AS block_count, CAST(sum(total_fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats,
       CAST(sum(observed_transaction_count) AS BIGINT) AS observed_transaction_count,
       round(avg(difficulty), 6) AS average_difficulty,
       CAST(count_if(transaction_count_matches) AS BIGINT) AS matching_block_count
FROM gold_blocks GROUP BY 1""",
        "gold_blocks",
    ),
    "q_sql_over_gold": over(
        """
SELECT b.miner, CAST(t.transaction_date AS VARCHAR) AS transaction_date, count(*) AS transaction_count,
       CAST(sum(t.fee_sats) AS DECIMAL(38, 0)) AS total_fee_sats
FROM gold_transactions t JOIN silver_blocks b ON b.block_hash = t.block_hash GROUP BY 1, 2 HAVING count(*) >= 5""",
        "gold_transactions",
        "silver_blocks",
    ),
    "corruption_rejects_quality": reasons("dq_"),
    "corruption_rejects_relationships": reasons("rel_"),
    "corruption_rejects": reasons("mix_"),
    "corruption_effects": over(
        """
SELECT resolution_status, address_matches, CAST(NULL AS BOOLEAN) AS spend_discrepancy, count(*) AS row_count
FROM mix_reconciliation GROUP BY 1, 2
UNION ALL SELECT NULL, NULL, spend_discrepancy, count(*) FROM mix_enriched GROUP BY 3""",
        "mix_reconciliation",
        "mix_enriched",
    ),
}
