"""The sample ledger and its Silver and Gold tables as DuckDB SQL, written independently of
the Spark code: one chain of common table expressions over `orders` and `lineitem`."""

from __future__ import annotations

LINEAGE = "strftime({0}, '%Y-%m') || '-01' AS batch_id"

# name -> (names it reads, body); insertion order is dependency order.
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def table(name: str, *needs: str):
    def add(body: str) -> None:
        TABLES[name] = (needs, body.strip())

    return add


def with_tables(*names: str) -> str:
    """WITH clause holding the named tables and everything they read."""
    wanted: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.add(name)
            pending.extend(TABLES[name][0])
    parts = [f"{name} AS MATERIALIZED (\n{body}\n)" for name, (_, body) in TABLES.items() if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------- building blocks

table("ord")("""
SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) AS day FROM orders
""")

table("dlines")("""
SELECT l_orderkey AS k, l_linenumber AS ln, 'addr-' || l_partkey AS address,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS value_sats,
       l_returnflag = 'R' AS spent, CAST(l_shipdate AS TIMESTAMP) AS shipped,
       CASE WHEN l_orderkey % 101 = 0 THEN 'o-' || l_orderkey
            ELSE 'o-' || l_orderkey || '-' || l_linenumber END AS output_id
FROM lineitem
""")

table("lines", "dlines")("""
SELECT k, ln, address, value_sats FROM (
  SELECT *, row_number() OVER (PARTITION BY k, ln
    ORDER BY shipped DESC, output_id DESC, address DESC, value_sats DESC, spent DESC) AS rn
  FROM dlines) WHERE rn = 1
""")

table("spends", "ord")("""
SELECT k, day, 0 AS slot, k - 7 AS prev FROM ord WHERE k % 19 <> 0 AND k >= 7
UNION ALL
SELECT k, day, 1 AS slot, k - 20 AS prev FROM ord WHERE k % 50 = 0 AND k >= 20
""")

table("refs", "spends", "lines")("""
SELECT s.k, s.day, s.slot, s.prev, coalesce(l.ln, 99) AS ln,
       CASE WHEN s.k % 97 = 0 THEN 'addr-x' ELSE coalesce(l.address, 'addr-0') END AS address,
       coalesce(l.value_sats, 100000) AS value_sats
FROM spends s LEFT JOIN lines l ON l.k = s.prev
""")

table("bal", "ord", "refs", "lines")("""
SELECT k, day, fee, i, ni, o, no, greatest(o + fee - i, 0) AS topup, greatest(i - o - fee, 0) AS change,
       greatest(i, o + fee) AS total_in
FROM (
  SELECT ord.k, ord.day, 500 + ord.k % 4501 AS fee,
         coalesce(r.i, 0) AS i, coalesce(r.ni, 0) AS ni, coalesce(l.o, 0) AS o, coalesce(l.no, 0) AS no
  FROM ord
  LEFT JOIN (SELECT k, CAST(sum(value_sats) AS BIGINT) AS i, count(*) AS ni FROM refs GROUP BY k) r ON r.k = ord.k
  LEFT JOIN (SELECT k, CAST(sum(value_sats) AS BIGINT) AS o, count(*) AS no FROM lines GROUP BY k) l ON l.k = ord.k)
""")

# ---------------------------------------------------------------- bronze

table("bronze_blocks", "ord")(f"""
SELECT CASE WHEN h % 211 = 1 THEN '  ' ELSE 'b-' || CAST(CAST(day AS DATE) AS VARCHAR) END AS block_hash,
       CAST(CASE WHEN h % 223 = 2 THEN -1 ELSE h END AS INTEGER) AS block_height,
       'b-' || CAST(CAST(day AS DATE) - (CASE WHEN h % 53 = 0 THEN 2 ELSE 1 END) AS VARCHAR) AS previous_block_hash,
       CASE WHEN h % 241 = 7 THEN NULL ELSE day + to_hours(h % 24) END AS timestamp,
       CASE WHEN again THEN upper(miner) ELSE miner END AS miner,
       CASE WHEN h % 239 = 6 THEN 0.0 ELSE CAST(70 + h % 20 AS DOUBLE) END AS difficulty,
       CASE WHEN h % 227 = 3 THEN -1 ELSE n * 1000 END AS nonce,
       CAST(CASE WHEN h % 229 = 4 THEN -1 ELSE least(size, 2147483647) END AS INTEGER) AS size_bytes,
       CAST(CASE WHEN h % 233 = 5 THEN -1
                 ELSE least(n - (CASE WHEN h % 37 = 0 THEN 1 ELSE 0 END), 2147483647) END AS INTEGER) AS transaction_count,
       CASE WHEN again THEN day + INTERVAL 1 DAY ELSE day END AS ingested_at,
       'orders' AS source_file,
       {LINEAGE.format("day")}
FROM (
  SELECT *, CASE h % 3 WHEN 0 THEN '  North Pool ' WHEN 1 THEN 'EastPool' ELSE 'south pool' END AS miner
  FROM (SELECT day, date_diff('day', DATE '1995-01-01', CAST(day AS DATE)) AS h, count(*) AS n,
               CAST(sum(k % 651) AS BIGINT) AS size
        FROM ord GROUP BY day)) b
JOIN (VALUES (false), (true)) AS a(again) ON NOT again OR h % 19 = 0
""")

table("bronze_transactions", "bal")(f"""
SELECT CASE WHEN k % 401 = 3 THEN '  ' WHEN k % 17 = 0 THEN '  tx-' || k ELSE 'tx-' || k END AS tx_hash,
       CASE WHEN k % 409 = 5 THEN NULL WHEN k % 457 = 21 THEN 'b-unknown'
            ELSE 'b-' || CAST(CAST(day AS DATE) AS VARCHAR) END AS block_hash,
       CASE WHEN k % 419 = 7 OR copy = 2 THEN NULL ELSE day + to_minutes(k % 1440) END AS timestamp,
       CASE WHEN k % 421 = 9 THEN -1 ELSE fee END AS fee_sats,
       CAST(CASE WHEN k % 431 = 11 THEN -5 ELSE k % 651 + (CASE WHEN copy = 1 THEN 1 ELSE 0 END) END AS INTEGER) AS size_bytes,
       CAST(CASE WHEN k % 433 = 13 THEN 0
            ELSE ni + (CASE WHEN topup > 0 THEN 1 ELSE 0 END) + (CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END) END AS INTEGER) AS input_count,
       CAST(CASE WHEN k % 439 = 15 THEN 0 ELSE no + (CASE WHEN change > 0 THEN 1 ELSE 0 END) END AS INTEGER) AS output_count,
       CASE WHEN k % 443 = 17 THEN -1 ELSE total_in END AS total_input_sats,
       CASE WHEN k % 449 = 19 THEN -1
            ELSE total_in - fee + (CASE WHEN k % 43 = 0 THEN 1 ELSE 0 END) END AS total_output_sats,
       CASE WHEN copy = 0 THEN day ELSE day + INTERVAL 1 DAY END AS ingested_at,
       'orders' AS source_file,
       {LINEAGE.format("day")}
FROM bal JOIN (VALUES (0), (1), (2)) AS c(copy)
  ON copy = 0 OR (copy = 1 AND k % 23 = 4) OR (copy = 2 AND k % 29 = 6)
""")

table("bronze_inputs", "refs", "bal")(f"""
SELECT CASE WHEN idx = 2 AND k % 503 = 4 THEN '  ' ELSE id END AS input_id,
       CASE WHEN idx = 2 AND k % 509 = 6 THEN NULL
            WHEN idx = 2 AND k % 557 = 16 THEN 'tx-' || k || '-lost' ELSE 'tx-' || k END AS tx_hash,
       CAST(CASE WHEN idx = 2 AND k % 521 = 8 THEN NULL
            WHEN idx = 2 AND k % 523 = 10 THEN -1 ELSE idx END AS INTEGER) AS input_index,
       CASE WHEN idx = 2 AND k % 563 = 18 THEN NULL ELSE previous END AS previous_tx_hash,
       CASE WHEN idx = 2 AND k % 541 = 12 THEN 'x' ELSE previous_index END AS previous_output_index,
       address,
       CASE WHEN idx = 2 AND k % 547 = 14 THEN 0 ELSE value_sats END AS value_sats,
       CASE WHEN again THEN day + INTERVAL 1 DAY ELSE day END AS ingested_at,
       'lineitem' AS source_file,
       {LINEAGE.format("day")}
FROM (
  SELECT k, day, 'i-' || k || '-' || slot || '-' || ln AS id, ln * 2 + slot AS idx, 'tx-' || prev AS previous,
         CAST(ln AS VARCHAR) AS previous_index, address, value_sats FROM refs
  UNION ALL
  SELECT k, day, 'i-' || k || '-g', 0, 'genesis', '0', 'addr-g', topup FROM bal WHERE topup > 0) r
JOIN (VALUES (false), (true)) AS a(again) ON NOT again OR k % 31 = 5
""")

table("bronze_outputs", "dlines", "bal")(f"""
SELECT CASE WHEN ln = 1 AND k % 307 = 11 THEN '   ' WHEN k % 7 = 0 THEN ' ' || output_id || ' ' ELSE output_id END AS output_id,
       CASE WHEN ln = 1 AND k % 331 = 23 THEN ' '
            WHEN ln = 1 AND k % 337 = 29 THEN 'tx-' || k || '-lost' ELSE 'tx-' || k END AS tx_hash,
       CAST(CASE WHEN ln = 1 AND k % 313 = 17 THEN -1 WHEN ln = 1 AND k % 317 = 19 THEN NULL ELSE ln END AS INTEGER) AS output_index,
       address,
       CASE WHEN ln = 2 AND k % 311 = 13 THEN 0 ELSE value_sats END AS value_sats,
       CASE WHEN k % 347 = 31 THEN NULL ELSE spent END AS spent,
       shipped AS ingested_at, 'lineitem' AS source_file,
       {LINEAGE.format("shipped")}
FROM (
  SELECT k, ln, address, value_sats, spent, shipped, output_id FROM dlines
  UNION ALL
  SELECT k, 0, 'addr-c-' || k, change, false, day, 'o-' || k || '-0' FROM bal WHERE change > 0)
""")


# ---------------------------------------------------------------- silver

def silver_tables(prefix: str = "") -> None:
    """Silver and reject tables over {prefix}bronze_*; the prefix keeps variants apart."""
    p = prefix

    table(f"{p}v_blocks", f"{p}bronze_blocks")(f"""
SELECT *, list_filter([
  CASE WHEN block_hash IS NULL OR trim(block_hash) = '' THEN 'BLOCK_HASH_MISSING' END,
  CASE WHEN block_height IS NULL OR block_height < 0 THEN 'BLOCK_HEIGHT_INVALID' END,
  CASE WHEN nonce IS NULL OR nonce < 0 THEN 'NONCE_INVALID' END,
  CASE WHEN size_bytes IS NULL OR size_bytes < 0 THEN 'SIZE_INVALID' END,
  CASE WHEN transaction_count IS NULL OR transaction_count < 0 THEN 'TRANSACTION_COUNT_INVALID' END,
  CASE WHEN difficulty IS NULL OR difficulty <= 0 THEN 'DIFFICULTY_INVALID' END,
  CASE WHEN timestamp IS NULL THEN 'TIMESTAMP_MISSING' END], lambda x: x IS NOT NULL) AS errors
FROM {p}bronze_blocks
""")
    table(f"{p}silver_blocks", f"{p}v_blocks")(f"""
SELECT * EXCLUDE (rn, errors), CAST(timestamp AS DATE) AS block_date, CAST(year(timestamp) AS INTEGER) AS block_year,
       CAST(month(timestamp) AS INTEGER) AS block_month, CAST(hour(timestamp) AS INTEGER) AS block_hour
FROM (
  SELECT *, row_number() OVER (PARTITION BY block_hash ORDER BY ingested_at DESC NULLS LAST, batch_id DESC NULLS LAST,
    block_height DESC, previous_block_hash DESC NULLS LAST, timestamp DESC, miner DESC NULLS LAST, difficulty DESC,
    nonce DESC, size_bytes DESC, transaction_count DESC, source_file DESC) AS rn
  FROM (SELECT * REPLACE (lower(trim(miner)) AS miner) FROM {p}v_blocks WHERE len(errors) = 0))
WHERE rn = 1
""")
    table(f"{p}reject_blocks", f"{p}v_blocks")(f"SELECT * FROM {p}v_blocks WHERE len(errors) > 0")

    table(f"{p}v_transactions", f"{p}bronze_transactions")(f"""
SELECT * REPLACE (CASE WHEN len(errors) = 0 AND total_input_sats <> total_output_sats + fee_sats
                       THEN ['ACCOUNTING_MISMATCH'] ELSE errors END AS errors)
FROM (
  SELECT *, list_filter([
    CASE WHEN tx_hash IS NULL OR tx_hash = '' THEN 'TX_HASH_MISSING' END,
    CASE WHEN block_hash IS NULL OR block_hash = '' THEN 'BLOCK_HASH_MISSING' END,
    CASE WHEN timestamp IS NULL THEN 'TIMESTAMP_MISSING' END,
    CASE WHEN fee_sats IS NULL OR fee_sats < 0 THEN 'FEE_INVALID' END,
    CASE WHEN size_bytes IS NULL OR size_bytes < 0 THEN 'SIZE_INVALID' END,
    CASE WHEN input_count IS NULL OR input_count <= 0 THEN 'INPUT_COUNT_INVALID' END,
    CASE WHEN output_count IS NULL OR output_count <= 0 THEN 'OUTPUT_COUNT_INVALID' END,
    CASE WHEN total_input_sats IS NULL OR total_input_sats < 0 THEN 'TOTAL_INPUT_INVALID' END,
    CASE WHEN total_output_sats IS NULL OR total_output_sats < 0 THEN 'TOTAL_OUTPUT_INVALID' END],
    lambda x: x IS NOT NULL) AS errors
  FROM (SELECT * REPLACE (trim(tx_hash) AS tx_hash, trim(block_hash) AS block_hash) FROM {p}bronze_transactions))
""")
    table(f"{p}l_transactions", f"{p}v_transactions")(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT * EXCLUDE (errors), row_number() OVER (PARTITION BY tx_hash ORDER BY ingested_at DESC NULLS LAST,
    batch_id DESC NULLS LAST, source_file DESC NULLS LAST, block_hash DESC, timestamp DESC, fee_sats DESC,
    size_bytes DESC, input_count DESC, output_count DESC, total_input_sats DESC, total_output_sats DESC) AS rn
  FROM {p}v_transactions WHERE len(errors) = 0) WHERE rn = 1
""")
    table(f"{p}silver_transactions", f"{p}l_transactions", f"{p}silver_blocks")(f"""
SELECT * FROM {p}l_transactions t WHERE EXISTS (SELECT 1 FROM {p}silver_blocks b WHERE b.block_hash = t.block_hash)
""")
    table(f"{p}reject_transactions", f"{p}v_transactions", f"{p}l_transactions", f"{p}silver_blocks")(f"""
SELECT * FROM {p}v_transactions WHERE len(errors) > 0
UNION ALL BY NAME
SELECT *, ['BLOCK_NOT_FOUND'] AS errors FROM {p}l_transactions t
WHERE NOT EXISTS (SELECT 1 FROM {p}silver_blocks b WHERE b.block_hash = t.block_hash)
""")

    table(f"{p}v_inputs", f"{p}bronze_inputs")(f"""
SELECT *, list_filter([
  CASE WHEN input_id IS NULL OR input_id = '' THEN 'INPUT_ID_MISSING' END,
  CASE WHEN tx_hash IS NULL OR tx_hash = '' THEN 'TX_HASH_MISSING' END,
  CASE WHEN input_index IS NULL THEN 'INPUT_INDEX_MISSING' END,
  CASE WHEN input_index < 0 THEN 'INPUT_INDEX_INVALID' END,
  CASE WHEN previous_output_index IS NULL OR previous_output_index < 0 THEN 'OUTPUT_INDEX_INVALID' END,
  CASE WHEN value_sats IS NULL OR value_sats <= 0 THEN 'VALUE_SATS_INVALID' END], lambda x: x IS NOT NULL) AS errors
FROM (SELECT * REPLACE (trim(input_id) AS input_id, trim(tx_hash) AS tx_hash, trim(previous_tx_hash) AS previous_tx_hash,
        trim(address) AS address, TRY_CAST(previous_output_index AS INTEGER) AS previous_output_index)
      FROM {p}bronze_inputs)
""")
    table(f"{p}l_inputs", f"{p}v_inputs")(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT * EXCLUDE (errors), row_number() OVER (PARTITION BY tx_hash, input_index ORDER BY ingested_at DESC NULLS LAST,
    batch_id DESC NULLS LAST, source_file DESC NULLS LAST, input_id DESC, previous_tx_hash DESC NULLS LAST,
    previous_output_index DESC, address DESC NULLS LAST, value_sats DESC) AS rn
  FROM {p}v_inputs WHERE len(errors) = 0) WHERE rn = 1
""")
    table(f"{p}v_outputs", f"{p}bronze_outputs")(f"""
SELECT *, list_filter([
  CASE WHEN output_id IS NULL OR output_id = '' THEN 'OUTPUT_ID_MISSING' END,
  CASE WHEN tx_hash IS NULL OR tx_hash = '' THEN 'TX_HASH_MISSING' END,
  CASE WHEN output_index IS NULL THEN 'OUTPUT_INDEX_MISSING' END,
  CASE WHEN output_index < 0 THEN 'OUTPUT_INDEX_INVALID' END,
  CASE WHEN value_sats IS NULL OR value_sats <= 0 THEN 'VALUE_SATS_INVALID' END], lambda x: x IS NOT NULL) AS errors
FROM (SELECT * REPLACE (trim(output_id) AS output_id, trim(tx_hash) AS tx_hash, trim(address) AS address)
      FROM {p}bronze_outputs)
""")
    table(f"{p}collisions", f"{p}v_outputs")(f"""
SELECT output_id FROM (SELECT DISTINCT output_id, tx_hash, output_index FROM {p}v_outputs WHERE len(errors) = 0)
GROUP BY output_id HAVING count(*) > 1
""")
    table(f"{p}l_outputs", f"{p}v_outputs", f"{p}collisions")(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT * EXCLUDE (errors), row_number() OVER (PARTITION BY tx_hash, output_index ORDER BY ingested_at DESC NULLS LAST,
    batch_id DESC NULLS LAST, source_file DESC NULLS LAST, output_id DESC, address DESC NULLS LAST, value_sats DESC,
    spent DESC NULLS LAST) AS rn
  FROM {p}v_outputs WHERE len(errors) = 0 AND output_id NOT IN (SELECT output_id FROM {p}collisions)) WHERE rn = 1
""")
    for side in ("input", "output"):
        latest, kept = f"{p}l_{side}s", f"{p}silver_transactions"
        table(f"{p}c_{side}s", latest, kept)(f"""
SELECT c.*, CASE WHEN t.tx_hash IS NULL THEN ['TRANSACTION_NOT_FOUND'] ELSE list_filter([
    CASE WHEN s.total <> t.total_{side}_sats THEN '{side.upper()}_VALUE_TOTAL_MISMATCH' END,
    CASE WHEN s.n <> t.{side}_count THEN '{side.upper()}_COUNT_MISMATCH' END], lambda x: x IS NOT NULL) END AS errors
FROM {latest} c
JOIN (SELECT tx_hash, sum(value_sats) AS total, count(*) AS n FROM {latest} GROUP BY tx_hash) s ON s.tx_hash = c.tx_hash
LEFT JOIN {kept} t ON t.tx_hash = c.tx_hash
""")
        table(f"{p}silver_{side}s", f"{p}c_{side}s")(
            f"SELECT * EXCLUDE (errors) FROM {p}c_{side}s WHERE len(errors) = 0"
        )
    table(f"{p}reject_inputs", f"{p}v_inputs", f"{p}c_inputs")(f"""
SELECT * FROM {p}v_inputs WHERE len(errors) > 0
UNION ALL BY NAME SELECT * FROM {p}c_inputs WHERE len(errors) > 0
""")
    table(f"{p}reject_outputs", f"{p}v_outputs", f"{p}c_outputs", f"{p}collisions")(f"""
SELECT * FROM {p}v_outputs WHERE len(errors) > 0
UNION ALL BY NAME
SELECT * REPLACE (['OUTPUT_ID_COLLISION'] AS errors) FROM {p}v_outputs
WHERE len(errors) = 0 AND output_id IN (SELECT output_id FROM {p}collisions)
UNION ALL BY NAME SELECT * FROM {p}c_outputs WHERE len(errors) > 0
""")


silver_tables()


# ---------------------------------------------------------------- reference resolution

def resolution_table(name: str, inputs: str, outputs: str) -> None:
    """Every input with what it spends, out of any pair of input and output tables."""
    table(name, inputs, outputs)(f"""
SELECT * EXCLUDE (claims), resolution_status = 'resolved' AND claims > 1 AS double_spend_detected
FROM (
  SELECT *, count(*) FILTER (WHERE resolution_status = 'resolved')
              OVER (PARTITION BY previous_tx_hash, previous_output_index) AS claims
  FROM (
    SELECT i.*, o.n AS matching_output_count,
           CASE WHEN o.n IS NOT NULL THEN i.previous_tx_hash END AS referenced_tx_hash,
           CASE WHEN o.n IS NOT NULL THEN i.previous_output_index END AS referenced_output_index,
           CASE WHEN o.n = 1 THEN o.output_id END AS referenced_output_id,
           CASE WHEN o.n = 1 THEN o.address END AS referenced_address,
           CASE WHEN o.n = 1 THEN o.value_sats END AS referenced_value_sats,
           CASE WHEN i.previous_tx_hash IS NULL THEN 'not_reconciled'
                WHEN i.previous_tx_hash = 'genesis' THEN 'genesis'
                WHEN o.n IS NULL THEN 'unresolved' WHEN o.n > 1 THEN 'ambiguous' ELSE 'resolved' END AS resolution_status,
           CASE WHEN o.n = 1 THEN i.address = o.address END AS address_matches,
           CASE WHEN o.n = 1 THEN i.value_sats = o.value_sats END AS value_matches
    FROM {inputs} i
    LEFT JOIN (SELECT tx_hash, output_index, count(*) AS n, min(output_id) AS output_id, min(address) AS address,
                      min(value_sats) AS value_sats
               FROM {outputs} GROUP BY tx_hash, output_index) o
      ON i.previous_tx_hash <> 'genesis' AND o.tx_hash = i.previous_tx_hash AND o.output_index = i.previous_output_index))
""")


resolution_table("reconciliation", "silver_inputs", "silver_outputs")

table("valid_inputs", "v_inputs")("SELECT * EXCLUDE (errors) FROM v_inputs WHERE len(errors) = 0")
table("valid_outputs", "v_outputs")("SELECT * EXCLUDE (errors) FROM v_outputs WHERE len(errors) = 0")
resolution_table("raw_reconciliation", "valid_inputs", "valid_outputs")

def enriched_table(p: str = "") -> None:
    table(f"{p}outputs_enriched", f"{p}silver_outputs", f"{p}reconciliation")(f"""
SELECT * RENAME (spent AS source_spent), observed AS observed_spent, observed AS canonical_spent,
       spent IS DISTINCT FROM observed AS spend_discrepancy
FROM (SELECT o.*, EXISTS (SELECT 1 FROM {p}reconciliation r WHERE r.resolution_status = 'resolved'
        AND r.previous_tx_hash = o.tx_hash AND r.previous_output_index = o.output_index) AS observed
      FROM {p}silver_outputs o)
""")


enriched_table()

# ---------------------------------------------------------------- gold

table("gold_blocks", "silver_blocks", "silver_transactions")("""
SELECT *, transaction_count = observed_transaction_count AS transaction_count_matches
FROM (
  SELECT b.*, coalesce(n, 0) AS observed_transaction_count, CAST(coalesce(fee, 0) AS DECIMAL(38,0)) AS total_fee_sats,
         CAST(coalesce(size, 0) AS DECIMAL(38,0)) AS total_transaction_size_bytes,
         CAST(coalesce(ti, 0) AS DECIMAL(38,0)) AS total_input_sats, CAST(coalesce(tout, 0) AS DECIMAL(38,0)) AS total_output_sats
  FROM silver_blocks b
  LEFT JOIN (SELECT block_hash, count(*) AS n, sum(fee_sats) AS fee, sum(size_bytes) AS size,
                    sum(total_input_sats) AS ti, sum(total_output_sats) AS tout
             FROM silver_transactions GROUP BY block_hash) t ON t.block_hash = b.block_hash)
""")

table("gold_transactions", "silver_transactions", "silver_inputs", "silver_outputs")("""
SELECT *, CASE WHEN size_bytes = 0 THEN NULL ELSE fee_sats / size_bytes END AS fee_rate_sats_per_byte,
       input_count = observed_input_count AS input_count_matches,
       output_count = observed_output_count AS output_count_matches,
       total_input_sats = observed_total_input_sats AS input_value_matches,
       total_output_sats = observed_total_output_sats AS output_value_matches,
       CAST(timestamp AS DATE) AS transaction_date
FROM (
  SELECT t.*, coalesce(i.n, 0) AS observed_input_count, CAST(coalesce(i.s, 0) AS DECIMAL(38,0)) AS observed_total_input_sats,
         coalesce(o.n, 0) AS observed_output_count, CAST(coalesce(o.s, 0) AS DECIMAL(38,0)) AS observed_total_output_sats
  FROM silver_transactions t
  LEFT JOIN (SELECT tx_hash, count(*) AS n, sum(value_sats) AS s FROM silver_inputs GROUP BY 1) i ON i.tx_hash = t.tx_hash
  LEFT JOIN (SELECT tx_hash, count(*) AS n, sum(value_sats) AS s FROM silver_outputs GROUP BY 1) o ON o.tx_hash = t.tx_hash)
""")

table("gold_inputs", "reconciliation", "silver_transactions")("""
SELECT r.* EXCLUDE (matching_output_count), s.block_hash AS spending_block_hash, s.timestamp AS spending_timestamp,
       p.timestamp AS referenced_transaction_timestamp, r.previous_tx_hash = 'genesis' AS is_genesis_input,
       CAST(s.timestamp AS DATE) AS spend_date,
       CASE WHEN r.resolution_status = 'resolved' THEN
         CAST(date_diff('day', CAST(p.timestamp AS DATE), CAST(s.timestamp AS DATE)) AS INTEGER) END AS coin_age_days
FROM reconciliation r
LEFT JOIN silver_transactions s ON s.tx_hash = r.tx_hash
LEFT JOIN silver_transactions p ON p.tx_hash = r.referenced_tx_hash
""")

def gold_outputs_table(p: str = "") -> None:
    table(f"{p}gold_outputs", f"{p}outputs_enriched", f"{p}reconciliation", f"{p}silver_transactions")(f"""
SELECT o.*, coalesce(a.n, 0) AS observed_spend_count, a.first_ts AS first_spent_timestamp,
       t.block_hash AS creating_block_hash, t.timestamp AS created_timestamp, CAST(t.timestamp AS DATE) AS output_date,
       CAST(a.first_ts AS DATE) AS first_spend_date, coalesce(a.n, 0) > 1 AS has_multiple_spend_attempts,
       CASE WHEN o.canonical_spent THEN
         CAST(date_diff('day', CAST(t.timestamp AS DATE), CAST(a.first_ts AS DATE)) AS INTEGER) END AS time_to_spend_days
FROM {p}outputs_enriched o
LEFT JOIN (SELECT r.previous_tx_hash AS tx_hash, r.previous_output_index AS output_index, count(*) AS n,
                  min(s.timestamp) AS first_ts
           FROM {p}reconciliation r LEFT JOIN {p}silver_transactions s ON s.tx_hash = r.tx_hash
           WHERE r.resolution_status = 'resolved' GROUP BY 1, 2) a
  ON a.tx_hash = o.tx_hash AND a.output_index = o.output_index
LEFT JOIN {p}silver_transactions t ON t.tx_hash = o.tx_hash
""")


gold_outputs_table()
