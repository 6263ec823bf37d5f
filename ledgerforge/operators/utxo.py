"""Which earlier output does each input spend, and which outputs are spent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerforge.functions.expressions import is_genesis
from ledgerforge.sources.staging import Staging

OUTPUT_KEY = ["tx_hash", "output_index"]
SPENT_KEY = ["previous_tx_hash", "previous_output_index"]

# Resolution statuses.
GENESIS_INPUT = "genesis"
RESOLVED = "resolved"
UNRESOLVED = "unresolved"
AMBIGUOUS = "ambiguous"
NOT_RECONCILED = "not_reconciled"

REFERENCED = {
    "referenced_output_id": "output_id",
    "referenced_address": "address",
    "referenced_value_sats": "value_sats",
}


def _payload(outputs: DataFrame) -> DataFrame:
    """Outputs that are unique per key as the reference columns of an input."""
    key = [F.col(key).alias(name) for key, name in zip(OUTPUT_KEY, SPENT_KEY)]
    found = [F.col(source).alias(name) for name, source in REFERENCED.items()]
    return outputs.select(*key, *found, F.lit(1).cast("long").alias("matching_output_count"))


def _verdicts(claims: DataFrame, outputs: DataFrame, unique: bool) -> DataFrame:
    """One row per claimed output key, renamed to the reference columns of an input.

    Id, address and value are looked up only where a single output has the key. Counting by key
    aggregates by hash; it is skipped for outputs that are already unique per key, as the
    Silver table is.
    """
    payload = _payload(outputs)
    if unique:
        return claims.join(payload, SPENT_KEY)
    key = [F.col(key).alias(name) for key, name in zip(OUTPUT_KEY, SPENT_KEY)]
    counts = outputs.groupBy(*key).agg(F.count("*").alias("matching_output_count"))
    counted = claims.join(counts, SPENT_KEY).withColumn("_one", F.col("matching_output_count") == 1)
    single = payload.drop("matching_output_count").withColumn("_one", F.lit(True))
    return counted.join(single, [*SPENT_KEY, "_one"], "left").drop("_one")


def resolve_inputs(
    inputs: DataFrame,
    outputs: DataFrame,
    *,
    unique_outputs: bool = False,
    stage: Staging | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Add to every input what it spends, whether that matches, and whether others spend it too.

    Resolution is decided once per referenced key (claims joined with outputs, both unique per
    key) and then looked up for the input rows. Genesis inputs and inputs without a reference
    bypass the join, where they would all share one key. A key is double spent when more than
    one input resolves to it; every claimant is flagged. With `stage` the decisions are written
    first, so that adaptive execution can split a key that very many inputs refer to. With `dealt`, for inputs that
    lie by tx_hash and have one each, only keys and decisions travel: a transaction's decisions come to its inputs.
    """
    referencing = F.col("previous_tx_hash").isNotNull() & ~is_genesis()
    candidates = inputs.filter(referencing)
    claims = candidates.groupBy(*SPENT_KEY).agg(F.count("*").alias("claim_count"))
    verdicts = _verdicts(claims, outputs, unique_outputs)
    if stage:
        verdicts = stage.keep(verdicts, "verdicts")
    on = SPENT_KEY
    if dealt:
        on = ["tx_hash", *SPENT_KEY]
        verdicts = candidates.select(*on).distinct().join(verdicts, SPENT_KEY)

    looked_up = _judged(candidates.join(verdicts, on, "left"), inputs)
    return _bypassing(inputs, looked_up).unionByName(looked_up)


def resolve_at_outputs(inputs: DataFrame, outputs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """resolve_inputs for outputs that lie by tx_hash, one per key: (referencing inputs, the others).

    Referencing inputs are dealt once, to where the outputs of the transaction that they refer to lie, and stay there: what
    is asked per spent output or referenced transaction afterwards moves none of them. Claims of one
    transaction share a task, as its outputs do; the others do not move.
    """
    dealt = inputs.filter(F.col("previous_tx_hash").isNotNull() & ~is_genesis()).repartition(buckets, "previous_tx_hash")
    claimed = dealt.withColumn("claim_count", F.count("*").over(Window.partitionBy(*SPENT_KEY)))
    looked_up = _judged(claimed.join(_payload(outputs), SPENT_KEY, "left"), inputs)
    return looked_up, _bypassing(inputs, looked_up)


def _judged(found: DataFrame, inputs: DataFrame) -> DataFrame:
    """Referencing inputs with what was found for them: status and comparisons."""
    resolved = F.col("resolution_status") == RESOLVED
    matched = F.col("matching_output_count")
    status = (
        F.when(matched.isNull(), UNRESOLVED).when(matched > 1, AMBIGUOUS).otherwise(RESOLVED)
    )
    return found.withColumn("resolution_status", status).select(
        *inputs.columns,
        "matching_output_count",
        F.when(matched.isNotNull(), F.col(SPENT_KEY[0])).alias("referenced_tx_hash"),
        F.when(matched.isNotNull(), F.col(SPENT_KEY[1])).alias("referenced_output_index"),
        "referenced_output_id",
        "referenced_address",
        "referenced_value_sats",
        "resolution_status",
        F.when(resolved, F.col("address") == F.col("referenced_address")).alias("address_matches"),
        F.when(resolved, F.col("value_sats") == F.col("referenced_value_sats")).alias("value_matches"),
        (resolved & (F.col("claim_count") > 1)).alias("double_spend_detected"),
    )


def _bypassing(inputs: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Genesis inputs and inputs without a reference, with the columns of those that were looked up."""
    fixed = {
        "resolution_status": F.when(is_genesis(), GENESIS_INPUT).otherwise(NOT_RECONCILED),
        "double_spend_detected": F.lit(False),
    }
    return inputs.filter(F.col("previous_tx_hash").isNull() | is_genesis()).select(
        *inputs.columns,
        *[
            fixed.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in looked_up.schema.fields[len(inputs.columns) :]
        ],
    )


def enrich_outputs(outputs: DataFrame, reconciliation: DataFrame) -> DataFrame:
    """Compare the delivered spent flag with the spends that were observed."""
    observed = (
        reconciliation.filter(F.col("resolution_status") == RESOLVED)
        .select(*[F.col(name).alias(key) for key, name in zip(OUTPUT_KEY, SPENT_KEY)])
        .distinct()
        .withColumn("observed_spent", F.lit(True))
    )
    renamed = outputs.withColumnRenamed("spent", "source_spent")
    return (
        renamed.join(observed, OUTPUT_KEY, "left")
        .withColumn("observed_spent", F.coalesce("observed_spent", F.lit(False)))
        .withColumn("canonical_spent", F.col("observed_spent"))
        .withColumn(
            "spend_discrepancy", ~F.col("source_spent").eqNullSafe(F.col("observed_spent"))
        )
    )


def check_chain_links(blocks: DataFrame) -> DataFrame:
    """Compare previous_block_hash with the block one height below.

    Status: first (nothing lower exists), linked, broken (the height below has blocks, none
    with that hash) or gap (the height below has no block). Two equi-joins instead of a
    window over all heights, which would need every block in one task.
    """
    next_height = F.col("block_height").cast("bigint") + 1
    below = blocks.select(next_height.alias("_height"), F.col("block_hash").alias("previous_block_hash"))
    hashes = below.distinct().withColumn("hash_below", F.lit(True))
    heights = below.select("_height").distinct().withColumn("height_below", F.lit(True))
    lowest = blocks.select(F.min("block_height")).scalar()
    joined = blocks.withColumn("_height", F.col("block_height").cast("bigint"))
    joined = joined.join(hashes, ["_height", "previous_block_hash"], "left").join(heights, "_height", "left")
    return joined.select(
        *blocks.columns,
        F.when(F.col("block_height") == lowest, "first")
        .when(F.col("hash_below"), "linked")
        .when(F.col("height_below"), "broken")
        .otherwise("gap")
        .alias("link_status"),
    )
