"""Row rules, quarantine split, key-level problems and reject frames.

Set checks (missing references, id collisions, total mismatches) are decided once per key.
Each yields a frame of problem keys with error codes; rows are then separated from it. Keys
are pre-aggregated, so a key with very many rows costs one row per task. Where the list of
problems was written first, both sides of the join are plain exchanges and adaptive execution
splits a hot key; whether a short list is broadcast instead is the planner's choice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = "validation_errors"


@dataclass(frozen=True)
class Rule:
    """A row fails when the SQL predicate is true; NULL counts as passing."""

    code: str
    fails: str


def missing(column: str) -> str:
    return f"{column} IS NULL OR trim({column}) = ''"


def null(column: str) -> str:
    return f"{column} IS NULL"


def below(column: str, bound: int) -> str:
    return f"{column} < {bound}"


def null_or_below(column: str, bound: int) -> str:
    return f"{null(column)} OR {below(column, bound)}"


def _codes(rules: Sequence[Rule]) -> Column:
    fired = ", ".join(f"CASE WHEN {rule.fails} THEN '{rule.code}' END" for rule in rules)
    return F.expr(f"array_compact(array({fired}))")


def validate(df: DataFrame, rules: Sequence[Rule], error_column: str = ERRORS) -> DataFrame:
    """Add the codes of all failed rules, in rule order."""
    return df.withColumn(error_column, _codes(rules))


def split(df: DataFrame, error_column: str = ERRORS) -> tuple[DataFrame, DataFrame]:
    """(rows without errors, rows with errors); a NULL error array counts as no errors."""
    failed = F.coalesce(F.size(error_column), F.lit(0)) > 0
    return df.filter(~failed), df.filter(failed)


def _any_fails(rules: Sequence[Rule]) -> Column:
    return F.expr(f"coalesce({' OR '.join(f'({rule.fails})' for rule in rules)}, false)")


def quarantine(
    df: DataFrame,
    *steps: Sequence[Rule],
    error_column: str = ERRORS,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """validate and split in one: (passing rows, failing rows with codes).

    Later steps judge only rows that pass the earlier ones. Passing rows, nearly all of them,
    meet one generated boolean condition; the code array is built for failing rows only. With
    `keep` (which writes a frame and reads it back) `df` is read once for both sides.
    """
    conditions = [_any_fails(rules) for rules in steps]
    failed = reduce(lambda a, b: a | b, conditions)
    codes = _codes(steps[-1])
    for condition, rules in reversed(list(zip(conditions[:-1], steps[:-1]))):
        codes = F.when(condition, _codes(rules)).otherwise(codes)
    if keep is None:
        return df.filter(~failed), df.filter(failed).withColumn(error_column, codes)
    marked = keep(df.withColumn(error_column, F.when(failed, codes)))
    passed = F.col(error_column).isNull()
    return marked.filter(passed).drop(error_column), marked.filter(~passed)


def missing_references(
    children: DataFrame, parents: DataFrame, on: Sequence[str], code: str
) -> DataFrame:
    """Problem keys: child keys that no parent has. NULL keys are left to the caller."""
    keys = children.select(*on).dropna().distinct()
    return keys.join(parents.select(*on), list(on), "left_anti").withColumn(
        ERRORS, F.array(F.lit(code))
    )


def id_collisions(
    df: DataFrame, id_column: str, key_columns: Sequence[str], code: str
) -> DataFrame:
    """Problem ids: one id used for more than one key. Repeats of the same key are fine.

    Keys are compared by two 64-bit hashes (which also cover which columns are NULL), whose
    extremes are longs and so aggregate by hash, before the shuffle, without a sort.
    """
    parts = [*map(F.col, key_columns), *(F.col(name).isNull() for name in key_columns)]
    hashes = {"a": F.xxhash64(*parts), "b": F.xxhash64(F.lit(code), *parts)}
    bounds = [f(key).alias(f"{f.__name__}_{name}") for name, key in hashes.items() for f in (F.min, F.max)]
    return (
        df.groupBy(id_column)
        .agg(*bounds)
        .filter("min_a <> max_a OR min_b <> max_b")
        .select(id_column, F.array(F.lit(code)).alias(ERRORS))
    )


def total_problems(
    children: DataFrame,
    parents: DataFrame,
    *,
    key: str,
    value: str,
    declared_total: str,
    declared_count: str,
    total_code: str,
    count_code: str,
    missing_code: str,
) -> DataFrame:
    """Problem keys of child groups whose parent is missing or declares other totals.

    One aggregate of the children gives sum and count, one join per key compares them with
    the parent. A sum beyond the long range is NULL here and reported as a mismatch.
    """
    total = F.when(F.count(value) > 0, F.try_sum(value)).otherwise(F.lit(0).cast("long"))
    totals = children.groupBy(key).agg(
        total.alias("actual_total"), F.count("*").alias("actual_count")
    )
    declared = parents.select(
        key, F.col(declared_total).alias("total"), F.col(declared_count).alias("count")
    ).withColumn("known", F.lit(True))
    total_differs = F.col("actual_total").isNull() | (F.col("actual_total") != F.col("total"))
    mismatches = F.array_compact(
        F.array(
            F.when(total_differs, F.lit(total_code)),
            F.when(F.col("actual_count") != F.col("count"), F.lit(count_code)),
        )
    )
    return (
        totals.join(declared, key, "left")
        .select(
            key,
            F.when(F.col("known"), mismatches)
            .otherwise(F.array(F.lit(missing_code)))
            .alias(ERRORS),
        )
        .filter(F.size(ERRORS) > 0)
    )


def separate(
    df: DataFrame, problems: DataFrame, on: Sequence[str], error_column: str = ERRORS
) -> tuple[DataFrame, DataFrame]:
    """(rows whose key has no problem, rows with one); the problem's codes replace the errors."""
    codes = problems.select(*on, F.col(ERRORS).alias("_codes"))
    columns = [*df.columns] if error_column in df.columns else [*df.columns, error_column]
    kept = df.join(problems.select(*on), list(on), "left_anti")
    failed = df.join(codes, list(on), "inner").withColumn(error_column, F.col("_codes"))
    return kept.select(*df.columns), failed.select(*columns)


def partition_by_reference(
    df: DataFrame,
    references: DataFrame,
    on: Sequence[str],
    code: str,
    error_column: str = ERRORS,
) -> tuple[DataFrame, DataFrame]:
    """(rows whose parent exists, rows rejected because it does not); NULL keys are rejected."""
    parents = references.select(*on)
    kept = df.join(parents, list(on), "left_semi").select(*df.columns)
    failed = df.join(parents, list(on), "left_anti").select(*df.columns)
    return kept, failed.withColumn(error_column, F.array(F.lit(code)))


def finalize_rejections(
    *frames: DataFrame, rejected_at: datetime | None = None, column: str = "rejected_at"
) -> DataFrame:
    """Union reject frames and stamp them; pass the run's own time to stamp every entity alike."""
    if not frames:
        raise ValueError("At least one reject frame is required.")
    stamp = F.current_timestamp() if rejected_at is None else F.lit(rejected_at).cast("timestamp")
    return reduce(DataFrame.unionByName, frames).withColumn(column, stamp)


def check_conservation(total: int, parts: dict[str, int], what: str) -> None:
    """Fail the run when rows went missing or were multiplied."""
    if total != sum(parts.values()):
        detail = ", ".join(f"{name}={count}" for name, count in parts.items())
        raise RuntimeError(f"Row conservation failed for {what}: {total} rows in, {detail} out.")
