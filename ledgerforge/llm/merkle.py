"""Merkle manifest of a dataset: a digest tree over all rows, with a proof for each row.

A group's leaves, in their order, are the bottom of a tree in which every FAN consecutive nodes of a
level become one node (the last run may be shorter), until one is left, the group's subroot. Subroots
in the order of their groups form the upper tree, whose top is the root. A node is the SHA-256
of the digests below it as lower-case hex text, one after the other.

1. Leaves are hashed and written with their position, which is the row's offset in its range partition plus
   what earlier partitions hold of its group: no task sees a whole group.
2. Superblocks of `superblock` consecutive nodes, a power of FAN, reduce to one node each, level by level of
   superblocks, until each group has one. Levels above the leaves shrink by that factor.
3. On the way back each superblock's nodes are cogrouped with the outer node that stands for it, which by then
   carries its own way to the root: the function reduces the superblock again, joins its siblings with
   the outer proof, and folds. So a proof of any length costs one exchange of the nodes and one row per
   superblock of outer ones, and no group of rows is larger than a superblock.

Groups of very different size are no matter: positions, not groups, say what a task gets.
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.sources.staging import Staging

FAN = 8
SUPERBLOCK = FAN**3

NODE = "grp string, pos bigint, total bigint, digest string"
STEP = "struct<before:string,after:string>"


def digest_of(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_digest(values: dict[str, Column]) -> Column:
    """SHA-256 of all values, each as `-` if null, else its UTF-8 byte count, a colon and its text."""
    texts = [value.cast("string") for value in values.values()]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def depth(nodes: int) -> int:
    """Levels above `nodes` nodes."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def _positions(rows: DataFrame, staging: Staging, name: str) -> DataFrame:
    """Rows (grp, sort_id, digest, ...) with `pos` and `total` in their group, ascending by sort_id and digest.

    Rows are dealt into ranges and numbered there as they are written; a row's position is the distance
    to the first of its group in its range, after what earlier ranges hold.
    """
    order = ("grp", "sort_id", "digest")
    ranged = rows.repartitionByRange(*(F.col(c).asc_nulls_first() for c in order)).sortWithinPartitions(*order)
    numbered = staging.keep(ranged.withColumn("at", F.monotonically_increasing_id()), f"{name}_numbered")
    part = F.shiftright("at", 33)
    runs = numbered.groupBy("grp", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("held"))
    totals = runs.groupBy("grp").agg(F.sum("held").alias("total"), F.collect_list(F.struct("part", "first", "held")).alias("runs"))
    # One entry per range that a group spans, in the order of ranges; sums before each by one fold.
    before = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).cast("bigint").alias("sum"), F.expr("cast(array() as array<struct<part:bigint,first:bigint,shift:bigint>>)").alias("out")),
        lambda acc, run: F.struct(
            (acc["sum"] + run["held"]).alias("sum"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        run["part"].cast("bigint").alias("part"),
                        run["first"].alias("first"),
                        (acc["sum"] - run["first"]).alias("shift"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    shifts = totals.select("grp", "total", F.inline(before).alias("part", "first", "shift")).drop("first")
    shifts = staging.keep(shifts, f"{name}_shifts")
    placed = numbered.withColumn("part", part.cast("bigint")).join(shifts, ["grp", "part"])
    return placed.withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _reduced(digests: list[str], levels: int) -> list[list[str]]:
    """All levels from the given one up, `levels` times reduced."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([digest_of(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return out


def _steps(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """Siblings of node `at` at each level, as the texts before and after it."""
    steps = []
    for level in levels[:-1]:
        first = at - at % FAN
        steps.append(("".join(level[first:at]), "".join(level[at + 1 : first + FAN])))
        at //= FAN
    return steps


def _levels_within(total: int, superblock: int) -> int:
    return min(depth(total), round(math.log(superblock, FAN)))


def _tops(nodes: DataFrame, superblock: int) -> DataFrame:
    """Each superblock of nodes (grp, pos, total, digest) as one node of the level it reduces to."""

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        total, first = int(rows["total"].iloc[0]), int(rows["pos"].iloc[0])
        levels = _levels_within(total, superblock)
        found = _reduced(rows["digest"].tolist(), levels)[-1]
        size = FAN**levels
        return pd.DataFrame({"grp": rows["grp"].iloc[0], "pos": [first // size], "total": [-(-total // size)], "digest": found})

    nodes = nodes.select("grp", "pos", "total", "digest")
    return nodes.groupBy("grp", F.expr(f"pos div {superblock}").alias("block")).applyInPandas(top, NODE)


def _proved(nodes: DataFrame, outer: DataFrame, extra: dict[str, str], finish, superblock: int) -> DataFrame:
    """Nodes cogrouped with the outer node of their superblock; `finish` makes the output rows.

    `outer` has grp, pos, steps and top: the way from a superblock's node to the last digest of its tree.
    """

    def prove(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if len(above) != 1 or not len(rows):
            raise RuntimeError("A superblock and its outer node have not met; write the leaves before proving them.")
        rows = rows.sort_values("pos")
        first = int(rows["pos"].iloc[0])
        levels = _reduced(rows["digest"].tolist(), _levels_within(int(rows["total"].iloc[0]), superblock))
        rest = [(step["before"], step["after"]) for step in above["steps"].iloc[0]]
        steps = [_steps(levels, pos - first) + rest for pos in rows["pos"].tolist()]
        return finish(rows, steps, above["subroot"].iloc[0], above["root"].iloc[0])

    block = F.expr(f"pos div {superblock}").alias("block")
    schema = ", ".join(f"{name} {kind}" for name, kind in extra.items())
    return nodes.groupBy("grp", block).cogroup(outer.groupBy("grp", F.col("pos").alias("block"))).applyInPandas(prove, schema)


OUTER = {"grp": "string", "pos": "bigint", "steps": f"array<{STEP}>", "subroot": "string", "root": "string"}


def _listed(steps: list) -> list:
    return [[{"before": before, "after": after} for before, after in own] for own in steps]


def _outer(rows: pd.DataFrame, steps: list, subroot: str, root: str) -> pd.DataFrame:
    return pd.DataFrame({"grp": rows["grp"], "pos": rows["pos"], "steps": _listed(steps), "subroot": subroot, "root": root})


def _climb(nodes: DataFrame, staging: Staging, name: str, superblock: int) -> list[DataFrame]:
    """The nodes of each level of superblocks, from the given one to one node a group."""
    levels, most = [nodes], nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        levels.append(staging.keep(_tops(levels[-1], superblock), f"{name}_{len(levels)}"))
        most = -(-most // FAN ** _levels_within(most, superblock))
    return levels


def _descend(levels: list[DataFrame], outer: DataFrame, staging: Staging, name: str, superblock: int) -> DataFrame:
    """The way to the root of every node of the second level (of the only one: `outer` itself)."""
    for at in range(len(levels) - 2, 0, -1):
        outer = staging.keep(_proved(levels[at], outer, OUTER, _outer, superblock), f"{name}_proofs_{at}")
    return outer


def _fold(digest: str, steps: list[tuple[str, str]]) -> str:
    for before, after in steps:
        digest = digest_of(before, digest, after)
    return digest


MANIFEST = {name: "string" for name in ("id_text", "leaf", "subroot", "root", "proof_sha256", "folded_root")}
MANIFEST["verified"] = "boolean"


def manifest(
    docs: DataFrame,
    *,
    doc_id="doc_id",
    group="lang",
    fields=("doc_id", "source", "lang", "n_chars", "text"),
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
    proofs=False,
    superblock=SUPERBLOCK,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of `docs`.

    `fields` make the leaf. A group's leaves ascend by doc_id, null first, equal ids by their digest
    (rows that agree in all fields are leaves of their own, next to each other). Groups are ordered bytewise, the
    null group first. A row's proof are the digests before and after its node, level by level up to the root;
    `proof_sha256` is the SHA-256 of all of them in that order, and with `proofs` they come too, as a list.
    `changed` gives other values to check a copy against the manifest, of rows that meet `where` (or of all): the
    leaf made with them is folded with the proof and must give the root. Other columns of `docs` play no
    part. An empty table has no rows and no root. `superblock` must be a power of eight. `docs` should come
    from a table or files.
    """
    if superblock < FAN or FAN ** round(math.log(superblock, FAN)) != superblock:
        raise ValueError("superblock must be a power of eight.")
    staging = Staging(docs.sparkSession, "merkle")
    values = {name: F.col(name) for name in fields}
    other = leaf_digest({**values, **changed}) if changed else F.lit(None).cast("string")
    leaves = docs.select(
        F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(group).cast("string"))).alias("grp"),
        F.col(doc_id).alias("sort_id"),
        leaf_digest(values).alias("digest"),
        (other if where is None else F.when(where, other)).alias("other"),
    )
    leaves = staging.keep(leaves, "leaves")
    levels = _climb(staging.keep(_positions(leaves, staging, "leaf"), "placed"), staging, "nodes", superblock)

    subroots = levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("sort_id"), "digest")
    top = _climb(staging.keep(_positions(subroots, staging, "subroot"), "subroots"), staging, "top", superblock)
    none = F.array().cast(f"array<{STEP}>").alias("steps")
    outer = top[-1].select("grp", "pos", none, F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    outer = _descend(top, outer, staging, "top", superblock)
    ways = _proved(top[0], outer, {"grp": "string", **{k: OUTER[k] for k in ("steps", "subroot", "root")}}, _ways, superblock)
    ways = staging.keep(ways.withColumn("pos", F.lit(0).cast("bigint")), "ways")

    outer = _descend(levels, ways, staging, "nodes", superblock)
    schema = {**MANIFEST, **({"proof": f"array<{STEP}>"} if proofs else {})}

    def finish(rows: pd.DataFrame, steps: list, subroot: str, root: str) -> pd.DataFrame:
        start = [digest if other is None else other for digest, other in zip(rows["digest"], rows["other"])]
        folded = [_fold(digest, own) for digest, own in zip(start, steps)]
        out = {
            "id_text": rows["id_text"],
            "leaf": rows["digest"],
            "subroot": subroot,
            "root": root,
            "proof_sha256": [digest_of(*(part for step in own for part in step)) for own in steps],
            "folded_root": folded,
            "verified": [found == root for found in folded],
        }
        if proofs:
            out["proof"] = _listed(steps)
        return pd.DataFrame(out)

    bottom = levels[0].withColumn("id_text", F.col("sort_id").cast("string")).drop("sort_id")
    proved = _proved(bottom, outer, schema, finish, superblock)
    return proved.select(F.col("id_text").cast(docs.schema[doc_id].dataType).alias(doc_id), *list(schema)[1:])


def _ways(rows: pd.DataFrame, steps: list, subroot: str, root: str) -> pd.DataFrame:
    """The upper tree's leaves are the subroots themselves."""
    out = _outer(rows, steps, subroot, root).drop(columns="pos")
    return out.assign(grp=rows["sort_id"], subroot=rows["digest"])
