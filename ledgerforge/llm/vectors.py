"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Vectors are compared inside their group only. Each is scaled to unit length and quantised to int8 steps with a scale of its own; e is the
length of what quantisation lost. For two unit vectors x and y with quantised parts p and q,
|x.y - p.q| <= |e_x| |y| + |p| |e_y| <= e_x + (1 + e_x) e_y, so a pair whose int8 product plus this bound (and a
margin for rounding) stays below the threshold cannot be linked. The other pairs are recomputed from
the original components in double precision; only those decide.

Exact copies are counted first and compared as one. A group is cut into blocks of about
BLOCK rows by hash, and each pair of blocks is one tile, so a large group spreads over many tasks
and no task holds more than two blocks. A tile reports, per vector, how many links it found, and a
spanning forest of them: two rows per vector at most, never a row per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.components import connected_components
from ledgerforge.sources.staging import Staging

THRESHOLD = 0.93
BLOCK = 4096
STRIPE = 512  # rows multiplied at a time
STEPS = 127  # int8 steps on either side of zero
ROUNDING = 1e-6  # above the rounding of all sums in double precision


def usable(vector: Column) -> Column:
    """Not null, with a direction, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = rows.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    table = flat.reshape(-1, width)
    table = table / np.abs(table).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    return table / np.sqrt((table * table).sum(axis=1, keepdims=True))


class Quantised:
    def __init__(self, unit: np.ndarray):
        scale = np.abs(unit).max(axis=1, keepdims=True) / STEPS
        self.steps = np.rint(unit / scale).astype(np.int8)
        self.scale = scale[:, 0]
        lost = unit - self.steps * scale
        self.error = np.sqrt((lost * lost).sum(axis=1)) + ROUNDING


def possible_pairs(left: Quantised, right: Quantised, threshold: float, lines: slice) -> tuple[np.ndarray, np.ndarray]:
    """Rows of both sides whose cosine may reach the threshold, for some lines of the left side.

    Products of int8 steps are integers that single precision holds exactly up to 2**24 (about
    1,000 components); wider vectors are multiplied in double precision.
    """
    kind = np.float32 if left.steps.shape[1] * STEPS * STEPS < 1 << 24 else np.float64
    product = left.steps[lines].astype(kind) @ right.steps.T.astype(kind)
    error = left.error[lines]
    estimate = product * left.scale[lines, None] * right.scale
    bound = error[:, None] + (1 + error[:, None]) * right.error
    rows, columns = np.nonzero(estimate + bound >= threshold - ROUNDING)
    return rows + lines.start, columns


class Forest:
    """Union-find over row numbers; the links that joined two trees are its edges."""

    def __init__(self, count: int):
        self.parent, self.edges = list(range(count)), []

    def root(self, node: int) -> int:
        while self.parent[node] != node:
            self.parent[node] = node = self.parent[self.parent[node]]
        return node

    def link(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((a, b))


def _tile(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        """Rows of one or two blocks -> (node, links) of vectors with links, and (node, other) forest edges."""
        nodes = rows.column("node").to_numpy()
        copies = rows.column("copies").to_numpy()
        side = rows.column("side").to_numpy()
        width = len(rows.column("vector")[0])
        unit = _unit(rows.column("vector"), width)
        at = [np.flatnonzero(side == s) for s in (0, 1)]
        own_block = not len(at[1])
        left, right = at[0], at[0] if own_block else at[1]
        links, forest = np.zeros(len(nodes), np.int64), Forest(len(nodes))
        if len(left) and len(right):
            coarse = Quantised(unit[left])
            other = coarse if own_block else Quantised(unit[right])
            for start in range(0, len(left), STRIPE):
                a, b = possible_pairs(coarse, other, threshold, slice(start, min(start + STRIPE, len(left))))
                if own_block:
                    a, b = a[a < b], b[a < b]
                for part in range(0, len(a), 1 << 18):
                    i, j = left[a[part : part + (1 << 18)]], right[b[part : part + (1 << 18)]]
                    sure = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                    i, j = i[sure], j[sure]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    for x, y in zip(i.tolist(), j.tolist()):
                        forest.link(x, y)
        some = np.flatnonzero(links)
        edges = np.array(forest.edges, np.int64).reshape(-1, 2)
        return pa.table(
            {
                "node": pa.array(np.r_[nodes[some], nodes[edges[:, 0]]], pa.int64()),
                "links": pa.array(np.r_[links[some], np.zeros(len(edges), np.int64)], pa.int64()),
                "other": pa.array([None] * len(some) + nodes[edges[:, 1]].tolist(), pa.int64()),
            }
        )

    return run


def near_vectors(
    vectors: DataFrame, *, vec_id="vec_id", vector="embedding", group="label", threshold=THRESHOLD, block=BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id) for every row; links join rows of one group.

    Rows link when their groups are equal and not null, both vectors are usable and as long, and the cosine
    in double precision is `threshold` or more. Other rows have no links and are their own component.
    Rows with equal ids are vectors of their own with the same id; a row with a null id links nothing.
    """
    staging = Staging(vectors.sparkSession, "vectors")
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"),
        F.col(group).alias("part"),
        F.when(usable(F.col(vector)) & F.col(group).isNotNull() & F.col(vec_id).isNotNull(), F.col(vector)).alias("vector"),
    )
    # Numbered once and written: the numbers are the nodes of the link graph.
    distinct = staging.keep(
        rows.dropna(subset=["vector"])
        .groupBy("part", "vector")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct",
    )
    sized = distinct.withColumn("width", F.size("vector"))
    blocks = F.ceil(F.count("*") / block).cast("int").alias("blocks")
    spans = staging.keep(sized.groupBy("part", "width").agg(blocks), "spans")
    keyed = sized.join(spans, ["part", "width"]).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    placed = keyed.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "part",
        "width",
        F.least("own", "partner").alias("low"),
        F.greatest("own", "partner").alias("high"),
        (F.col("own") > F.col("partner")).cast("int").alias("side"),
        "node",
        "copies",
        "vector",
    )
    found = placed.groupBy("part", "width", "low", "high").applyInArrow(
        _tile(threshold), "node bigint, links bigint, other bigint"
    )
    found = staging.keep(found, "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = connected_components(found.filter("other is not null").select("node", "other"), staging)
    placed = (
        distinct.join(links, "node", "left")
        .join(classes, "node", "left")
        .select(
            "part",
            "vector",
            "first",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    lowest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    classed = staging.keep(placed.join(lowest, "component").drop("component", "first"), "classed")
    return rows.join(classed, ["part", "vector"], "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
