"""Line dedup: deletion of later repeated runs of lines, prefiltered by winnowing over line hashes.

A document is its sequence of line hashes. Winnowing slides a window of `run` lines over it and
selects the smallest line hash in each, the first of equals, so any run of `run` lines that two places
share selects the same line at the same offset: the selected positions are fingerprints that no
shared run escapes. An aggregation counts the selected positions of each hash; windows whose
fingerprint is selected at one position only are dropped. The others are keyed by their whole content and
joined with the first place of that content. This takes the place of extending matches from
joined positions, which would pair the places of a frequent line with each other: the windows of a
longer match are all found by their own content, and overlapping ones delete it whole.

So a line goes if and only if some `run` consecutive lines around it also start earlier: in a
document with a smaller id, or earlier in the same document. With `words`, runs of fewer lines that hold
at least so many words are windows too, by the same rule. Content is compared by 128-bit hashes.
Both joins meet a table with one row per distinct key, built with map-side aggregation, so a
line that fills a third of the corpus is one aggregated row, and its places are spread by Spark's
skew join; positions are never paired with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.llm.columns import free_name
from ledgerforge.llm.tasks import bounds, raw_texts
from ledgerforge.sources.staging import Staging

RUN = 3
WORDS = 20  # that make a shorter run long enough, in the registered query and the pipeline

WINDOWS = T.ArrayType(
    T.StructType(
        [
            T.StructField("mark", T.LongType()),
            T.StructField("fresh", T.BooleanType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("content", T.BinaryType()),
        ]
    )
)


def _windows(text: bytes, run: int, words: int | None) -> list[tuple[int, bool, int, int, bytes]]:
    """(fingerprint, whether its position is selected anew, start, lines, content hash) of every window."""
    lines = text.split(b"\n")
    if words is None and len(lines) < run:
        return []
    digests = [xxhash.xxh3_128_digest(line) for line in lines]
    long = None if words is None else bounds(len(line.split()) for line in lines)
    out = []
    for size in range(run if words is None else 1, min(run, len(lines)) + 1):
        # Another seed for each size: windows of one size only are counted together.
        hashes = np.array([xxhash.xxh64_intdigest(line, run - size) for line in lines], np.uint64).view(np.int64)
        slid = np.lib.stride_tricks.sliding_window_view(hashes, size)
        selected = slid.argmin(axis=1) + np.arange(len(slid))
        starts = np.arange(len(slid))
        if words is not None:
            enough = long[size:] - long[:-size] >= words if size < run else np.ones(len(slid), bool)
            # Where each line is long enough alone, their own windows say the same.
            alone = np.lib.stride_tricks.sliding_window_view(np.diff(long) >= words, size).all(axis=1)
            starts = np.flatnonzero(enough & ~alone) if size > 1 else np.flatnonzero(enough)
        marks, fresh = hashes[selected[starts]].tolist(), np.r_[True, np.diff(selected[starts]) > 0][: len(starts)].tolist()
        for i, mark, new in zip(starts.tolist(), marks, fresh):
            out.append((mark, new, i, size, xxhash.xxh3_128_digest(b"".join(digests[i : i + size]))))
    return out


def line_windows(text: Column, run: int, words: int | None = None) -> Column:
    @F.arrow_udf(WINDOWS)
    def windows(texts: pa.Array) -> pa.Array:
        kind = pa.list_(
            pa.struct(
                [
                    ("mark", pa.int64()),
                    ("fresh", pa.bool_()),
                    ("start", pa.int32()),
                    ("size", pa.int32()),
                    ("content", pa.binary()),
                ]
            )
        )
        rows = [
            [{"mark": m, "fresh": f, "start": s, "size": n, "content": c} for m, f, s, n, c in _windows(text, run, words)]
            if text is not None
            else []
            for text in raw_texts(texts)
        ]
        return pa.array(rows, kind)

    return windows(text)


def shared_marks(places: DataFrame) -> DataFrame:
    """Fingerprints (mark) of `places` (mark, fresh) that are selected at more than one position."""
    return places.filter("fresh").groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")


def repeated_windows(places: DataFrame, staging: Staging) -> DataFrame:
    """Rows of `places` (mark, fresh, content, order columns `at`) whose content also starts earlier.

    `at` is a struct that orders places; equal places of equal content are the same place.
    """
    shared = staging.keep(shared_marks(places), "shared")  # a table of its own, so that Spark may split hot marks
    candidates = staging.keep(places.join(shared, "mark", "left_semi").drop("mark", "fresh"), "candidates")
    first = staging.keep(candidates.groupBy("content").agg(F.min("at").alias("first")), "first")
    return candidates.join(first, "content").filter("at > first")


def repeated_lines(docs: DataFrame, *, doc_id="doc_id", text="text", run=RUN, words=None) -> DataFrame:
    """(doc_id, text_hash, gone): positions of repeated lines, for documents that have any.

    Rows that agree in id and text are one document. Rows with equal ids but other texts are ordered by a
    hash of the text; a null id comes after all others.
    """
    staging = Staging(docs.sparkSession, "lines")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    if words is None and run > 1:
        rows = rows.filter(F.col("text").contains("\n"))
    places = rows.select("doc_id", "text_hash", F.explode(line_windows(F.col("text"), run, words)).alias("w")).select(
        F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", F.col("w.start").alias("start")).alias(
            "at"
        ),
        F.col("w.size").alias("size"),
        F.col("w.mark").alias("mark"),
        F.col("w.fresh").alias("fresh"),
        F.col("w.content").alias("content"),
    )
    repeated = repeated_windows(staging.keep(places, "places"), staging)
    covered = F.transform(F.collect_set(F.struct("start", "size")), lambda w: F.sequence(w["start"], w["start"] + w["size"] - 1))
    return (
        repeated.select("at.*", "size")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.array_distinct(F.flatten(covered))).alias("gone"))
    )


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, places in zip(raw_texts(texts), gone.to_pylist()):
        if text is not None and places:
            lines = text.split(b"\n")
            keep = np.ones(len(lines), bool)
            keep[places] = False
            text = b"\n".join(lines[i] for i in np.flatnonzero(keep))
        out.append(text)
    return pa.array(out, pa.binary()).cast(pa.string())


def without_repeated_lines(
    docs: DataFrame, *, doc_id="doc_id", text="text", run=RUN, words=None, removed=None
) -> DataFrame:
    """`docs` with later repeated runs of lines deleted from the text; no row is dropped.

    Lines are separated by "\\n" only; the kept lines are joined by it again. A document all of
    whose lines go has an empty text. Null and empty texts stay. A run is long enough with `run`
    lines or, if `words` is given, with so many words. `removed` names an optional column for the number
    of deleted lines.
    """
    columns = docs.columns
    found = repeated_lines(docs, doc_id=doc_id, text=text, run=run, words=words)
    taken = [*columns, removed or ""]
    names = {name: free_name(taken, f"_{name}") for name in found.columns}
    found = found.select([F.col(name).alias(own) for name, own in names.items()])
    gone = F.col(names["gone"])
    same = F.col(doc_id).eqNullSafe(F.col(names["doc_id"])) & (F.xxhash64(text) == F.col(names["text_hash"]))
    joined = docs.join(found, same, "left")
    if removed:
        joined = joined.withColumn(removed, F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("bigint"))
        columns = [*[c for c in columns if c.lower() != removed.lower()], removed]
    return joined.withColumn(text, _without(F.col(text), gone)).select(columns)
