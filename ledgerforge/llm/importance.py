"""Quality by importance resampling: hashed n-gram models of target and raw text.

Words and pairs of neighbouring words are hashed into BUCKETS. The raw model counts them over all documents, the target
model over the documents labelled good. A document's weight is the log of the ratio of its likelihoods under the
two models, summed over its n-grams. Adding Gumbel noise and keeping the largest
sums draws documents without replacement, in proportion to their weights. The noise is a hash of
the id and a seed, so a retried task draws the same. Sums grow with the text and have no bound; they
are ordered by the bits of the double.

Each task sends one row per bucket it met. The cut of the top k is found without sorting the
corpus: the 64 bits of a sortable key are narrowed 16 at a time by histograms of at most 65,536
rows; k may be any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.llm.tasks import WordHashes, bounds, raw_texts, slices
from ledgerforge.sources.staging import Staging

BUCKETS = 10_000
SMOOTHING = 1.0
SEED = 17
DIGIT = 16  # bits of a key that one histogram settles


def _grams(texts: list[bytes | None], cache: WordHashes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, and the text of each."""
    documents = [(text or b"").lower().split() for text in texts]
    edges = bounds(map(len, documents))
    hashes = cache.of([word for document in documents for word in document])
    owner = np.repeat(np.arange(len(documents)), np.diff(edges))
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    pairs ^= pairs >> np.uint64(29)
    inside = owner[:-1] == owner[1:]
    grams = np.concatenate([hashes, pairs[inside]]) % np.uint64(buckets)
    return grams.astype(np.int64), np.concatenate([owner, owner[:-1][inside]])


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents (text, good) -> (bucket, raw, target)."""
        cache, raw, target = WordHashes(), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good, at = np.array(batch.column(1).to_pylist(), bool), 0
            for part in slices(raw_texts(batch.column(0))):
                grams, owner = _grams(part, cache, buckets)
                raw += np.bincount(grams, minlength=buckets)
                target += np.bincount(grams[good[at : at + len(part)][owner]], minlength=buckets)
                at += len(part)
        some = np.flatnonzero(raw)
        columns = [pa.array(x, pa.int64()) for x in (some, raw[some], target[some])]
        yield pa.record_batch(columns, names=["bucket", "raw", "target"])

    return run


def train(docs: DataFrame, good: Column, *, text="text", buckets=BUCKETS) -> np.ndarray:
    """Log ratio of the target and raw model for each bucket.

    `good` is a condition on `docs` that picks the target; null counts as not good. Without any target text all
    ratios are zero. The driver receives at most `buckets` rows.
    """
    rows = (
        docs.select(text, F.coalesce(good, F.lit(False)).alias("good"))
        .mapInArrow(_count(buckets), "bucket bigint, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    counts = np.zeros((2, buckets))
    for row in rows:
        counts[:, row.bucket] = row.target, row.raw
    if not counts[0].any():
        return np.zeros(buckets)
    target, raw = counts + SMOOTHING
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weight(text: Column, ratios: np.ndarray) -> Column:
    """Log importance weight of a text; zero without words (and for null)."""

    @F.arrow_udf(T.DoubleType())
    def weights(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = WordHashes()
        for texts in batches:
            sums = [np.empty(0)]
            for part in slices(raw_texts(texts)):
                grams, owner = _grams(part, cache, len(ratios))
                sums.append(np.bincount(owner, ratios[grams], minlength=len(part)))
            yield pa.array(np.concatenate(sums), pa.float64())

    return weights(text)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise that depends on the id and the seed only."""
    unit = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(unit))


@F.arrow_udf(T.LongType())
def sortable(values: pa.Array) -> pa.Array:
    """An integer that orders like the double, of any size and to its last bit."""
    bits = (values.to_numpy(zero_copy_only=False) + 0.0).view(np.int64)  # -0.0 + 0.0 is 0.0
    return pa.array(bits ^ (bits >> np.int64(63)) & np.int64((1 << 63) - 1), pa.int64())


def top_share(scored: DataFrame, key: str, share: float) -> DataFrame:
    """`scored` (a written table) with `kept`: true for the ceil(share * rows) largest keys.

    `key` is a bigint column. Equal keys at the cut are kept or dropped by a second, unique
    column, `tie`, the smaller first.
    """
    total = scored.count()
    left = int(np.ceil(share * total))
    if left <= 0 or left >= total:
        return scored.withColumn("kept", F.lit(left > 0))

    def narrowed(rows: DataFrame, column: Column, left: int) -> tuple[int, int]:
        """The left-th largest value of a bigint column, and how many rows with it are wanted."""
        flipped, prefix = column.bitwiseXOR(F.lit(-(1 << 63))), 0  # orders as unsigned
        for shift in range(64 - DIGIT, -1, -DIGIT):
            if shift < 64 - DIGIT:
                rows = rows.filter(F.shiftrightunsigned(flipped, shift + DIGIT) == prefix)
            digit = F.shiftrightunsigned(flipped, shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
            counts = sorted(rows.groupBy(digit.alias("digit")).count().collect(), reverse=True)
            for value, count in counts:
                if count >= left:
                    break
                left -= count
            prefix = prefix << DIGIT | value
        return prefix - (1 << 63), left

    cut, wanted = narrowed(scored, F.col(key), left)
    at_cut = scored.filter(F.col(key) == cut)
    last = -narrowed(at_cut, -F.col("tie"), wanted)[0]
    above = (F.col(key) > cut) | ((F.col(key) == cut) & (F.col("tie") <= last))
    return scored.withColumn("kept", above)


def resample(
    docs: DataFrame, ratios: np.ndarray, share: float, *, doc_id="doc_id", text="text", seed=SEED
) -> DataFrame:
    """(doc_id, log_weight, noise, kept) for every row of `docs`; `share` of the rows are kept.

    Rows with equal ids (or null ones) share one draw of noise. Equal sums at the cut, which such rows may
    have, are settled by row number.
    """
    scored = docs.select(
        F.col(doc_id).alias("doc_id"), log_weight(F.col(text), ratios).alias("log_weight"), gumbel(F.col(doc_id), seed).alias("noise")
    )
    scored = scored.withColumn("key", sortable(F.col("log_weight") + F.col("noise"))).withColumn(
        "tie", F.monotonically_increasing_id()
    )
    scored = Staging(docs.sparkSession, "importance").keep(scored, "scored")
    return top_share(scored, "key", share).select("doc_id", "log_weight", "noise", "kept")
