"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits. Two fingerprints that
differ in at most two bits agree in at least one segment, and differ in at most two bits in
every other. The binary Golay code of length 23 is perfect: each word of 23 bits lies within
three bits of exactly one codeword. Keying a segment by its codeword, and, where that is three
bits off, also by the five codewords four bits off, gives any two words within two bits of each
other a common key. A join key is (which segment agrees, its bits, one codeword index of the
next segment): about 34 bits, at most 18 keys for a fingerprint. Pairs that share a key are
compared bit by bit; only verified links leave the join.

Exact copies meet before that: the join sees each distinct fingerprint once. Links per
fingerprint are bounded by the number of words within two bits (2,080), whatever the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.llm.components import connected_components
from ledgerforge.llm.columns import free_name
from ledgerforge.llm.tasks import raw_texts
from ledgerforge.sources.staging import Staging

SEED = 42
SHINGLE = 3
MOST_BITS = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, width)

# Fixed value: generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011
LENGTH, CHECK_BITS = 23, 11


def _fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # of bytes: lowers A-Z, splits at 0x20 and 0x09-0x0D
    count = len(words) - shingle + 1
    if not words:
        return 0
    if count < 2:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: count - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(count, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > count
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    """64-bit fingerprint (as a signed long) of the shingles of a text.

    Words are runs of other characters than ASCII white space, A-Z lower-cased. A bit is set if
    it is set in over half the shingles' XXH64 hashes, repeats counted. Fewer words than a
    shingle: the whole sequence is one shingle. No words, or null: zero.
    """

    @F.arrow_udf(T.LongType())
    def fingerprints(texts: pa.Array) -> pa.Array:
        values = [_fingerprint(text or b"", shingle) for text in raw_texts(texts)]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return fingerprints(text)


def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - CHECK_BITS), 0)
    return rest


def _error_patterns() -> np.ndarray:
    """Syndrome -> the one error of at most three bits that causes it."""
    ones = [1 << i for i in range(LENGTH)]
    errors = {0} | {a | b | c for a in ones for b in ones for c in ones}
    errors = np.array(sorted(errors), np.int64)
    table = np.zeros(1 << CHECK_BITS, np.int64)
    table[_syndromes(errors)] = errors
    return table


class GolayIndex:
    def __init__(self):
        self.errors = _error_patterns()
        self.weight = np.array([bin(e).count("1") for e in self.errors])

    def keys(self, words: np.ndarray) -> np.ndarray:
        """Codeword indices near each word: one row per word, repeats where fewer than all differ."""
        words = words.astype(np.int64)
        syndrome = _syndromes(words)
        nearest = words ^ self.errors[syndrome]
        out = [nearest]
        far = self.weight[syndrome] == 3  # otherwise no codeword is four bits off
        for bit in range(LENGTH):
            flipped = words ^ (1 << bit)
            out.append(np.where(far, flipped ^ self.errors[_syndromes(flipped)], nearest))
        return np.stack(out, axis=1) >> CHECK_BITS


@F.arrow_udf(T.ArrayType(T.LongType()))
def golay_keys(fingerprints: pa.Array) -> pa.Array:
    """Join keys of each fingerprint; two within two bits of each other share at least one."""
    values = fingerprints.to_numpy(zero_copy_only=False).view(np.uint64)
    index = GolayIndex()
    segments = [
        ((values >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS
    ]
    keys = []
    for exact in range(3):
        near = index.keys(segments[(exact + 1) % 3])
        keys.append((exact << 34) | (segments[exact] << 12)[:, None] | near)
    keys = np.sort(np.concatenate(keys, axis=1), axis=1)
    fresh = np.ones(keys.shape, bool)
    fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum(fresh.sum(axis=1), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[fresh]))


def fingerprint_links(fingerprints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Links (a, b), a < b, between the distinct values of the column `fingerprint`."""
    if most_bits > MOST_BITS:
        raise ValueError(f"The keys guarantee links of up to {MOST_BITS} bits.")
    keyed = fingerprints.select("fingerprint", F.explode(golay_keys("fingerprint")).alias("key"))
    left = keyed.select(F.col("key").alias("key_a"), F.col("fingerprint").alias("a"))
    right = keyed.select(F.col("key").alias("key_b"), F.col("fingerprint").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits
    met = (F.col("key_a") == F.col("key_b")) & (F.col("a") < F.col("b")) & near
    return left.join(right, met).select("a", "b")


def simhash_components(
    docs: DataFrame, *, doc_id="doc_id", text="text", shingle=SHINGLE, most_bits=MOST_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`, repeated rows included.

    component_id is the smallest doc_id reachable over links of at most `most_bits` differing
    bits. Rows without an id have a fingerprint and a null component, and link nothing.
    """
    staging = Staging(docs.sparkSession, "simhash")
    rows = staging.keep(
        docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text), shingle).alias("fingerprint")), "rows"
    )
    nodes = staging.keep(
        rows.dropna(subset=["doc_id"]).groupBy("fingerprint").agg(F.min("doc_id").alias("low")), "nodes"
    )
    classes = connected_components(fingerprint_links(nodes, most_bits), staging)
    placed = nodes.join(classes.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "low", F.coalesce("component", "fingerprint").alias("component")
    )
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    named = staging.keep(placed.join(lowest, "component").select("fingerprint", "component_id"), "named")
    return rows.join(named, "fingerprint", "left").select(
        "doc_id",
        "fingerprint",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def without_near_duplicates(docs: DataFrame, *, doc_id="doc_id", text="text", **options) -> DataFrame:
    """`docs` with one document of each component: the one with the smallest id.

    Of several rows with that id one stays, the smallest by text. Rows without an id all stay.
    """
    columns = docs.columns
    ids = simhash_components(docs, doc_id=doc_id, text=text, **options)
    kept = ids.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(doc_id)).distinct()
    place = free_name(columns)
    first = Window.partitionBy(doc_id).orderBy(F.col(text).asc_nulls_last())
    named = docs.filter(F.col(doc_id).isNotNull()).join(kept, doc_id, "left_semi")
    named = named.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1)
    return named.select(columns).unionByName(docs.filter(F.col(doc_id).isNull()))
