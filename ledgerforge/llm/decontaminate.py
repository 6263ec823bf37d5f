"""Benchmark decontamination: a broadcast set of normalised test n-grams against token windows.

Words are runs of letters and digits after lower-casing A-Z; bytes of non-ASCII characters count
as letters, so everything works on UTF-8 bytes. The benchmark's windows are hashed into a set
that goes to every task; each task hashes the windows of its documents, looks them up, and
compares the words themselves for every hit. Documents never leave their task: no shuffle.

The set is bounded: a benchmark above BLOCK_BYTES is cut into blocks by a hash of the item, and
each block scans the documents in turn, adding to the hits so far. Items are collected one block
at a time, so the driver holds one block's texts.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.llm.columns import free_name
from ledgerforge.llm.tasks import RollingHash, WordHashes, bounds, merged_runs, raw_texts, slices

WINDOW = 13
BLOCK_BYTES = 32 << 20
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
CONTAMINATED_SHARE = 20  # one hit word in this many contaminates a document

# A-Z to a-z, everything else that is no digit, letter or non-ASCII byte to a space.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


class NgramSet:
    """Windows of benchmark items: exact words behind a hash filter, by window length."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = normal_words(text)
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                self.by_length[size][tuple(words[at : at + size])].add(item)
        hashes = WordHashes()
        self.filters = {}
        for size, grams in self.by_length.items():
            bits = max(16, (64 * len(grams)).bit_length())
            table = np.zeros(1 << bits, bool)
            for gram in grams:
                table[RollingHash(hashes.of(list(gram))).runs(size) >> np.uint64(64 - bits)] = True
            self.filters[size] = (np.uint64(64 - bits), table)
        self.by_length = {size: dict(grams) for size, grams in self.by_length.items()}

    def hits(self, words: list[bytes], hashes: np.ndarray) -> list[tuple[int, int, set]]:
        """(position, window length, items) of every verified window, texts being end to end."""
        found, rolling = [], RollingHash(hashes)
        for size, (shift, table) in self.filters.items():
            grams = self.by_length[size]
            for at in np.flatnonzero(table[rolling.runs(size) >> shift]).tolist():
                items = grams.get(tuple(words[at : at + size]))
                if items is not None:
                    found.append((at, size, items))
        return sorted(found, key=lambda hit: hit[:2])


def _scan(ngrams: NgramSet):
    """Arrow function: texts and the hits of earlier blocks -> hits."""

    @F.arrow_udf(HITS)
    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        cache, out = WordHashes(), []
        earlier = before.to_pylist()
        for part in slices(raw_texts(texts)):
            documents = [normal_words(text) for text in part]
            edges = bounds(map(len, documents))
            words = [word for document in documents for word in document]
            by_document = defaultdict(list)
            for at, size, items in ngrams.hits(words, cache.of(words)):
                document = int(np.searchsorted(edges, at, "right")) - 1
                if at + size <= edges[document + 1]:
                    by_document[document].append((at - int(edges[document]), size, items))
            for document, own in enumerate(documents):
                hits = by_document.get(document, ())
                old = earlier[len(out)] or {"spans": (), "items": ()}
                spans = [(s["start"], s["stop"]) for s in old["spans"]] + [(at, at + size) for at, size, _ in hits]
                spans = np.array(sorted(spans), np.int64).reshape(-1, 2)
                items = set(old["items"]).union(*(items for *_, items in hits)) - {None}
                out.append(
                    {
                        "n_words": len(own),
                        "spans": [
                            {"start": a, "stop": b} for a, b in merged_runs(spans[:, 0], spans[:, 1] - spans[:, 0]).tolist()
                        ],
                        "items": sorted(items),
                    }
                )
        return pa.array(
            out,
            pa.struct(
                [
                    ("n_words", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                    ("items", pa.list_(pa.string())),
                ]
            ),
        )

    return scan


def benchmark_hits(text: Column, benchmark: DataFrame, *, item_id="item_id", item_text="text", window=WINDOW) -> Column:
    """struct(n_words, spans, items): hit word spans [start, stop) and the ids of items that occur.

    An item of `window` words or more occurs through any window of that many consecutive words;
    a shorter one through all its words in a row; one without words never. Null text: no words.
    Items with a null id mark spans but are not listed; repeated items count once. An empty
    benchmark gives no hits.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("words")).dropna(
        subset=["words"]
    )
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    hits = F.lit(None).cast(HITS)
    for number in range(blocks):
        rows = items.filter(block == number).collect()
        hits = _scan(NgramSet([(r.item, r.words.encode()) for r in rows], window))(text, hits)
    return hits


def hit_words(hits: Column) -> Column:
    return F.aggregate(hits["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


def is_contaminated(hits: Column) -> Column:
    n = hit_words(hits)
    return (n > 0) & (n * CONTAMINATED_SHARE >= hits["n_words"])


@F.arrow_udf(T.StringType())
def without_spans(texts: pa.Array, hits: pa.Array) -> pa.Array:
    """Cut the hit words, and what stands between them, from the original text."""
    out = []
    for text, hit in zip(raw_texts(texts), hits.to_pylist()):
        if text is None or not hit["spans"]:
            out.append(text)
            continue
        starts, stops, at, folded = [], [], 0, text.translate(NORMAL)
        for word in folded.split():
            at = folded.index(word, at)
            starts.append(at)
            at += len(word)
            stops.append(at)
        kept, last = [], 0
        for span in hit["spans"]:
            kept.append(text[last : starts[span["start"]]])
            last = stops[span["stop"] - 1]
        out.append(b"".join([*kept, text[last:]]))
    return pa.array(out, pa.binary()).cast(pa.string())


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text="text", remove="documents", window=WINDOW
) -> DataFrame:
    """`docs` with contaminated documents removed, or (remove="spans") with the hit words cut out.

    Documents with a null or empty text stay as they are. Columns and repeated rows are kept.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"Unknown removal: {remove}")
    columns = docs.columns
    marker = free_name(columns)
    marked = docs.withColumn(marker, benchmark_hits(F.col(text), benchmark, window=window))
    if remove == "documents":
        return marked.filter(~is_contaminated(F.col(marker))).select(columns)
    return marked.withColumn(text, without_spans(F.col(text), F.col(marker))).select(columns)
