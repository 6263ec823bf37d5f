"""Substring dedup over words: suffix automata of reference shards, streamed for matching statistics.

A document is its sequence of words. A window of WINDOW words is repeated when the same words
also start earlier: in a document with a smaller id, or earlier in the same one. Every word inside a repeated
window is removed.

The reference of each document is all text before it, which no broadcast can hold. So the reference is
cut into shards by content. The smallest hash among the GRAM-word runs of a window is its
anchor; equal windows have equal anchors, and the windows in a row that share one make a piece, at most
2 * WINDOW - GRAM words (or several, if they are more than a place can count). Pieces meet by anchor:

1. Each task reports its pieces as hashes, one row with the first place for each distinct (anchor, content)
   in a block of documents. The block's other places of it are repeated for certain and travel by document,
   so a piece that fills the corpus is one row per block here. Sorted by anchor, content and place, the rows say
   which pieces are the first with their content; all windows of the others are repeated.
2. First pieces that share an anchor with different content are cut from the texts and sent to the anchor's shard. The
   shard's suffix automaton grows in the order of places: each piece is streamed through it for
   matching statistics (the longest suffix at each word that was seen before); windows that a match of WINDOW
   words covers are repeated, and the others are added to the automaton.
3. An anchor with more than SPLIT different pieces is no shard: its windows are keyed by their own
   content, so that a passage in very many surroundings spreads over all tasks.
4. The repeated windows of a document are joined with its text and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.llm.tasks import RollingHash, WordHashes, bounds, merged_runs, raw_texts, slices
from ledgerforge.sources.staging import Staging

WINDOW = 20
GRAM = 5
SPLIT = 256
BLOCK_ROWS = 200_000  # distinct pieces of a block of documents
NO_ID = (1 << 63) - 1  # stands for a null id: after all others


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value in each run of `width`, the last one of equals."""
    place = np.arange(len(values))
    best, span = place, 1
    while span < width:  # runs of `span` values, doubled until they cover `width` with overlap
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] < values[right], left, right)
        span += step
    return best


def _pieces(documents: list[list[bytes]], cache: WordHashes, window: int, gram: int) -> list[np.ndarray]:
    """All pieces of some documents: owner, anchor, content hash, first window, number of windows.

    The hashes of a piece's first and last window cover all its words. No two windows of one
    piece are equal: the later one would have taken the anchor's repeat, being the last of equals.
    More than MOST_WINDOWS windows that share an anchor are several pieces, cut at equal distances from
    the first, so that equal runs are cut alike.
    """
    edges = bounds(map(len, documents))
    rolling = RollingHash(cache.of([word for document in documents for word in document]))
    owner = np.repeat(np.arange(len(documents)), np.diff(edges))
    windows, grams = rolling.runs(window), rolling.runs(gram)
    inside = np.flatnonzero(owner[: len(windows)] == owner[window - 1 :][: len(windows)])
    if not len(inside):
        return [np.empty(0, np.int64)] * 5
    anchors = _smallest(grams, window - gram + 1)[inside]
    first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    if window - gram + 1 > MOST_WINDOWS:
        since = np.arange(len(anchors)) - np.repeat(first, np.diff(np.r_[first, len(anchors)]))
        first = np.flatnonzero(since % MOST_WINDOWS == 0)
    last = np.r_[first[1:], len(anchors)] - 1
    count = last - first + 1
    mixed = windows[inside[first]] * np.uint64(0x9E3779B97F4A7C15) + windows[inside[last]] * np.uint64(0xC2B2AE3D27D4EB4F)
    content = mixed ^ (mixed >> np.uint64(31)) ^ count.astype(np.uint64)
    at = inside[first]
    return [owner[at], grams[anchors[first]].view(np.int64), content.view(np.int64), at - edges[owner[at]], count]


# A place is (doc, at); at holds the first window, the number of windows and some bits of the
# text's hash, which tell apart rows with equal ids. It orders by the first window.
COUNT_BITS, TEXT_BITS = 5, 27
MOST_WINDOWS = (1 << COUNT_BITS) - 1  # of one piece


def _at(start: np.ndarray, count: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
    return start << (COUNT_BITS + TEXT_BITS) | count << TEXT_BITS | text_hash


def _windows_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return at >> (COUNT_BITS + TEXT_BITS), at >> TEXT_BITS & ((1 << COUNT_BITS) - 1)


def _report(window: int, gram: int):
    """Documents (doc, text_hash, text) -> first places of the distinct pieces of a block, by anchor.

    Rows without an anchor hold the other places in one document, as little-endian 64-bit numbers; they go
    by document. (As a list they would make the step from rows to Arrow several times as slow.)
    """

    def block(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        anchor, content, doc, at = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((at, doc, content, anchor))
        anchor, content, doc, at = anchor[order], content[order], doc[order], at[order]
        same = np.r_[False, (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])]
        twin = np.r_[False, (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])] & same  # a repeated row
        anchor, content, doc, at, same = (x[~twin] for x in (anchor, content, doc, at, same))
        first = [x[~same] for x in (anchor, anchor, content, doc, at)]
        order = np.argsort(doc[same], kind="stable")
        later, places = doc[same][order], at[same][order]
        starts = np.flatnonzero(np.r_[True, later[1:] != later[:-1]]) if len(later) else np.empty(0, np.int64)
        owners, nothing = later[starts], [None] * len(starts)
        edges = np.r_[starts, len(later)].astype(np.int32) * np.int32(places.itemsize)
        packed = pa.py_buffer(np.ascontiguousarray(places, "<i8").tobytes())
        own = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges.tobytes()), packed])
        columns = [
            pa.concat_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())])
            for x, y in zip(first, (owners, nothing, nothing, owners, nothing))
        ]
        columns.append(pa.concat_arrays([pa.nulls(len(first[0]), own.type), own]))
        return pa.record_batch(columns, names=["route", "anchor", "content", "doc", "at", "ats"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, parts, rows = WordHashes(), [], 0
        for batch in batches:
            ids, hashes, done = batch.column(0).to_numpy(), batch.column(1).to_numpy(), 0
            for texts in slices(raw_texts(batch.column(2))):
                owner, anchor, content, start, count = _pieces([(t or b"").split() for t in texts], cache, window, gram)
                owner = owner + done
                parts.append([anchor, content, ids[owner], _at(start, count, hashes[owner])])
                done, rows = done + len(texts), rows + len(anchor)
                if rows >= BLOCK_ROWS:
                    yield block(parts)
                    parts, rows = [], 0
        if rows:
            yield block(parts)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by anchor, content and place -> repeated places, and first pieces of contested anchors.

    `number` counts the different contents of an anchor; it is null for a place all of whose
    windows are repeated. Only the row before is remembered, however many rows an anchor has.
    """
    open_anchor = open_content = first = waiting = None
    number = 0
    for batch in batches:
        anchor = batch.column("anchor").fill_null(0).to_numpy()
        lone = np.ones(len(anchor), bool)
        lone[1:] &= anchor[1:] != anchor[:-1]
        lone[:-1] &= anchor[1:] != anchor[:-1]
        lone[[0, -1]] = False  # its group may reach into another batch
        lone &= batch.column("anchor").is_valid().to_numpy(zero_copy_only=False)
        out = []
        for row in batch.take(pa.array(np.flatnonzero(~lone))).to_pylist():
            if row["anchor"] is None:
                out += [(row["doc"], at, None, None) for at in np.frombuffer(row["ats"], "<i8").tolist()]
                continue
            place = (row["doc"], row["at"])
            if row["anchor"] != open_anchor:
                open_anchor, open_content, number = row["anchor"], row["content"], 1
                first = waiting = place
            elif row["content"] != open_content:
                open_content, first, number = row["content"], place, number + 1
                if waiting:
                    out.append((*waiting, open_anchor, 1))
                    waiting = None
                out.append((*place, open_anchor, number))
            elif place != first:
                out.append((*place, None, None))
        columns = list(zip(*out)) or [()] * 4
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc", "at", "anchor", "number"])


class SuffixAutomaton:
    """All runs of symbols of the texts added so far."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _new(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, state: int, symbol, to: int) -> int:
        """The part of `to` that a move from `state` may mean, as a state of its own."""
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._new(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while state >= 0 and self.next[state].get(symbol) == to:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def add(self, text: list) -> None:
        last = 0
        for symbol in text:
            to = self.next[last].get(symbol)
            if to is not None:
                last = self._split(last, symbol, to)
                continue
            new, state = self._new(self.length[last] + 1, {}, 0), last
            while state >= 0 and symbol not in self.next[state]:
                self.next[state][symbol] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, symbol, self.next[state][symbol])
            last = new

    def matching_statistics(self, text: list) -> list[int]:
        """For each symbol, the length of the longest suffix up to it that was added."""
        state, size, out = 0, 0, []
        for symbol in text:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                size += 1
            out.append(size)
        return out


def repeated_in_shard(automaton: SuffixAutomaton, words: list[bytes], window: int) -> np.ndarray:
    """Which windows of a piece are repeated; the others become part of the reference."""
    repeated = np.array(automaton.matching_statistics(words)[window - 1 :]) >= window
    fresh = np.flatnonzero(~repeated)
    for start, stop in merged_runs(fresh, 1):
        automaton.add(words[start : stop + window - 1])
    return repeated


def _stream(window: int):
    """Pieces (anchor, doc, at, words) sorted by anchor and place -> places of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_anchor, shard = None, SuffixAutomaton()
        for batch in batches:
            docs, places = [], []
            for row in batch.to_pylist():
                if row["anchor"] != open_anchor:
                    open_anchor, shard = row["anchor"], SuffixAutomaton()
                repeated = np.flatnonzero(repeated_in_shard(shard, row["words"].split(), window))
                start, _ = _windows_of(row["at"])
                for first, stop in merged_runs(repeated, 1).tolist():
                    docs.append(row["doc"])
                    places.append(_at(start + first, stop - first, row["at"] & ((1 << TEXT_BITS) - 1)))
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(places, pa.int64())], names=["doc", "at"])

    return run


PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("anchor", T.LongType()),
            T.StructField("at", T.LongType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("content", T.BinaryType()),
        ]
    )
)


def _cut(window: int):
    @F.arrow_udf(PIECES)
    def cut(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        """Words of the wanted pieces; of an anchor to be split, the content hash of each window."""
        out = []
        for text, pieces in zip(raw_texts(texts), wanted.to_pylist()):
            words, own = text.split(), []
            for piece in pieces:
                start, count = _windows_of(piece["at"])
                if not piece["split"]:
                    own.append((piece["anchor"], piece["at"], b" ".join(words[start : start + count + window - 1]), None))
                    continue
                for at in range(start, start + count):
                    content = xxhash.xxh3_128_digest(b" ".join(words[at : at + window]))
                    place = _at(at, 1, piece["at"] & ((1 << TEXT_BITS) - 1))
                    own.append((None, place, None, content))
            out.append([dict(zip(("anchor", "at", "words", "content"), row)) for row in own])
        kind = [("anchor", pa.int64()), ("at", pa.int64()), ("words", pa.binary()), ("content", pa.binary())]
        return pa.array(out, pa.list_(pa.struct(kind)))

    return cut


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit((1 << TEXT_BITS) - 1))


def _by_document(places: DataFrame, value: Column, name: str) -> DataFrame:
    own = F.col("at").bitwiseAND(F.lit((1 << TEXT_BITS) - 1)).alias("text_hash")
    return places.groupBy("doc", own).agg(F.collect_list(value).alias(name))


def repeated_windows(docs: DataFrame, staging: Staging, *, window=WINDOW, gram=GRAM) -> DataFrame:
    """Places (doc, at) of repeated windows of `docs` (doc, text_hash, text)."""
    reported = docs.mapInArrow(
        _report(window, gram),
        "route bigint, anchor bigint, content bigint, doc bigint, at bigint, ats binary",
    )
    settled = (
        reported.repartition("route")
        .sortWithinPartitions("anchor", "content", "doc", "at")
        .mapInArrow(_settle, "doc bigint, at bigint, anchor bigint, number bigint")
    )
    settled = staging.keep(settled, "settled")
    contested = settled.filter("number is not null")
    sizes = contested.groupBy("anchor").agg((F.max("number") > SPLIT).alias("split"))
    wanted = contested.join(staging.keep(sizes, "sizes"), "anchor")
    wanted = _by_document(wanted, F.struct("anchor", "at", "split"), "wanted")
    cut = docs.join(wanted, ["doc", "text_hash"]).select(
        "doc", "text_hash", F.explode(_cut(window)(F.col("text"), F.col("wanted"))).alias("piece")
    )
    cut = staging.keep(cut.select("doc", "piece.*").distinct(), "cut")  # repeated rows were cut twice
    streamed = (
        cut.filter("words is not null")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc", "at")
        .mapInArrow(_stream(window), "doc bigint, at bigint")
    )
    split = cut.filter("content is not null").select("content", "doc", "at")
    first = split.groupBy("content").agg(F.min(F.struct("doc", "at")).alias("first"))
    later = split.join(staging.keep(first, "first"), "content").filter(F.struct("doc", "at") > F.col("first"))
    return settled.filter("number is null").select("doc", "at").union(streamed).union(later.select("doc", "at"))


KEPT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("kept", T.StringType()),
    ]
)


def _keep(window: int):
    @F.arrow_udf(KEPT)
    def keep(texts: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for text, places in zip(raw_texts(texts), removed.to_pylist()):
            words = (text or b"").split()
            gone, spans = np.zeros(len(words), bool), np.empty((0, 2), np.int64)
            if places:
                start, count = _windows_of(np.sort(np.array(places, np.int64)))
                spans = merged_runs(start, count + window - 1)
                for first, stop in spans:
                    gone[first:stop] = True
                words = [words[i] for i in np.flatnonzero(~gone)]
            out.append(
                {
                    "n_words": len(gone),
                    "n_removed": int(gone.sum()),
                    "spans": spans.tolist(),
                    "kept": b" ".join(words).decode(),
                }
            )
        kind = [("n_words", pa.int64()), ("n_removed", pa.int64())]
        kind += [("spans", pa.list_(pa.list_(pa.int32()))), ("kept", pa.string())]
        return pa.array(out, pa.struct(kind))

    return keep


def without_repeated_windows(docs: DataFrame, *, doc_id="doc_id", text="text", window=WINDOW, gram=GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) for every row of `docs`.

    Words are runs of other characters than ASCII white space; `spans` are the removed [start, stop) in words,
    `kept` the other words joined by one space. Null texts have no words. Rows that agree in id and text are
    one document. Rows with equal ids and other texts are documents of their own, ordered by the position
    of the window and then by a hash of the text. A null id comes after all others.
    """
    staging = Staging(docs.sparkSession, "substrings")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("doc"),
        _text_hash(F.col(text)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    places = repeated_windows(rows.drop("doc_id"), staging, window=window, gram=gram)
    removed = staging.keep(_by_document(places, F.col("at"), "removed"), "removed")
    joined = rows.join(removed, ["doc", "text_hash"], "left")
    kept = joined.select("doc_id", _keep(window)(F.col("text"), F.col("removed")).alias("k")).select("doc_id", "k.*")
    return kept.withColumnRenamed("doc_id", doc_id)
