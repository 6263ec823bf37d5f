"""Phrase collocations: word n-grams counted by weighted automata, united by prefix range, scored by their parts.

The counted unit is a window: the up to `longest` words of a piece that start at one word. A window
stands for all phrases that it begins with, so each word costs one entry and not one per phrase length.

1. Each task sorts the windows of a block of words, group by group, and builds an acyclic automaton from them in
   that order: a window adds only the states after the prefix that it shares with the one before.
   Each state weighs what passes through it. The block's automaton is cut at fixed windows, the bounds of prefix
   ranges, so that a frequent first word is spread over as many ranges as its windows fill.
2. The automata of one range are united: equal paths become one and weights add up. A state is a
   phrase, its weight the phrase's count. Only states on the path of a bound can go on in another range;
   they are reported in parts and added up afterwards, the others only if they are frequent.
3. Frequent phrases are composed with the same counts for the two parts of every cut, which are frequent too.

Bounds of ranges come from a bounded sample of windows (SAMPLE), and only decide which task counts
what; all counts are of all words. Above MOST_RANGES ranges, each is dealt further by a hash of a window's first
two words.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm.tasks import raw_texts
from ledgerforge.sources.staging import Staging

LONGEST, LEAST, TOP, ABSORB = 5, 100, 2000, 100
NO_GROUP = "und"
BLOCK_WORDS = 2 << 20
CHUNK_BYTES = 4 << 20  # of a text, cut into words in one step
RANGE_WORDS = 1 << 20
SAMPLE, SAMPLE_TEXT, SAMPLE_STEP, SAMPLE_BYTES = 1 << 16, 16 << 20, 16, 200
MOST_RANGES = SAMPLE // 8

Window = tuple[bytes, ...]
BREAK = b"."  # stands between pieces; no word contains one
_SAME = bytes.maketrans(b",;:!?\n\v\f\r\t", b".........\x20")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words and breaks of a text, in lists of about CHUNK_BYTES."""
    text = text.lower().translate(_SAME).replace(b".", b" . ")
    start = 0
    while start < len(text):
        stop = text.find(b" ", start + CHUNK_BYTES)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop].split()
        start = stop


def windows_of(symbols: np.ndarray, longest: int) -> list[np.ndarray]:
    """One column for each place in a window; 0 where the piece has ended. Symbol 0 is a break."""
    columns = [symbols]
    for place in range(1, longest):
        column = np.zeros_like(symbols)
        column[: max(0, len(symbols) - place)] = symbols[place:]
        column[columns[-1] == 0] = 0
        columns.append(column)
    return columns


def distinct_rows(columns: list[np.ndarray], weights: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows of some columns, and the sum of the weights of each."""
    if not len(weights):
        return np.empty((0, len(columns)), np.int32), np.empty(0, np.int64)
    bits = max(1, int(symbols).bit_length())
    key, room = columns[0].astype(np.uint64), bits
    for column in columns[1:]:
        if room + bits > 64:  # the columns so far become their rank
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            room = max(1, int(key.max()).bit_length())
        key = key << np.uint64(bits) | column.astype(np.uint64)
        room += bits
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    rows = np.stack([column[order[first]] for column in columns], axis=1).astype(np.int32)
    return rows, np.add.reduceat(weights[order], first)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes before all second ones: small numbers shrink well."""
    data = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(data.tobytes())


def _from_planes(data: bytes) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(data.reshape(4, -1).T).view("<u4").ravel()


class CountTransducer:
    """Acyclic automaton from phrases to counts, built from sorted distinct phrases.

    `words` are its symbols in byte order, symbol 1 first; row i of `paths` is the i-th phrase, 0 after
    its end. `shared` says how many states a path has in common with the one before; the rest are its own.
    """

    def __init__(self, words: list[bytes], paths: np.ndarray, weights: np.ndarray):
        self.words, self.paths, self.weights = words, paths, weights.astype(np.int64)
        differs = paths[1:] != paths[:-1]
        self.shared = np.r_[np.zeros(min(1, len(paths)), int), differs.argmax(axis=1)] if len(paths) > 1 else np.zeros(len(paths), int)

    @classmethod
    def of_part(cls, vocabulary: list[bytes], paths: np.ndarray, weights: np.ndarray) -> CountTransducer:
        """Some sorted paths over a larger vocabulary, with the words they use."""
        used = np.unique(paths)
        used = used[used > 0]
        small = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.int32)
        small[used] = np.arange(1, len(used) + 1)
        return cls([vocabulary[i - 1] for i in used.tolist()], small[paths], weights)

    def states(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """States that end phrases of `length` words: the first path through each, and its weight."""
        starts = np.flatnonzero(self.shared < length)
        if not len(starts):
            return starts, starts
        weights = np.add.reduceat(self.weights, starts)
        inside = self.paths[starts, length - 1] > 0
        return starts[inside], weights[inside]

    def phrase(self, path: int, length: int) -> bytes:
        return b" ".join(self.words[i - 1] for i in self.paths[path, :length].tolist())

    def through(self, path: Window) -> Iterator[tuple[int, np.ndarray]]:
        """For each prefix of `path` that is a state: its length, and whether each path goes through it."""
        inside = np.ones(len(self.paths), bool)
        for place, word in enumerate(path):
            at = bisect.bisect_left(self.words, word)
            if at == len(self.words) or self.words[at] != word:
                return
            inside = inside & (self.paths[:, place] == at + 1)
            yield place + 1, inside

    def pack(self) -> dict[str, bytes | int]:
        own = np.arange(self.paths.shape[1]) >= self.shared[:, None]
        weights = np.stack([self.weights & 0xFFFFFFFF, self.weights >> 32])
        return {
            "words": zstandard.ZstdCompressor(level=3).compress(b"\n".join(self.words)),
            "shared": zstandard.ZstdCompressor(level=3).compress(self.shared.astype(np.uint8).tobytes()),
            "labels": _planes(self.paths[own]),
            "weights": _planes(weights.ravel()),
        }

    @classmethod
    def unpack(cls, row: dict, longest: int) -> CountTransducer:
        grow = zstandard.ZstdDecompressor().decompress
        words, shared = grow(row["words"]).split(b"\n"), np.frombuffer(grow(row["shared"]), np.uint8)
        own = np.arange(longest) >= shared[:, None]
        paths = np.zeros(own.shape, np.int32)
        paths[own] = _from_planes(row["labels"])
        place = np.arange(len(shared))
        for column in range(longest):
            paths[:, column] = paths[np.maximum.accumulate(np.where(own[:, column], place, 0)), column]
        low, high = _from_planes(row["weights"]).astype(np.int64).reshape(2, -1)
        return cls(words, paths, low | high << 32)

    @classmethod
    def union(cls, parts: list[CountTransducer]) -> CountTransducer:
        """Equal paths become one; their weights add up."""
        words = sorted(set().union(*(part.words for part in parts)))
        symbol = {word: i for i, word in enumerate(words, 1)}
        paths = []
        for part in parts:
            to = np.zeros(len(part.words) + 1, np.int32)
            to[1:] = np.fromiter(map(symbol.__getitem__, part.words), np.int32, len(part.words))
            paths.append(to[part.paths])
        columns = list(np.ascontiguousarray(np.concatenate(paths).T))
        return cls(words, *distinct_rows(columns, np.concatenate([part.weights for part in parts]), len(words)))


class _Block:
    """Words of some documents, group by group, until they are sorted into automata."""

    def __init__(self, longest: int, bounds: dict[str, list[Window]], subs: int):
        self.longest, self.bounds, self.subs = longest, bounds, subs
        self.clear()

    def clear(self) -> None:
        self.symbols = {BREAK: 0}
        self.parts: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, group: str, words: list[bytes]) -> None:
        symbols = self.symbols
        for word in set(words).difference(symbols):
            symbols[word] = len(symbols)
        self.parts.setdefault(group, []).append(np.fromiter(map(symbols.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def close(self, unfinished: str | None = None) -> Iterator[dict]:
        """All automata, cut by range. The last words of an unfinished text start the next block."""
        vocabulary = sorted(word for word in self.symbols if word != BREAK)
        rank = np.zeros(len(self.symbols), np.int32)
        rank[[self.symbols[word] for word in vocabulary]] = np.arange(1, len(vocabulary) + 1)
        rest: list[bytes] = []
        for group, parts in self.parts.items():
            ranks = rank[np.concatenate(parts)]
            columns = windows_of(ranks, self.longest)
            starts = ranks > 0
            if group == unfinished:
                cut = max(0, len(ranks) - self.longest + 1)
                starts[cut:] = False
                rest = [vocabulary[i - 1] if i else BREAK for i in ranks[cut:].tolist()]
            columns = [column[starts] for column in columns]
            paths, weights = distinct_rows(columns, np.ones(len(columns[0]), np.int64), len(vocabulary))
            if len(paths):
                yield from self._ranges(group, vocabulary, paths, weights)
        self.clear()
        if rest:
            self.add(unfinished, rest)

    def _ranges(self, group: str, vocabulary: list[bytes], paths: np.ndarray, weights: np.ndarray) -> Iterator[dict]:
        def before(bound: Window) -> int:
            # Words between two of the vocabulary get an odd number; nothing after such a word matters.
            wanted = []
            for word in bound:
                at = bisect.bisect_left(vocabulary, word)
                known = at < len(vocabulary) and vocabulary[at] == word
                wanted.append(2 * at + 2 if known else 2 * at + 1)
            return bisect.bisect_left(range(len(paths)), wanted, key=lambda i: (2 * paths[i]).tolist())

        edges = [0, *map(before, self.bounds.get(group, [])), len(paths)]
        for number, (start, stop) in enumerate(zip(edges, edges[1:])):
            if start == stop:
                continue
            own, held = paths[start:stop], weights[start:stop]
            if self.subs == 1:
                yield {"grp": group, "range": number, "sub": 0} | CountTransducer.of_part(vocabulary, own, held).pack()
                continue
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 3) for w in vocabulary), np.uint64, len(vocabulary))
            hashes = np.r_[np.zeros(1, np.uint64), hashes]
            sub = (hashes[own[:, 0]] * np.uint64(31) + hashes[own[:, 1]]) % np.uint64(self.subs)
            for name in np.unique(sub).tolist():
                part = CountTransducer.of_part(vocabulary, own[sub == name], held[sub == name])
                yield {"grp": group, "range": number, "sub": name} | part.pack()


AUTOMATON = pa.schema(
    [("grp", pa.string()), ("range", pa.int32()), ("sub", pa.int32())]
    + [(name, pa.binary()) for name in ("words", "shared", "labels", "weights")]
)


def _shards(longest: int, bounds: dict[str, list[Window]], subs: int, block_words: int):
    """Documents (grp, text) -> packed automata of blocks, one row for each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(longest, bounds, subs)

        def closed(unfinished: str | None = None) -> Iterator[pa.RecordBatch]:
            for row in block.close(unfinished):
                yield pa.RecordBatch.from_pylist([row], AUTOMATON)

        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                for words in words_of(text or b""):
                    block.add(group, words)
                    if block.size >= block_words:
                        yield from closed(group)
                if group in block.parts:
                    block.add(group, [BREAK])
        yield from closed()

    return run


def _united(longest: int, bounds: dict[str, list[Window]], subs: int, least: int):
    """Automata of one range -> its phrases: the frequent ones, and in parts those that other ranges share.

    One row without a phrase has the number of words.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group, number = key[0].as_py(), key[1].as_py()
        own = bounds.get(group, [])
        borders = own[max(0, number - 1) : number + 1]  # where this range starts and where the next one does
        union = CountTransducer.union([CountTransducer.unpack(row, longest) for row in table.to_pylist()])
        phrases, sizes, counts = [None], [0], [int(union.weights.sum())]
        shared = [np.zeros(len(union.paths), bool) for _ in range(longest + 1)]
        for border in borders:
            for length, inside in union.through(border):
                shared[length] |= inside
        for length in range(1, longest + 1):
            starts, weights = union.states(length)
            told = (weights >= least) | shared[length][starts] | (length == 1 and subs > 1)
            phrases += [union.phrase(path, length) for path in starts[told].tolist()]
            counts += weights[told].tolist()
            sizes += [length] * int(told.sum())
        columns = [pa.array([group] * len(phrases), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string())]
        columns += [pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())]
        return pa.table(columns, names=["grp", "phrase", "size", "held"])

    return run


def _sampled(longest: int):
    """Every SAMPLE_STEP-th word's window, with a number that orders all of them at random."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                rows = []
                for words in words_of(text or b""):
                    for at in range(0, len(words), SAMPLE_STEP):
                        window = words[at : at + longest]
                        if BREAK in window:
                            window = window[: window.index(BREAK)]
                        if window and sum(map(len, window)) <= SAMPLE_BYTES:
                            draw = xxhash.xxh64_intdigest(b"%d %d" % (at, len(rows)) + b" ".join(words[at : at + 20]))
                            rows.append({"grp": group, "draw": draw >> 1, "words": window})
                    schema = [("grp", pa.string()), ("draw", pa.int64()), ("words", pa.list_(pa.binary()))]
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(schema))
                    rows = []

    return run


def range_bounds(docs: DataFrame, longest: int, range_words: int) -> tuple[dict[str, list[Window]], int]:
    """First windows of all ranges but each group's first, and into how many parts a range is dealt further."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, SAMPLE_TEXT / max(1, size))
    drawn = docs.sample(share, 11).mapInArrow(_sampled(longest), "grp string, draw bigint, words array<binary>")
    rows = drawn.orderBy("draw", "grp", "words").limit(SAMPLE).collect()
    ranges = max(1, math.ceil(size / 6 / range_words))  # six bytes a word
    step = max(1.0, len(rows) / min(ranges, MOST_RANGES))
    groups: dict[str, list[Window]] = {}
    for row in rows:
        groups.setdefault(row.grp, []).append(tuple(map(bytes, row.words)))
    bounds = {}
    for group, windows in groups.items():
        windows.sort()
        picked = [windows[math.ceil(i * step)] for i in range(1, math.ceil(len(windows) / step)) if math.ceil(i * step) < len(windows)]
        bounds[group] = sorted(set(picked))
    return bounds, math.ceil(ranges / MOST_RANGES)


def phrase_counts(
    docs: DataFrame, staging: Staging, *, longest=LONGEST, least=LEAST, block_words=BLOCK_WORDS, range_words=RANGE_WORDS
) -> DataFrame:
    """(grp, phrase, size, f): phrases of `docs` (grp, text) with f >= least, and a null phrase with f of all words."""
    bounds, subs = range_bounds(docs, longest, range_words)
    automata = docs.mapInArrow(
        _shards(longest, bounds, subs, block_words),
        "grp string, range int, sub int, words binary, shared binary, labels binary, weights binary",
    )
    told = automata.groupBy("grp", "range", "sub").applyInArrow(
        _united(longest, bounds, subs, least), "grp string, phrase string, size int, held bigint"
    )
    counts = told.groupBy("grp", "phrase", "size").agg(F.sum("held").alias("f"))
    return staging.keep(counts.filter(F.col("phrase").isNull() | (F.col("f") >= least)), "counts")


def collocations(
    docs: DataFrame,
    *,
    group="lang",
    text="text",
    longest=LONGEST,
    least=LEAST,
    top=TOP,
    absorb=ABSORB,
    block_words=BLOCK_WORDS,
    range_words=RANGE_WORDS,
) -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score): each group's `top` phrases of two to `longest` words.

    A-Z are lower-cased; pieces end at . , ; : ! ? and line ends; words are separated by spaces and tabs. A
    phrase's count a must reach `least`. Each cut into two parts with counts l and r scores floor(1000 a n / (l r)), n
    being all words of the group, in exact arithmetic; the lowest-scoring cut counts, the shortest first part among
    equals. A phrase inside a longer counted one goes if `absorb` percent of its count or more are the longer
    one's. Order: score, then a, both falling, then phrase bytewise. Null texts have no words, the null
    group is `und` (with a group of that name), repeated rows count each time, and groups without such a
    phrase, or an empty table, have no rows. Other columns play no part.
    """
    staging = Staging(docs.sparkSession, "collocations")
    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(NO_GROUP)).alias("grp"), F.col(text).alias("text"))
    counts = phrase_counts(
        rows, staging, longest=longest, least=least, block_words=block_words, range_words=range_words
    )
    totals = counts.filter("phrase is null").select("grp", F.col("f").alias("n"))
    counts = counts.filter("phrase is not null")
    found = counts.filter("size > 1").select("grp", "phrase", "size", F.col("f").alias("a"))

    words = F.split("phrase", " ")
    longer = found.filter("size > 2").select("grp", "a", "size", words.alias("words"))
    spans = F.expr(
        "filter(flatten(transform(sequence(1, size - 1), i -> transform(sequence(2, size - 1), k ->"
        " if(i + k <= size + 1, array_join(slice(words, i, k), ' '), null)))), x -> x is not null)"
    )
    inside = longer.select("grp", "a", F.explode(spans).alias("phrase")).groupBy("grp", "phrase").agg(F.max("a").alias("most"))
    found = found.join(inside, ["grp", "phrase"], "left").filter(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * absorb)
    )
    found = staging.keep(found.drop("most"), "found")

    cuts = found.select("*", words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "grp",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    for part, name in (("left", "l"), ("right", "r")):
        own = counts.select("grp", F.col("phrase").alias(part), F.col("f").alias(name))
        cuts = cuts.join(own, ["grp", part])
    cuts = cuts.join(totals, "grp")
    wide = "cast({} as decimal(19,0))".format
    score = F.expr(f"({wide('a')} * {wide('n')} * 1000BD) div ({wide('l')} * {wide('r')})")
    best = cuts.groupBy("grp", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    best = staging.keep(best.select("grp", "phrase", "a", "n", "cut.l", "cut.r", "cut.score"), "scored")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return _first_of_each(best, top, order).select(
        F.col("grp").alias(group), F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _first_of_each(rows: DataFrame, top: int, order: list) -> DataFrame:
    """The first `top` rows of each group, with their rank: first within shares of a group, then of what is left."""
    from pyspark.sql import Window as W

    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    for keys in (("grp", "share"), ("grp",)):
        placed = dealt.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        dealt = placed.filter(F.col("rank") <= top)
    return dealt
