"""Byte-level BPE over a corpus: each distinct pre-token is encoded once, globally.

Encoding has four steps. (1) Each task cuts its texts into pre-tokens and numbers the distinct
ones of a section of documents; a document becomes the sequence of these numbers, which keeps
every position. (2) Each section's distinct words are dealt into buckets by hash and shuffled by
bucket, so that equal words of all sections meet; each distinct word is encoded once. (3) The ids
go back to their sections. (4) Each section looks its documents' numbers up and lays the ids end to
end; where bytes are asked for, the same step joins them with the token-byte table again.

A very frequent word is sent once by each section, not once per occurrence, so no word is a hot
key. Within a section, documents travel in blocks of about BLOCK_CHARS (a longer text is a block of
its own), each one compressed row, and so do a section's words of one bucket, by the same two
shuffles. Step 4 holds a section's ids (at most SECTION_WORDS words) and one block. There are as many
buckets as shuffle partitions, at most MOST_BUCKETS, so rows grow with the input and not with its
square. Sections are named by input partition and order, so a retried task names them alike; a
section that does not meet all its ids fails the job.

Decoding joins ids with the token-byte table, whose size is the vocabulary's, inside each task.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BLOCK_CHARS = 2 << 20
SECTION_CHARS = 32 << 20
SECTION_WORDS = 1 << 19  # distinct words after which a section ends with its block
MOST_BUCKETS = 4096
KNOWN_WORDS = 1 << 20  # encoded words of a bucket that a task remembers before it starts afresh
CUT_WORDS = 1 << 18  # pre-tokens numbered in one step
LAY_OUT_WORDS = 1 << 18  # pre-tokens replaced by ids in one step
SLICE_TOKENS = 1 << 18  # tokens of documents that are handed on together
DECODE_ROWS = 256  # texts decoded in one step

# Fixed value: the characters that the tokenizer's engine takes for white space.
WHITE_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> id from a rank file: a base64 token and its rank on each line.

    A vocabulary is bounded (some tens of thousands of lines), so the driver reads it and tasks
    get it by broadcast.
    """
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def word_pattern(pattern: str) -> regex.Pattern:
    """The pre-token pattern with white space spelled out as the tokenizer's engine defines it."""
    spelled = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\S", f"[^{WHITE_SPACE}]")
    return regex.compile(spelled.replace(r"\s", f"[{WHITE_SPACE}]"))


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the lowest-ranked adjacent pair, leftmost first, until none is in the vocabulary."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    size = len(word)
    after = list(range(1, size + 1))  # start of the part that follows the part starting here
    before = list(range(-1, size))
    heap = []

    def offer(at: int) -> None:
        middle = after[at]
        if middle < size and (rank := ranks.get(word[at : after[middle]])) is not None:
            heap.append((rank, at, after[middle]))

    for at in range(size):
        offer(at)
    heapq.heapify(heap)
    while heap:
        _, at, stop = heapq.heappop(heap)
        middle = after[at]
        if middle >= size or middle < 0 or after[middle] != stop:
            continue  # one of its parts has been merged meanwhile
        after[at], after[middle] = stop, -1
        if stop < size:
            before[stop] = at
        for start in (at, before[at]) if at else (at,):
            follow = after[start]
            if follow < size and (rank := ranks.get(word[start : after[follow]])) is not None:
                heapq.heappush(heap, (rank, start, after[follow]))
    out, at = [], 0
    while at < size:
        out.append(ranks[word[at : after[at]]])
        at = after[at]
    return out


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as variable-length bytes: seven bits each, the top bit marks the last."""
    values = numbers.astype(np.int64)
    digits = [values & 127]
    while (values := values >> 7).any():
        digits.append(values & 127)
    table = np.stack(digits[::-1], axis=1).astype(np.uint8)
    used = np.maximum.accumulate(table > 0, axis=1)
    used[:, -1] = True
    table[:, -1] |= 128
    return table[used].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    digits = np.frombuffer(packed, np.uint8)
    last = np.flatnonzero(digits & 128)
    first = np.r_[0, last[:-1] + 1] if len(last) else last
    values, width = np.zeros(len(last), np.int64), last - first + 1 if len(last) else last
    for place in range(int(width.max()) if len(last) else 0):
        inside = place < width
        values[inside] = values[inside] << 7 | (digits[first[inside] + place] & 127)
    return values


def _shrink(*arrays: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=9).compress(b"".join(arrays))


def _grow(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


ROW = [("route", pa.int64()), ("section", pa.int64()), ("part", pa.int32())]


class _Section:
    """Documents in blocks, and the distinct words of all of them.

    A block numbers its new words by frequency, after those of the blocks before it. Its row has the
    documents' numbers and the length of each; a row of words has them with their numbers. `part`
    is a block's order, or below zero for the words of bucket -1 - part.
    """

    def __init__(self, name: int, schema: pa.Schema, buckets: int, block_chars: int, section_chars: int):
        self.name, self.schema, self.buckets = name, schema, buckets
        self.most_block, self.most = block_chars, section_chars
        self.chars = self.block_chars = self.blocks = 0
        self.ids, self.sequences = [], []
        self.seen = defaultdict()  # word -> order of its first occurrence
        self.seen.default_factory = self.seen.__len__
        self.number = np.empty(0, np.int32)  # by that order

    def add(self, doc_id, words: Iterator[str], size: int) -> None:
        parts = []
        while len(part := np.fromiter(map(self.seen.__getitem__, itertools.islice(words, CUT_WORDS)), np.int32)):
            parts.append(part)
        self.ids.append(doc_id)
        self.sequences.append(np.concatenate(parts) if parts else np.empty(0, np.int32))
        self.chars += size
        self.block_chars += size

    def full(self) -> bool:
        return self.chars >= self.most or len(self.seen) >= SECTION_WORDS

    def block_full(self) -> bool:
        return self.block_chars >= self.most_block or self.full()

    def _rows(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), self.schema)], schema=self.schema)

    def block(self) -> pa.RecordBatch:
        orders, known = np.concatenate(self.sequences), len(self.number)
        counts = np.bincount(orders, minlength=len(self.seen))[known:]
        added = np.empty(len(counts), np.int32)
        added[np.argsort(-counts, kind="stable")] = np.arange(known, len(self.seen))
        self.number = np.r_[self.number, added]
        sizes = np.fromiter(map(len, self.sequences), "<u4", len(self.sequences))
        route = self.name * MOST_BUCKETS + self.blocks
        row = (route, self.name, self.blocks, self.ids, _shrink(_pack(self.number[orders])), _shrink(sizes), None)
        self.ids, self.sequences, self.block_chars, self.blocks = [], [], 0, self.blocks + 1
        return self._rows([row])

    def words(self) -> Iterator[pa.RecordBatch]:
        dealt: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for word, number in zip(self.seen, self.number.tolist()):
            word = word.encode()
            dealt[zlib.crc32(word) % self.buckets].append((number, word))
        for bucket, own in dealt.items():
            numbers, words = zip(*sorted(own))
            steps = _shrink(_pack(np.diff(np.array(numbers, np.int64), prepend=0)))
            yield self._rows([(-1 - bucket, self.name, -1 - bucket, None, _shrink(b"\xff".join(words)), None, steps)])


def _into_sections(pattern: str, *limits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, name, section = word_pattern(pattern), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            schema = pa.schema(
                ROW
                + [("doc_ids", pa.list_(batch.schema.field(0).type))]
                + [(data, pa.binary()) for data in ("data", "sizes", "numbers")]
            )
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                section = section or _Section(name, schema, *limits)
                text = text.as_py() or ""
                words = iter(cut.findall(text)) if len(text) < BLOCK_CHARS else (m[0] for m in cut.finditer(text))
                section.add(doc_id.as_py(), words, len(text))
                if section.block_full():
                    yield section.block()
                if section.full():
                    yield from section.words()
                    name, section = name + 1, None
        if section:
            if section.ids:
                yield section.block()
            yield from section.words()

    return run


def _encode_words(ranks: dict[bytes, int]):
    """Rows sorted by route: a bucket's words become ids and their number for each word; blocks pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, open_bucket = {}, None
        for batch in batches:
            data, sizes = (batch.schema.get_field_index(name) for name in ("data", "sizes"))
            for row, part in enumerate(batch.column("part").to_pylist()):
                one = batch.slice(row, 1)
                if part >= 0:
                    yield one
                    continue
                if part != open_bucket or len(known) > KNOWN_WORDS:
                    known, open_bucket = {}, part
                parts = []
                for word in _grow(one.column(data)[0].as_py()).split(b"\xff"):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(encode_word(word, ranks), "<u4").tobytes()
                    parts.append(ids)
                lengths = np.fromiter(map(len, parts), "<u4", len(parts)) // np.uint32(4)
                one = one.set_column(data, "data", pa.array([_shrink(*parts)], pa.binary()))
                yield one.set_column(sizes, "sizes", pa.array([_shrink(lengths)], pa.binary()))

    return run


class _Pool:
    """The ids of a section's words, by number."""

    def __init__(self, section: int):
        self.section, self.ids, self.sizes, self.numbers = section, [], [], []
        self.width = None

    def add(self, row: dict) -> None:
        self.ids.append(np.frombuffer(_grow(row["data"]), "<i4"))
        self.sizes.append(np.frombuffer(_grow(row["sizes"]), "<u4").astype(np.int64))
        self.numbers.append(np.cumsum(_unpack(_grow(row["numbers"]))))

    def close(self) -> None:
        numbers = np.concatenate([*self.numbers, np.empty(0, np.int64)])
        sizes = np.concatenate([*self.sizes, np.empty(0, np.int64)])
        if len(np.unique(numbers)) != len(numbers) or (len(numbers) and numbers.max() >= len(numbers)):
            raise RuntimeError(MIXED)
        self.flat = np.concatenate([*self.ids, np.empty(0, np.int32)]).astype(np.int32, copy=False)
        self.width, self.start = np.zeros((2, len(numbers)), np.int64)
        self.width[numbers], self.start[numbers] = sizes, np.cumsum(sizes) - sizes
        self.ids = self.sizes = self.numbers = None

    def lay_out(self, numbers: np.ndarray) -> np.ndarray:
        if len(numbers) and numbers.max() >= len(self.width):
            raise RuntimeError(MIXED)
        total = np.r_[0, np.cumsum(self.width[numbers])]
        out = np.empty(total[-1], np.int32)
        for at in range(0, len(numbers), LAY_OUT_WORDS):
            part = numbers[at : at + LAY_OUT_WORDS]
            low, high = total[at], total[at + len(part)]
            shift = np.repeat(self.start[part] - total[at : at + len(part)], self.width[part])
            out[low:high] = self.flat[shift + np.arange(low, high)]
        return out


MIXED = "A section has met the ids of another run; write the input before encoding it."


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs [first, stop) of documents with about SLICE_TOKENS pre-tokens together."""
    first = total = 0
    for stop, size in enumerate(sizes, 1):
        total += size
        if total >= SLICE_TOKENS or stop - first >= DECODE_ROWS or stop == len(sizes):
            yield first, stop
            first, total = stop, 0


def _lay_out(table: pa.Array | None, kind: pa.DataType):
    """Rows sorted by section and part -> documents with their ids, and their bytes if there is a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = _Pool(-1)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("section", "part", "data", "sizes", "numbers")}
                if row["section"] != pool.section:
                    pool = _Pool(row["section"])
                if row["part"] < 0:
                    pool.add(row)
                    continue
                if pool.width is None:
                    pool.close()
                numbers = _unpack(_grow(row["data"]))
                sizes = np.frombuffer(_grow(row["sizes"]), "<u4").astype(np.int64)
                edges, doc_ids = np.r_[0, np.cumsum(sizes)], batch.column("doc_ids")[at].values
                for first, stop in _groups(sizes.tolist()):
                    flat = pool.lay_out(own := numbers[edges[first] : edges[stop]])
                    ends = np.r_[0, np.cumsum(pool.width[own])][edges[first : stop + 1] - edges[first]]
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                    columns = [doc_ids.slice(first, stop - first).cast(kind), ids]
                    if table is not None:
                        columns.append(_bytes_of(ids, table))
                    yield pa.record_batch(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    return run


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    *,
    doc_id="doc_id",
    text="text",
    decoded=None,
    buckets=None,
    block_chars=BLOCK_CHARS,
    section_chars=SECTION_CHARS,
) -> DataFrame:
    """(doc_id, ids) for every row of `docs`; ids is the array of token ids of the whole text.

    With `decoded`, a column of that name holds the bytes that the ids stand for, joined from the
    token-byte table in the task that lays the ids out. `buckets` is by how many hash buckets distinct words meet, by
    default the session's shuffle partitions. Null and empty texts have no tokens. Repeated rows and null
    ids stay as they are. `ranks` must hold all 256 single bytes. `docs` should be a table or files, so
    that a lost task reads its rows again in the same order.
    """
    kind = docs.schema[doc_id].dataType
    numbers = [T.StructField(name, T.LongType()) for name in ("route", "section")]
    data = [T.StructField(name, T.BinaryType()) for name in ("data", "sizes", "numbers")]
    sections = T.StructType(
        [*numbers, T.StructField("part", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(kind)), *data]
    )
    laid = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        laid.add("decoded", T.BinaryType())
    buckets = min(MOST_BUCKETS, buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = (
        docs.select(doc_id, text)
        .mapInArrow(_into_sections(pattern, buckets, block_chars, section_chars), sections)
        .repartition("route")
        .sortWithinPartitions("route")
        .mapInArrow(_encode_words(ranks), sections)
        .repartition("section")
        .sortWithinPartitions("section", "part")
        .mapInArrow(_lay_out(_token_bytes(ranks) if decoded else None, to_arrow_type(kind)), laid)
    )
    return out.toDF(doc_id, "ids", *([decoded] if decoded else []))


def _token_bytes(ranks: dict[bytes, int]) -> pa.Array:
    """Bytes by id; null for ids between that are not in the vocabulary, and for the one after the last."""
    tokens = [None] * (max(ranks.values(), default=-1) + 2)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.binary())


def _bytes_of(lists: pa.Array, table: pa.Array) -> pa.Array:
    unknown, flat = len(table) - 1, lists.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, unknown))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    edges = np.zeros(len(lists) + 1, np.int32)
    np.cumsum(sizes, out=edges[1:])
    pieces = pa.ListArray.from_arrays(pa.array(edges), table.take(pc.if_else(known, flat, unknown)))
    words = pc.binary_join(pieces, pa.scalar(b"", pa.binary()))
    return pc.if_else(pc.is_valid(lists), words, pa.scalar(None, pa.binary()))


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Bytes of an array of ids; null for a null array or one with an unknown id."""
    table = _token_bytes(ranks)

    @F.arrow_udf(T.BinaryType())
    def joined(lists: pa.Array) -> pa.Array:
        parts = [_bytes_of(lists.slice(at, DECODE_ROWS), table) for at in range(0, len(lists), DECODE_ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return joined(ids)
