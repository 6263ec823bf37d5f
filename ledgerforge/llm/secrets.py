"""Secret scan: fixed patterns, and Markov models of random strings against ordinary identifiers.

Labelled samples come from the corpus itself: the values that the fixed patterns catch are examples of
random strings, all other tokens of letters, digits and `+/_=-` are examples of ordinary identifiers. Two
first-order character models count which character follows which in either class, over all documents:
each task adds its counts up and sends one table, and the driver gets two tables of fixed size. A
token of LEAST_LENGTH characters or more that no pattern has caught is a secret too if the log-likelihood ratio of the two models,
per character, exceeds LEAST_RATIO.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_LENGTH = 20
LEAST_RATIO = 1.0  # natural log-odds per character
LEAST_EXAMPLES = 100  # transitions in random strings; below it there is no model, only patterns

# The patterns, and the least length of what they catch.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LENGTH = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_LENGTH)

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1  # 0 stands for every other byte, and for a token's edges
CODE = np.zeros(256, np.int64)
CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, SYMBOLS)
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("stop", T.IntegerType()),
        ]
    )
)


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) by the fixed patterns, in code points; leftmost matches that do not overlap within a kind.

    A maximal run that is long enough equals a greedy match of at least that length, so only the
    assignment needs its check after the match.
    """
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def _values(text: str) -> list[tuple[int, int]]:
    """The random strings themselves: for an assignment its value only."""
    spans = [m.span(1) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    return spans + [m.span() for m in ACCESS.finditer(text)] + [m.span() for m in HEX.finditer(text)]


def _transitions(data: bytes) -> np.ndarray:
    """Counts of neighbouring symbols, as one row of SYMBOLS * SYMBOLS."""
    codes = CODE[np.frombuffer(data, np.uint8)]
    return np.bincount(codes[:-1] * SYMBOLS + codes[1:], minlength=SYMBOLS * SYMBOLS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    random = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for batch in batches:
        values, texts = [], [text.as_py() or "" for text in batch.column(0)]
        for text in texts:
            values += [text[a:b] for a, b in _values(text)]
            total += _transitions(f" {text} ".encode()) if len(text) > 1 << 20 else 0
        total += _transitions(" ".join(["", *(t for t in texts if len(t) <= 1 << 20), ""]).encode())
        random += _transitions(" ".join(["", *values, ""]).encode())
    some = np.flatnonzero(total + random)
    yield pa.record_batch(
        [pa.array(some, pa.int64()), pa.array(random[some], pa.int64()), pa.array(total[some], pa.int64())],
        names=["pair", "random", "total"],
    )


def train(docs: DataFrame, *, text="text") -> np.ndarray | None:
    """Log-likelihood ratio of each symbol pair (random over ordinary), from all of `docs`.

    None if the patterns catch too little to learn from. The driver receives one row for each pair of symbols at most.
    """
    rows = (
        docs.select(text)
        .mapInArrow(_count, "pair bigint, random bigint, total bigint")
        .groupBy("pair")
        .agg(F.sum("random").alias("random"), F.sum("total").alias("total"))
        .collect()
    )
    random, total = np.zeros((2, SYMBOLS * SYMBOLS))
    for row in rows:
        random[row.pair], total[row.pair] = row.random, row.total
    random, total = random.reshape(SYMBOLS, SYMBOLS), total.reshape(SYMBOLS, SYMBOLS)
    ordinary = np.maximum(total - random, 0)
    for counts in (random, ordinary):
        counts[0, 0] = 0  # between tokens
    if random.sum() < LEAST_EXAMPLES:
        return None
    smooth = [np.log((c + 0.5) / (c + 0.5).sum(axis=1, keepdims=True)) for c in (random, ordinary)]
    return smooth[0] - smooth[1]


def log_ratio(token: str, model: np.ndarray) -> float:
    """Mean log-likelihood ratio per character, edges included."""
    codes = CODE[np.frombuffer(f" {token} ".encode(), np.uint8)]
    return float(model[codes[:-1], codes[1:]].sum() / len(token))


def _scan(text: str, model: np.ndarray | None) -> list[tuple[int, int, int]]:
    found = pattern_spans(text)
    if model is not None:
        starts, reach = [a for a, _, _ in sorted(found)], list(accumulate((b for *_, b in sorted(found)), max))
        for match in TOKEN.finditer(text):
            a, b = match.span()
            before = bisect_left(starts, b)  # spans that start before the token ends
            if not (before and reach[before - 1] > a) and log_ratio(match[0], model) > LEAST_RATIO:
                found.append((a, 3, b))
    return sorted(found)


def secret_spans(text: Column, model: np.ndarray | None) -> Column:
    """array<struct<kind, start, stop>> in code points, stop exclusive, by start and then kind.

    Null and empty texts have none. Spans of different pattern kinds may overlap; `random` spans overlap no other.
    """

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        rows = [
            [{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in _scan(text.as_py() or "", model)] for text in texts
        ]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
        return pa.array(rows, pa.list_(kind))

    return spans(text)
