"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are its runs of one to four letters, with the word's edge as a letter of its own, hashed
into BUCKETS. Their embeddings are averaged and a linear layer gives one logit per language. Both layers
are trained by stochastic gradient descent in numpy on a bounded sample: about SAMPLE_ROWS labelled rows, the
same number of each language as far as there are so many, chosen by a hash of the id. Each gives its whole text
and a few excerpts of some words, so that short texts are learned too. One fifth of the sample is
kept from the descent; on it a temperature is fitted, so that scores are probabilities, and the least score
at which predictions reach the wanted precision, below which a prediction is called rejected.

Prediction needs no shuffle: the two layers are multiplied into one table of BUCKETS x languages, whose size is
fixed by parameters, and each text's subword counts are multiplied with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerforge.llm.tasks import slices

BUCKETS = 1 << 14
LONGEST = 4  # letters of a subword
DIMENSION = 16
LANGUAGES = 256  # learned at most, the most frequent ones
SAMPLE_ROWS = 3_000
EXCERPTS = (1, 3, 8, 20)  # words
CHUNK = 1 << 20  # letters whose subwords are hashed in one step
EPOCHS, BATCH, RATE, SEED = 4, 16, 0.3, 5
PRECISION = 0.99
UNKNOWN = "und"

# Multipliers of the subword hash, chosen freely.
_STEP, _LAST = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def _subwords(symbols: np.ndarray, count: int) -> np.ndarray:
    """Buckets of the subwords that start at each of the first `count` symbols; BUCKETS where there is none.

    Symbol 0 is what lies between words: it may begin or end a subword of two letters or more.
    """
    padded = np.zeros(len(symbols) + LONGEST, np.uint32)
    padded[: len(symbols)] = symbols
    out = np.full((count, LONGEST), BUCKETS, np.int32)
    mixed = padded[:count].copy()
    inner = np.ones(count, bool)  # all letters but the first and the last are letters
    for size in range(1, LONGEST + 1):
        last = padded[size - 1 : size - 1 + count]
        if size == 1:
            valid = last > 0
        else:
            mixed = mixed * _STEP + last + np.uint32(size)
            valid = inner & ((padded[:count] > 0) | (last > 0)) if size == 2 else inner
            inner = inner & (last > 0)
        hashed = (mixed ^ mixed >> np.uint32(15)) * _LAST >> np.uint32(32 - BUCKETS.bit_length() + 1)
        out[valid, size - 1] = hashed[valid].astype(np.int32)
    return out


def subword_counts(texts: list[str]) -> Iterator[np.ndarray]:
    """Counts of the BUCKETS of each text."""
    lowered = [text.lower() for text in texts]
    edges = np.cumsum([0, *(len(text) + 1 for text in lowered)])
    symbols = np.frombuffer("".join("\0" + text for text in lowered).encode("utf-32-le"), np.uint32)
    symbols = np.where(_letters()[symbols], symbols, np.uint32(0))
    low, buckets = 0, np.empty((0, LONGEST), np.int32)
    for start, stop in zip(edges.tolist(), edges[1:].tolist()):
        counts = np.zeros(BUCKETS, np.int64)
        while start < stop:
            if start >= low + len(buckets):
                low = start
                count = min(CHUNK, len(symbols) - low)
                buckets = _subwords(symbols[low : low + count + LONGEST - 1], count)
            here = min(stop, low + len(buckets))
            counts += np.bincount(buckets[start - low : here - low].ravel(), minlength=BUCKETS + 1)[:BUCKETS]
            start = here
        yield counts


@dataclass(frozen=True)
class Model:
    """Languages, logits of each bucket and of none, and what scores mean."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        logits = counts.astype(np.float32) @ self.table / max(1, counts.sum()) + self.bias
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def descend(bags, targets: np.ndarray, languages: int, *, epochs=EPOCHS, rate=RATE, seed=SEED):
    """Embeddings, weights and bias after stochastic gradient descent on (bag, language) pairs.

    `bags` gives, for numbers of samples, a matrix whose rows are shares of the buckets.
    """
    rng = np.random.default_rng(seed)
    embeddings = rng.uniform(-0.1, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    weights = np.zeros((DIMENSION, languages), np.float32)
    bias = np.zeros(languages, np.float32)
    steps, step = max(1, epochs * -(-len(targets) // BATCH)), 0
    for _ in range(epochs):
        order = rng.permutation(len(targets))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            shares = bags(own)
            mean = shares @ embeddings
            wrong = softmax(mean @ weights + bias)
            wrong[np.arange(len(own)), targets[own]] -= 1
            wrong *= rate * (1 - step / steps) / len(own)
            back = wrong @ weights.T
            weights -= mean.T @ wrong
            bias -= wrong.sum(axis=0)
            embeddings -= BUCKETS / 64 * (shares.T @ back)  # shares are small; steps need not be
            step += 1
    return embeddings, weights, bias


def _bags(packed: list[bytes]):
    """Sparse bags (2-byte buckets, then 4-byte shares) as dense rows on demand."""
    sizes = [len(bag) // 6 for bag in packed]
    buckets = [np.frombuffer(bag, "<u2", size) for bag, size in zip(packed, sizes)]
    shares = [np.frombuffer(bag, "<f4", size, 2 * size) for bag, size in zip(packed, sizes)]

    def dense(own: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(own), BUCKETS), np.float32)
        for row, sample in zip(rows, own):
            row[buckets[sample]] = shares[sample]
        return rows

    return dense


def fit(samples: list[tuple[str, int, bytes]], *, precision=PRECISION) -> Model:
    """A model of (language, row number, packed bag); every fifth row number only calibrates."""
    languages = sorted({language for language, _, _ in samples}, key=str.encode)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), least_score=1.0)
    target = np.array([languages.index(language) for language, _, _ in samples])
    kept = np.array([row % 5 == 4 for _, row, _ in samples])
    if kept.all() or not kept.any():
        kept[:] = False
    bags = _bags([bag for _, _, bag in samples])
    learned = np.flatnonzero(~kept)
    embeddings, weights, bias = descend(lambda own: bags(learned[own]), target[learned], len(languages))
    table = embeddings @ weights
    model = Model(languages, table, bias)
    if not kept.any():
        return model
    own = np.flatnonzero(kept)
    logits = np.concatenate([bags(own[i : i + 256]) @ table + bias for i in range(0, len(own), 256)])
    scale = min(np.geomspace(0.05, 20, 121), key=lambda t: _loss(logits / t, target[own]))
    scores = softmax(logits / scale)
    best, right = scores.max(axis=1), scores.argmax(axis=1) == target[own]
    order = np.argsort(-best, kind="stable")
    reached = np.flatnonzero(np.cumsum(right[order]) >= precision * np.arange(1, len(order) + 1))
    least = best[order[reached[-1]]] if len(reached) else 1.0
    return Model(languages, table, bias, float(scale), float(least))


def _loss(logits: np.ndarray, target: np.ndarray) -> float:
    return float(-np.log(softmax(logits)[np.arange(len(target)), target] + 1e-12).mean())


def _excerpts(text: str) -> Iterator[str]:
    """The whole text, and runs of EXCERPTS words at places chosen by a hash of it."""
    yield text
    words = text.split()
    for size in EXCERPTS:
        if len(words) > size:
            first = xxhash.xxh64_intdigest(text.encode(), size) % (len(words) - size + 1)
            yield " ".join(words[first : first + size])


def _pack_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for language, order, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            bags = []
            for counts in subword_counts(list(_excerpts(text))):
                buckets = np.flatnonzero(counts)
                if len(buckets):
                    shares = counts[buckets] / counts.sum()
                    bags.append(buckets.astype("<u2").tobytes() + shares.astype("<f4").tobytes())
            columns = [pa.array([x] * len(bags), kind) for x, kind in ((language, pa.string()), (order, pa.int64()))]
            yield pa.record_batch([*columns, pa.array(bags, pa.binary())], names=["lang", "draw", "bag"])


def train(docs: DataFrame, *, doc_id="doc_id", text="text", lang="lang", rows=SAMPLE_ROWS, precision=PRECISION) -> Model:
    """A model of the rows of `docs` that have a text and a language; others teach nothing.

    At most `rows` rows in LANGUAGES languages reach the driver, each as five bags of at most BUCKETS entries.
    Without such rows the model knows no language.
    """
    known = docs.select(
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.col(doc_id).cast("string"), F.lit("sample")).alias("draw"),
        F.col(text).alias("text"),
    ).filter("lang is not null and text is not null")
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return fit([])
    each = max(1, rows // len(sizes))
    # Of a language with `count` rows, those in the lowest part of the hash's range.
    shares = [(row["lang"], (min(each, row["count"]) << 64) // row["count"] - 2**63 - 1) for row in sizes]
    below = docs.sparkSession.createDataFrame(shares, "lang string, below bigint")
    drawn = known.join(F.broadcast(below), "lang").filter("draw <= below").select("lang", "draw", "text")
    drawn = drawn.orderBy("draw", "lang", "text").limit(2 * rows)
    bags = drawn.mapInArrow(_pack_bags, "lang string, draw bigint, bag binary").collect()
    return fit([(row["lang"], row["draw"], bytes(row["bag"])) for row in bags], precision=precision)


FOUND = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


def language(text: Column, model: Model) -> Column:
    """(lang, score, rejected) of a text: its likeliest language and that language's probability.

    A null text, one without a letter, and any text under a model of no language is `und` with score 0, rejected. Others
    are rejected if the score is below the least one of the wanted precision; `lang` still names the
    likeliest language. Whole texts count, whatever their length; equal texts have equal results.
    """

    @F.arrow_udf(FOUND)
    def identify(column: pa.Array) -> pa.Array:
        out = []
        for part in slices(column.cast(pa.binary()).to_pylist()):
            for counts in subword_counts([(raw or b"").decode() for raw in part]):
                if not model.languages or not counts.any():
                    out.append({"lang": UNKNOWN, "score": 0.0, "rejected": True})
                    continue
                odds = model.probabilities(counts)
                best = int(odds.argmax())
                score = min(1.0, max(0.0, float(odds[best])))
                out.append({"lang": model.languages[best], "score": score, "rejected": score < model.least_score})
        return pa.array(out, pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]))

    return identify(text)
