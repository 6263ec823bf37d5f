"""Collocations against plain counting; the automata on their own."""

import random

import numpy as np
import pytest

from ledgerforge.llm import collocations as C
from tests.llm import brute

SCHEMA = "doc_id bigint, lang string, text string, phrase string, grp string, n string"


def invented(count, seed, words=40, length=30):
    rnd = random.Random(seed)
    vocabulary = [f"{'abcdefgh'[i % 8]}{i}" for i in range(words)]
    ends = [" ", "  ", "\t", ". ", ", ", "\n", "!", " ;", "\x0c", "\x0b", " "]
    for _ in range(count):
        picked = rnd.choices(vocabulary, weights=[1 / (i + 1) for i in range(words)], k=rnd.randint(0, length))
        yield "".join(w.upper() * (rnd.random() < 0.1) or w for w in (x + rnd.choice(ends) for x in picked))


def build(frame, rows):
    return frame([(i, lang, text, "x", "y", None) for i, (lang, text) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize(
    "options, sizes",
    [
        ({}, {}),
        ({"least": 3, "top": 7}, {"block_words": 50, "range_words": 40}),
        ({"least": 2, "longest": 3, "absorb": 60}, {"block_words": 300, "range_words": 10}),
        ({"least": 1, "longest": 2, "top": 10**6}, {"block_words": 7, "range_words": 1000}),
    ],
)
def test_phrases_equal_plain_counting(frame, options, sizes):
    rows = [(("en", "de", None, "und")[i % 4 if i % 3 else 0], t) for i, t in enumerate(invented(250, 5))]
    rows += [("en", "new york city " * 60), ("en", "New York. york city, new"), ("de", None), ("de", ""), (None, ". ! ,")]
    rows += [("x\x00y", "naïve é\x00a \x01b " * 120), ("en", "one"), ("fr", brute.LONG), ("fr", "a" * 50_000)]
    rows += [("en", "New York. york city, new")] * 2
    found = C.collocations(build(frame, rows).repartition(3), **options, **sizes)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(brute.collocations(rows, **options))


def test_parts_of_ranges(frame, monkeypatch):
    rows = [("en", t) for t in invented(200, 9)]
    monkeypatch.setattr(C, "MOST_RANGES", 4)  # ranges are dealt further by hash
    found = C.collocations(build(frame, rows), least=3, block_words=500, range_words=100)
    assert sorted(map(tuple, found.collect())) == sorted(brute.collocations(rows, least=3))


def test_empty_table(frame):
    assert C.collocations(build(frame, [])).count() == 0


def test_automata_round_trip_and_unite():
    rnd, parts, plain = random.Random(3), [], {}
    for _ in range(6):
        vocabulary = sorted({f"w{rnd.randint(0, 30)}".encode() for _ in range(12)})
        phrases = {tuple(rnd.choices(range(1, len(vocabulary) + 1), k=rnd.randint(1, 4))) for _ in range(40)}
        rows = np.array(sorted((*p, *[0] * (4 - len(p))) for p in phrases), np.int32)
        weights = np.array([rnd.choice([1, 2, 1 << 33]) for _ in rows])
        part = C.CountTransducer(vocabulary, rows, weights)
        for row, weight in zip(rows.tolist(), weights.tolist()):
            words = tuple(vocabulary[i - 1] for i in row if i)
            for size in range(1, len(words) + 1):
                plain[words[:size]] = plain.get(words[:size], 0) + weight
        back = C.CountTransducer.unpack(part.pack(), 4)
        assert (back.paths == part.paths).all() and (back.weights == weights).all() and back.words == vocabulary
        parts.append(back)
    union = C.CountTransducer.union(parts)
    found = {}
    for size in range(1, 5):
        for path, weight in zip(*(x.tolist() for x in union.states(size))):
            found[tuple(union.phrase(path, size).split(b" "))] = weight
    assert found == plain


def test_rows_too_wide_for_one_key():
    rnd = np.random.default_rng(1)
    columns = [rnd.integers(0, 3, 500) * 400_000 for _ in range(5)]
    rows, weights = C.distinct_rows(columns, np.ones(500, np.int64), 1_000_000)
    expected, counts = np.unique(np.stack(columns, 1), axis=0, return_counts=True)
    assert (rows == expected).all() and (weights == counts).all()


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(C, "CHUNK_BYTES", 7)
    text = "".join(invented(30, 2)).encode()
    chunks = list(C.words_of(text))
    assert len(chunks) > 10
    whole = [w for part in brute.re.split("[.,;:!?\n-\r]", text.decode().lower()) for w in part.split()]
    assert [w for c in chunks for w in c if w != C.BREAK] == [w.encode() for w in whole]
