"""Language identification: held-out accuracy, subwords against plain counting, calibration, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from ledgerforge.llm import langid, queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, lang string, text string, score string, draw string, found string"


def plain_subwords(text):
    symbols = [ord(c) if c.isalpha() else 0 for c in "\0" + text.lower()] + [0]
    out = Counter()
    for at in range(len(symbols) - 1):
        for size in range(1, 5):
            run = symbols[at : at + size]
            edges = sum(c == 0 for c in (run[0], run[-1]))
            if len(run) == size and 0 not in run[1:-1] and edges < min(2, size) + (size > 2):
                out[tuple(run)] += 1
    return out


@pytest.mark.parametrize("chunk", [1 << 20, 5, 64])
def test_subwords_equal_plain_counting(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    texts = ["", "a", "Ab", "naïve café!", "x1y22zz", "İstanbul ß", "  two  words ", "1 2", "abc" * 40, "漢字 и", ""]
    for text, counts in zip(texts, langid.subword_counts(texts)):
        expected = plain_subwords(text)
        assert counts.sum() == sum(expected.values()), text
        assert 0 <= len(expected) - np.count_nonzero(counts) <= 1 + len(expected) // 50, text  # few share a bucket


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    rows = queries.op12_language_id(spark, FOLDER).collect()
    assert len(rows) == len(truth) and {r.lang_pred for r in rows} <= {lang for lang, _ in truth.values()} | {"und"}
    held = [r for r in rows if r.held_out and truth[r.doc_id][0]]
    assert len(held) > 150
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) / len(held) > 0.98
    long = [r for r in held if len(truth[r.doc_id][1]) > 200]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in long) / len(long) > 0.99
    assert sum(r.rejected for r in long) / len(long) < 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_of_held_out_rows_is_learned(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs.filter(~queries.unlearned()), rows=40)
    odd = frame([(i, "xx", "zzz qqq " * 50) for i in range(60)], "doc_id bigint, lang string, text string")
    mixed = docs.select("doc_id", "lang", "text").union(odd.filter(queries.unlearned()))
    again = langid.train(mixed.filter(~queries.unlearned()), rows=40)
    assert again.languages == model.languages and np.array_equal(again.table, model.table)


def texts_of(rnd, letters, count):
    return ["".join(rnd.choice(letters + " ") for _ in range(rnd.randint(30, 200))) for _ in range(count)]


def test_scores_are_calibrated_and_strange_texts_rejected(frame):
    rnd = random.Random(4)
    # A third of both languages is the same mixture: nobody can tell those apart.
    rows = [("aa", t) for t in texts_of(rnd, "abcdefg", 200)] + [("bb", t) for t in texts_of(rnd, "opqrstu", 200)]
    rows += [(rnd.choice(["aa", "bb"]), t) for t in texts_of(rnd, "hijklmn", 200)]
    docs = frame([(i, lang, text, None, None, None) for i, (lang, text) in enumerate(rows)], SCHEMA)
    model = langid.train(docs, precision=0.97)
    found = docs.select("lang", langid.language(docs.text, model).alias("f")).select("lang", "f.lang", "f.score", "f.rejected")
    found = [tuple(r) for r in found.collect()]
    sure, unsure = [r for r in found if not r[3]], [r for r in found if r[3]]
    assert sum(r[0] == r[1] for r in sure) / len(sure) > 0.95 and len(sure) > 350 and len(unsure) > 120
    assert abs(sum(r[2] for r in unsure) / len(unsure) - 0.5) < 0.15
    strange = frame([("Привет как дела",), ("漢字",)], "text string").select(langid.language("text", model).alias("f"))
    assert all(r.f.rejected and r.f.score < 0.9 for r in strange.collect())


def test_odd_rows_and_empty_tables(frame):
    texts = [*brute.ODD_TEXTS, "Same text here", "123 !?", "é" * 3_000_000]
    langs = ["en", None, "de"]
    docs = frame([(None if i == 3 else i % 9, langs[i % 3], t, "s", "d", "f") for i, t in enumerate(texts)], SCHEMA)
    model = langid.train(docs)
    assert model.languages == ["de", "en"]
    rows = docs.select("text", langid.language(docs.text, model).alias("f")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        has_letter = any(c.isalpha() for c in row.text or "")
        assert (row.f.lang == "und") == (not has_letter) and (row.f.score > 0) == has_letter
    same = {(r.f.lang, r.f.score) for r in rows if r.text == "Same text here"}
    assert len(same) == 1
    nothing = langid.train(docs.limit(0))
    assert nothing.languages == [] and langid.train(docs.filter("lang is null")).languages == []
    rows = docs.select(langid.language(docs.text, nothing).alias("f")).collect()
    assert all(tuple(r.f) == ("und", 0.0, True) for r in rows)
    assert docs.limit(0).select(langid.language(docs.text, model)).count() == 0


def test_one_language_and_few_rows():
    counts = next(langid.subword_counts(["hello"]))
    buckets = np.flatnonzero(counts)
    bag = buckets.astype("<u2").tobytes() + (counts[buckets] / counts.sum()).astype("<f4").tobytes()
    model = langid.fit([("en", 4, bag)])
    assert model.languages == ["en"] and math.isclose(float(model.probabilities(counts).sum()), 1, rel_tol=1e-6)
