"""Operators that find spans: secrets, decontamination, lines, substrings."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerforge.llm import decontaminate, lines, queries, secrets, substrings
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


def odd_documents(frame):
    return frame([*enumerate(brute.ODD_TEXTS), (None, "a b"), (3, "a b"), (3, "a b")], DOCS)


# -- secrets ------------------------------------------------------------------------------

TEXTS = [
    'password = "hunter2hunter2" and TOKEN: abcdefgh, api_key=\'short\' apikey="ABCDEFGH12"',
    "token=token=abcdefgh secret:token:abcdefghij passwd  ==x",
    "AKIAABCDEFGHIJKL AKIASHORT xAKIAAKIA1234567890 " + "0123456789abcdef" * 3 + "Z" + "deadbeef" * 4,
    "Key ſecret=longenough1 é password\n=abcdefghi",
    None,
    "",
]


def test_patterns_equal_brute_force():
    for text in TEXTS:
        found = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(secrets.pattern_spans(text or ""))]
        assert found == brute.secrets(text)


def random_strings(rnd, alphabet, count, length):
    return ["".join(rnd.choice(alphabet) for _ in range(length)) for _ in range(count)]


def test_models_find_random_strings_and_leave_identifiers(spark, frame):
    rnd = random.Random(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    prose = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text")
    labelled = [(f'the token = "{s}" was',) for s in random_strings(rnd, alphabet, 60, 40)]
    model = secrets.train(prose.union(frame(labelled, "text string")))
    hidden = random_strings(rnd, alphabet, 50, 32)
    found = sum(any(k == 3 for _, k, _ in secrets._scan(f"see {s} here", model)) for s in hidden)
    assert found >= 49
    names = ["get_the_thing_of_the_other", "internationalization-of-the", "--------------------------"]
    assert not any(k == 3 for n in names for _, k, _ in secrets._scan(f"see {n} here", model))


def test_secret_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in queries.op1_secret_scan(spark, FOLDER).collect():
        expected = brute.secrets(docs[row.doc_id])
        assert row.base_sha256 == brute.sha(",".join(expected))
        assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == expected
        assert row.n_hex == sum(s.startswith("hex") for s in expected)


def test_secrets_odd_rows(spark, frame):
    docs = odd_documents(frame)
    model = secrets.train(docs)
    assert model is None and secrets.train(docs.limit(0)) is None
    found = docs.select(secrets.secret_spans(F.col("text"), model).alias("s")).collect()
    assert len(found) == docs.count() and found[0].s == []


# -- decontamination ------------------------------------------------------------------------

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, "short ITEM"),
    (3, ""),
    (4, None),
    (None, "no id here at all"),
    (2, "short item"),
    (10, "éa eé"),
]
PROBES = [
    "x One, two three FOUR five six seven eight nine ten eleven twelve thirteen y short-item z",
    "one two three four five six seven eight nine ten eleven twelve",
    "no id here at all",
    "ÉA eé éa eé short item short item " + "pad " * 200,
    *brute.ODD_TEXTS,
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_hits_equal_brute_force(spark, frame, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    docs = frame(list(enumerate(PROBES)), DOCS)
    bench = frame(ITEMS, "item_id bigint, text string")
    rows = docs.select("doc_id", "text", decontaminate.benchmark_hits(F.col("text"), bench).alias("h")).collect()
    assert len(rows) == len(PROBES)
    for row in rows:
        count, hit, found = brute.contamination(row.text, ITEMS)
        assert row.h.n_words == count
        assert {i for s in row.h.spans for i in range(s.start, s.stop)} == hit
        assert row.h["items"] == sorted(found - {"None"})


def test_decontaminate_removes_documents_or_spans(spark, frame):
    rows = [(1, "keep me", 1), (2, "no, short Item! yes", 2), (3, None, 3), (4, "short item " + "pad " * 60, 4)]
    docs = frame(rows, "doc_id bigint, text string, _work int")
    bench = frame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.orderBy("doc_id").collect()] == [1, 3, 4]
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[2] == "no, ! yes" and cut[1] == "keep me" and cut[3] is None and cut[4] == " " + "pad " * 60
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == 4
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, bench, remove="words")


# -- lines ----------------------------------------------------------------------------------


def line_documents(seed, count=40):
    rnd = random.Random(seed)
    return [(i, "\n".join(rnd.choice("aabbcdefgh") for _ in range(rnd.randint(1, 14)))) for i in range(count)]


@pytest.mark.parametrize("run", [2, 3])
def test_lines_equal_brute_force(spark, frame, run):
    docs = line_documents(run)
    gone = brute.repeated([(d, t.split("\n")) for d, t in docs], run)
    found = lines.without_repeated_lines(frame(docs, DOCS), run=run, removed="n").collect()
    assert len(found) == len(docs)
    for row in found:
        own = dict(docs)[row.doc_id].split("\n")
        assert row.text == "\n".join(x for i, x in enumerate(own) if i not in gone[row.doc_id])
        assert row.n == len(gone[row.doc_id])


def test_lines_odd_rows(spark, frame):
    rows = [(1, "a\nb\nc", 1), (None, "a\nb\nc", 2), (2, None, 3), (3, "", 4), (1, "a\nb\nc", 5), (4, "\n" * 9, 6)]
    docs = frame(rows, "doc_id bigint, text string, _starts int")
    found = {r._starts: r.text for r in lines.without_repeated_lines(docs).collect()}
    # Repeated rows are one document; a null id comes last; empty lines repeat within a document.
    assert found == {1: "a\nb\nc", 2: "", 3: None, 4: "", 5: "a\nb\nc", 6: ""}
    assert lines.without_repeated_lines(docs.limit(0)).columns == docs.columns


def test_lines_take_short_runs_of_many_words(spark, frame):
    rnd = random.Random(4)
    passages = [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (4, 8, 9, 15, 30)]
    docs = [(i, "\n".join(rnd.choice(passages) if rnd.random() < 0.5 else f"own {rnd.random()}" for _ in range(rnd.randint(1, 6)))) for i in range(60)]
    seen, gone = set(), {d: set() for d, _ in docs}
    for doc, text in docs:
        own = text.split("\n")
        for at, size in [(i, n) for i in range(len(own)) for n in (1, 2, 3) if i + n <= len(own)]:
            window = tuple(own[at : at + size])
            if size == 3 or sum(len(x.split()) for x in window) >= 15:
                gone[doc] |= set(range(at, at + size)) if window in seen else set()
                seen.add(window)
    found = lines.without_repeated_lines(frame(docs, DOCS), words=15, removed="n").collect()
    assert any(gone[d] and t.count("\n") < 2 for d, t in docs) and len(found) == len(docs)
    for row in found:
        own = dict(docs)[row.doc_id].split("\n")
        assert (row.text, row.n) == ("\n".join(x for i, x in enumerate(own) if i not in gone[row.doc_id]), len(gone[row.doc_id]))


def test_lines_selected_at_one_position_are_dropped(spark, frame):
    docs = frame([(i, "\n".join(f"{i} {j}" for j in range(30))) for i in range(20)] + [(99, "7 1\n7 2\n7 3")], DOCS)
    places = docs.select(F.explode(lines.line_windows(F.col("text"), 3)).alias("w")).select("w.*")
    shared = lines.shared_marks(places)
    assert shared.count() == 1 and places.join(shared, "mark", "left_semi").count() <= 4


# -- substrings -------------------------------------------------------------------------------


def check_substrings(spark, frame, docs, window, gram):
    found = substrings.without_repeated_windows(frame(docs, DOCS), window=window, gram=gram).collect()
    gone = brute.repeated([(d, brute.words(t)) for d, t in docs], window)
    assert len(found) == len(docs)
    for row in found:
        own = brute.words(dict(docs)[row.doc_id])
        assert (row.n_words, row.n_removed) == (len(own), len(gone[row.doc_id]))
        assert row.kept == " ".join(w for i, w in enumerate(own) if i not in gone[row.doc_id])
        assert {i for a, b in row.spans for i in range(a, b)} == gone[row.doc_id]


@pytest.mark.parametrize("split", [256, 1])
def test_substrings_equal_brute_force(spark, frame, monkeypatch, split):
    monkeypatch.setattr(substrings, "SPLIT", split)
    monkeypatch.setattr(substrings, "BLOCK_ROWS", 50)
    rnd = random.Random(split)
    passage = [rnd.choice("abcdefgh") for _ in range(30)]
    docs = []
    for i in range(60):
        text = [rnd.choice("abc" if i % 5 else "ab") for _ in range(rnd.randint(0, 40))]
        at = rnd.randint(0, len(text))
        cut = sorted(rnd.sample(range(31), 2))
        docs.append((i, " ".join(text[:at] + passage[cut[0] : cut[1]] + text[at:])))
    check_substrings(spark, frame, docs, 6, 3)


def test_substrings_odd_rows(spark, frame):
    check_substrings(spark, frame, list(enumerate(brute.ODD_TEXTS)), 20, 5)
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (7, "a b c d e")]
    found = substrings.without_repeated_windows(frame(rows, DOCS), window=3, gram=2).collect()
    removed = sorted((repr(r.doc_id), r.n_words, r.n_removed) for r in found)
    # Equal rows are one document; its id's other text comes later by hash; null comes last.
    assert removed == [("7", 4, 0), ("7", 4, 0), ("7", 5, 4), ("None", 4, 4)]
    assert substrings.without_repeated_windows(frame([], DOCS)).count() == 0


@pytest.mark.parametrize("split", [256, 1])
def test_substrings_equal_brute_force_at_wide_windows(spark, frame, monkeypatch, split):
    monkeypatch.setattr(substrings, "SPLIT", split)
    rnd = random.Random(split)
    passage = [f"w{rnd.randint(0, 10**6)}" for _ in range(200)]
    docs = []
    for i in range(30):
        cut = sorted(rnd.sample(range(201), 2))
        own = [f"o{rnd.randint(0, 10**6)}" for _ in range(120)]
        docs.append((i, " ".join(own[:60] + passage[cut[0] : cut[1]] + own[60:])))
    check_substrings(spark, frame, docs, 50, 5)


def test_automaton_matching_statistics():
    rnd = random.Random(9)
    texts = [[rnd.choice("ab") for _ in range(rnd.randint(1, 12))] for _ in range(8)]
    automaton = substrings.SuffixAutomaton()
    for n, text in enumerate(texts):
        known = {tuple(t[i:j]) for t in texts[:n] for i in range(len(t)) for j in range(i, len(t) + 1)} | {()}
        longest = [max(k for k in range(i + 2) if tuple(text[i + 1 - k : i + 1]) in known) for i in range(len(text))]
        assert automaton.matching_statistics(text) == longest
        automaton.add(text)


def test_last_of_the_smallest():
    values = np.array([5, 2, 2, 9, 1, 7, 1, 3])
    for width in range(1, 9):
        runs = [values[i : i + width] for i in range(len(values) - width + 1)]
        expected = [i + width - 1 - int(np.argmin(r[::-1])) for i, r in enumerate(runs)]
        assert substrings._smallest(values, width).tolist() == expected
