"""Tokenizer, toxicity, importance resampling, url filters."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerforge.llm import bpe, importance, queries, toxicity, urls
from tests.compare import connect, difference, oracle_result, spark_result
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


# -- byte pair encoding -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_encode_like_the_library(ranks, reference):
    cut, rnd = bpe.word_pattern(public_tokenizers.PATTERN).findall, random.Random(1)
    bits = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "é", "'s", "'", "1", "½", "²"]
    bits += ["!", "…", "漢", "🙂", "_", "ing", "ABC", "\u0301", "\ufeff", "\u180e", "\u200b"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    for text in [*texts, "a" * 4000, "!" * 999 + "ab" * 999]:
        assert [i for w in cut(text) for i in bpe.encode_word(w.encode(), ranks)] == reference.encode_ordinary(text)


def test_packed_numbers_round_trip():
    for numbers in ([], [0], [127, 128, 0, 16383, 16384, 5, 1 << 30], list(range(400))):
        assert bpe._unpack(bpe._pack(np.array(numbers, int))).tolist() == numbers


@pytest.mark.parametrize("block", [1 << 24, 50, 3000])
def test_documents_encode_and_decode(spark, frame, ranks, reference, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
    monkeypatch.setattr(bpe, "LAY_OUT_WORDS", 100)
    texts = [*brute.ODD_TEXTS, "Same text here", "\x00\xff naïve", " lead", "trail "]
    docs = frame([(None if i == 1 else i % 11, t) for i, t in enumerate(texts)], DOCS)
    found = bpe.encode(docs, ranks, public_tokenizers.PATTERN).withColumn("back", bpe.decode(F.col("ids"), ranks))
    rows = sorted((repr(r.doc_id), r.ids, bytes(r.back)) for r in found.collect())
    expected = [(repr(r.doc_id), reference.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    assert rows == sorted(expected)
    assert bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("block, section, buckets", [(50, 50, 3), (50, 400, 1), (3000, 1 << 20, 4096), (1, 1, 2)])
def test_sections_of_any_size_encode_alike(frame, ranks, reference, block, section, buckets):
    texts = [*brute.ODD_TEXTS, *(f"doc {i} says {i % 3} words, naïve \n" for i in range(40))]
    docs = frame(list(enumerate(texts)), DOCS).repartition(3)
    limits = {"buckets": buckets, "block_chars": block, "section_chars": section}
    found = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="ids_back", **limits)
    assert found.columns == ["doc_id", "ids", "ids_back"]
    rows = sorted((r.doc_id, r.ids, bytes(r.ids_back)) for r in found.collect())
    assert rows == [(i, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(texts)]


def test_a_section_needs_all_its_ids(ranks):
    pool = bpe._Pool(7)
    word = {"data": bpe._shrink(b"\1\0\0\0"), "sizes": bpe._shrink(b"\1\0\0\0")}
    pool.add({**word, "numbers": bpe._shrink(bpe._pack(np.array([1])))})
    with pytest.raises(RuntimeError):
        pool.close()


def test_decoding_unknown_ids(frame, ranks):
    rows = frame([([1, 2],), ([],), (None,), ([999999],), ([-1],)], "ids array<int>").select(bpe.decode(F.col("ids"), ranks).alias("b"))
    assert [r.b is None for r in rows.collect()] == [False, False, True, True, True]


# -- toxicity ---------------------------------------------------------------------------------


def levenshtein(a, b):
    """Edits of one letter, and swaps of neighbours that are not edited otherwise."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                best = min(best, rows[i - 2][j - 2] + 1)
            rows[i].append(best)
    return rows[-1][-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(3)
    terms = ["".join(rnd.choice("abc") for _ in range(rnd.randint(3, 10))) for _ in range(25)]
    automaton = toxicity.LexiconAutomaton(terms, [])
    for _ in range(3000):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 11)))
        near = [(levenshtein(word, t), t) for t in terms if levenshtein(word, t) <= toxicity.allowed_edits(t)]
        assert automaton.match(word) == min(near, default=None)


def test_stems_take_any_ending():
    automaton = toxicity.LexiconAutomaton(["idiot"], ["lowei"])
    assert automaton.match("loweischaft") == (0, "lowei") and automaton.match("lowe") is None
    assert automaton.match("id1ot") == (1, "idiot") and automaton.match("idiotic") is None


MODEL = toxicity.ToxicityModel({"idiot": 9.0, "worthless": 9.0, "lowei*": 8.0}, 0.1, 0.001, frozenset({"idiom"}))


def test_context_separates_quotation_from_abuse():
    judge = toxicity._Judge(MODEL)
    abuse = judge.score("you are a worthless person")
    quoted = judge.score('the report said the word "worthless" appeared once')
    assert abuse > 0.9 and quoted < toxicity.THRESHOLD
    assert judge.score("what an idioot, honestly") > toxicity.THRESHOLD
    assert judge.score("a common idiom") == judge.score("") == MODEL.quiet_rate


@pytest.mark.parametrize(
    "text, toxic",
    [
        ('he said "you worthless idiot" yesterday', False),
        ("the word idiot is an insult", False),
        ('she wrote that "idiot" is rude', False),
        ("« idiot » est un mot", False),
        ("you are an idiot", True),
        ('you idiot, "nice" work', True),
        ("what an idiot, truly", True),
        ("they called him an idiot", True),
        ("such an idoit again", True),
        ("that wortlhess thing", True),
    ],
)
def test_quotation_abuse_and_misspelling(text, toxic):
    assert (toxicity._Judge(MODEL).score(text) >= toxicity.THRESHOLD) == toxic


def test_every_hit_counts():
    judge = toxicity._Judge(MODEL)
    scores = [judge.score("idiot " * n) for n in (1, 2, 3)]
    assert scores == sorted(set(scores)) and judge.score("idiot " * 200) == 1.0


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    scored = queries.op7_toxicity(spark, folder)
    rows = scored.join(labels, "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()
    counts = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert counts.get((1, 1), 0) >= 0.8 * (counts.get((1, 1), 0) + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.02 * counts[0, 0]


def test_toxicity_odd_rows(spark, frame):
    docs = frame([*enumerate(brute.ODD_TEXTS), (None, "idiot"), (99, "idiot"), (99, "idiot")], DOCS)
    labels = frame([(99, 1), (99, 0), (0, None), (None, 1), (5, 7)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    assert model.weights == {} and toxicity.train(docs, labels.limit(0)).base_rate == pytest.approx(0.05)
    kept = toxicity.without_toxic(docs, MODEL)
    assert kept.count() == len(brute.ODD_TEXTS) and kept.columns == docs.columns
    scores = docs.select(toxicity.toxicity(F.col("text"), MODEL).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scores) and scores[0].s == MODEL.quiet_rate


# -- importance resampling ------------------------------------------------------------------------


def test_top_share_is_exact(spark):
    rnd = random.Random(5)
    keys = [rnd.choice([-(1 << 62), -5, 0, 3, rnd.getrandbits(60) - (1 << 59)]) for _ in range(300)]
    scored = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key bigint, tie bigint")
    for share in (0.0, 0.003, 0.4, 0.61, 1.0):
        kept = {r.tie for r in importance.top_share(scored, "key", share).filter("kept").collect()}
        order = sorted(range(300), key=lambda i: (-keys[i], i))
        assert kept == set(order[: math.ceil(share * 300)])


def test_weights_are_log_ratios(spark, frame):
    docs = frame([(1, "good words here", True), (2, "bad bad bad", False), (3, None, None), (4, "", True)], f"{DOCS}, good boolean")
    ratios = importance.train(docs, F.col("good"), buckets=997)
    found = docs.select("doc_id", importance.log_weight(F.col("text"), ratios).alias("w")).collect()
    weight = {r.doc_id: r.w for r in found}
    assert weight[1] > 0 > weight[2] and weight[3] == weight[4] == 0
    counts = {"raw": 10 + 997, "target": 5 + 997}  # three words and two pairs; the bad ones as many, smoothed
    expected = 5 * (math.log(2 / counts["target"]) - math.log(2 / counts["raw"]))
    assert weight[1] == pytest.approx(expected)
    assert not importance.train(docs, F.lit(None).cast("boolean")).any()


def test_resampling_prefers_good_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op2_importance(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    assert found.filter("kept").count() == math.ceil(queries.KEPT_SHARE * found.count())
    held_out = found.join(labels, "doc_id").filter(queries.held_out())
    share = {r.quality: r.share for r in held_out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.95 and share[0] < 0.15


def test_gumbel_noise(spark):
    noise = np.array([r.g for r in spark.range(20000).select(importance.gumbel(F.col("id")).alias("g")).collect()])
    assert abs(noise.mean() - 0.5772) < 0.05 and abs(noise.var() - math.pi**2 / 6) < 0.1
    again = spark.range(5).select(importance.gumbel(F.col("id")).alias("g")).collect()
    assert [r.g for r in again] == noise[:5].tolist()


def test_resampling_odd_rows(frame):
    docs = frame([*enumerate(brute.ODD_TEXTS), (None, "x"), (None, "x"), (3, "x")], DOCS)
    found = importance.resample(docs, importance.train(docs, F.col("doc_id") > 4), 0.5).collect()
    assert len(found) == docs.count() and sum(r.kept for r in found) == 7
    assert importance.resample(docs.limit(0), np.zeros(10), 0.5).count() == 0


def test_resampling_takes_very_long_texts(frame):
    texts = ["x " * 1_200_000, "x " * 1_000_000, "x", "x x", ""]  # two n-grams a word: sums below -2**23
    found = importance.resample(frame([*enumerate(texts)], DOCS), np.full(10, -9.0), 0.8).collect()
    assert min(r.log_weight for r in found) < -(1 << 24)
    assert {r.doc_id for r in found if r.kept} == {1, 2, 3, 4}


def test_sortable_orders_like_the_double(frame):
    rnd = random.Random(8)
    values = [0.0, -0.0, 1e308, -1e308, 5e-324, -5e-324, 8.5e6, -9e7, *(rnd.uniform(-1, 1) * 10 ** rnd.randint(-9, 12) for _ in range(300))]
    keys = [r.key for r in frame([(v,) for v in values], "v double").select(importance.sortable("v").alias("key")).collect()]
    order = sorted(range(len(values)), key=lambda i: keys[i])
    assert [values[i] for i in order] == sorted(values) and keys[0] == keys[1]


# -- url filters --------------------------------------------------------------------------------

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://NET",
    "http://net/",
    "x://a.net/en/1?q#f",
    "http://example.net/en/",
    "http://a.example.net/en/b",
    "http://a.example.net/e",
    "http://badexample.net/en/",
    "http://example-x.net/",
    "http://example.com/de",
    "http://www.example.com/de/1",
    "http://u:p@example.com:80/de/",
    "http://de.org/fr/x",
    "http://org/fr/",
    "http://a..net/",
    "http://net./",
    "http://.net/",
    "http://é.org/fr/é",
    "http://a.b/http://x.net/",
    "http://deep.a.b.c.example.net/en/\nnew",
    "http://a.net?x=/",
]


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate(brute.LOWER), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), a == "block", h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("partitions", ["1", "4"])
def test_urls_equal_brute_force(spark, frame, partitions):
    rules = [*queries.URL_RULES, ("c.example.net", "/", "allow"), ("b.c.example.net", "/en/", "block"), ("org", "/fr/", "block")]
    pages = frame([(i % 20, u, "x") for i, u in enumerate(URLS * 2)], "page_id int, url string, rule string")
    given = frame([*rules, rules[0], (None, "/", "block")], "host string, path string, action string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = urls.judge_urls(pages, given)
        assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(rows) == 2 * len(URLS)
    for row in rows:
        assert (row.host, row.path, row.rule, row.verdict) == judged(row.url, rules), row.url
    assert urls.judge_urls(pages.limit(0), given).count() == 0
    assert {r.verdict for r in urls.judge_urls(pages, given.limit(0), default="block").collect()} == {"block"}


# -- SQL ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op5_decontamination", "op8_url_filter", "op9_line_dedup", "op10_near_vectors"])
def test_query_equals_sql(spark, name):
    assert difference(spark_result(spark, name, FOLDER), oracle_result(connect(FOLDER), name)) is None
