"""Near-duplicate operators and components."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerforge.llm import queries, simhash, vectors
from ledgerforge.llm.components import connected_components
from ledgerforge.sources.staging import Staging
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


def test_components(spark):
    rnd = random.Random(4)
    chain = [(i, i + 1) for i in range(60)]
    star = [(500, i) for i in range(501, 700)]
    other = [(rnd.randint(1000, 1300), rnd.randint(1000, 1300)) for _ in range(200)]
    links = chain + star + other + chain[:5] + [(900, 900), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint"), Staging(spark, "test")).collect()
    nodes = {n for pair in chain + star + other for n in pair if pair[0] != pair[1]}
    expected = brute.components(nodes, [(a, b) for a, b in chain + star + other])
    assert {r.node: r.component for r in found} == {n: expected[n] for n in nodes}
    assert len(found) == len(nodes)


def test_no_links(spark):
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert connected_components(empty, Staging(spark, "test")).count() == 0


def test_golay_keys_meet():
    index, rnd = simhash.GolayIndex(), np.random.default_rng(1)
    words = rnd.integers(0, 1 << 23, 3000)
    keys = [set(row) for row in index.keys(words)]
    for _ in range(20):
        flips = (1 << rnd.integers(0, 23, 3000)) ^ (1 << rnd.integers(0, 23, 3000))
        for own, row in zip(keys, index.keys(words ^ flips)):
            assert own & set(row)


def test_fingerprints_within_two_bits_link(spark):
    rnd, rows = random.Random(2), []
    for _ in range(200):
        mark = rnd.getrandbits(64)
        for bits in range(5):
            rows.append(mark ^ sum(1 << b for b in rnd.sample(range(64), bits)))
    signed = [m - (1 << 64) if m >> 63 else m for m in set(rows)]
    found = simhash.fingerprint_links(spark.createDataFrame([(m,) for m in signed], "fingerprint bigint"))
    pairs = {(r.a, r.b) for r in found.collect()}
    near = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}
    assert pairs == near
    with pytest.raises(ValueError):
        simhash.fingerprint_links(found, 3)


def test_simhash_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    expected = brute.simhash_groups(docs)
    found = queries.op3_simhash(spark, FOLDER).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == expected
    assert len(found) == len(docs)


def test_simhash_odd_rows(spark, frame):
    docs = frame([*enumerate(brute.ODD_TEXTS), (None, "Same text here"), (2, "another text"), (2, "another text")], DOCS)
    found = sorted(map(tuple, simhash.simhash_components(docs).collect()), key=repr)
    assert len(found) == docs.count()
    by_id = {d: (m, c) for d, m, c in found if d is not None and d != 2}
    assert [by_id[i] for i in (0, 1, 3)] == [(0, 0)] * 3 and by_id[6][1] == by_id[7][1] == 6
    assert [c for d, _, c in found if d is None] == [None]
    assert [c for d, _, c in found if d == 2].count(2) == 2  # both copies of the other text


def test_one_of_each_group_stays(spark, frame):
    rows = [(1, "a b c d", 5), (2, "a b c d", 5), (1, "a b c d", 6), (None, "a b c d", 7), (3, None, 8), (4, "", 9)]
    docs = frame(rows, "doc_id bigint, text string, _work int")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.dropna(subset=["doc_id"]).collect()) == [1, 3]
    assert kept.filter("doc_id is null").count() == 1
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0


VECTORS = "vec_id bigint, embedding array<float>, label int, links string"


def near_by_brute_force(rows):
    ok = {
        i: np.array(v, float)
        for i, v, g, _ in rows
        if v is not None and g is not None and None not in v and np.isfinite(v).all() and np.any(v)
    }
    group = {i: g for i, _, g, _ in rows}
    links = [
        (a, b)
        for a in ok
        for b in ok
        if a < b
        and group[a] == group[b]
        and len(ok[a]) == len(ok[b])
        and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= 0.93
    ]
    groups = brute.components([r[0] for r in rows], links)
    return {i: (sum(i in link for link in links), groups[i]) for i in groups}


@pytest.mark.parametrize("block", [4096, 25])
def test_vectors_equal_brute_force(spark, frame, block):
    rnd, rows = np.random.default_rng(3), []
    for label in (1, 2, None):
        for _ in range(12):
            base = rnd.normal(size=24) * 10.0 ** rnd.integers(-20, 12)
            for spread in (0, 0, 0.2, 0.35, 0.4, 0.45):
                vector = base + spread * np.abs(base).mean() * rnd.normal(size=24)
                rows.append((len(rows), np.float32(vector).tolist(), label, "x"))
    odd = [None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0], [2.0], [-0.0, 1.0]]
    rows += [(len(rows) + n, v, 1, "x") for n, v in enumerate(odd)]
    found = vectors.near_vectors(frame(rows, VECTORS), block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == near_by_brute_force(rows)
    assert len(found) == len(rows)


def test_vectors_empty_and_repeated(spark, frame):
    assert vectors.near_vectors(frame([], VECTORS)).count() == 0
    rows = [(1, [1.0, 2.0], 1, ""), (1, [1.0, 2.0], 1, ""), (None, [1.0, 2.0], 1, "")]
    found = vectors.near_vectors(frame(rows, VECTORS)).collect()
    assert sorted(map(repr, ((r.vec_id, r.n_links, r.component_id) for r in found))) == sorted(
        map(repr, [(1, 1, 1), (1, 1, 1), (None, 0, None)])
    )


def test_quantisation_bound_is_rigorous():
    rnd = np.random.default_rng(5)
    unit = rnd.normal(size=(400, 64))
    unit[:200] = unit[:200] + 0.4 * unit[200:]
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    for threshold in (0.2, 0.35, 0.93):
        coarse = vectors.Quantised(unit)
        rows, columns = vectors.possible_pairs(coarse, coarse, threshold, slice(0, 400))
        assert set(zip(*np.nonzero(unit @ unit.T >= threshold))) <= set(zip(rows, columns))


def test_no_python_on_the_url_path(spark):
    plan = queries.op8_url_filter(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert F is not None
