"""The Merkle manifest against trees built in plain Python."""

import pytest
from pyspark.sql import functions as F

from ledgerforge.llm import merkle, queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def manifest(docs, **options):
    where = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = {"text": F.translate("text", UPPER, UPPER.lower())}
    return merkle.manifest(docs, changed=changed, where=where, **options)


def test_the_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    found = plain(queries.op11_merkle_manifest(spark, FOLDER))
    assert found == sorted(brute.merkle(list(map(tuple, rows))), key=repr)
    assert {row[-1] for row in found} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (9, 1), (513, 64, 2, 1, 1, 1, 1, 8, 3)])
@pytest.mark.parametrize("superblock", [8, 512])
def test_trees_of_any_shape(frame, sizes, superblock):
    names = [None, "", "é", "en", "EN", "z", "en ", "-", "="]
    rows = [(1000 * g + i, "s", names[g], i, f"Text {i}") for g, size in enumerate(sizes) for i in range(size)]
    found = manifest(frame(rows, SCHEMA).repartition(3), superblock=superblock)
    assert plain(found) == sorted(brute.merkle(rows), key=repr)


def test_odd_rows(frame):
    texts = [*brute.ODD_TEXTS, "Same text here", "Same text here"]
    big = 2**62 + 1
    rows = [(None if i == 2 else big + i % 8, None, None if i % 3 else "en", None, t) for i, t in enumerate(texts)]
    docs = frame(rows, SCHEMA)
    clashing = docs.withColumn("digest", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("grp", F.lit("y"))
    for source in (docs, clashing):
        assert plain(manifest(source)) == sorted(brute.merkle(rows), key=repr)
    assert manifest(docs.limit(0)).count() == 0


def test_proofs_lead_from_leaf_to_root(frame):
    rows = [(i, None, "en" if i % 5 else "de", i, f"Text {i}") for i in range(90)]
    for row in merkle.manifest(frame(rows, SCHEMA), proofs=True, superblock=8).collect():
        digest = row.leaf
        for step in row.proof:
            digest = brute.sha(step.before + digest + step.after)
        assert digest == row.root == row.folded_root and row.verified


def test_a_superblock_is_a_power_of_eight(frame):
    with pytest.raises(ValueError):
        merkle.manifest(frame([], SCHEMA), superblock=100)
