"""The pipeline against the brute-force version of each stage on the stage before it."""

import public_tokenizers
import tiktoken

import corpus_pipeline
from ledgerforge.llm import bpe, toxicity
from ledgerforge.llm.queries import held_out
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter(~held_out())
    judge = toxicity._Judge(toxicity.train(table, labels))
    docs = {r.doc_id: r.text for r in table.collect()}
    docs = {d: t for d, t in sorted(docs.items()) if judge.score(t or "") < toxicity.THRESHOLD}

    gone = brute.repeated_lines([(d, (t or "").split("\n")) for d, t in docs.items()])
    docs = {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[d]) for d, t in docs.items()}

    groups = brute.simhash_groups(list(docs.items()))
    docs = {d: t for d, t in docs.items() if groups[d][1] == d}

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for d, t in list(docs.items()):
        count, hit, _ = brute.contamination(t, bench)
        if hit and 20 * len(hit) >= count:
            del docs[d]

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: r.ids for r in found} == {d: encoding.encode_ordinary(t) for d, t in docs.items()}
    assert all(r.decoded_sha256 == brute.sha(docs[r.doc_id]) and r.n_tokens == len(r.ids) for r in found)
    assert len(found) == len(docs) and 0 < len(docs) < table.count()


def test_stages_take_odd_rows(spark, frame):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string, hits string"
    texts = [*brute.ODD_TEXTS, "Same text here"]
    docs = frame([(None if i == 4 else i, t, None, None, None, "x", None) for i, t in enumerate(texts)], schema)
    for source in (docs, docs.limit(0)):
        rows = source
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, rows, FOLDER)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert after.columns == docs.columns, name
                rows = after
        assert after.count() <= source.count() and (after.count() > 0) == (source.count() > 0)
