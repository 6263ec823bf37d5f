"""The registered queries: each applies an operator to its whole table and derives digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.llm import bpe, collocations, decontaminate, importance, langid, lines, merkle, secrets, simhash, substrings, toxicity, urls, vectors


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sha256(text):
    return F.sha2(text.cast("binary"), 256)


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = secrets.secret_spans(F.col("text"), secrets.train(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "random")
    return docs.select("doc_id", found.alias("found")).select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        _sha256(listed(base)).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        count("random"),
    )


TARGET_ROWS = 20_000  # labelled good documents that the target model is learned from, the first by hash
KEPT_SHARE = 0.85


def op2_importance(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    target = (
        labels.filter((F.col("quality") == 1) & ~held_out())
        .select("doc_id", F.lit(True).alias("good"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TARGET_ROWS)
    )
    marked = docs.select("doc_id", "text").join(F.broadcast(target), "doc_id", "left")
    ratios = importance.train(marked, F.col("good"))
    return importance.resample(docs, ratios, KEPT_SHARE)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.without_repeated_windows(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", _sha256(F.col("kept")).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(F.col("text"), _table(spark, folder, "benchmark"))
    marked = _table(spark, folder, "documents").select("doc_id", hits.alias("hits"))
    hit = F.col("hits")
    return marked.select(
        "doc_id",
        hit["n_words"].alias("n_words"),
        decontaminate.hit_words(hit).alias("n_hit"),
        F.size(hit["items"]).cast("bigint").alias("n_items"),
        _sha256(F.concat_ws(",", hit["items"])).alias("items_sha256"),
        decontaminate.is_contaminated(hit).alias("contaminated"),
    )


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, decoded="decoded")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        _sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.train(docs, labels.filter(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


# The rules that op8 judges by.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = urls.judge_urls(_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    count = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint")
    kept = lines.without_repeated_lines(docs.withColumn("n_lines", count), words=lines.WORDS, removed="n_removed")
    return kept.select("doc_id", "n_lines", "n_removed", _sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op10_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = vectors.near_vectors(_table(spark, folder, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every third id by crc32 is checked with a text whose capitals A-Z were lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = {"text": F.translate("text", upper, upper.lower())}
    return merkle.manifest(
        _table(spark, folder, "documents"), changed=tampered, where=F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    )


def unlearned(doc_id: str = "doc_id"):
    """Rows that language identification never learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = langid.language(F.col("text"), langid.train(docs.filter(~unlearned())))
    judged = docs.select("doc_id", unlearned().alias("held_out"), found.alias("found"))
    return judged.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_importance": op2_importance,
    "op3_simhash": op3_simhash,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_line_dedup": op9_line_dedup,
    "op10_near_vectors": op10_near_vectors,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_language_id": op12_language_id,
    "op13_collocations": op13_collocations,
}
