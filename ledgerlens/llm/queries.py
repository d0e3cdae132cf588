"""The registered queries of this package: each applies its operator to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    jaccard,
    language,
    mixing,
    oracles,
    packing,
    pq,
    resampling,
    runs,
    secret_scan,
    sharding,
    substrings,
    topk,
    toxicity,
    urls,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(mod: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("tokens", mixing.token_count(F.col("text")))
    mixed = mixing.mixed(docs, max_repeats=2.0)
    return mixed.select("doc_id", "source", "tokens", "pass_no", "block_order", "doc_order")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels)
    return toxicity.scored(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != "lexed")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in secret_scan.KINDS],
        F.sha2(secret_scan.span_texts(base), 256).alias("base_sha256"),
        secret_scan.span_texts(F.col("spans")).alias("spans"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(4) == 2
    model = language.fit(docs.where(~held_out), public_tokenizers.path("piece_bpe_32k.model"))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), URL_RULES).drop("url")


def op11_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.interleaved(table(spark, sf_dir, "documents"), shards=24)
    return rows.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_periods(docs: DataFrame) -> DataFrame:
    """The contract's texts: where h % 10 = 0, word i from a on becomes word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("_h DIV 10")
    n, a = F.size("_w"), F.col("_a")
    period = F.expr("1 + (size(_w) - _a) DIV (3 + (_h DIV 10) % 8)")
    places = F.sequence(F.lit(0), n - 1)
    word = F.transform(places, lambda i: F.get("_w", F.when(i < a, i).otherwise(a + (i - a) % F.col("_p")).cast("int")))
    planted = (F.col("_h") % 10 == 0) & (n > 0)
    words = F.when(F.col("_h") % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({runs.WORDS})")))
    rows = docs.select("doc_id", "text", h.alias("_h")).withColumn("_w", words)
    rows = rows.withColumn("_a", F.when(planted, g % n)).withColumn("_p", F.when(planted, period))
    return rows.select("doc_id", F.when(planted, F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapsed(with_periods(table(spark, sf_dir, "documents")))
    best = runs.longest_run(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.sha2(runs.run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("(1000 * length) DIV period"))


QUERIES = {
    f.__name__: f
    for f in [
        op1_best_fit_packing,
        op2_source_mixing,
        op3_toxicity,
        op4_secret_scan,
        op5_substring_dedup,
        op6_ngram_jaccard,
        op7_embedding_near_dedup,
        op8_language_id,
        op9_exact_top_k,
        op10_url_filter,
        op11_interleaved_shards,
        op12_importance_resampling,
        op13_periodic_runs,
    ]
}
SQL = oracles.SQL
