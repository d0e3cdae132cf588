"""From raw documents to packed sequences: each stage works on what the one before it kept.

Stages but the last return the columns of documents, whatever those are; ``run`` writes every stage's rows to the
shared folder and reads them again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import jaccard, language, mixing, packing, secret_scan
from ledgerlens.session import written

MIN_LANGUAGE_SCORE = 0.5  # least probability of the best language
MAX_REPEATS = 2.0  # passes over the smallest source


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, in one of the languages that the labelled ones have.

    Rejected: no letter at all (null and empty texts too), no language with a probability over one half, or letters that
    fit the likeliest language far worse than labelled texts do (other languages and scripts, noise).
    """
    labelled = written(language.different(docs), "labelled")
    model = language.fit(labelled, public_tokenizers.path("piece_bpe_32k.model"), docs_per_language=None)
    names = [_free(docs, n) for n in ("lang_pred", "score", "n_letters", "fit")]
    known = written(language.identify(docs, model, names=names), "identified")
    fits = known.where("text IS NOT NULL AND lang IS NOT NULL").groupBy(F.xxhash64("text"), "lang").agg(F.first(names[3]).alias("fit"))
    least = language.least_fit(written(fits.select("fit"), "fits"))
    known = known.where((F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= MIN_LANGUAGE_SCORE))
    known = known.where(F.col(names[3]) >= least)
    return known.select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that links hold together: the one with the smallest doc_id.

    Documents without words, and rows without a doc_id, are in no group and stay. Where rows share a doc_id, each text
    counts for itself.
    """
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        groups = written(jaccard.similarity_components(docs), "groups")
        gone = _free(docs, "gone")
        others = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(gone))
        return docs.join(others, F.col("doc_id") == F.col(gone), "left_anti")
    row = _free(docs, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts = numbered.where("doc_id IS NOT NULL")
    groups = jaccard.similarity_components(texts.select(F.col(row).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_member"), F.col("component_id").alias("_group"))
    named = texts.select("doc_id", row).join(groups, F.col(row) == F.col("_member"))
    first = named.groupBy("_group").agg(F.min(F.struct("doc_id", "_member"))["_member"].alias(row))
    kept = numbered.join(written(first.select(row), "first"), row, "left_semi").select(*[f"`{c}`" for c in numbered.columns])
    return kept.union(numbered.where("doc_id IS NULL")).drop(row)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; every secret is replaced by its kind in brackets, and n_chars follows the text."""
    spans = _free(docs, "spans")
    clean = secret_scan.scan(docs, redact=True, name=spans)
    if "n_chars" in docs.columns:
        chars = F.when(F.size(spans) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", chars)
    return clean.select(*[f"`{c}`" for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The flattest mix of the sources within MAX_REPEATS passes, of as many tokens as there are; a pass is a row."""
    return mixing.mixed(docs, max_repeats=MAX_REPEATS).select(*[f"`{c}`" for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("secret_scan", secrets),
    ("source_mixing", source_mix),
    ("best_fit_packing", packing_stage),
]

# Piece models, tokenizers and lexers have no SQL form; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
