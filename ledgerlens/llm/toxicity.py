"""Toxicity scores by boosted trees over dense text features, calibrated by isotonic regression.

Features: density and reach of a lexicon, its nearness to words of address, capitals, punctuation and obfuscation. The
lexicon is learned: whole words and word beginnings that labelled toxic texts hold far more often than others. Texts
are read once; trees and calibration are Spark ML models and score inside the JVM.

Fitting uses FIT_ROWS labelled rows at most, chosen by a hash of the document's number: four parts in five grow trees,
the last part calibrates them. All documents are scored on their whole texts.

Defined cases: null and empty texts have all features 0 and get a score like any other; unlabelled rows (null label) are
not learned from; without rows of both labels every score is the share of label 1 (0 without rows); repeated rows are
scored alike. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import written

FIT_ROWS = 10_000
SLICE_ROWS = 500  # of a batch that are worked on and passed on at a time
LEXICON = 400  # entries at most
LEAST_TEXTS = 5  # toxic texts that an entry must be in
LEAST_ODDS = 2.0  # log odds of an entry
BEGINNINGS = (4, 5, 6)  # letters
NEAR = 5  # words between an address and a lexicon word

LETTER_RUN = re.compile(r"[^\W\d_]+")
MARKS_INSIDE = re.compile(r"[^\W_][@$*#!0134578]+[^\W_]|[^\W\d_]\*+|(?<!\w)[@$01345]+[^\W\d_]{2,}")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
# Stand-ins for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
ADDRESS = {"you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "toi", "te", "vous", "votre", "ton", "ta", "tú", "usted", "ustedes", "vosotros", "tus"}

FEATURES = [
    "lexicon_weight",
    "lexicon_density",
    "lexicon_words",
    "lexicon_strongest",
    "address_density",
    "address_near",
    "capital_share",
    "shouted_share",
    "exclamations",
    "questions",
    "punctuation",
    "obfuscated",
    "stretched",
    "log_words",
]


def stems(word: str) -> set[str]:
    """A word and its beginnings, as lexicon entries."""
    return {word} | {word[:n] + "*" for n in BEGINNINGS if len(word) > n}


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Entries with their log odds from (text, label); at most LEXICON of them reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: Counter = Counter()
            toxic: Counter = Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                entries: set[str] = set()
                for word in set(LETTER_RUN.findall((text or "").lower())):
                    entries |= stems(word)
                texts.update(entries)
                if label == 1:
                    toxic.update(entries)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(texts), pa.string()), pa.array(list(texts.values()), pa.int64()), pa.array([toxic[e] for e in texts], pa.int64())],
                names=["entry", "texts", "toxic"],
            )

    n = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    counts = rows.select("text", "label").mapInArrow(count, "entry string, texts long, toxic long")
    sums = counts.groupBy("entry").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n["toxic"] + 1.0)) - F.log((F.col("texts") - F.col("toxic") + 0.5) / (n["n"] - n["toxic"] + 1.0))
    best = sums.withColumn("odds", odds).where((F.col("toxic") >= LEAST_TEXTS) & (F.col("odds") >= LEAST_ODDS))
    best = best.orderBy(F.desc("toxic"), F.desc("odds"), "entry").limit(LEXICON)
    return {r["entry"]: r["odds"] for r in best.collect()}


def features_of(text: str | None, lexicon: dict[str, float], known: dict[str, float]) -> list[float]:
    """Values in the order of FEATURES; ``known`` remembers the weight of each word met."""
    if not text:
        return [0.0] * len(FEATURES)
    runs = LETTER_RUN.findall(text.lower())
    marked = MARKS_INSIDE.findall(text)
    plain = LETTER_RUN.findall(text.lower().translate(STAND_INS)) if marked else runs
    total = len(plain)
    if not total:
        return [0.0] * 10 + [len(text.translate(_NO_SPACE)) / len(text)] + [0.0] * 3
    weights = Counter(plain)
    weight = hits = strongest = 0.0
    words = set()
    for word, n in weights.items():
        w = known.get(word)
        if w is None:
            w = known[word] = max((lexicon.get(s, 0.0) for s in stems(word)), default=0.0)
        if w > 0.0:
            weight += n * w
            hits += n
            words.add(word)
            strongest = max(strongest, w)
    addressed = sum(weights[a] for a in ADDRESS if a in weights)
    near = 0
    if hits and addressed:
        at = np.array([i for i, w in enumerate(plain) if w in ADDRESS])
        weighty = np.array([i for i, w in enumerate(plain) if w in words])
        after = np.searchsorted(at, weighty)  # the word of address at or after each; the other neighbour is the one before
        gaps = np.minimum(np.abs(at[np.minimum(after, len(at) - 1)] - weighty), np.abs(at[np.maximum(after - 1, 0)] - weighty))
        near = int((gaps <= NEAR).sum())
    letters = sum(map(len, runs)) or 1
    capitals = sum(c.isupper() for c in text) if not text.isascii() else len(text) - len(text.translate(_NO_CAPITALS))
    shouted = len(SHOUTED.findall(text))
    marks = len(text) - len(text.translate(_NO_MARKS))
    return [
        weight / total,
        hits / total,
        float(len(words)),
        strongest,
        addressed / total,
        near / total,
        capitals / letters,
        shouted / total,
        text.count("!") / total,
        text.count("?") / total,
        marks / len(text),
        len(marked) / total,
        len(STRETCHED.findall(text)) / total,
        math.log1p(total),
    ]


SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
_NO_CAPITALS = {c: None for c in range(65, 91)}
_NO_MARKS = {ord(c): None for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"}
_NO_SPACE = {ord(c): None for c in " \t\n\r\x0b\x0c"}
KEPT_WORDS = 300_000


def with_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` (its text last) with the array ``features`` in place of the text."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            values = []
            for text in batch.column("text").to_pylist():
                if len(known) > KEPT_WORDS:
                    known.clear()
                values.append(features_of(text, lexicon, known))
            columns = [batch.column(c) for c in kept] + [pa.array(values, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "features"])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("features", T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float  # the score where there are no trees


def fit(docs: DataFrame, labels: DataFrame, trees: int = 20, depth: int = 3, seed: int = 11) -> Model:
    """Learn from (doc_id, text) and (doc_id, label); at most FIT_ROWS labelled rows, so these are broadcast."""
    rows = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    picked = rows.withColumn("_h", F.xxhash64("doc_id", F.lit(seed))).orderBy("_h", "doc_id").limit(FIT_ROWS)
    picked = written(picked, "toxic-labels")
    sample = written(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "toxic-sample")
    seen = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):
        return Model({}, None, None, float(seen.get(1, 0)) / max(1, sum(seen.values())))
    part = F.pmod(F.col("_h"), F.lit(5))
    lexicon = learn_lexicon(sample.where(part < 4))
    table = with_features(sample.select("doc_id", "label", part.alias("part"), "text"), lexicon)
    table = written(table, "toxic-features").withColumn("vector", array_to_vector("features"))
    grow = table.where("part < 4").select(F.col("label").cast("double").alias("label"), "vector")
    gbt = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32)
    if grow.select("label").distinct().count() < 2:
        return Model({}, None, None, float(seen[1]) / sum(seen.values()))
    model = gbt.fit(grow)
    margins = model.transform(table.where("part = 4")).select(
        F.col("label").cast("double").alias("label"), vector_to_array("rawPrediction")[1].alias("margin")
    )
    margins = written(margins, "toxic-margins")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins) if margins.count() else None
    return Model(lexicon, model, calibration, 0.0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the text, with score (0 to 1) and predicted.

    Isotonic calibration has steps; a thousandth of the uncalibrated probability keeps the order within a step.
    """
    kept = [c for c in docs.columns if c != "text"]
    if model.trees is None:
        out = docs.select(*kept, F.lit(model.base).alias("score"))
    else:
        rows = with_features(docs, model.lexicon).withColumn("vector", array_to_vector("features"))
        rows = model.trees.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1])
        raw = 1.0 / (1.0 + F.exp(-2.0 * F.col("margin")))
        if model.calibration is None:
            out = rows.select(*kept, raw.alias("score"))
        else:
            rows = model.calibration.setPredictionCol("calibrated").transform(rows)
            level = F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0))
            out = rows.select(*kept, (0.999 * level + 0.001 * raw).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
