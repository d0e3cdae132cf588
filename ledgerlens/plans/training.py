"""Model training, comparison and batch scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import is_numeric
from ledgerlens.operators.curves import roc_auc, threshold_for_recall
from ledgerlens.operators.enrich import enrich_identity
from ledgerlens.operators.guards import ID_COLUMN, TARGET_COLUMN, check_feature_contract, fail_on_violations
from ledgerlens.operators.policy import (
    best_policy,
    metrics_at_threshold,
    policy_rows,
    select_operating_threshold,
    threshold_table,
)
from ledgerlens.operators.profile import scale_pos_weight
from ledgerlens.operators.splits import split_by_time_ratio, split_summary
from ledgerlens.plans import features_v2
from ledgerlens.session import written

SPLITS = ["train", "validation", "test"]
ROUNDS = 20  # boosting rounds at most
PATIENCE = 10  # rounds without a better validation AUC after which boosting stops
AT_ONCE = 4  # candidates that are fitted at the same time
FEATURES = "features"


@dataclass
class Trained:
    """A fitted model; of boosted trees also the validation AUC after each round, of which the best one's trees are kept."""

    model: PipelineModel
    inputs: list[str]
    auc_by_round: list[float] = field(default_factory=list)

    @property
    def best_round(self) -> int | None:
        return best_round(self.auc_by_round) if self.auc_by_round else None


def model_inputs(features: DataFrame, state: features_v2.FitState) -> list[str]:
    """Numeric features; each category column is represented by its training frequency."""
    texts = set(state.categorical) | set(features_v2.INTERACTION_TEXTS)
    fields = [f for f in features.schema.fields if f.name in state.features and f.name not in texts]
    return [f.name for f in fields if is_numeric(f.dataType)]


def feature_table(
    labelled: DataFrame, state: features_v2.FitState | None = None
) -> tuple[DataFrame, features_v2.FitState]:
    """Features of all splits with key, label and split, written once for the several models that read it.

    The labelled rows are written first, a folder per split, so that fitting
    reads the training rows without repeating the join and the split.
    """
    labelled = written(labelled, "labelled", ["split"])
    if state is None:
        train = labelled.where(F.col("split") == "train").drop("split", "score")
        state = features_v2.fit(train)
    table = features_v2.transform(labelled.drop("score"), state, keep=[ID_COLUMN, TARGET_COLUMN, "split"])
    return written(table, "feature-table", ["split"]), state


def classifier(family: str, weight_column: str | None = None, **params):
    common = {"featuresCol": FEATURES, "labelCol": TARGET_COLUMN}
    if weight_column:
        common["weightCol"] = weight_column
    if family == "gbt":
        return GBTClassifier(**{"maxIter": ROUNDS, "stepSize": 0.1, "maxDepth": 5, "seed": 42, **common, **params})
    if family == "forest":
        return RandomForestClassifier(**{"numTrees": 20, "maxDepth": 6, "seed": 42, **common, **params})
    if family == "logistic":
        return LogisticRegression(**{"maxIter": 50, "regParam": 0.01, **common, **params})
    raise KeyError(family)


def assembled(table: DataFrame, inputs: list[str]) -> DataFrame:
    """The table with its input vectors, written once for all the fits and scores that read them."""
    kept = [c for c in table.columns if c not in inputs]
    vectors = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(table)
    return written(vectors.select(*kept, FEATURES), "vectors", ["split"])


def staged_aucs(rows: DataFrame, model: GBTClassificationModel) -> list[float]:
    """Exact AUC of the model's first 1, 2, ... trees on ``rows``, all rounds ranked in one job.

    The margin after a round is the sum of its trees' weighted answers; the probability rises with it.
    """
    answers = rows.select(FEATURES, F.col(TARGET_COLUMN).alias("y"))
    for i, tree in enumerate(model.trees):
        answers = tree.setFeaturesCol(FEATURES).setPredictionCol(f"_tree_{i}").transform(answers)
    # Each margin is the one before and a tree: running sums in one array, not ever longer expressions.
    trees = F.array(*[F.col(f"_tree_{i}") * F.lit(float(w)) for i, w in enumerate(model.treeWeights)])
    running = F.aggregate(
        trees,
        F.array().cast("array<double>"),
        lambda done, x: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0.0)) + x)),
    )
    long = answers.select("y", F.posexplode(running).alias("round", "p"))
    found = {r["round"]: r["roc_auc"] for r in roc_auc(long, ["round"]).collect()}
    return [found.get(i) if found.get(i) is not None else 0.5 for i in range(len(model.trees))]


def best_round(aucs: list[float], patience: int | None = None) -> int | None:
    """The first round (from 1) with the highest AUC, looking no further than ``patience`` rounds after the best so far.

    With ``patience``, None if the rounds at hand don't show yet that boosting stops.
    """
    best = 0
    for i, value in enumerate(aucs):
        if value > aucs[best]:
            best = i
        if patience is not None and i - best >= patience:
            return best + 1
    return None if patience is not None else best + 1


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after ``rounds`` rounds."""
    jvm, java = SparkSession.active()._jvm, model._java_obj
    trees = SparkSession.active().sparkContext._gateway.new_array(
        jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds
    )
    weights = SparkSession.active().sparkContext._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], float(model.treeWeights[i])
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, model.numFeatures, 2)
    return GBTClassificationModel(java.copyValues(cut, java.extractParamMap()))


def boosted(rows: DataFrame, weight_column: str | None, patience: int, **params) -> tuple[GBTClassificationModel, list[float]]:
    """Boosted trees that stop when the validation AUC has not risen for ``patience`` rounds, cut to the best round.

    Trees are grown in doubling numbers of rounds, then all rounds are ranked: a longer fit begins with the same trees, so
    at most twice the rounds needed are grown.
    """
    most = params.pop("maxIter", ROUNDS)
    train, validation = rows.where("split = 'train'"), rows.where("split = 'validation'")
    rounds = min(most, 2 * patience)
    while True:
        model = classifier("gbt", weight_column, maxIter=rounds, **params).fit(train)
        aucs = staged_aucs(validation, model)
        stop = best_round(aucs, patience)
        if stop is not None:
            aucs = aucs[: stop + patience]
        if stop is not None or rounds == most:
            return first_trees(model, best_round(aucs)), aucs
        rounds = min(most, 2 * rounds)


def fit_vectors(
    vectors: DataFrame, inputs: list[str], family: str = "gbt", weight: float | None = None, patience: int = PATIENCE, **params
) -> Trained:
    """Fit one classifier on assembled rows of the training split; boosted trees stop on the AUC of the validation split."""
    if vectors.where("split = 'train'").isEmpty() or (family == "gbt" and vectors.where("split = 'validation'").isEmpty()):
        raise ValueError("Training or validation feature set is empty.")
    weight_column = None
    if weight is not None:
        weight_column = "_weight"
        vectors = vectors.withColumn("_weight", F.when(F.col(TARGET_COLUMN) == 1, float(weight)).otherwise(1.0))
    aucs: list[float] = []
    if family == "gbt":
        model, aucs = boosted(vectors, weight_column, patience, **params)
    else:
        model = classifier(family, weight_column, **params).fit(vectors.where("split = 'train'"))
    return Trained(PipelineModel([VectorAssembler(inputCols=inputs, outputCol=FEATURES), model]), inputs, aucs)


def train_model(
    table: DataFrame, inputs: list[str], family: str = "gbt", weight: float | None = None, patience: int = PATIENCE, **params
) -> Trained:
    """``fit_vectors`` on a feature table."""
    return fit_vectors(assembled(table, inputs), inputs, family, weight, patience, **params)


def fitted_together(spark: SparkSession, fits: dict[str, Callable[[], Trained]], at_once: int = AT_ONCE) -> dict[str, Trained]:
    """Run the fits at the same time, each in a scheduler pool of its own (fair where the session schedules fairly)."""

    def pooled(name: str, fit: Callable[[], Trained]) -> Callable[[], Trained]:
        def run() -> Trained:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            return fit()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(pooled(name, fit)) for name, fit in fits.items()}
        return {name: task.result() for name, task in running.items()}


def score(table: DataFrame, trained: Trained, name: str = "fraud_probability") -> DataFrame:
    """Probability of the positive class beside the input columns, from a feature table or from assembled rows."""
    model = trained.model.stages[-1] if FEATURES in table.columns else trained.model
    scored = model.transform(table)
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def batch_score(raw: DataFrame, state: features_v2.FitState, trained: Trained) -> DataFrame:
    """Transform with the saved state, check the feature contract (any violation is an error), attach the probability."""
    features = written(features_v2.transform(raw, state, keep=[ID_COLUMN]), "batch-features")
    fail_on_violations(features.drop(ID_COLUMN), state.features)
    return score(features, trained)


def scored_candidate(table: DataFrame, trained: Trained, candidate: str) -> DataFrame:
    return score(table, trained).select(
        ID_COLUMN,
        "split",
        F.lit(candidate).alias("candidate"),
        F.lit("trained").alias("status"),
        F.col(TARGET_COLUMN).alias("y"),
        F.col("fraud_probability").alias("p"),
    )


def weight_search(table: DataFrame, inputs: list[str], weights: list[float] | None = None, **params) -> DataFrame:
    """One boosted model per class weight; scored validation and test rows of all candidates."""
    if weights is None:
        row = scale_pos_weight(table.where(F.col("split") == "train")).first()
        weights = list(row["candidate_weights"])
    vectors = assembled(table, inputs)
    held_out = vectors.where(F.col("split") != "train")
    fits = {f"weight_{w:g}": (lambda w=w: fit_vectors(vectors, inputs, "gbt", w, **params)) for w in weights}
    models = fitted_together(table.sparkSession, fits)
    parts = [
        scored_candidate(held_out, models[f"weight_{w:g}"], f"weight_{w:g}").withColumn("scale_pos_weight", F.lit(float(w)))
        for w in weights
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def model_family_compare(
    table: DataFrame, inputs: list[str], candidates: dict[str, tuple[str, dict]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Scored held-out rows of the families that can be trained, and (candidate, family, status, reason)."""
    candidates = candidates or {
        "gbt_default": ("gbt", {}),
        "gbt_shallow": ("gbt", {"maxDepth": 3}),
        "forest_default": ("forest", {}),
        "logistic_default": ("logistic", {}),
    }
    scored, statuses, fits = None, [], {}
    vectors = assembled(table, inputs)
    held_out = vectors.where(F.col("split") != "train")
    for name, (family, params) in candidates.items():
        try:
            classifier(family)
        except KeyError as unavailable:
            statuses.append((name, family, "skipped", f"family not available: {unavailable}"))
            continue
        statuses.append((name, family, "trained", "available"))
        fits[name] = lambda family=family, params=params: fit_vectors(vectors, inputs, family, **params)
    for name, trained in fitted_together(table.sparkSession, fits).items():
        part = scored_candidate(held_out, trained, name)
        scored = part if scored is None else scored.unionByName(part)
    schema = "candidate string, model_family string, status string, reason string"
    return scored, table.sparkSession.createDataFrame(statuses, schema)


def family_policies(scored: DataFrame) -> DataFrame:
    """Best validation policy per alert-rate limit over all families."""
    validation = scored.where(F.col("split") == "validation")
    return best_policy(policy_rows(validation, ["candidate"], status="status"))


def train_pipeline(
    transactions: DataFrame,
    identity: DataFrame,
    target_recall: float = 0.95,
    state_path: str | None = None,
    **params,
) -> dict[str, DataFrame | Trained | float]:
    """Join, split, features, train, choose thresholds on validation, rate validation and test."""
    labelled = split_by_time_ratio(enrich_identity(transactions, identity))
    table, state = feature_table(labelled)
    inputs = model_inputs(table, state)
    trained = train_model(table, inputs, **params)
    scored = written(scored_candidate(table, trained, "gbt"), "scored")
    validation = scored.where(F.col("split") == "validation")
    threshold = threshold_for_recall(validation, [], target_recall).first()["threshold"]
    held_out = scored.where(F.col("split") != "train")
    metrics = metrics_at_threshold(held_out, threshold, ["split"])
    chosen = select_operating_threshold(threshold_table(validation))
    if state_path:
        features_v2.save_state(state, state_path, {"threshold": threshold})
        trained.model.write().save(f"{state_path}/model")
    return {
        "model": trained,
        "scored": scored,
        "threshold": threshold,
        "metrics": metrics,
        "selection": chosen,
        "comparison": threshold_table(held_out, ["split"]),
    }


def pipeline_dry_run(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """Join, split and features without training or artifacts: one row per split."""
    labelled = written(split_by_time_ratio(enrich_identity(transactions, identity)), "labelled", ["split"])
    train = labelled.where(F.col("split") == "train")
    state = features_v2.fit(train.drop("split", "score"))
    table = features_v2.transform(labelled.drop("score"), state, keep=[ID_COLUMN, TARGET_COLUMN, "split"])
    summary = split_summary(labelled)
    broken = check_feature_contract(table.select(*state.features), state.features).agg(F.count(F.lit(1))).scalar()
    texts = len(state.categorical) + len(features_v2.INTERACTION_TEXTS)
    return summary.drop("columns").withColumns(
        {
            "feature_count": F.lit(len(state.features)).cast("bigint"),
            "categorical_feature_count": F.lit(texts).cast("bigint"),
            "contract_violations": broken,
            "would_write_artifacts": F.lit(False),
        }
    )


def feature_importance(trained: Trained, table: DataFrame) -> DataFrame:
    """(feature, importance, rank) of a tree model: one row per input feature."""
    model: Model = trained.model.stages[-1]
    pairs = sorted(zip(trained.inputs, model.featureImportances.toArray().tolist()), key=lambda p: (-p[1], p[0]))
    rows = [(name, value, i + 1) for i, (name, value) in enumerate(pairs)]
    return table.sparkSession.createDataFrame(rows, "feature string, importance double, rank int")
