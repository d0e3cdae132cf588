"""Training, comparison and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import JOINED, joined
from ledgerlens.catalog.registry import query
from ledgerlens.operators.curves import pr_curve
from ledgerlens.operators.guards import apply_threshold
from ledgerlens.operators.policy import metrics_at_threshold, policy_rows
from ledgerlens.operators.splits import split_by_time_ratio
from ledgerlens.plans import training


def _features(spark, sf_dir):
    table, state = training.feature_table(split_by_time_ratio(joined(spark, sf_dir)))
    return table, state, training.model_inputs(table, state)


# The splits as SQL, and what of the models' results doesn't depend on the engine that trains them.
SPLIT = f"""SELECT *, CASE WHEN r <= CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
      WHEN r <= CAST(floor(n * 0.70) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) AS r, count(*) OVER () AS n FROM ({JOINED}) j) a"""
COUNTED = ["card1", "card2", "card3", "card4", "card6", "addr1", "addr2", "P_emaildomain", "R_emaildomain", "ProductCD"]
INPUTS = [
    "TransactionDT",
    "TransactionAmt",
    "TransactionDT_was_missing",
    "TransactionAmt_was_missing",
    "transaction_hour",
    "transaction_day",
    *[f"{c}_missing_flag" for c in ("DeviceInfo", "DeviceType", "R_emaildomain", "P_emaildomain")],
    "identity_missing_count",
    "identity_missing_ratio",
    "high_identity_missing_flag",
    "ProductCD_W_flag",
    *[f"{c}_frequency" for c in COUNTED],
]
PER_SPLIT = "count(*) AS rows, count(*) FILTER (WHERE isFraud = 1) AS positives"


@query(
    "batch_score",
    "SELECT TransactionID, true AS is_probability, true AS flag_follows_threshold FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    """Every row is scored, by id; the flag follows from the score."""
    scored = apply_threshold(_batch_scores(spark, sf_dir), 0.2, "fraud_probability")
    p = F.col("fraud_probability")
    return scored.select(
        "TransactionID",
        F.coalesce(p.between(0, 1), F.lit(False)).alias("is_probability"),
        ((p >= 0.2).cast("int") == F.col("fraud_prediction")).alias("flag_follows_threshold"),
    )


def _batch_scores(spark, sf_dir):
    table, state, inputs = _features(spark, sf_dir)
    trained = training.train_model(table, inputs)
    batch = joined(spark, sf_dir).drop("isFraud", "score")
    return training.batch_score(batch, state, trained)


@query("batch_score_probabilities")
def _(spark, sf_dir):
    return _batch_scores(spark, sf_dir).select("TransactionID", "fraud_probability")


@query(
    "train_gbt",
    f"SELECT split, {PER_SPLIT}, true AS round_has_best_auc, CASE WHEN split = 'train' THEN true END AS better_than_chance "
    "FROM d GROUP BY split",
    ["txn", "ident"],
    {"d": SPLIT},
)
def _(spark, sf_dir):
    """Rows and positives of the scored splits; the kept round has the best validation AUC, recomputed from the scores."""
    table, _, inputs = _features(spark, sf_dir)
    trained = training.train_model(table, inputs, weight=3.0)
    rated = metrics_at_threshold(training.scored_candidate(table, trained, "gbt"), 0.2, ["split"])
    best = F.abs(F.col("roc_auc") - F.lit(max(trained.auc_by_round))) < 1e-9
    return rated.select(
        "split",
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("rows"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        F.when(F.col("split") == "validation", best).otherwise(F.lit(True)).alias("round_has_best_auc"),
        F.when(F.col("split") == "train", F.col("roc_auc") > 0.5).alias("better_than_chance"),
    )


@query("train_gbt_metrics")
def _(spark, sf_dir):
    table, _, inputs = _features(spark, sf_dir)
    trained = training.train_model(table, inputs, weight=3.0)
    return metrics_at_threshold(training.scored_candidate(table, trained, "gbt"), 0.2, ["split"])


@query(
    "weight_search",
    f"""SELECT scale_pos_weight, split, {PER_SPLIT} FROM d, (SELECT DISTINCT unnest([1.0::DOUBLE, 3.0, 5.0, round(sqrt(w), 4), 10.0])
          AS scale_pos_weight FROM (SELECT count(*) FILTER (WHERE isFraud = 0) / count(*) FILTER (WHERE isFraud = 1) AS w
          FROM d WHERE split = 'train') q) c WHERE split <> 'train' GROUP BY scale_pos_weight, split""",
    ["txn", "ident"],
    {"d": SPLIT},
)
def _(spark, sf_dir):
    """Held-out rows and positives that each candidate weight has scored."""
    table, _, inputs = _features(spark, sf_dir)
    scored = training.weight_search(table, inputs).where("p BETWEEN 0 AND 1")
    return scored.groupBy("scale_pos_weight", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("y") == 1).alias("positives")
    )


@query("weight_search_metrics")
def _(spark, sf_dir):
    table, _, inputs = _features(spark, sf_dir)
    return metrics_at_threshold(training.weight_search(table, inputs), 0.2, ["candidate", "split"])


FAMILIES = {
    "gbt_default": ("gbt", {}),
    "forest_default": ("forest", {}),
    "logistic_default": ("logistic", {}),
    "other_library": ("other", {}),
}


def _families(spark, sf_dir):
    table, _, inputs = _features(spark, sf_dir)
    return training.model_family_compare(table, inputs, FAMILIES)


@query(
    "model_family_compare",
    f"""SELECT candidate, model_family, status, split, CASE WHEN status = 'trained' THEN rows END AS rows,
          CASE WHEN status = 'trained' THEN positives END AS positives
        FROM (VALUES ('gbt_default', 'gbt', 'trained'), ('forest_default', 'forest', 'trained'),
          ('logistic_default', 'logistic', 'trained'), ('other_library', 'other', 'skipped')) f(candidate, model_family, status)
        JOIN (SELECT split, {PER_SPLIT} FROM d WHERE split <> 'train' GROUP BY split
          UNION ALL SELECT NULL, NULL, NULL) s ON (status = 'trained') = (split IS NOT NULL)""",
    ["txn", "ident"],
    {"d": SPLIT},
)
def _(spark, sf_dir):
    """Which candidates were trained, and the held-out rows and positives that each has scored."""
    scored, statuses = _families(spark, sf_dir)
    counts = scored.where("p BETWEEN 0 AND 1").groupBy("candidate", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("y") == 1).alias("positives")
    )
    return statuses.drop("reason").join(counts, "candidate", "left")


@query("model_family_policies")
def _(spark, sf_dir):
    scored, statuses = _families(spark, sf_dir)
    rows = policy_rows(scored.where("split = 'validation'"), ["candidate"], status="status")
    return statuses.join(rows, "candidate", "left")


@query(
    "train_pipeline",
    f"""SELECT split, {PER_SPLIT}, CASE WHEN split = 'validation' THEN true END AS recall_met,
          CASE WHEN split = 'validation' THEN true END AS no_better_threshold FROM d WHERE split <> 'train' GROUP BY split""",
    ["txn", "ident"],
    {"d": SPLIT},
)
def _(spark, sf_dir):
    """Rows and positives of the rated splits; the threshold is the most precise one with the recall asked for."""
    result = training.train_pipeline(views.txn(spark, sf_dir), views.ident(spark, sf_dir))
    validation = F.col("split") == "validation"
    curve = pr_curve(result["scored"].where(validation), []).where("recall >= 0.95")
    best = curve.agg(F.max("precision")).first()[0]
    return result["metrics"].select(
        "split",
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("rows"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        F.when(validation, F.col("recall") >= 0.95).alias("recall_met"),
        F.when(validation, F.abs(F.col("precision") - F.lit(best)) < 1e-9).alias("no_better_threshold"),
    )


@query("train_pipeline_metrics")
def _(spark, sf_dir):
    result = training.train_pipeline(views.txn(spark, sf_dir), views.ident(spark, sf_dir))
    return result["metrics"]


def _importance(spark, sf_dir):
    table, _, inputs = _features(spark, sf_dir)
    return training.feature_importance(training.train_model(table, inputs), table)


@query(
    "feature_importance",
    "SELECT feature, true AS is_share, true AS adds_up, true AS ranked FROM (VALUES "
    + ", ".join(f"('{c}')" for c in INPUTS)
    + ") f(feature)",
)
def _(spark, sf_dir):
    """One row per model input: shares that add up to one, ranked without gaps."""
    found = _importance(spark, sf_dir)
    value = F.col("importance")
    whole = found.agg(
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_up"),
        ((F.max("rank") == F.count(F.lit(1))) & (F.count_distinct("rank") == F.max("rank"))).alias("ranked"),
    ).first()
    return found.select(
        "feature", value.between(0, 1).alias("is_share"), F.lit(whole["adds_up"]).alias("adds_up"), F.lit(whole["ranked"]).alias("ranked")
    )


@query("feature_importance_values")
def _(spark, sf_dir):
    return _importance(spark, sf_dir)


@query(
    "pipeline_dry_run",
    f"""SELECT split, count(*) AS rows, min(TransactionDT) AS min_time, max(TransactionDT) AS max_time,
          count(*) FILTER (WHERE isFraud = 1) AS fraud_rows, CAST(44 AS BIGINT) AS feature_count,
          CAST(20 AS BIGINT) AS categorical_feature_count, CAST(0 AS BIGINT) AS contract_violations,
          false AS would_write_artifacts
        FROM (SELECT *, CASE WHEN r <= CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
                WHEN r <= CAST(floor(n * 0.70) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'validation'
                ELSE 'test' END AS split
              FROM (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) AS r, count(*) OVER () AS n
                    FROM ({JOINED}) j) a) b GROUP BY split""",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    return training.pipeline_dry_run(views.txn(spark, sf_dir), views.ident(spark, sf_dir))


