"""Model evaluation and policy selection over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import JOINED, joined, rounded
from ledgerlens.catalog.registry import query
from ledgerlens.operators import curves, missed, policy
from ledgerlens.session import written

G = ["candidate", "split"]


def _grid(values) -> str:
    return ", ".join(f"({v!r}::DOUBLE)" for v in values)


def _table(values, group: str = "candidate, split", source: str = "preds") -> str:
    """Threshold table in SQL, unrounded."""
    return f"""SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
        CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_score,
        (tp + fp) / (tp + fp + fn + tn) AS alert_rate
      FROM (SELECT {group}, threshold, count(*) FILTER (WHERE p >= threshold AND y = 1) AS tp,
              count(*) FILTER (WHERE p >= threshold AND y = 0) AS fp,
              count(*) FILTER (WHERE p < threshold AND y = 1) AS fn,
              count(*) FILTER (WHERE p < threshold AND y = 0) AS tn
            FROM {source} CROSS JOIN (VALUES {_grid(values)}) g(threshold) GROUP BY ALL) c"""


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


COUNTS = "fp AS false_positives, fn AS false_negatives, tp AS true_positives, tn AS true_negatives"
RATES = _r("precision", "recall", "f1_score", "alert_rate")
RANKS = """SELECT candidate, split, (sum(r) FILTER (WHERE y = 1) - np * (np + 1) / 2) / (np * nn) AS roc_auc
    FROM (SELECT *, rank() OVER (PARTITION BY candidate, split ORDER BY p)
             + (count(*) OVER (PARTITION BY candidate, split, p) - 1) / 2 AS r,
             count(*) FILTER (WHERE y = 1) OVER (PARTITION BY candidate, split) AS np,
             count(*) FILTER (WHERE y = 0) OVER (PARTITION BY candidate, split) AS nn FROM preds) x
    GROUP BY candidate, split, np, nn"""
CURVE = """SELECT candidate, split, threshold, tp, fp, pos, tp / (tp + fp) AS precision, tp / np AS recall, np
    FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                 sum(pos) OVER (PARTITION BY candidate, split) AS np
          FROM (SELECT candidate, split, p AS threshold, count(*) FILTER (WHERE y = 1) AS pos,
                       count(*) FILTER (WHERE y = 0) AS neg FROM preds GROUP BY ALL) c
          WINDOW w AS (PARTITION BY candidate, split ORDER BY threshold DESC)) k"""
AVERAGE = "SELECT candidate, split, sum(precision * pos) / max(np) AS pr_auc FROM cu GROUP BY candidate, split"


def _scored(spark, sf_dir):
    return views.preds(spark, sf_dir)


@query(
    "metrics_at_threshold",
    f"""SELECT candidate, split, tn, fp, fn, tp, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, {RATES},
               threshold, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
        FROM tt JOIN ra USING (candidate, split) JOIN pa USING (candidate, split)""",
    ["preds"],
    {"tt": _table([0.2]), "ra": RANKS, "cu": CURVE, "pa": AVERAGE},
)
def _(spark, sf_dir):
    return rounded(policy.metrics_at_threshold(_scored(spark, sf_dir), 0.2, G))


@query("roc_auc", "SELECT candidate, split, round(roc_auc, 6) AS roc_auc FROM ra", ["preds"], {"ra": RANKS})
def _(spark, sf_dir):
    return rounded(curves.roc_auc(_scored(spark, sf_dir), G))


@query(
    "pr_auc", "SELECT candidate, split, round(pr_auc, 6) AS pr_auc FROM pa", ["preds"], {"cu": CURVE, "pa": AVERAGE}
)
def _(spark, sf_dir):
    return rounded(curves.pr_auc(_scored(spark, sf_dir), G))


@query(
    "pr_curve",
    f"SELECT candidate, split, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, {_r('precision', 'recall')} FROM cu",
    ["preds"],
    {"cu": CURVE},
)
def _(spark, sf_dir):
    curve = curves.pr_curve(_scored(spark, sf_dir), G)
    return rounded(curve.select(*G, "threshold", "tp", "fp", "precision", "recall"))


@query(
    "threshold_for_recall",
    f"""SELECT candidate, split, threshold, {_r('precision', 'recall')} FROM (
          SELECT *, row_number() OVER (PARTITION BY candidate, split ORDER BY precision DESC, threshold) AS r
          FROM cu WHERE recall >= 0.95) q WHERE r = 1""",
    ["preds"],
    {"cu": CURVE},
)
def _(spark, sf_dir):
    return rounded(curves.threshold_for_recall(_scored(spark, sf_dir), G))


@query(
    "threshold_table",
    f"SELECT candidate, split, threshold, {RATES}, {COUNTS}, round(recall, 6) AS fraud_capture_rate FROM tt",
    ["preds"],
    {"tt": _table(policy.DEFAULT_GRID)},
)
def _(spark, sf_dir):
    return rounded(policy.threshold_table(_scored(spark, sf_dir), G))


STAGE = "CASE WHEN recall >= 0.8 AND alert_rate <= 0.2 THEN 1 WHEN recall >= 0.8 THEN 2 ELSE 3 END"


@query(
    "select_operating_threshold",
    f"""SELECT candidate, split, threshold, {RATES}, {COUNTS}, round(recall, 6) AS fraud_capture_rate,
          CASE stage WHEN 1 THEN 'max_f1_with_min_recall_and_max_alert_rate'
            WHEN 2 THEN 'max_f1_with_min_recall_alert_rate_relaxed' ELSE 'max_f1_recall_requirement_not_met' END
            AS selection_rule
        FROM (SELECT *, row_number() OVER (PARTITION BY candidate, split ORDER BY stage,
                CASE stage WHEN 2 THEN alert_rate ELSE -f1_score END, precision DESC,
                CASE stage WHEN 2 THEN -f1_score ELSE -recall END,
                CASE stage WHEN 2 THEN -recall ELSE -threshold END, threshold DESC) AS r
              FROM (SELECT *, {STAGE} AS stage FROM tt) s) q WHERE r = 1""",
    ["preds"],
    {"tt": _table(policy.DEFAULT_GRID)},
)
def _(spark, sf_dir):
    table = policy.threshold_table(_scored(spark, sf_dir), G)
    return rounded(policy.select_operating_threshold(table, G))


FINE = {"tt": _table(policy.FINE_GRID)}


@query(
    "max_recall_under_alert",
    f"""SELECT candidate, split, round(threshold, 6) AS threshold, {_r('alert_rate', 'recall', 'precision')} FROM (
          SELECT *, row_number() OVER (PARTITION BY candidate, split ORDER BY recall DESC, threshold) AS r
          FROM tt WHERE alert_rate <= 0.08) q WHERE r = 1""",
    ["preds"],
    FINE,
)
def _(spark, sf_dir):
    return rounded(policy.max_recall_under_alert(_scored(spark, sf_dir), G))


@query(
    "cost_curve",
    f"""SELECT candidate, split, round(threshold, 6) AS threshold, {_r('recall', 'precision')}, fp AS false_positives,
          fn AS false_negatives, fn * 500 + fp * 10 AS total_cost,
          row_number() OVER (PARTITION BY candidate, split ORDER BY fn * 500 + fp * 10, threshold) = 1 AS is_minimum
        FROM tt""",
    ["preds"],
    FINE,
)
def _(spark, sf_dir):
    return rounded(policy.cost_curve(_scored(spark, sf_dir), G))


def _class(name: str, hit: str, false_hit: str, miss: str) -> str:
    return f"""SELECT candidate, split, '{name}' AS label,
        CASE WHEN {hit} + {false_hit} = 0 THEN 0 ELSE {hit} / ({hit} + {false_hit}) END AS precision,
        CASE WHEN {hit} + {miss} = 0 THEN 0 ELSE {hit} / ({hit} + {miss}) END AS recall,
        CASE WHEN 2 * {hit} + {false_hit} + {miss} = 0 THEN 0
             ELSE 2 * {hit} / (2 * {hit} + {false_hit} + {miss}) END AS f1_score, {hit} + {miss} AS support FROM tt"""


@query(
    "classification_report",
    f"""SELECT candidate, split, label, {_r('precision', 'recall', 'f1_score')}, support FROM (
          SELECT * FROM cl
          UNION ALL SELECT candidate, split, 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn),
            (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM tt
          UNION ALL SELECT candidate, split, 'macro avg', avg(precision), avg(recall), avg(f1_score),
            CAST(sum(support) AS BIGINT) FROM cl GROUP BY 1, 2
          UNION ALL SELECT candidate, split, 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT)
            FROM cl GROUP BY 1, 2) q""",
    ["preds"],
    {
        "tt": _table([0.3]),
        "cl": _class("0", "tn", "fn", "fp") + " UNION ALL " + _class("1", "tp", "fp", "fn"),
    },
)
def _(spark, sf_dir):
    return rounded(policy.classification_report(_scored(spark, sf_dir), 0.3, G))


@query(
    "operational_rates",
    """SELECT candidate, split, round(tn / (tn + fp), 6) AS specificity, round(fp / (tn + fp), 6) AS false_positive_rate,
          round(fn / (tp + fn), 6) AS false_negative_rate, round((tp + fn) / (tp + fp + fn + tn), 6) AS fraud_prevalence,
          round((tp + fp) / (tp + fp + fn + tn) * 1000, 6) AS alerts_per_1000,
          round(fn / (tp + fp + fn + tn) * 1000, 6) AS missed_frauds_per_1000,
          round(fp / (tp + fp + fn + tn) * 1000, 6) AS false_alerts_per_1000 FROM tt""",
    ["preds"],
    {"tt": _table([0.2])},
)
def _(spark, sf_dir):
    metrics = policy.metrics_at_threshold(_scored(spark, sf_dir), 0.2, G, ranking=False)
    names = [
        "specificity",
        "false_positive_rate",
        "false_negative_rate",
        "fraud_prevalence",
        "alerts_per_1000",
        "missed_frauds_per_1000",
        "false_alerts_per_1000",
    ]
    return rounded(policy.operational_rates(metrics).select(*G, *names))


@query(
    "false_negative_counts",
    """SELECT candidate, split, threshold, tp + fp + fn + tn AS row_count, tp + fn AS fraud_count,
          fn AS false_negative_count, tp AS true_positive_count, round(fn / (tp + fn), 6) AS missed_fraud_rate FROM tt""",
    ["preds"],
    {"tt": _table([0.1, 0.2])},
)
def _(spark, sf_dir):
    return rounded(policy.false_negative_counts(_scored(spark, sf_dir), G))


BANDED = f"""SELECT *, CASE WHEN TransactionAmt <= 25 THEN '<=25' WHEN TransactionAmt <= 50 THEN '25-50'
      WHEN TransactionAmt <= 100 THEN '50-100' WHEN TransactionAmt <= 250 THEN '100-250'
      WHEN TransactionAmt <= 500 THEN '250-500' WHEN TransactionAmt > 500 THEN '>500' END AS TransactionAmt_band,
    CASE WHEN h <= 5 THEN 'overnight' WHEN h <= 11 THEN 'morning' WHEN h <= 17 THEN 'afternoon' ELSE 'evening' END
      AS transaction_hour_band,
    CASE WHEN n <= 0 THEN '0' WHEN n <= 5 THEN '1-5' WHEN n <= 20 THEN '6-20' ELSE '21+' END
      AS identity_missing_count_band
  FROM (SELECT *, CAST(floor(TransactionDT / 3600) AS BIGINT) % 24 AS h, CAST(id_01 IS NULL AS INT)
          + CAST(id_02 IS NULL AS INT) + CAST(id_12 IS NULL AS INT) AS n FROM ({JOINED}) j) c"""


@query(
    "false_negative_rows",
    """SELECT TransactionID, TransactionAmt_band, transaction_hour_band, identity_missing_count_band,
          CASE WHEN score < 0.4 THEN 'false_negative' ELSE 'true_positive' END AS outcome FROM b WHERE isFraud = 1""",
    ["txn", "ident"],
    {"b": BANDED},
)
def _(spark, sf_dir):
    bands = ["TransactionAmt_band", "transaction_hour_band", "identity_missing_count_band"]
    return missed.false_negative_rows(joined(spark, sf_dir), 0.4).select("TransactionID", *bands, "outcome")


PRESENT = [c for c in missed.GROUP_COLUMNS if c != "card5"]


@query(
    "top_fn_groups",
    """SELECT group_column, group_value, fn AS false_negatives, tp AS true_positives, fraud AS fraud_count,
          non_fraud AS non_fraud_count, total AS total_count, round(fn / fraud, 6) AS missed_fraud_rate,
          round(fn / (SELECT count(*) FROM b WHERE isFraud = 1 AND score < 0.4), 6) AS false_negative_share,
          round(fraud / total, 6) AS fraud_rate
       FROM (SELECT group_column, coalesce(v, '__MISSING__') AS group_value,
               count(*) FILTER (WHERE isFraud = 1 AND score < 0.4) AS fn,
               count(*) FILTER (WHERE isFraud = 1 AND score >= 0.4) AS tp, count(*) FILTER (WHERE isFraud = 1) AS fraud,
               count(*) FILTER (WHERE isFraud = 0) AS non_fraud, count(*) AS total FROM st GROUP BY 1, 2) g
       WHERE fn > 0 ORDER BY fn DESC, fn / fraud DESC, group_column, group_value LIMIT 10""",
    ["txn", "ident"],
    {
        "b": BANDED,
        "st": " UNION ALL ".join(
            f"SELECT '{c}' AS group_column, CAST({c} AS VARCHAR) AS v, isFraud, score FROM b" for c in PRESENT
        ),
    },
)
def _(spark, sf_dir):
    flagged = missed.add_bands(missed.outcome_flags(joined(spark, sf_dir), 0.4))
    return rounded(missed.top_fn_groups(flagged))


POLICY = {"vp": "SELECT * FROM preds WHERE split = 'validation'", "tt": _table(policy.DEFAULT_GRID, "candidate, scale_pos_weight", "vp")}


def _validation(spark, sf_dir):
    return _scored(spark, sf_dir).where("split = 'validation'")


@query(
    "policy_rows", f"SELECT candidate, scale_pos_weight, threshold, {RATES}, {COUNTS} FROM tt", ["preds"], POLICY
)
def _(spark, sf_dir):
    return rounded(policy.policy_rows(_validation(spark, sf_dir), ["candidate", "scale_pos_weight"]))


@query(
    "best_policy",
    f"""SELECT max_alert_rate, candidate, scale_pos_weight, threshold, {RATES}, {COUNTS}, candidate IS NOT NULL AS policy_found
        FROM (VALUES (0.01::DOUBLE), (0.05::DOUBLE), (0.07::DOUBLE), (0.1::DOUBLE)) l(max_alert_rate) LEFT JOIN (
          SELECT l2.m, tt.*, row_number() OVER (PARTITION BY l2.m ORDER BY recall DESC, precision DESC, f1_score DESC,
                   candidate, threshold) AS r
          FROM tt JOIN (VALUES (0.01::DOUBLE), (0.05::DOUBLE), (0.07::DOUBLE), (0.1::DOUBLE)) l2(m) ON alert_rate <= l2.m) q
        ON q.m = max_alert_rate AND r = 1""",
    ["preds"],
    POLICY,
)
def _(spark, sf_dir):
    rows = policy.policy_rows(_validation(spark, sf_dir), ["candidate", "scale_pos_weight"])
    return rounded(policy.best_policy(rows, [0.01, *policy.POLICY_ALERT_LIMITS]))


RANKED = {"tt": _table([0.2]), "ra": RANKS, "cu": CURVE, "pa": AVERAGE,
          "ms": "SELECT * FROM tt JOIN ra USING (candidate, split) JOIN pa USING (candidate, split)",
          "mv": "SELECT * FROM ms WHERE split = 'validation'", "mt": "SELECT * FROM ms WHERE split = 'test'"}
SUMMARY = ["roc_auc", "pr_auc", "precision", "recall", "f1_score", "alert_rate"]


def _halves(spark, sf_dir, threshold, ranking=True):
    metrics = written(policy.metrics_at_threshold(_scored(spark, sf_dir), threshold, G, ranking=ranking), "metrics")
    return [metrics.where(F.col("split") == s).drop("split") for s in ("validation", "test")]


@query(
    "candidate_summary",
    "SELECT v.candidate, v.fn AS validation_false_negatives, "
    + ", ".join(f"round(v.{n}, 6) AS validation_{n}, round(t.{n}, 6) AS test_{n}" for n in SUMMARY)
    + ", "
    + ", ".join(
        f"round(v.{n} - (SELECT {n} FROM mv WHERE candidate = 'base'), 6) AS validation_{n}_delta"
        for n in ("recall", "pr_auc", "precision", "alert_rate")
    )
    + " FROM mv v JOIN mt t USING (candidate)",
    ["preds"],
    RANKED,
)
def _(spark, sf_dir):
    validation, test = _halves(spark, sf_dir, 0.2)
    return rounded(policy.candidate_summary(validation, test, "base"))


def _decision_sql(limit: float) -> str:
    return f"""SELECT max(candidate) AS recommended_candidate,
          CASE WHEN count(*) > 0 THEN 'promote_candidate' ELSE 'do_not_promote' END AS promotion_recommendation,
          max(threshold) AS threshold, round(max(va), 6) AS validation_alert_rate, round(max(alert_rate), 6) AS test_alert_rate,
          round(max(recall), 6) AS test_recall, round(max(precision), 6) AS test_precision,
          round(max(f1_score), 6) AS test_f1_score
        FROM (SELECT t.*, v.alert_rate AS va, row_number() OVER (ORDER BY t.recall DESC, t.precision DESC, t.f1_score DESC,
                t.candidate) AS r FROM tt t JOIN tt v USING (candidate)
              WHERE t.split = 'test' AND v.split = 'validation' AND t.alert_rate <= {limit} AND v.alert_rate <= {limit}) q
        WHERE r = 1"""


@query("final_policy_decision", _decision_sql(0.05), ["preds"], {"tt": _table([0.6])})
def _(spark, sf_dir):
    validation, test = _halves(spark, sf_dir, 0.6, ranking=False)
    return rounded(policy.final_policy_decision(validation, test))


@query("final_policy_decision_none", _decision_sql(0.05), ["preds"], {"tt": _table([0.1])})
def _(spark, sf_dir):
    validation, test = _halves(spark, sf_dir, 0.1, ranking=False)
    return rounded(policy.final_policy_decision(validation, test))


@query(
    "alert_limited_threshold",
    f"""SELECT candidate, split, threshold, {RATES}, {COUNTS}, round(recall, 6) AS fraud_capture_rate,
          CASE WHEN alert_rate <= lim THEN 'max_alert_rate_then_recall_precision_f1'
               ELSE 'best_overall_no_alert_rate_candidate' END AS selection_rule
        FROM (SELECT *, row_number() OVER (PARTITION BY candidate, split ORDER BY alert_rate <= lim DESC,
                CASE WHEN alert_rate <= lim THEN -recall ELSE -f1_score END, precision DESC,
                CASE WHEN alert_rate <= lim THEN -f1_score ELSE -recall END, threshold DESC) AS r
              FROM (SELECT *, 0.05 AS lim FROM tt) x) q WHERE r = 1""",
    ["preds"],
    {"tt": _table(policy.DEFAULT_GRID)},
)
def _(spark, sf_dir):
    table = policy.threshold_table(_scored(spark, sf_dir), G)
    return rounded(policy.alert_limited_threshold(table, G))


@query(
    "compare_to_benchmark",
    """SELECT candidate, threshold AS selected_threshold, beats AS beats_benchmark,
          CASE WHEN beats THEN 'neural_baseline_beats_catboost' WHEN NOT ok THEN 'do_not_promote'
               ELSE 'catboost_remains_benchmark' END AS recommendation,
          CASE WHEN beats THEN candidate ELSE 'catboost_default' END AS recommended_candidate
       FROM (SELECT t.candidate, t.threshold, t.alert_rate <= 0.05 AND v.alert_rate <= 0.05 AS ok,
               t.alert_rate <= 0.05 AND v.alert_rate <= 0.05 AND t.recall > 0.5806 AND t.precision >= 0.4103
                 AND t.f1_score >= 0.4808 AS beats
             FROM tt t JOIN tt v USING (candidate) WHERE t.split = 'test' AND v.split = 'validation') q""",
    ["preds"],
    {"tt": _table([0.6])},
)
def _(spark, sf_dir):
    validation, test = _halves(spark, sf_dir, 0.6, ranking=False)
    return policy.compare_to_benchmark(validation, test)
