"""Aggregations and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import JOINED, UID, joined, later_rows, off_ties, rounded, train_rows
from ledgerlens.catalog.registry import query
from ledgerlens.operators import drift, encoding, profile
from ledgerlens.operators.splits import split_by_last_days, split_by_time_ratio, split_summary
from ledgerlens.session import written

CARDS = ["card1", "card2", "card3", "card4"]
TRAIN = "TransactionDT < 1728000"


def _stack(columns: list[str], source: str, value: str = "CAST({c} AS VARCHAR)") -> str:
    """UNION ALL of (column, value) selects."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {value.format(c=c)} AS value FROM {source}" for c in columns
    )


@query(
    "frequency_fit",
    'SELECT "column", value, count(*) AS freq FROM st GROUP BY ALL',
    ["txn"],
    {"st": _stack([*CARDS, "P_emaildomain"], "txn")},
)
def _(spark, sf_dir):
    return encoding.frequency_fit(views.txn(spark, sf_dir), [*CARDS, "P_emaildomain"])


def _freq_join(c: str) -> str:
    return (
        f"LEFT JOIN (SELECT {c} AS v, count(*) AS n FROM txn WHERE {TRAIN} GROUP BY 1) f_{c} "
        f"ON t.{c} IS NOT DISTINCT FROM f_{c}.v"
    )


@query(
    "frequency_encode",
    "SELECT t.TransactionID, "
    + ", ".join(f"coalesce(f_{c}.n, 0) AS {c}_freq" for c in CARDS)
    + " FROM txn t "
    + " ".join(_freq_join(c) for c in CARDS)
    + f" WHERE NOT (t.{TRAIN})",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    state = written(encoding.frequency_fit(train_rows(rows), CARDS), "frequencies", ["column"])
    encoded = encoding.frequency_encode(later_rows(rows), state, CARDS)
    return encoded.select("TransactionID", *[f"{c}_freq" for c in CARDS])


@query(
    "frequency_encode_self",
    "SELECT TransactionID, count(*) OVER (PARTITION BY card2) AS card2_freq, "
    "count(*) OVER (PARTITION BY card4) AS card4_freq FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    state = written(encoding.frequency_fit(rows, ["card2", "card4"]), "frequencies", ["column"])
    return encoding.frequency_encode(rows, state, ["card2", "card4"]).select("TransactionID", "card2_freq", "card4_freq")


@query(
    "uid_stats_fit",
    f"""SELECT {UID} AS uid, count(*) AS uid_txn_count, round(avg(TransactionAmt), 6) AS uid_amt_mean,
               round(coalesce(stddev_samp(TransactionAmt), 0), 6) AS uid_amt_std,
               round(median(TransactionAmt), 6) AS uid_amt_median FROM txn GROUP BY 1""",
    ["txn"],
)
def _(spark, sf_dir):
    return rounded(encoding.uid_stats_fit(views.txn(spark, sf_dir)))


@query(
    "uid_stats_apply",
    f"""SELECT TransactionID, coalesce(n, 1) AS uid_txn_count, round(coalesce(m, gm), 6) AS uid_amt_mean,
               round(coalesce(s, gs), 6) AS uid_amt_std, round(coalesce(d, gm), 6) AS uid_amt_median,
               round((TransactionAmt - coalesce(m, gm)) / (coalesce(s, gs) + 1e-6), 2) AS uid_amt_deviation
        FROM (SELECT *, {UID} AS uid FROM txn) t LEFT JOIN st USING (uid) CROSS JOIN g WHERE NOT ({TRAIN})""",
    ["txn"],
    {
        "st": f"SELECT {UID} AS uid, count(*) AS n, avg(TransactionAmt) AS m, "
        f"coalesce(stddev_samp(TransactionAmt), 0) AS s, median(TransactionAmt) AS d FROM txn WHERE {TRAIN} GROUP BY 1",
        "g": f"SELECT avg(TransactionAmt) AS gm, stddev_samp(TransactionAmt) AS gs FROM txn WHERE {TRAIN}",
    },
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    train = train_rows(rows)
    mean, std = encoding.amount_totals(train)
    applied = encoding.uid_stats_apply(later_rows(rows), encoding.uid_stats_fit(train), mean, std)
    # An entity with one training row has no spread: its deviations are millions, so 2 places.
    return rounded(applied.select("TransactionID", *encoding.UID_STATS, "uid_amt_deviation"), uid_amt_deviation=2)


@query(
    "numeric_median_fit",
    'SELECT \'TransactionAmt\' AS "column", round(median(TransactionAmt), 6) AS median FROM txn '
    "UNION ALL SELECT 'card2', median(card2) FROM txn UNION ALL SELECT 'addr1', median(addr1) FROM txn "
    "UNION ALL SELECT 'score', round(median(score), 6) FROM txn UNION ALL SELECT 'empty', 0.0",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir).withColumn("empty", F.lit(None).cast("double"))
    return rounded(encoding.numeric_median_fit(rows, ["TransactionAmt", "card2", "addr1", "score", "empty"]))


@query(
    "category_vocab_fit",
    """SELECT DISTINCT "column", coalesce(value, '__MISSING__') AS value FROM st
       UNION SELECT c, v FROM (VALUES ('card4'), ('card2'), ('ProductCD')) a(c), (VALUES ('__MISSING__'), ('__UNKNOWN__')) b(v)""",
    ["txn"],
    {"st": _stack(["card4", "card2", "ProductCD"], "txn")},
)
def _(spark, sf_dir):
    return encoding.category_vocab_fit(views.txn(spark, sf_dir), ["card4", "card2", "ProductCD"])


@query(
    "class_balance",
    """SELECT isFraud, count(*) AS rows, round(count(*) / (SELECT count(*) FROM txn), 6) AS share,
              round((SELECT count(*) FILTER (WHERE isFraud = 0) / count(*) FILTER (WHERE isFraud = 1) FROM txn), 6)
                AS imbalance_ratio FROM txn GROUP BY isFraud""",
    ["txn"],
)
def _(spark, sf_dir):
    return rounded(profile.class_balance(views.txn(spark, sf_dir)))


MERGED = [
    "TransactionID",
    "TransactionDT",
    "TransactionAmt",
    "ProductCD",
    "card1",
    "card2",
    "card3",
    "card4",
    "card6",
    "addr1",
    "addr2",
    "P_emaildomain",
    "R_emaildomain",
    "isFraud",
    "score",
    "DeviceType",
    "DeviceInfo",
    "id_01",
    "id_02",
    "id_12",
]


@query(
    "missing_summary",
    'SELECT "column", count(*) FILTER (WHERE value IS NULL) AS missing_count, '
    "round(count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*), 6) AS missing_percent FROM st GROUP BY 1",
    ["txn", "ident"],
    {"j": JOINED, "st": _stack(MERGED, "j")},
)
def _(spark, sf_dir):
    return profile.missing_summary(joined(spark, sf_dir), digits=6).drop("dtype")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(
    "missing_summary_orders",
    'SELECT "column", count(*) FILTER (WHERE value IS NULL) AS missing_count, '
    "round(count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*), 6) AS missing_percent FROM st GROUP BY 1",
    None,
    {"st": _stack(ORDER_COLUMNS, "orders")},
)
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDER_COLUMNS)
    return profile.missing_summary(orders, digits=6).drop("dtype")


SIGNAL = [c for c in MERGED if c != "isFraud"]


@query(
    "missing_signal_strength",
    'SELECT "column", round(abs(a - b), 6) AS fraud_rate_difference FROM ('
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(isFraud) FILTER (WHERE {c} IS NULL) AS a, "
        f"avg(isFraud) FILTER (WHERE {c} IS NOT NULL) AS b, "
        f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS m FROM j"
        for c in SIGNAL
    )
    + ") q WHERE m > 30 AND a IS NOT NULL AND b IS NOT NULL",
    ["txn", "ident"],
    {"j": JOINED},
)
def _(spark, sf_dir):
    return rounded(profile.missing_signal_strength(joined(spark, sf_dir), min_missing_percent=30.0))


AUDITED = ["TransactionAmt", "card2", "addr2", "R_emaildomain", "id_01", "score", "isFraud"]
AUDIT_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
          round((count(*) - count({c})) / count(*), 6) AS missing_rate,
          count({c}) - count(x_{c}) AS coercion_failure_count,
          round(CASE WHEN count({c}) = 0 THEN 0 ELSE (count({c}) - count(x_{c})) / count({c}) END, 6)
            AS coercion_failure_rate,
          round(min(x_{c}), 6) AS "min", round(max(x_{c}), 6) AS "max", round(avg(x_{c}) + 1e-9, 6) AS mean,
          round(quantile_cont(x_{c}, 0.5), 6) AS median,
          count(*) FILTER (WHERE x_{c} < 0) AS negative_count, round(quantile_cont(x_{c}, 0.01), 6) AS q01,
          round(quantile_cont(x_{c}, 0.99), 6) AS q99,
          (SELECT count(*) FROM n, (SELECT quantile_cont(x_{c}, 0.25) AS a, quantile_cont(x_{c}, 0.75) AS b FROM n) q
           WHERE x_{c} < a - 3 * (b - a) OR x_{c} > b + 3 * (b - a)) AS iqr_outlier_count,
          count(DISTINCT {c}) AS unique_count,
          round((SELECT max(k) FROM (SELECT count(*) AS k FROM n WHERE {c} IS NOT NULL GROUP BY {c}) g) / count({c}), 6)
            AS top_value_rate,
          count(DISTINCT {c}) <= 1 AS constant,
          (SELECT max(k) FROM (SELECT count(*) AS k FROM n WHERE {c} IS NOT NULL GROUP BY {c}) g) / count({c}) >= 0.99
            AS near_constant FROM n"""
    for c in AUDITED
)
AUDIT_VIEWS = {
    "j": JOINED,
    "n": "SELECT *, " + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS x_{c}" for c in AUDITED) + " FROM j",
}


@query("numeric_audit", AUDIT_SQL, ["txn", "ident"], AUDIT_VIEWS)
def _(spark, sf_dir):
    return rounded(off_ties(profile.numeric_audit(joined(spark, sf_dir), AUDITED).drop("dtype"), "mean"))


@query(
    "audit_views",
    """SELECT 'negative' AS view, "column" FROM a WHERE negative_count > 0
       UNION ALL SELECT 'constant', "column" FROM a WHERE constant OR near_constant
       UNION ALL SELECT 'high_missing', "column" FROM a WHERE missing_rate >= 0.5""",
    ["txn", "ident"],
    {**AUDIT_VIEWS, "a": AUDIT_SQL},
)
def _(spark, sf_dir):
    return profile.audit_views(profile.numeric_audit(joined(spark, sf_dir), AUDITED))


CATEGORIES = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "DeviceInfo", "mixed", "many"]
KIND = r"""CASE WHEN regexp_matches(value, '^[+-]?\d+$') THEN 'int'
  WHEN regexp_matches(value, '^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$') THEN 'float'
  WHEN lower(value) IN ('true', 'false') THEN 'bool' ELSE 'str' END"""


@query(
    "categorical_audit",
    f"""SELECT "column", count(value) AS unique_count, coalesce(sum(n) FILTER (WHERE value IS NULL), 0)::BIGINT
          AS missing_count, round(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) / sum(n), 6) AS missing_rate,
          coalesce(string_agg(value || '=' || CAST(n AS VARCHAR), '|' ORDER BY r) FILTER (WHERE r <= 5 AND value IS NOT NULL), '')
            AS top_values,
          count(value) > greatest(100, 0.05 * sum(n)) AS high_cardinality,
          count(DISTINCT {KIND}) FILTER (WHERE value IS NOT NULL) > 1 AS mixed_kinds
        FROM (SELECT *, row_number() OVER (PARTITION BY "column", value IS NULL ORDER BY n DESC, value) AS r FROM c) q
        GROUP BY 1""",
    ["txn", "ident"],
    {
        "j": "SELECT *, CASE WHEN TransactionID % 3 = 0 THEN CAST(card2 AS VARCHAR) ELSE card4 END AS mixed, "
        f"'u' || CAST(TransactionID AS VARCHAR) AS many FROM ({JOINED}) jj",
        "st": _stack(CATEGORIES, "j"),
        "c": 'SELECT "column", value, count(*) AS n FROM st GROUP BY ALL',
    },
)
def _(spark, sf_dir):
    mixed = F.when(F.col("TransactionID") % 3 == 0, F.col("card2").cast("string")).otherwise(F.col("card4"))
    many = F.concat(F.lit("u"), F.col("TransactionID").cast("string"))
    rows = joined(spark, sf_dir).withColumns({"mixed": mixed, "many": many})
    return rounded(profile.categorical_audit(rows, CATEGORIES))


ID_LIKE = ["TransactionID", "card1", "card2", "card3", "card4", "card6", "addr1", "addr2", "id_01", "id_02", "id_12"]


@query(
    "id_like_audit",
    """SELECT "column", count(DISTINCT value) AS unique_count, round(count(DISTINCT value) / count(*), 6) AS unique_rate,
              count(*) - count(value) AS missing_count, round((count(*) - count(value)) / count(*), 6) AS missing_rate,
              count(DISTINCT value) = count(*) AS behaves_like_unique_id,
              CASE WHEN "column" = 'TransactionID' THEN 'ignored'
                   WHEN starts_with("column", 'id_') THEN CASE WHEN count(DISTINCT value) < 1000 THEN 'categorical'
                                                               ELSE 'monitored' END
                   ELSE 'categorical' END AS recommended_treatment
       FROM st GROUP BY 1""",
    ["txn", "ident"],
    {"j": JOINED, "st": _stack(ID_LIKE, "j")},
)
def _(spark, sf_dir):
    return rounded(profile.id_like_audit(joined(spark, sf_dir)))


@query(
    "label_rate_by_period",
    """SELECT CAST(floor(TransactionDT / 86400) AS BIGINT) AS period, 'day' AS unit, count(*) AS rows,
              round(avg(isFraud), 6) AS label_rate FROM txn GROUP BY 1
       UNION ALL SELECT CAST(floor(TransactionDT / 3600) AS BIGINT) % 24, 'hour', count(*), round(avg(isFraud), 6)
       FROM txn GROUP BY 1""",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    parts = [
        profile.label_rate_by_period(rows, unit).select(
            F.col(unit).alias("period"), F.lit(unit).alias("unit"), "rows", "label_rate"
        )
        for unit in ("day", "hour")
    ]
    return rounded(parts[0].unionByName(parts[1]))


@query(
    "describe_period",
    """SELECT 'label_rate' AS "column", count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
              round(min(x), 6) AS "min", round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
              round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS "max" FROM d
       UNION ALL
       SELECT 'day', count(day), round(avg(day), 6), round(stddev_samp(day), 6), min(day), quantile_cont(day, 0.25),
              quantile_cont(day, 0.5), quantile_cont(day, 0.75), max(day) FROM t""",
    ["txn"],
    {
        "t": "SELECT CAST(floor(TransactionDT / 86400) AS DOUBLE) AS day, isFraud FROM txn",
        "d": "SELECT day, avg(isFraud) AS x FROM t GROUP BY day",
    },
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    rates = profile.label_rate_by_period(rows, "day")
    days = rows.select(F.floor(F.col("TransactionDT") / 86400).alias("day"))
    return rounded(profile.describe(rates, "label_rate").unionByName(profile.describe(days, "day")))


@query(
    "mean_shift",
    f"""SELECT 'split' AS view, split AS "group", round(avg(dev), 6) AS feature_mean FROM t GROUP BY split
        UNION ALL SELECT 'class', CAST(isFraud AS VARCHAR), round(avg(dev), 6) FROM t GROUP BY isFraud""",
    ["txn"],
    {
        "s": f"SELECT {UID} AS uid, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS s FROM txn GROUP BY 1",
        "t": f"""SELECT (TransactionAmt - m) / (s + 1e-6) AS dev, isFraud,
                   CASE WHEN floor(TransactionDT / 86400) <= (SELECT max(floor(TransactionDT / 86400)) - 10 FROM txn)
                        THEN 'train' ELSE 'validation' END AS split
                 FROM (SELECT *, {UID} AS uid FROM txn) x LEFT JOIN s USING (uid)""",
    },
)
def _(spark, sf_dir):
    rows = split_by_last_days(encoding.uid_window_stats(views.txn(spark, sf_dir)), 10)
    return rounded(profile.mean_shift(rows, "uid_amt_deviation"))


CORRELATED = ["TransactionID", "TransactionDT", "TransactionAmt", "card1", "card2", "card3", "addr1", "isFraud", "score"]


@query(
    "label_correlation_topk",
    'SELECT "column", round(r, 6) AS correlation FROM ('
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", corr({c}, isFraud) AS r FROM txn" for c in CORRELATED)
    + ') q WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY r DESC, "column" LIMIT 10',
    ["txn"],
)
def _(spark, sf_dir):
    return rounded(profile.label_correlation_topk(views.txn(spark, sf_dir).drop("addr2")))


@query(
    "split_summary",
    """SELECT split, count(*) AS rows, min(TransactionDT) AS min_time, max(TransactionDT) AS max_time,
              count(*) FILTER (WHERE isFraud = 1) AS fraud_rows, CAST(15 AS BIGINT) AS columns
       FROM (SELECT *, CASE WHEN r <= CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
                            WHEN r <= CAST(floor(n * 0.70) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'validation'
                            ELSE 'test' END AS split
             FROM (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) AS r, count(*) OVER () AS n FROM txn) a) b
       GROUP BY split""",
    ["txn"],
)
def _(spark, sf_dir):
    return split_summary(split_by_time_ratio(views.txn(spark, sf_dir)))


@query(
    "risk_tier_counts",
    """SELECT CASE WHEN s >= 0.8 THEN 'high_risk' WHEN s >= 0.5 THEN 'medium_risk' ELSE 'low_risk' END AS tier,
              count(*) AS rows, (SELECT count(*) FROM txn) AS total_predictions
       FROM (SELECT score * 1.3 AS s FROM txn) t GROUP BY 1""",
    ["txn"],
)
def _(spark, sf_dir):
    return drift.risk_tier_counts(views.txn(spark, sf_dir).withColumn("score", F.col("score") * 1.3))


def _psi_sql(c: str, early: str, late: str, bins: int = 10) -> str:
    """PSI as SQL: interpolated edges, bin by counting edges, last bin closed."""
    points = ", ".join(str(i / bins) for i in range(bins + 1))
    inside = "list_count(list_filter(e, lambda z: z <= x))"
    binned = (
        f"SELECT CASE WHEN x BETWEEN e[1] AND e[{bins + 1}] THEN least({inside} - 1, {bins - 1}) ELSE -1 END AS b "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS x FROM txn WHERE {{w}} AND {c} IS NOT NULL) v "
        f"CROSS JOIN (SELECT quantile_cont(CAST({c} AS DOUBLE), [{points}]) AS e FROM txn WHERE {early}) q"
    )
    share = (
        "SELECT b, count(*) / (SELECT count(*) FROM txn WHERE {w} AND " + c + " IS NOT NULL) AS f FROM ({q}) z GROUP BY b"
    )
    expected = share.format(w=early, q=binned.format(w=early))
    actual = share.format(w=late, q=binned.format(w=late))
    return (
        f"SELECT '{c}' AS \"column\", sum((coalesce(a.f, 0) - coalesce(x.f, 0)) * "
        f"ln((coalesce(a.f, 0) + 1e-6) / (coalesce(x.f, 0) + 1e-6))) AS psi "
        f"FROM ({expected}) x FULL JOIN ({actual}) a ON x.b = a.b WHERE coalesce(x.b, a.b) >= 0"
    )


EARLY, LATE = "TransactionDT < 1728000", "TransactionDT >= 1728000"
DRIFTED = ["TransactionAmt", "score", "card1", "card2", "TransactionDT"]


@query("psi", f'SELECT "column", round(psi, 6) AS psi FROM ({_psi_sql("TransactionAmt", EARLY, LATE)}) p', ["txn"])
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    return rounded(drift.psi(rows.where(EARLY), rows.where(LATE), "TransactionAmt"))


@query(
    "drift_report",
    "SELECT \"column\", round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'warning' "
    "ELSE 'drift_detected' END AS status FROM (" + " UNION ALL ".join(_psi_sql(c, EARLY, LATE) for c in DRIFTED) + ") p",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    return rounded(drift.drift_report(rows.where(EARLY), rows.where(LATE), DRIFTED))


MONITORED = ["card1", "card4", "P_emaildomain", "ProductCD"]


@query(
    "unseen_category_rate",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column",
              round(count(*) FILTER (WHERE {c} IS NULL) / count(*)
                - (SELECT count(*) FILTER (WHERE {c} IS NULL) / count(*) FROM fitted), 6) AS missing_rate_drift,
              round(count(*) FILTER (WHERE {c} IS NOT NULL
                AND {c} NOT IN (SELECT {c} FROM fitted WHERE {c} IS NOT NULL)) / count(*), 6) AS unseen_rate,
              (SELECT count(DISTINCT {c}) FROM fitted) AS distinct_fitted, count(DISTINCT {c}) AS distinct_now,
              count(DISTINCT {c}) - (SELECT count(DISTINCT {c}) FROM fitted) AS cardinality_change
            FROM txn WHERE TransactionDT >= 1728000"""
        for c in MONITORED
    ),
    ["txn"],
    {"fitted": "SELECT * FROM txn WHERE TransactionDT < 1728000 AND card4 IS DISTINCT FROM 'discover'"},
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    early = rows.where("TransactionDT < 1728000 AND NOT (card4 <=> 'discover')")
    state = encoding.frequency_fit(encoding.categorical_fill(early, MONITORED), MONITORED)
    return rounded(drift.unseen_category_rate(state, early.count(), rows.where(LATE), MONITORED))


@query(
    "dedup_rows",
    "SELECT DISTINCT ProductCD, card2, card4, addr1, P_emaildomain FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    return drift.dedup_rows(views.txn(spark, sf_dir).select("ProductCD", "card2", "card4", "addr1", "P_emaildomain"))


@query(
    "category_union",
    'SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS index FROM '
    '(SELECT DISTINCT "column", value FROM st WHERE value IS NOT NULL) d',
    ["txn"],
    {"st": _stack(["card1", "card4", "P_emaildomain"], "txn")},
)
def _(spark, sf_dir):
    rows = split_by_time_ratio(views.txn(spark, sf_dir))
    splits = [rows.where(F.col("split") == s) for s in ("train", "validation", "test")]
    return encoding.category_union(splits, ["card1", "card4", "P_emaildomain"])


@query(
    "scale_pos_weight",
    """SELECT p AS positives, n AS negatives, round(n / p, 6) AS scale_pos_weight,
              '1.0|3.0|5.0|' || CAST(round(sqrt(n / p), 4) AS VARCHAR) || '|10.0' AS candidate_weights
       FROM (SELECT count(*) FILTER (WHERE isFraud = 1) AS p, count(*) FILTER (WHERE isFraud = 0) AS n FROM txn) t""",
    ["txn"],
)
def _(spark, sf_dir):
    weights = profile.scale_pos_weight(views.txn(spark, sf_dir))
    joined_weights = F.array_join(F.transform("candidate_weights", lambda w: w.cast("string")), "|")
    return rounded(weights.withColumn("candidate_weights", joined_weights))


@query(
    "latency_summary",
    """SELECT endpoint, model_version, count(*) AS request_count, count(*) FILTER (WHERE status = 'success')
            AS successful_requests, count(*) FILTER (WHERE status <> 'success') AS failed_requests,
          round(count(*) FILTER (WHERE status <> 'success') / count(*), 6) AS error_rate,
          round(min(ok), 6) AS min_ms, round(avg(ok), 6) AS mean_ms, round(quantile_cont(ok, 0.5), 6) AS p50_ms,
          round(quantile_cont(ok, 0.95), 6) AS p95_ms, round(quantile_cont(ok, 0.99), 6) AS p99_ms,
          round(max(ok), 6) AS max_ms,
          round(count(*) FILTER (WHERE status = 'success') / (max(epoch(ts)) - min(epoch(ts))), 6) AS throughput_rps
       FROM (SELECT *, CASE WHEN status = 'success' THEN latency_ms END AS ok FROM prediction_log) l GROUP BY 1, 2""",
    ["prediction_log"],
)
def _(spark, sf_dir):
    return rounded(profile.latency_summary(views.prediction_log(spark, sf_dir), ["endpoint", "model_version"]))


