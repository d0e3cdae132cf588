"""Projections, filters, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import JOINED, UID, joined, rounded, train_rows
from ledgerlens.catalog.registry import query
from ledgerlens.catalog.sources import MESSAGE_SQL, READABLE, message_stream, messages
from ledgerlens.functions import expressions as E
from ledgerlens.functions.requests import extract_request_fields, route_counts
from ledgerlens.operators import encoding, guards, missed
from ledgerlens.operators.splits import sort_by_time
from ledgerlens.session import written
from ledgerlens.sources import events
from ledgerlens.streaming.sinks import run_to_parquet


@query("require_columns", "SELECT * FROM txn", ["txn"])
def _(spark, sf_dir):
    return guards.require_columns(views.txn(spark, sf_dir), guards.REQUIRED_COLUMNS, "transactions")


@query(
    "drop_non_features",
    "SELECT * EXCLUDE (TransactionID, isFraud) FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    return guards.drop_non_features(views.txn(spark, sf_dir).withColumn("uid", E.uid()))


@query(
    "separate_target",
    "SELECT card4, count(*) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud FROM txn GROUP BY card4",
    ["txn"],
)
def _(spark, sf_dir):
    features, labels = guards.separate_target(views.txn(spark, sf_dir))
    return features.join(labels, "TransactionID").groupBy("card4").agg(
        F.count(F.lit(1)).alias("n"), F.sum("isFraud").alias("fraud")
    )


@query(
    "drop_all_null_columns",
    "SELECT TransactionID, DeviceType, id_01 FROM ident",
    ["ident"],
)
def _(spark, sf_dir):
    padded = views.ident(spark, sf_dir).select(
        "TransactionID",
        F.lit(None).cast("string").alias("id_98"),
        "DeviceType",
        F.lit(None).cast("double").alias("id_99"),
        "id_01",
    )
    return guards.drop_all_null_columns(padded)


@query(
    "align_feature_schema",
    "SELECT TransactionDT, 0 AS uid_time_to_next, card1, 0 AS uid_time_from_prev, TransactionAmt FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    order = ["TransactionDT", "uid_time_to_next", "card1", "uid_time_from_prev", "TransactionAmt"]
    return guards.align_feature_schema(views.txn(spark, sf_dir), order)


CONTRACT = ["TransactionDT", "TransactionAmt", "card1", "card2", "addr1", "P_emaildomain", "id_01"]


@query(
    "check_feature_contract",
    """SELECT 'absent' AS "check", 'id_01' AS "column", CAST(1 AS BIGINT) AS violations
       UNION ALL SELECT 'extra', 'score', 1
       UNION ALL SELECT 'null', 'TransactionAmt', count(*) FROM txn WHERE TransactionAmt IS NULL
       UNION ALL SELECT 'null', 'card2', count(*) FROM txn WHERE card2 IS NULL
       UNION ALL SELECT 'null', 'addr1', count(*) FROM txn WHERE addr1 IS NULL
       UNION ALL SELECT 'null', 'P_emaildomain', count(*) FROM txn WHERE P_emaildomain IS NULL""",
    ["txn"],
)
def _(spark, sf_dir):
    table = views.txn(spark, sf_dir).select(*CONTRACT[:-1], "score")
    return guards.check_feature_contract(table, CONTRACT)


@query(
    "apply_threshold",
    """SELECT TransactionID, score, CAST(score >= 0.2 AS INT) AS fraud_prediction,
              CAST(0.2 AS DOUBLE) AS threshold, 'v2' AS model_version, 'catboost' AS model_family FROM txn""",
    ["txn"],
)
def _(spark, sf_dir):
    scored = views.txn(spark, sf_dir).select("TransactionID", "score")
    return guards.apply_threshold(scored, 0.2, version="v2", family="catboost")


@query("filter_by_key", "SELECT TransactionID, card4, score FROM txn WHERE card4 = 'visa' AND ProductCD = 'W'", ["txn"])
def _(spark, sf_dir):
    keys = {"card4": "visa", "ProductCD": "W"}
    return guards.filter_by_key(views.txn(spark, sf_dir), keys, ["TransactionID", "card4", "score"])


@query(
    "outcome_flags",
    """SELECT TransactionID, isFraud AS _y_true, score AS _y_proba, CAST(score >= 0.4 AS INT) AS _y_pred,
              isFraud = 1 AND score < 0.4 AS _is_false_negative, isFraud = 1 AND score >= 0.4 AS _is_true_positive,
              isFraud = 0 AS _is_non_fraud FROM txn""",
    ["txn"],
)
def _(spark, sf_dir):
    flagged = missed.outcome_flags(views.txn(spark, sf_dir), 0.4)
    return flagged.select("TransactionID", *[c for c in flagged.columns if c.startswith("_")])


@query(
    "column_groups",
    """SELECT c AS "column", kind, id_like, feature_kind FROM (VALUES
         ('TransactionID', 'numeric', true, 'numeric'), ('TransactionDT', 'numeric', false, 'numeric'),
         ('TransactionAmt', 'numeric', false, 'numeric'), ('ProductCD', 'categorical', false, 'categorical'),
         ('card1', 'numeric', true, 'categorical'), ('card2', 'numeric', true, 'categorical'),
         ('card3', 'numeric', true, 'categorical'), ('card4', 'categorical', true, 'categorical'),
         ('card6', 'categorical', true, 'categorical'), ('addr1', 'numeric', true, 'categorical'),
         ('addr2', 'numeric', true, 'categorical'), ('P_emaildomain', 'categorical', false, 'categorical'),
         ('R_emaildomain', 'categorical', false, 'categorical'), ('isFraud', 'numeric', false, 'numeric'),
         ('score', 'numeric', false, 'numeric'), ('DeviceType', 'categorical', false, 'categorical'),
         ('DeviceInfo', 'categorical', false, 'categorical'), ('id_12', 'categorical', true, 'categorical'),
         ('id_02', 'numeric', true, 'categorical')) v(c, kind, id_like, feature_kind)
       UNION ALL SELECT 'id_01', 'numeric', true,
         CASE WHEN (SELECT count(DISTINCT TransactionID * 10 + id_01) FROM ident) <= 1000
              THEN 'categorical' ELSE 'numeric' END""",
    ["ident"],
)
def _(spark, sf_dir):
    # id_01 made nearly unique, so that both sides of the distinct-count rule are met as data grows.
    wide = joined(spark, sf_dir).withColumn("id_01", F.col("TransactionID") * 10 + F.col("id_01"))
    return guards.column_groups(wide)


@query(
    "sort_by_time",
    "SELECT TransactionID, TransactionDT, row_number() OVER (ORDER BY TransactionDT, TransactionID) > 0 AS placed FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir).select("TransactionID", "TransactionDT")
    return sort_by_time(rows).withColumn("placed", F.lit(True))


@query(
    "time_parts",
    """SELECT TransactionID, CAST(floor(TransactionDT / 86400) AS BIGINT) AS transaction_day,
              CAST(floor(TransactionDT / 3600) AS BIGINT) % 24 AS transaction_hour,
              CAST(floor(TransactionDT / 86400) AS BIGINT) % 7 AS transaction_day_of_week FROM txn""",
    ["txn"],
)
def _(spark, sf_dir):
    t = "TransactionDT"
    return views.txn(spark, sf_dir).select(
        "TransactionID",
        E.day(t).alias("transaction_day"),
        E.hour(t).alias("transaction_hour"),
        E.day_of_week(t).alias("transaction_day_of_week"),
    )


@query("uid_key", f"SELECT TransactionID, {UID} AS uid FROM txn", ["txn"])
def _(spark, sf_dir):
    return views.txn(spark, sf_dir).select("TransactionID", E.uid().alias("uid"))


@query(
    "numeric_coerce_impute",
    """SELECT TransactionID, coalesce(x, m) AS amount_text, CAST(x IS NULL AS INT) AS amount_text_was_missing,
              CAST(7.5 AS DOUBLE) AS absent, 0 AS absent_was_missing
       FROM (SELECT TransactionID, CASE WHEN TransactionID % 13 = 0 THEN NULL ELSE TransactionAmt END AS x FROM txn) t
       CROSS JOIN (SELECT median(TransactionAmt) AS m FROM txn WHERE TransactionDT < 1728000 AND TransactionID % 13 <> 0) s""",
    ["txn"],
)
def _(spark, sf_dir):
    text = F.when(F.col("TransactionID") % 13 == 0, F.lit("not-a-number")).otherwise(F.col("TransactionAmt").cast("string"))
    rows = views.txn(spark, sf_dir).select("TransactionID", "TransactionDT", text.alias("amount_text"))
    fitted = encoding.numeric_median_fit(train_rows(rows), ["amount_text"]).first()["median"]
    return encoding.numeric_coerce_impute(rows, {"amount_text": fitted, "absent": 7.5}).drop("TransactionDT")


@query(
    "categorical_fill",
    """SELECT TransactionID,
         CASE WHEN card4 IS NULL THEN '__MISSING__' WHEN card4 IN (SELECT card4 FROM seen WHERE card4 IS NOT NULL)
              THEN card4 ELSE '__UNKNOWN__' END AS card4,
         CASE WHEN card1 IN (SELECT card1 FROM seen) THEN CAST(card1 AS VARCHAR) ELSE '__UNKNOWN__' END AS card1
       FROM txn""",
    ["txn"],
    {"seen": "SELECT card1, card4 FROM txn WHERE TransactionDT < 1728000 AND card4 IS DISTINCT FROM 'discover'"},
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    early = rows.where("TransactionDT < 1728000 AND NOT (card4 <=> 'discover')")
    vocabulary = written(encoding.category_vocab_fit(early, ["card1", "card4"]), "vocabulary", ["column"])
    return encoding.categorical_fill(rows.select("TransactionID", "card1", "card4"), ["card1", "card4"], vocabulary)


@query(
    "missing_flags",
    f"""SELECT TransactionID, CAST(DeviceInfo IS NULL AS INT) AS DeviceInfo_missing_flag,
               CAST(DeviceType IS NULL AS INT) AS DeviceType_missing_flag,
               CAST(P_emaildomain IS NULL AS INT) AS P_emaildomain_missing_flag,
               1 AS R_emaildomain_missing_flag FROM ({JOINED}) j""",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    rows = joined(spark, sf_dir).drop("R_emaildomain")
    return encoding.missing_flags(rows).select("TransactionID", *[f"{c}_missing_flag" for c in encoding.FLAGGED_COLUMNS])


@query(
    "identity_missingness",
    f"""SELECT TransactionID, n AS identity_missing_count, round(n / 3.0, 6) AS identity_missing_ratio,
               0 AS high_identity_missing_flag
        FROM (SELECT TransactionID, CAST(id_01 IS NULL AS INT) + CAST(id_02 IS NULL AS INT)
                + CAST(id_12 IS NULL AS INT) AS n FROM ({JOINED}) j) c""",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    counted = encoding.identity_missingness(joined(spark, sf_dir))
    return rounded(
        counted.select("TransactionID", "identity_missing_count", "identity_missing_ratio", "high_identity_missing_flag")
    )


M = "coalesce({0}, '__MISSING__')"


@query(
    "interactions",
    f"""SELECT TransactionID, CAST(ProductCD = 'W' AS INT) AS ProductCD_W_flag,
          ProductCD || '__DeviceType_missing_' || CAST(CAST(DeviceType IS NULL AS INT) AS VARCHAR)
            AS ProductCD_DeviceType_missing_interaction,
          ProductCD || '__DeviceInfo_missing_' || CAST(CAST(DeviceInfo IS NULL AS INT) AS VARCHAR)
            AS ProductCD_DeviceInfo_missing_interaction,
          ProductCD || '__R_emaildomain_missing_' || CAST(CAST(R_emaildomain IS NULL AS INT) AS VARCHAR)
            AS ProductCD_R_emaildomain_missing_interaction,
          CAST(card3 AS VARCHAR) || '__' || {M.format('CAST(addr2 AS VARCHAR)')} AS card3_addr2_interaction,
          {M.format('card4')} || '__' || {M.format('card6')} AS card4_card6_interaction
        FROM ({JOINED}) j""",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    crossed = encoding.interactions(joined(spark, sf_dir))
    return crossed.select("TransactionID", *encoding.interaction_columns(crossed))


@query(
    "email_match",
    """SELECT TransactionID, CAST(P_emaildomain = R_emaildomain AS INT) AS purchaser_recipient_email_match FROM txn""",
    ["txn"],
)
def _(spark, sf_dir):
    return views.txn(spark, sf_dir).select("TransactionID", E.email_match().alias("purchaser_recipient_email_match"))


BAND_SQL = """CASE WHEN TransactionAmt <= 25 THEN '<=25' WHEN TransactionAmt <= 50 THEN '25-50'
                WHEN TransactionAmt <= 100 THEN '50-100' WHEN TransactionAmt <= 250 THEN '100-250'
                WHEN TransactionAmt <= 500 THEN '250-500' WHEN TransactionAmt > 500 THEN '>500' END"""
HOUR_SQL = """CASE WHEN h <= 5 THEN 'overnight' WHEN h <= 11 THEN 'morning' WHEN h <= 17 THEN 'afternoon'
                ELSE 'evening' END"""


@query(
    "bands",
    f"""SELECT TransactionID, {BAND_SQL} AS TransactionAmt_band, {HOUR_SQL} AS transaction_hour_band,
               n AS identity_missing_count,
               CASE WHEN n <= 0 THEN '0' WHEN n <= 5 THEN '1-5' WHEN n <= 20 THEN '6-20' ELSE '21+' END
                 AS identity_missing_count_band
        FROM (SELECT *, CAST(floor(TransactionDT / 3600) AS BIGINT) % 24 AS h, CAST(id_01 IS NULL AS INT)
                + CAST(id_02 IS NULL AS INT) + CAST(id_12 IS NULL AS INT) AS n FROM ({JOINED}) j) c""",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    banded = missed.add_bands(joined(spark, sf_dir))
    return banded.select(
        "TransactionID",
        "TransactionAmt_band",
        "transaction_hour_band",
        "identity_missing_count",
        "identity_missing_count_band",
    )


@query(
    "ordinal_standardize",
    """SELECT TransactionID, CAST(coalesce(code, 0) AS DOUBLE) AS card4,
              round(CAST(CAST((coalesce(TransactionAmt, m) - m) / s AS FLOAT) AS DOUBLE), 4) AS TransactionAmt
       FROM (SELECT *, coalesce(card4, '__MISSING__') AS c FROM txn) t
       LEFT JOIN codes ON c = v CROSS JOIN stats WHERE TransactionDT >= 1728000""",
    ["txn"],
    {
        "fit": "SELECT coalesce(card4, '__MISSING__') AS v, TransactionAmt AS x FROM txn "
        "WHERE TransactionDT < 1728000 AND card4 IS DISTINCT FROM 'discover'",
        "codes": "SELECT v, row_number() OVER (ORDER BY v) AS code FROM (SELECT DISTINCT v FROM fit) d",
        "stats": "SELECT avg(x) AS m, stddev_samp(x) AS s FROM fit",
    },
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    names = ["TransactionID", "card4", "TransactionAmt"]
    train = rows.where("TransactionDT < 1728000 AND NOT (card4 <=> 'discover')").select(*names)
    encoded = encoding.ordinal_standardize(train, rows.where("TransactionDT >= 1728000").select(*names), "TransactionID")
    return rounded(encoded.withColumns({c: F.col(c).cast("double") for c in names[1:]}), 4)


@query("parse_event_json", f"{MESSAGE_SQL} {READABLE}", ["txn"])
def _(spark, sf_dir):
    return events.good_events(events.parse_event_json(messages(views.txn(spark, sf_dir), "null")))


@query(
    "quarantine_events",
    "SELECT count(*) FILTER (WHERE TransactionID % 100 = 99 OR TransactionID % 101 = 100) AS bad, count(*) AS messages FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    parsed = events.parse_event_json(message_stream(spark, sf_dir))
    table = run_to_parquet(parsed.select("_bad"), "parsed")
    return table.agg(F.count_if("_bad").alias("bad"), F.count(F.lit(1)).alias("messages"))


W = r"(?i)(?:transaction(?:\s*id)?|txn)\s*[:#]?\s*([A-Za-z0-9_-]+)"
X = r"(?i)\b((?:TX|txn)[-_]?\d+)\b"


@query(
    "extract_request_fields",
    rf"""SELECT request_id,
          array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(text, '{W}', 1),
            regexp_extract_all(text, '{X}', 1)))), ',') AS transaction_ids,
          array_to_string(regexp_extract_all(text, '\b(\d{{4}}-\d{{2}}-\d{{2}})\b', 1), ',') AS date_ranges,
          array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '\b(v[12])\b', 1))), ',')
            AS model_versions,
          round(CAST(regexp_extract(lower(text), 'threshold\s*(?:=|to|at|:)?\s*(0?\.\d+|1(?:\.0+)?)', 1) AS DOUBLE), 6)
            AS first_threshold,
          CASE WHEN regexp_matches(lower(text), '\bhigh\b') THEN 'high' ELSE '' END AS risk_categories,
          false AS malformed_or_missing_inputs
        FROM requests""",
    ["requests"],
)
def _(spark, sf_dir):
    found = extract_request_fields(views.requests(spark, sf_dir))
    return found.select(
        "request_id",
        *[F.array_join(c, ",").alias(c) for c in ("transaction_ids", "date_ranges", "model_versions")],
        F.round(F.try_element_at("thresholds", F.lit(1)), 6).alias("first_threshold"),
        F.array_join("risk_categories", ",").alias("risk_categories"),
        "malformed_or_missing_inputs",
    )


@query(
    "route_requests",
    """SELECT tool, risk_level, requires_human_approval, count(*) AS requests FROM (
         SELECT CASE WHEN t LIKE '%rollback%' THEN 'rollback_readiness' WHEN t LIKE '%monitor%' THEN 'model_monitoring'
                     ELSE 'fraud_risk_analysis' END AS tool,
                CASE WHEN t LIKE '%rollback%' OR t LIKE '%monitor%' THEN 'medium'
                     WHEN regexp_matches(t, '\\bhigh\\b') THEN 'high' ELSE 'medium' END AS risk_level,
                t LIKE '%rollback%' AS requires_human_approval
         FROM (SELECT lower(text) AS t FROM requests) r) q GROUP BY ALL""",
    ["requests"],
)
def _(spark, sf_dir):
    return route_counts(views.requests(spark, sf_dir))


@query(
    "deviation_score",
    """SELECT TransactionID, round((TransactionAmt - m) / (s + 1e-6), 6) AS deviation
       FROM txn LEFT JOIN (SELECT ProductCD, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS s
                           FROM txn GROUP BY ProductCD) g USING (ProductCD)""",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    stats = rows.groupBy("ProductCD").agg(F.avg("TransactionAmt").alias("m"), F.stddev_samp("TransactionAmt").alias("s"))
    attached = rows.join(stats, "ProductCD", "left")
    return rounded(attached.select("TransactionID", E.deviation("TransactionAmt", "m", "s").alias("deviation")))
