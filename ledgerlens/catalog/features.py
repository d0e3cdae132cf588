"""Composite feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import JOINED, UID, joined, rounded
from ledgerlens.catalog.registry import query
from ledgerlens.operators.encoding import UID_STATS
from ledgerlens.plans import features_v1, features_v2, tables

TRAIN = "TransactionDT < 1728000 AND card4 IS DISTINCT FROM 'discover'"
SPARK_TRAIN = "TransactionDT < 1728000 AND NOT (card4 <=> 'discover')"
LATER = "TransactionDT >= 1728000"
CARDS = ["card1", "card2", "card3", "card4"]
V1_RAW = ["TransactionDT", "TransactionAmt", "card1", "card2", "card3", "addr1", "addr2"]
V1_TEXT = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain"]

V1_SQL = (
    "SELECT t.TransactionID, "
    + ", ".join(f"t.{c}" for c in V1_RAW)
    + ", "
    + ", ".join(f"CASE WHEN t.{c} IN (SELECT {c} FROM tr WHERE {c} IS NOT NULL) THEN t.{c} END AS {c}" for c in V1_TEXT)
    + ", CAST(floor(TransactionDT / 86400) AS BIGINT) AS day, CAST(floor(TransactionDT / 3600) AS BIGINT) % 24 AS hour, "
    + ", ".join(f"coalesce(f_{c}.n, 0) AS {c}_freq" for c in CARDS)
    + "{more} FROM txn t "
    + " ".join(
        f"LEFT JOIN (SELECT {c} AS v, count(*) AS n FROM tr GROUP BY 1) f_{c} ON t.{c} IS NOT DISTINCT FROM f_{c}.v"
        for c in CARDS
    )
    + " {join} WHERE "
    + LATER
)
V1_STATS = {
    "tr": f"SELECT * FROM txn WHERE {TRAIN}",
    "st": f"SELECT {UID} AS uid, count(*) AS n, avg(TransactionAmt) AS m, coalesce(stddev_samp(TransactionAmt), 0) AS s, "
    "median(TransactionAmt) AS d FROM tr GROUP BY 1",
    "g": "SELECT avg(TransactionAmt) AS gm, stddev_samp(TransactionAmt) AS gs FROM tr",
}


@query("features_v1", V1_SQL.format(more="", join=""), ["txn"], {"tr": V1_STATS["tr"]})
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir).drop("score")
    state = features_v1.fit(rows.where(SPARK_TRAIN))
    return features_v1.transform(rows.where(LATER), state, key="TransactionID")


TAIL_SQL = """, 0 AS uid_time_to_next, 0 AS uid_time_from_prev, coalesce(st.n, 1) AS uid_txn_count,
    round(coalesce(st.m, gm), 6) AS uid_amt_mean, round(coalesce(st.s, gs), 6) AS uid_amt_std,
    round(coalesce(st.d, gm), 6) AS uid_amt_median,
    round((t.TransactionAmt - coalesce(st.m, gm)) / (coalesce(st.s, gs) + 1e-6), 2) AS uid_amt_deviation"""


@query(
    "features_v1_contract",
    V1_SQL.format(more=TAIL_SQL, join=f"LEFT JOIN st ON st.uid = {UID} CROSS JOIN g"),
    ["txn"],
    V1_STATS,
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir).drop("score")
    state = features_v1.fit(rows.where(SPARK_TRAIN))
    features = features_v1.transform(rows.where(LATER), state, state.contract, key="TransactionID")
    return rounded(features, uid_amt_deviation=2)


CATEGORIES = [
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
    "DeviceType",
    "DeviceInfo",
    "id_01",
    "id_02",
    "id_12",
]
COUNTED = [c for c in features_v2.FREQUENCY_COLUMNS if c in CATEGORIES]
CROSSED = {
    "ProductCD_DeviceType_missing_interaction": "ProductCD || '__DeviceType_missing_' || CAST(DeviceType_missing_flag AS VARCHAR)",
    "ProductCD_DeviceInfo_missing_interaction": "ProductCD || '__DeviceInfo_missing_' || CAST(DeviceInfo_missing_flag AS VARCHAR)",
    "ProductCD_R_emaildomain_missing_interaction": "ProductCD || '__R_emaildomain_missing_' || "
    "CAST(R_emaildomain_missing_flag AS VARCHAR)",
    "card3_addr2_interaction": "card3 || '__' || addr2",
    "card4_card6_interaction": "card4 || '__' || card6",
}
FLAGS = ", ".join(
    f"CAST({c} = '__MISSING__' AS INT) AS {c}_missing_flag"
    for c in ("DeviceInfo", "DeviceType", "R_emaildomain", "P_emaildomain")
)
FILLED = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '__MISSING__') AS {c}" for c in CATEGORIES)
KNOWN = ", ".join(
    f"CASE WHEN {c} = '__MISSING__' OR {c} IN (SELECT {c} FROM tr) THEN {c} ELSE '__UNKNOWN__' END AS {c}"
    for c in CATEGORIES
)
BASE = "TransactionID, CAST(TransactionDT AS DOUBLE) AS TransactionDT, TransactionAmt AS raw_amount"
CROSS = ", ".join(f"{text} AS {name}" for name, text in CROSSED.items())
V2_SQL = (
    """SELECT TransactionID, TransactionDT, 0 AS TransactionDT_was_missing,
      round(coalesce(raw_amount, (SELECT median(raw_amount) FROM tr)), 6) AS TransactionAmt,
      CAST(raw_amount IS NULL AS INT) AS TransactionAmt_was_missing,
      CAST(floor(TransactionDT / 3600) AS BIGINT) % 24 AS transaction_hour,
      CAST(floor(TransactionDT / 86400) AS BIGINT) AS transaction_day,
      CAST(ProductCD = 'W' AS INT) AS ProductCD_W_flag, 0 AS high_identity_missing_flag,
      DeviceInfo_missing_flag, DeviceType_missing_flag, R_emaildomain_missing_flag, P_emaildomain_missing_flag,
      CAST(id_01 = '__MISSING__' AS INT) + CAST(id_02 = '__MISSING__' AS INT) + CAST(id_12 = '__MISSING__' AS INT)
        AS identity_missing_count,
      round((CAST(id_01 = '__MISSING__' AS INT) + CAST(id_02 = '__MISSING__' AS INT)
        + CAST(id_12 = '__MISSING__' AS INT)) / 3.0, 6) AS identity_missing_ratio, """
    + ", ".join(f"l.{c}" for c in CATEGORIES)
    + ", "
    + ", ".join(
        f"CASE WHEN l.{c} IN (SELECT {c} FROM ti) THEN l.{c} ELSE '__UNKNOWN__' END AS {c}" for c in CROSSED
    )
    + ", "
    + ", ".join(f"coalesce(f_{c}.n, 0) AS {c}_frequency" for c in COUNTED)
    + " FROM li l "
    + " ".join(f"LEFT JOIN (SELECT {c} AS v, count(*) AS n FROM tr GROUP BY 1) f_{c} ON l.{c} = f_{c}.v" for c in COUNTED)
)
V2_VIEWS = {
    "j": JOINED,
    "tr": f"SELECT {BASE}, {FILLED} FROM j WHERE {TRAIN}",
    "la": f"SELECT {BASE}, {FILLED} FROM j WHERE {LATER}",
    "kn": f"SELECT TransactionID, TransactionDT, raw_amount, {KNOWN} FROM la",
    "tf": f"SELECT *, {FLAGS} FROM tr",
    "lf": f"SELECT *, {FLAGS} FROM kn",
    "ti": f"SELECT {CROSS} FROM tf",
    "li": f"SELECT *, {CROSS} FROM lf",
}


@query("features_v2", V2_SQL, ["txn", "ident"], V2_VIEWS)
def _(spark, sf_dir):
    rows = joined(spark, sf_dir).drop("score")
    state = features_v2.fit(rows.where(SPARK_TRAIN))
    return rounded(features_v2.transform(rows.where(LATER), state, keep=["TransactionID"]))


@query(
    "foundation_table",
    "SELECT *, CAST(floor(TransactionDT / 86400) AS BIGINT) AS day, CAST(floor(TransactionDT / 3600) AS BIGINT) % 24 AS hour, "
    + ", ".join(f"count(*) OVER (PARTITION BY {c}) AS {c}_freq" for c in CARDS)
    + f" FROM ({JOINED}) j",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    return tables.foundation_table(views.txn(spark, sf_dir), views.ident(spark, sf_dir))


W = "OVER (PARTITION BY uid ORDER BY TransactionDT, TransactionID)"


@query(
    "behavioral_table",
    f"""SELECT TransactionID, uid, lag(TransactionDT) {W} AS uid_prev_dt, lead(TransactionDT) {W} AS uid_next_dt,
          TransactionDT - lag(TransactionDT) {W} AS uid_time_from_prev,
          lead(TransactionDT) {W} - TransactionDT AS uid_time_to_next, n AS uid_txn_count,
          round(m, 6) AS uid_amt_mean, round(s, 6) AS uid_amt_std, round(d, 6) AS uid_amt_median,
          round((TransactionAmt - m) / (s + 1e-6), 6) AS uid_amt_deviation
        FROM (SELECT *, {UID} AS uid FROM txn) t JOIN
             (SELECT {UID} AS uid, count(*) AS n, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS s,
                     median(TransactionAmt) AS d FROM txn GROUP BY 1) g USING (uid)""",
    ["txn"],
)
def _(spark, sf_dir):
    table = tables.behavioral_table(views.txn(spark, sf_dir))
    gaps = ["uid_prev_dt", "uid_next_dt", "uid_time_from_prev", "uid_time_to_next"]
    return rounded(table.select("TransactionID", "uid", *gaps, *UID_STATS, "uid_amt_deviation"))


@query(
    "batch_prepare",
    f"SELECT DISTINCT * EXCLUDE (isFraud, score) FROM ({JOINED}) j",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    batch = views.txn(spark, sf_dir).drop("isFraud", "score")
    doubled = batch.unionByName(batch.where("TransactionID % 10 = 0"))
    identity = views.ident(spark, sf_dir).withColumn("id_99", F.lit(None).cast("double"))
    return tables.batch_prepare(doubled, identity)


@query(
    "entity_risk_metrics",
    f"""SELECT *, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1_score FROM (
         SELECT ProductCD, count(*) FILTER (WHERE score < 0.2 AND isFraud = 0) AS tn,
           count(*) FILTER (WHERE score >= 0.2 AND isFraud = 0) AS fp,
           count(*) FILTER (WHERE score < 0.2 AND isFraud = 1) AS fn,
           count(*) FILTER (WHERE score >= 0.2 AND isFraud = 1) AS tp,
           round(count(*) FILTER (WHERE (score >= 0.2) = (isFraud = 1)) / count(*), 6) AS accuracy,
           round(coalesce(count(*) FILTER (WHERE score >= 0.2 AND isFraud = 1)
             / nullif(count(*) FILTER (WHERE score >= 0.2), 0), 0), 6) AS precision,
           round(coalesce(count(*) FILTER (WHERE score >= 0.2 AND isFraud = 1)
             / nullif(count(*) FILTER (WHERE isFraud = 1), 0), 0), 6) AS recall,
           round(count(*) FILTER (WHERE score >= 0.2) / count(*), 6) AS alert_rate,
           CAST(0.2 AS DOUBLE) AS threshold, round(avg((TransactionAmt - m) / (s + 1e-6)), 6) AS mean_deviation,
           CAST(sum(n) AS BIGINT) AS entity_rows
         FROM (SELECT *, {UID} AS uid FROM ({JOINED}) j) t JOIN
           (SELECT {UID} AS uid, count(*) AS n, avg(TransactionAmt) AS m, coalesce(stddev_samp(TransactionAmt), 0) AS s
            FROM txn GROUP BY 1) g USING (uid) GROUP BY ProductCD) q""",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    return rounded(tables.entity_risk_metrics(views.txn(spark, sf_dir), views.ident(spark, sf_dir)))


