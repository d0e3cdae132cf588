"""Entity timelines, splits and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import UID, off_ties, rounded
from ledgerlens.catalog.registry import query
from ledgerlens.operators import encoding, median, splits, timeline
from ledgerlens.operators.policy import best_row

W = f"OVER (PARTITION BY {UID} ORDER BY TransactionDT, TransactionID)"
GAPS_SQL = f"""SELECT TransactionID, lag(TransactionDT) {W} AS uid_prev_dt, lead(TransactionDT) {W} AS uid_next_dt,
        TransactionDT - lag(TransactionDT) {W} AS uid_time_from_prev,
        lead(TransactionDT) {W} - TransactionDT AS uid_time_to_next FROM txn"""


@query("uid_time_gaps", GAPS_SQL, ["txn"])
def _(spark, sf_dir):
    gaps = timeline.uid_time_gaps(views.txn(spark, sf_dir))
    return gaps.select("TransactionID", "uid_prev_dt", "uid_next_dt", "uid_time_from_prev", "uid_time_to_next")


@query(
    "uid_window_stats",
    f"""SELECT TransactionID, n AS uid_txn_count, round(m, 6) AS uid_amt_mean, round(s, 6) AS uid_amt_std,
               round(d, 6) AS uid_amt_median, round((TransactionAmt - m) / (s + 1e-6), 6) AS uid_amt_deviation
        FROM (SELECT *, {UID} AS uid FROM txn) t LEFT JOIN
             (SELECT {UID} AS uid, count(*) AS n, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS s,
                     median(TransactionAmt) AS d FROM txn GROUP BY 1) g USING (uid)""",
    ["txn"],
)
def _(spark, sf_dir):
    stats = encoding.uid_window_stats(views.txn(spark, sf_dir))
    return rounded(stats.select("TransactionID", *encoding.UID_STATS, "uid_amt_deviation"))


def _past(prefix: str, key: str) -> str:
    frame = (
        f"OVER (PARTITION BY {key} ORDER BY TransactionDT RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    x = "TransactionAmt"
    return f"""count(*) {frame} AS {prefix}_past_count, round(avg({x}) {frame} + 1e-9, 6) AS {prefix}_past_mean,
        round(stddev_samp({x}) {frame}, 6) AS {prefix}_past_std, min({x}) {frame} AS {prefix}_past_min,
        max({x}) {frame} AS {prefix}_past_max,
        round(({x} - avg({x}) {frame}) / (coalesce(stddev_samp({x}) {frame}, 0) + 1e-6), 2) AS {prefix}_past_deviation"""


KEYS = {
    "uid": UID,
    "card1": "coalesce(CAST(card1 AS VARCHAR), 'nan')",
    "addr1": "coalesce(CAST(addr1 AS VARCHAR), 'nan')",
}


@query(
    "past_history_features",
    "SELECT TransactionID, " + ", ".join(_past(p, k) for p, k in KEYS.items()) + " FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    past = timeline.past_history_features(views.txn(spark, sf_dir))
    names = [c for c in past.columns if "_past_" in c]
    # A single earlier amount has no spread: the deviation is the gap times a million, so 2 places.
    shown = past.select("TransactionID", *names)
    means = [c for c in names if c.endswith("mean")]
    return rounded(off_ties(shown, *means), **{c: 2 for c in names if c.endswith("deviation")})


@query(
    "past_history_median",
    "SELECT TransactionID, "
    + ", ".join(
        f"round(median(TransactionAmt) OVER (PARTITION BY {k} ORDER BY TransactionDT "
        f"RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1e-9, 6) AS {p}_past_median"
        for p, k in KEYS.items()
    )
    + " FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir).select("TransactionID", "TransactionDT", "TransactionAmt", "card1", "addr1")
    for prefix, key in timeline.history_keys().items():
        rows = median.past_history_median(rows, key, name=f"{prefix}_past_median")
    names = [f"{p}_past_median" for p in KEYS]
    return rounded(off_ties(rows.select("TransactionID", *names), *names))


@query(
    "time_since_previous",
    f"SELECT TransactionID, TransactionDT - lag(TransactionDT) {W} AS time_since_previous_uid_transaction FROM txn",
    ["txn"],
)
def _(spark, sf_dir):
    since = timeline.time_since_previous(views.txn(spark, sf_dir))
    return since.select("TransactionID", "time_since_previous_uid_transaction")


@query(
    "rolling_history",
    f"""SELECT TransactionID, count(*) OVER w AS uid_count_86400s, round(sum(TransactionAmt) OVER w, 6) AS uid_sum_86400s
        FROM txn WINDOW w AS (PARTITION BY {UID} ORDER BY TransactionDT RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)""",
    ["txn"],
)
def _(spark, sf_dir):
    rolled = timeline.rolling_history(views.txn(spark, sf_dir), 86_400)
    return rounded(rolled.select("TransactionID", "uid_count_86400s", "uid_sum_86400s"))


@query(
    "split_by_time_ratio",
    """SELECT TransactionID, CASE WHEN r <= CAST(floor(n * 0.70) AS BIGINT) THEN 'train'
              WHEN r <= CAST(floor(n * 0.70) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'validation'
              ELSE 'test' END AS split
       FROM (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) AS r, count(*) OVER () AS n FROM txn) t""",
    ["txn"],
)
def _(spark, sf_dir):
    return splits.split_by_time_ratio(views.txn(spark, sf_dir)).select("TransactionID", "split")


@query(
    "split_by_last_days",
    """SELECT TransactionID, CASE WHEN floor(TransactionDT / 86400) <= (SELECT max(floor(TransactionDT / 86400)) - 7 FROM txn)
              THEN 'train' ELSE 'validation' END AS split FROM txn""",
    ["txn"],
)
def _(spark, sf_dir):
    return splits.split_by_last_days(views.txn(spark, sf_dir), 7).select("TransactionID", "split")


@query(
    "best_row",
    """SELECT ProductCD, TransactionID, score FROM (
         SELECT *, row_number() OVER (PARTITION BY ProductCD ORDER BY score DESC, TransactionID) AS r FROM txn) t
       WHERE r = 1""",
    ["txn"],
)
def _(spark, sf_dir):
    order = [F.col("score").desc(), F.col("TransactionID")]
    return best_row(views.txn(spark, sf_dir), ["ProductCD"], order).select("ProductCD", "TransactionID", "score")


