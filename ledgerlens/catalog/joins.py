"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.catalog.helpers import JOINED, UID, joined, rounded
from ledgerlens.catalog.registry import query
from ledgerlens.functions.expressions import uid
from ledgerlens.operators import encoding, enrich
from ledgerlens.session import written
from ledgerlens.streaming.scoring import stream_static_enrich
from ledgerlens.streaming.sinks import run_to_parquet


@query("enrich_identity", JOINED, ["txn", "ident"])
def _(spark, sf_dir):
    return joined(spark, sf_dir)


@query(
    "build_curated",
    f"""SELECT TransactionID, ProductCD, card1, TransactionAmt, n AS uid_txn_count FROM
        (SELECT *, count(*) OVER (PARTITION BY {UID}) AS n FROM txn) t""",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    foundation = rows.select("TransactionID", "ProductCD", "card1", "TransactionAmt")
    counts = rows.groupBy(uid().alias("uid")).agg(F.count(F.lit(1)).alias("uid_txn_count"))
    behavioral = rows.select("TransactionID", "card1", uid().alias("uid")).join(counts, "uid").drop("uid")
    return enrich.build_curated(foundation, behavioral)


@query(
    "lookup_map",
    """SELECT TransactionID, CAST(coalesce(f.freq, 0) AS BIGINT) AS card4_freq FROM txn t
       LEFT JOIN (SELECT card4, count(*) AS freq FROM txn WHERE TransactionDT < 1728000
                  AND card4 IS DISTINCT FROM 'visa' GROUP BY card4) f ON t.card4 IS NOT DISTINCT FROM f.card4""",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    early = rows.where("TransactionDT < 1728000 AND NOT (card4 <=> 'visa')")
    table = early.groupBy("card4").agg(F.count(F.lit(1)).alias("freq"))
    looked_up = enrich.lookup_map(rows, F.col("card4"), table, "card4", {"card4_freq": ("freq", F.lit(0))})
    return looked_up.select("TransactionID", "card4_freq")


@query(
    "known_category_filter",
    """SELECT TransactionID, card1, card1 IN (SELECT card1 FROM txn WHERE TransactionDT < 1728000) AS seen
       FROM txn WHERE TransactionDT >= 1728000""",
    ["txn"],
)
def _(spark, sf_dir):
    rows = views.txn(spark, sf_dir)
    vocabulary = rows.where("TransactionDT < 1728000").select("card1")
    later = rows.where("TransactionDT >= 1728000").select("TransactionID", "card1")
    parts = [
        enrich.known_category_filter(later, F.col("card1"), vocabulary, "card1", seen).withColumn("seen", F.lit(seen))
        for seen in (True, False)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "identity_coverage",
    """SELECT count(*) AS transactions, count(i.TransactionID) AS matched,
              count(*) - count(i.TransactionID) AS unmatched, CAST(5 AS BIGINT) AS columns_added, true AS rows_preserved
       FROM txn t LEFT JOIN ident i USING (TransactionID)""",
    ["txn", "ident"],
)
def _(spark, sf_dir):
    return enrich.identity_coverage(views.txn(spark, sf_dir), views.ident(spark, sf_dir))


@query(
    "label_coverage",
    """SELECT count(*) AS transactions, count(l.doc_id) AS matched, count(*) - count(l.doc_id) AS unmatched,
              CAST(2 AS BIGINT) AS columns_added, true AS rows_preserved
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def _(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return enrich.identity_coverage(documents, labels, "doc_id")


@query(
    "stream_static_enrich",
    f"""SELECT TransactionID, coalesce(n, 1) AS uid_txn_count, round(coalesce(m, gm), 6) AS uid_amt_mean,
               round(coalesce(s, gs), 6) AS uid_amt_std, round(coalesce(d, gm), 6) AS uid_amt_median,
               round((TransactionAmt - coalesce(m, gm)) / (coalesce(s, gs) + 1e-6), 2) AS uid_amt_deviation
        FROM (SELECT *, {UID} AS uid FROM txn) t LEFT JOIN st USING (uid) CROSS JOIN g""",
    ["txn"],
    {
        "st": f"SELECT {UID} AS uid, count(*) AS n, avg(TransactionAmt) AS m, "
        "coalesce(stddev_samp(TransactionAmt), 0) AS s, median(TransactionAmt) AS d FROM txn "
        "WHERE TransactionDT < 1728000 GROUP BY 1",
        "g": "SELECT avg(TransactionAmt) AS gm, stddev_samp(TransactionAmt) AS gs FROM txn WHERE TransactionDT < 1728000",
    },
)
def _(spark, sf_dir):
    train = views.txn(spark, sf_dir).where("TransactionDT < 1728000")
    stats = written(encoding.uid_stats_fit(train), "uid-stats")
    mean, std = encoding.amount_totals(train)
    stream = views.as_txn(views.event_stream(spark, sf_dir))
    table = run_to_parquet(stream_static_enrich(stream, stats, mean, std), "enriched")
    return rounded(table.select("TransactionID", *encoding.UID_STATS, "uid_amt_deviation"), uid_amt_deviation=2)


