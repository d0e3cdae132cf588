"""Small helpers for registered queries: rounding and common inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.catalog import views
from ledgerlens.operators.enrich import enrich_identity

TRAIN_SECONDS = 20 * 86_400  # the fitted rows of the feature queries: the first 20 days

# The same pieces for the reference SQL.
UID = "coalesce(CAST(card1 AS VARCHAR), 'nan') || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan')"
JOINED = "SELECT t.*, i.* EXCLUDE (TransactionID) FROM txn t LEFT JOIN ident i USING (TransactionID)"


def rounded(df: DataFrame, places: int = 6, **other_places: int) -> DataFrame:
    """All doubles rounded: their last digits depend on the order of summation.

    ``other_places`` is for columns of large numbers, which have fewer digits after the point.
    """
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), other_places.get(f.name, places)).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def off_ties(df: DataFrame, *columns: str) -> DataFrame:
    """A hair added where exact values can lie between two roundings (the SQL does the same)."""
    return df.withColumns({c: F.col(c) + 1e-9 for c in columns})


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_identity(views.txn(spark, sf_dir), views.ident(spark, sf_dir))


def train_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("TransactionDT") < TRAIN_SECONDS)


def later_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("TransactionDT") >= TRAIN_SECONDS)
