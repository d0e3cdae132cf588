"""Table files: CSV and Parquet inputs, lakehouse zones, conversion, fingerprints."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.expressions import normalize_missing
from ledgerlens.session import scratch

ZONES = ["raw", "external", "processed", "curated", "splits"]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its own file system (local, HDFS, object store)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def load_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a table by its suffix: ``.parquet`` or ``.csv``; anything else is refused."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in (".parquet", ".csv"):
        raise ValueError(f"Unsupported dataset file type: {suffix!r}. Expected .parquet or .csv.")
    if not exists(spark, path):
        raise FileNotFoundError(f"Dataset path does not exist: {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    if suffix == ".parquet":
        return normalize_missing(reader.parquet(path))
    reader = reader.option("header", True)
    return normalize_missing(reader.csv(path) if schema else reader.option("inferSchema", True).csv(path))


def csv_to_parquet(
    spark: SparkSession, source: str, target: str, schemas: dict[str, T.StructType | str]
) -> list[str]:
    """Convert ``<source>/<name>.csv`` to snappy Parquet ``<target>/<name>.parquet``.

    Tables whose target exists are left alone. Returns the names written.
    """
    done = []
    for name, schema in schemas.items():
        output = os.path.join(target, f"{name}.parquet")
        if exists(spark, output):
            continue
        table = spark.read.schema(schema).option("header", True).csv(os.path.join(source, f"{name}.csv"))
        table.write.mode("ignore").option("compression", "snappy").parquet(output)
        done.append(name)
    return done


def _zone_path(root: str, zone: str, table: str) -> str:
    if zone not in ZONES:
        raise ValueError(f"Unknown zone {zone!r}; expected one of {ZONES}")
    return os.path.join(root, zone, f"{table}.parquet")


def read_zone(spark: SparkSession, root: str, zone: str, table: str) -> DataFrame:
    path = _zone_path(root, zone, table)
    try:
        return normalize_missing(spark.read.parquet(path))
    except AnalysisException as error:
        raise FileNotFoundError(f"Zone table not found: {path}") from error


def write_zone(
    df: DataFrame, root: str, zone: str, table: str, partition_by: list[str] | None = None
) -> str:
    """Overwrite a zone table as Parquet; give ``partition_by`` (e.g. the day) for large facts.

    Rows are rebalanced by the partition columns first: few files per folder,
    and a folder with very many rows is still written by several tasks.
    """
    path = _zone_path(root, zone, table)
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def bucketed(df: DataFrame, key: str, name: str = "fitted", buckets: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, cut into buckets of ``key``, each sorted.

    For fitted tables that many jobs or micro-batches look keys up in: a join on ``key`` shuffles the other side only.
    There are at least as many buckets as shuffle partitions, else the planner would shuffle both sides again.
    """
    spark = df.sparkSession
    count = buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    writer = df.repartition(count, key).write.format("parquet").option("path", scratch(spark, name))
    writer.bucketBy(count, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def row_hash(df: DataFrame) -> Column:
    """md5 of a row: each column in name order as its bytes' number, a colon and its text, or a dash for null."""
    texts = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]))


def dataset_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Row count and an order-free content hash of a table, in one scan.

    The halves of all row hashes are summed as decimals, which any engine with md5 can repeat; equal rows count each.
    """

    def total(half: Column) -> Column:
        number = F.conv(half, 16, 10).cast("decimal(28,0)")
        return F.coalesce(F.sum(number), F.lit(0).cast("decimal(38,0)")).cast("string")

    return df.select(row_hash(df).alias("h")).agg(
        F.lit(name).alias("table"),
        F.lit(len(df.columns)).alias("columns"),
        F.count(F.lit(1)).alias("rows"),
        total(F.substring("h", 1, 16)).alias("high_hash"),
        total(F.substring("h", 17, 16)).alias("low_hash"),
    )


def run_manifest(
    run_id: str, stage: str, inputs: dict[str, DataFrame], outputs: dict[str, DataFrame]
) -> DataFrame:
    """Inputs and outputs of a run with fingerprints, one row per table."""
    parts = [
        dataset_fingerprint(df, name).withColumn("role", F.lit(role))
        for role, tables in (("input", inputs), ("output", outputs))
        for name, df in tables.items()
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table.withColumns(
        {
            "run_id": F.lit(run_id),
            "stage": F.lit(stage),
            "created_utc": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"),
        }
    )


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows, the same for the same seed: smallest seeded hashes (md5 of ``seed:key``) of the key.

    Runs as a per-task top-n, so only n rows per task move.
    """
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(key).cast("string"))), F.col(key)).limit(n)
