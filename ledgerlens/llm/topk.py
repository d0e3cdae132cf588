"""Exact top-k inner products of integer vectors, block at a time.

Rows are put in an order that keeps like vectors together and cut into blocks. A block's forward index is its matrix;
its term maxima are the greatest and least value of each component, so a query's score in a block is at most
sum(q+ * max + q- * min). A task takes the blocks it is given in order of that bound and leaves out those whose bound
lies below the k-th score that every query of the group already has there. Queries and rows meet in blocks of both.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; components that a shorter
vector lacks count as 0; ties go to the smaller id; rows that share an id are each a candidate, save for that id's own
query, which equal rows ask once; with fewer than k candidates all are returned; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.session import written

BLOCK = 512
QUERIES = 256


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """While a table of blocks is written: a row is a whole block, so few of them go to Python at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and floor(scale * x) of each component x."""
    values = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return vectors.where(finite(F.col("embedding"))).select("vec_id", values.alias("v"))


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list array, shorter ones padded with 0."""
    ends = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    width = int(ends.max()) if len(ends) else 0
    out = np.zeros((len(ends), width), dtype=values.dtype)
    out[np.arange(width) < ends[:, None]] = values
    return out


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, v) as blocks of up to ``size``: ids and values, like vectors side by side."""
    order = [F.array_position("v", F.array_max("v")), F.array_position("v", F.array_min("v")), F.xxhash64("vec_id")]
    keyed = rows.select("vec_id", "v", *[c.alias(f"o{i}") for i, c in enumerate(order)])
    keyed = keyed.repartitionByRange("o0", "o1", "o2").sortWithinPartitions("o0", "o1", "o2").select("vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                m = matrix(part.column("v")).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([m.shape[1]], pa.int64()),
                        pa.array([m.tobytes()], pa.binary()),
                    ],
                    names=["ids", "width", "m"],
                )

    return keyed.mapInArrow(run, "ids array<long>, width long, m binary")


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer products; by doubles where every sum stays below 2**53."""
    width = max(q.shape[1], m.shape[1])
    q, m = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, m))
    largest = width * float(np.abs(q).max(initial=0)) * float(np.abs(m).max(initial=0))
    if largest < 2**53:
        return (q.astype(np.float64) @ m.astype(np.float64).T).astype(np.int64)
    return q @ m.T


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best among all other ids."""
    rows = written(quantised(vectors, scale).withColumn("query", is_query), "quantised")
    against = written(blocks(rows.select("vec_id", "v"), BLOCK), "blocks")
    asked = written(blocks(rows.where("query").select("vec_id", "v").distinct(), QUERIES), "queries")
    pairs = against.crossJoin(asked.toDF("q_ids", "q_width", "q_m"))  # blocks of a stated query set against blocks of all rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list[list[tuple[int, int]]]] = {}  # per group of queries: each one's k best (score, -id) here
        for batch in batches:
            work = []
            for i in range(batch.num_rows):
                q_ids, ids = tuple(batch.column("q_ids")[i].as_py()), np.array(batch.column("ids")[i].as_py(), np.int64)
                q = np.frombuffer(batch.column("q_m")[i].as_buffer(), np.int64).reshape(len(q_ids), batch.column("q_width")[i].as_py())
                m = np.frombuffer(batch.column("m")[i].as_buffer(), np.int64).reshape(len(ids), batch.column("width")[i].as_py())
                high, low = m.max(axis=0, initial=0)[None], m.min(axis=0, initial=0)[None]
                bound = _products(np.maximum(q, 0), high) + _products(np.minimum(q, 0), low)
                work.append((int(bound.max()), q_ids, q, ids, m, bound[:, 0]))
            for _, q_ids, q, ids, m, bound in sorted(work, key=lambda w: -w[0]):
                tops = best.setdefault(q_ids, [[] for _ in q_ids])
                open_ = [j for j, t in enumerate(tops) if len(t) < k or bound[j] >= t[-1][0]]
                if not open_:
                    continue
                scores = _products(q[open_], m)
                for row, j in enumerate(open_):
                    others = np.flatnonzero(ids != q_ids[j])  # rows of the query's own id, however many, take no place
                    if not len(others):
                        continue
                    theirs, n = scores[row, others], min(k, len(others))
                    floor = np.partition(theirs, len(others) - n)[len(others) - n]
                    if len(tops[j]) == k:
                        floor = max(floor, tops[j][-1][0])
                    found = [(int(theirs[c]), -int(ids[others[c]])) for c in np.flatnonzero(theirs >= floor)]
                    tops[j] = sorted(tops[j] + found, reverse=True)[:k]
        out = [(q, s, -v) for q_ids, tops in best.items() for q, top in zip(q_ids, tops, strict=True) for s, v in top]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "score", "vec_id"])

    with small_batches(vectors.sparkSession, 64):
        found = written(pairs.mapInArrow(run, "query_id long, score long, vec_id long"), "found")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
