"""Near-duplicate embeddings by product quantisation: links between vectors of one label with cosine >= threshold.

Coarse inverted lists (nearest of some centroids) hold the vectors of a label; what a centroid leaves over is coded per
subspace, and the length of what the code misses is kept beside it. A query looks its distance to every code up in
tables of its own (asymmetric distances) and reranks exactly what may be near enough. What is near is found:

* a list is probed unless the plane between its centroid and the query's own lies further away than a neighbour may
  reach across it: the whole radius, or, with ``deviations``, so many standard deviations of a neighbour at the radius in
  a random direction (three by default, and a pair may be found from either end; 20 of 128 lists on the test vectors,
  where recall against brute force is 1.0);
* a code is passed over only if its distance less what it misses is over the radius.

Centroids and codebooks are fitted on FIT_ROWS vectors at most, chosen by a hash; all vectors are indexed. Equal vectors
are one entry with a weight. Lists are cut into blocks and their queries into groups, so that a task holds one of each.

The driver holds the fitted rows and the index. The planner takes a vector for one component, an exploded row for one row
and a file for its compressed size, so what grows with the vectors meets by merging, never by a broadcast. Blocks and
queries stay where the count of their list met them: the probed rows are shuffled once.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and rows without a label, link with
nothing; vectors of different lengths don't link; rows that share a vec_id count once and link with themselves never; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.graph import components
from ledgerlens.llm.topk import finite, matrix, small_batches
from ledgerlens.session import written

FIT_ROWS = 8192
ROWS_PER_LIST = 64  # fitted vectors for each centroid
SUBSPACE = 8  # components that one code byte stands for
CODES = 64
BLOCK = 512
DEVIATIONS = 3.0
SLACK = 1e-6  # for rounding in bounds; the final check is exact


@dataclass(frozen=True)
class Index:
    """``directions``: how many directions the vectors really spread in around their centroids."""

    centroids: np.ndarray
    codebooks: list[np.ndarray]
    directions: float


def _means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows of ``x`` (which come in the order of a hash)."""
    means = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _distances(x, means).argmin(axis=1)
        for j in range(k):
            if (near == j).any():
                means[j] = x[near == j].mean(axis=0)
    return means


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)[None], 0.0)


def _split(width: int) -> list[slice]:
    return [slice(a, min(width, a + SUBSPACE)) for a in range(0, width, SUBSPACE)]


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit(vectors: DataFrame, width: int) -> Index:
    """Centroids and codebooks for unit vectors of ``width`` components, from FIT_ROWS rows at most."""
    own = vectors.where(F.size("v") == width)
    chosen = own.select(F.xxhash64("vec_id").alias("h"), "vec_id", "v").orderBy("h", "vec_id").limit(FIT_ROWS)
    # Written first: collected as it is, each task would send the driver as many rows.
    rows = written(chosen, "fitted").toPandas().sort_values(["h", "vec_id"])
    x = unit(np.array(rows["v"].tolist(), dtype=np.float64).reshape(-1, width))
    centroids = _means(x, max(1, len(x) // ROWS_PER_LIST))
    rest = x - centroids[_distances(x, centroids).argmin(axis=1)]
    return Index(centroids, [_means(rest[:, s], min(CODES, len(rest))) for s in _split(width)], _directions(rest))


def _directions(rest: np.ndarray) -> float:
    """(sum of variances)**2 / sum of squared variances along the axes: the width for even spread, the rank at most."""
    variances = np.linalg.eigvalsh(rest.T @ rest) if len(rest) else np.zeros(1)
    squares = float((variances**2).sum())
    return max(1.0, float(variances.sum()) ** 2 / squares) if squares > 0 else 1.0


def assign(vectors: DataFrame, index: Index, threshold: float, deviations: float | None = DEVIATIONS) -> DataFrame:
    """vec_id, label, v, its list, code and what the code misses; and the lists that its neighbours may be in."""
    radius = np.sqrt(2.0 - 2.0 * threshold) + SLACK
    # A neighbour's step has a part along the line to another centroid; even steps in d directions have 1 / sqrt(d) of it.
    reach = radius if deviations is None else radius * min(1.0, deviations / np.sqrt(index.directions))
    between = np.sqrt(_distances(index.centroids, index.centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column("v")))
            d = _distances(x, index.centroids)
            home = d.argmin(axis=1)
            rest = x - index.centroids[home]
            code = np.zeros((len(x), len(index.codebooks)), np.uint8)
            told = np.zeros_like(x)
            for j, (book, s) in enumerate(zip(index.codebooks, _split(x.shape[1]), strict=True)):
                code[:, j] = _distances(rest[:, s], book).argmin(axis=1)
                told[:, s] = book[code[:, j]]
            missed = np.sqrt(((rest - told) ** 2).sum(axis=1))
            gap = between[home]
            beyond = np.where(gap > 0, (d - d[np.arange(len(x)), home][:, None]) / np.maximum(2 * gap, 1e-300), 0.0)
            probes = [np.flatnonzero(row <= reach) for row in beyond]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("vec_id", "label", "v")],
                    pa.array(home, pa.int64()),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(missed),
                    pa.array(probes, pa.list_(pa.int64())),
                ],
                names=["vec_id", "label", "v", "home", "code", "missed", "probes"],
            )

    label, v = (vectors.schema[c].dataType.simpleString() for c in ("label", "v"))
    return vectors.select("vec_id", "label", "v").mapInArrow(
        run, f"vec_id long, label {label}, v {v}, home long, code binary, missed double, probes array<long>"
    )


def _blocks(rows: DataFrame, size: int, *columns: str) -> DataFrame:
    """Rows of each (label, home) as blocks of about ``size``."""
    count = rows.groupBy("label", "home").agg(F.ceil(F.count(F.lit(1)) / size).alias("n"))
    keyed = rows.join(count.hint("merge"), ["label", "home"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("n")))
    return keyed.groupBy("label", "home", "block").agg(F.collect_list(F.struct(*columns)).alias("rows")).drop("block")


def near_pairs(entries: DataFrame, index: Index, threshold: float) -> DataFrame:
    """(a, b), a < b: entries with cosine >= threshold, by probing, table lookups and the exact check."""
    radius = np.sqrt(2.0 - 2.0 * threshold) + SLACK
    lists = _blocks(entries, BLOCK, "vec_id", "v", "code", "missed")
    asked = entries.select("vec_id", "label", "v", F.explode("probes").alias("home"))
    asked = _blocks(asked, BLOCK, "vec_id", "v").withColumnRenamed("rows", "queries")
    together = asked.join(lists.hint("merge"), ["label", "home"]).select("home", "rows", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, queries = batch.column("rows")[i].values, batch.column("queries")[i].values
                ids, q_ids = rows.field("vec_id").to_numpy(), queries.field("vec_id").to_numpy()
                v, q = matrix(rows.field("v")).astype(np.float64), matrix(queries.field("v")).astype(np.float64)
                code = np.frombuffer(b"".join(rows.field("code").to_pylist()), np.uint8).reshape(len(ids), -1)
                missed = rows.field("missed").to_numpy()
                rest = unit(q) - index.centroids[batch.column("home")[i].as_py()]
                told = np.zeros((len(q), len(ids)))
                for j, (book, s) in enumerate(zip(index.codebooks, _split(q.shape[1]), strict=True)):
                    told += _distances(rest[:, s], book)[:, code[:, j]]
                a, b = np.nonzero((np.sqrt(told) - missed[None] <= radius) & (q_ids[:, None] != ids[None]))
                norms, q_norms = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
                for at in range(0, len(a), 100_000):
                    x, y = a[at : at + 100_000], b[at : at + 100_000]
                    exact = np.einsum("ij,ij->i", q[x], v[y]) / (q_norms[x] * norms[y])
                    near = exact >= threshold
                    one, other = q_ids[x[near]], ids[y[near]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(one, other)), pa.array(np.maximum(one, other))], names=["a", "b"]
                    )

    with small_batches(entries.sparkSession, 16):
        return written(together.mapInArrow(run, "a long, b long"), "near").distinct()


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, deviations: float | None = DEVIATIONS) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, embedding, label)."""
    kind = vectors.schema["embedding"].dataType.elementType
    v = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0).cast(kind)).otherwise(x))
    usable = finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", v.alias("v"), F.coalesce(usable, F.lit(False)).alias("usable"))
    rows = written(rows, "vectors")
    groups = rows.where("usable").groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count_distinct("vec_id").alias("copies"))
    entries = written(groups.withColumnRenamed("first", "vec_id"), "entries")
    found = None
    for r in entries.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1))).collect():  # one index per vector length
        own = entries.where(F.size("v") == r["width"])
        index = fit(own, r["width"])
        pairs = near_pairs(written(assign(own, index, threshold, deviations), "index"), index, threshold)
        found = pairs if found is None else found.union(pairs)
    if found is None:
        out = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
        return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    links = written(found, "vector-links")
    both = links.union(links.select("b", "a")).toDF("vec_id", "other")
    weight = entries.select(F.col("vec_id").alias("other"), "copies")
    near = both.join(weight.hint("merge"), "other").groupBy("vec_id").agg(F.sum("copies").alias("near"))
    named = components(links).toDF("vec_id", "component")
    known = entries.join(near.hint("merge"), "vec_id", "left").join(named.hint("merge"), "vec_id", "left").select(
        "label",
        "v",
        (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.lit(True).alias("usable"),
    )
    out = rows.join(known.hint("merge"), ["label", "v", "usable"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
