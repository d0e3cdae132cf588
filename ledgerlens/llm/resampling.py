"""Importance resampling towards a target distribution, over hashed word runs.

A document's weight is the mean gain of its features, a gain being the log ratio of a hash bucket's share in the target
texts to its share in all documents. Documents are drawn without replacement by Gumbel keys: the highest of weight plus
seeded noise.

Features are hashed by CRC-32, taken apart by its linearity: each byte contributes a table entry that depends on the byte
and its distance from the end of the feature, the contributions of a feature are XORed, and a constant for its length
holds what start value and final inversion give. So all features of many texts are hashed by one table lookup and one
XOR over spans. Features over BLOCK bytes are cut into blocks from their end; block values are folded in pairs, the
earlier one moved on by the bytes of the later.

A word is a run of bytes a-z, 0-9 (A-Z are lower-cased before) and over 0x7F. Both passes read the texts where they lie
and shuffle bucket counts and ids only. The driver gets one count for each of the ``buckets``, a parameter; ranks come
from sorted ranges (``ranks.positions``).

Defined cases: null, empty and wordless texts have no features and weight 0; all of them come back, undrawn, as they have
fewer than ``min_words`` words; null doc_ids count as an empty text in the seed; ties go to the smaller doc_id, and among
repeated rows to any; without target texts or documents the counts are 0 and the formula holds; very long texts are worked
on whole, about 80 bytes of memory a byte for the text at hand. Extra columns don't matter, whatever they are called.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import by_bytes
from ledgerlens.llm.ranks import positions
from ledgerlens.session import written

BLOCK = 64  # bytes of a feature with a distance of their own in the table
SLICE_BYTES = 1 << 18  # of text hashed at a time; one longer text is a slice of its own
POLYNOMIAL = 0xEDB88320

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """Contribution of a feature's last byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """Contribution of a byte at distance d from the end, at d * 256 + byte."""
    last = byte_table()
    rows = [last]
    for _ in range(BLOCK - 1):
        rows.append(last[rows[-1] & 255] ^ (rows[-1] >> 8))
    return np.concatenate(rows)


@lru_cache(maxsize=64)
def moved(level: int) -> np.ndarray:
    """Four tables, one per byte of a value: what the value is BLOCK * 2**level bytes earlier in the feature."""
    if level:
        half = moved(level - 1)
        return np.stack([move(half, half[j]) for j in range(4)])
    tables = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    last = byte_table()
    for _ in range(BLOCK):
        tables = last[tables & 255] ^ (tables >> 8)
    return tables


def move(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    return tables[0][values & 255] ^ tables[1][values >> 8 & 255] ^ tables[2][values >> 16 & 255] ^ tables[3][values >> 24]


@lru_cache(maxsize=4096)
def length_constant(n: int) -> int:
    """CRC-32 of n zero bytes."""
    return zlib.crc32(bytes(n))


@lru_cache(maxsize=1)
def _short_constants() -> np.ndarray:
    return np.array([length_constant(n) for n in range(BLOCK + 1)], dtype=np.uint32)


def _arange(counts: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _block_values(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span's bytes; spans have 1 to BLOCK bytes."""
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(starts - first, sizes)
    distance = np.repeat(ends, sizes) - 1 - at
    return np.bitwise_xor.reduceat(position_table()[(distance << 8) | raw[at]], first)


def _folded(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One value per span from those of its blocks, which follow one another; all blocks but a span's first are full."""
    level = 0
    while counts.max() > 1:
        pairs = (counts + 1) // 2
        # From a span's end: block 2j is moved over by none, block 2j + 1 by one block of this level.
        end = np.repeat(np.cumsum(counts), pairs)
        back = np.repeat(pairs, pairs) - 1 - _arange(pairs)
        late = values[end - 1 - 2 * back]
        has = 2 * back + 1 < np.repeat(counts, pairs)
        early = np.where(has, values[np.where(has, end - 2 - 2 * back, 0)], np.uint32(0))
        values, counts, level = late ^ move(moved(level), early), pairs, level + 1
    return values


def crc_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``raw[start:end]`` for each pair, as unsigned 32-bit values; spans may overlap, none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    sizes = ends - starts
    if sizes.max() <= BLOCK:
        return _block_values(raw, starts, ends) ^ _short_constants()[sizes]
    out = np.zeros(len(starts), np.uint32)
    short = sizes <= BLOCK
    if short.any():
        out[short] = crc_spans(raw, starts[short], ends[short])
    starts, ends, sizes = starts[~short], ends[~short], sizes[~short]
    blocks = -(-sizes // BLOCK)
    left = np.repeat(blocks, blocks) - 1 - _arange(blocks)
    block_ends = np.repeat(ends, blocks) - left * BLOCK
    values = _block_values(raw, np.maximum(block_ends - BLOCK, np.repeat(starts, blocks)), block_ends)
    lengths, of = np.unique(sizes, return_inverse=True)
    out[~short] = _folded(values, blocks) ^ np.array([length_constant(int(n)) for n in lengths], dtype=np.uint32)[of]
    return out


def word_runs(texts: pa.Array, longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, row) of all runs of 1 to ``longest`` words of a row, its words joined by one space."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds, raw = offsets - offsets[0], _LOWER[raw]
    inside = _WORD[raw]
    # A word also begins and ends where a row does.
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    opens, closes = edge == 1, edge == -1
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    cuts = cuts[inside[cuts - 1] & inside[cuts]]
    opens[cuts] = closes[cuts] = True
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    row = np.searchsorted(bounds, starts, side="right") - 1
    if longest > 1 and len(starts):
        sizes = ends - starts
        joined = np.full(int((sizes + 1).sum()), 0x20, dtype=np.uint8)
        new = np.cumsum(sizes + 1) - sizes - 1
        joined[np.repeat(new, sizes) + _arange(sizes)] = raw[np.repeat(starts, sizes) + _arange(sizes)]
        raw, starts, ends = joined, new, new + sizes
        runs = [(starts[: len(starts) - k], ends[k:], row[: len(row) - k], row[k:]) for k in range(min(longest, len(starts)))]
        whole = [(a[r == s], b[r == s], r[r == s]) for a, b, r, s in runs]
        starts, ends, row = (np.concatenate(x) for x in zip(*whole, strict=True))
    return raw, starts, ends, row


def bucket_counts(texts: DataFrame, buckets: int, longest: int = 1, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any; a task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE_BYTES):
                raw, starts, ends, _ = word_runs(part.column("text"), longest)
                counts += np.bincount(crc_spans(raw, starts, ends) % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    per_task = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, target: DataFrame, buckets: int, longest: int = 1) -> list[int]:
    """floor(1000 * ln) of each bucket's share in the target over its share in the documents, both with add-one counts."""
    # At most ``buckets`` rows of each table reach the driver.
    s = {r["bucket"]: r["n"] for r in bucket_counts(documents, buckets, longest).collect()}
    t = {r["bucket"]: r["n"] for r in bucket_counts(target, buckets, longest).collect()}
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    return [
        math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t))) for b in range(buckets)
    ]


def _noise(seed: int) -> Column:
    """floor(1000 * Gumbel noise) of a document, from the first 32 bits of sha256("seed:doc_id")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weighted(docs: DataFrame, gains: list[int], longest: int = 1, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight (the floored mean gain) of each row."""
    table = np.array(gains, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE_BYTES):
                raw, starts, ends, row = word_runs(part.column("text"), longest)
                gain = table[crc_spans(raw, starts, ends) % np.uint32(len(table))]
                n = np.bincount(row, minlength=part.num_rows)
                total = np.zeros(part.num_rows, dtype=np.int64)
                np.add.at(total, row, gain)
                # Runs of k words: one less for each k, so the words follow from the runs of a row.
                words = n if longest == 1 else _words(n, longest)
                columns = [part.column("doc_id"), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    schema = slim.select("doc_id").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    return slim.mapInArrow(run, schema)


def _words(features: np.ndarray, longest: int) -> np.ndarray:
    """Words of a row with so many runs of 1 to ``longest`` words."""
    low = np.arange(longest + 1)
    few = low * (low + 1) // 2  # runs of up to ``longest`` words
    many = (features + longest * (longest - 1) // 2) // longest
    return np.where(features < few[-1], np.searchsorted(few, features), many)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    buckets: int = 10_000,
    longest: int = 1,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null where a row is not drawn.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100) are drawn.
    """
    gains = bucket_gains(docs, target, buckets, longest)
    scored = weighted(docs, gains, longest).withColumns(
        {"score": (F.col("weight") + _noise(seed)).cast("bigint"), "_row": F.monotonically_increasing_id()}
    )
    scored = written(scored, "resampling-scores")
    names = ["doc_id", "n_features", "weight", "score"]
    able = written(scored.where(F.col("n_words") >= min_words), "resampling-able")
    drawn = percent * able.count() // 100
    placed = positions(able, [F.desc("score"), F.col("doc_id"), F.col("_row")])
    rank = F.when(F.col("position") < drawn, F.col("position") + 1).cast("bigint").alias("rank")
    rest = scored.where(F.col("n_words") < min_words).select(*names, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*names, rank).unionByName(rest)
