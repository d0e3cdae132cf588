"""Long repeated word runs across a corpus, by compaction of a De Bruijn graph.

Edges of the graph are windows of k consecutive words. A stretch of windows that share their smallest m-word hash (the
minimizer) is a path without branches as seen from its text, and is kept as one compacted edge: (minimizer, hash of the
whole stretch, source coordinates). Equal stretches meet by both hashes, 128 bits: all their windows repeat. Stretches
that share the minimizer only are where paths branch: those, and one stretch of each kind they branch from, are opened
into single windows, which meet by 96 bits. Rows are dealt out in ranges of the sorted keys, so a passage that a third
of all documents share is spread over as many tasks as it needs; what touches the edge of a range is opened as well.
Last, the coordinates go back to their texts, and the covered words are taken out.

Defined cases: words are runs of characters other than space and 0x09-0x0D, unchanged; null and empty texts have none;
texts of fewer than k words have no window; a window that repeats within one text counts; repeated rows repeat each
other; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import trim
from ledgerlens.llm.words import U, WORD_BASE, run_hashes, slices, words_of
from ledgerlens.session import written

MINIMIZER = 8  # words
CHECK_BASE = 0xA0761D6478BD642F


def _windows(row: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which places of a slice's n words begin a window of one text."""
    return row[: max(0, n - k + 1)] == row[k - 1 :] if n >= k else np.zeros(0, bool)


def _runs(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(hashes, starts, ends, WORD_BASE)


def stretches(rows: DataFrame, k: int) -> DataFrame:
    """(minimizer, whole, key, start, n): n windows from word ``start`` of the row ``key``."""
    width = k - MINIMIZER + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"))
                n = len(words.hashes)
                inside = _windows(words.row, n, k)
                if not inside.any():
                    continue
                at = np.arange(n - MINIMIZER + 1)
                least = _runs(words.hashes, at, at + MINIMIZER)
                span = 1
                while span * 2 <= width:  # least over 1, 2, 4 ... hashes, then over ``width``
                    least = np.minimum(least[:-span], least[span:])
                    span *= 2
                least = np.minimum(least[: len(inside)], least[width - span :][: len(inside)])
                change = np.append(True, (least[1:] != least[:-1]) | (words.row[1 : len(inside)] != words.row[: len(inside) - 1]))
                change[1:] |= inside[1:] != inside[:-1]
                begins = np.flatnonzero(change)
                ends = np.append(begins[1:], len(inside))
                begins, ends = begins[inside[begins]], ends[inside[begins]]
                whole = _runs(words.hashes, begins, ends + k - 1)
                row = words.row[begins]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(least[begins].view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        part.column("key").take(pa.array(row)),
                        pa.array(begins - words.first[row], pa.int64()),
                        pa.array(ends - begins, pa.int64()),
                    ],
                    names=["minimizer", "whole", "key", "start", "n"],
                )
        trim()

    return rows.mapInArrow(run, "minimizer long, whole long, key long, start long, n long")


def _with_neighbours(batches: Iterator[pa.RecordBatch], first: str, second: str) -> Iterator[tuple]:
    """For rows sorted by (first, second): each batch with flags of what the rows before and after share.

    Yields (rows, same pair before, same pair after, same first before, same first after, edge of the task).
    """
    held: pa.RecordBatch | None = None
    before: tuple | None = None

    def flags(rows: pa.RecordBatch, n: int, at_end: bool) -> tuple:
        a, b = rows.column(first).to_numpy(), rows.column(second).to_numpy()
        next_a, next_b = a[1:] == a[:-1], (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        start_a = before is not None and before[0] == a[0]
        start_b = start_a and before[1] == b[0]
        edge = np.zeros(len(a), bool)
        edge[0] = before is None
        if at_end:
            edge[-1] = True
        one = (np.append(start_b, next_b), np.append(next_b, False), np.append(start_a, next_a), np.append(next_a, False), edge)
        return (rows.slice(0, n), *[x[:n] for x in one])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        n = rows.num_rows
        if n > 1:
            yield flags(rows, n - 1, False)
            before = (rows.column(first)[n - 2].as_py(), rows.column(second)[n - 2].as_py())
        held = rows.slice(n - 1)
    if held is not None:
        yield flags(held, 1, True)


def met(found: DataFrame) -> DataFrame:
    """(key, start, n, repeated, opened): stretches that repeat as a whole, and those to be opened into windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, pair_before, pair_after, first_before, first_after, edge in _with_neighbours(batches, "minimizer", "whole"):
            repeated = pair_before | pair_after
            opened = (first_before & ~pair_before) | (first_after & ~pair_after) | edge
            out = pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in ("key", "start", "n")], pa.array(repeated), pa.array(opened)],
                names=["key", "start", "n", "repeated", "opened"],
            )
            yield out.filter(pa.array(repeated | opened))

    dealt = found.repartitionByRange("minimizer", "whole", "key", "start").sortWithinPartitions("minimizer", "whole")
    return dealt.mapInArrow(run, "key long, start long, n long, repeated boolean, opened boolean")


def windows(rows: DataFrame, opened: DataFrame, k: int) -> DataFrame:
    """(h, check, key, place) of every window of the opened stretches."""
    lists = opened.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"))
                spans = part.column("spans")
                owner = np.repeat(np.arange(part.num_rows), np.diff(spans.offsets.to_numpy()))
                flat = spans.flatten()
                starts, sizes = flat.field("start").to_numpy(), flat.field("n").to_numpy()
                place = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                owner = np.repeat(owner, sizes)
                at = words.first[owner] + place
                check = run_hashes(words.hashes, at, at + k, CHECK_BASE)
                for i in range(0, len(at), 200_000):
                    s = slice(i, i + 200_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_runs(words.hashes, at[s], at[s] + k).view(np.int64)),
                            pa.array((check[s] >> U(33)).astype(np.int32)),
                            part.column("key").take(pa.array(owner[s])),
                            pa.array(place[s].astype(np.int32)),
                        ],
                        names=["h", "check", "key", "place"],
                    )
        trim()

    return rows.join(lists, "key").select("key", "text", "spans").mapInArrow(run, "h long, check int, key long, place int")


def repeated_windows(found: DataFrame) -> DataFrame:
    """(key, start, n) of the windows whose words begin at another place as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, before, after, _, _, edge in _with_neighbours(batches, "h", "check"):
            out = rows.append_column("repeated", pa.array(before | after))
            yield out.filter(pa.array(before | after | edge))

    dealt = found.repartitionByRange("h", "check", "key", "place").sortWithinPartitions("h", "check")
    kept = written(dealt.mapInArrow(run, "h long, check int, key long, place int, repeated boolean"), "windows")
    # Windows at the edges of the ranges: two rows a task at most.
    edges = kept.where("NOT repeated")
    again = edges.groupBy("h", "check").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "check")
    more = edges.join(again, ["h", "check"])
    beside = edges.join(kept.where("repeated").select("h", "check").distinct(), ["h", "check"], "left_semi")
    places = kept.where("repeated").select("key", "place").union(more.select("key", "place")).union(beside.select("key", "place"))
    return places.select("key", F.col("place").cast("bigint").alias("start"), F.lit(1).cast("bigint").alias("n"))


def remove_repeats(docs: DataFrame, k: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, the kept text and its sha256 for each row of (doc_id, text)."""
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(F.col("doc_id"), text).alias("key"))
    found = written(met(stretches(rows.select("key", "text"), k)), "stretches")
    single = repeated_windows(windows(rows.select("key", "text"), found.where("opened"), k))
    spans = found.where("repeated").select("key", "start", "n").union(single)
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"))
                texts, spans = part.column("text").to_pylist(), part.column("spans")
                begins = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(spans), 0).to_numpy()))
                span_starts, span_sizes = (spans.flatten().field(c).to_numpy() for c in ("start", "n"))
                n = len(words.hashes)
                at = np.flatnonzero(_windows(words.row, n, k))
                own = _runs(words.hashes, at, at + k)
                removed_count, kept_texts, digests = [], [], []
                for r, text in enumerate(texts):
                    mine = slice(begins[r], begins[r + 1])
                    a, b = int(words.first[r]), int(words.first[r + 1])
                    cover = np.zeros(b - a + 1, np.int64)
                    lo, hi = np.searchsorted(at, [a, b])
                    _, which, count = np.unique(own[lo:hi], return_inverse=True, return_counts=True)
                    inner = at[lo:hi][count[which] > 1] - a if hi > lo else np.zeros(0, np.int64)
                    starts = np.concatenate([inner, span_starts[mine]])
                    sizes = np.concatenate([np.ones(len(inner), np.int64), span_sizes[mine]])
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + sizes + k - 1, -1)
                    gone = np.cumsum(cover)[: b - a] > 0
                    if gone.any():
                        raw = text.encode().split()
                        kept = b" ".join([w for w, g in zip(raw, gone, strict=True) if not g])
                    else:
                        kept = b" ".join((text or "").encode().split())
                    removed_count.append(int(gone.sum())), kept_texts.append(kept.decode()), digests.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array(removed_count, pa.int64()),
                        pa.array(kept_texts, pa.string()),
                        pa.array(digests, pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
                )
        trim()

    together = rows.join(spans, "key", "left").select("doc_id", "text", "spans")
    return together.mapInArrow(
        run, f"doc_id {kind.simpleString()}, n_words long, n_removed long, kept_text string, kept_sha256 string"
    )
