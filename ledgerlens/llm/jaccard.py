"""Exact n-gram Jaccard join by first tokens, with one level of leaves pruned by their bitmaps.

A document is the set of its distinct k-word runs. Two documents link when 100 * |A & B| >= percent * |A | B|.

1. Equal sets meet by their 128-bit fingerprint and are linked to the smallest doc_id among them.
2. Tokens are ordered by how many documents have them, rare ones first, then by hash (all tokens of all documents are
   counted; any order that is the same everywhere gives the same links). Linked sets share a token among the first
   n - ceil(t n) + 1 of each: a bucket.
3. In every bucket each document is compared with a first one; these links give components. A bucket
   whose documents are all in one component is finished: its further links change nothing.
4. In the other buckets leaves (no nodes stand above them) hold up to LEAF documents of one component and near size,
   with the OR of their token bitmaps, their range of sizes and the most tokens any of them hides in shared bits. Leaves of
   different components meet in a bucket only if its token may be the first that a linked pair shares (all that it shares
   comes from there on, so each side must have as many tokens left as the link needs; see ``leaf_candidates``). They are
   dropped when their sizes or the greatest possible overlap rule a link out:
   |a & b| <= |a| - popcount(a) + popcount(a AND OR(b)). The documents of two leaves that are left are compared by
   their own bitmaps likewise, within the task that has both leaves; pairs that pass are checked on the full sets.

So no link between components is missed. Texts that are near each other without a link (a document beside a large group
of near copies) are still compared with each of the group, 100 bytes or so at a time.

Defined cases: null and empty texts have an empty set and link with nothing; fewer than k words are one shingle, the
whole sequence; rows that share a doc_id are one document; a null doc_id takes no part (null component); an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import kept, trim
from ledgerlens.llm.graph import components
from ledgerlens.llm.words import U, mix, shingle_sets, slices
from ledgerlens.session import written

CELL_BITS = 24  # of the bitmap of wanted documents: 2 MB at any size of the corpus
COMMON = 4  # documents from which a token counts as common: the first of the LEVELS
LEVELS = 15  # of common tokens, each of twice as many documents as the one before
LEVEL_BITS = 25  # of the table of levels, four bits a place: 16 MB at most
COUNTED = 2_000_000  # tokens that a task counts at a time
BITS = 4  # of a bitmap, to a token: at least this many
KEPT_SETS = 200_000  # that a task remembers; a set that comes again after that is only looked at again
LEAF = 32
SIZE_BANDS = 8  # leaves per doubling of the size


def _sets(part: pa.RecordBatch, k: int) -> Iterator[tuple[int | None, np.ndarray]]:
    return zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"), k), strict=True)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def bitmap_of(tokens: np.ndarray) -> tuple[bytes, int]:
    """The bits of a set's tokens, and how many tokens share a bit with another one.

    A bitmap has the next power of two as its size, so that a larger one folds onto a smaller one.
    """
    size = max(64, BITS << len(tokens).bit_length())
    own = np.zeros(size, np.uint8)
    own[(mix(tokens, 4) & U(size - 1)).astype(np.int64)] = 1
    return np.packbits(own).tobytes(), len(tokens) - int(own.sum())


def set_prints(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n, two independent sums of the mixed hashes of its set, and its bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        for batch in (part for whole in batches for part in slices(whole)):
            ids, n, f1, f2, bits, hidden = [], [], [], [], [], []
            for doc, tokens in _sets(batch, k):
                ids.append(doc), n.append(len(tokens))
                f1.append(mix(tokens, 1).sum(dtype=U)), f2.append(mix(tokens, 2).sum(dtype=U))
                one, out_of_sight = bitmap_of(tokens)
                bits.append(one), hidden.append(out_of_sight)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(_signed(np.array(f1, U))),
                    pa.array(_signed(np.array(f2, U))),
                    pa.array(bits, pa.binary()),
                    pa.array(hidden, pa.int64()),
                ],
                names=["doc_id", "n", "f1", "f2", "bits", "hidden"],
            )
        trim()

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, bits binary, hidden long")


def _bitmap(cells: DataFrame) -> np.ndarray:
    """2**CELL_BITS flags, set for the cells of a table; at most 2**(CELL_BITS - 6) rows reach the driver."""
    words = cells.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")).alias("bits"))
    bitmap = np.zeros(1 << (CELL_BITS - 6), np.int64)
    for r in words.collect():
        bitmap[r["at"]] = r["bits"]
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little")


def _packed(x: np.ndarray) -> bytes:
    """32-bit numbers, most of them small."""
    return pa.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(raw, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4").ravel()


def token_counts(docs: DataFrame, tokens: int, k: int) -> tuple[DataFrame, int]:
    """(cell, n, slot, level) of the tokens that at least COMMON documents have, n how many, and the bits of a cell.

    A cell is the first bits of a token, with 32 cells or more to each token occurrence; tokens that share one count
    together. Tasks send sorted cells of a range, as differences, to the task that adds up that range.
    """
    size = max(1, tokens - 1).bit_length()
    bits, range_bits = min(58, max(24, size + 5)), max(0, size + 1 - COUNTED.bit_length())
    shift = U(bits - range_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(COUNTED, U), 0

        def told() -> pa.RecordBatch:
            held[:total].sort()
            cuts = np.flatnonzero(np.append(True, np.diff(held[:total] >> shift) > 0))
            out: list[tuple] = []
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), total], strict=True):
                own, at = held[i:j], int(held[i] >> shift)
                begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                steps = np.diff(own[begins], prepend=U(at << int(shift)))
                out.append((at, len(begins), _packed(steps), _packed(np.diff(begins, append=j - i))))
            names = ["range", "cells", "steps", "n"]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in (part for whole in batches for part in slices(whole)):
            for _, shingles in _sets(batch, k):
                for at in range(0, len(shingles), COUNTED):
                    some = shingles[at : at + COUNTED]
                    if total + len(some) > COUNTED:
                        yield told()
                        total = 0
                    held[total : total + len(some)] = some >> U(64 - bits)
                    total += len(some)
        if total:
            yield told()
        del held
        trim()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        at = None

        def told() -> pa.RecordBatch:
            cells, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(cells, kind="stable")
            cells, n = cells[order], n[order]
            begins = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
            n = np.add.reduceat(n, begins, dtype=np.int64)
            keep = n >= COMMON
            found = cells[begins][keep].astype(np.int64) + (at << int(shift))
            level = np.minimum(LEVELS, 1 + np.log2(n[keep] / COMMON).astype(np.int64))
            columns = [pa.array(x) for x in (found, n[keep], _slots(found), level)]
            return pa.RecordBatch.from_arrays(columns, names=["cell", "n", "slot", "level"])

        for row in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            if held and row["range"] != at:
                yield told()
            at = row["range"]
            held.append((np.cumsum(_unpacked(row["steps"], row["cells"]), dtype="<u4"), _unpacked(row["n"], row["cells"])))
        if held:
            yield told()
        trim()

    parts = docs.where("doc_id IS NOT NULL").mapInArrow(count, "range long, cells long, steps binary, n binary")
    dealt = parts.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(add, "cell long, n long, slot long, level long"), bits


def _slots(cells: np.ndarray) -> np.ndarray:
    return (mix(cells.astype(U), 3) & U((1 << LEVEL_BITS) - 1)).astype(np.int64)


def token_levels(docs: DataFrame, tokens: int, k: int) -> tuple[np.ndarray, int]:
    """A table of levels (0: rare), two places a byte, and the bits of a cell; see ``levels_of``.

    It decides only the order of tokens, and so which buckets are large; never which pairs link. If there are more common
    tokens than the table has room for, it holds those of the most documents.
    """
    counts, bits = token_counts(docs, tokens, k)
    placed = written(counts.select("slot", "level"), "levels")
    sizes = {r["level"]: r["n"] for r in placed.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    least, room = LEVELS + 1, 1 << (LEVEL_BITS - 3)
    while least > 1 and (room := room - sizes.get(least - 1, 0)) >= 0:
        least -= 1
    held = sum(n for level, n in sizes.items() if level >= least)
    size = 1 << min(LEVEL_BITS, max(10, held.bit_length() + 4))
    slots = placed.where(F.col("level") >= least).groupBy((F.col("slot") % size).alias("slot")).agg(F.max("level").alias("level"))
    words = slots.groupBy(F.shiftright("slot", 4).alias("at")).agg(F.bit_or(F.expr("shiftleft(level, CAST(4 * (slot & 15) AS INT))")).alias("bits"))
    table = np.zeros(size >> 4, np.int64)
    for batch in words.toArrow().to_batches():
        table[batch.column("at").to_numpy()] = batch.column("bits").to_numpy()
    return table.view(np.uint8), bits


def levels_of(shingles: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """The level of each token."""
    slots = _slots(shingles >> U(64 - bits)) & (2 * len(table) - 1)
    return (table[slots >> 1] >> (4 * (slots & 1)).astype(np.uint8)) & 15


def postings(docs: DataFrame, levels: np.ndarray, bits: int, percent: int, k: int) -> DataFrame:
    """(token, rest, n, doc_id) for the first tokens of every document of n tokens; ``rest`` are left from the token on.

    What differs from row to row stands first: a tenth less to shuffle than with ``rest`` at the end. Within a task a set
    that was met before is left out: step 1 has linked it already.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        met: set[tuple[int, int]] = set()
        for batch in (part for whole in batches for part in slices(whole)):
            tokens, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            sizes, rests = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            rows = list(_sets(batch, k))
            ends = np.cumsum([len(x) for _, x in rows])
            ranks = np.split(levels_of(np.concatenate([np.zeros(0, U), *[x for _, x in rows]]), table, bits), ends)
            for (doc, shingles), rank in zip(rows, ranks, strict=False):
                n = len(shingles)
                seen = (int(mix(shingles, 1).sum(dtype=U)), int(mix(shingles, 2).sum(dtype=U)))
                if not n or doc is None or seen in met:
                    continue
                if len(met) >= KEPT_SETS:
                    met.clear()
                met.add(seen)
                ordered = shingles[np.argsort(rank, kind="stable")]
                first = n + (-percent * n) // 100 + 1
                tokens.append(_signed(ordered[:first]))
                ids.append(np.full(first, doc))
                sizes.append(np.full(first, n, np.int32))
                rests.append(np.arange(n, n - first, -1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (tokens, rests, sizes, ids)], names=["token", "rest", "n", "doc_id"]
            )
        del met
        trim()

    return docs.mapInArrow(run, "token long, rest int, n int, doc_id long")


def buckets(posts: DataFrame) -> DataFrame:
    """(token, doc_id, n, rest, center) of the tokens that several postings have.

    Postings are dealt out by ranges of (token, doc_id), so that a token of any number of documents is spread over as
    many tasks as it needs. ``center`` is the token's first document in the task; a task's first and last token are
    kept in any case, as they may go on in another one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "doc_id", "n", "rest"]
        held: pa.RecordBatch | None = None  # a last row whose token may have no other
        open_token = center = None  # of a last token that is kept and may go on
        for i, batch in enumerate(batches):
            batch = batch.select(names)
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, docs = batch.column("token").to_numpy(), batch.column("doc_id").to_numpy()
            if not len(token):
                continue
            begins = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            sizes = np.diff(np.append(begins, len(token)))
            centers, keep = docs[begins].copy(), sizes > 1
            if token[0] == open_token:
                centers[0], keep[0] = center, True
            keep[0] |= i == 0
            open_token, center, held = (token[-1], centers[-1], None) if keep[-1] else (None, None, batch.slice(int(begins[-1])))
            columns = [*batch.columns, pa.array(np.repeat(centers, sizes))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "center"]).filter(pa.array(np.repeat(keep, sizes)))
        if held is not None:
            yield held.append_column("center", held.column("doc_id"))
        trim()

    dealt = posts.repartitionByRange("token", "doc_id").sortWithinPartitions("token", "doc_id")
    return dealt.mapInArrow(run, "token long, doc_id long, n int, rest int, center long")


def shingles_of(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """doc_id and its set, for the documents of ``ids`` and some others: texts are picked by a bitmap of hashed ids.

    So texts are read where they are and only sets are dealt out; the join that follows leaves the others behind.
    """
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(1 << CELL_BITS))
    wanted = docs.sparkSession.sparkContext.broadcast(np.packbits(_bitmap(ids.select(cell.alias("cell")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(wanted.value)
        wanted_rows = (whole.filter(pa.array(flags[whole.column("cell").to_numpy()] > 0)) for whole in batches)
        for batch in (part for whole in wanted_rows for part in slices(whole)):
            rows = list(_sets(batch, k))
            for at in range(0, len(rows), 500):
                part = rows[at : at + 500]
                values = np.concatenate([np.zeros(0, U), *[x for _, x in part]])
                ends = np.cumsum([0, *[len(x) for _, x in part]])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(_signed(values)))
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in part], pa.int64()), lists], names=["doc_id", "shingles"])
        trim()

    rows = docs.where("doc_id IS NOT NULL").withColumn("cell", cell)
    return rows.mapInArrow(run, "doc_id long, shingles array<long>")


def linked(pairs: DataFrame, docs: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link; ``pairs`` is a written table.

    The last join is by a shuffle at any size: a task that made sets and compared them would keep two Python workers busy,
    and an executor holds on to as many as it ever had at once.
    """
    sets = shingles_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), k)
    a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(b, "b").join(a.hint("merge"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            left, right = batch.column("sa"), batch.column("sb")
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        trim()

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def leaves(placed: DataFrame, own: DataFrame) -> DataFrame:
    """(leaf, OR of bitmaps, least and greatest size, most hidden tokens) and the documents of each leaf.

    A leaf's rows stand side by side in one task; there are about LEAF of them, so at most a leaf is carried over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        inner = ("doc_id", "n", "hidden", "bits")

        def told(rows: pa.RecordBatch) -> pa.RecordBatch:
            leaf, n, hidden = (rows.column(c).to_numpy() for c in ("leaf", "n", "hidden"))
            bits = rows.column("bits").to_pylist()
            begins = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
            ends = np.append(begins[1:], len(leaf))
            most, together = hidden[begins].copy(), [bits[i] for i in begins]
            for i in np.flatnonzero(ends - begins > 1):
                own = slice(begins[i], ends[i])
                size = min(map(len, bits[own]))
                each = np.concatenate([_folded(np.frombuffer(x, np.uint64)[None], size) for x in bits[own]])
                most[i] = (n[own] - np.bitwise_count(each).sum(axis=1, dtype=np.int64)).max()
                together[i] = np.bitwise_or.reduce(each, axis=0).tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(leaf[begins]),
                    pa.array(np.minimum.reduceat(n, begins)),
                    pa.array(np.maximum.reduceat(n, begins)),
                    pa.array(most),
                    pa.array(together, pa.binary()),
                    *[pa.ListArray.from_arrays(pa.array(np.append(begins, len(leaf)), pa.int32()), rows.column(c)) for c in inner],
                ],
                names=["leaf", "lo", "hi", "hidden", "bits", *[f"{c}s" for c in inner]],
            )

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            leaf = batch.column("leaf").to_numpy()
            last = int(np.searchsorted(leaf, leaf[-1]))
            held = batch.slice(last)
            if last:
                yield told(batch.slice(0, last))
        if held is not None:
            yield told(held)
        trim()

    rows = placed.join(own.select("doc_id", "n", "hidden", "bits"), "doc_id").select("leaf", "doc_id", "n", "hidden", "bits")
    rows = rows.repartition("leaf").sortWithinPartitions("leaf")
    documents = "doc_ids array<long>, ns array<long>, hiddens array<long>, bitss array<binary>"
    return rows.mapInArrow(run, f"leaf long, lo long, hi long, hidden long, bits binary, {documents}")


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps folded to ``size`` bytes: one row each, words of 64 bits."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, size // 8), axis=1)


def _may_link(batch: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    """The rows (x, y) of ``may_link`` whose bitmaps allow a link."""
    col = {c: batch.column(c) for c in batch.schema.names}
    num = {c: col[c].to_numpy() for c in ("lox", "loy", "hiddenx", "hiddeny")}
    sizes = [pc.binary_length(col[c]).to_numpy() for c in ("bitsx", "bitsy")]
    most = np.zeros(batch.num_rows, np.int64)
    for a, b in set(zip(*[s.tolist() for s in sizes], strict=True)):
        at = np.flatnonzero((sizes[0] == a) & (sizes[1] == b))
        x, y = (
            np.frombuffer(b"".join(col[c].take(pa.array(at)).to_pylist()), np.uint64).reshape(len(at), -1)
            for c in ("bitsx", "bitsy")
        )
        shared = np.bitwise_count(_folded(x, min(a, b)) & _folded(y, min(a, b))).sum(axis=1, dtype=np.int64)
        # What a side hides is known for its own size of bitmap only.
        sides = [num[c][at] for c, s in (("hiddenx", a), ("hiddeny", b)) if s == min(a, b)]
        most[at] = shared + np.minimum.reduce(sides)
    keep = (100 + percent) * most >= percent * (num["lox"] + num["loy"])
    return pa.RecordBatch.from_arrays([col["x"], col["y"]], names=["x", "y"]).filter(pa.array(keep))


def may_link(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) whose sizes and bitmaps allow a link; columns lox, hix, hiddenx, bitsx and the same for y.

    The overlap is at most the shared bits plus the most tokens that one side hides in them; a link needs
    percent / (100 + percent) of both sizes together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 2000) for whole in batches for i in range(0, whole.num_rows, 2000)):
            yield _may_link(batch, percent)
        trim()

    sized = pairs.where((F.col("hix") * 100 >= F.col("loy") * percent) & (F.col("hiy") * 100 >= F.col("lox") * percent))
    return sized.mapInArrow(run, "x long, y long")


def documents_of(leaf_pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of documents, one of each leaf of a pair, whose sizes and bitmaps allow a link."""
    names = ("doc_id", "n", "hidden", "bits")
    both = leaf_pairs
    for side in "xy":
        both = both.join(nodes.select(F.col("leaf").alias(side), *[F.col(f"{c}s").alias(c + side) for c in names]), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 64) for whole in batches for i in range(0, whole.num_rows, 64)):
            first, count = {}, {}
            for side in "xy":
                count[side] = pc.list_value_length(batch.column(f"doc_id{side}")).to_numpy().astype(np.int64)
                first[side] = np.cumsum(count[side]) - count[side]
            pairs = count["x"] * count["y"]
            row = np.repeat(np.arange(batch.num_rows), pairs)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            at = {"x": first["x"][row] + nth // count["y"][row], "y": first["y"][row] + nth % count["y"][row]}
            flat = {c + side: batch.column(c + side).flatten() for c in names for side in "xy"}
            n = {side: flat[f"n{side}"].to_numpy()[at[side]] for side in "xy"}
            near = np.flatnonzero((100 * n["x"] >= percent * n["y"]) & (100 * n["y"] >= percent * n["x"]))
            for i in range(0, len(near), 2000):
                one = {side: pa.array(at[side][near[i : i + 2000]]) for side in "xy"}
                columns = {c + side: flat[c + side].take(one[side]) for c in names for side in "xy"}
                renamed = {"doc_idx": "x", "doc_idy": "y", "nx": "lox", "ny": "loy"}
                yield _may_link(pa.RecordBatch.from_pydict({renamed.get(c, c): v for c, v in columns.items()}), percent)
        trim()

    return both.drop("x", "y").mapInArrow(run, "x long, y long")


def leaf_candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of leaves of different components whose sizes and token places allow a link; each pair once.

    ``entries`` has, for each token of a leaf, the leaf's component c, the sizes lo to hi of its documents with that token,
    and the most tokens (rest) that one of them has from that token on. A link of sizes a and b needs an overlap of
    percent / (100 + percent) of a + b, and all of it lies from the first shared token on, on both sides. So the smaller
    document has 2 percent / (100 + percent) of its own size left there: one side of the join is those entries alone,
    and a token that stands late in nearly all documents, as frequent ones do, pairs few of them.
    """
    early = F.col("rest") * (100 + percent) >= F.col("lo") * (2 * percent)
    entries = entries.withColumn("early", early)
    x, y = (entries.select("token", *[F.col(c).alias(c + s) for c in ("leaf", "c", "lo", "hi", "rest", "early")]) for s in "xy")
    near = x.where("earlyx").drop("earlyx").join(y, "token").where("cx <> cy AND (leafx < leafy OR NOT earlyy)")
    near = near.where((F.col("hix") * 100 >= F.col("loy") * percent) & (F.col("hiy") * 100 >= F.col("lox") * percent))
    near = near.where(F.least("restx", "resty") * (100 + percent) >= (F.col("lox") + F.col("loy")) * percent)
    return near.select(F.least("leafx", "leafy").alias("x"), F.greatest("leafx", "leafy").alias("y")).distinct()


def _with_sides(pairs: DataFrame, table: DataFrame, key: str) -> DataFrame:
    out = pairs
    for side in ("x", "y"):
        out = out.join(table.select(F.col(key).alias(side), *[F.col(c).alias(c + side) for c in ("lo", "hi", "hidden", "bits")]), side)
    return out


def similarity_components(docs: DataFrame, percent: int = 75, k: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) for each row of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = written(set_prints(docs, k), "sets")
    own = prints.where("n > 0 AND doc_id IS NOT NULL")
    least = own.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("most")).where("b < most")
    equal = own.join(least.drop("most"), ["n", "f1", "f2"]).where("doc_id > b").select(F.col("doc_id").alias("a"), "b")
    tokens = own.agg(F.sum("n")).first()[0] or 0
    members = written(buckets(postings(docs, *token_levels(docs, tokens, k), percent, k)), "buckets")
    bits = own.select("doc_id", F.col("n").alias("lo"), F.col("n").alias("hi"), "hidden", "bits")

    stars = members.select("center", "doc_id").union(
        members.join(members.groupBy("token").agg(F.min("center").alias("c"), F.max("center").alias("m")).where("c < m"), "token").select("c", "center")
    )
    stars = stars.toDF("x", "y").where("x < y").distinct()
    stars = written(may_link(_with_sides(stars, bits, "doc_id"), percent).toDF("a", "b"), "stars")
    first = written(equal.union(linked(stars, docs, percent, k)), "links")
    named = written(components(first).toDF("doc_id", "component"), "components")

    # Buckets that still hold several components, as leaves.
    parts = members.select("token", "doc_id", "n", "rest").join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    mixed = parts.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    parts = written(parts.join(mixed.select("token"), "token"), "mixed-buckets")
    placed = parts.groupBy("doc_id").agg(F.first("component").alias("component"), F.first("n").alias("n"))
    placed = placed.withColumn("band", F.floor(F.log2("n") * SIZE_BANDS).cast("int"))
    count = placed.groupBy("component", "band").agg(F.count(F.lit(1)).alias("docs"))
    placed = placed.join(count, ["component", "band"])
    share = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("docs") / LEAF))
    placed = written(placed.select("doc_id", "component", F.xxhash64("component", "band", share).alias("leaf")), "placed")
    nodes = written(leaves(placed, own), "leaves")
    entries = parts.select("token", "doc_id", "n", "rest").join(placed, "doc_id")
    ranges = [f("n" if c != "rest" else c).cast("bigint").alias(c) for f, c in ((F.min, "lo"), (F.max, "hi"), (F.max, "rest"))]
    entries = entries.groupBy("token", "leaf").agg(F.first("component").alias("c"), *ranges)
    entries = written(entries, "tree-entries")
    leaf_pairs = leaf_candidates(entries, percent)
    leaf_pairs = written(may_link(_with_sides(leaf_pairs, nodes, "leaf"), percent), "leaf-pairs")
    doc_pairs = written(documents_of(leaf_pairs, nodes, percent).toDF("a", "b"), "document-pairs")
    second = linked(doc_pairs, docs, percent, k)
    named = components(first.union(second)).toDF("doc_id", "component_id")
    out = prints.select("doc_id", F.col("n").alias("n_shingles")).join(named, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
