"""Packing token runs into sequences of fixed size by the sum-of-squares rule.

A document's tokens are its text's ids and an end id. Documents longer than a sequence are cut; every piece is then
placed where the sum over residual gaps of (open sequences with that gap) squared becomes smallest, larger pieces first.

Pieces are dealt into groups of about GROUP_PIECES by a hash of their number, so that each group sees the same mix of
sizes; a group is packed in one task. Groups grow in number, not in size, and each leaves a few open sequences only.

Defined cases: a null text counts as empty and still has its end id; a table without rows gives no rows; repeated rows
(and rows that share a doc_id) are packed each for itself. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.batches import kept, trim
from ledgerlens.llm.words import slices
from ledgerlens.session import written

GROUP_PIECES = 30_000
KEPT_WORDS = 500_000  # that a Python worker remembers: some 40 MB
CHUNK_BYTES = 1 << 20  # of text that is cut into parts at a time, up to a white space
SHORT = 16  # bytes of a part that is looked up in the table; longer ones are few

# Kinds of UTF-8 bytes. The tokenizer cuts texts into letter runs, single digits and runs of marks; an apostrophe may
# begin a suffix, and no normaliser changes the letters of ASCII and Latin-1 but for case. What else is in a run of other
# bytes than white space makes that run one part (WHOLE), which the tokenizer cuts.
SPACE, LETTER, DIGIT, MARK, WHOLE = range(5)
KIND = np.full(256, WHOLE, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3]] = LETTER  # C3 80 to C3 BF: Latin-1 letters
KIND[0x30:0x3A] = DIGIT
KIND[list(b"""!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~""")] = MARK
NO_LETTER = (0x97, 0xB7)  # after C3: the signs of times and division
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
LOWER[0x80:0x9F] += 32  # after C3


class Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind: str):
        self.data, self.size = np.zeros(1024, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(max(len(values), len(self.data)), self.data.dtype)])
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


class Table:
    """Numbers of keys of two 64-bit words each, by open addressing in arrays: no Python object for a key."""

    def __init__(self, places: int = 1 << 16):
        self.low, self.high = np.zeros(places, np.uint64), np.zeros(places, np.uint64)
        self.number = np.full(places, -1, np.int32)
        self.size = 0

    def _place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        bits = np.uint64(65 - len(self.number).bit_length())
        mixed = (low ^ (high * np.uint64(0xD1342543DE82EF95))) * np.uint64(0x9E3779B97F4A7C15)
        return (((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)) >> bits).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        at, out = self._place(low, high), np.full(len(low), -1, np.int64)
        left = np.arange(len(low))
        while len(left):
            there = self.number[at]
            same = (self.low[at] == low[left]) & (self.high[at] == high[left])
            out[left[same]] = there[same]  # -1 at an empty place
            more = ~same & (there >= 0)
            left, at = left[more], (at[more] + 1) & (len(self.number) - 1)
        return out

    def add(self, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> None:
        """Different new keys; the table doubles before it is half full."""
        if 2 * (self.size + len(low)) > len(self.number):
            old, used = self, self.number >= 0
            low, high, number = (np.concatenate(x) for x in ((old.low[used], low), (old.high[used], high), (old.number[used], number)))
            self.__init__(1 << (4 * len(low)).bit_length())
        self.size += len(low)
        number = number.astype(np.int32)
        at = self._place(low, high)
        while len(at):
            free = np.flatnonzero(self.number[at] < 0)
            self.number[at[free]] = number[free]
            put = np.zeros(len(at), bool)
            put[free] = self.number[at[free]] == number[free]  # of several for one place the last
            self.low[at[put]], self.high[at[put]] = low[put], high[put]
            low, high, number, at = low[~put], high[~put], number[~put], (at[~put] + 1) & (len(self.number) - 1)


class Encoder:
    """Token ids of whole texts by a tokenizer that drops white space and marks the ends of words.

    Parts that the tokenizer never joins with others are encoded once and looked up from then on.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.table, self.long = Table(), {}
        self.ids, self.ends = Grown("<u4"), Grown("i8")
        self.ends.extend(np.zeros(1, "i8"))

    def learn(self, plain: list[str], whole: list[str]) -> np.ndarray:
        """Numbers for new parts: those of ``plain``, then those of ``whole``."""
        first = self.ends.size - 1
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some):
                self.add(ids, ends)
            else:  # a tokenizer that marks ends otherwise
                self.learn([], some)
        for at in range(0, len(whole), 2000):
            lists = [e.ids for e in self.tokenizer.encode_batch(whole[at : at + 2000], add_special_tokens=False)]
            self.add(np.fromiter(chain.from_iterable(lists), "<u4"), np.cumsum([len(x) for x in lists]))
        return np.arange(first, self.ends.size - 1)

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ends.extend(self.ids.size + np.asarray(ends, dtype="i8"))
        self.ids.extend(ids)

    @staticmethod
    def parts(raw: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and kinds of the parts of some bytes; texts begin at ``first``."""
        kind = KIND[raw]
        begins = np.zeros(len(raw) + 1, bool)
        begins[[0, *first.tolist(), len(raw)]] = True
        for sign in NO_LETTER:
            at = np.flatnonzero(raw[1:] == sign) + 1
            kind[at[raw[at - 1] == 0xC3]] = WHOLE
        if (at := np.flatnonzero(kind == WHOLE)).size:
            run = np.cumsum(begins[:-1] | (kind == SPACE))  # a white space and the run behind it
            odd = np.zeros(run[-1] + 1, bool)
            odd[run[at]] = True
            kind[odd[run] & (kind != SPACE)] = WHOLE
        begins[1:-1] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        edges = np.flatnonzero(begins)
        inside = kind[edges[:-1]] != SPACE
        return edges[:-1][inside], edges[1:][inside], kind[edges[:-1][inside]]

    def numbers(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The number of each part; new ones are learnt."""
        lower = np.concatenate([LOWER[raw], np.zeros(SHORT, np.uint8)])
        out, sizes = np.zeros(len(starts), np.int64), ends - starts
        short = (sizes <= SHORT) & (kinds != WHOLE)
        at, n = starts[short], sizes[short]
        words = np.ndarray((len(lower) - 7,), "<u8", lower, strides=(1,))  # eight bytes from each place on
        low, high = words[at] & BYTES[np.minimum(n, 8)], words[at + 8] & BYTES[np.maximum(n - 8, 0)]
        known = self.table.find(low, high)
        if (new := np.flatnonzero(known < 0)).size:
            new = new[np.lexsort((low[new], high[new]))]
            change = (low[new[1:]] != low[new[:-1]]) | (high[new[1:]] != high[new[:-1]])
            one = new[np.flatnonzero(np.append(True, change))]
            text = lower.tobytes()
            numbers = self.learn([text[i:j].decode() for i, j in zip(at[one].tolist(), (at[one] + n[one]).tolist(), strict=True)], [])
            self.table.add(low[one], high[one], numbers)
            known[new] = np.repeat(numbers, np.diff(np.append(np.flatnonzero(np.append(True, change)), len(new))))
        out[short] = known
        rest = np.flatnonzero(~short)
        if len(rest):
            cased = np.where(np.repeat(kinds[rest] == WHOLE, sizes[rest]), *(x[_spans(starts[rest], sizes[rest])] for x in (raw, lower))).tobytes()
            cuts = np.cumsum(sizes[rest]).tolist()
            keys = [cased[i:j] for i, j in zip([0, *cuts], cuts, strict=False)]
            if fresh := [k for k in dict.fromkeys(keys) if k not in self.long]:
                self.long.update(zip(fresh, self.learn([], [k.decode() for k in fresh]).tolist(), strict=True))
            out[rest] = [self.long[k] for k in keys]
        return out

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = pc.fill_null(texts, "")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        out, counts = [np.zeros(0, "<u4")], np.zeros(len(raw) and len(texts), np.int64)
        begin = 0
        while begin < len(raw):
            end = begin + CHUNK_BYTES
            while end < len(raw) and not (space := np.flatnonzero(KIND[raw[end : end + CHUNK_BYTES]] == SPACE)[:1]).size:
                end += CHUNK_BYTES
            end = min(len(raw), end + int(space[0])) if end < len(raw) else len(raw)
            if self.table.size + len(self.long) > KEPT_WORDS:
                self.forget()
            inner = np.searchsorted(bounds, [begin, end], "right")
            starts, ends, kinds = self.parts(raw[begin:end], bounds[inner[0] : inner[1]][bounds[inner[0] : inner[1]] < end] - begin)
            which = self.numbers(raw[begin:end], starts, ends, kinds)
            sizes = self.ends.data[which + 1] - self.ends.data[which]
            out.append(self.ids.data[_spans(self.ends.data[which], sizes)])
            row = np.searchsorted(bounds, starts + begin, "right") - 1
            counts += np.bincount(row, sizes, len(texts)).astype(np.int64)
            begin = end
        if not len(raw):
            return [np.zeros(0, "<u4")] * len(texts)
        return np.split(np.concatenate(out), np.cumsum(counts)[:-1])


BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each span, one span after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(begins - before, sizes) + np.arange(int(sizes.sum()))


def kept_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: workers serve one task after another, so what one learnt serves the next."""
    encoders = kept("packing")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, size: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and a number ``item`` of its own, for each piece of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(tokenizer_path)
        item = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in slices(whole):
                out: list[tuple] = []
                for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), size)):
                        part = ids[start : start + size]
                        out.append((doc, k, start, len(part), zlib.crc32(part.tobytes()), item))
                        item += 1
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "item"],
                )
        trim()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, item long")


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) for each piece, in the order given.

    Moving a sequence from gap g to g - s changes the sum by (1 - 2 N(g)) + (2 N(g - s) + 1); a new one adds
    2 N(size - s) + 1; full sequences don't count. Ties go to the smallest gap that is left.
    """
    counts = np.zeros(size + 1, dtype=np.int64)  # counts[0] stays 0
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    fill: list[int] = []
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, s in enumerate(lengths):
        s = int(s)
        now = counts[s : size + 1]
        left = counts[: size + 1 - s]
        change = 2 * (left - now) + 2
        change[0] = 1 - 2 * now[0]
        change[now == 0] = np.iinfo(np.int64).max
        change[size - s] = 2 * left[size - s] + 1 if s < size else 0
        to = int(change.argmin())
        if to == size - s:
            b = len(fill)
            fill.append(0)
        else:
            b = open_at[to + s].pop()
            counts[to + s] -= 1
        where[i], offset[i] = b, fill[b]
        fill[b] += s
        if to:
            counts[to] += 1
            open_at[to].append(b)
    return where, offset


def pack(items: DataFrame, size: int = 4096, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``items`` (written rows with item and length) with sequence_id and offset; at most ``size`` tokens a sequence."""
    short = items.where(F.col("length") < size)
    groups = max(1, -(-short.count() // group_pieces))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "item"], ascending=[False, True], kind="stable")
        where, offset = sum_of_squares(rows["length"].to_numpy(), size)
        group = int(rows["_group"].iloc[0])
        return rows.drop(columns="_group").assign(sequence_id=(group << 32) + where, offset=offset)

    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    packed = short.withColumn("_group", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int")).groupBy("_group").applyInPandas(run, schema)
    full = items.where(F.col("length") == size)
    return packed.union(full.select("*", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, size: int = 4096) -> DataFrame:
    """One row per piece of every document of (doc_id, text), with the sequence that holds it."""
    return pack(written(pieces(docs, tokenizer_path, end_id, size), "pieces"), size).drop("item")
