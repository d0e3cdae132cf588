"""Periodic runs of words, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q and at least max(shortest, 2 q) words that no neighbouring
word extends keeping period q.

A suffix automaton is built of a stretch of words; its suffix links are a tree in which the prefix that ends at word i is
a path to the root. Words are then appended one after another: the access of a link-cut tree recolours the path of prefix
i with i. The path falls into segments by the colour they had, the end e of the last occurrence of their words, and the
longest of a segment has L words. Where i - e <= L, the words up to i are a square of period i - e, which begins L words
before e; reports of one beginning and period at consecutive words are one run. Each run is reported from its second
period on: its last q words ended last q words ago. Preferred paths are kept on the heavy paths of the finished tree, so
an access takes few steps and recolours O(log n) segments a word, amortised.

Only words that can be in a run get into an automaton: in a run of s words and more, each word lies in a window of s / 2
words that the same run holds twice. Stretches of such words are found by hashes and looked at again until nothing
falls away; equal hashes of other words can only add to them. Words are compared by their bytes.

Words are runs of bytes other than space and 0x09-0x0D. A row is one row's work in one task, without a shuffle. A text's
words are held in memory, about 100 bytes a word, and 700 bytes for each word in a stretch; time is n log n.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; repeated rows are each
judged for themselves; an empty table gives no rows. Extra columns pass through; the columns ``runs``, ``n_words`` and
``collapsed`` replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.batches import by_bytes

SHORTEST = 12  # words of a run at least
SLICE_BYTES = 1 << 20  # of text turned to words at a time; one longer text is a slice of its own
U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
WORDS = r"[^\x20\x09-\x0D]+"


def stretches(ids: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Disjoint (begin, end) that hold every run of ``shortest`` words or more."""
    window = shortest // 2
    n = len(ids)
    if n < shortest:
        return []
    hashes = np.zeros(n - window + 1, dtype=U)
    for k in range(window):
        hashes = (hashes + ids[k : n - window + 1 + k].astype(U) + U(1)) * _STEP
        hashes ^= hashes >> U(29)
    begins, ends = np.array([0]), np.array([n])
    while True:
        # Windows that lie in one stretch, and whose words it holds again.
        of = np.searchsorted(begins, np.arange(len(hashes)), side="right") - 1
        inside = (of >= 0) & (np.arange(len(hashes)) + window <= ends[of])
        at = np.flatnonzero(inside)
        key = hashes[at] ^ (of[at].astype(U) * U(0xBF58476D1CE4E5B9))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        depth = np.zeros(n + 1, dtype=np.int64)
        np.add.at(depth, at[again], 1)
        np.add.at(depth, at[again] + window, -1)
        covered = np.cumsum(depth)[:n] > 0
        edge = np.diff(covered.astype(np.int8), prepend=0, append=0)
        new_begins, new_ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = new_ends - new_begins >= shortest
        new_begins, new_ends = new_begins[long], new_ends[long]
        if len(new_begins) == len(begins) and (new_begins == begins).all() and (new_ends == ends).all():
            return list(zip(begins.tolist(), ends.tolist(), strict=True))
        if not len(new_begins):
            return []
        begins, ends = new_begins, new_ends


def suffix_automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(lengths, suffix links, state of each prefix); state 0 is the root."""
    lengths, links, steps, prefixes = [0], [-1], [{}], []
    last = 0
    for i, c in enumerate(word):
        state = len(lengths)
        lengths.append(i + 1)
        links.append(0)
        steps.append({})
        prefixes.append(state)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = state
            p = links[p]
        if p >= 0:
            q = steps[p][c]
            if lengths[q] != lengths[p] + 1:
                copy = len(lengths)
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                steps.append(steps[q].copy())
                links[q] = copy
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = links[p]
                q = copy
            links[state] = q
        last = state
    return lengths, links, prefixes


def heavy_tops(lengths: list[int], links: list[int]) -> list[int]:
    """The state nearest the root on each state's heavy path."""
    order = np.argsort(np.array(lengths), kind="stable").tolist()  # a link leads to a shorter state
    size, heavy = [1] * len(lengths), [0] * len(lengths)
    for v in reversed(order[1:]):
        size[links[v]] += size[v]
    for v in order[1:]:
        h = heavy[links[v]]
        if not h or size[v] > size[h]:
            heavy[links[v]] = v
    tops = list(range(len(lengths)))
    for v in order[1:]:
        if heavy[links[v]] == v and links[v]:
            tops[v] = tops[links[v]]
    return tops


def runs_of(word: list[int], shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    lengths, links, prefixes = suffix_automaton(word)
    tops = heavy_tops(lengths, links)
    # Per heavy path: (length of the deepest state, last end) of its coloured segments, the one nearest the root last.
    paths: list[list[tuple[int, int]]] = [[] for _ in lengths]
    ends: dict[tuple[int, int], int] = {}
    for i, v in enumerate(prefixes):
        below = -1  # the colour at the top of the path below; a segment that began there has been seen
        while v > 0:
            top, n = tops[v], lengths[v]
            path = paths[top]
            colour = path[-1][1] if path else -1
            while path:
                deepest, e = path[-1]
                common = deepest if deepest < n else n
                if i - e <= common and e != below:
                    ends[e - common + 1, i - e] = i
                if deepest <= n:
                    path.pop()
                if deepest >= n:
                    break
            path.append((n, i))
            below, v = colour, links[top]
    found = [(s, e - s + 1, p) for (s, p), e in ends.items() if e - s + 1 >= shortest]
    return sorted(found, key=lambda r: (r[0], r[2]))


def judged(words: list[bytes], shortest: int = SHORTEST) -> tuple[list[tuple[int, int, int]], list[bytes]]:
    """All runs of a text, and its words without what follows the first period of each."""
    if len(words) < shortest:
        return [], words
    number = dict(zip(words, range(len(words)), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    found = [(a + s, n, q) for a, b in stretches(ids, shortest) for s, n, q in runs_of(ids[a:b].tolist(), shortest)]
    if not found:
        return [], words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
    return found, [words[i] for i in kept]


def collapsed(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period, by start, then period) and the collapsed text."""
    names = ["n_words", "runs", "collapsed"]
    if text in names:
        raise ValueError(f"The text column must not be named {text}")
    kept = [c for c in docs.columns if c not in names]
    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in by_bytes(batch, text, SLICE_BYTES)):
            sizes, found, texts = [], [], []
            for raw in part.column(text).cast(pa.large_binary()).to_pylist():
                words = (raw or b"").split()  # splits at space and 0x09-0x0D
                runs, rest = judged(words, shortest)
                sizes.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(b" ".join(rest))
            columns = {c: part.column(c) for c in kept}
            columns["n_words"] = pa.array(sizes, pa.int64())
            columns["runs"] = pa.array(found, kind)
            columns["collapsed"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length, of those the one with the smallest start, then period; null without runs."""
    sortable = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("q")))
    best = F.array_min(sortable)
    return F.when(F.size(runs) > 0, F.struct(best["s"].alias("start"), (-best["n"]).alias("length"), best["q"].alias("period")))


def run_lines(runs: Column) -> Column:
    """start,length,period and a line feed for each run."""
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
