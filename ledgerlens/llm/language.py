"""Language identification by unigram pieces, summed over all segmentations of every word.

Each language has its own probabilities over the pieces of one fixed public vocabulary. The forward algorithm sums the
probability of all ways to cut a word into pieces; a text's score is the sum over its words, so a word is computed
once per task and then looked up. Fitting is expectation-maximisation over the same segmentations.

Defined cases: a text without letters (null, empty, digits only) is ``und`` with score 0; with no labelled text every
prediction is ``und``. Words of over LONG_WORD letters are scored in parts of that length, so all letters count. Ties go
to the first language in order. Repeated rows are predicted one by one. Output columns replace input columns of the
same name; all other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.batches import kept as kept_tables
from ledgerlens.llm.batches import trim
from ledgerlens.operators.ordered import column_quantiles
from ledgerlens.session import written

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
WORD_START = "▁"
LONG_WORD = 40
FLOOR = 1e-9  # of a character that no piece covers
KEPT_WORDS = 150_000  # that a task remembers
COUNTED_WORDS = 100_000  # different words that a task counts before it passes them on
SLICE_ROWS = 500  # of a batch that are worked on and passed on at a time


def vocabulary(path: str) -> list[str]:
    """Lower-case letter pieces of a sentencepiece model; ``path`` is public_tokenizers.path(...)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(t for t in texts if t.removeprefix(WORD_START).isalpha() or t == WORD_START)


def word_counts(text: str | None) -> Counter:
    """Lower-cased letter runs of a text; long ones in parts."""
    counts = Counter(LETTERS.findall(text.lower())) if text else Counter()
    for word in [w for w in counts if len(w) > LONG_WORD]:
        n = counts.pop(word)
        for i in range(0, len(word), LONG_WORD):
            counts[word[i : i + LONG_WORD]] += n
    return counts


class Pieces:
    """The vocabulary, looked up for all substrings of many words at once by their hashes."""

    BASE, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.longest = max(map(len, texts), default=1)
        hashes = np.array([self._hash(t) for t in texts], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[self._slot(self.hashes)] = True

    @classmethod
    def _hash(cls, text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(cls.BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @classmethod
    def _slot(cls, h: np.ndarray) -> np.ndarray:
        return (h * cls.SPREAD) >> np.uint64(44)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, or the number of pieces where there is none."""
        out = np.full(h.shape, len(self.texts), dtype=np.int64)
        likely = np.nonzero(self.filter[self._slot(h)])
        h = h[likely]
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        out[likely] = np.where(self.hashes[at] == h, self.order[at], len(self.texts))
        return out


@dataclass(frozen=True)
class Model:
    """``log_p``-free table of piece probabilities: ``p[piece, language]``."""

    pieces: Pieces
    languages: list[str]
    p: np.ndarray


def lattice(words: list[str], pieces: Pieces) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of the marked words, and for each piece length k the piece at [word, start].

    ``len(texts)`` stands for no piece, ``len(texts) + 1`` for a character that no piece covers.
    """
    marked = [WORD_START + w for w in words]
    lengths = np.array([len(w) for w in marked])
    width = int(lengths.max())
    codes = np.zeros((len(words), width), dtype=np.uint64)
    inside = np.arange(width) < lengths[:, None]
    codes[inside] = np.frombuffer("".join(marked).encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    h = np.zeros_like(codes)
    found = []
    for k in range(1, min(width, pieces.longest) + 1):
        h = h[:, : width - k + 1] * Pieces.BASE + codes[:, k - 1 :]
        ids = pieces.find(h)
        ids[~inside[:, k - 1 :]] = len(pieces.texts)
        if k == 1:
            ids[(ids == len(pieces.texts)) & inside] += 1
        found.append(ids)
    return lengths, found


def _table(p: np.ndarray) -> np.ndarray:
    return np.vstack([p, np.zeros((1, p.shape[1])), np.full((1, p.shape[1]), FLOOR)])


def forward(found: list[np.ndarray], weights: list[np.ndarray], width: int) -> np.ndarray:
    """Summed weights of all ways to cut the first ``place`` characters, for each word and place."""
    n, languages = weights[0].shape[0], weights[0].shape[2]
    alpha = np.zeros((width + 1, n, languages))
    alpha[0] = 1.0
    for end in range(1, width + 1):
        for k in range(1, min(end, len(found)) + 1):
            alpha[end] += alpha[end - k] * weights[k - 1][:, end - k]
    return alpha


def backward(found: list[np.ndarray], weights: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    """Summed weights of all ways to cut what follows a place."""
    n, width = weights[0].shape[0], int(lengths.max())
    beta = np.zeros((width + 1, n, weights[0].shape[2]))
    beta[lengths, np.arange(n)] = 1.0
    for start in range(width - 1, -1, -1):
        for k in range(1, min(width - start, len(found)) + 1):
            beta[start] += beta[start + k] * weights[k - 1][:, start]
    return beta


def score_words(words: list[str], model: Model) -> np.ndarray:
    """log P(word | language), summed over all segmentations; words in order of length waste least."""
    lengths, found = lattice(words, model.pieces)
    table = _table(model.p)
    alpha = forward(found, [table[ids] for ids in found], int(lengths.max()))
    return np.log(np.maximum(alpha[lengths, np.arange(len(words))], 1e-300))


def _expected(pieces: Pieces, p: np.ndarray):
    """For a table (word, l, n): expected uses of each piece per language, of each batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_tables("language")
        table = _table(p)
        languages = p.shape[1]
        total = np.zeros(table.size)
        for all_rows in batches:
            all_rows = all_rows.iloc[np.argsort(all_rows["word"].str.len(), kind="stable")]
            for at in range(0, len(all_rows), 2000):
                rows = all_rows.iloc[at : at + 2000]
                l, words = rows["l"].to_numpy()[:, None], np.arange(len(rows))
                lengths, found = lattice(list(rows["word"]), pieces)
                weights = [table[ids, l][:, :, None] for ids in found]
                alpha = forward(found, weights, int(lengths.max()))[:, :, 0]
                beta = backward(found, weights, lengths)[:, :, 0]
                share = rows["n"].to_numpy() / np.maximum(alpha[lengths, words], 1e-300)
                for k, ids in enumerate(found, 1):
                    places = ids.shape[1]
                    uses = (alpha[:places] * beta[k : k + places] * share).T * weights[k - 1][:, :, 0]
                    total += np.bincount((ids * languages + l).ravel(), uses.ravel(), total.size)
        total = total.reshape(table.shape)[: len(p)]
        piece, l = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "l": l, "uses": total[piece, l]})
        trim()

    return run


def different(labelled: DataFrame) -> DataFrame:
    """(text, lang) of all different labelled texts."""
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang"))
    return rows.where("text IS NOT NULL AND lang IS NOT NULL").distinct()


def sampled(labelled: DataFrame, docs_per_language: int = 1500) -> tuple[list[str], DataFrame]:
    """The languages, and (text, lang) of about ``docs_per_language`` different texts of each, chosen by a hash of the text.

    Copies of a text count once, so this bound holds whatever the table's size. Rows without either are left out.
    """
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    different = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    sizes = {r["lang"]: r["n"] for r in different.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return [], rows
    share = F.create_map(*[F.lit(x) for l in sorted(sizes) for x in (l, min(1.0, docs_per_language / sizes[l]))])
    spread = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return sorted(sizes), rows.where(spread < share[F.col("lang")]).distinct()


def fit(labelled: DataFrame, vocabulary_path: str, docs_per_language: int | None = 1500, rounds: int = 3) -> Model:
    """Fit piece probabilities per language on the sampled texts of columns (text, lang); None: on each row of ``different``.

    What reaches the driver is at most vocabulary x languages numbers.
    """
    pieces = Pieces(vocabulary(vocabulary_path))
    if docs_per_language is None:
        languages, sample = sorted(r["lang"] for r in labelled.select("lang").distinct().collect()), labelled
    else:
        languages, sample = sampled(labelled, docs_per_language)
    if not languages:
        return Model(pieces, [], np.zeros((len(pieces.texts), 0)))
    index = F.create_map(*[F.lit(x) for i, l in enumerate(languages) for x in (l, i)])
    sample = sample.select("text", index[F.col("lang")].alias("l"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_tables("language")
        by: Counter = Counter()

        def told() -> pa.RecordBatch:
            columns = [pa.array([w for w, _ in by], pa.string()), pa.array([l for _, l in by], pa.int32()), pa.array(list(by.values()), pa.int64())]
            by.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "l", "n"])

        for rows in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            for text, l in zip(rows.column("text").to_pylist(), rows.column("l").to_pylist(), strict=True):
                for word, n in word_counts(text).items():
                    by[word, l] += n
                if len(by) > COUNTED_WORDS:
                    yield told()
        yield told()
        trim()

    words = sample.mapInArrow(count, "word string, l int, n long").groupBy("word", "l").agg(F.sum("n").cast("double").alias("n"))
    words = written(words, "words")
    p = np.full((len(pieces.texts), len(languages)), 1.0 / len(pieces.texts))
    for _ in range(rounds):
        uses = words.mapInPandas(_expected(pieces, p), "piece int, l int, uses double")
        p = np.full(p.shape, 0.01)
        for r in uses.groupBy("piece", "l").agg(F.sum("uses").alias("uses")).collect():
            p[r["piece"], r["l"]] += r["uses"]
        p /= p.sum(axis=0)
    return Model(pieces, languages, p)


def least_fit(fits: DataFrame, share: float = 0.01, margin: float = 3.0) -> float:
    """What a text of the model's languages reaches per letter: ``margin`` below what all but a ``share`` of the texts have.

    ``fits``: a column ``fit`` of all labelled texts; the quantile is exact.
    """
    quantiles = column_quantiles(fits, ["fit"], [share]).first()["quantiles"]
    low = quantiles[0] if quantiles else None
    return -math.inf if low is None else low - margin


def identify(
    docs: DataFrame, model: Model, text: str = "text", names: Sequence[str] = ("lang_pred", "score", "n_letters")
) -> DataFrame:
    """``docs`` with lang_pred, score (probability of lang_pred among the languages) and n_letters.

    With a fourth name also the fit: log P(text | lang_pred) per letter, null for ``und``.
    """
    kinds = ((pa.string(), T.StringType()), (pa.float64(), T.DoubleType()), (pa.int64(), T.LongType()), (pa.float64(), T.DoubleType()))
    added = [(pa.field(n, kind), spark_kind) for n, (kind, spark_kind) in zip(names, kinds, strict=False)]
    kept = [c for c in docs.columns if c not in names]
    schema = docs.select(*[f"`{c}`" for c in kept]).schema
    for f, kind in added:
        schema = schema.add(f.name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_tables("language")
        seen: dict[str, int] = {}
        table = np.zeros((0, len(model.languages)))
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            counts = [word_counts(t) for t in batch.column(text).to_pylist()]
            if len(seen) > KEPT_WORDS:
                seen, table = {}, table[:0]
            new = sorted({w for c in counts for w in c if w not in seen}, key=len) if model.languages else []
            parts = [score_words(new[i : i + 2000], model) for i in range(0, len(new), 2000)]
            size = len(seen)
            if size + len(new) > len(table):  # doubled, not copied for each slice
                table = np.concatenate([table[:size], np.zeros((max(size, len(new)), table.shape[1]))])
            for at, part in zip(range(size, size + len(new), 2000), parts, strict=True):
                table[at : at + len(part)] = part
            seen.update(zip(new, range(size, size + len(new)), strict=True))
            labels, scores, letters, fits = [], [], [], []
            for c in counts:
                letters.append(sum(len(w) * n for w, n in c.items()))
                if not c or not model.languages:
                    labels.append(UNKNOWN), scores.append(0.0), fits.append(None)
                    continue
                ll = np.fromiter(c.values(), np.float64, len(c)) @ table[np.fromiter(map(seen.get, c), np.int64, len(c))]
                best = int(ll.argmax())
                labels.append(model.languages[best]), fits.append(ll[best] / letters[-1])
                scores.append(1.0 / sum(math.exp(max(-700.0, x - ll[best])) for x in ll))
            new_columns = [pa.array(x, f.type) for x, (f, _) in zip((labels, scores, letters, fits), added, strict=False)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new_columns], names=[*kept, *[f.name for f, _ in added]])
        del seen, table
        trim()

    return docs.mapInArrow(run, schema)
