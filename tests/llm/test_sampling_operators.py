"""Shards, importance resampling and periodic runs against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import queries, ranks, resampling, runs, sharding
from ledgerlens.session import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", "   \n", "x", "word " * 3000, "a b " * 40, "naïve É \x1c\x0btail 中文 中文", "word " * 3000, "x", "A-b_c 12\x7f3"]


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# Places in a global order


def test_positions_split_a_hot_value(spark):
    rows = written(spark.range(5000).selectExpr("id % 3 AS v", "id"), "rows")
    got = ranks.positions(rows, [F.desc("v"), F.col("id")]).collect()
    want = sorted(((i % 3, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(5000))


# Shards


def plain_shards(rows, shards, seed=11):
    """rows: (doc_id, text, source) -> {index: (shard, slot)}."""

    def h(value, digits):
        return int(hashlib.sha256(f"{seed}:{value}".encode()).hexdigest()[:digits], 16)

    strata = defaultdict(list)
    for i, (doc, _, source) in enumerate(rows):
        strata["" if source is None else f"={source}"].append((h("" if doc is None else doc, 15), i))
    placed = []
    for name, members in strata.items():
        u = h(name, 8) / 2**32
        placed += [((r + u) / len(members), name, r, i) for r, (_, i) in enumerate(sorted(members))]
    cuts = [k * len(rows) // shards for k in range(shards + 1)]
    order = [i for *_, i in sorted(placed)]
    return {order[p]: (k, p - cuts[k]) for k in range(shards) for p in range(cuts[k], cuts[k + 1])}


def test_shards_equal_plain_version(spark):
    rng = random.Random(3)
    sources = [rng.choices(["big", "mid", None, "", f"one{i}"], [50, 20, 10, 5, 5])[0] for i in range(700)]
    texts = [rng.choice([None, "", "ä" * (i % 7), f"text {i}"]) for i in range(700)]
    docs = documents(spark, texts, sources).withColumns({c: F.lit("clash") for c in ("_stratum", "_h", "shard", "_at", "position")})
    got = {r.doc_id: r for r in sharding.interleaved(docs, 24).collect()}
    want = plain_shards([(i, t, s) for i, (t, s) in enumerate(zip(texts, sources, strict=True))], 24)
    assert {i: (r.shard, r.slot) for i, r in got.items()} == want
    for i, r in got.items():
        raw = (texts[i] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    # Every shard has each source in its share.
    mix = Counter((r.shard, sources[i]) for i, r in got.items())
    for name, n in Counter(sources).items():
        assert all(abs(mix[k, name] - n / 24) <= 3 for k in range(24)), name


def test_shards_of_repeated_rows_few_rows_and_none(spark):
    same = spark.createDataFrame([(1, "t", "a")] * 50 + [(None, None, None)] * 3, "doc_id long, text string, source string")
    got = sharding.interleaved(same, 7).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == 53 and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == k) == list(range(n)) for k, n in counts.items())
    few = sharding.interleaved(same.limit(3), 24).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}
    assert sharding.interleaved(same.where("false"), 24).count() == 0


def test_written_shards_hold_all_columns_in_order(spark, tmp_path):
    docs = documents(spark, [f"t{i}" for i in range(300)], [f"s{i % 3}" for i in range(300)]).withColumn("slot", F.lit("old"))
    got = sharding.sharded(docs, str(tmp_path / "shards"), 5)
    assert set(got.columns) == {"doc_id", "text", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot"}
    want = {r.doc_id: (r.shard, r.slot) for r in sharding.interleaved(docs, 5).collect()}
    rows = got.collect()
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == want and all(r.text == f"t{r.doc_id}" for r in rows)
    for folder in (tmp_path / "shards").glob("shard=*"):
        for file in folder.glob("*.parquet"):
            slots = [r.slot for r in spark.read.parquet(str(file)).collect()]
            assert slots == sorted(slots) and slots[-1] - slots[0] == len(slots) - 1


# Importance resampling


def test_crc_of_spans():
    rng = random.Random(1)
    raw = np.frombuffer(rng.randbytes(9000), dtype=np.uint8)
    starts = [rng.randrange(8999) for _ in range(2000)] + [0, 5]
    ends = [min(9000, a + 1 + int(rng.expovariate(1 / 90))) for a in starts[:-2]] + [9000, 5 + 4 * resampling.BLOCK]
    got = resampling.crc_spans(raw, np.array(starts), np.array(ends)).tolist()
    assert got == [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert len(resampling.crc_spans(raw, np.zeros(0, int), np.zeros(0, int))) == 0


def plain_features(text, longest):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_word_runs(longest):
    texts = [*ODD, "ends", "begins", "中" * 3000, "é" * 700 + " tail"]
    raw, starts, ends, row = resampling.word_runs(pa.array(texts).slice(1), longest)
    got = defaultdict(list)
    for a, b, r in zip(starts, ends, row, strict=True):
        got[int(r) + 1].append(raw[a:b].tobytes().decode())
    for i, text in enumerate(texts[1:], 1):
        words, features = plain_features(text, longest)
        assert sorted(got[i]) == sorted(features)
        assert resampling._words(np.array([len(features)]), longest)[0] == len(words)


def plain_resampling(docs, target, longest=1, buckets=10_000, percent=10):
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t, longest)[1])

    s, t = count(x for _, x in docs), count(target)
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out, able = {}, []
    for doc, text in docs:
        words, features = plain_features(text, longest)
        gains = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in (zlib.crc32(f.encode()) % buckets for f in features)]
        weight = sum(gains) // max(1, len(gains))
        h = int(hashlib.sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc] = [len(features), weight, score, None]
        if len(words) >= 20:
            able.append((-score, doc))
    for i, (_, doc) in enumerate(sorted(able)[: percent * len(able) // 100]):
        out[doc][3] = i + 1
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_equals_plain_version(spark, longest):
    rng = random.Random(5)
    texts = ODD + [" ".join(rng.choice("red Green blue éa x9 Sun".split()) for _ in range(rng.randrange(60))) for _ in range(300)]
    target = ["green green sun", None, "unseen éa"]
    docs = documents(spark, texts).withColumns({c: F.lit("clash") for c in ("score", "rank", "_row", "n_words", "position")})
    got = resampling.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=30, longest=longest)
    want = plain_resampling(list(enumerate(texts)), target, longest, percent=30)
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()} == want


def test_resampling_of_repeated_rows_and_empty_tables(spark):
    text = "one two three " * 10
    docs = spark.createDataFrame([(7, text)] * 20 + [(None, text)], "doc_id long, text string")
    target = spark.createDataFrame([("one",)], "text string")
    got = resampling.resampled(docs, target).collect()
    assert len(got) == 21 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2]
    assert resampling.resampled(docs.where("false"), target).count() == 0
    assert resampling.resampled(docs, target.where("false")).count() == 21


# Periodic runs


def plain_runs(words, shortest=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("shortest", [2, 4, 12])
def test_runs_equal_plain_version(shortest):
    rng = random.Random(shortest)
    for _ in range(600):
        n, k = rng.randrange(90), rng.choice([1, 2, 2, 3, 5])
        words = [b"%d" % rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange(n - a)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found, kept = runs.judged(words, shortest)
        want = plain_runs(words, shortest)
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert found == want
        assert kept == [w for i, w in enumerate(words) if i not in gone]


def test_runs_of_fibonacci_words_and_long_texts():
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < 600:
        a, b = b, b + a
    assert runs.judged(b)[0] == plain_runs(b)
    assert runs.judged([b"w"] * 200_000)[0] == [(0, 200_000, 1)]
    period = [b"%d" % i for i in range(40_000)]
    assert runs.judged(period * 3 + [b"1"])[0] == [(0, 120_000, 40_000)]


def test_collapsed_documents(spark):
    texts = [*ODD, "a b c d e f a b c d e f a b c", "x " * 11, "x " * 12]
    docs = documents(spark, texts).withColumn("runs", F.lit("clash")).withColumn("part", F.lit(1))
    got = {r.doc_id: r for r in runs.collapsed(docs).collect()}
    assert len(got) == len(texts) and set(got[0].asDict()) == {*docs.columns, "n_words", "collapsed"}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want = plain_runs(words)
        gone = {j for s, n, q in want for j in range(s + q, s + n)}
        assert [tuple(r) for r in got[i].runs] == want and got[i].n_words == len(words)
        assert got[i].collapsed == " ".join(w for j, w in enumerate(words) if j not in gone)
    assert runs.collapsed(docs.where("false")).count() == 0
    best = runs.collapsed(docs).select("doc_id", runs.longest_run(F.col("runs")).alias("b"), runs.run_lines(F.col("runs")).alias("l"))
    lines = {r.doc_id: (r.b, r.l) for r in best.collect()}
    assert lines[0] == (None, "") and tuple(lines[10][0]) == (0, 15, 6) and lines[10][1] == "0,15,6\n"


def test_planted_periods(spark):
    texts = [None, "", "one", *[" ".join(f"w{j % 50}\x0b" for j in range(30 + i)) for i in range(60)]]
    got = {r.doc_id: r.text for r in queries.with_periods(documents(spark, texts)).collect()}
    for doc, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert re.findall(r"[^\x20\x09-\x0D]+", got[doc] or "") == words
