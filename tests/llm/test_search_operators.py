"""Jaccard join, substring dedup, embeddings, top-k and URL filters against plain versions."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import graph, jaccard, pq, queries, substrings, topk, urls

SF = "/root/testdata/sf0.001"


def plain_components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def edited(rng, text, share):
    return [f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text]


def corpus(seed=5):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "one", "One  two", "one two", "a b c d e", "A B C\x0bD E"]
    base = [words(rng, rng.randrange(5, 200)) for _ in range(40)]
    passage = words(rng, 60)
    for b in base:
        texts += [" ".join(b)] * rng.choice([1, 1, 2, 3])
        texts += [" ".join(edited(rng, b, rng.choice([0.005, 0.02, 0.05]))) for _ in range(rng.randrange(4))]
        texts.append(" ".join(b[: len(b) // 2] + passage + b[len(b) // 2 :]))
    hot = words(rng, 150)
    texts += [" ".join(edited(rng, hot, 0.02)) for _ in range(120)]
    texts += [" ".join(words(rng, 1) * 300), " ".join(["again and"] * 200), " ".join(words(rng, 30_000, 5000))]
    rng.shuffle(texts)
    return texts


def table(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs.withColumn("n", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("token", F.lit(1)).repartition(5)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = plain_components({x for l in links for x in l}, links)
    assert {n: got.get(n, n) for n in want} == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


# N-gram Jaccard


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("common", [4, 10**9])
def test_jaccard_components(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    texts = corpus()
    sets = [shingles(t) for t in texts]
    links = []
    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                links.append((i, j))
    want = plain_components(range(len(texts)), links)
    rows = jaccard.similarity_components(table(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(sets[i]), want[i]) for i in range(len(texts))}
    assert len(rows) == len(texts)


def python_nodes_of_a_task(df):
    """The most Python nodes one above the other without an exchange between them."""
    most, path = 0, []
    for line in df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines():
        node = line.lstrip(" :+-*")
        depth, name = len(line) - len(node), node.split(" ")[0]
        path = [(d, n) for d, n in path if d < depth]
        above = path[-1][1] if path else 0
        path.append((depth, 0 if "Exchange" in name else above + ("MapInArrow" in line)))
        most = max(most, path[-1][1])
    return most


def test_jaccard_tasks_have_one_python_worker(spark, monkeypatch):
    """An executor keeps as many workers as its tasks ever had at once: two to a task took 4 x 60 to 180 MB of it."""
    docs = table(spark, ["a b c d e f g"] * 9 + ["a b c d e f h", "x y z"])
    pairs = spark.createDataFrame([(0, 1), (0, 9)], "a long, b long")
    both = jaccard.linked(pairs, docs, 50, 5)
    assert python_nodes_of_a_task(both) == 1
    assert sorted(tuple(r) for r in both.collect()) == [(0, 1), (0, 9)]
    frames, named = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name, *a: frames.append(df) or named(df, name, *a))
    jaccard.similarity_components(docs).collect()
    assert len(frames) > 8 and max(map(python_nodes_of_a_task, frames)) == 1


def rows_of_joins(df):
    """The most rows that a join of a plan puts out."""
    df.collect()
    most, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.nodeName()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
        left += [node.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [node.plan()] if "QueryStage" in name else []
        if "Join" in name:
            most = max(most, node.metrics().apply("numOutputRows").value())
    return most


def test_jaccard_frequent_passage_pairs_few_leaves(spark, monkeypatch):
    """Documents that share a passage, but too little of themselves to link, are not paired once for each of its tokens."""
    passage = " ".join(f"p{i}" for i in range(86))
    texts = [passage + "".join(f" d{i}w{j}" for j in range(18)) for i in range(60)]
    frames, named = {}, jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name, *a: frames.setdefault(name, df) and named(df, name, *a))
    rows = jaccard.similarity_components(table(spark, texts)).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(i, i) for i in range(60)]
    assert rows_of_joins(frames["leaf-pairs"]) < 60 * 59 / 2


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_leaf_candidates_lose_no_link(spark, percent):
    rng = random.Random(percent)
    base = [rng.sample(range(200), 60) for _ in range(4)]
    docs = [sorted({t if rng.random() > (100 - percent) / 300 else rng.randrange(200) for t in rng.choice(base)}) for _ in range(120)]
    docs = [d[rng.randrange(12) :] for d in docs]  # sorted: the order of tokens
    leaf = [i // 2 if i < 40 else i for i in range(120)]
    entries, want = {}, set()
    for i, d in enumerate(docs):
        for at, t in enumerate(d[: len(d) + -percent * len(d) // 100 + 1]):
            lo, hi, rest = entries.get((t, leaf[i]), (len(d), len(d), 0))
            entries[t, leaf[i]] = min(lo, len(d)), max(hi, len(d)), max(rest, len(d) - at)
        for j in range(i):
            shared = len(set(d) & set(docs[j]))
            if leaf[i] % 10 != leaf[j] % 10 and 100 * shared >= percent * (len(d) + len(docs[j]) - shared):
                want.add((leaf[j], leaf[i]))
    rows = [(t, x, x % 10, *v) for (t, x), v in entries.items()]
    table_of = spark.createDataFrame(rows, "token long, leaf long, c long, lo long, hi long, rest long")
    got = [tuple(r) for r in jaccard.leaf_candidates(table_of, percent).collect()]
    assert len(want) > 20 and want <= set(got) and len(got) == len(set(got))


def test_jaccard_of_no_rows_and_null_ids(spark):
    assert jaccard.similarity_components(table(spark, ["a"]).where("false")).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.component_id or -1) for r in jaccard.similarity_components(rows).collect())
    assert got == [(-1, -1), (3, 3), (3, 3)]


def test_tokens_are_ordered_by_counts_over_all_documents(spark, monkeypatch):
    # Before, counts came from SAMPLES token occurrences.
    monkeypatch.setattr(jaccard, "SAMPLES", 1, raising=False)
    monkeypatch.setattr(jaccard, "COUNTED", 64)
    rng = random.Random(4)
    lines = [words(rng, 5, 10**6) for _ in range(40)]
    texts = [" ".join(w for line in rng.sample(lines, 1 + i % 20) for w in line) for i in range(300)]
    sets = jaccard.shingle_sets(pa.array(texts), 5)
    count = Counter(t for x in sets for t in x.tolist())
    levels, bits = jaccard.token_levels(table(spark, texts), sum(map(len, sets)), 5)
    tokens = np.array(list(count), np.uint64)
    want = [max(0, int(np.log2(n / jaccard.COMMON)) + 1) if n >= jaccard.COMMON else 0 for n in count.values()]
    got = jaccard.levels_of(tokens, levels, bits)
    assert np.mean(got == want) > 0.9 and (got >= want).all()  # places are shared by a few
    assert max(want) >= 5
    counted, bits = jaccard.token_counts(table(spark, texts), sum(map(len, sets)), 5)
    cells = Counter()
    for token, n in count.items():
        cells[token >> (64 - bits)] += n
    rows = counted.collect()
    assert {r.cell: r.n for r in rows} == {c: n for c, n in cells.items() if n >= jaccard.COMMON} and len(rows) > 30


def test_near_copies_are_pruned_within_a_group(spark, monkeypatch):
    # Before, a document beside a group of near copies met each of them as a row of its own.
    base = [f"w{i}" for i in range(150)]

    def changed(seed, edits):
        rng = random.Random(seed)
        out = list(base)
        for i in rng.sample(range(150), edits):
            out[i] = f"e{seed}-{i}"
        return " ".join(out)

    texts = [changed(i, 1) for i in range(60)] + [changed(1000 + i, 12) for i in range(20)]
    rows, named = [], jaccard.written

    def written(df, name, *more):
        out = named(df, name, *more)
        if name == "document-pairs":
            rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", written)
    got = {r.doc_id: r.component_id for r in jaccard.similarity_components(table(spark, texts)).collect()}
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(80) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert got == plain_components(range(80), links)
    assert rows[0] < 60 * 20 / 4


def test_overlap_bound_never_drops_a_link(spark):
    rng = random.Random(9)
    base = words(rng, 900, 10**6)
    a = np.unique(np.array([hash(w) & (2**63 - 1) for w in base], dtype=np.uint64))
    for share in (0.0, 0.05, 0.14, 0.3, 0.9):
        b = a[: int((1 - share) * len(a))] if share > 0.5 else np.unique(np.concatenate([a[int(share * len(a)) :], np.arange(1, int(share * len(a)) + 1, dtype=np.uint64)]))
        (x, hx), (y, hy) = jaccard.bitmap_of(a), jaccard.bitmap_of(b)
        size = min(len(x), len(y))
        u, v = (jaccard._folded(np.frombuffer(z, np.uint64)[None], size) for z in (x, y))
        shared = int(np.bitwise_count(u & v).sum())
        assert shared + min(h for h, z in ((hx, x), (hy, y)) if len(z) == size) >= len(np.intersect1d(a, b))


# Repeated substrings


def plain_removal(texts, k):
    all_words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + k]) for w in all_words for i in range(len(w) - k + 1))
    out = []
    for w in all_words:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if count[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_windows_are_removed(spark):
    texts = corpus(6)
    rows = substrings.remove_repeats(table(spark, texts)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == dict(enumerate(plain_removal(texts, 35)))
    assert len(rows) == len(texts)


def test_repeats_in_one_text_and_no_rows(spark):
    rng = random.Random(1)
    run = words(rng, 36)
    texts = [" ".join([*run, "mid", *run]), " ".join(words(rng, 34)), None]
    rows = sorted(substrings.remove_repeats(table(spark, texts)).collect())
    assert [(r.n_words, r.n_removed) for r in rows] == [(73, 72), (34, 0), (0, 0)]
    assert rows[0].kept_text == "mid"
    assert substrings.remove_repeats(table(spark, texts).where("false")).collect() == []


# Embeddings


def plain_near(rows, threshold=0.93):
    ok = {}
    for i, v, label in rows:
        good = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if good:
            ok.setdefault(i, []).append((label, np.array(v, dtype=np.float32).astype(float)))
    flat = [(i, label, v) for i, x in ok.items() for label, v in x]
    links = set()
    for a in range(len(flat)):
        for b in range(a):
            (i, l, v), (j, m, w) = flat[a], flat[b]
            if i != j and l == m and len(v) == len(w) and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= threshold:
                links.add((max(i, j), min(i, j)))
    named = plain_components({i for i, _, _ in rows}, links)
    degree = Counter(x for l in links for x in l)
    return {i: (degree[i], named[i], named[i] == i) for i, _, _ in rows}


def vectors():
    rng = np.random.default_rng(4)
    rows, centers = [], rng.normal(size=(12, 16))
    for i in range(400):
        v = centers[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.25, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3)))
    same = rows[0][1]
    rows += [(400 + i, same, 0) for i in range(60)] + [(460, same, 1), (461, [2 * x for x in same], 0)]
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, same, None), (504, [None, *same[1:]], 0)]
    rows += [(505, [float("inf"), *same[1:]], 0), (506, same[:5], 0), (507, [-0.0, *same[1:5]], 0), (508, [], 0), (509, same[:5], 0)]
    return rows


def test_near_vectors(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("v", F.lit("clash")).withColumn("home", F.lit(1))
    got = pq.near_duplicates(df.repartition(4), deviations=None).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == plain_near(rows)
    assert len(got) == len(rows)
    assert pq.near_duplicates(df.where("false")).collect() == []


def test_recall_of_near_vectors(spark):
    """The production search against brute force on all vectors of a table."""
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = plain_near(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op7_embedding_near_dedup(spark, SF).collect()}
    found, there = (sum(v[0] for v in x.values()) for x in (got, want))
    assert 0.99 * there <= found <= there and set(got) == set(want)


def test_vectors_are_not_broadcast(spark, monkeypatch):
    """The planner takes blocks of vectors, and what was exploded, for small, and links for as small as their file."""
    plans, write = {}, pq.written

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(pq, "written", planned)
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>, label int")
    plans["out"] = pq.near_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    assert [plans[x].count("SortMergeJoin") for x in ("near", "out")] == [3, 4]
    assert not [x for x, plan in plans.items() if "Broadcast" in plan]
    assert plans["near"].count("Generate explode") == 2  # once for the rows and once for their count
    assert plans["near"].count("Exchange") == 4  # of the rows and counts of lists and of queries, and of nothing again
    assert "TakeOrderedAndProject" in plans["fitted"]  # in tasks: the driver gets the chosen rows only


def test_near_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(pq, "BLOCK", 7)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = pq.near_duplicates(df.repartition(4), deviations=None).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == plain_near(rows)


def plain_top(rows, k=5):
    ok = [(i, [int(np.floor(256.0 * np.float64(np.float32(x)))) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("rank", [3, 6, 256])
def test_recall_of_vectors_that_fill_few_directions(spark, rank):
    rng = np.random.default_rng(rank)
    x = rng.normal(size=(2500, rank)) @ (rng.normal(size=(rank, 256)) if rank < 256 else np.eye(256))
    if rank == 256:
        x = x[rng.integers(0, 200, 2500)] + 0.25 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    docs = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in pq.near_duplicates(docs).collect()}
    links = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert all(got[i] <= n for i, n in enumerate(links.tolist()))
    assert links.sum() > 500 and sum(got.values()) >= 0.99 * links.sum()


def test_top_k(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("clash")).repartition(4)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain_top(rows)
    few = topk.top_k(df.where("vec_id IN (0, 1, 2)"), F.col("vec_id") % 50 == 0).collect()
    assert len(few) == 2
    assert topk.top_k(df.where("false"), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain_top(rows)


def test_top_k_of_repeated_query_ids(spark):
    """Ten rows of a query's own id lie side by side and score highest; they take no other row's place."""
    rng = np.random.default_rng(11)
    once = [(i, rng.normal(size=6).astype("float32").astype(float).tolist(), 0) for i in range(1, 120)]
    hot = [(0, [9.0] * 6, 0), (0, [8.0] * 6, 0), (150, [-7.0] * 6, 0)]
    rows = once + [r for r in hot for _ in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v, _ in rows]
    want = []
    for q in (0, 50, 100, 150):
        vectors_of = {tuple(v) for i, v in whole if i == q}
        scores = sorted((-int(np.dot(a, v)), i) for a in vectors_of for i, v in whole if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


# URLs


def judge(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    out = urls.judged(pages, queries.URL_RULES)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}


def test_rules(spark):
    got = judge(
        spark,
        [
            (1, "http://WWW.Example.com/en/a?x#y", ""),
            (2, "https://m.example.com/en/", None),
            (3, "http://example.com/de", None),
            (4, "http://a.net/es/1", None),
            (5, "http://notexample.com/en/", None),
            (6, "http://com/en/", None),
            (7, "http://x.org", None),
            (8, None, None),
            (9, "no scheme", None),
            (10, "http://a.com?/en/", None),
            (11, "ftp://a.net#/es/", None),
            (12, "http://É.Net/fr/://x", None),
            (13, "", ""),
        ],
    )
    assert got == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        2: ("m.example.com", "/en/", "example.com/en/", "block"),
        3: ("example.com", "/de", "com/", "allow"),
        4: ("a.net", "/es/1", "net/es/", "block"),
        5: ("notexample.com", "/en/", "com/", "allow"),
        6: ("com", "/en/", "com/", "allow"),
        7: ("x.org", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("a.com", "", None, "allow"),
        11: ("a.net", "", None, "allow"),
        12: ("É.net", "/fr/://x", "net/fr/", "block"),
        13: ("", "", None, "allow"),
    }


def test_blocks_reach_aliases(spark):
    canonical = "<html><LINK href='//b.net/es/9' rel=\"canonical\"></html>"
    refresh = '<meta http-equiv="refresh" content="0; url=/two">'
    got = judge(
        spark,
        [
            (1, "https://x.org/one", refresh),  # x.org/two
            (2, "http://x.org/two/?utm_source=feed#top", canonical),  # b.net/es/9
            (3, "http://y.org/r?url=http%3A%2F%2Fx.org%2Ftwo", None),
            (4, "http://www.example.com/en/k", "<link rel=canonical href=http://b.net/es/9>"),  # its own rule stands
            (5, "http://z.org/", None),
            (6, "http://x.org/two", None),
        ],
    )
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block"}


def test_unclosed_tags_take_linear_time(spark):
    import time

    pages = [(i, "http://a.example/", tag * (1_000_000 // len(tag))) for i, tag in enumerate(["<link ", "<meta ", "<link rel=canonical "])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    urls.links_of(df.limit(0)).collect()
    begun = time.time()
    assert urls.links_of(df).collect() == []
    assert time.time() - begun < 20


def test_urls_of_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judged(pages, queries.URL_RULES).collect() == []


# The pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.dtypes == docs.dtypes
            rows = after.collect()
            docs = spark.createDataFrame(rows, docs.schema)
            if name == "ngram_jaccard":
                sets = Counter(frozenset(shingles(r.text)) for r in rows)
                assert max(sets.values()) == 1 and len({r.doc_id for r in rows}) == len(rows)
            if name == "language_id":
                assert len(rows) > 0.95 * clean
    by = defaultdict(int)
    for r in after.collect():
        by[r.sequence_id] += r.length
    assert max(by.values()) <= 4096


def test_pipeline_of_odd_rows(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, score string"
    rows = [(i, t, "en", None, 1, "s", "x") for i, t in enumerate(["a b c d e f", "a b c d e f", None, "", "12 34", "password=abcdefgh12 held by the cat"])]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.dtypes == spark.createDataFrame([], schema).dtypes
        docs = spark.createDataFrame(docs.collect(), schema)
    assert sorted(r.text for r in docs.collect()) == ["[assign] held by the cat", "a b c d e f"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), "").collect() == []


def test_rows_that_share_an_id_are_kept_unless_their_texts_link(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, row string"
    texts = [(2, "a b c d e f"), (2, "u v w x y z"), (1, "u v w x y z"), (3, "k l m n o p"), (3, "k l m n o p"), (4, ""), (None, "a b c d e f")]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame([(*t, "r") for t in texts], schema).repartition(3), "")
    want = [(1, "u v w x y z"), (2, "a b c d e f"), (3, "k l m n o p"), (4, "")]
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == ["doc_id", "text", "row"]
    assert sorted(r for r in rows if r[0]) == want and len(rows) == len(want) + 1


def test_functions_travel_without_the_package():
    from pyspark import cloudpickle

    assert "ledgerlens.llm" in cloudpickle.list_registry_pickle_by_value()
    assert os.path.exists(os.path.join(os.path.dirname(jaccard.__file__), "__init__.py"))
