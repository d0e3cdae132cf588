"""Stacked lookups equal a dictionary, whichever way a column goes."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import encoding
from ledgerlens.operators.lookups import looked_up
from ledgerlens.session import written

WAYS = {
    "maps": {},
    "broadcasts": {"inline": 0},
    "stacked": {"inline": 0, "budget": 0},
    "stacked, split": {"inline": 0, "budget": 0, "task_rows": 20},
    "all": {"inline": 4, "budget": 30},
}


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(1)
    sizes = {"a": 3, "b": 20, "c": 60, "d": 40}
    fitted = {c: {f"{c}'\\{i}": i * 10 for i in range(n)} for c, n in sizes.items()}
    fitted["b"][None] = 7
    texts = {c: [*values, "unseen", "popular unseen"] for c, values in fitted.items()}
    rows = []
    for i in range(400):
        row = {c: "popular unseen" if rng.random() < 0.3 else rng.choice([*texts[c], None]) for c in sizes}
        rows.append((i, *row.values(), "clash"))
    df = spark.createDataFrame(rows, "id int, a string, b string, c string, d string, value string")
    stacked = [(c, v, n) for c, values in fitted.items() for v, n in values.items()]
    table = written(spark.createDataFrame(stacked, "column string, value string, n bigint"), "fitted")
    return df, table, fitted, rows


@pytest.mark.parametrize("way", WAYS)
def test_lookup_equals_dictionary(spark, case, way):
    df, table, fitted, rows = case
    got = looked_up(df, {c: F.col(c) for c in "abcd"}, table, "n", **WAYS[way])
    assert got.columns == [*df.columns, *[f"_found_{c}" for c in "abcd"]]
    want = [(*r, *[fitted[c].get(r[1 + i]) for i, c in enumerate("abcd")]) for r in rows]
    assert [tuple(r) for r in got.orderBy("id").collect()] == want


def test_text_payloads_and_unfitted_columns(spark, case):
    df, table, fitted, rows = case
    levels = table.withColumn("level", F.col("value"))
    for way in WAYS.values():
        got = looked_up(df, {"a": F.col("a"), "x": F.col("value")}, levels, "level", **way).orderBy("id").collect()
        assert [r["_found_a"] for r in got] == [r[1] if r[1] in fitted["a"] else None for r in rows]
        assert all(r["_found_x"] is None for r in got)


def test_rows_of_many_columns_are_shuffled_once(spark):
    names = [f"t{i}" for i in range(64)]
    df = spark.range(300).select("id", F.lit("wide").alias("payload"), *[F.concat(F.lit("v"), (F.col("id") % (i + 2)).cast("string")).alias(c) for i, c in enumerate(names)])
    stacked = df.unpivot(["id"], names, "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    table = written(stacked, "fitted")
    with_broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = looked_up(df, {c: F.col(c) for c in names}, table, "n", inline=0, budget=0)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert got.where(" AND ".join(f"_found_{c} IS NOT NULL" for c in names)).count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_broadcast)
    # The rows once, their cells once to meet the table and once to be put together, the table once.
    assert plan.count("Exchange hashpartitioning") <= 4 and plan.count("SortMergeJoin") <= 2
    few = looked_up(df, {c: F.col(c) for c in names[:8]}, table, "n")
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()


def test_vocabularies_and_counts_on_both_sides_of_the_limits(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, rng.choice(["x", "y", None, "rare"]), rng.choice([None, *"abcdefgh"])) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, p string, q string")
    fitted = df.where("id < 60")
    vocabulary = written(encoding.category_vocab_fit(fitted.where("p <> 'rare'"), ["p", "q"]), "vocabulary")
    counts = written(encoding.frequency_fit(fitted, ["p", "q"]), "counts")
    plain = None
    for inline, budget, task_rows in [(64, 400_000, 1_000_000), (0, 400_000, 1_000_000), (0, 0, 1_000_000), (0, 0, 10)]:
        monkeypatch.setattr(looked_up, "__kwdefaults__", {**looked_up.__kwdefaults__, "inline": inline, "budget": budget})
        filled = encoding.categorical_fill(df, ["p", "q", "absent"], vocabulary, task_rows=task_rows).orderBy("id").collect()
        coded = encoding.frequency_encode(df, counts, ["p", "q"], task_rows=task_rows).orderBy("id").collect()
        plain = plain or (filled, coded)
        assert (filled, coded) == plain
    by_id = {r["id"]: r for r in plain[0]}
    assert {r[1]: by_id[r[0]]["p"] for r in rows} == {"x": "x", "y": "y", None: "__MISSING__", "rare": "__UNKNOWN__"}
    assert all(r["absent"] == "__MISSING__" for r in plain[0])
    n = {v: sum(r[1] == v for r in rows[:60]) for v in ("x", "y", None, "rare")}
    assert all(r["p_freq"] == n[r["p"]] for r in plain[1])
