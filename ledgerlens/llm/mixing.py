"""Mixing sources by temperature, with DataFrame functions only.

A source with share q of all tokens gets the weight q**a / sum(q**a). The exponent a is found by bisection: the one
whose mix has the target entropy, or the flattest mix in which no source repeats more often than allowed. A budget of
tokens times the weight is a source's quota: whole passes over it, and a last pass that is cut where the quota ends.

Every pass is a permutation in blocks: documents fall into BLOCKS blocks by a hash, blocks are ordered by a hash of
(seed, pass, block) and documents within a block by another. The last pass takes the blocks before the cut, found
level by level: block totals, then those of the parts of the one block that holds the cut, and so on. So a window sees
at most BLOCKS rows of a source, however large the source.

Defined cases: null sources are one source; null and empty texts have no tokens and come with every pass and with the
part of the last pass that is taken; a source without tokens has weight 0 and gets no pass; rows with one doc_id stand
or fall together; a document that would overshoot the quota is left out; an empty table gives no rows. All columns pass
through; output columns replace input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import written

BITS = 10  # of the hash that a level of blocks uses
BLOCKS = 1 << BITS
LEVELS = 3  # the last one looks at single hashes, of one block in BLOCKS**2
STEPS = 31  # exponents tried in one aggregate: five halvings of the interval
WORDS = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def source_totals(docs: DataFrame, tokens: Column, source: str = "source") -> DataFrame:
    return docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("docs"), F.sum(tokens).alias("tokens"))


def _measures(shares: DataFrame, exponents: list[float], scale: float) -> list[tuple[float, float]]:
    """(entropy, most repeats) of the mix at each exponent; one row reaches the driver."""
    q = F.col("share")
    columns = []
    for i, a in enumerate(exponents):
        columns += [
            F.sum(F.pow(q, F.lit(a))).alias(f"z{i}"),
            F.sum(F.pow(q, F.lit(a)) * F.log(q)).alias(f"l{i}"),
            F.max(F.pow(q, F.lit(a - 1.0))).alias(f"m{i}"),
        ]
    row = shares.agg(*columns).first()
    return [
        (math.log(row[f"z{i}"]) - a * row[f"l{i}"] / row[f"z{i}"], scale * row[f"m{i}"] / row[f"z{i}"])
        for i, a in enumerate(exponents)
    ]


def find_exponent(shares: DataFrame, scale: float, entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The exponent with the target entropy (nats), or the least one that keeps to the repetition limit.

    ``shares``: column share, each over 0; ``scale``: budget over all tokens. Entropy falls from exponent 0 on, and so
    do the repeats up to 1, the natural mix. Where no exponent meets the target, the nearest end is taken.
    """
    low, high = 0.0, 1.0 if entropy is None else 8.0
    for _ in range(6):
        tried = [low + (high - low) * (i + 1) / (STEPS + 1) for i in range(STEPS)]
        enough = [(h <= entropy) if entropy is not None else (r <= max_repeats) for h, r in _measures(shares, tried, scale)]
        first = enough.index(True) if True in enough else STEPS
        low, high = [low, *tried, high][first : first + 2]
    return high


def _place(seed: int) -> Column:
    """A document's place in the order of blocks, as a hash of 60 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("cut"), F.col("doc_id")), 4)


def _free(taken: list[str], *names: str) -> list[str]:
    """The names, each lengthened until no column has it."""
    low = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in low:
            name = f"_{name}"
        low.add(name.lower())
        out.append(name)
    return out


def mixed(
    docs: DataFrame,
    budget: float | None = None,
    entropy: float | None = None,
    max_repeats: float | None = None,
    seed: int = 17,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row for each document and each pass that takes it, with pass_no, block_order and doc_order.

    ``budget``: tokens of the mix, as many as the input's when None. Sorting a pass by (block_order, doc_order) gives
    its permutation.
    """
    if (entropy is None) == (max_repeats is None):
        raise ValueError("Give either a target entropy or a repetition limit")
    slim = docs.select(F.col(source).alias("_source"), _place(seed).alias("_u"), token_count(F.col(text)).alias("_tokens"))
    slim = written(slim, "mix-places")
    totals = written(source_totals(slim, F.col("_tokens"), "_source"), "mix-sources").where("tokens > 0")
    all_tokens = totals.agg(F.sum("tokens")).first()[0]
    names = ["pass_no", "block_order", "doc_order"]
    kept = [c for c in docs.columns if c not in names]
    if not all_tokens:
        empty = docs.select(*[f"`{c}`" for c in kept], F.lit(0).alias("pass_no"), F.lit(0).cast("bigint").alias("block_order"))
        return empty.withColumn("doc_order", F.col("block_order")).where(F.lit(False))
    budget = float(all_tokens if budget is None else budget)
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(all_tokens)))
    a = find_exponent(shares, budget / all_tokens, entropy, max_repeats)
    z = shares.agg(F.sum(F.pow("share", F.lit(a)))).first()[0]
    quota = F.floor(F.lit(budget) * F.pow("share", F.lit(a)) / F.lit(z)).cast("bigint")
    plan = shares.select(F.col("source").alias("_s"), "tokens", quota.alias("quota"))
    plan = plan.withColumn("passes", F.floor(F.col("quota") / F.col("tokens")).cast("int"))
    plan = plan.withColumn("rest", F.col("quota") - F.col("passes") * F.col("tokens")).withColumn("cut", F.lit(0).cast("bigint"))
    plan = written(plan.select("_s", "passes", "rest", "cut"), "mix-plan")
    same = F.col("_source").eqNullSafe(F.col("_s"))
    for level in range(1, LEVELS + 1):
        # ``cut``: all places below are taken, ``rest`` tokens are left for the block that begins there.
        width = 0 if level == LEVELS else 60 - BITS * level
        inside = F.col("_u") < F.col("cut") + F.lit(1 << (60 - BITS * (level - 1)))
        rows = slim.join(plan, same).where((F.col("_u") >= F.col("cut")) & inside)
        part = F.shiftleft(F.shiftright("_u", width), width)
        sums = rows.groupBy("_s", "passes", "rest", "cut", part.alias("part")).agg(F.sum("_tokens").alias("n"))
        order = Window.partitionBy("_s").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = sums.withColumn("upto", F.sum("n").over(order))
        over = F.col("upto") > F.col("rest")
        step = run.groupBy("_s").agg(
            F.min(F.when(over, F.col("part"))).alias("_cut"),
            F.max(F.when(~over, F.col("upto"))).alias("_taken"),
            F.lit(True).alias("_seen"),
        ).withColumnRenamed("_s", "_t")
        end = F.col("cut") + F.lit(1 << (60 - BITS * (level - 1)))
        plan = plan.join(step, F.col("_s").eqNullSafe(F.col("_t")), "left").select(
            "_s",
            "passes",
            (F.col("rest") - F.coalesce("_taken", F.lit(0))).alias("rest"),
            F.when(F.col("_seen").isNull(), F.col("cut")).otherwise(F.coalesce("_cut", end)).alias("cut"),
        )
        plan = written(plan, "mix-plan")
    of, passes, cut, n = _free(docs.columns, "_s", "passes", "cut", "_n")
    plan = plan.select(F.col("_s").alias(of), F.col("passes").alias(passes), F.col("cut").alias(cut))
    last = F.when(_place(seed) < F.col(cut), F.lit(1)).otherwise(F.lit(0))
    rows = docs.select(*[f"`{c}`" for c in kept]).join(plan, F.col(f"`{source}`").eqNullSafe(F.col(of)))
    rows = rows.withColumn(n, F.col(passes) + last).where(F.col(n) > 0)
    rows = rows.withColumn("pass_no", F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    block = F.shiftright(_place(seed), 60 - BITS)
    rows = rows.withColumn("block_order", F.xxhash64(F.lit(seed), F.col("pass_no"), F.col(f"`{source}`"), block))
    rows = rows.withColumn("doc_order", F.xxhash64(F.lit(seed), F.col("pass_no"), F.col("doc_id"), F.lit("doc")))
    return rows.select(*[f"`{c}`" for c in kept], *names)
