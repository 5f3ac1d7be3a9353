"""Exact set-similarity join on bigram sets that chooses its plan per block.

Both sides are reduced to their distinct values. A block is what the extra key columns hold apart (all values, if there
are none), and for each block the cheaper of two plans is taken, by its own counts:

* **prefixes**: Dice >= t forces two sets to share a bigram among the rarest few of each, so the join is an equi-join on those.
  Its cost is known beforehand: for each bigram, how many prefixes of either side hold it.
* **grid**: where that is more than the pairs of the block - at low thresholds the prefix is most of a set - the block's values are dealt
  into small parts, and every two parts meet once.

Either way a pair becomes a row only if a bound from two machine words per value allows it, and it stays only if the exact
Dice, counted on bit sets, reaches t. Nothing is dropped: bounds only skip pairs that cannot reach t.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.functions import text as tx
from sitefold.operators.lineage import cut_lineage

_EPS = 1e-9
#: Values of one part of a grid, on the left and on the right.
LEFT_PART, RIGHT_PART = 1024, 4096


def with_sets(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the folded bit set of each text column: ``columns`` maps it to the name of its set."""
    # One expression per step: each reads what the one before has made instead of repeating it.
    steps = [lambda c, s: tx.bigram_numbers(tx.bigram_codes(F.col(c))), lambda c, s: tx.bigram_set(F.col(s)), lambda c, s: tx.folded_set(F.col(s))]
    for step in steps:
        df = df.withColumns({s: step(c, s) for c, s in columns.items()})
    return df


def value_sets(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Distinct (keys, value) with their bit sets, written out: keys, ``value``, ``set``, ``numbers`` (its bigrams)."""
    keys = list(keys or [])
    distinct = df.select(*keys, F.col(value).alias("value")).where("value <> ''").distinct()
    numbered = distinct.withColumn("numbers", tx.bigram_numbers(tx.bigram_codes(F.col("value"))))
    return cut_lineage(numbered.withColumn("set", tx.bigram_set(F.col("numbers"))).withColumn("set", tx.folded_set(F.col("set"))))


def rarest_first(left: DataFrame, right: DataFrame) -> Column:
    """An order of bigrams, the rarest first, as an array of ranks. There are 1,369 bigrams, so that is what reaches the driver."""
    both = left.select("numbers").unionByName(right.select("numbers"))
    counts = {r["x"]: r["n"] for r in both.select(F.explode("numbers").alias("x")).groupBy("x").agg(F.count("*").alias("n")).collect()}
    size = 64 * tx.SET_WORDS
    rank = {x: k for k, x in enumerate(sorted(range(size), key=lambda x: (counts.get(x, 0), x)))}
    return F.split(F.lit(",".join(str(rank[x]) for x in range(size))), ",").cast("array<int>")


def _prefixes(sets: DataFrame, keys: list[str], ranks: Column, threshold: Column) -> DataFrame:
    """One row per (keys, value) and bigram of its prefix: ``at`` is the bigram's place."""
    n = F.col("set.n")
    # Smallest overlap any partner can have: the partner is at least t/(2-t) times as long.
    least = F.ceil(n * threshold / (2.0 - threshold) - _EPS)
    ordered = F.array_sort(F.transform("numbers", lambda x: F.get(ranks, x)))
    prefix = F.slice(ordered, F.lit(1), F.greatest(n - least + 1, F.lit(1)).cast("int"))
    return sets.select(*keys, "value", F.posexplode(prefix).alias("at", "token"))


def plans(left: DataFrame, right: DataFrame, ranks: Column, threshold: Column, keys: list[str]) -> DataFrame:
    """Per block: ``n_left``, ``n_right``, ``by_prefix`` (rows that the prefixes would join) and ``grid`` (whether that is the cheaper plan)."""
    sizes = left.groupBy(*keys).agg(F.count("*").alias("n_left")).join(right.groupBy(*keys).agg(F.count("*").alias("n_right")), keys)
    tokens = [_prefixes(s, keys, ranks, threshold).groupBy(*keys, "token").agg(F.count("*").alias(c)) for s, c in ((left, "c_left"), (right, "c_right"))]
    met = tokens[0].join(tokens[1], [*keys, "token"]).groupBy(*keys).agg(F.sum(F.col("c_left") * F.col("c_right")).alias("by_prefix"))
    costs = sizes.join(met, keys, "left").withColumn("by_prefix", F.coalesce("by_prefix", F.lit(0)))
    return costs.withColumn("grid", F.col("by_prefix") > F.col("n_left") * F.col("n_right"))


def _may_reach(a: Column, b: Column, threshold: Column) -> Column:
    """Whether the sizes and folds of two sets allow Dice >= t (> 0 if t is 0)."""
    total = (a["n"] + b["n"]) * threshold
    shared = tx.shared_at_most(a, b)
    return (2.0 * F.least(a["n"], b["n"]) >= total - _EPS) & (shared > 0) & (2.0 * shared >= total - _EPS)


def similar_sets(left: DataFrame, right: DataFrame, threshold: float | Column, on: list[str] | None = None, ranks: Column | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Like ``similar_values``, for two results of ``value_sets``. ``ranks`` is their ``rarest_first``, where it is at hand.

    ``threshold`` may be an expression of the ``on`` columns. ``keep`` names further columns of the right side that the result holds too.
    """
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    keys = list(on or [])
    if not keys:
        keys = ["block"]
        left, right = left.withColumn("block", F.lit(0)), right.withColumn("block", F.lit(0))
    ranks = rarest_first(left, right) if ranks is None else ranks
    plan = cut_lineage(plans(left, right, ranks, threshold, keys))
    sides = [s.select(*keys, F.col("value").alias(f"{x}_value"), F.col("set").alias(f"{x}_set"), *kept) for s, x, kept in ((left, "l", ()), (right, "r", keep))]

    # Grid: every part of the left meets every part of the right once.
    gridded = plan.where("grid").select(*keys, F.ceil(F.col("n_left") / LEFT_PART).alias("l_parts"), F.ceil(F.col("n_right") / RIGHT_PART).alias("r_parts"))
    dealt = []
    for side, own, other in ((sides[0], "l", "r"), (sides[1], "r", "l")):
        parts = side.join(gridded, keys).withColumn(f"{own}_part", F.pmod(F.xxhash64(f"{own}_value"), f"{own}_parts"))
        dealt.append(parts.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_parts") - 1))).drop("l_parts", "r_parts"))
    l, r = F.col("l_set"), F.col("r_set")
    cells = dealt[0].join(dealt[1].hint("merge"), [*keys, "l_part", "r_part"]).where(_may_reach(l, r, threshold)).drop("l_part", "r_part")

    # Prefixes: what both sets can still share from the common bigram on bounds the pair as well.
    chosen = plan.where("not grid").select(*keys)
    rows = []
    for sets, x in ((left, "l"), (right, "r")):
        small = sets.join(chosen, keys, "left_semi")
        tokens = _prefixes(small, keys, ranks, threshold).withColumnRenamed("at", f"{x}_at").withColumnRenamed("value", f"{x}_value")
        brief = F.struct(*[F.col(f"{x}_set.{f}").alias(f) for f in ("n", "f0", "f1", "spare")]).alias(f"{x}_set")
        rows.append(tokens.join(sides["lr".index(x)].select(*keys, f"{x}_value", brief), [*keys, f"{x}_value"]))
    possible = F.least(l["n"] - F.col("l_at"), r["n"] - F.col("r_at"))
    met = rows[0].join(rows[1], [*keys, "token"]).where(
        _may_reach(l, r, threshold) & (possible * F.lit(2.0) >= (l["n"] + r["n"]) * threshold - _EPS))
    pairs = met.select(*keys, "l_value", "r_value").distinct()
    found = pairs.join(sides[0], [*keys, "l_value"]).join(sides[1], [*keys, "r_value"])

    columns = [*keys, "l_value", "r_value", *keep]
    either = cells.select(*columns, "l_set", "r_set").unionByName(found.select(*columns, "l_set", "r_set"))
    exact = either.select(*columns, F.explode(F.array(tx.dice_sets(l, r))).alias("similarity"))
    # ">= 0" holds for every pair; without a threshold a pair has to share something.
    return exact.where((F.col("similarity") >= threshold) & (F.col("similarity") > 0)).select(*(on or []), "l_value", "r_value", *keep, "similarity")


def similar_values(left: DataFrame, left_value: str, right: DataFrame, right_value: str, threshold: float, on: list[str] | None = None) -> DataFrame:
    """Distinct value pairs with Dice >= threshold (> 0 if threshold is 0).

    ``on`` names extra columns, present on both sides, that must be equal. Result
    columns: the ``on`` columns, ``l_value``, ``r_value``, ``similarity``.
    """
    return similar_sets(value_sets(left, left_value, on), value_sets(right, right_value, on), threshold, on)
