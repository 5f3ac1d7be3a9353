"""Mixing sources to target weights: weighted pivotal rounding over a reduction tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sitefold.llm import common as C

#: Residuals that one block of the tree reduces to one.
FAN_IN = 256


def shares(totals: DataFrame, total: int, *, weights: tuple[float, ...], ratio: float, most: float) -> DataFrame:
    """Add ``target`` to one row per source (``size``, ``weight``).

    The sources share ``ratio`` of all sizes by weight; none gets more than ``most`` times its size, and what that leaves
    over is shared by weight among the others, until none is above. Each round fixes the sources that the share of the
    rest would lift above their bound; only sums leave the executors.
    """
    bound = F.col("size") * most
    held: list[float] = []
    share, state = 0.0, totals.withColumn("full", F.lit(False))
    # A round fixes all sources above the share; the share only grows, so sources once fixed stay so.
    while True:
        r = state.agg(F.sum(F.when(F.col("full"), bound)).alias("held"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("open"),
                      F.sum(F.col("full").cast("int")).alias("n")).first()
        if not r["open"]:
            break
        share = (total * ratio - (r["held"] or 0.0)) / r["open"]
        if held and held[-1] == r["n"]:
            break
        held.append(r["n"])
        state = totals.withColumn("full", F.col("weight") * share > bound)
    return state.withColumn("target", F.when(F.col("full"), bound).otherwise(F.col("weight") * share)).drop("full")


def _uniform(*columns: Column) -> Column:
    """A number in [0, 1) that only depends on the values given."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / float(1 << 52)


def _settle(items: Column, salt: Column) -> Column:
    """Reduce a block of fractional items to one, pair by pair.

    The state is the open item (its place, size and mass: size times probability), and the copies settled so far. Mass
    moves between the open item and the next one until one of them is whole, up or down at random so that both keep
    their expectation and the sum of their masses stays as it is. The other is the new open item.
    """
    state = F.struct(F.lit(-1).alias("at"), F.lit(0.0).alias("w"), F.lit(0.0).alias("m"), F.array().cast("array<struct<at:int,copies:int>>").alias("done"))

    def merge(s: Column, x: Column) -> Column:
        up = F.least(s["w"] - s["m"], x["m"])  # mass that the open item can take from the next
        down = F.least(s["m"], x["w"] - x["m"])  # and give to it
        def step(taken: Column, full: Column, empty: Column) -> Column:
            """``taken``: whether the open item takes; ``full``/``empty``: whether it is the one that becomes whole then."""
            own = F.when(taken, full).otherwise(empty)
            copies = F.when(own, taken.cast("int")).otherwise((~taken).cast("int"))
            moved = F.when(taken, up).otherwise(-down)
            return F.struct(
                F.when(own, x["at"]).otherwise(s["at"]).alias("at"), F.when(own, x["w"]).otherwise(s["w"]).alias("w"),
                F.when(own, x["m"] - moved).otherwise(s["m"] + moved).alias("m"),
                F.concat(s["done"], F.array(F.struct(F.when(own, s["at"]).otherwise(x["at"]).alias("at"), copies.alias("copies")))).alias("done"))

        taken = F.coalesce(_uniform(salt, s["at"], x["at"], x["tie"]) < down / F.nullif(up + down, F.lit(0.0)), F.lit(False))
        first = F.struct(x["at"].alias("at"), x["w"].alias("w"), x["m"].alias("m"), s["done"].alias("done"))
        return F.when(s["at"] < 0, first).otherwise(step(taken, s["w"] - s["m"] <= x["m"], s["m"] <= x["w"] - x["m"]))

    return F.aggregate(items, state, merge)


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), ratio: float = 1.5, most: float = 2.0, seed: int = 17,
        id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """How often the mix takes each document: doc_id, source, print, size, source_size, target, copies, taken.

    ``weights`` repeat over the sources in code point order, null last. A source's documents should be copied
    ``target / source_size`` times. The whole part is certain; the fraction is rounded by weighted pivotal rounding, so that
    the words taken miss the target by at most half of one document's size. Documents fall into blocks of about ``FAN_IN`` by hash;
    each block settles all but one, and the open ones go up a tree of the same fan-in, which has one root per source. A
    large source has many blocks, so no task holds more than a few blocks. Blocks are counted over documents with words, and only
    these enter them.

    Random numbers are hashes of ids and ``seed``: reruns agree. Rows that agree in id, source and text hash are counted first
    and settled as one item; the mass of all copies is rounded, and the first of the rows get the copies. Without words
    (null or empty text) a document takes the whole part of its copies and no words. An empty table gives no rows. Only
    the three named columns are read.
    """
    text = C.text_of(text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), C.n_words_of(text).alias("size"), F.xxhash64(text).alias("print"))
    items = C.written(rows.groupBy("doc_id", "source", "size", "print").agg(F.count("*").alias("n")), "items")
    sums = C.written(items.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"),
                                                F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("items")), "sources")
    largest = sums.agg(F.max("items").alias("items"), F.sum("size").alias("size")).first()
    if largest["size"] is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, source string, print bigint, size bigint, source_size bigint, target double, copies bigint, taken bigint")
    ordered = C.running_total(sums.withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1)), ["last", "source"], "one", "place")
    weighted = ordered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    targets = C.written(shares(C.written(weighted, "weights"), largest["size"], weights=weights, ratio=ratio, most=most).select(
        "source", F.col("size").alias("source_size"), "target", F.greatest(F.ceil(F.col("items") / FAN_IN), F.lit(1)).alias("blocks")), "targets")
    # One row per source on the right: Spark broadcasts it or splits the large partitions of the left, by measured size.
    open_items = items.join(targets, items["source"].eqNullSafe(targets["source"]), "left").drop(targets["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    mass = F.when(F.col("size") > 0, (rate - whole) * F.col("n")).otherwise(0.0)
    # Certain copies, and the fraction that is left of all rows of the item.
    open_items = open_items.select(
        "doc_id", "source", "size", "print", "n", "source_size", "target", (whole * F.col("n") + F.floor(mass)).alias("sure"),
        ((mass - F.floor(mass)) * F.col("size")).alias("m"),
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "print"), F.col("blocks")).alias("block"))
    open_items = C.written(open_items, "rates")
    # Without a fraction there is nothing to round: such items, those without words among them, stay out of the tree.
    certain = open_items.where("m <= 0").select("source", F.struct("doc_id", "print", "size", "n", "sure", "source_size", "target").alias("item"), F.lit(0).alias("copies"))
    level = open_items.where("m > 0").select("source", "block", F.xxhash64(F.lit(seed + 1), "doc_id", "print", "size").alias("tie"), F.col("size").cast("double").alias("w"), "m",
                              F.struct("doc_id", "print", "size", "n", "sure", "source_size", "target").alias("item"))
    settled: list[DataFrame] = [certain]
    blocks, depth = max(1, -(-largest["items"] // FAN_IN)), 0
    while True:
        grouped = level.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("tie", "item", "w", "m"))).alias("items"))
        grouped = grouped.withColumn("state", _settle(
            F.transform("items", lambda x, i: F.struct(i.alias("at"), x["w"].alias("w"), x["m"].alias("m"), x["tie"].alias("tie"))),
            F.xxhash64(F.lit(seed + 2), F.lit(depth), F.col("block"))))
        reduced = C.written(grouped.select(
            "source", "block", F.transform("state.done", lambda d: F.struct(F.get("items", d["at"])["item"].alias("item"), d["copies"].alias("copies"))).alias("done"),
            F.get("items", F.col("state.at")).alias("open"), F.col("state.m").alias("m")), f"level{depth}")
        settled.append(reduced.select("source", F.explode("done").alias("x")).select("source", "x.item", "x.copies"))
        if blocks == 1:
            # One item per source is left to round: to the nearer side, so that half its size is the most it can miss.
            root = (F.col("m") > 0) & (2 * F.col("m") >= F.col("open.w"))
            settled.append(reduced.select("source", F.col("open.item").alias("item"), root.cast("int").alias("copies")))
            break
        level = reduced.select("source", F.floor(F.col("block") / FAN_IN).alias("block"), F.col("open.tie").alias("tie"), F.col("open.w").alias("w"), "m", F.col("open.item").alias("item"))
        blocks, depth = -(-blocks // FAN_IN), depth + 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    # The item's copies are dealt to its rows evenly, the first rows first.
    copies = F.col("item.sure") + F.col("copies")
    out = out.select("item.*", "source", copies.alias("all"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("item.n") - 1)).alias("k"))
    own = F.floor(F.col("all") / F.col("n")) + (F.col("k") < F.col("all") % F.col("n")).cast("long")
    return out.select("doc_id", "source", "print", "size", "source_size", F.col("target").cast("double").alias("target"), own.alias("copies"), (own * F.col("size")).alias("taken"))


def apply(docs: DataFrame, mixed: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` takes it; rows that it does not take go.

    Rows of one id, source and text only differ in other columns; they share the copies evenly, in an order that only depends on these. The
    row travels as one struct, so its columns may have any name, dots included, and any type. An empty table stays empty.
    """
    name = lambda c: "`" + c.replace("`", "``") + "`"
    key = F.struct("doc_id", "source", "print")
    taken = mixed.groupBy(key.alias("key")).agg(F.sum("copies").alias("total"), F.count("*").alias("n"))
    own = F.struct(F.col(name(id_column)).alias("doc_id"), F.col(name(source_column)).alias("source"), F.xxhash64(C.text_of(name(text_column))).alias("print"))
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(name(c)).alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text_column]))
    rows = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"), own.alias("key"), F.xxhash64(others).alias("place"))
    nth = F.row_number().over(W.partitionBy("key").orderBy("place")) - 1
    joined = rows.join(taken, "key").withColumn("nth", nth)
    copies = F.floor(F.col("total") / F.col("n")) + (F.col("nth") < F.col("total") % F.col("n")).cast("long")
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("copy")).select("row.*")
