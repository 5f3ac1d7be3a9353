"""URL filters: fixed host and path rules, and association rules over URL tokens."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm import common as C

# The base rules (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
BAD = "=bad"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as the contract cuts them; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return C.ascii_lower(rest), path


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, judged in reversed(ordered):
        fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(path, F.lit(own_path))
        name, verdict = F.when(fits, own_host + own_path).otherwise(name), F.when(fits, judged).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels, path segments (digits as ``#``), ending, names of query parts, mark of a fragment."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_and_path(url)
    tag = lambda prefix, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))
    segments = F.split(F.regexp_replace(F.regexp_replace(path, r"\.[A-Za-z0-9]+$", ""), "[0-9]+", "#"), "/", -1)
    query = F.regexp_extract_all(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit("(?:^|&)([^=&]+)"), F.lit(1))
    return F.array_distinct(F.concat(
        tag("s:", F.array(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))), tag("h:", F.split(host, r"\.", -1)), tag("p:", segments),
        tag("e:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))), tag("q:", query), F.when(F.contains(url, F.lit("#")), F.array(F.lit("f:#"))).otherwise(F.array())))


@dataclass(frozen=True)
class Rule:
    """These tokens -> bad. ``alike`` lists, for each, the tokens that stand for it: those found in exactly the same labelled urls."""

    tokens: tuple[str, ...]
    confidence: float
    support: float
    alike: tuple[tuple[str, ...], ...] = ()


def learn(pages: DataFrame, labels: DataFrame, *, max_labelled: int = 50_000, least_rows: int = 25, least_support: float = 0.002, least_confidence: float = 0.6,
          id_column: str = "page_id", url_column: str = "url", label_id: str = "doc_id", label_column: str = "quality") -> list[Rule]:
    """Rules "these tokens -> bad" mined by FP-growth from labelled urls.

    A url's transaction holds its tokens, and ``=bad`` where its label is 0. Rules need a support of ``least_support`` (and
    ``least_rows`` rows) and a confidence of ``least_confidence``; a rule is pruned if one with fewer of its tokens is at
    least as confident. Tokens that occur in exactly the same labelled urls are one item, named by the smallest of them, so a template
    of any length is one item; support and confidence stay exact. The model is fitted on about ``max_labelled`` labelled urls (by hash of
    the id; all, if fewer). All rules that are not pruned are kept and broadcast; the support and the number of distinguishable
    tokens in one url bound their number. Labels without id or value and contradicting ones are ignored; without labels, or in
    an empty table, there are no rules. Long urls are read whole.
    """
    known = labels.select(F.col(label_id).alias("__id"), F.col(label_column).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    known = known.groupBy("__id").agg(F.min("__y").alias("lo"), F.max("__y").alias("hi")).where("lo = hi").select("__id", (F.col("lo") == 0).alias("bad"))
    total = known.count()
    if total > max_labelled:
        known = known.where(F.pmod(F.xxhash64(F.lit("urls"), "__id"), F.lit(1 << 30)) < int((1 << 30) * max_labelled / total))
    own = pages.select(F.col(id_column).alias("__id"), F.col(url_column).alias("__url")).join(F.broadcast(known), "__id")
    urls = C.written(own.select(F.monotonically_increasing_id().alias("row"), tokens(F.col("__url")).alias("tokens"), "bad"), "urls")
    pairs = urls.select("row", F.explode("tokens").alias("token"))
    groups = C.written(same_rows(pairs), "groups")
    merged = pairs.join(groups, "token").groupBy("row").agg(F.collect_set("item").alias("own"))
    bad = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    items = C.written(urls.join(merged, "row", "left").select(F.concat(F.coalesce("own", F.array().cast("array<string>")), bad).alias("items")), "transactions")
    n = items.count()
    if not n:
        return []
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(least_support, least_rows / n)), minConfidence=least_confidence).fit(items)
    rules = C.written(unpruned(model.freqItemsets, n).where(F.col("confidence") >= least_confidence), "rules")
    used = rules.select(F.explode("tokens").alias("item")).distinct()
    alike = {r["item"]: tuple(r["tokens"]) for r in groups.join(used, "item").groupBy("item").agg(F.array_sort(F.collect_set("token")).alias("tokens")).collect()}
    return [Rule(tuple(r["tokens"]), r["confidence"], r["support"], tuple(alike[t] for t in r["tokens"]))
            for r in sorted(rules.collect(), key=lambda r: (len(r["tokens"]), -r["confidence"], r["tokens"]))]


def same_rows(pairs: DataFrame) -> DataFrame:
    """token, item: the smallest of the tokens found in exactly the same rows (equal count and equal sums of two hashes of the rows)."""
    total = lambda salt: F.sum(F.xxhash64(F.lit(salt), "row").cast("decimal(38,0)"))
    prints = pairs.groupBy("token").agg(F.count("*").alias("n"), total(1).alias("x"), total(2).alias("y"))
    return prints.join(prints.groupBy("n", "x", "y").agg(F.min("token").alias("item")), ["n", "x", "y"]).select("token", "item")


def unpruned(itemsets: DataFrame, n: int) -> DataFrame:
    """tokens, confidence, support of the sets of tokens that are more confident than each set of fewer of their tokens.

    Goes up by size: every subset of a frequent set is frequent, so the best confidence below a set is that of the sets with one token less, or below these.
    """
    sets = itemsets.select(F.array_sort("items").alias("items"), "freq")
    bad = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("tokens"), F.col("freq").alias("both"))
    own = bad.join(sets.where(~F.array_contains("items", BAD)).select(F.col("items").alias("tokens"), "freq"), "tokens")
    own = C.written(own.select("tokens", (F.col("both") / F.col("freq")).alias("confidence"), (F.col("both") / n).alias("support"), F.size("tokens").alias("size")), "itemsets")
    most = own.agg(F.max("size").alias("most")).first()["most"] or 0
    level = C.written(own.where("size = 1").withColumn("below", F.lit(0.0)), "level")
    levels = [level]
    for size in range(2, most + 1):
        less = level.select(F.col("tokens").alias("part"), F.greatest("confidence", "below").alias("b"))
        parts = own.where(F.col("size") == size).select("*", F.explode("tokens").alias("t")).select(*own.columns, F.array_remove("tokens", F.col("t")).alias("part"))
        level = C.written(parts.join(less, "part").groupBy(*own.columns).agg(F.max("b").alias("below")), "level")
        levels.append(level)
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.where("confidence > below").select("tokens", "confidence", "support")


def judge(pages: DataFrame, learned: list[Rule], *, rules: tuple[tuple[str, str, str], ...] = RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, and the learned rule that fits (``learned``) with its confidence.

    A fixed rule decides where one fits. Else the page is blocked if a learned rule holds, which has a token of the url for each of its
    items; they are found through an inverted index from item to rules, by counting the items that each has in common with the url. Each row is judged on its own,
    nothing is shuffled. A null url, or one without ``://``, has an empty host and path and no rule, and is allowed. Repeated rows and rows
    without an id stay rows. Only the two named columns are read.
    """
    host, path = host_and_path(F.col(url_column))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), tokens(F.col(url_column)).alias("tokens"))
    rows = rows.select("page_id", "host", "path", name.alias("rule"), verdict.alias("fixed"), "tokens")
    out = C.schema(page_id="long", host="string", path="string", rule="string", verdict="string", learned="string", confidence="double")

    def judged(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index: dict[str, list[int]] = {}
        item: dict[str, str] = {}
        for k, r in enumerate(learned):
            for t, same in zip(r.tokens, r.alike or [(t,) for t in r.tokens], strict=True):
                index.setdefault(t, []).append(k)
                item.update(dict.fromkeys(same, t))
        for batch in batches:
            verdicts, names, sure = [], [], []
            for fixed, own in zip(batch.column("fixed").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                shared: dict[int, int] = {}
                for t in {item[t] for t in own if t in item}:
                    for k in index.get(t, ()):
                        shared[k] = shared.get(k, 0) + 1
                fits = [learned[k] for k, c in shared.items() if c == len(learned[k].tokens)]
                best = max(fits, key=lambda r: (r.confidence, r.support, r.tokens), default=None)
                verdicts.append(fixed or ("block" if best else "allow"))
                names.append(" ".join(best.tokens) if best else None)
                sure.append(best.confidence if best else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("page_id", "host", "path", "rule")] + [pa.array(verdicts, pa.string()), pa.array(names, pa.string()), pa.array(sure, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "learned", "confidence"])

    return rows.mapInArrow(judged, out)
