"""Quality rules: a decision list of threshold conjunctions, learned from labelled statistics."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm import common as C

WINDOW = 8
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What rules may test: ratios of the counts, so that a threshold means the same for short and long texts; length is for the base rule.
FEATURES = {
    "mean_word": lambda c: c["word_chars"] / F.greatest(c["n_words"], F.lit(1)),
    "symbols_per_word": lambda c: c["n_symbols"] / F.greatest(c["n_words"], F.lit(1)),
    "dup_lines_per_word": lambda c: c["n_dup_lines"] / F.greatest(c["n_words"], F.lit(1)),
    "repeat_share": lambda c: c["n_repeat_words"] / F.greatest(c["n_words"], F.lit(1)),
    "shout_share": lambda c: c["n_upper"] / F.greatest(c["word_chars"], F.lit(1)),
    "marks_per_word": lambda c: c["n_marks"] / F.greatest(c["n_words"], F.lit(1)),
    "digit_share": lambda c: c["n_digits"] / F.greatest(c["word_chars"], F.lit(1)),
}


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it.

    A column of its own would not do: a filter above is pushed below the projection, and each name in it becomes the expression again.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(windows: Column) -> Column:
    """Words lying in a window of 8 words that the text holds twice or more, from the windows' hashes.

    Only a text with a repeated window sorts its windows: equal neighbours give the places, and the
    places' gaps the number of words they cover.
    """
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(o: Column) -> Column:
        twin = F.filter(o, lambda x, k: ((k > 0) & (x["h"] == F.get(o, k - 1)["h"])) | ((k + 1 < F.size(o)) & (x["h"] == F.get(o, k + 1)["h"])))
        return F.array_sort(F.transform(twin, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)

    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(let(ordered, places), covered)).otherwise(F.lit(0))


def counts_of(text: Column) -> Column:
    """A struct of the counts of the whole text. Hashes of 8-word windows come from doubling (1, 2, 4, 8 words)."""
    def doubled(h: Column, k: int) -> Column:
        """Hashes of twice as many words; the last ones, of windows that the text's end cuts, are of no use."""
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + k)))

    def repeated(four: Column) -> Column:
        """A text that repeats no 4 words repeats no 8."""
        eight = lambda w: let(F.slice(doubled(w, 4), 1, F.greatest(F.size(w) - 7, F.lit(0))), repeat_words)
        return F.when(F.size(F.array_distinct(four)) < F.size(four), eight(four)).otherwise(F.lit(0))

    def counted(t: Column) -> Column:
        full = F.filter(F.split(t, "\n", -1), lambda x: F.rlike(x, F.lit(C.WORD)))
        of_lines = let(full, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        of_words = let(C.words_of(t), lambda w: F.struct(
            F.size(w).alias("n"), F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)).alias("chars"),
            let(let(doubled(w, 1), lambda h: doubled(h, 2)), repeated).alias("r")))
        # One pass leaves the characters that are counted; each kind is then told apart on what little is left.
        rare = F.regexp_replace(t, f"[^{SYMBOLS}A-Z0-9!?]+", "")
        return let(F.struct(of_words.alias("w"), rare.alias("x")), lambda b: F.struct(*[v.cast("long").alias(k) for k, v in {
            "n_words": b["w"]["n"], "word_chars": b["w"]["chars"], "n_symbols": _without(b["x"], SYMBOLS), "n_dup_lines": of_lines, "n_repeat_words": b["w"]["r"],
            "n_upper": _without(b["x"], C.UPPER), "n_marks": _without(b["x"], "!?"), "n_digits": _without(b["x"], "0123456789")}.items()]))

    return let(text, counted)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self, values: dict[str, Column]) -> Column:
        v = values[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first whose tests all hold rejects, and what none rejects is kept."""

    rules: tuple[tuple[Test, ...], ...]

    def rejected_by(self, values: dict[str, Column]) -> Column:
        """Number of the first rule that holds (from 1), as one conditional expression; 0 if none does."""
        out = F.lit(0)
        for k in reversed(range(len(self.rules))):
            holds = reduce(lambda a, b: a & b, [t.column(values) for t in self.rules[k]])
            out = F.when(holds, F.lit(k + 1)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}" for r in self.rules) + "\nkeep"


def features(c: Column) -> dict[str, Column]:
    return {k: f(c) for k, f in FEATURES.items()}


class _Statistics:
    """Counts of good and bad rows by feature and bin, for the rows that some tests hold for."""

    def __init__(self, rows: DataFrame, cuts: dict[str, list[float]]):
        self.cuts = cuts
        values = {k: F.col(k) for k in cuts}
        bins = [F.struct(F.lit(k).alias("feature"), reduce(lambda a, b: a + b, [(values[k] > x).cast("int") for x in xs], F.lit(0)).alias("bin"))
                for k, xs in cuts.items() if xs]
        self.rows = rows.withColumn("bins", F.array(*bins))

    def of(self, tests: tuple[Test, ...], earlier: tuple[tuple[Test, ...], ...]) -> list[dict[str, list[tuple[int, int]]]]:
        """For rows that no earlier rule covers, of the pruning and of the growing part: (good, bad) by bin of each feature."""
        values = {k: F.col(k) for k in self.cuts}
        some = self.rows.where(DecisionList(earlier).rejected_by(values) == 0)
        for t in tests:
            some = some.where(t.column(values))
        counted = some.select("grow", F.explode("bins").alias("b"), "bad").groupBy("grow", "b.feature", "b.bin").agg(
            F.sum(1 - F.col("bad")).alias("good"), F.sum("bad").alias("bad")).collect()
        out = [{k: [(0, 0)] * (len(xs) + 1) for k, xs in self.cuts.items()} for _ in range(2)]
        for r in counted:
            out[r["grow"]][r["feature"]][r["bin"]] = (r["good"], r["bad"])
        return out


def _totals(counts: dict[str, list[tuple[int, int]]]) -> tuple[int, int]:
    bins = max(counts.values(), key=len, default=[])
    return sum(g for g, _ in bins), sum(b for _, b in bins)


def _best(counts: dict[str, list[tuple[int, int]]], cuts: dict[str, list[float]], good: int, bad: int, slack: float = 0.02) -> Test | None:
    """The test of largest information gain for the bad rows (FOIL): bad kept x (purity after - before), in bits.

    Its threshold then moves away from the good rows, as far as that costs at most ``slack`` of the bad ones it covers: what lies
    between the two kinds is given the benefit of the doubt.
    """
    found: list[tuple[float, str, bool, int, int]] = []
    for feature, bins in counts.items():
        for k in range(len(cuts[feature])):
            low = (sum(g for g, _ in bins[: k + 1]), sum(b for _, b in bins[: k + 1]))
            for above, (g, b) in ((False, low), (True, (good - low[0], bad - low[1]))):
                if b:
                    found.append((b * (math.log2(b / (g + b)) - math.log2(bad / (good + bad))), feature, above, k, b))
    gain, feature, above, k, covered = max(found, key=lambda x: (x[0], x[1], x[2], -x[3]), default=(0.0, "", True, 0, 0))
    if gain <= 1e-9:
        return None
    near = [j for _, f, a, j, b in found if f == feature and a == above and b >= (1 - slack) * covered and (j >= k if above else j <= k)]
    return Test(feature, above, cuts[feature][max(near) if above else min(near)])


def learn(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000, bins: int = 24, max_rules: int = 8, max_tests: int = 3,
          purity: float = 0.97, least: float = 0.002, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> DecisionList:
    """Learn a decision list by sequential covering from the labelled documents (1 good, 0 bad).

    A rule is grown on two thirds of the rows that no earlier rule covers, test by test, by gain; then its last tests are
    pruned as long as that does not lower (bad - good) / (bad + good) on the other third, and it is accepted if at least
    ``purity`` of what it covers is bad on both parts and it covers at least ``least`` of the bad rows. Everything is read
    from counts by feature and bin that Spark aggregates: the driver sees as many numbers as there are bins.

    The model is fitted on a sample of about ``max_labelled`` labelled documents, by hash of the id (all, if fewer); its
    ids are the only thing broadcast. Labels without an id or a value, contradicting labels of one id, and labels of no
    document are ignored. Without labels, or with one class only, the list is empty: everything is kept.
    """
    known = labels.select(F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    known = known.groupBy("__id").agg(F.min("__y").alias("lo"), F.max("__y").alias("hi")).where("lo = hi").select("__id", (1 - F.col("lo")).alias("bad"))
    total = known.count()
    if total > max_labelled:
        known = known.where(F.pmod(F.xxhash64(F.lit("labelled"), "__id"), F.lit(1 << 30)) < int((1 << 30) * max_labelled / total))
    # As many rows as the parameter allows: ids and one number each.
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__x")).join(F.broadcast(known), "__id")
    grow = F.pmod(F.xxhash64(F.lit("grow"), "__id"), F.lit(3)) > 0
    counted = C.written(texts.select("bad", grow.alias("grow"), counts_of(C.text_of("__x")).alias("c")), "labelled")
    # At most as many rows as the parameter allows: a few tasks read them, each of the few times.
    rows = counted.coalesce(8).where(~base_failed(F.col("c"))).select("bad", "grow", *[v.alias(k) for k, v in features(F.col("c")).items()])
    at = [k / bins for k in range(1, bins)] + [0.98, 0.99, 0.995]
    found = rows.select(*[F.percentile_approx(k, F.lit(at), 10_000).alias(k) for k in FEATURES]).first()
    cuts = {k: sorted(set(found[k] or [])) for k in FEATURES}
    if not any(cuts.values()):
        return DecisionList(())
    statistics = _Statistics(rows, cuts)
    _, fresh = statistics.of((), ())
    every = _totals(fresh)[1]
    rules: list[tuple[Test, ...]] = []
    while len(rules) < max_rules:
        tests: tuple[Test, ...] = ()
        good, bad = _totals(fresh)
        grown, counts = [], fresh
        while len(tests) < max_tests and good and bad:
            test = _best(counts, cuts, good, bad)
            if test is None:
                break
            tests += (test,)
            held, counts = statistics.of(tests, tuple(rules))
            good, bad = _totals(counts)
            grown.append((tests, _totals(held), (good, bad)))
        if not grown:
            break
        worth = [(b - g) / (b + g) if b + g else -1.0 for _, (g, b), _ in grown]
        tests, (g, b), (good, bad) = grown[max(range(len(grown)), key=lambda k: (worth[k], -k))]
        if bad < max(1, least * every) or bad < purity * (good + bad) or b < purity * (g + b):
            break
        rules.append(tests)
        _, fresh = statistics.of((), tuple(rules))
    return DecisionList(tuple(rules))


def judge(text: Column, rules: DecisionList) -> Column:
    """Struct of ``counts``, ``failed`` (the base rule) and ``rule`` (number of the rule that rejects, else 0) of a text.

    One conditional expression over the counts, without a shuffle. A null text counts as one without words, which the base rule fails.
    """
    return let(counts_of(F.coalesce(text, F.lit(""))), lambda c: F.struct(
        c.alias("counts"), base_failed(c).alias("failed"), rules.rejected_by(features(c)).alias("rule")))


def kept(docs: DataFrame, rules: DecisionList, *, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor the list rejects.

    Repeated rows and rows without an id are judged like others; the columns, whatever their names, stay as they are.
    """
    return docs.where(let(judge(F.col(text_column), rules), lambda v: ~v["failed"] & (v["rule"] == 0)))
