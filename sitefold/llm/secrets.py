"""Secret scans over an incremental ledger of content-addressed texts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitefold.llm import common as C


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``least`` is the least length of ``group``; shorter matches are dropped after matching.

    ``needs`` is a literal that every match contains; texts without it are not searched.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    needs: str = ""


# The three base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Further kinds: public formats of credentials.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", needs="-----BEGIN "),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs="eyJ"),
    Rule("prefixed", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@\"']{1,64}:[^\s/:@\"']{3,64}@", needs="://"),
)
RULES = BASE + MORE
SPAN = "array<struct<start:int,place:int,kind:string,stop:int>>"


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """Spans of one rule, leftmost and non-overlapping, in code points, end exclusive.

    The pieces between the matches and the matches themselves, laid end to end, give the places. Only a
    text with a match is split.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, rule.pattern, -1)

    # (found, pieces, secret lengths) -> spans: start k = pieces 0..k and matches 0..k-1 together.
    lengths = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    walk = F.aggregate(
        F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("p"), found.alias("m"), lengths.alias("g")),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
            F.when(F.length(x["g"]) >= rule.least, F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(x["p"])).alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"),
                (s["at"] + F.length(x["p"]) + F.length(x["m"])).alias("stop")))))
            .otherwise(s["spans"]).alias("spans")),
        lambda s: s["spans"],
    )
    searched = F.size(found) > 0
    if rule.needs:
        searched = F.contains(text, F.lit(rule.needs)) & searched
    return F.when(searched, walk).otherwise(F.array().cast(SPAN))


def find(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text, by start and then by the rules' order."""
    return F.array_sort(reduce(F.concat, [spans_of(text, r, k) for k, r in enumerate(rules)]))


def rule_version(rules: tuple[Rule, ...]) -> str:
    """Identifies the set of rules: another set has findings of its own."""
    import hashlib

    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


class Ledger:
    """Findings by blob and version of the rules: a Parquet folder to which each scan appends what was unseen.

    One writer at a time. Each scan appends one commit as a whole, so a scan that fails leaves the ledger as it was.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    SCHEMA = f"blob binary, version string, spans {SPAN}"

    def rows(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.folder)

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """Findings of every row of ``versions``: doc_id, blob, spans.

        Each text is addressed by its SHA-256. Of the rows that share a blob not yet in the ledger under these rules, one (the
        smallest id) is scanned; its findings are appended, and all rows get theirs by blob. Copies thus cost one scan, a later
        run scans only new texts, and new rules scan all. Only ids and hashes are grouped; a hot blob is combined before the
        shuffle, and the last join is on small rows that Spark can split.

        A null text is the empty text. Rows without an id, or that repeat one, get the findings of their own text. An empty
        table gives no rows. Only the two named columns are read.
        """
        version = rule_version(rules)
        paths = C.written(
            versions.select(F.col(id_column).alias("doc_id"), F.unhex(F.sha2(C.text_of(text_column), 256)).alias("blob")), "paths")
        # A null id cannot be joined on, so a stand-in takes its place.
        seen = self.rows().where(F.col("version") == version).select("blob")
        unseen = (paths.groupBy("blob").agg(F.min("doc_id").alias("pick")).join(seen, "blob", "left_anti")
                  .select("blob", F.coalesce(F.col("pick").cast("string"), F.lit("")).alias("pick")))
        texts = versions.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("pick"), C.text_of(text_column).alias("text"))
        texts = texts.withColumn("blob", F.unhex(F.sha2("text", 256)))
        # Equal rows (one id, one text) may be picked together: the first is as good as any.
        found = (texts.join(unseen, ["blob", "pick"], "left_semi").select("blob", find(F.col("text"), rules).alias("spans"))
                 .groupBy("blob").agg(F.first("spans").alias("spans")))
        found.select("blob", F.lit(version).alias("version"), "spans").write.mode("append").parquet(self.folder)
        hits = self.rows().where((F.col("version") == version) & (F.size("spans") > 0)).select("blob", "spans").dropDuplicates(["blob"])
        return paths.join(hits, "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def written_spans(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    some = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, and each run of overlapping spans, replaced by the first one's ``[kind]``."""
    state = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["stop"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit("["), x["kind"], F.lit("]")))
            .otherwise(s["out"]).alias("out")))
    return F.when(F.size(spans) > 0, F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))).otherwise(text)


def redact(docs: DataFrame, found: DataFrame, *, text_column: str = "text", size_column: str = "n_chars") -> DataFrame:
    """``docs`` with the spans of ``found`` (from ``Ledger.scan``) replaced; ``size_column``, if there, follows the new text."""
    hits = found.where(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("__spans")).withColumnRenamed("blob", "__blob")
    joined = docs.withColumn("__blob", F.unhex(F.sha2(C.text_of(text_column), 256))).join(hits, "__blob", "left")
    joined = joined.withColumn(text_column, F.when(F.col("__spans").isNotNull(), redacted(F.col(text_column), F.col("__spans"))).otherwise(F.col(text_column)))
    if size_column in docs.columns:
        size = F.when(F.col("__spans").isNotNull(), F.length(text_column).cast(docs.schema[size_column].dataType)).otherwise(F.col(size_column))
        joined = joined.withColumn(size_column, size)
    return joined.select(*docs.columns)
