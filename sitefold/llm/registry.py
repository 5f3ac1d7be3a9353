"""Registered queries of this package, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitefold.llm import align, common as C, licenses, lm, mixing, neardup, ngram_join, packing, quality, secrets, spelling, token_files, topk, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(C.table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    place = C.new_path(spark, "tokens")
    manifest = token_files.write(C.table(spark, folder, "documents"), place, C.tokenizer_path("byte_bpe_50k.json"), 2, dtype="uint16")
    return token_files.read(manifest, place, dtype="uint16", with_ids=False)


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = C.table(spark, folder, "documents")
    rules = quality.learn(docs, C.table(spark, folder, "labels"))
    judged = docs.select("doc_id", quality.judge(F.col("text"), rules).alias("v"))
    return judged.select("doc_id", *[F.col(f"v.counts.{c}") for c in quality.COUNTS], F.col("v.failed").alias("base_failed"),
                         F.col("v.rule").alias("rule"), (~F.col("v.failed") & (F.col("v.rule") == 0)).alias("kept"))


@query
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(C.table(spark, folder, "documents")).drop("spans")


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = C.table(spark, folder, "pages")
    return urls.judge(pages, urls.learn(pages, C.table(spark, folder, "labels")))


@query
def op6_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(C.table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op6_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query
def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.cluster(C.table(spark, folder, "documents"))


ORACLE["op7_near_duplicates"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(id, c) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT reach.id, pairs.b FROM reach JOIN pairs ON reach.c = pairs.a
), least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept FROM s JOIN least ON id = doc_id
"""


@query
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    ledger = secrets.Ledger(spark, C.new_path(spark, "secret-ledger"))
    found = ledger.scan(C.table(spark, folder, "documents"))
    base = tuple(r.kind for r in secrets.BASE)
    return found.select("doc_id", *[secrets.count_of(F.col("spans"), k).alias(f"n_{k}") for k in base], F.sha2(secrets.written_spans(F.col("spans"), base), 256).alias("base_sha256"),
                        secrets.written_spans(F.col("spans")).alias("spans"))


def _span_sql(place: int, rule: secrets.Rule) -> str:
    """The spans of one rule: places from the lengths of the pieces and of the matches before."""
    pattern, least = rule.pattern, rule.least
    if pattern.startswith("(?i)"):  # spelled out, since the flag would fold other letters too
        end = pattern.index(")", 4) + 1
        pattern = "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in pattern[4:end]) + pattern[end:]
    quoted = pattern.replace("'", "''")
    m, g = f"regexp_extract_all(t, '{quoted}')", f"regexp_extract_all(t, '{quoted}', {rule.group})"
    return f"""list_transform(list_filter(list_transform(range(1, len({m}) + 1), lambda i: {{
      'start': CAST(list_sum(list_transform(string_split_regex(t, '{quoted}')[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform({m}[1:i-1], lambda x: length(x))), 0) AS BIGINT),
      'size': length({m}[i]), 'secret': length({g}[i])}}), lambda x: x.secret >= {least}),
      lambda x: {{'start': x.start, 'place': {place}, 'kind': '{rule.kind}', 'stop': x.start + x.size}})"""


def _spans_sql() -> str:
    out = _span_sql(0, secrets.RULES[0])
    for k, rule in enumerate(secrets.RULES[1:], 1):
        out = f"list_concat({out}, {_span_sql(k, rule)})"
    return out


_WRITTEN = "coalesce(array_to_string(list_transform({0}, lambda x: x.kind || ':' || x.start || ':' || x.stop), ','), '')"
_BASE_SPANS = f"list_filter(s, lambda x: x.place < {len(secrets.BASE)})"
ORACLE["op8_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS (SELECT doc_id, list_sort({_spans_sql()}) AS s FROM d)
SELECT doc_id, {', '.join(f"CAST(len(list_filter(s, lambda x: x.kind = '{r.kind}')) AS BIGINT) AS n_{r.kind}" for r in secrets.BASE)},
  sha256({_WRITTEN.format(_BASE_SPANS)}) AS base_sha256, {_WRITTEN.format('s')} AS spans FROM f
"""


@query
def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(C.table(spark, folder, "documents"), C.tokenizer_path("piece_bpe_32k.model"))


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(C.table(spark, folder, "documents"), C.tokenizer_path("word_bpe_49k.json"), 2, with_ids=False)


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(C.table(spark, folder, "documents"), C.tokenizer_path("byte_bpe_50k.json"), C.tokenizer_path("piece_bpe_32k.model"))


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group(C.table(spark, folder, "documents"))


#: Checksums byte by byte from a table that the statement derives; near words by what is left of them without one code point.
ORACLE["op12_spelling_variants"] = """
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, list_transform(range(8), lambda k: CAST(0 AS BIGINT))),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents
), d AS (SELECT id, run, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY id, run
), b AS (
  SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)]
    ELSE [195, CAST(ord(c) - 64 AS BIGINT)] END)) AS bytes FROM d
), h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM b, tab
), o AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM h
), w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), e AS (
  SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM e a JOIN e b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT e.word, w.word, w.n FROM e JOIN w ON e.rest = w.word
  UNION SELECT w.word, e.word, e.n FROM e JOIN w ON e.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word
), f AS (
  SELECT word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM w LEFT JOIN best USING (word)
), path(word, root) AS (SELECT word, word FROM f UNION SELECT path.word, f.form FROM path JOIN f ON f.word = path.root WHERE f.form IS NOT NULL
), last AS (SELECT path.word, path.root FROM path JOIN f ON f.word = path.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN last USING (word)
"""


@query
def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.cluster(C.table(spark, folder, "documents"))


def _links_sql(words: int, percent: int) -> str:
    """Components of all links between sets of shingles, by reaching on from each document."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i+{words - 1}], ' ')) END) AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), reach(id, c) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT reach.id, pairs.b FROM reach JOIN pairs ON reach.c = pairs.a
), least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
"""


ORACLE["op13_ngram_join"] = _links_sql(3, 90) + "SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id FROM s JOIN least ON id = doc_id"
