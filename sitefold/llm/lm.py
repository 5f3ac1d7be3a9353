"""Language-model scoring: smoothed word counts, and the likelihood of all subword segmentations."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from sitefold.llm import common as C

ALPHA = 0.1
#: What the vocabulary file writes for the blank before a word.
MARK = "▁"
#: Code points of the longest word that is broadcast.
LONGEST = 64


def pieces_of(path: str) -> list[str]:
    """The pieces of a sentencepiece vocabulary, in the order of its scores (best first)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    order = sorted(range(model.get_piece_size()), key=lambda k: (-model.get_score(k), k))
    return [model.id_to_piece(k) for k in order if not model.is_control(k) and not model.is_unknown(k)]


class Lattice:
    """Marginal probability of a word over all its segmentations into weighted pieces.

    ``weights`` are natural logarithms. A character that is no piece is written by the pieces of its UTF-8 bytes.
    """

    def __init__(self, weights: dict[str, float], byte_weights: list[float]):
        self.weights, self.bytes = weights, byte_weights
        self.longest = max(map(len, weights), default=1)
        self.starts = {p[0] for p in weights}

    def arcs(self, text: str) -> Iterator[tuple[int, list[tuple[int, float]]]]:
        """For each end, the pieces that end there: (start, weight)."""
        get, longest = self.weights.get, self.longest
        for j in range(1, len(text) + 1):
            found = []
            for i in range(max(0, j - longest), j):
                w = get(text[i:j])
                if w is not None:
                    found.append((i, w))
            if not found or found[-1][0] != j - 1:
                found.append((j - 1, sum(self.bytes[b] for b in text[j - 1].encode("utf-8", "surrogatepass"))))
            yield j, found

    def forward(self, text: str) -> float:
        """Natural logarithm of the sum over all segmentations, by forward recursion in log space."""
        exp, log, get, bytes_ = math.exp, math.log, self.weights.get, self.bytes
        n = len(text)
        alpha = [0.0] * (n + 1)
        longest = self.longest
        for j in range(1, n + 1):
            terms = []
            last = None
            for i in range(j - longest if j > longest else 0, j):
                last = get(text[i:j])
                if last is not None:
                    terms.append(alpha[i] + last)
            if last is None:
                terms.append(alpha[j - 1] + sum([bytes_[b] for b in text[j - 1].encode("utf-8", "surrogatepass")]))
            top = max(terms)
            alpha[j] = top if len(terms) == 1 else top + log(sum([exp(t - top) for t in terms]))
        return alpha[n]


def word_counts(docs: DataFrame, text_column: str, training: str) -> DataFrame:
    """word, c: how often each word occurs in training documents (0 for words of the others), over whole texts."""
    words = docs.select(training, F.explode(C.words_of(C.ascii_lower(C.text_of(text_column)))).alias("word"))
    return words.groupBy("word").agg(F.sum(F.col(training).cast("long")).alias("c"))


def piece_weights(counts: DataFrame, vocabulary: str, ends: int) -> tuple[dict[str, float], list[float], float]:
    """Natural logarithms of the pieces' probabilities, of the bytes' and of the end's.

    The vocabulary file's own scores rank merges; to weigh segmentations they are turned into probabilities by counting, over
    all training words, the pieces of each word's segmentation by that file, smoothed. As many numbers as the vocabulary
    has pieces reach the driver.
    """
    def segmented(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        total: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                for ids, c in zip(model.encode(part.column("word").to_pylist(), num_threads=1), part.column("c").to_pylist(), strict=True):
                    for k in ids:
                        total[k] += c
        if total:
            yield pa.RecordBatch.from_pydict({"piece": [model.id_to_piece(k) for k in total], "n": list(total.values())})

    found = {r["piece"]: r["n"] for r in counts.where("c > 0").mapInArrow(segmented, C.schema(piece="string", n="long")).groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    pieces = pieces_of(vocabulary)
    total = sum(found.get(p, 0) for p in pieces) + ends + ALPHA * (len(pieces) + 1)
    weights = {p: math.log((found.get(p, 0) + ALPHA) / total) for p in pieces}
    plain = {p: w for p, w in weights.items() if not (len(p) == 6 and p.startswith("<0x") and p.endswith(">"))}
    floor = math.log(ALPHA / total)
    return plain, [weights.get(f"<0x{b:02X}>", floor) for b in range(256)], math.log((ends + ALPHA) / total)


def head_and_rest(words: DataFrame, head_words: int) -> tuple[dict[str, tuple[int, float]], DataFrame]:
    """The most frequent words (word -> c, p), at most ``head_words`` and none beyond ``LONGEST``, and all others as a table."""
    short = F.length("word") <= LONGEST
    # The least count at which the words that occur as often fit the bound; there are few distinct counts above it.
    at_least, held = None, 0
    frequent = words.where((F.col("c") > 1) & short).groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(head_words)
    for r in frequent.collect():
        held += r["n"]
        if held > head_words:
            break
        at_least = r["c"]
    if at_least is None:
        return {}, words
    own = (F.col("c") >= at_least) & short
    return {r["word"]: (r["c"], r["p"]) for r in words.where(own).collect()}, words.where(~own)


def score(docs: DataFrame, vocabulary: str, *, head_words: int = 1 << 17, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32 of the id, modulo 10, is not 0 are learned from (and rows without an id). Tokens are the words of the
    lower-cased text and one end. ``base_score`` is the smoothed unigram log10 probability; ``score`` the log10 probability
    under a subword unigram model, summed over all segmentations of each word (forward recursion), times that of the end.

    Word counts and each distinct word's lattice are computed once, over all texts. The most frequent words of up to ``LONGEST``
    code points, at most ``head_words``, are broadcast with their count and score, which covers most tokens; every other word of a document is joined
    with the table of words by a shuffle, so the result is exact at any size. Copies of a hot document spread over the join by
    their own words' hashes, and equal words of a document are summed before it.

    A null text is the empty text: one end token. Rows that repeat an id stay rows. An empty table gives no rows. Only the two
    named columns are read.
    """
    spark = docs.sparkSession
    checksum = F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(1))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), C.text_of(text_column).alias("text"), (checksum % 10 != 0).alias("training"))
    counts = C.written(word_counts(rows, "text", "training"), "word-counts")
    ends = rows.agg(F.coalesce(F.sum(F.col("training").cast("long")), F.lit(0)).alias("n")).first()["n"]
    known = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    total, distinct = known["n"] + ends, (known["v"] or 0) + (ends > 0)
    model = spark.sparkContext.broadcast(piece_weights(counts, vocabulary, ends))

    def marginals(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights, byte_weights, _ = model.value
        lattice = Lattice(weights, byte_weights)
        for batch in batches:
            out = [lattice.forward(MARK + w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(out, pa.float64())], names=["word", "c", "p"])

    words = C.written(counts.mapInArrow(marginals, C.schema(word="string", c="long", p="double")), "words")
    head, rare = head_and_rest(words, head_words)
    shared = spark.sparkContext.broadcast(head)
    scale = total + ALPHA * (distinct + 1)

    def of_head(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa
        from pyspark import TaskContext

        find, get, log10 = re.compile(C.WORD).findall, shared.value.get, math.log10
        row = TaskContext.get().partitionId() << 33
        base = {w: log10((c + ALPHA) / scale) for w, (c, _) in shared.value.items()}
        columns: list[list] = [[] for _ in range(7)]
        arrow = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string())]
        names = ["row", "doc_id", "training", "n_head", "base", "p", "tail"]
        held = 0
        for doc, training, text in C.rows_of(batches, "doc_id", "training", "text"):
            n, b, p, tail = 0, 0.0, 0.0, []
            for w in find(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):
                x = get(w)
                if x is None:
                    tail.append(w)
                else:
                    n, b, p = n + 1, b + base[w], p + x[1]
            for column, value in zip(columns, (row, doc, training, n, b, p, tail), strict=True):
                column.append(value)
            row, held = row + 1, held + len(tail)
            if held > 200_000 or len(columns[0]) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow, strict=True)], names=names)
                columns, held = [[] for _ in range(7)], 0
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow, strict=True)], names=names)

    scored = C.written(rows.mapInArrow(of_head, C.schema(row="long", doc_id="long", training="boolean", n_head="long", base="double", p="double", tail="array<string>")), "scored")
    tail = scored.select("row", F.explode("tail").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
    tail = tail.join(rare, "word").groupBy("row").agg(
        F.sum("n").alias("t"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.col("n") * F.log10((F.col("c") + ALPHA) / scale)).alias("b"), F.sum(F.col("n") * F.col("p")).alias("tp"))
    zero = lambda c, x: F.coalesce(F.col(c), F.lit(x))
    return scored.join(tail, "row", "left").select(
        "doc_id", (~F.col("training")).alias("held_out"), (F.col("n_head") + zero("t", 0) + 1).alias("n_tokens"),
        (F.col("n_head") + zero("k", 0) + int(ends > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("b", 0.0) + math.log10((ends + ALPHA) / scale)).alias("base_score"),
        ((F.col("p") + zero("tp", 0.0) + model.value[2]) / math.log(10)).alias("score"))
