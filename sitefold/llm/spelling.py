"""Spelling variants: pairs of words one edit apart, by composing the vocabulary's acceptor with a one-edit transducer and itself."""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm import common as C

#: A run of letters, and the divisor of the checksums that lose a code point.
RUN, MARKED = "[A-Za-z\\u00C0-\\u00FF]+", 97
#: Words of one partition's acceptor, and code points that they differ in at most: beyond either, enumeration starts from deeper states.
PARTITION, MIDDLE = 20_000, 64


def words_of(docs: DataFrame, *, least_length: int = 5, least_n: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, n: the distinct words of all whole texts and how often each occurs; runs whose checksum is marked lose a code point first."""
    run = F.explode(F.regexp_extract_all(C.ascii_lower(C.text_of(text_column)), F.lit(RUN), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), run)
    sums = runs.where(F.length("run") >= least_length).select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = sums.select(F.when(F.col("h") % MARKED == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


class Acceptor:
    """The minimised acyclic acceptor of a set of words: states are numbers, ``arcs[q]`` maps labels to states, ``final[q]`` ends a word."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        # Words come sorted; what a word does not share with the next one can take no further arc and is merged with an equal state.
        path: list[tuple[dict[str, int], bool, str]] = [({}, False, "")]

        def close(depth: int) -> None:
            while len(path) - 1 > depth:
                arcs, final, label = path.pop()
                path[-1][0][label] = self._state(known, arcs, final)

        last = ""
        for word in sorted(set(words)):
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            close(shared)
            for label in word[shared:]:
                path.append(({}, False, label))
            path[-1] = (path[-1][0], True, path[-1][2])
            last = word
        close(0)
        self.initial = self._state(known, *path[0][:2])
        self._shared: dict[tuple[int, int], list[str]] = {}

    def _state(self, known: dict[tuple, int], arcs: dict[str, int], final: bool) -> int:
        key = (final, tuple(sorted(arcs.items())))
        if key not in known:
            known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return known[key]

    def shared(self, p: int, q: int) -> list[str]:
        """What both states accept: the rest of a pair after its edit, where the transducer only copies."""
        if p > q:
            p, q = q, p
        known = self._shared.get((p, q))
        if known is None:
            known = [""] if self.final[p] and self.final[q] else []
            other = self.arcs[q]
            for label, to in self.arcs[p].items():
                if label in other:
                    known += [label + rest for rest in self.shared(to, other[label])]
            self._shared[(p, q)] = known
        return known

    def pairs(self) -> Iterator[tuple[str, str]]:
        """The pairs that acceptor o one edit o acceptor accepts, each in one order.

        Before the edit the transducer copies, so that both acceptors are in one state; in it, it replaces a label by another, or
        deletes one (inserting is the same pair in the other order); after it, it copies again.
        """
        waiting = [(self.initial, "")]
        while waiting:
            state, before = waiting.pop()
            arcs = self.arcs[state]
            labels = sorted(arcs)
            for k, x in enumerate(labels):
                to = arcs[x]
                for y in labels[k + 1 :]:
                    for rest in self.shared(to, arcs[y]):
                        yield before + x + rest, before + y + rest
                for rest in self.shared(to, state):
                    yield before + x + rest, before + rest
                waiting.append((to, before + x))


def partitions(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """key, word, n, left, right: words by the states from which their pairs are enumerated, about ``most`` to a partition.

    Two words one edit apart, the shorter of ``m`` code points, agree either on the first ``m // 2`` or on the last ``m - m // 2``: a
    partition holds the words of ``m`` or ``m + 1`` code points that reach one state of the acceptor (or of the reversed one) after so
    many. A larger partition, or one of longer words, is parted again: its pairs differ within the middle, so they agree on one half of
    that too. In the end a middle has one or two code points, and no partition more words than the square of the alphabet.
    """
    def keyed(rows: DataFrame) -> DataFrame:
        head, tail = F.left("word", F.col("left")), F.right("word", F.col("right"))
        return rows.select(F.concat_ws("/", F.col("m"), F.col("left"), F.col("right"), head, tail).alias("key"), "word", "n", "m", "left", "right")

    def parted(rows: DataFrame) -> DataFrame:
        middle = F.col("m") - F.col("left") - F.col("right")
        half = F.floor(middle / 2).cast("int")
        either = F.explode(F.array(F.struct((F.col("left") + half).alias("left"), F.col("right").alias("right")),
                                   F.struct(F.col("left").alias("left"), (F.col("right") + middle - half).cast("int").alias("right"))))
        return keyed(rows.select("word", "n", "m", either.alias("x")).select("word", "n", "m", "x.left", "x.right"))

    length = F.length("word")
    start = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"), F.lit(0).alias("left"), F.lit(0).alias("right")).where("m > 0")
    rows, done = C.written(parted(start), "acceptors"), []
    while True:
        middle = F.col("m") - F.col("left") - F.col("right")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        deeper = (middle > 1) & ((F.col("size") > most) | (middle > MIDDLE))
        known = C.written(rows.join(sizes, "key").withColumn("deeper", deeper), "acceptors")
        done.append(known.where("not deeper").select("key", "word", "n", "left", "right"))
        large = known.where("deeper")
        if large.isEmpty():
            return functools.reduce(DataFrame.unionByName, done)
        rows = C.written(parted(large), "acceptors")


def near_pairs(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """word, near, near_n: all ordered pairs of words that differ by one inserted, deleted or replaced code point."""

    def enumerated(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: list[tuple] = []
        names, types = ["word", "near", "near_n"], (pa.string(), pa.string(), pa.int64())

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)
            found.clear()
            return out

        def walk(held: dict[str, int], left: int, right: int) -> Iterator:
            sample = next(iter(held))
            before, after = sample[:left], sample[len(sample) - right :]
            for p, q in Acceptor([w[left : len(w) - right] for w in held]).pairs():
                p, q = before + p + after, before + q + after
                found.append((p, q, held[q]))
                found.append((q, p, held[p]))
                if len(found) >= 20_000:
                    yield batch()

        key, held, place = None, {}, (0, 0)
        for own, word, n, left, right in C.rows_of(batches, "key", "word", "n", "left", "right"):
            if own != key:
                if len(held) > 1:
                    yield from walk(held, *place)
                key, held, place = own, {}, (left, right)
            held[word] = n
        if len(held) > 1:
            yield from walk(held, *place)
        if found:
            yield batch()

    rows = partitions(words, most).repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(enumerated, C.schema(word="string", near="string", near_n="long")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where following ``form`` from each word of (word, form) ends. A form occurs at least twice as often, so paths end.

    Each round doubles the length of the steps, so it takes as many rounds as the logarithm of the longest path.
    """
    now = C.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = C.written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def group(docs: DataFrame, *, least_length: int = 5, least_n: int = 3, partition: int = PARTITION, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Words and the spelling each is a variant of: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters of at least ``least_length`` code points, A-Z lower-cased, that occur ``least_n`` times over all
    texts; a run whose checksum with the document's id is marked loses a code point first. A word's form is the most frequent word one
    edit away (ties: the smallest in code-point order), if it occurs at least twice as often, else null. ``root`` follows forms
    to the last one.

    Words are counted with partial sums, so a word of all documents is one small row per task. Pairs come from the composition of
    the vocabulary's minimised acceptor with a one-edit transducer and the acceptor again, in partitions by the state
    that an enumeration starts from; large ones start deeper, and none is bound to a task by its size.

    Null and empty texts have no words; a missing id is written as an empty one; rows that share an id or text count each. A run
    of any length is a word. An empty table gives no rows. Only the two named columns are read.
    """
    words = C.written(words_of(docs, least_length=least_length, least_n=least_n, id_column=id_column, text_column=text_column), "words")
    near = near_pairs(words, partition).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    form_n = -F.col("best.less")
    enough: Column = form_n >= 2 * F.col("n")
    found = C.written(words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, form_n).alias("form_n")), "forms")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
