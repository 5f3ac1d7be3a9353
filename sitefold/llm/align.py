"""Cross-tokenizer alignment: the tokens of two vocabularies coalesced over byte intervals, and links counted over the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from sitefold.llm import common as C

#: Characters after which a task aligns the texts gathered so far, and the most pairs whose counts are broadcast.
STRETCH, HEAD_PAIRS = 1 << 20, 1 << 20


def byte_tokens(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level vocabulary stands for."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    letters = {chr(c): b for b, c in C.BYTES.items()}
    names = [model.id_to_token(k) or "" for k in range(model.get_vocab_size())]
    return [b"".join(bytes([letters[x]]) if x in letters else x.encode("latin-1") if ord(x) < 256 else x.encode() for x in name) for name in names]


class Pieces(dict):
    """Ids of a sentencepiece vocabulary by chunk of text, bounded: a full cache starts anew.

    No piece holds a blank after another character, and (checked) none holds a line end, so the blanks before a word and each line
    end part a text into chunks whose ids do not depend on their neighbours. The model adds a blank before a text.
    """

    def __init__(self, path: str, limit: int = 600_000):
        import re

        import numpy as np
        import sentencepiece

        super().__init__()
        self.model, self.limit = sentencepiece.SentencePieceProcessor(model_file=path), limit
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        own = [k for k in range(len(names)) if not (self.model.is_byte(k) or self.model.is_control(k) or self.model.is_unknown(k))]
        splits = not any("\n" in names[k] or "▁" in names[k].lstrip("▁") for k in own)
        self.find = re.compile(r" *[^ \n]+| +|\n" if splits else r"(?s).+").findall
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]
        self.array = np.array

    def __missing__(self, chunk: str) -> bytes:
        # The model's own blank stands for the chunk's first one; a chunk without any follows a line end, whose two ids are cut off again.
        ids = self.model.encode(chunk[1:]) if chunk[0] == " " and len(chunk) > 1 and chunk.strip(" ") else self.after_line(chunk)
        out = self.array(ids, "<u4").tobytes()
        if len(chunk) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = out
        return out

    def after_line(self, chunk: str) -> list[int]:
        lead = self.model.encode("\n")
        ids = self.model.encode("\n" + chunk)
        return ids[len(lead):]

    def ids(self, text: str) -> bytes:
        """The ids of ``text``, which starts with the blank that the model would add."""
        return b"".join([self[c] for c in self.find(text)])


def coalesced(a_len, b_len):
    """Groups and overlaps of two tokenisations of the same bytes, from the tokens' lengths in order.

    Returns the group number of each A and B token, and the first and the last-but-one B token that each A token overlaps. All tokens
    are sorted by start; where a start reaches the highest end so far, both tokenisations end, and a group does.
    """
    import numpy as np

    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    a_start, b_start = a_end - a_len, b_end - b_len
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    first, stop = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    return group[: len(a_len)], group[len(a_len):], first, stop


def _written(n: int, first: int) -> list[str]:
    """How the ids are written after a comma, a bar and a semicolon."""
    return [f"{sign}{k}" for k in range(first, first + n) for sign in (",", "|", ";")]


def aligned(docs: DataFrame, byte_level: str, pieces: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times.

    ``pairs`` are the distinct linked id pairs of the document, ascending, each written as ``a * size of B + b``, and ``times`` how many
    links each has. No shuffle; a task holds the texts of about ``STRETCH`` characters at a time, or one longer text.
    """
    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        a_ids, b_ids, a_bytes = C.encoder(byte_level), Pieces(pieces), byte_tokens(byte_level)
        a_size, b_size = np.array([len(x) for x in a_bytes]), np.array([len(x) for x in b_ids.bytes])
        written = np.array([*_written(len(a_bytes), 0), *_written(len(b_ids.bytes), 0)], object)
        base_b, width = len(a_bytes), len(b_ids.bytes)
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

        def batch_of(held: list) -> pa.RecordBatch:
            n = len(held)
            n_a, n_b = (np.array([len(x) // 4 for x in side], np.int64) for side in ([h[1] for h in held], [h[2] for h in held]))
            a, b = (np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in ([h[1] for h in held], [h[2] for h in held]))
            digests, counted = [""] * n, np.zeros((2, n), np.int64)
            keys, times, cut = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
            if len(a):
                group_a, group_b, first, stop = coalesced(a_size[a], b_size[b])
                # A group is written A first: a token's place follows from its number and the other side's tokens of the groups before.
                in_a, in_b = np.bincount(group_a), np.bincount(group_b)
                before_b = np.cumsum(in_b) - in_b
                code = np.empty(len(a) + len(b), np.int64)
                sign_a, sign_b = np.full(len(a), 0), np.full(len(b), 0)
                sign_a[np.r_[True, group_a[1:] != group_a[:-1]]] = 2
                sign_b[np.r_[True, group_b[1:] != group_b[:-1]]] = 1
                code[np.arange(len(a)) + before_b[group_a]] = a * 3 + sign_a
                code[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = (b + base_b) * 3 + sign_b
                doc_a = np.repeat(np.arange(n), n_a)
                link = stop - first
                counted[0] = np.bincount(doc_a[sign_a == 2], minlength=n)
                counted[1] = np.bincount(doc_a, weights=link, minlength=n).astype(np.int64)
                text = written[code]
                at = 0
                for k, size in enumerate((n_a + n_b).tolist()):
                    if size:
                        digests[k] = hashlib.sha256("".join(text[at : at + size].tolist())[1:].encode()).hexdigest()
                    at += size
                other = np.arange(link.sum()) - np.repeat(np.cumsum(link) - link, link) + np.repeat(first, link)
                both = np.sort((np.repeat(doc_a, link) << 40) | (np.repeat(a, link) * width + b[other]))
                new = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
                times = np.diff(np.r_[new, len(both)])
                keys = both[new] & ((1 << 40) - 1)
                cut = np.searchsorted(both[new] >> 40, np.arange(n + 1))
            cut = pa.array(cut, pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.array([h[0] for h in held], pa.int64()), pa.array(n_a), pa.array(n_b), pa.array(counted[0]), pa.array(counted[1]), pa.array(digests),
                pa.ListArray.from_arrays(cut, pa.array(keys, pa.int64())), pa.ListArray.from_arrays(cut, pa.array(times, pa.int64()))], names=names)

        held, size = [], 0
        for doc, text in C.rows_of(batches, "id", "text"):
            a = b = b""
            if text:
                raw = " " + text
                a, b = a_ids.ids(raw), b_ids.ids(raw)
                same = raw.encode()
                for ids, known in ((a, a_bytes), (b, b_ids.bytes)):
                    if b"".join([known[k] for k in memoryview(ids).cast("I")]) != same:
                        a = b = b""
                        break
            held.append((doc, a, b))
            size += len(text or "") + 16
            if size >= STRETCH:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return picked.mapInArrow(rows, C.schema(doc_id="long", n_a="long", n_b="long", n_groups="long", n_links="long", groups_sha256="string", pairs="array<bigint>", times="array<bigint>"))


def pair_counts(documents: DataFrame, width: int) -> DataFrame:
    """pair, c, best: in how many documents each linked pair occurs, and whether no pair of its A id occurs in more."""
    counts = C.written(documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("c")), "pair-counts")
    a = F.floor(F.col("pair") / F.lit(width)).alias("a")
    # One row per A id: no larger than the vocabulary.
    highest = counts.groupBy(a).agg(F.max("c").alias("top"))
    return C.written(counts.select("pair", "c", a).join(highest, "a").select("pair", "c", (F.col("c") == F.col("top")).alias("best")), "pair-counts")


def head_of(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of the highest counts, at most ``most``, and all others."""
    held, at_least = 0, None
    sizes = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(most).toLocalIterator()
    for r in sizes:
        held += r["n"]
        if held > most:
            break
        at_least = r["c"]
    own = F.lit(False) if at_least is None else F.col("c") >= at_least
    return counts.where(own), counts.where(~own)


def align(docs: DataFrame, byte_level: str, pieces: str, *, head_pairs: int = HEAD_PAIRS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Two tokenisations of each whole text, aligned by interval coalescing: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A tokens come from a byte-level vocabulary for a blank and the text, B tokens from a sentencepiece vocabulary for the text (it
    adds the blank). Byte offsets where tokens of both sides end part them into groups; two tokens whose byte ranges overlap are
    linked. An id pair counts the documents that hold it linked; ``n_best`` counts links whose pair has the highest count of
    its A id (ties included), ``count_sum`` adds the counts over the links.

    Each document's distinct pairs are written once and counted with partial sums, so a pair of all documents is one small row per
    task. The most frequent pairs, at most ``head_pairs``, are broadcast; each other pair of a document joins its count by a
    shuffle, so the result is exact at any number of pairs.

    A null or empty text, and one whose tokens do not spell a blank and the text (a U+2581 in it, say), has no tokens: zeros and an
    empty ``groups_sha256``. Texts of any length are aligned whole. Rows that share an id, or have none, are documents
    of their own, and ties among pairs all count as highest. An empty table gives no rows. Only the two named columns are read.
    """
    import sentencepiece

    spark = docs.sparkSession
    width = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    documents = C.written(aligned(docs, byte_level, pieces, id_column=id_column, text_column=text_column), "aligned")
    head, rare = head_of(pair_counts(documents, width), head_pairs)
    known = head.orderBy("pair").toPandas()
    shared = spark.sparkContext.broadcast(tuple(known[c].to_numpy(t) for c, t in (("pair", "int64"), ("c", "int64"), ("best", "bool"))))

    def of_head(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        keys, counts, best = shared.value
        row = TaskContext.get().partitionId() << 33
        plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False)
                sizes = np.array([len(x) for x in pairs], np.int64)
                cut, own = np.r_[0, np.cumsum(sizes)], pairs.flatten().to_numpy(zero_copy_only=False)
                place = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
                hit = keys[place] == own if len(keys) else np.zeros(len(own), bool)
                weight = np.where(hit, times, 0)
                total = [np.r_[0, np.cumsum(weight * x[place] if len(keys) else weight)] for x in (best, counts)]
                left = np.r_[0, np.cumsum(~hit)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + batch.num_rows)), *[batch.column(c) for c in plain], *[pa.array((t[cut[1:]] - t[cut[:-1]]).astype(np.int64)) for t in total],
                     pa.ListArray.from_arrays(pa.array(left[cut], pa.int32()), pa.array(own[~hit], pa.int64())),
                     pa.ListArray.from_arrays(pa.array(left[cut], pa.int32()), pa.array(times[~hit], pa.int64()))],
                    names=["row", *plain, "best", "total", "pairs", "times"])
                row += batch.num_rows

    fields = C.schema(row="long", doc_id="long", n_a="long", n_b="long", n_groups="long", n_links="long", groups_sha256="string", best="long", total="long", pairs="array<bigint>", times="array<bigint>")
    looked = C.written(documents.mapInArrow(of_head, fields), "looked-up")
    tail = looked.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    tail = tail.join(rare.hint("merge"), "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("b"), F.sum(F.col("n") * F.col("c")).alias("t"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return looked.join(tail, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("best") + zero("b")).alias("n_best"), (F.col("total") + zero("t")).alias("count_sum"), "groups_sha256")
