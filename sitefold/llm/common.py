"""Helpers shared by the operators of this package."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from sitefold.operators.lineage import shared_folder

#: A word, as the contracts of this package define it: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The ASCII white space that separates words.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_words_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before this one, in the order of ``order``.

    A prefix sum in two steps: rows are dealt into ranges, each range is summed on its own, and the
    sums of the ranges (as many rows as there are ranges) give each range its base.
    """
    ranged = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    bases = ranged.groupBy("__range").agg(F.sum(value).alias("__sum")).select(
        F.col("__range"), F.coalesce(F.sum("__sum").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    inside = F.coalesce(F.sum(value).over(W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (ranged.withColumn("__inside", inside).join(bases, "__range")
            .withColumn(name, (F.col("__base") + F.col("__inside")).cast("long")).drop("__range", "__inside", "__base"))


class PieceCache(dict):
    """Token ids by chunk of text, bounded: a full cache starts anew.

    Between two chunks the pre-tokenizer never joins text, so that the ids of a text are those of its
    chunks one after another; a chunk that the corpus repeats is encoded once per Python worker.
    """

    def __init__(self, path: str, pattern: str, limit: int = 600_000):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.find, self.limit, self.model = re.compile(pattern).findall, limit, self.tokenizer.model
        name = os.path.basename(path)
        self.plain = re.compile(PLAIN.get(name, r"(?!)")).fullmatch
        self.known = name in PLAIN
        self.lower = self.tokenizer.normalizer is not None

    def __missing__(self, chunk: str) -> bytes:
        bare = chunk.lower() if self.lower else chunk
        # One run of one kind is one pre-token, on which the model alone has a say.
        if self.known and chunk.isascii() and chunk.lstrip(" ").isalpha() and (chunk[0] != " " or chunk[1] != " "):
            found = [t.id for t in self.model.tokenize(bare.replace(" ", BLANK_BYTE))]
        elif self.plain(chunk):
            found = [t.id for t in self.model.tokenize(bare.encode().decode("latin-1").translate(BYTES))]
        else:
            found = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(chunk) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        """The ids of the whole text as little-endian unsigned 32-bit integers."""
        return b"".join([self[c] for c in self.find(text)]) if text else b""


#: Unicode white space, the set on which both pre-tokenizers split.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", "!-&(-/:-@\\[-`{-~"
#: Chunks by tokenizer file. Both pre-tokenizers part letters, digits and signs, so a run of plain letters or signs
#: that one of the others or white space ends is a chunk; any other word is one as a whole (with an apostrophe,
#: say), and so is a run of white space where it counts.
CHUNKS = {
    "byte_bpe_50k.json": f" ?[{_LETTERS}]+(?=[{SPACE}{_SIGNS}0-9]|\\Z)| ?[{_SIGNS}]+(?=[{SPACE}{_LETTERS}0-9]|\\Z)"
                         f"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+",
    "word_bpe_49k.json": f"[{_LETTERS}]+(?=[{SPACE}{_SIGNS}0-9]|\\Z)|[{_SIGNS}]+(?=[{SPACE}{_LETTERS}0-9]|\\Z)|[^{SPACE}]+",
}
#: Chunks that are one pre-token, and the letters by which byte-level vocabularies write bytes that do not print.
PLAIN = {"byte_bpe_50k.json": f" ?(?:[{_LETTERS}]+|[{_SIGNS}]+)", "word_bpe_49k.json": f"[{_LETTERS}]+|[{_SIGNS}]+"}
BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}
BLANK_BYTE = chr(BYTES[32])
_CACHES: dict[str, PieceCache] = {}


def encoder(path: str) -> PieceCache:
    """The cache of this Python worker for the tokenizer file at ``path``."""
    if path not in _CACHES:
        import os

        # A file of unknown pre-tokenizer is given each text as one chunk.
        _CACHES[path] = PieceCache(path, CHUNKS.get(os.path.basename(path), r"(?s).+"))
    return _CACHES[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def rows_of(batches: Iterable, *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches, a slice of each batch at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*[part.column(c).to_pylist() for c in columns], strict=True)


def schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in fields.items()])
