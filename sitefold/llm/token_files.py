"""Token-id files: flat unsigned integers plus 64-bit document offsets, read through memory maps.

A folder holds, per shard ``k``:

``shard-kkkkkk.bin``  the ids of its documents one after another, little-endian unsigned 16 or 32 bit
``shard-kkkkkk.off``  ``n + 1`` little-endian unsigned 64-bit offsets into all ids of the folder
``shard-kkkkkk.doc``  ``n`` little-endian signed 64-bit document ids (rows without one come first; their number is in the manifest)

and ``manifest`` (Parquet): shard, n_docs, n_null, n_tokens, and the bases ``doc_base`` and ``base``.
Shards follow one another in ascending document id.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window as W, functions as F

from sitefold.llm import common as C

DTYPES = {"uint16": "<u2", "uint32": "<u4"}


def local_path(folder: str) -> str:
    """The mounted path of ``folder``. Memory maps need a file system that driver and executors mount alike."""
    scheme, colon, rest = folder.partition(":")
    if colon and "/" not in scheme:
        if scheme != "file":
            raise ValueError(f"token files are memory-mapped; {folder} is in a store that cannot be mounted")
        return "/" + rest.lstrip("/")
    return folder


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, *, dtype: str = "uint32", id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write the files below ``folder`` and return the manifest.

    Documents are dealt into ranges of ascending id, and each task streams its range into one shard: no
    task holds more than a batch. A shard is written under a name of its attempt and then renamed, so that
    a repeated or speculative task leaves the same file. Offsets get their base from the prefix sum of the
    shards' sizes (one row per shard).

    A null text is the empty text (one end id); rows without an id come first; rows that share an id stay
    rows of their own, in the order of their text's hash. An empty table gives an empty manifest. Columns
    other than the two named are not read, so they may have any name.
    """
    place, kind = local_path(folder), DTYPES[dtype]

    def shards(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        ctx = TaskContext.get()
        shard, own = ctx.partitionId(), f".{ctx.taskAttemptId()}.part"
        encode, end = C.encoder(tokenizer), np.asarray([end_id], "<u4").tobytes()
        os.makedirs(place, exist_ok=True)
        stem = f"{place}/shard-{shard:06d}"
        n_docs = n_null = n_tokens = 0
        with open(f"{stem}.bin{own}", "wb") as ids_file, open(f"{stem}.len{own}", "wb") as len_file, open(f"{stem}.doc{own}", "wb") as doc_file:
            for doc, text in C.rows_of(batches, "id", "text"):
                ids = np.frombuffer(encode.ids(text) + end, "<u4")
                if kind == "<u2" and ids.max() > 65535:
                    raise ValueError("an id does not fit 16 bits")
                ids_file.write(ids.astype(kind).tobytes())
                len_file.write(np.asarray([len(ids)], "<u8").tobytes())
                doc_file.write(np.asarray([doc or 0], "<i8").tobytes())
                n_docs, n_null, n_tokens = n_docs + 1, n_null + (doc is None), n_tokens + len(ids)
        for part in ("bin", "len", "doc"):
            os.replace(f"{stem}.{part}{own}", f"{stem}.{part}")
        if n_docs:
            yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [n_docs], "n_null": [n_null], "n_tokens": [n_tokens]})

    picked = docs.select(F.col(id_column).cast("long").alias("id"), C.text_of(text_column).alias("text"))
    ranged = picked.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    sizes = C.written(ranged.select("id", "text").mapInArrow(shards, C.schema(shard="long", n_docs="long", n_null="long", n_tokens="long")), "shards")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    manifest = sizes.select("*", F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("doc_base"), F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def offsets(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                stem, own = f"{place}/shard-{shard:06d}", f".{os.getpid()}.{os.urandom(4).hex()}.part"
                lengths = np.fromfile(f"{stem}.len", "<u8")
                at = np.zeros(len(lengths) + 1, "<u8")
                np.cumsum(lengths, out=at[1:])
                (at + np.uint64(base)).tofile(f"{stem}.off{own}")
                os.replace(f"{stem}.off{own}", f"{stem}.off")
            yield batch

    # A number of tasks of its own: a manifest row is tiny, but stands for a whole shard.
    manifest.repartitionByRange(max(1, sizes.count()), "shard").mapInArrow(offsets, manifest.schema).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


class Shard:
    """One shard, memory-mapped."""

    def __init__(self, folder: str, shard: int, dtype: str = "uint32"):
        import numpy as np

        stem = f"{local_path(folder)}/shard-{shard:06d}"
        self.offsets = np.memmap(f"{stem}.off", "<u8", "r")
        self.docs = np.memmap(f"{stem}.doc", "<i8", "r")
        self.ids = np.memmap(f"{stem}.bin", DTYPES[dtype], "r")

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, k: int):
        base = int(self.offsets[0])
        return self.ids[int(self.offsets[k]) - base : int(self.offsets[k + 1]) - base]


def read(manifest: DataFrame, folder: str, *, dtype: str = "uint32", with_ids: bool = True) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids. A task reads about one shard."""

    def documents(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for shard, nulls in zip(batch.column("shard").to_pylist(), batch.column("n_null").to_pylist(), strict=True):
                files = Shard(folder, shard, dtype)
                for at in range(0, len(files), 1024):
                    some = range(at, min(at + 1024, len(files)))
                    ids = [np.asarray(files[k], "<u4") for k in some]
                    out = {"doc_id": pa.array([None if k < nulls else int(files.docs[k]) for k in some], pa.int64()),
                           "start": pa.array(files.offsets[some.start : some.stop].astype("i8")),
                           "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                           "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())}
                    if with_ids:
                        out["ids"] = pa.array([x.astype("i8") for x in ids], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)

    fields = {"doc_id": "long", "start": "long", "n_tokens": "long", "ids_crc32": "long"} | ({"ids": "array<long>"} if with_ids else {})
    return manifest.select("shard", "n_null").repartitionByRange(max(1, manifest.count()), "shard").mapInArrow(documents, C.schema(**fields))
