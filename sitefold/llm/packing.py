"""Cost-balanced packing of token ids into sequences."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from sitefold.llm import common as C


def capacities(total: int, size: int) -> list[int]:
    """Sequences that hold ``total`` ids without padding: full ones, and powers of two for the rest."""
    return [size] * (total // size) + [1 << b for b in reversed(range((total % size).bit_length())) if total % size >> b & 1]


def assign(lengths: list[int], size: int, linear: float = 1.0, quadratic: float = 1.0) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a block of documents.

    Documents longer than a sequence are cut at its size. Then the pieces are taken from the longest to the shortest, ties in
    order: each goes to the sequence of lowest cost among those with room for all of it, where a piece of ``n`` ids costs
    ``linear * n + quadratic * n * n / size`` (attention within the piece). If no sequence has room, the piece is cut: the
    roomiest sequence is filled, and the rest waits its turn as a shorter piece. All sequences end up full.
    """
    room = capacities(sum(lengths), size)
    waiting: list[tuple[int, int, int]] = []
    for doc, n in enumerate(lengths):
        waiting += [(-min(size, n - at), doc, at) for at in range(0, n, size)]
    heapq.heapify(waiting)
    cost, used = [0.0] * len(room), [0] * len(room)
    # Open sequences by cost; a sequence with too little room for this piece has it for a later, shorter one.
    opened = [(0.0, k) for k in range(len(room))]
    heapq.heapify(opened)
    by_room: list[tuple[int, int]] = [(-r, k) for k, r in enumerate(room)]
    heapq.heapify(by_room)
    aside: list[list[tuple[float, int]]] = [[] for _ in range(size.bit_length() + 1)]
    placed = []
    while waiting:
        n, doc, at = heapq.heappop(waiting)
        n = -n
        # Pieces come in descending length: what was set aside for too little room may fit from here on.
        for level in range(n.bit_length(), len(aside)):
            if aside[level]:
                for entry in aside[level]:
                    heapq.heappush(opened, entry)
                aside[level] = []
        best, tight = None, []
        while opened:
            c, k = heapq.heappop(opened)
            left = room[k] - used[k]
            if c != cost[k] or not left:
                continue
            if left >= n:
                best = k
                break
            if left.bit_length() < n.bit_length():
                aside[left.bit_length()].append((c, k))
            else:
                tight.append((c, k))
        for entry in tight:
            heapq.heappush(opened, entry)
        take = n
        if best is None:
            while True:
                r, k = heapq.heappop(by_room)
                left = room[k] - used[k]
                if left and -r == left:
                    best, take = k, min(left, n)
                    break
                if left:
                    heapq.heappush(by_room, (-left, k))
            heapq.heappush(waiting, (-(n - take), doc, at + take)) if n > take else None
        placed.append((doc, at, take, best, used[best]))
        used[best] += take
        cost[best] += linear * take + quadratic * take * take / size
        if used[best] < room[best]:
            heapq.heappush(opened, (cost[best], best))
            heapq.heappush(by_room, (-(room[best] - used[best]), best))
    return placed


def pack(docs: DataFrame, tokenizer: str, end_id: int, *, size: int = 4096, block_tokens: int = 1 << 20, linear: float = 1.0,
         quadratic: float = 1.0, with_ids: bool = True, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Sequences of at most ``size`` ids, one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Each task encodes its documents and packs them in blocks of about ``block_tokens`` ids, so nothing is shuffled, memory is
    bounded by a block (or one document), and a lost task is repeated alone. A block's sequences are full: what does not fill
    ``size`` is laid out in powers of two, which need no padding. ``sequence_id`` numbers the sequences within a task's range
    of 2**36 ids.

    A null text is the empty text: one end id. Rows without a doc_id, or that share one, are packed like others. An empty
    table gives no row. Columns other than the two named are not read.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")

    def pieces(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, end = C.encoder(tokenizer), np.asarray([end_id], "<u4").tobytes()
        first = TaskContext.get().partitionId() << 36

        def packed(block: list) -> Iterator:
            nonlocal first
            out = assign([len(x) // 4 for _, x in block], size, linear, quadratic)
            # A document's pieces share the block's byte strings; batches bound what is turned into rows at once.
            for at in range(0, len(out), 2048):
                some = out[at : at + 2048]
                cut = [block[d][1][4 * s : 4 * (s + n)] for d, s, n, _, _ in some]
                columns = {
                    "doc_id": pa.array([block[d][0] for d, *_ in some], pa.int64()),
                    "start": pa.array([s for _, s, *_ in some], pa.int64()),
                    "length": pa.array([n for _, _, n, _, _ in some], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                    "doc_tokens": pa.array([len(block[d][1]) // 4 for d, *_ in some], pa.int64()),
                    "sequence_id": pa.array([first + k for *_, k, _ in some], pa.int64()),
                    "offset": pa.array([o for *_, o in some], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype("i8") for x in cut], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)
            first += 1 + max(k for *_, k, _ in out)

        block, held = [], 0
        for doc, text in C.rows_of(batches, "id", "text"):
            block.append((doc, encode.ids(text) + end))
            held += len(block[-1][1]) // 4
            if held >= block_tokens:
                yield from packed(block)
                block, held = [], 0
        if block:
            yield from packed(block)

    fields = {k: "long" for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")} | ({"ids": "array<long>"} if with_ids else {})
    picked = docs.select(F.col(id_column).cast("long").alias("id"), C.text_of(text_column).alias("text"))
    return picked.mapInArrow(pieces, C.schema(**fields))
