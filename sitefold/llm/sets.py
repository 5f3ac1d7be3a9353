"""Sets of word shingles: hashing, group counts as points, verification on full texts, and components of links."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from sitefold.llm import common as C


class Shingler:
    """Sets of 64-bit shingle hashes of whole texts."""

    def __init__(self, k: int, limit: int = 500_000):
        import re

        self.find, self.k, self.limit, self.words = re.compile(C.WORD).findall, k, limit, {}

    def shingles(self, text: str | None):
        """Sorted distinct hashes; a text of fewer than k words has its whole sequence as one."""
        import numpy as np
        import xxhash

        own = self.find((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
        if not own:
            return np.zeros(0, np.uint64)
        cache, digest = self.words, xxhash.xxh64_intdigest
        if len(cache) > self.limit:
            cache.clear()
        hashes = []
        for w in own:
            h = cache.get(w)
            if h is None:
                h = cache[w] = digest(w.encode("utf-8", "surrogatepass"))
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        n = min(self.k, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for j in range(n):  # order counts: multiply between words
            out = (out ^ h[j : len(h) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)


def spread(n: int) -> int:
    """Coordinates of a point: a power of two, about a fourth of the set's size."""
    return 1 << max(4, min(14, (n // 4).bit_length()))


def kind(n: int) -> str:
    """How the counts of a set of ``n`` are written."""
    return "<u2" if n < 1 << 16 else "<u4"


def point_of(shingles):
    """The counts of a set's shingles by group of their hash, as bytes. No set shares more than the sum of the smaller counts."""
    import numpy as np

    n = len(shingles)
    return np.bincount((shingles % np.uint64(spread(n))).astype(np.int64), minlength=spread(n)).astype(kind(n)).tobytes()


def counts_of(point: bytes, n: int, width: int):
    """A point's counts in ``width`` coordinates, at most its own: groups by fewer bits of the same hash."""
    import numpy as np

    return np.frombuffer(point, kind(n)).astype(np.int64).reshape(-1, width).sum(0)


def sketch_of(shingles):
    """Parities of a set's shingles by group of their hash, as bits: a power of two of them, at least twice the set's size.

    Each shingle that only one of two sets holds toggles one bit, so sets differ in no fewer shingles than their sketches in bits.
    """
    import numpy as np

    width = sketch_bits(len(shingles))
    return np.packbits((np.bincount((shingles % np.uint64(width)).astype(np.int64), minlength=width) & 1).astype(bool)).tobytes()


def sketch_bits(n: int) -> int:
    return 1 << max(6, min(16, (2 * n - 1).bit_length()))


def unlike_sets(n: int, x: bytes, m: int, y: bytes, percent: int) -> int | None:
    """In how many bits two sketches differ, or None if their sets cannot be linked."""
    if 100 * min(n, m) < percent * max(n, m):
        return None
    a, b, wide, narrow = int.from_bytes(x, "little"), int.from_bytes(y, "little"), len(x), len(y)
    if wide < narrow:
        a, b, wide, narrow = b, a, narrow, wide
    while wide > narrow:  # fold the wider one: groups by one bit less of the hash
        wide //= 2
        a = (a >> 8 * wide) ^ (a & (1 << 8 * wide) - 1)
    differ = (a ^ b).bit_count()
    return differ if (100 + percent) * differ <= (100 - percent) * (n + m) else None


def may_link(sketches_a, sizes_a, sketches_b, sizes_b, percent: int):
    """Which of two lists of sketches (rows of 64-bit words, equally wide) may be of linked sets: a matrix of booleans."""
    import numpy as np

    differ = np.zeros((len(sizes_a), len(sizes_b)), np.int64)
    for word in range(sketches_a.shape[1]):  # one word of all pairs at a time
        differ += np.bitwise_count(sketches_a[:, word, None] ^ sketches_b[None, :, word])
    both = sizes_a[:, None] + sizes_b[None, :]
    fits = 100 * np.minimum(sizes_a[:, None], sizes_b[None, :]) >= percent * np.maximum(sizes_a[:, None], sizes_b[None, :])
    return fits & ((100 + percent) * differ <= (100 - percent) * both)


def strongest(x, y, unlike):
    """Numbers of the pairs (x, y) that are the least unlike ones of either end: no more than two for each node."""
    import numpy as np

    chosen = np.zeros(len(x), bool)
    for end in (x, y):
        order = np.lexsort((unlike, end))
        chosen[order[np.r_[True, end[order][1:] != end[order][:-1]]]] = True
    return np.flatnonzero(chosen)


def sketches(rows: list[tuple[int, bytes]]):
    """Sketches given as (size, bytes) as an array of 64-bit words: all as wide as the narrowest, to which the others are folded."""
    import numpy as np

    width = min(len(x) for _, x in rows) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, "<u8").reshape(-1, width), axis=0) for _, x in rows])


#: Pairs a member that one cell gives in full; a cell of more gives each member's best one first.
GIVEN = 8


def in_cells(members: DataFrame, nodes: DataFrame, block: int, joined) -> DataFrame:
    """Pairs (a, b, unlike, cut) with a < b that ``joined`` finds among the members (key, node, c) of each key; ``nodes`` holds node, n and brief.

    A key of more than ``block`` members is dealt into blocks, and every two blocks meet in a cell of their own, so that no task
    holds more than two blocks. Briefs join the cells, after all that needs keys only, so they travel once. ``joined(low, high)`` gets lists of
    (node, c, n, brief), ``high`` being None for a block and itself, and gives (a, b, unlike, whether the cell has more pairs); ``cut`` is
    the key of a cell that has more, else null.
    """
    def cells(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        at, low, high = None, [], []

        def found() -> Iterator:
            parts = (joined(low, None) if len(low) > 1 else ()) if at[1] == at[2] else joined(low, high) if low and high else ()
            for a, b, unlike, more in parts:
                key = pa.repeat(pa.scalar(at[0] if more else None, pa.int64()), len(a))
                yield pa.RecordBatch.from_arrays([*(pc.cast(pa.array(x), t) for x, t in ((a, pa.int64()), (b, pa.int64()), (unlike, pa.float64()))), key], names=["a", "b", "unlike", "cut"])

        for key, x, y, upper, *member in C.rows_of(batches, "key", "x", "y", "upper", "node", "c", "n", "brief"):
            if (key, x, y) != at:
                if at:
                    yield from found()
                at, low, high = (key, x, y), [], []
            (high if upper else low).append(tuple(member))
        if at:
            yield from found()

    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), "blocks").alias("own")
    dealt = members.join(sizes, "key").select("key", "node", "c", "blocks", own)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    cell = dealt.select("*", other).select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).alias("upper"), "node", "c")
    placed = cell.join(nodes.hint("merge"), "node").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return placed.mapInArrow(cells, C.schema(a="long", b="long", unlike="double", cut="long"))


def given(parts, members: int, best: bool) -> Iterator[tuple]:
    """A cell's pairs from its ``parts`` (x, y, unlike), as ``in_cells`` takes them: with ``best``, of more than GIVEN a member only the strongest."""
    import numpy as np

    kept, held = [], 0
    for x, y, unlike in parts:
        if not len(x):
            continue
        x, y = np.minimum(x, y), np.maximum(x, y)
        if not best:
            yield x, y, unlike, False
            continue
        kept, held = [*kept, (x, y, unlike)], held + len(x)
    if kept:
        x, y, unlike = (np.concatenate(c) for c in zip(*kept, strict=True))
        more = held > GIVEN * members
        at = strongest(x, y, unlike) if more else slice(None)
        yield x[at], y[at], unlike[at], more


def settled(members: DataFrame, joined: DataFrame, tried: DataFrame, texts: DataFrame, search, k: int, percent: int) -> DataFrame:
    """id, component of all links: those of ``joined``, and what ``search`` finds between its components but ``tried`` has not.

    ``members`` holds key and node; ``search(placed, best)`` gives the pairs (a, b, unlike, cut) of members (key, node, c). Each node's least unlike
    partner is verified first, then what is still between components. Only keys that were cut are searched again.
    """
    def placed(rows: DataFrame, node: str, c: str) -> DataFrame:
        own = joined.select(F.col("id").alias(node), "component")
        return rows.join(own, node, "left").withColumn(c, F.coalesce("component", node)).drop("component")

    for best in (True, True, False):
        at = C.written(placed(members, "node", "c").select("key", "node", "c"), "placed")
        several = at.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
        found = C.written(search(at.join(several.hint("merge"), "key"), best), "found")
        fresh = C.written(found.groupBy("a", "b").agg(F.min("unlike").alias("unlike")).join(tried, ["a", "b"], "left_anti"), "pairs")
        if not fresh.isEmpty():
            either = fresh.select(F.col("a").alias("id"), "*").unionByName(fresh.select(F.col("b").alias("id"), "*"))
            first = either.groupBy("id").agg(F.min(F.struct("unlike", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
            for step in (0, 1):
                rest = first if step == 0 else placed(placed(fresh, "a", "ca"), "b", "cb").where("ca <> cb").select("a", "b").join(tried, ["a", "b"], "left_anti")
                pairs = C.written(rest, "pairs")
                if pairs.isEmpty():
                    continue
                tried, links = tried.unionByName(pairs), C.written(verified(pairs, texts, k, percent).distinct(), "links")
                if not links.isEmpty():
                    # The components so far are stars already.
                    stars = joined.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
                    joined = C.written(components(stars.unionByName(links)), "components")
        cut = C.written(found.where("cut is not null").select(F.col("cut").alias("key")).distinct(), "cut")
        if cut.isEmpty():
            break
        members = members.join(cut.hint("merge"), "key", "left_semi")
    return joined


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int, most: int = 512) -> DataFrame:
    """Those pairs (a, b) whose full sets meet 100 * intersection >= percent * union; ``texts`` holds node and text.

    Pairs are grouped by their first end, whose text travels once per group of about ``most`` pairs; the other ends' texts follow one by one.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / most).alias("parts"))
    dealt = C.written(pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part")), "dealt")
    first = dealt.select("a", "part").distinct().join(texts.hint("merge"), F.col("a") == F.col("node")).select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    other = dealt.join(texts.hint("merge"), F.col("b") == F.col("node")).select("a", "part", "b", "text")

    def held(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        make = Shingler(k)
        of, own, found = None, None, []
        for a, part, b, text in C.rows_of(batches, "a", "part", "b", "text"):
            if b is None:
                of, own = (a, part), make.shingles(text)
                continue
            if of != (a, part):
                raise RuntimeError("a pair came without its first end")
            s = make.shingles(text)
            if 100 * min(len(s), len(own)) >= percent * max(len(s), len(own)):
                shared = len(np.intersect1d(s, own, assume_unique=True))
                if 100 * shared >= percent * (len(s) + len(own) - shared):
                    found.append((a, b))
            if len(found) >= 10_000:
                yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [x for _, x in found]})
                found = []
        if found:
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [x for _, x in found]})

    # Nulls sort first: a group starts with its first end.
    rows = first.unionByName(other).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return rows.mapInArrow(held, C.schema(a="long", b="long"))


def components(edges: DataFrame, most: int = 40) -> DataFrame:
    """id, component: the smallest id reachable, for all ends of ``edges`` (a, b).

    Alternates two steps until nothing changes: every neighbour above a node is tied to the node's smallest neighbour, then every
    node and its smaller neighbours to the smallest. Paths shorten by half, and each step only combines minima and joins them back.
    """
    now = C.written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    for _ in range(most):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = C.written(small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == state:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component")).groupBy("id").agg(F.min("component").alias("component"))
