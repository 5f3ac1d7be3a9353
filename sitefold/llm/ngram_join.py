"""Jaccard self-join on word shingles by an R-tree over group counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from sitefold.llm import common as C
from sitefold.llm.sets import Shingler, components, counts_of, given, in_cells, kind, point_of, settled, sketch_of, sketches, spread, verified

#: Words of a shingle, and the least similarity in percent.
SHINGLE, PERCENT = 3, 90
#: Points of a leaf of the tree, and members of a branch that one task compares as a whole.
LEAF, BLOCK = 32, 2048


def size_class(n: int) -> int:
    """Sizes in steps of one and a half; linked sets are in one class or in two that follow one another."""
    return int(math.log(max(n, 1)) / math.log(1.5) + 1e-9)


def class_bound(c: int) -> int:
    """The largest size of class ``c``."""
    n = math.ceil(1.5 ** (c + 1)) + 1
    while size_class(n) > c:
        n -= 1
    return n


def groups_of(c: int, percent: int) -> tuple[int, int]:
    """Groups by which class ``c`` is branched, and how many of them may be empty in a set.

    Linked sets differ in fewer shingles than there are groups, so one group at least holds the same shingles in both, and of a
    set with no more empty groups than are spare, one that is not empty. One group means that only equal sets are linked.
    """
    differ = 2 * class_bound(c) * (100 - percent) // (100 + percent)
    spare = differ // 50
    return differ + 1 + spare if differ else 1, spare


def shared_bound(p, q):
    """Upper bound of the common shingles of points (or boxes): the sum of the coordinates' minima. Works on all rows of both at once."""
    import numpy as np

    return np.minimum(p[:, None, :], q[None, :, :]).sum(2, dtype=np.int64)


class Tree:
    """An R-tree over points, packed bottom up: leaves of neighbours in a sort by coordinates, boxes of boxes above."""

    def __init__(self, points, sizes, leaf: int = LEAF):
        import numpy as np

        order = self._tiles(points, sizes, leaf)
        self.order, self.points, self.sizes, self.leaf = order, points[order], sizes[order], leaf
        starts = np.arange(0, len(order), leaf)
        high, least, most = np.maximum.reduceat(self.points, starts), np.minimum.reduceat(self.sizes, starts), np.maximum.reduceat(self.sizes, starts)
        # levels[0] are the leaves; each level holds the boxes' upper corners and the range of sizes.
        self.levels = [(high, least, most)]
        while len(self.levels[-1][0]) > 1:
            high, least, most = self.levels[-1]
            starts = np.arange(0, len(high), leaf)
            self.levels.append((np.maximum.reduceat(high, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)))

    @staticmethod
    def _tiles(points, sizes, leaf: int):
        """Sort by size, then tile by tile along the coordinates that vary most."""
        import numpy as np

        order = np.argsort(sizes, kind="stable")
        axes = np.argsort(-points.var(0), kind="stable")[:3]
        n = len(order)
        for k, axis in enumerate(axes):
            tile = max(leaf, int(n / max(1, n / leaf) ** ((k + 1) / (len(axes) + 1))))
            order = np.concatenate([part[np.argsort(points[part, axis], kind="stable")] for part in np.split(order, range(tile, n, tile))])
        return order


def tree_pairs(a: Tree, b: Tree, percent: int, same: bool) -> Iterator[tuple]:
    """Pairs of numbers of points of both trees whose bound allows a link; with ``same``, each unordered pair once.

    Two boxes are followed only if the sum of the minima of their upper corners reaches what sets of their least sizes must share.
    """
    import numpy as np

    def reach(bound, least_a, least_b):
        return (100 + percent) * bound >= percent * (least_a[:, None] + least_b[None, :])

    def near(most_a, least_a, most_b, least_b):
        return (100 * most_a[:, None] >= percent * least_b[None, :]) & (100 * most_b[None, :] >= percent * least_a[:, None])

    height = max(len(a.levels), len(b.levels)) - 1
    open_ = [(0, 0)]
    for level in range(height, -1, -1):
        (ha, la, ma), (hb, lb, mb) = a.levels[min(level, len(a.levels) - 1)], b.levels[min(level, len(b.levels) - 1)]
        followed = []
        for x, y in open_:
            # The children of both boxes on this level; the roots are their own.
            xs = np.arange(x * a.leaf, min((x + 1) * a.leaf, len(ha))) if level < len(a.levels) - 1 else np.array([0])
            ys = np.arange(y * b.leaf, min((y + 1) * b.leaf, len(hb))) if level < len(b.levels) - 1 else np.array([0])
            good = reach(shared_bound(ha[xs], hb[ys]), la[xs], lb[ys]) & near(ma[xs], la[xs], mb[ys], lb[ys])
            for i, j in zip(*np.nonzero(good), strict=True):
                if not same or xs[i] <= ys[j]:
                    followed.append((int(xs[i]), int(ys[j])))
        open_ = followed
    for x, y in open_:
        xs, ys = np.arange(x * a.leaf, min((x + 1) * a.leaf, len(a.points))), np.arange(y * b.leaf, min((y + 1) * b.leaf, len(b.points)))
        sa, sb = a.sizes[xs], b.sizes[ys]
        good = reach(shared_bound(a.points[xs], b.points[ys]), sa, sb) & near(sa, sa, sb, sb)
        i, j = np.nonzero(good)
        if same and x == y:
            i, j = i[i < j], j[i < j]
        yield a.order[xs[i]], b.order[ys[j]]


def branch_keys(shingles, c: int, percent: int) -> list:
    """One key per group of class ``c`` that is not empty: of the class, the group and all shingles that fall into it.

    A set with more empty groups than are spare is grouped anew, by another hash, until it has fewer. Two linked sets share a key: either
    the groups that they agree on are not all empty, or both go on to the next hash.
    """
    import numpy as np

    groups, spare = groups_of(c, percent)
    out, turn = [], 0
    while groups > 1:
        mixed = (shingles ^ np.uint64(turn * 0x2545F4914F6CDD1D & (1 << 64) - 1)) * np.uint64(0x7FB5D329728EA185)
        mixed ^= mixed >> np.uint64(29)
        place = (mixed % np.uint64(groups)).astype(np.int64)
        content = np.zeros(groups, np.uint64)
        np.add.at(content, place, (mixed * np.uint64(0x81DADEF4BC2DD44D)) ^ (mixed >> np.uint64(33)))
        key = content ^ (np.arange(groups, dtype=np.uint64) + np.uint64(c * 1_000_003 + turn * 7 + 1)) * np.uint64(0x9E3779B97F4A7C15)
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        filled = np.bincount(place, minlength=groups) > 0
        out.append(key[filled].astype(np.int64))
        if groups - int(filled.sum()) <= spare:
            break
        turn += 1
    return out


def measured(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, th, n, digest (of the set; null if empty), point (its group counts), sketch (parities) and branches (its keys on the tree's first level)."""

    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        make, empty = Shingler(k), np.zeros(0, np.int64)
        names = ["doc_id", "th", "n", "digest", "point", "sketch", "branches"]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        out: list[tuple] = []
        held = 0
        for doc, th, text in C.rows_of(batches, "doc_id", "th", "text"):
            s = make.shingles(text)
            n, digest, point, sketch, branches = len(s), None, None, None, empty
            if n:
                digest = xxhash.xxh128_digest(s.astype("<u8").tobytes())
                point, sketch = point_of(s), sketch_of(s)
                c = size_class(n)
                keys = branch_keys(s, c, percent)
                # The larger of two linked sets may be of the next class: the smaller one has its keys there as well.
                if 100 * n >= percent * (class_bound(c) + 1):
                    keys += branch_keys(s, c + 1, percent)
                branches = np.concatenate(keys) if keys else empty
            out.append((doc, th, n, digest, point, sketch, branches))
            held += n
            if held >= 1_000_000 or len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return docs.mapInArrow(rows, C.schema(doc_id="long", th="long", n="long", digest="binary", point="binary", sketch="binary", branches="array<bigint>"))


def tree_joined(members: DataFrame, nodes: DataFrame, percent: int = PERCENT, block: int = BLOCK, best: bool = False) -> DataFrame:
    """Pairs (a, b, unlike, cut) with a < b of different components that the trees' bounds allow, of members (key, node, c); ``nodes`` holds node, n, point and sketch.

    Each branch of the first level is a tree of its own. A branch of more than ``block`` members is dealt into blocks, each with its
    tree, and every two blocks meet in a cell of their own: no task holds more than two blocks. Pairs that a tree leaves are held against
    their sets' parities, which bound what the sets differ in. With ``best``, a cell of many pairs gives only each member's least unlike partner,
    and ``cut`` names its key.
    """
    def joined(low: list[tuple], high: list[tuple] | None) -> Iterator:
        import numpy as np

        width = min(spread(n) for _, _, n, _ in low + (high or []))
        cut = [spread(n) * np.dtype(kind(n)).itemsize for _, _, n, _ in low + (high or [])]
        words = sketches([(r[2], r[3][at:]) for r, at in zip(low + (high or []), cut, strict=True)])

        def tree(rows: list[tuple]) -> tuple:
            points = np.stack([counts_of(p[: spread(n) * np.dtype(kind(n)).itemsize], n, width) for _, _, n, p in rows])
            return *(np.array([r[k] for r in rows], np.int64) for k in range(3)), Tree(points, np.array([r[2] for r in rows], np.int64))

        ids_a, comp_a, size_a, a = tree(low)
        ids_b, comp_b, size_b, b = tree(high) if high else (ids_a, comp_a, size_a, a)
        words_a, words_b = words[: len(low)], words[len(low) :] if high else words

        def allowed() -> Iterator:
            for i, j in tree_pairs(a, b, percent, not high):
                apart = comp_a[i] != comp_b[j]
                i, j = i[apart], j[apart]
                differ = np.bitwise_count(words_a[i] ^ words_b[j]).sum(1, dtype=np.int64)
                both = size_a[i] + size_b[j]
                good = (100 + percent) * differ <= (100 - percent) * both
                yield ids_a[i[good]], ids_b[j[good]], differ[good] / both[good]

        yield from given(allowed(), len(low) + len(high or ()), best)

    return in_cells(members, nodes.select("node", "n", F.concat("point", "sketch").alias("brief")), block, joined)


def cluster(docs: DataFrame, *, k: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents linked by a Jaccard similarity of at least ``percent`` of their ``k``-word shingles: doc_id, n_shingles, component_id.

    A set's shingles are hashed into groups, and its point holds the groups' counts: the sum of the smaller counts of two points is an upper
    bound of what their sets share. The points are indexed by an R-tree. A plain one over all points would follow nearly every pair of boxes,
    because a tenth of the size is several deviations in each of many coordinates; so its first level branches by the contents of
    groups, of which linked sets have one in common (``branch_keys``), and below it each branch is a packed tree of boxes (``tree_joined``).

    Equal sets are one node at once. Each node is first compared with the smallest node of the branches it shares most often, which settles
    groups of near copies in one comparison a member. Only branches that still hold several components are searched by their trees: once, if
    their pairs are few, else first for each node's best partner, then for all. Pairs whose bounds allow a link are verified on the full sets.
    Components are those of all links.

    ``component_id`` is the smallest id that links reach, itself included. Null and empty texts, and texts without words, have no shingles
    and are linked with nothing; rows without an id take no part and have a null component. Rows that repeat an id are each taken for
    themselves: their component is that of their own text. Texts of any length are taken whole; ties between branches are settled by
    the smaller node. An empty table gives no rows. Only the two named columns are read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).withColumn("th", F.xxhash64("text"))
    sized = C.written(measured(rows, k, percent), "points")
    known = sized.where("doc_id is not null and digest is not null")
    classes = C.written(known.groupBy("digest").agg(
        F.min(F.struct("doc_id", "th")).alias("rep"), F.first("n").alias("n"), F.first("point").alias("point"), F.first("sketch").alias("sketch"), F.first("branches").alias("branches"),
    ).select("digest", "rep.doc_id", "rep.th", "n", "point", "sketch", "branches", F.monotonically_increasing_id().alias("node")), "classes")

    keys = classes.select("node", F.explode("branches").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").select("key", "lead")
    members = C.written(keys.join(shared.hint("merge"), "key"), "members")
    nodes = members.select("node").distinct().join(classes.select("node", "doc_id", "th").hint("merge"), "node")
    texts = C.written(rows.where("doc_id is not null").join(nodes.hint("merge"), ["doc_id", "th"]).select("node", "text"), "texts")

    often = members.where("node <> lead").groupBy("node", "lead").agg(F.count("*").alias("times"))
    best = often.groupBy("node").agg(F.max(F.struct("times", (-F.col("lead")).alias("less"))).alias("x")).select((-F.col("x.less")).alias("a"), F.col("node").alias("b"))
    tried = C.written(best, "pairs")
    links = C.written(verified(tried, texts, k, percent).distinct(), "links")
    joined = C.written(components(links), "components")

    # Then what the trees find in branches that still hold several components.
    of_node = settled(members.select("key", "node"), joined, tried, texts, lambda placed, best: tree_joined(placed, classes, percent, block, best), k, percent)

    named = classes.select("digest", "doc_id", "node").join(of_node.withColumnRenamed("id", "node"), "node", "left").select(
        "digest", F.col("doc_id").alias("first"), F.coalesce("component", "node").alias("c"))
    smallest = named.groupBy("c").agg(F.min("first").alias("component"))
    of_class = named.join(smallest, "c").select("digest", "component")
    return sized.select("doc_id", "n", "digest").join(of_class, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
