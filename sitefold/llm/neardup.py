"""Near duplicates by a MinHash LSH forest, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sitefold.llm import common as C
from sitefold.llm.sets import Shingler, components, given, in_cells, may_link, settled, sketch_of, sketches, unlike_sets, verified

SHINGLE = 5
#: Sorted orders of the forest, and signature components of each: the depth of its tree.
TREES, DEPTH = 8, 10
#: Neighbours looked at on either side in each order, centres of a large region, and partners kept per document and order.
NEAR, CENTRES, PARTNERS = 24, 16, 6
#: Least estimated similarity of a pair that is worth a look at the full sets: 0.75 less four standard errors of the estimate.
WORTH = 0.55
#: One in so many of a set's hashes is looked at beyond the prefix that a partner must meet.
MORE = 20
#: Members of a key that one task compares as a whole, and pairs that are compared one by one.
BLOCK, FEW = 2048, 64


def _constants(n: int):
    import numpy as np

    random = np.random.default_rng(20_240_917)
    return random.integers(0, 2**63, n, np.uint64), random.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles, add, multiply):
    """Lowest value of each of the permutations, mixed down to 16 bits each."""
    import numpy as np

    low = np.full(len(add), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        np.minimum(low, ((part[None, :] ^ add[:, None]) * multiply[:, None]).min(1), out=low)
    return ((low * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(">u2")


def prefix_length(n: int, percent: int) -> int:
    """How many of a set's lowest hashes are looked at: of a linked set's, the first ``1 + n // MORE`` common ones are among them."""
    return n - -(-percent * n // 100) + 1 + n // MORE


def measured(docs: DataFrame, trees: int = TREES, depth: int = DEPTH, percent: int = 75) -> DataFrame:
    """All that is read off a text, in one pass: row, doc_id, th, n (size of the set), digest (of the set; null if empty), sig (MinHash
    signature), sketch (parities) and low (its lowest hashes). ``row`` numbers the rows."""
    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        make, (add, multiply) = Shingler(SHINGLE), _constants(trees * depth)
        out: list[tuple] = []
        names = ["row", "doc_id", "th", "n", "digest", "sig", "sketch", "low"]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        row, held, none = TaskContext.get().partitionId() << 33, 0, np.zeros(0, np.int64)
        for doc, th, text in C.rows_of(batches, "doc_id", "th", "text"):
            s = make.shingles(text)
            n = len(s)
            if n:
                digest = xxhash.xxh128_digest(s.astype("<u8").tobytes())
                out.append((row, doc, th, n, digest, signature(s, add, multiply).tobytes(), sketch_of(s), s[: prefix_length(n, percent)].astype(np.int64)))
            else:
                out.append((row, doc, th, 0, None, None, None, none))
            row, held = row + 1, held + n
            if len(out) >= 2048 or held > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return docs.mapInArrow(rows, C.schema(row="long", doc_id="long", th="long", n="long", digest="binary", sig="binary", sketch="binary", low="array<bigint>"))


def partners(ids, sigs, keys, near: int = NEAR, centres: int = CENTRES, keep: int = PARTNERS, worth: float = WORTH):
    """Candidate pairs of a stretch of one sorted order: (a, b, estimate).

    ``keys`` are the stretch's components in order (one row per document), ``sigs`` all components. Documents whose first components
    agree form a region. Its longest-common-prefix neighbours stand next to one another, so each document looks at ``near``
    of them on either side; a region too large for that is as deep as its members' prefixes agree, and in addition all its members look
    at its centres, the members nearest to its consensus. Of the pairs whose signatures agree in a share of ``worth``, a document keeps
    the ``keep`` best.
    """
    import numpy as np

    n, k = len(ids), sigs.shape[1]
    found_a, found_b, found_e = [], [], []
    root = keys[:, 0]
    for shift in range(1, min(near, n - 1) + 1):
        together = np.flatnonzero(root[shift:] == root[:-shift])
        if not len(together):
            break
        e = (sigs[together] == sigs[together + shift]).mean(1)
        live = e >= worth
        found_a.append(together[live])
        found_b.append(together[live] + shift)
        found_e.append(e[live])
    edges = np.flatnonzero(np.diff(root.astype(np.int64)) != 0) + 1
    for lo, hi in zip([0, *edges], [*edges, n], strict=True):
        if hi - lo <= near + 1:
            continue
        own = sigs[lo:hi]
        consensus = np.array([np.bincount(own[:, c]).argmax() for c in range(k)])
        central = np.argsort(-(own == consensus).mean(1), kind="stable")[:centres]
        for c in central:
            e = (own == own[c]).mean(1)
            live = np.flatnonzero((e >= worth) & (np.arange(hi - lo) != c))
            found_a.append(live + lo)
            found_b.append(np.full(len(live), c + lo))
            found_e.append(e[live])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, e = np.concatenate(found_a), np.concatenate(found_b), np.concatenate(found_e)
    # Each side's best: rank the pairs within their first and within their second document.
    chosen = np.zeros(len(a), bool)
    for side in (a, b):
        order = np.lexsort((-e, side))
        s = side[order]
        start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
        place = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)]))
        chosen[order[place < keep]] = True
    a, b, e = ids[a[chosen]], ids[b[chosen]], e[chosen]
    return np.minimum(a, b), np.maximum(a, b), e


def candidates(reps: DataFrame, trees: int = TREES, depth: int = DEPTH, stretch: int = 8192) -> DataFrame:
    """Pairs (a, b) with a < b and their best estimate, from all orders of the forest.

    ``reps`` holds doc_id and signature. All orders are sorted in one shuffle, in ranges of (order, components, id): a region, however
    large, is split where its members' deeper components differ. A task walks its range in stretches of bounded size.
    """
    width = 2 * depth
    orders = F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"), F.substring(F.col("sig"), t * width + 1, F.lit(width)).alias("key"))))
    rows = reps.select("doc_id", "sig", orders.alias("o")).select("doc_id", "sig", "o.tree", "o.key")
    order = ["tree", "key", "doc_id"]

    def pairs(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        ids: list = []
        sigs: list = []
        trees_: list = []

        def emit() -> Iterator:
            i, t = np.array(ids, np.int64), np.array(trees_)
            s = np.frombuffer(b"".join(sigs), ">u2").reshape(len(i), -1).astype(np.uint16)
            for tree in np.unique(t):
                own = t == tree
                a, b, e = partners(i[own], s[own], s[own][:, tree * depth : (tree + 1) * depth])
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b, "e": e})

        for doc, tree, sig in C.rows_of(batches, "doc_id", "tree", "sig"):
            # A stretch ends between two regions if it can, and in any case at twice its size; the next one starts with an overlap.
            if len(ids) >= stretch and (tree != trees_[-1] or sig[tree * width : tree * width + 2] != sigs[-1][tree * width : tree * width + 2] or len(ids) >= 2 * stretch):
                yield from emit()
                ids, sigs, trees_ = ids[-NEAR:], sigs[-NEAR:], trees_[-NEAR:]
            ids.append(doc)
            sigs.append(sig)
            trees_.append(tree)
        if ids:
            yield from emit()

    ranged = rows.select("doc_id", "tree", "key", "sig").repartitionByRange(*order).sortWithinPartitions(*order)
    found = ranged.select("doc_id", "tree", "sig").mapInArrow(pairs, C.schema(a="long", b="long", e="double"))
    return found.groupBy("a", "b").agg(F.max("e").alias("e"))


def bounded(pairs: DataFrame, nodes: DataFrame, percent: int = 75) -> DataFrame:
    """Those pairs (a, b, ...) whose sketches allow a link; ``nodes`` holds node, n and sketch."""
    columns = pairs.columns

    def kept(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            four = [batch.column(c).to_pylist() for c in ("na", "xa", "nb", "xb")]
            keep = [unlike_sets(*row, percent) is not None for row in zip(*four, strict=True)]
            yield batch.select(columns).filter(pa.array(keep, pa.bool_()))

    own = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"x{c}")).hint("merge")
    joined = pairs.join(own("a"), "a").join(own("b"), "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return joined.select(*columns, "na", "nb", "xa", "xb").mapInArrow(kept, pairs.schema)


def with_facts(rows: DataFrame, **facts: Column) -> DataFrame:
    """``rows`` with aggregates over all rows of the same ``h``. Hashes do not compress, so they are shuffled once, not for an aggregate as well."""
    return rows.select("*", *[fact.over(W.partitionBy("h")).alias(name) for name, fact in facts.items()])


def unsettled(low: DataFrame, nodes: DataFrame, placed: DataFrame, percent: int = 75) -> DataFrame:
    """node, c (its component): the nodes that may have a link to another component; all others have none.

    ``low`` holds the hashes h of nodes' lowest ones that several nodes have. The first k common hashes of two linked sets are among the
    ``n - least + k`` lowest of either, where ``least`` is what a partner must share. The lowest for k = 1 + n // MORE are looked at,
    and a partner has at least ``least`` shingles; so a node stays only if 1 + least // MORE of them occur in two components.
    """
    hashes = low.join(placed.hint("merge"), "node").select("node", "c", "h")
    crossing = hashes.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("h")
    met = hashes.join(crossing.hint("merge"), "h").groupBy("node").agg(F.count("*").alias("m"), F.first("c").alias("c"))
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    return met.join(nodes.select("node", "n"), "node").where(F.col("m") > F.floor(least / MORE)).select("node", "c")


def crossing(texts: DataFrame, open_: DataFrame, nodes: DataFrame, percent: int = 75) -> DataFrame:
    """Where links between components can be: key and node, for the nodes of ``open_`` (node, c), from their whole texts.

    A link's common shingles all occur in two components, so of each set only those count, the rarest first. A set that has fewer of them
    than a partner must share has no partner, and otherwise the first common one is among its first ``x - least + 1`` of x: these are the keys.
    """
    def each(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        make = Shingler(SHINGLE)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                own = [make.shingles(t).astype(np.int64) for t in part.column("text").to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(own)), [len(s) for s in own]))
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(rows) for c in ("node", "c", "n")], pa.array(np.concatenate(own))], names=["node", "c", "n", "h"])

    # A row that the table repeats counts twice, in x and in place alike: its prefix only becomes longer.
    sized = open_.join(nodes.select("node", "n").hint("merge"), "node")
    rows = texts.join(sized.hint("merge"), "node").select("node", "c", "n", "text").mapInArrow(each, C.schema(node="long", c="long", n="long", h="long"))
    rows = C.written(rows, "shingles")
    rows = with_facts(rows, lo=F.min("c"), hi=F.max("c"), df=F.count("*")).where("lo < hi")
    own = W.partitionBy("node")
    rows = rows.select("node", "c", "n", "h", F.count("*").over(own).alias("x"), F.row_number().over(own.orderBy("df", "h")).alias("place"))
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    rows = C.written(rows.where((F.col("x") >= least) & (F.col("place") <= F.col("x") - least + 1)).select("node", "c", "h"), "prefixes")
    keyed = rows.select("node", "c", F.col("h").alias("key"))
    meet = keyed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    return C.written(keyed.join(meet.hint("merge"), "key").select("key", "node"), "crossing")


def sketched_pairs(members: DataFrame, nodes: DataFrame, percent: int = 75, block: int = BLOCK, best: bool = False) -> DataFrame:
    """Pairs (a, b, unlike, cut) of different components whose sketches allow a link, of members (key, node, c): others never become rows.

    ``nodes`` holds node, n and sketch. With ``best``, a key of many pairs gives only each member's least unlike partner, and ``cut`` names it.
    """
    def joined(low: list[tuple], high: list[tuple] | None) -> Iterator:
        import numpy as np

        both = low + (high or [])
        if len(low) * len(high or low) <= FEW:
            pairs = [(x[0], y[0], unlike_sets(x[2], x[3], y[2], y[3], percent), x[2] + y[2]) for k, x in enumerate(low) for y in (high or low[k + 1 :]) if x[1] != y[1]]
            pairs = [(min(x, y), max(x, y), differ / n) for x, y, differ, n in pairs if differ is not None]
            if pairs:
                yield *zip(*pairs, strict=True), False
            return
        node, c, n = (np.array([r[k] for r in both], np.int64) for k in range(3))
        words = sketches([(r[2], r[3]) for r in both])
        split = len(low) if high else 0

        def allowed() -> Iterator:
            for at in range(0, len(low), 256):
                mine, others = slice(at, min(at + 256, len(low))), slice(split, None)
                i, j = np.nonzero(may_link(words[mine], n[mine], words[others], n[others], percent) & (c[mine][:, None] != c[others][None, :]))
                i, j = i + at, j + split
                if not high:
                    i, j = i[i < j], j[i < j]
                yield node[i], node[j], np.bitwise_count(words[i] ^ words[j]).sum(1, dtype=np.int64) / (n[i] + n[j])

        yield from given(allowed(), len(both), best)

    return in_cells(members, nodes.select("node", "n", F.col("sketch").alias("brief")), block, joined)


def cluster(docs: DataFrame, *, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Classes of near duplicates: doc_id, n_shingles, component_id, kept.

    Documents whose sets of five-word shingles agree are one node at once. An LSH forest proposes
    pairs of nodes; those that sketches of both sets do not exclude count after a look at the full sets. Each node's best pair is looked at
    first; of all other pairs only those between different components then are, since no other can change a component. The forest keeps a bounded
    number of partners per node, so a last step finds all links left between different components exactly, by prefixes of the full sets:
    components are those of all links.

    ``component_id`` is the smallest id that links reach, and ``kept`` marks that document. Null and empty texts, and texts without
    words, have no shingles and are linked with nothing. Rows without an id take no part: their component is null, and they
    are kept. Rows that repeat an id and text give equal rows; if an id has several texts, each row has the component of its own text, and
    those of the smallest id are kept. Texts of any length are taken whole; ties in the estimate go to the larger ids. An
    empty table gives no rows. Only the two named columns are read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).withColumn("th", F.xxhash64("text"))
    sized = C.written(measured(rows, percent=percent), "signatures")
    known = sized.where("doc_id is not null and digest is not null")
    # A node is a distinct set, numbered by the row of its smallest id.
    classes = C.written(known.groupBy("digest").agg(F.min(F.struct("doc_id", "th", "row")).alias("first")).select("digest", "first.doc_id", "first.th", F.col("first.row").alias("node")), "classes")
    of_row = C.written(known.select("row", "digest").join(classes.select("digest", "node").hint("merge"), "digest").select("row", "node"), "nodes")
    nodes = C.written(known.join(classes.select("node").hint("merge"), F.col("row") == F.col("node"), "left_semi").select(F.col("row").alias("node"), "n", "sig", "sketch"), "nodes")
    named = classes.select("node", "doc_id", "th")

    def texts_of(some: DataFrame) -> DataFrame:
        wanted = named.join(some.hint("merge"), "node", "left_semi")
        return C.written(rows.where("doc_id is not null").join(wanted.hint("merge"), ["doc_id", "th"]).select("node", "text"), "texts")

    # The lowest hashes that several rows have, by node: a link's ends have one in common.
    low = known.select("row", F.explode("low").alias("h"))
    again = with_facts(low, times=F.count("*")).where("times > 1").select("row", "h")
    low = C.written(again.join(of_row.hint("merge"), "row").select("node", "h").distinct(), "lowest")

    found = candidates(nodes.select(F.col("node").alias("doc_id"), "sig"))
    pairs = C.written(bounded(found, nodes, percent), "pairs")
    # One pass fetches all texts that may be looked at: the ends of pairs, and nodes with so many shared hashes that they may end up unsettled.
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    shared = low.groupBy("node").agg(F.count("*").alias("m")).join(nodes.select("node", "n"), "node").where(F.col("m") > F.floor(least / MORE)).select("node")
    texts = texts_of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(shared).distinct())

    # First the best pair of each node, then what lies between components.
    either = pairs.select(F.col("a").alias("id"), "a", "b", "e").unionByName(pairs.select(F.col("b").alias("id"), "a", "b", "e"))
    first = C.written(either.groupBy("id").agg(F.max(F.struct("e", F.col("a").alias("a"), F.col("b").alias("b"))).alias("x")).select("x.a", "x.b").distinct(), "pairs")
    links = C.written(verified(first, texts, SHINGLE, percent).distinct(), "links")
    joined = C.written(components(links), "components")
    left = joined.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    right = joined.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    apart = (pairs.select("a", "b").join(left, "a", "left").join(right, "b", "left")
             .where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b").join(first, ["a", "b"], "left_anti"))
    later = C.written(verified(C.written(apart, "pairs"), texts, SHINGLE, percent).distinct(), "links")
    # The components so far are stars already: only what the new links change is left to do.
    stars = joined.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    joined = C.written(components(stars.unionByName(later)), "components")
    # What the forest's bounds left out: all links between components, on the texts that may have one.
    placed = C.written(nodes.select("node").join(joined.withColumnRenamed("id", "node"), "node", "left").select("node", F.coalesce("component", "node").alias("c")), "placed")
    open_ = C.written(unsettled(low, nodes, placed, percent), "unsettled")
    members = crossing(texts, open_, nodes, percent)
    joined = settled(members, joined, pairs.select("a", "b"), texts, lambda placed, best: sketched_pairs(placed, nodes, percent, best=best), SHINGLE, percent)
    placed = classes.select("digest", "doc_id", "node").join(joined.withColumnRenamed("id", "node"), "node", "left").select(
        "digest", F.col("doc_id").alias("first"), F.coalesce("component", "node").alias("c"))
    smallest = placed.groupBy("c").agg(F.min("first").alias("component"))
    of_class = C.written(placed.join(smallest, "c").select("digest", "component"), "classes")
    # Only classes of several documents, or linked ones, need a look; the join's hot class is one small row.
    component = F.coalesce("component", "doc_id")
    return sized.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(of_class, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def keep_one(docs: DataFrame, clustered: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one per class (the one of its smallest id; of rows that repeat the id, the first by text hash), and rows without an id."""
    kept = clustered.where("kept and doc_id is not null").select(F.col("doc_id").alias("__id")).distinct()
    named = docs.where(F.col(id_column).isNotNull()).withColumn("__id", F.col(id_column).cast("long"))
    first = F.row_number().over(W.partitionBy("__id").orderBy(F.xxhash64(text_column), text_column))
    own = named.join(kept, "__id", "left_semi").withColumn("__first", first).where("__first = 1").select(*docs.columns)
    return own.unionByName(docs.where(F.col(id_column).isNull()))
