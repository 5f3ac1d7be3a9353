"""Exact top-k inner products: columnar branch and bound."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sitefold.llm import common as C

#: Queries and candidates of a block at most on average; dimensions that are added up between two bounds.
QUERIES, CANDIDATES, STEP = 1024, 4096, 16


def scaled(vector: Column, factor: int = 256) -> Column:
    """Components as floor(factor * x); null where the vector is null or holds a null or a non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(vector, lambda x: F.floor(factor * x.cast("double")).cast("long")))


def best_of_block(query_ids, queries, ids, vectors, k: int, step: int = STEP):
    """The k best of a block of candidates for each query: (query, candidate, score) arrays.

    Candidates lie dimension by dimension. After each step of dimensions, what the rest can still add is at most the product
    of the rests' lengths (Cauchy-Schwarz): candidates whose upper bound is below the k-th best lower bound leave, and the
    survivors are gathered into a dense block for the next step. Scores are sums of whole numbers below 2**53: exact.
    """
    import numpy as np

    dims = vectors.shape[1]
    exact = max(float(np.abs(queries).max(initial=0)), 1.0) * max(float(np.abs(vectors).max(initial=0)), 1.0) * max(dims, 1) < 2**53
    kind = np.float64 if exact else object
    columns = np.ascontiguousarray(vectors.T).astype(kind)
    asked = queries.astype(kind)
    cuts = [*range(0, dims, step), dims] if exact else [0, dims]
    # Lengths of what is left after each step, for both sides.
    rest = lambda m: [np.sqrt((m[:, c:].astype(np.float64) ** 2).sum(1)) for c in cuts[1:]]
    left_x, left_q = rest(vectors), rest(queries)
    first = asked[:, : cuts[1]] @ columns[: cuts[1]] if dims else np.zeros((len(asked), len(ids)))
    # A bound may only count on k different candidates: a block that repeats an id is scored in full.
    prune = len(np.unique(ids)) == len(ids)
    out_q, out_c, out_s = [], [], []
    for q, own in enumerate(query_ids):
        alive = np.flatnonzero(ids != own)
        score = first[q, alive]
        for b in range(1, len(cuts)):
            if b > 1:
                score = score + asked[q, cuts[b - 1] : cuts[b]] @ columns[cuts[b - 1] : cuts[b], alive]
            if prune and b < len(cuts) - 1 and len(alive) > k:
                slack = left_q[b - 1][q] * left_x[b - 1][alive] * (1 + 1e-9) + 1e-6
                floor = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                live = score + slack >= floor
                alive, score = alive[live], score[live]
        if prune and len(alive) > k:
            worst = np.sort(score)[-k]
            live = score >= worst
            alive, score = alive[live], score[live]
        order = np.lexsort((ids[alive], -score.astype(np.float64))) if exact else sorted(range(len(alive)), key=lambda i: (-score[i], ids[alive[i]]))
        chosen: dict[int, int] = {}
        for i in order:
            chosen.setdefault(int(ids[alive[i]]), int(score[i]))
            if len(chosen) == k:
                break
        out_q += [own] * len(chosen)
        out_c += chosen
        out_s += chosen.values()
    return out_q, out_c, out_s


def search(vectors: DataFrame, is_query: Column, k: int = 5, *, queries: int = QUERIES, candidates: int = CANDIDATES, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """The k best rows for each row that ``is_query`` (over ``vec_id``) holds for: query_id, rank, vec_id, score.

    Queries meet all rows in blocks: both sides are dealt into blocks by hash of the id, a candidate goes to each block of queries, and
    one block of each makes a task's group, a few megabytes whatever the size of the table. Each group returns at most k rows a
    query, from which the k best overall follow by a ranking that Spark cuts per task.

    Vectors that are null, or hold a null or non-finite component, and rows without an id take no part. Vectors are compared
    with those of their own length. Rows that repeat an id and vector count once; if an id has several vectors, the smallest is
    its query and the best its score. Ties go to the smaller id. Fewer candidates than k give as many rows. Only the two named
    columns are read; a table without rows or queries gives none.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), scaled(F.col(vector_column)).alias("v")).where("vec_id is not null and v is not null")
    rows = C.written(rows.distinct().withColumn("asks", F.coalesce(is_query, F.lit(False))), "vectors")
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    size = rows.agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("asks"), F.col("vec_id"))).alias("q")).first()
    n_queries, n_candidates = max(1, -(-size["q"] // queries)), max(1, -(-size["n"] // candidates))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    cells = (rows.select("vec_id", "v", F.lit(False).alias("asks"), block(n_candidates).alias("c"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_queries - 1).cast("long"))).alias("q"))
             .unionByName(asked.select("vec_id", "v", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_candidates - 1).cast("long"))).alias("c"), block(n_queries).alias("q")))
             .withColumn("dims", F.size("v")))

    def cell(part):
        import numpy as np
        import pyarrow as pa

        part = part.combine_chunks()
        asks = np.asarray(part.column("asks"))
        ids = np.asarray(part.column("vec_id"))
        values = part.column("v").combine_chunks()
        flat = np.asarray(values.flatten()).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)
        q, c, s = best_of_block(ids[asks], flat[asks], ids[~asks], flat[~asks], k)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.int64())})

    best = cells.groupBy("q", "c", "dims").applyInArrow(cell, C.schema(query_id="long", vec_id="long", score="long"))
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
