"""Table-level reads, writes and checks on Parquet snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import codes
from sitefold.operators.lineage import cut_lineage
from sitefold.sources.master import first_per_key


def read_master(df: DataFrame) -> DataFrame:
    """Master rows with empty strings as null and the life cycle recomputed from the raw status."""
    cols = [F.nullif(F.col(n), F.lit("")).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes]
    return df.select(cols).withColumn("lifecycle_status", codes.lifecycle(F.col("status"))["normalized"])


def rows_with_keys(df: DataFrame, column: str, keys: DataFrame | list[str]) -> DataFrame:
    """Rows whose ``column`` (a nested one too) is among ``keys``, each row once; no row has a null key.

    A list becomes a filter that reaches the file scan. A table of keys (its first column) becomes a semi join.
    """
    if isinstance(keys, list):
        return df.where(F.col(column).isin(keys))
    wanted = keys.select(F.col(f"`{keys.columns[0]}`").alias("_wanted"))
    return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")


def candidates_of_companies(candidates: DataFrame, company_ids: DataFrame | list[str]) -> DataFrame:
    """Candidate locations of the given companies."""
    return rows_with_keys(candidates, "company.id", company_ids)


def queue_rows(queue: DataFrame, candidate_ids: DataFrame | list[str]) -> DataFrame:
    """Queue rows of the given candidates; a candidate that was never scored has none."""
    return rows_with_keys(queue, "candidate_id", candidate_ids)


def identities(candidates: DataFrame) -> DataFrame:
    """One company identity per company id. Candidates of one company hold the same identity; the smallest candidate id settles it if not."""
    return candidates.groupBy("company.id").agg(F.min_by("company", "id").alias("c")).select("c.*")


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str], batch: str) -> DataFrame:
    """Last write wins: the row with the highest ``batch`` per key."""
    return first_per_key(old.unionByName(new), keys, [F.col(batch).desc()])


def insert_if_absent(ledger: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``new`` to append: first per key, and key not in the ledger yet."""
    return first_per_key(new, keys, order).join(ledger.select(*keys), keys, "left_anti")


HUMAN_COLUMNS = ["review_status", "reviewer_note", "created_at"]


def upsert_queue(previous: DataFrame, scored: DataFrame, now: str) -> DataFrame:
    """Next queue snapshot: machine columns from ``scored``, human columns kept.

    Rows not scored this time stay as they were; new rows start as pending.
    """
    machine = [c for c in scored.columns if c != "candidate_id"]
    fresh = F.col("n._new")
    joined = previous.alias("p").join(scored.withColumn("_new", F.lit(True)).alias("n"), "candidate_id", "full_outer")
    return joined.select(
        "candidate_id",
        *[F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"p.{c}")).alias(c) for c in machine],
        F.coalesce("p.review_status", F.lit("pending")).alias("review_status"),
        F.col("p.reviewer_note").alias("reviewer_note"),
        F.coalesce("p.created_at", F.lit(now)).alias("created_at"),
    )


def missing_references(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null child keys without a parent row."""
    keys = child.select(F.col(child_key).alias("missing_key")).where("missing_key IS NOT NULL").distinct()
    return keys.join(parent, F.col("missing_key") == F.col(parent_key), "left_anti")


def content_checksum(df: DataFrame) -> DataFrame:
    """Row count and an order-independent checksum of a table: the sum of its rows' hashes, in which equal rows count each time."""
    hashes = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("row_count"), F.coalesce(hashes, F.lit(0).cast("decimal(38,0)")).cast("string").alias("checksum"))


def write_artifacts(artifacts: dict[str, DataFrame], root: str, pull_date: str, facts: dict[str, str]) -> DataFrame:
    """Write each table below a dated folder as compressed JSON lines, plus a manifest; returns the manifest."""
    base = f"{root.rstrip('/')}/pull_date={pull_date}"
    rows = None
    for name, df in artifacts.items():
        df.write.mode("overwrite").json(f"{base}/{name}", compression="gzip")
        back = df.sparkSession.read.schema(df.schema).json(f"{base}/{name}")
        line = content_checksum(back).select(F.lit(name).alias("artifact"), "row_count", "checksum")
        rows = line if rows is None else rows.unionByName(line)
    manifest = rows.withColumn("facts", F.to_json(F.create_map(*[F.lit(x) for kv in facts.items() for x in kv])))
    manifest.coalesce(1).write.mode("overwrite").json(f"{base}/manifest")
    return manifest


def queue_in_order(queue: DataFrame) -> DataFrame:
    """Display order: priority, then match score; candidate id settles ties."""
    return queue.orderBy(F.desc("review_priority"), F.desc("match_score"), "candidate_id")


def queue_positions(queue: DataFrame) -> DataFrame:
    """candidate_id and its ``position`` (from 1) in display order, for every row.

    Rows are dealt into sorted ranges and written; a range's first position is the number of rows in the ranges before it (one row per
    range), so that no task numbers more than its own range.
    """
    order = [F.desc("review_priority"), F.desc("match_score"), F.asc("candidate_id")]
    rows = queue.select("candidate_id", "review_priority", "match_score")
    ranges = cut_lineage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranges.withColumn("_place", inside).join(bases, "_range").select("candidate_id", (F.col("_base") + F.col("_place")).cast("bigint").alias("position"))


def queue_view(queue: DataFrame, candidates: DataFrame, master: DataFrame) -> DataFrame:
    """Queue rows with names from candidate and matched master, and the display defaults.

    Both joins are sorted merges by request: the size of a master's files, by which the optimizer would broadcast it, says little of its
    names in memory.
    """
    c = candidates.select(
        F.col("id").alias("candidate_id"), F.col("company.legal_name").alias("_name"), F.col("site_type").alias("_site"),
        F.col("physical_address.city").alias("city"), F.col("physical_address.state").alias("state"),
    )
    m = master.select(F.col("id").alias("matched_id"), F.col("company_name").alias("_matched"))
    return (
        queue.join(c.hint("merge"), "candidate_id", "left")
        .join(m.hint("merge"), "matched_id", "left")
        .select(
            "candidate_id",
            F.coalesce("_name", F.lit("(unknown)")).alias("company_name"),
            F.coalesce("_site", F.lit("-")).alias("site_type"),
            "city",
            "state",
            "resolution_outcome",
            F.coalesce("_matched", F.lit("-")).alias("matched_existing"),
            F.when(F.col("requires_human_review"), "yes").otherwise("no").alias("needs_extra_review"),
            "match_classification",
            F.round("match_score", 3).alias("match_score"),
            F.round("completeness_score", 3).alias("completeness_score"),
            "publication_state",
            F.round("review_priority", 3).alias("review_priority"),
            "review_status",
        )
    )


