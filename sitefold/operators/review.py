"""Reviewer decisions: validation, append-only ledger, status chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import codes


def latest_decisions(ledger: DataFrame) -> DataFrame:
    """Last decision per candidate; combines map-side."""
    last = F.max_by(F.struct("sequence", "action", "new_status", "notes"), "sequence")
    return ledger.groupBy("candidate_id").agg(last.alias("d")).select("candidate_id", "d.*")


def history(ledger: DataFrame, candidate_id: str) -> DataFrame:
    return ledger.where(F.col("candidate_id") == candidate_id).orderBy("sequence")


def status_mismatches(queue: DataFrame, ledger: DataFrame) -> DataFrame:
    """Queue rows whose status is not what the ledger says (pending without a decision)."""
    last = latest_decisions(ledger).select("candidate_id", F.col("new_status").alias("_ledger_status"))
    return (
        queue.select("candidate_id", "review_status")
        .join(last, "candidate_id", "left")
        .select("candidate_id", "review_status", F.coalesce("_ledger_status", F.lit("pending")).alias("ledger_status"))
        .where(F.col("review_status") != F.col("ledger_status"))
    )


def validate_decisions(decisions: DataFrame, queue: DataFrame, ledger: DataFrame | None = None, off: DataFrame | None = None) -> DataFrame:
    """Add ``reject_reason``; null means the decision can be recorded.

    ``off`` holds the candidates whose queue row and ledger disagree, where that is known already; else ``ledger`` tells.
    """
    known = queue.select("candidate_id", F.lit(True).alias("_queued"))
    rows = decisions.join(known, "candidate_id", "left")
    broken = F.lit(False)
    if off is None and ledger is not None:
        off = status_mismatches(queue, ledger)
    if off is not None:
        rows = rows.join(off.select("candidate_id", F.lit(True).alias("_off")), "candidate_id", "left")
        broken = F.col("_off").isNotNull()
    reason = F.coalesce(
        codes.action_reject_reason(F.col("action"), F.col("selected_id")),
        F.when(F.col("_queued").isNull(), "no review queue row").when(broken, "queue and ledger disagree"),
    )
    return rows.withColumn("reject_reason", reason).drop("_queued", "_off")


def chain(decisions: DataFrame, order: list[str], chunk: Column, ledger: DataFrame | None = None) -> DataFrame:
    """Add ``new_status``, ``sequence`` and ``previous_status`` in decision order.

    Numbering runs in two steps: inside a (candidate, chunk) group, and over one
    summary row per group. ``chunk`` must grow with the order (the day of a time
    stamp, say). A candidate with a large share of all decisions is thereby spread
    over its chunks and never sorted in one task.
    """
    rows = decisions.withColumns({"new_status": codes.status_for_action(F.col("action")), "_chunk": chunk})
    inside = Window.partitionBy("candidate_id", "_chunk").orderBy(*order)
    rows = rows.withColumns(
        {"_n": F.row_number().over(inside), "_before": F.lag("new_status").over(inside)}
    )
    groups = rows.groupBy("candidate_id", "_chunk").agg(
        F.count("*").alias("_size"), F.max_by("new_status", F.struct(*order)).alias("_last")
    )
    over = Window.partitionBy("candidate_id").orderBy("_chunk")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "candidate_id", "_chunk",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.lag("_last").over(over).alias("_carried"),
    )
    if ledger is not None:
        last = latest_decisions(ledger).select(
            "candidate_id", F.col("sequence").alias("_base"), F.col("new_status").alias("_base_status")
        )
        groups = groups.join(last, "candidate_id", "left")
    else:
        groups = groups.withColumns({"_base": F.lit(0), "_base_status": F.lit(None).cast("string")})
    return (
        rows.join(groups, ["candidate_id", "_chunk"])
        .withColumn("sequence", F.coalesce("_base", F.lit(0)) + F.col("_offset") + F.col("_n"))
        .withColumn("previous_status", F.coalesce("_before", "_carried", "_base_status", F.lit("pending")))
        .drop("_chunk", "_n", "_before", "_offset", "_carried", "_base", "_base_status")
    )


def machine_snapshot(queue: DataFrame) -> DataFrame:
    """What the machine recommended, per candidate, as kept with each decision."""
    return queue.select(
        "candidate_id",
        F.struct(
            "match_classification", "match_score",
            F.coalesce("matched_id", "best_id").alias("machine_selected_id"),
            "resolution_outcome", "resolution_confidence", "requires_human_review",
            "resolution_reasons", "resolution_conflicts", "completeness_score", "publication_state",
            F.col("blockers.rule_id").alias("blocker_rule_ids"),
            "review_priority",
        ).alias("machine_recommendation"),
    )


def record(decisions: DataFrame, queue: DataFrame, order: list[str], chunk: Column,
           ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(ledger rows to append, rejected decisions with reason)."""
    checked = validate_decisions(decisions, queue, ledger)
    accepted = checked.where("reject_reason IS NULL").drop("reject_reason")
    rows = chain(accepted, order, chunk, ledger).join(machine_snapshot(queue), "candidate_id")
    return rows, checked.where("reject_reason IS NOT NULL")


def queue_after(queue: DataFrame, appended: DataFrame) -> DataFrame:
    """Queue with status and note of the last appended decision."""
    last = latest_decisions(appended).select(
        "candidate_id", F.col("new_status").alias("_status"), F.col("notes").alias("_note"), F.lit(True).alias("_hit")
    )
    return (
        queue.join(last, "candidate_id", "left")
        .withColumns(
            {
                "review_status": F.coalesce("_status", "review_status"),
                "reviewer_note": F.when(F.col("_hit"), F.col("_note")).otherwise(F.col("reviewer_note")),
            }
        )
        .drop("_status", "_note", "_hit")
    )
