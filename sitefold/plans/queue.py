"""Score-and-queue job: candidates against the master -> review queue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefold.operators import policy, readiness


def score_candidates(candidates: DataFrame, master: DataFrame, edges: DataFrame | None = None,
                     order: str = "id", mode: str = "all") -> DataFrame:
    """Machine columns of the review queue, one row per candidate.

    ``mode`` "all" compares with the whole master, where nothing is cut and ``related_ids`` is null: a chain may have any number of
    sites, which ``policy.related_records`` gives as rows. "retrieved" compares with the bounded candidate set only (``edges`` and
    ``order``, the master's file-order column, are for it) and marks in ``truncated`` the candidates that had more.
    """
    if mode == "retrieved":
        decided = policy.resolve_retrieved(candidates, master, edges, order)
    elif mode == "all":
        decided = policy.resolve_all(candidates, master)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    machine = decided.select(
        "candidate_id", "best_id", "match_score", "match_classification", "match_reasons",
        F.struct(*[F.get("matches", F.lit(0))[f].alias(f) for f in (
            "name_score", "address_score", "phone_match", "domain_match", "sic_match", "city_state_match")]).alias("match_evidence"),
        F.col("outcome").alias("resolution_outcome"),
        F.col("decision_confidence").alias("resolution_confidence"),
        F.col("reasons").alias("resolution_reasons"),
        F.col("conflicts").alias("resolution_conflicts"),
        "matched_id",
        "related_ids", "truncated",
        F.slice("matches", 2, 2).alias("alternatives"),
        "requires_human_review",
    )
    described = readiness.with_readiness(readiness.with_completeness(candidates)).select(
        F.col("id").alias("candidate_id"), "site_type", "employee_size_site", "completeness_score", "present_fields",
        "missing_fields", "publication_state", "blockers", "unresolved_rules", "satisfied_requirements",
        "optional_missing_fields", "publication_ready",
    )
    priority = readiness.review_priority(F.col("completeness_score"), F.col("match_classification"))
    return machine.join(described, "candidate_id").withColumn("review_priority", priority).drop(
        "site_type", "employee_size_site"
    )
