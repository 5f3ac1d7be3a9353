"""From ranked matches to one conservative business outcome per candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.functions import text as tx
from sitefold.operators import matching as m

# Cut-offs of the outcome policy (name cut-offs live with the match score).
WEAK_NAME = 0.5
STRONG_ADDRESS, MODERATE_ADDRESS = 0.85, 0.6
CLOSE_MARGIN = 0.05
REVIEW_CONFIDENCE_CAP = 0.6
NO_RECORDS_REASON = "no comparison records available"

MATCH_FIELDS = [
    "master_id", "score", "name_score", "address_score", "phone_match", "domain_match",
    "sic_match", "city_state_match", "classification", "m_lifecycle",
]


def collect_matches(ranked: DataFrame, with_related: bool) -> DataFrame:
    """Per candidate: ``matches`` (ranks 1-3) and, for bounded sets, ``related_ids``.

    ``with_related`` needs ranked rows of a capped candidate set; the lists it
    collects are no longer than the cap.
    """
    row = F.struct("rank", *MATCH_FIELDS, m.match_reasons().alias("reasons"))
    aggs = [F.array_sort(F.collect_list(F.when(F.col("rank") <= 3, row))).alias("matches")]
    if with_related:
        related = F.array_sort(F.collect_list(F.when(m.strong_company(), F.struct("rank", "master_id"))))
        aggs.append(related["master_id"].alias("related_ids"))
        if "truncated" in ranked.columns:
            aggs.append(F.bool_or("truncated").alias("truncated"))
    return ranked.groupBy("candidate_id").agg(*aggs)


def _strong_location(b: Column) -> Column:
    return (
        (b["address_score"] >= STRONG_ADDRESS)
        | (b["phone_match"] & b["city_state_match"])
        | ((b["address_score"] >= MODERATE_ADDRESS) & b["city_state_match"])
    )


def _strong_company(b: Column) -> Column:
    return (b["name_score"] >= m.STRONG_NAME) | (
        (b["domain_match"] | b["sic_match"]) & (b["name_score"] >= m.MODERATE_NAME)
    )


def _evidence_reasons(b: Column) -> list[Column]:
    name, addr = b["name_score"], b["address_score"]
    return [
        F.when(b["domain_match"], "exact_domain_match"),
        F.when(b["sic_match"], "sic_match"),
        F.when(name >= m.STRONG_NAME, "strong_company_name_match").when(
            name >= m.MODERATE_NAME, "similar_company_name_match"
        ),
        F.when(addr >= STRONG_ADDRESS, "exact_normalized_address_match").when(
            addr >= MODERATE_ADDRESS, "strong_normalized_address_match"
        ),
        F.when(b["phone_match"], "exact_phone_match"),
        F.when(b["city_state_match"], "city_state_match"),
    ]


def decide(rows: DataFrame) -> DataFrame:
    """Outcome columns for rows holding candidate_id, site_type, matches, has_several.

    ``matches`` is null when there was nothing to compare with. Which situation a
    candidate is in is worked out once (``has_several``: two or more records of the same company); outcome, review flag, reasons and
    conflicts all follow from it.
    """
    best, second = F.get("matches", F.lit(0)), F.get("matches", F.lit(1))
    close = F.coalesce(
        (best["master_id"] != second["master_id"])
        & (best["score"] >= m.MEANINGFUL_SCORE)
        & (second["score"] >= m.MEANINGFUL_SCORE)
        & (best["score"] - second["score"] < CLOSE_MARGIN),
        F.lit(False),
    )
    site = F.coalesce("site_type", F.lit(""))
    company, location = _strong_company(best), _strong_location(best)
    continuity = best["domain_match"] | best["phone_match"]
    situation = (
        F.when(best.isNull(), "nothing")
        .when(close, "close")
        .when(company & location, "same")
        .when(company & (site == "branch"), "branch")
        .when(company & (site == "headquarters"), "hq")
        .when(company & F.col("has_several"), "several")
        .when(company, "moved")
        .when(location & (best["name_score"] < WEAK_NAME) & continuity, "renamed")
        .when(location, "location_only")
        .when(best["score"] < m.MEANINGFUL_SCORE, "weak")
        .otherwise("unclear")
    )
    s = F.col("situation")
    life = F.when(best["m_lifecycle"] == "deleted", "existing_location_is_deleted").when(
        best["m_lifecycle"] == "research_deleted", "existing_location_is_research_deleted"
    )
    conflict = (
        F.when(s.isin("close", "several"), "multiple_close_existing_location_matches")
        .when(s == "same", life)
        .when(
            (s == "moved") & (best["address_score"] < MODERATE_ADDRESS),
            "candidate_address_differs_from_best_existing_location",
        )
        .when(s.isin("renamed", "location_only"), "company_name_materially_different")
    )
    outcome = (
        F.when(s.isin("nothing", "weak"), "likely_new_company")
        .when(s == "same", "same_existing_location")
        .when(s == "branch", "new_branch_of_existing_company")
        .when(s == "hq", "new_headquarters_of_existing_company")
        .when(s == "moved", "possible_changed_location")
        .when(s == "renamed", "possible_name_change")
        .otherwise("ambiguous_manual_review")
    )
    site_reason = (
        F.when(s == "branch", "candidate_site_type_branch")
        .when(s == "hq", "candidate_site_type_headquarters")
        .when((s == "moved") & (site == "unknown"), "candidate_site_type_unknown")
        .when(s == "moved", "candidate_site_type_missing")
    )
    other_site = F.when(s.isin("branch", "hq"), "existing_company_other_location_found")
    reasons = (
        F.when(s == "nothing", F.array(F.lit("no_existing_locations_to_compare")))
        .when(s == "weak", F.array(F.lit("weak_or_no_match_evidence")))
        .otherwise(F.array_compact(F.array(*_evidence_reasons(best), site_reason, other_site)))
    )
    review = F.when(s == "same", life.isNotNull()).otherwise(~s.isin("nothing", "weak", "branch"))
    capped = F.when(
        F.col("requires_human_review"), F.least(best["score"], F.lit(REVIEW_CONFIDENCE_CAP))
    ).otherwise(best["score"])
    return (
        rows.withColumn("situation", situation)
        .withColumns(
            {
                "outcome": outcome,
                "requires_human_review": review,
                "reasons": reasons,
                "conflicts": F.array_compact(F.array(conflict)),
                "matched_id": F.when(s.isin("same", "branch", "hq", "moved", "renamed"), best["master_id"]),
            }
        )
        .withColumn("decision_confidence", F.when(s == "nothing", 1.0).otherwise(tx.fixed4(capped)))
    )


def best_match_columns() -> dict[str, Column]:
    """Best match of a row with ``matches``, with the defaults for an empty comparison set."""
    best = F.get("matches", F.lit(0))
    none = best.isNull()
    return {
        "best_id": best["master_id"],
        "match_score": F.coalesce(best["score"], F.lit(0.0)),
        "match_classification": F.coalesce(best["classification"], F.lit("likely_new")),
        "match_reasons": F.when(none, F.array(F.lit(NO_RECORDS_REASON))).otherwise(best["reasons"]),
    }


def resolve_retrieved(candidates: DataFrame, master: DataFrame, edges: DataFrame | None, order: str) -> DataFrame:
    """Decision per candidate over its bounded candidate set."""
    ranked = m.rank_retrieved(candidates, master, edges, order)
    found = collect_matches(ranked, with_related=True)
    rows = candidates.select(F.col("id").alias("candidate_id"), "site_type").join(found, "candidate_id", "left")
    rows = rows.withColumn("has_several", F.coalesce(F.size("related_ids") >= 2, F.lit(False)))
    decided = decide(rows).withColumns(best_match_columns())
    others = F.array_remove(F.col("related_ids"), F.col("matched_id"))
    wanted = F.col("situation").isin("branch", "hq") & (F.size(others) > 0)
    return decided.withColumn("related_ids", F.when(wanted, others)).withColumn("truncated", F.coalesce("truncated", F.lit(False)))


def resolve_all(candidates: DataFrame, master: DataFrame) -> DataFrame:
    """Decision per candidate over the whole master.

    Related records are not collected into a list here: for a chain there can be
    as many as the chain has sites. ``related_records`` gives them as rows.
    """
    found = collect_matches(m.rank_all(candidates, master, 3), with_related=False)
    related = m.company_links(candidates, master).counts().select("candidate_id", (F.col("n_sites") >= 2).alias("has_several"))
    rows = (
        candidates.select(F.col("id").alias("candidate_id"), "site_type")
        .join(found, "candidate_id", "left")
        .join(related, "candidate_id", "left")
        .withColumn("has_several", F.coalesce("has_several", F.lit(False)))
    )
    none = {"related_ids": F.lit(None).cast("array<string>"), "truncated": F.lit(False)}
    return decide(rows).withColumns(best_match_columns() | none)


def related_records(decided: DataFrame, candidates: DataFrame, master: DataFrame) -> DataFrame:
    """(candidate_id, related_id) for new branches and headquarters, matched record excluded.

    One row per site of the chain; ``matching.company_links`` holds the same in factors, which grow with companies only.
    """
    wanted = decided.where(F.col("situation").isin("branch", "hq")).select("candidate_id", "matched_id")
    return (
        m.company_links(candidates, master).pairs(wanted)
        .join(wanted.hint("merge"), "candidate_id")
        .where(F.col("master_id") != F.col("matched_id"))
        .select("candidate_id", F.col("master_id").alias("related_id"))
    )
