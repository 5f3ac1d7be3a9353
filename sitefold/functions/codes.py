"""Closed vocabularies and the code normalisers built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefold.functions.text import trim_ws, truthy

# Codes and names as the master directory and the reviewers use them.
SITE_TYPE_CODES = {
    "S": "single_site",
    "H": "headquarters",
    "B": "branch",
    "R": "regional_headquarters",
    "U": "unknown",
}
LIFECYCLE_CODES = {
    "DIRE": "published",
    "DEL": "deleted",
    "RDL": "research_deleted",
    "RDEL": "research_deleted",
    "RESEARCH": "research",
    "RSCH": "research",
    "DELE": "deleted",
}
LIFECYCLE_NAMES = ["published", "research", "deleted", "research_deleted"]
OUTCOMES = [
    "same_existing_location",
    "possible_changed_location",
    "new_branch_of_existing_company",
    "new_headquarters_of_existing_company",
    "possible_name_change",
    "likely_new_company",
    "ambiguous_manual_review",
]
EXISTING_RELATED_OUTCOMES = [
    "same_existing_location",
    "new_branch_of_existing_company",
    "new_headquarters_of_existing_company",
    "possible_changed_location",
    "possible_name_change",
]
NEW_COMPANY_OUTCOME = "likely_new_company"
ABSTENTION_OUTCOME = "ambiguous_manual_review"
ACTION_STATUS = {
    "approve_new_company": "approved",
    "approve_new_branch": "approved",
    "link_existing_location": "approved",
    "mark_duplicate": "duplicate",
    "needs_more_research": "needs_more_research",
    "reject_source_observation": "rejected",
}
ACTIONS_NEEDING_A_RECORD = ["approve_new_branch", "link_existing_location", "mark_duplicate"]
ACTIONS_FORBIDDING_A_RECORD = ["approve_new_company"]
SINGLE_SOURCE_CONFIDENCE = 0.6


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Value of ``key`` in a small fixed table, null when absent."""
    out = F.lit(None).cast("string")
    for value in dict.fromkeys(table.values()):
        out = F.when(key.isin([k for k, v in table.items() if v == value]), value).otherwise(out)
    return out


def _coded(raw: Column, name: Column) -> Column:
    return F.struct(
        F.coalesce(name, F.lit("unknown")).alias("normalized"),
        raw.alias("raw_code"),
        name.isNotNull().alias("recognized"),
    )


def site_type(raw: Column) -> Column:
    """Struct (normalized, raw_code, recognized) for a site-type code or name."""
    t = trim_ws(raw)
    as_name = F.regexp_replace(F.lower(t), r"\s+", "_")
    by_name = F.when(as_name.isin(list(SITE_TYPE_CODES.values())), as_name)
    return _coded(raw, F.coalesce(lookup(F.upper(t), SITE_TYPE_CODES), by_name))


def lifecycle(raw: Column) -> Column:
    """Struct (normalized, raw_code, recognized) for a master status code."""
    t = trim_ws(raw)
    by_name = F.when(F.lower(t).isin(LIFECYCLE_NAMES), F.lower(t))
    return _coded(raw, F.coalesce(lookup(F.upper(t), LIFECYCLE_CODES), by_name))


def status_for_action(action: Column) -> Column:
    return lookup(action, ACTION_STATUS)


def action_reject_reason(action: Column, selected_id: Column) -> Column:
    """Why a reviewer's action cannot be recorded, null when it can."""
    has_id = truthy(trim_ws(selected_id))
    return (
        F.when(~F.coalesce(action.isin(list(ACTION_STATUS)), F.lit(False)), "unknown action")
        .when(action.isin(ACTIONS_FORBIDDING_A_RECORD) & has_id, "record id not allowed")
        .when(action.isin(ACTIONS_NEEDING_A_RECORD) & ~has_id, "record id required")
    )
