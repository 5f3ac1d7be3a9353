"""Enrichment job: research plan -> provider requests -> merged candidates, evidence and conflicts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefold import schemas
from sitefold.operators import evidence
from sitefold.operators.buckets import BucketedTable
from sitefold.operators.lineage import cut_lineage
from sitefold.operators.readiness import with_readiness

#: Place of a piece of evidence among all of its candidate: the run, the provider, the outcome, and the proposal in it.
ORDER = "struct<run:bigint,position:bigint,outcome:bigint,proposal:bigint>"
STORED = f"candidate_id string, path_key string, seq {ORDER}, value string, source_key string, derivation string, proposal {schemas.EVIDENCE}"


@dataclass
class Enriched:
    requests: DataFrame
    merged: DataFrame
    refused: DataFrame
    conflicts: DataFrame
    assessed: DataFrame
    asked: DataFrame
    columns: list[str]

    @cached_property
    def candidates(self) -> DataFrame:
        """The candidates after the run, with the evidence it accepted; written when first asked for."""
        given = self.assessed.select(self.columns)
        added = accepted(self.merged).groupBy(F.col("candidate_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("seq", "proposal")))["proposal"].alias("_added"))
        written = evidence.set_fields(given, evidence.filled_values(self.merged)).join(added, "id", "left")
        empty = F.array().cast(f"array<{schemas.EVIDENCE}>")
        after = written.withColumn("field_evidence", F.concat(F.coalesce("field_evidence", empty), F.coalesce("_added", empty))).drop("_added")
        return cut_lineage(after.select(given.columns))

    @cached_property
    def summary(self) -> DataFrame:
        """Publication state before and after, with the counts of fills, conflicts and requests."""
        requested = self.asked.groupBy("candidate_id").agg(F.count("*").alias("n_requests"))
        return evidence.state_change(self.assessed, self.candidates, self.merged).join(requested, "candidate_id", "left").withColumn(
            "n_requests", F.coalesce("n_requests", F.lit(0)))


def accepted(merged: DataFrame) -> DataFrame:
    """What a run keeps: everything but repeats of the same source and value."""
    return merged.where("merge_class <> 'repeat'")


def field_path(field: Column, contact_id: Column) -> Column:
    """Evidence path of a research field; contact fields need the target contact."""
    return F.when(field.startswith("contact."), F.concat_ws(".", F.lit("contact"), contact_id, F.substring_index(field, ".", -1))).otherwise(field)


def requests(candidates: DataFrame, providers: DataFrame, run_id: str, started_at: str, *, allowed: list[str] | None = None,
             max_providers: int | None = None) -> DataFrame:
    """What each eligible provider is asked about each candidate.

    candidate_id, provider_id, position, fields (planned and supported), target_contact_id, blockers, existing_evidence (of the fields
    asked for, in their order of insertion), run_id, started_at. A provider beyond ``max_providers``, one that cannot run, and one that
    supports no planned field is not asked. Row-local but for the join of plans and providers, a table of some hundred rows.
    """
    assessed = cut_lineage(with_readiness(candidates))
    return described(assessed, planned(assessed, providers, allowed, max_providers), run_id, started_at)


def planned(assessed: DataFrame, providers: DataFrame, allowed: list[str] | None, max_providers: int | None) -> DataFrame:
    """The requests themselves: candidate_id, provider_id, position, fields."""
    return evidence.provider_requests(evidence.plan_fields(assessed, list(evidence.RESEARCH_FIELDS), allowed), providers, max_providers)


def described(assessed: DataFrame, asked: DataFrame, run_id: str, started_at: str) -> DataFrame:
    """Requests with what a provider is told about the candidate."""
    about = assessed.select(F.col("id").alias("candidate_id"), evidence.target_contact()["id"].alias("target_contact_id"), "blockers", "field_evidence")
    paths = F.transform("fields", lambda f: field_path(f, F.col("target_contact_id")))
    known = F.filter(F.coalesce("field_evidence", F.array().cast(f"array<{schemas.EVIDENCE}>")), lambda e: F.array_contains(F.col("_paths"), e["path_key"]))
    return asked.join(about, "candidate_id").withColumn("_paths", paths).select(
        "candidate_id", "provider_id", "position", "fields", "target_contact_id", "blockers", known.alias("existing_evidence"),
        F.lit(run_id).alias("run_id"), F.lit(started_at).alias("started_at"))


def evidence_value(e: Column) -> Column:
    """What a piece of evidence says: its normalised value where it has one."""
    return F.coalesce(e["normalized_json"], e["value_json"])


def prior_proposals(candidates: DataFrame) -> DataFrame:
    """The candidates' own evidence as rows of the merge, before all runs."""
    rows = candidates.select(F.col("id").alias("candidate_id"), F.posexplode("field_evidence").alias("at", "proposal"))
    order = F.struct(F.lit(0).alias("run"), F.lit(0).alias("position"), F.lit(0).alias("outcome"), F.col("at").alias("proposal")).cast(ORDER)
    return _merge_rows(rows.withColumn("seq", order))


def _merge_rows(rows: DataFrame, *more: str) -> DataFrame:
    e = F.col("proposal")
    return rows.select("candidate_id", e["path_key"].alias("path_key"), "seq", evidence_value(e).alias("value"),
                       evidence.source_identity(e["source"]).alias("source_key"), e["derivation"].alias("derivation"), "proposal", *more)


def store(spark: SparkSession, path: str, buckets: int = 64) -> BucketedTable:
    """The evidence that earlier runs have accepted, by candidate and path: what a run's proposals meet, without the candidates."""
    return BucketedTable(spark, path, STORED, ["candidate_id", "path_key"], buckets)


def enrich(candidates: DataFrame, providers: DataFrame, results: DataFrame, run_id: str, started_at: str, *, run: int = 1,
           known: BucketedTable | None = None, allowed: list[str] | None = None, max_providers: int | None = None) -> Enriched:
    """One enrichment run over all candidates.

    ``results`` holds what the providers answered: candidate_id, provider_id, provider_status (completed or failed), outcome (its place in the
    answer), status (success, conflict, not_found, skipped), item (the proposal's place in the outcome) and proposal (evidence). A failed
    answer gives nothing and stops no other one; answers of providers that were not asked are left out. Proposals go in the order of
    provider, outcome and item. Those with a confidence that is not a number from 0 to 1 are refused, with the reason, and neither merged nor kept.

    What a proposal does follows from all evidence of its field before it: the candidate's own, or, with ``known``, what earlier runs have stored
    - the table's buckets that hold fields with new proposals are read, and no others - and the run's own so far. Every accepted proposal,
    conflicts included, is appended to the candidate's evidence; repeats of the same source and value are not. With ``known``, they are appended to it as
    batch ``run`` (from 1), and a run that is repeated replaces them. The candidates are assessed and written once, and all steps start from
    that; the requests carry evidence and the candidates after the run are made only for those who read them.
    """
    assessed = cut_lineage(with_readiness(candidates))
    candidates = assessed.select(candidates.columns)
    asked = cut_lineage(planned(assessed, providers, allowed, max_providers))
    answers = results.where((F.col("provider_status") == "completed") & F.col("status").isin("success", "conflict") & F.col("proposal").isNotNull())
    answers = answers.join(asked.select("candidate_id", "provider_id", "position"), ["candidate_id", "provider_id"])
    order = F.struct(F.lit(run).alias("run"), "position", "outcome", F.col("item").alias("proposal")).cast(ORDER)
    rows = answers.withColumn("seq", order).withColumn("_valid", evidence.valid_confidence(F.col("proposal.confidence")))
    rows = cut_lineage(rows.select("candidate_id", "provider_id", "seq", "proposal", (F.col("status") == "conflict").alias("force_conflict"), "_valid"))
    refused = rows.where("not _valid").select("candidate_id", "provider_id", "seq", "proposal", F.lit("invalid_confidence").alias("reject_reason"))
    fresh = rows.where("_valid")
    fields = fresh.select("candidate_id", F.col("proposal.path_key").alias("path_key")).distinct()
    before = prior_proposals(candidates)
    if known is not None:
        stored = known.of(fields).where(F.col("batch") < run).drop("bucket", "batch")
        # Where the candidate's evidence holds some of it already, it counts twice, which changes nothing.
        before = before.unionByName(stored)
    before = before.join(fields, ["candidate_id", "path_key"], "left_semi")
    # Of what was there before, only value, source and place count.
    old = before.withColumns({"is_prior": F.lit(True), "force_conflict": F.lit(False), "proposal": F.lit(None).cast(schemas.EVIDENCE)})
    proposals = old.unionByName(_merge_rows(fresh, "force_conflict").withColumn("is_prior", F.lit(False)))
    current = evidence.field_values(candidates)
    merged = cut_lineage(evidence.classify_proposals(proposals, current).where("not is_prior"))

    if known is not None:
        known.append(accepted(merged), run)
    conflicts = merged.where(F.col("merge_class").isin("conflict", "provider_conflict")).select("candidate_id", "path_key", F.col("current_value").alias("existing_value"), "seq", "proposal")
    return Enriched(described(assessed, asked, run_id, started_at), merged, refused, conflicts, assessed, asked, candidates.columns)
