"""Ingest job: mapped drafts -> new candidates, identities, ledger rows and run metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.operators.tables import insert_if_absent
from sitefold.schemas import as_candidates

LEDGER_KEYS = ["source_id", "fingerprint"]


@dataclass
class Ingested:
    candidates: DataFrame
    identities: DataFrame
    ledger_rows: DataFrame
    run: DataFrame
    skipped: DataFrame


def _id(prefix: str) -> Column:
    """Stable id of an observation: the same fingerprint always gives the same one."""
    return F.concat(F.lit(prefix), F.left(F.sha2(F.concat_ws("|", *LEDGER_KEYS), 256), F.lit(32)))


def new_drafts(drafts: DataFrame, ledger: DataFrame) -> DataFrame:
    """First valid draft per fingerprint that the ledger does not know yet."""
    return insert_if_absent(ledger, drafts.where("reject_reason IS NULL"), LEDGER_KEYS, ["seq"])


def run_counters(drafts: DataFrame, ledger: DataFrame) -> DataFrame:
    """raw, valid, new, already-ingested and skipped counts per source.

    Counted over one row per fingerprint; the drafts themselves are only combined map-side.
    """
    per_key = drafts.groupBy("source_id", F.when(F.col("reject_reason").isNull(), F.col("fingerprint")).alias("fingerprint")).agg(
        F.count("*").alias("n")
    )
    known = ledger.select(*LEDGER_KEYS, F.lit(True).alias("_known"))
    valid = F.col("fingerprint").isNotNull()
    fresh = valid & F.col("_known").isNull()
    zero = F.lit(0)
    return (
        per_key.join(known, LEDGER_KEYS, "left")
        .groupBy("source_id")
        .agg(
            F.sum("n").alias("raw_count"),
            F.coalesce(F.sum(F.when(valid, F.col("n"))), zero).alias("valid_count"),
            F.count_if(fresh).alias("new_candidate_count"),
            F.coalesce(F.sum(F.when(valid, F.col("n") - F.when(fresh, 1).otherwise(0))), zero).alias("already_ingested_count"),
            F.coalesce(F.sum(F.when(~valid, F.col("n"))), zero).alias("skipped_count"),
        )
    )


def skip_reasons(drafts: DataFrame) -> DataFrame:
    return drafts.where("reject_reason IS NOT NULL").groupBy("source_id", "reject_reason").agg(F.count("*").alias("n"))


def ledger_of(candidates: DataFrame, run_id: str, ingested_at: str) -> DataFrame:
    """Ledger rows of new candidates, which hold all that the ledger keeps."""
    return candidates.select(
        *[F.col(f"source.{k}").alias(k) for k in LEDGER_KEYS], "source.source_record_id", F.col("id").alias("candidate_id"),
        F.lit(run_id).alias("first_run_id"), F.lit(ingested_at).alias("first_ingested_at"),
    )


def ingest(drafts: DataFrame, ledger: DataFrame, run_id: str, ingested_at: str) -> Ingested:
    """Everything one run appends. Running it again on the same input adds nothing."""
    fresh = new_drafts(drafts, ledger).withColumns({"id": _id("loc-"), "_company_id": _id("co-")})
    source = F.struct(
        "source_id", "source_name", "source_url", F.col("record_id").alias("source_record_id"), "fingerprint",
        F.lit(ingested_at).alias("ingested_at"),
    )
    # One provisional identity per observation; companies are never merged here.
    company = F.col("company").withField("id", F.col("_company_id"))
    candidates = as_candidates(fresh.withColumns({"source": source, "company": company}))
    run = run_counters(drafts, ledger).withColumns({"run_id": F.lit(run_id), "status": F.lit("success")})
    return Ingested(candidates, candidates.select("company.*"), ledger_of(candidates, run_id, ingested_at), run, skip_reasons(drafts))


def append_run(result: Ingested, root: str) -> None:
    """Write a run below ``root``. The ledger comes last: a run that dies before is simply repeated."""
    for name in ("candidates", "identities", "run", "skipped", "ledger_rows"):
        getattr(result, name).write.mode("append").parquet(f"{root.rstrip('/')}/{name}")
