"""Batch job of the review ledger: validate a batch of decisions, append what is accepted, keep what is refused."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitefold.operators import review
from sitefold.operators.lineage import cut_lineage

# Columns of the ledger as it is stored, without the machine's recommendation, whose layout is the queue's.
LEDGER = (
    "event_id bigint, candidate_id string, sequence bigint, action string, previous_status string, new_status string, "
    "selected_id string, reviewer string, notes string, decided_at timestamp, "
    "field_corrections array<struct<path_key:string,previous_value:string,corrected_value:string,reason:string>>, batch string"
)


def stored_ledger(like: DataFrame, root: str) -> DataFrame:
    """The ledger below ``root``; empty before the first batch."""
    spark = like.sparkSession
    try:
        return spark.read.schema(LEDGER).option("basePath", f"{root}/ledger").parquet(f"{root}/ledger")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def append_decisions(decisions: DataFrame, queue: DataFrame, root: str, batch: str) -> DataFrame:
    """Append one batch below ``root`` and return its ledger rows.

    ``decisions`` has event_id, candidate_id, decided_at, action, selected_id, and may have reviewer, notes and field_corrections (values as text, kept
    as given and in their order, an empty list if there are none; they never change the candidate); ``queue`` is the review
    queue with its statuses, which ``review.queue_after`` brings up to date with the rows returned. Rows go to
    ``ledger/batch=<batch>`` with the machine's recommendation at the time, refused ones to ``rejected/batch=<batch>`` with
    their reason. A batch that is run again replaces what it wrote before.
    """
    root = root.rstrip("/")
    for name in ("reviewer", "notes"):
        if name not in decisions.columns:
            decisions = decisions.withColumn(name, F.lit(None).cast("string"))
    schema = StructType.fromDDL(LEDGER)
    kind = schema["field_corrections"].dataType
    given = F.col("field_corrections") if "field_corrections" in decisions.columns else F.lit(None)
    decisions = decisions.withColumn("field_corrections", F.coalesce(given.cast(kind), F.array().cast(kind)))
    ledger = stored_ledger(decisions, root).where(F.col("batch") != batch)
    rows, refused = review.record(decisions, queue, ["decided_at", "event_id"], F.to_date("decided_at"), ledger)
    keep = [c for c in schema.names if c != "batch"]
    rows = cut_lineage(rows.withColumn("sequence", F.col("sequence").cast("bigint")).select(*keep, "machine_recommendation"))
    refused.write.mode("overwrite").parquet(f"{root}/rejected/batch={batch}")
    rows.write.mode("overwrite").parquet(f"{root}/ledger/batch={batch}")
    return rows
