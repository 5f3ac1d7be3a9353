"""Life cycle of an ingest run: a record that it started, its outputs, a record of how it ended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefold.operators.lineage import cut_lineage
from sitefold.plans import ingest as batch

COUNTS = ("raw_count", "valid_count", "new_candidate_count", "already_ingested_count", "skipped_count")
RECORD = (
    "run_id string, source_id string, source_name string, started_at string, step int, status string, finished_at string, "
    + ", ".join(f"{c} bigint" for c in COUNTS) + ", error_message string"
)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows below ``path``; none before the first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def _record(spark: SparkSession, root: str, step: int, row: dict) -> None:
    """One step of a run in a folder of its own, so that a run that is repeated replaces its records."""
    values = [{**row, "step": step}.get(f.split(" ")[0]) for f in RECORD.split(", ")]
    spark.createDataFrame([tuple(values)], RECORD).coalesce(1).write.mode("overwrite").parquet(f"{root}/runs/run={row['run_id']}/step={step}")


def source_runs(spark: SparkSession, root: str) -> DataFrame:
    """The last record of each run: ``running`` until it has ended, then ``success`` or ``failed``."""
    rows = _read(spark, f"{root.rstrip('/')}/runs/*/*", RECORD)
    names = [f.split(" ")[0] for f in RECORD.split(", ") if not f.startswith(("run_id ", "step "))]
    return rows.groupBy("run_id").agg(F.max_by(F.struct(*names), "step").alias("r")).select("run_id", "r.*")


def known_observations(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """Keys that other runs brought in. What an interrupted attempt at this run wrote does not count."""
    rows = _read(spark, f"{root.rstrip('/')}/ledger_rows/*", "source_id string, fingerprint string, first_run_id string")
    return rows.where(F.col("first_run_id") != run_id)


def run_source(spark: SparkSession, root: str, run_id: str, source_id: str, source_name: str, fetch: Callable[[], DataFrame],
               clock: Callable[[], str]) -> dict:
    """Ingest what ``fetch`` returns (mapped drafts) below ``root``; returns the record of the run's end.

    The record of the start is written before anything is read. Drafts are mapped and written once; candidates, identities, skips and ledger go to
    ``<name>/run=<run_id>``, the ledger last, and a repeated run replaces them. Counters are counted from the files written, which lost
    executors cannot change. A feed without rows ends as a success with zeros. A feed that cannot be read or mapped ends as
    ``failed`` with the error and the counts known by then; its run does not raise, as other sources go on.
    """
    root = root.rstrip("/")
    row: dict = {"run_id": run_id, "source_id": source_id, "source_name": source_name, "started_at": clock()}
    _record(spark, root, 0, {**row, "status": "running"})
    counts = dict.fromkeys(COUNTS, 0)
    try:
        drafts = cut_lineage(fetch())
        seen = drafts.agg(F.count("*").alias("raw"), F.count_if(F.col("reject_reason").isNull()).alias("valid")).first()
        counts |= {"raw_count": seen["raw"], "valid_count": seen["valid"], "skipped_count": seen["raw"] - seen["valid"]}
        result = batch.ingest(drafts, known_observations(spark, root, run_id), run_id, row["started_at"])
        result.candidates.write.mode("overwrite").parquet(f"{root}/candidates/run={run_id}")
        # The drafts are grouped once: what else is new is read off the candidates written.
        new = spark.read.schema(result.candidates.schema).parquet(f"{root}/candidates/run={run_id}")
        rest = {"identities": new.select("company.*"), "skipped": result.skipped, "ledger_rows": batch.ledger_of(new, run_id, row["started_at"])}
        for name, rows in rest.items():
            rows.write.mode("overwrite").parquet(f"{root}/{name}/run={run_id}")
        fresh = spark.read.parquet(f"{root}/ledger_rows/run={run_id}").count()
        counts |= {"new_candidate_count": fresh, "already_ingested_count": seen["valid"] - fresh}
        end = {"status": "success"}
    except Exception as error:  # whatever breaks a feed is the run's result
        end = {"status": "failed", "error_message": str(error)}
    done = {**row, **counts, **end, "finished_at": clock()}
    _record(spark, root, 1, done)
    return done
