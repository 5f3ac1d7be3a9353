"""Streaming forms of ingest, arrival counting and the review ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sitefold.operators import review
from sitefold.operators.buckets import BucketedTable
from sitefold.operators.lineage import cut_lineage
from sitefold.plans import ingest as batch


def stream_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


#: Rows of the dedup ledger as the ingest job gives them.
DEDUP_LEDGER = (
    "source_id string, fingerprint string, source_record_id string, candidate_id string, first_run_id string, first_ingested_at string"
)


def dedup_ledger(spark: SparkSession, root: str, buckets: int = 64) -> BucketedTable:
    """The ledger below ``root``, in buckets of its keys; ``compacted`` is the job that merges its small files."""
    return BucketedTable(spark, f"{root.rstrip('/')}/ledger_rows", DEDUP_LEDGER, batch.LEDGER_KEYS, buckets)


def ingest_stream(rows: DataFrame, mapper: Callable[[DataFrame], DataFrame], root: str, checkpoint: str,
                  ingested_at: str, buckets: int = 64) -> StreamingQuery:
    """Micro-batches through the batch ingest; the ledger below ``root`` keeps it idempotent.

    Each micro-batch writes into folders of its own number, replacing what an
    interrupted attempt at the same batch left behind. It reads those buckets of the
    ledger that its own fingerprints fall into; the ledger's rows come last.
    """
    root = root.rstrip("/")
    ledger = dedup_ledger(rows.sparkSession, root, buckets)

    def one_batch(df: DataFrame, number: int) -> None:
        # Candidates, ledger, counters and skips all start from the mapped batch: it is mapped once.
        drafts = cut_lineage(mapper(df))
        # what this same batch wrote before a restart does not count as known
        known = ledger.of(drafts).where(F.col("batch") != number)
        result = batch.ingest(drafts, known, f"batch-{number}", ingested_at)
        for name in ("candidates", "run", "skipped"):
            getattr(result, name).write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")
        ledger.append(result.ledger_rows, number)

    return (
        rows.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def arrival_counts(drafts: DataFrame, event_time: str = "ts", delay: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Tumbling counts of distinct arrivals by source and status.

    A fingerprint seen again with the same status within the watermark delay counts
    once; rows later than the watermark are dropped by the engine and show in the
    query's progress.
    """
    status = F.when(F.col("reject_reason").isNull(), "valid").otherwise("skipped")
    return (
        drafts.withColumn("status", status)
        .select(F.col(event_time).cast("timestamp").alias(event_time), "source_id", "fingerprint", "status")
        .withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark(["source_id", "fingerprint", "status"])
        .groupBy(F.window(event_time, width).alias("w"), "source_id", "status")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "source_id", "status", "n")
    )


def write_counts(counts: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Write changed counts of every micro-batch below ``root``; a repeated batch replaces itself."""
    root = root.rstrip("/")

    def one_batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/batch={number}")

    return (
        counts.writeStream.outputMode("update").foreachBatch(one_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current_counts(spark: SparkSession, root: str) -> DataFrame:
    """The last written count per window, source and status."""
    rows = spark.read.option("basePath", root).parquet(root)
    key = ["window_start", "source_id", "status"]
    return rows.groupBy(*key).agg(F.max_by("n", "batch").alias("n"))


def windowed_arrivals(drafts: DataFrame, root: str, checkpoint: str, event_time: str = "ts", delay: str = "1 hour",
                      width: str = "1 hour", buckets: int = 64) -> StreamingQuery:
    """Tumbling counts of distinct arrivals, with late rows kept beside them.

    The watermark of a micro-batch is the latest event time of all batches before it, less ``delay``; the first batch has none. A row
    before the watermark, or without an event time, goes whole to ``late`` below ``root``, with the watermark it missed. All others
    count in their window, equal (source, fingerprint, status) once per window, whatever the order of rows and batches (nulls are equal).
    ``counts`` holds what each batch adds; ``window_counts`` sums it up. A batch compares its keys with the buckets of ``seen``
    that they fall into, from the watermark's window on; earlier windows are final.
    """
    spark = drafts.sparkSession
    root = root.rstrip("/")
    key = ["window_start", "source_id", "fingerprint", "status"]
    seen = BucketedTable(spark, f"{root}/seen", "window_start timestamp, source_id string, fingerprint string, status string",
                         ["source_id", "fingerprint"], buckets)

    def one_batch(df: DataFrame, number: int) -> None:
        at = F.col(event_time)
        rows = cut_lineage(df.withColumn(event_time, at.cast("timestamp")))
        before = spark.read.schema("high timestamp").parquet(f"{root}/clock/batch={number - 1}") if number else spark.createDataFrame([], "high timestamp")
        # One number reaches the driver: the watermark in microseconds, or none yet.
        mark = before.agg(F.unix_micros(F.max("high") - F.expr(f"INTERVAL {delay}")).alias("m")).first()["m"]
        marked = rows.withColumn("watermark", F.timestamp_micros(F.lit(mark).cast("bigint")))
        late = at.isNull() | F.coalesce(at < F.col("watermark"), F.lit(False))
        marked.where(late).write.mode("overwrite").parquet(f"{root}/late/batch={number}")
        status = F.when(F.col("reject_reason").isNull(), "valid").otherwise("skipped")
        counted = marked.where(~late).select(F.window(at, width)["start"].alias("window_start"), "source_id", "fingerprint", status.alias("status"))
        counted = cut_lineage(counted.distinct())
        past = seen.of(counted).where(F.col("batch") != number)
        if mark is not None:  # windows that ended before the watermark take no more rows
            past = past.where(F.col("window_start") >= F.timestamp_micros(F.lit(mark)) - F.expr(f"INTERVAL {width}"))
        same = [counted[c].eqNullSafe(past[c]) for c in key]
        fresh = cut_lineage(counted.join(past, same, "left_anti"))
        counts = fresh.groupBy("window_start", "source_id", "status").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{root}/counts/batch={number}")
        seen.append(fresh, number)
        before.unionByName(rows.select(at.alias("high"))).agg(F.max("high").alias("high")).write.mode("overwrite").parquet(f"{root}/clock/batch={number}")

    return (
        drafts.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def window_counts(spark: SparkSession, root: str) -> DataFrame:
    """Distinct arrivals per window, source and status so far."""
    return spark.read.parquet(f"{root.rstrip('/')}/counts").groupBy("window_start", "source_id", "status").agg(F.sum("n").alias("n"))


#: Where a candidate stands in review: its last decision (sequence 0 and pending without one) and whether the queue says the same.
STANDING = "candidate_id string, sequence bigint, new_status string, agrees boolean"


def open_standing(queue: DataFrame, ledger: DataFrame | None, standing: BucketedTable) -> None:
    """Add the candidates of ``queue`` that ``standing`` does not hold yet, with their last decision in ``ledger``.

    ``queue`` has candidate_id and may have review_status; without it every row agrees. Rows get a batch number below those of the stream.
    """
    known = standing.all()
    last = F.lit(None).cast("string")
    rows = queue.where("candidate_id IS NOT NULL")
    rows = rows.groupBy("candidate_id").agg(F.collect_set(F.col("review_status") if "review_status" in queue.columns else last).alias("_said"))
    rows = rows.join(known.select("candidate_id").distinct(), "candidate_id", "left_anti")
    if ledger is None:
        rows = rows.withColumns({"sequence": F.lit(0), "new_status": F.lit("pending")})
    else:
        past = ledger.groupBy("candidate_id").agg(F.max("sequence").alias("sequence"), F.max_by("new_status", "sequence").alias("new_status"))
        rows = rows.join(past, "candidate_id", "left").withColumns(
            {"sequence": F.coalesce("sequence", F.lit(0)), "new_status": F.coalesce("new_status", F.lit("pending"))}
        )
    rows = cut_lineage(rows.select("candidate_id", "sequence", "new_status", F.forall("_said", lambda s: s == F.col("new_status")).alias("agrees")))
    first = known.agg(F.min("batch").alias("b")).first()["b"]
    standing.append(rows, min(first or 0, 0) - 1)


def ledger_batches(decisions: DataFrame, queue: DataFrame, root: str, checkpoint: str, ledger: DataFrame | None = None,
                   buckets: int = 64) -> StreamingQuery:
    """Review ledger as a stream: each micro-batch is validated and chained onto the decisions so far.

    ``queue`` and ``ledger`` (the decisions before the stream, if any) are read once, at the start: ``standing`` below ``root`` keeps
    one row per candidate and batch that changed it, in buckets, and a batch reads the buckets of its own candidates; no batch reads a
    ledger. Validation and chain are the batch operators: a decision needs a row of ``queue`` that says what the ledger says, and a
    candidate with very many decisions is numbered in chunks, never as one state group. Decisions accepted by the stream keep both sides
    equal, so whether they agree is settled at the start. Refused ones go to ``rejected`` beside ``ledger``, with their reason.
    """
    spark = decisions.sparkSession
    root = root.rstrip("/")
    standing = BucketedTable(spark, f"{root}/standing", STANDING, ["candidate_id"], buckets)
    open_standing(queue, ledger, standing)

    def one_batch(df: DataFrame, number: int) -> None:
        notes = F.col("notes") if "notes" in df.columns else F.lit(None).cast("string")
        rows = cut_lineage(df.withColumn("notes", notes))
        past = standing.of(rows).where(F.col("batch") != number)
        last = F.max_by(F.struct("sequence", "new_status", "agrees"), "sequence")
        known = cut_lineage(past.groupBy("candidate_id").agg(last.alias("d")).select("candidate_id", "d.*"))
        checked = cut_lineage(review.validate_decisions(rows, known, off=known.where(~F.col("agrees"))))
        accepted = checked.where("reject_reason IS NULL").drop("reject_reason")
        so_far = known.withColumns({"action": F.lit(None).cast("string"), "notes": F.lit(None).cast("string")})
        chained = review.chain(accepted, ["decided_at", "event_id"], F.to_date("decided_at"), so_far)
        chained.select(
            "candidate_id", "event_id", F.col("sequence").cast("bigint").alias("sequence"), "action", "previous_status",
            "new_status", "decided_at", "notes",
        ).write.mode("overwrite").parquet(f"{root}/ledger/batch={number}")
        checked.where("reject_reason IS NOT NULL").write.mode("overwrite").parquet(f"{root}/rejected/batch={number}")
        written = spark.read.schema(STANDING).parquet(f"{root}/ledger/batch={number}")
        heads = written.groupBy("candidate_id").agg(F.max("sequence").alias("sequence"), F.max_by("new_status", "sequence").alias("new_status"))
        standing.append(heads.withColumn("agrees", F.lit(True)), number)

    return (
        decisions.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
