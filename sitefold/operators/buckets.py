"""Append-only tables in hash buckets of their keys: a batch reads the buckets that its own keys fall into, and no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class BucketedTable:
    """Parquet below ``path`` as ``bucket=<n>/batch=<b>``, one file per bucket and batch (large ones have several).

    Rows with equal ``keys`` are in one bucket. A batch is a number; one that is written again replaces its former self. ``buckets`` is a
    property of the table: it bounds what a reader has to know about a batch (the numbers of the buckets that it hits).
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def append(self, rows: DataFrame, batch: int) -> None:
        """Write ``rows`` as batch ``batch``; its columns are those of the schema, in any order."""
        columns = [c for c in rows.sparkSession.createDataFrame([], self.schema).columns]
        placed = rows.select(*columns, self.bucket(), F.lit(batch).cast("bigint").alias("batch"))
        # A bucket is one file, unless it is too large for one task.
        dealt = placed.hint("rebalance", "bucket")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(self.path)

    def _read(self, pattern: str) -> DataFrame:
        schema = f"{self.schema}, bucket int, batch bigint"
        try:
            return self.spark.read.schema(schema).option("basePath", self.path).parquet(f"{self.path}/{pattern}")
        except Exception as error:  # nothing has been written to these buckets yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def all(self) -> DataFrame:
        return self._read("bucket=*")

    def of(self, batch: DataFrame) -> DataFrame:
        """All stored rows of the buckets that the keys of ``batch`` fall into; at most ``buckets`` numbers reach the driver."""
        hit = sorted(r["bucket"] for r in batch.select(self.bucket()).distinct().collect())
        return self._read(f"bucket={{{','.join(map(str, hit))}}}") if hit else self.spark.createDataFrame([], f"{self.schema}, bucket int, batch bigint")

    def compacted(self, path: str) -> BucketedTable:
        """The same rows below a new path, with one file per bucket: its batch is the highest one so far.

        Readers move to the new path; the old one may go when none is left.
        """
        out = BucketedTable(self.spark, path, self.schema, self.keys, self.buckets)
        last = self.all().agg(F.max("batch").alias("b")).first()["b"]
        if last is not None:
            out.append(self.all().drop("bucket", "batch"), last)
        return out
