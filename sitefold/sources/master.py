"""Master directory scans: records and relationship edges from CSV exports.

The id headers of an export carry its vendor's name. ``vendor`` is that name as it
appears in the header: ``<vendor>_location_id``, ``parent_<vendor>_id`` and
``child_<vendor>_id``. Without it plain ``location_id``, ``parent_id`` and
``child_id`` are expected. Everything stays a string, so codes keep leading zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitefold.functions import text as tx

# Column names of the exports.
RECORD_COLUMNS = [
    "location_id", "company_name", "alpha_sort", "status_code", "status_description", "market_id",
    "market_name", "market_abbreviation", "site_type_code", "site_type_description", "address",
    "building_number", "street", "suite_number", "city", "state", "zip", "zip_plus", "county", "phone",
    "website", "sic", "naics", "start_year", "site_size_code", "site_employee_count",
    "company_size_code", "number_of_sites", "building_type_code", "address_type_code",
    "address_validation_code", "latitude", "longitude", "entered_date", "base_date", "researched_date",
]
EDGE_COLUMNS = [
    "relationship_type", "relationship_description", "parent_id", "parent_company_name",
    "parent_alpha_sort", "parent_is_fortune_1000", "parent_city", "parent_state", "parent_country",
    "parent_stock_ticker", "child_id", "child_company_name", "child_status", "child_site_type",
    "child_market_id", "child_city", "child_state",
]
RECORD_REQUIRED = ["location_id", "company_name", "status_code", "site_type_code"]
EDGE_REQUIRED = ["relationship_type", "parent_id", "child_id"]


class HeaderError(ValueError):
    """A CSV export lacks a required header."""


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-string CSV with header; quoted cells may hold separators, quotes and line breaks."""
    return spark.read.options(
        header=True, multiLine=True, quote='"', escape='"', inferSchema=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def _conform(raw: DataFrame, columns: list[str], required: list[str], renamed: dict[str, str], label: str) -> DataFrame:
    headers = {c.strip().lower().lstrip("﻿"): c for c in raw.columns}
    by_name = {renamed.get(h, h): c for h, c in headers.items()}
    missing = [c for c in required if c not in by_name]
    if missing:
        raise HeaderError(f"{label}: missing required header(s): {', '.join(missing)}")
    cells = [
        (tx.nullish_to_null(F.col(f"`{by_name[c]}`")) if c in by_name else F.lit(None).cast("string")).alias(c)
        for c in columns
    ]
    extra = [c for c in raw.columns if c in ("_seq",)]
    return raw.select(*extra, *cells)


def in_file_order(scan: DataFrame) -> DataFrame:
    """Add ``_seq``, which numbers the rows of a scan by file name, place of the block and place in the block.

    Spark packs files into tasks by size, so the scan's own numbers follow no order between files. One row per
    file block (not per row) is ranked; the scan numbers rows alike both times, since its splits are the same.
    """
    at = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()}
    rows = scan.select("*", *[c.alias(n) for n, c in at.items()])
    blocks = rows.groupBy("_file", "_start").agg(F.min("_row").alias("_first"))
    blocks = blocks.withColumn("_rank", F.row_number().over(Window.orderBy("_file", "_start")) - 1)
    placed = rows.join(blocks, ["_file", "_start"])
    return placed.withColumn("_seq", F.shiftleft(F.col("_rank").cast("long"), 33) + F.col("_row") - F.col("_first")).drop(*at, "_first", "_rank")


def read_records(spark: SparkSession, path: str, vendor: str = "") -> DataFrame:
    """Cleaned record rows with ``seq`` in file order."""
    renamed = {f"{vendor}_location_id": "location_id"} if vendor else {}
    raw = in_file_order(read_csv(spark, path))
    return _conform(raw, RECORD_COLUMNS, RECORD_REQUIRED, renamed, "records").withColumnRenamed("_seq", "seq")


def read_edges(spark: SparkSession, path: str, vendor: str = "") -> DataFrame:
    """Cleaned edge rows with ``edge_seq`` in file order."""
    renamed = {f"parent_{vendor}_id": "parent_id", f"child_{vendor}_id": "child_id"} if vendor else {}
    raw = in_file_order(read_csv(spark, path))
    return _conform(raw, EDGE_COLUMNS, EDGE_REQUIRED, renamed, "relationships").withColumnRenamed("_seq", "edge_seq")


def clean_records(df: DataFrame) -> DataFrame:
    """Blank, NULL and None cells of every string column become null."""
    return df.select(
        *[tx.nullish_to_null(F.col(n)).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes]
    )


def classify_records(records: DataFrame, order: str = "seq") -> DataFrame:
    """Add ``row_status``: malformed, duplicate (a later row of a known id) or valid."""
    bad = F.col("location_id").isNull() | F.col("company_name").isNull() | F.col("status_code").isNull()
    # The first row of an id comes from an aggregate that combines map-side, so an id
    # repeated very often costs one row per task.
    good = records.where(~bad)
    first = good.groupBy("location_id").agg(F.min(order).alias("_first"))
    status = F.when(F.col(order) > F.col("_first"), "duplicate").otherwise("valid")
    checked = good.join(first, "location_id").withColumn("row_status", status).drop("_first")
    # Malformed rows, among them all without an id, need no partner and stay out of the join.
    return checked.unionByName(records.where(bad).withColumn("row_status", F.lit("malformed")))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of every key. Spark keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def load_unique_records(records: DataFrame, order: str = "seq") -> DataFrame:
    """Valid records; refuses a directory with a repeated id."""
    classified = classify_records(records, order)
    repeated = classified.where(F.col("row_status") == "duplicate").select("location_id").limit(1).collect()
    if repeated:
        raise ValueError(f"duplicate location_id in the directory, e.g. {repeated[0][0]!r}")
    return classified.where(F.col("row_status") == "valid").drop("row_status")


def valid_edges(edges: DataFrame) -> DataFrame:
    return edges.where("relationship_type IS NOT NULL AND parent_id IS NOT NULL AND child_id IS NOT NULL")
