"""Permit observations: windowed scan, valid-and-unique pull."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import text as tx

# Defaults of the permit pull.
DEFAULT_COUNTIES = ["043", "057", "061", "220"]
DEFAULT_DAYS = 7


def resolve_window(from_: str | None = None, to: str | None = None, days: int | None = None,
                   now: dt.datetime | None = None) -> tuple[str, str]:
    """(start, end) as ISO dates: explicit, or the last ``days`` days."""
    if from_ is not None or to is not None:
        if from_ is None or to is None:
            raise ValueError("give both ends of the window")
        for value in (from_, to):
            if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
                raise ValueError(f"not an ISO date: {value!r}")
        if from_ >= to:
            raise ValueError(f"window start {from_} is not before its end {to}")
        return from_, to
    days = DEFAULT_DAYS if days is None else days
    if not isinstance(days, int) or days <= 0:
        raise ValueError(f"days must be a positive integer, got {days}")
    now = now or dt.datetime.now(dt.timezone.utc)
    return (now - dt.timedelta(days=days)).date().isoformat(), now.date().isoformat()


def parse_counties(raw: str | None) -> list[str]:
    if raw is None:
        return list(DEFAULT_COUNTIES)
    counties = [c.strip() for c in raw.split(",") if c.strip()]
    if not counties:
        raise ValueError("no county given")
    return counties


def in_window(permits: DataFrame, window: tuple[str, str], counties: list[str]) -> DataFrame:
    """County and issue-date predicate; both reach a Parquet scan."""
    if not counties:
        raise ValueError("no county given")
    issued = F.col("outlet_permit_issue_date")
    start, end = (F.lit(dt.datetime.fromisoformat(d)) for d in window)
    return permits.where(F.col("outlet_county_code").isin(counties) & (issued >= start) & (issued < end))


def page(permits: DataFrame, limit: int, offset: int = 0, ties: list[str] | None = None) -> DataFrame:
    """One page of the scan in issue date, taxpayer, outlet order."""
    if limit <= 0 or offset < 0:
        raise ValueError("limit must be positive and offset not negative")
    order = ["outlet_permit_issue_date", "taxpayer_number", "outlet_number", *(ties or [])]
    return permits.orderBy(*order).offset(offset).limit(limit)


def observations(permits: DataFrame) -> DataFrame:
    """Add ``source_record_id`` (null when the row cannot be identified)."""
    taxpayer, outlet = tx.string_field(F.col("taxpayer_number")), tx.string_field(F.col("outlet_number"))
    return permits.withColumn(
        "source_record_id", F.when(taxpayer.isNotNull() & outlet.isNotNull(), F.concat_ws(":", taxpayer, outlet))
    )


def unique_observations(permits: DataFrame, ties: list[str] | None = None) -> DataFrame:
    """First valid observation per record id in issue date, taxpayer, outlet order."""
    order = ["outlet_permit_issue_date", "taxpayer_number", "outlet_number", *(ties or [])]
    w = Window.partitionBy("source_record_id").orderBy(*order)
    valid = observations(permits).where("source_record_id IS NOT NULL")
    return valid.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def pull(permits: DataFrame, window: tuple[str, str], counties: list[str], limit: int,
         ties: list[str] | None = None) -> DataFrame:
    """The first ``limit`` unique valid observations of a window, with pull metadata."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    rows = unique_observations(in_window(permits, window, counties), ties)
    order = ["outlet_permit_issue_date", "taxpayer_number", "outlet_number", *(ties or [])]
    return (
        rows.orderBy(*order)
        .limit(limit)
        .withColumns(
            {
                "query_window_start": F.lit(window[0]),
                "query_window_end": F.lit(window[1]),
                "requested_counties": F.array(*[F.lit(c) for c in counties]),
            }
        )
    )


def pull_counts(permits: DataFrame, window: tuple[str, str], counties: list[str]) -> DataFrame:
    """Raw, malformed, unique and duplicate counts of an unlimited pull."""
    rows = observations(in_window(permits, window, counties))
    return rows.groupBy("source_record_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_count"),
        F.coalesce(F.sum(F.when(F.col("source_record_id").isNull(), F.col("n"))), F.lit(0)).alias("malformed_count"),
        F.count("source_record_id").alias("unique_count"),
        F.coalesce(F.sum(F.when(F.col("source_record_id").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("duplicate_count"),
    )
