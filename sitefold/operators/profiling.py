"""Source profiling, reproducible stratified samples and directory statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import text as tx
from sitefold.operators.lineage import cut_lineage
from sitefold.sources.master import classify_records, valid_edges

# Sample quotas, expected population of the directory, table sizes of the report.
SAMPLE_SIZE, PRIORITY_SHARE = 100, 0.7
EXPECTED_RECORDS, EXPECTED_EDGES, DEVIATION = 241_194, 57_575, 0.2
EXPECTED_STATUSES = ["DIRE", "KEEP", "RSCH", "RDEL", "DELE"]
EXPECTED_RELATIONSHIPS = ["AFFL", "HQTR"]
TOP_N = {"county": 12, "organization_type": 12, "naics2": 12, "naics3": 15}


# -------------------------------------------------------------- permit profile


def names_differ() -> Column:
    taxpayer, outlet = tx.string_field(F.col("taxpayer_name")), tx.string_field(F.col("outlet_name"))
    both = taxpayer.isNotNull() & outlet.isNotNull()
    return both & (tx.company_name(taxpayer) != tx.company_name(outlet))


def permit_profile(observations: DataFrame) -> DataFrame:
    """The scalar metrics of a pull as one row.

    The counters are one global aggregate: a row per task leaves the scan. Only the two keys
    are shuffled for the distinct counts, which are plain counts over groups, so that no set of
    ids is ever held in one place.
    """

    def missing(name: str) -> Column:
        return F.count_if(tx.string_field(F.col(name)).isNull())

    address = tx.string_field(F.col("outlet_address"))
    limits = tx.city_limits_bucket(F.col("outlet_inside_outside_city_limits_indicator"))
    sums = {
        "missing_outlet_name": missing("outlet_name"),
        "missing_outlet_address": missing("outlet_address"),
        "missing_outlet_city": missing("outlet_city"),
        "missing_outlet_zip": missing("outlet_zip_code"),
        "missing_outlet_naics": missing("outlet_naics_code"),
        "missing_permit_issue_date": missing("outlet_permit_issue_date"),
        "missing_first_sales_date": missing("outlet_first_sales_date"),
        "name_differs": F.count_if(names_differ()),
        "po_box_like": F.count_if(tx.is_po_box(address)),
        "residential_risk": F.count_if(tx.is_residential_risk(address)),
        "inside_city_limits": F.count_if(limits == "inside"),
        "outside_city_limits": F.count_if(limits == "outside"),
        "unknown_city_limits": F.count_if(limits == "unknown"),
    }
    counters = observations.agg(F.count("*").alias("total_observations"), *[c.alias(n) for n, c in sums.items()])
    per_record = observations.select(tx.string_field(F.col("taxpayer_number")).alias("_taxpayer"), "source_record_id").groupBy(
        "_taxpayer", "source_record_id").agg(F.count("*").alias("_n"))
    per_taxpayer = per_record.groupBy("_taxpayer").agg(F.sum("_n").alias("_n"), F.count("source_record_id").alias("_ids"))
    named = F.col("_taxpayer").isNotNull()
    keys = per_taxpayer.agg(
        F.sum("_ids").alias("unique_record_ids"),
        F.sum(F.col("_n") - F.col("_ids")).alias("duplicate_record_ids"),
        F.count("_taxpayer").alias("unique_taxpayers"),
        F.count_if(named & (F.col("_n") > 1)).alias("taxpayers_with_multiple_outlets"),
    )
    some = F.col("total_observations") > 0
    counters = counters.select(*[F.when(some, F.col(n)).alias(n) for n in counters.columns])
    # One row from each side, put into one.
    both = counters.unionByName(keys, allowMissingColumns=True)
    names = ["total_observations", *keys.columns, *sums]
    return both.agg(*[F.max(n).alias(n) for n in names])


def distributions(observations: DataFrame) -> DataFrame:
    """Counts by county, organisation type and NAICS prefix in one pass: (dimension, bucket, n)."""
    missing = F.lit("(missing)")
    items = {
        "county": F.coalesce(tx.string_field(F.col("outlet_county_code")), missing),
        "organization_type": F.coalesce(tx.string_field(F.col("taxpayer_organization_type")), missing),
        "naics2": tx.naics_bucket(F.col("outlet_naics_code"), 2),
        "naics3": tx.naics_bucket(F.col("outlet_naics_code"), 3),
    }
    long = F.array(*[F.struct(F.lit(d).alias("dimension"), c.alias("bucket")) for d, c in items.items()])
    return observations.select(F.inline(long)).groupBy("dimension", "bucket").agg(F.count("*").alias("n"))


def top_buckets(counts: DataFrame) -> DataFrame:
    """The largest buckets per dimension, and how many more there are."""
    top = F.lit(None).cast("int")
    for name, n in TOP_N.items():
        top = F.when(F.col("dimension") == name, n).otherwise(top)
    w = Window.partitionBy("dimension")
    return (
        counts.withColumns(
            {"position": F.row_number().over(w.orderBy(F.desc("n"), "bucket")), "_all": F.count("*").over(w), "_top": top}
        )
        .where(F.col("position") <= F.col("_top"))
        .select("dimension", "position", "bucket", "n", F.greatest(F.col("_all") - F.col("_top"), F.lit(0)).alias("more"))
    )


# ---------------------------------------------------------------------- sampling


def with_flags(observations: DataFrame) -> DataFrame:
    """What a stratum reads of the long texts, as flags: rows that are to be shuffled need not carry the texts then."""
    address = tx.string_field(F.col("outlet_address"))
    flags = {"_fsd": tx.string_field(F.col("outlet_first_sales_date")).isNotNull(), "_differ": names_differ(), "_risk": tx.is_po_box(address) | tx.is_residential_risk(address)}
    return observations.withColumns(flags)


def with_stratum(observations: DataFrame) -> DataFrame:
    """Add ``stratum``, a seven-part key. The flags are worked out unless the rows have them from ``with_flags``."""
    if "_risk" not in observations.columns:
        observations = with_flags(observations)
    taxpayer = tx.string_field(F.col("taxpayer_number"))
    naics = tx.naics_bucket(F.col("outlet_naics_code"), 2)
    # A count per taxpayer, combined map-side and joined back: a taxpayer with very many
    # outlets is one row here, not one window partition.
    outlets = observations.groupBy(taxpayer.alias("_taxpayer")).agg((F.count("*") > 1).alias("_multi"))
    rows = observations.withColumn("_taxpayer", taxpayer).join(outlets, "_taxpayer", "left")

    def flag(c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit(False)), "true").otherwise("false")

    parts = {
        "org": F.coalesce(tx.string_field(F.col("taxpayer_organization_type")), F.lit("unknown_org_type")),
        "naics": F.when(naics.isin("(missing)", "(short)"), "unknown_naics").otherwise(naics),
        "multi": flag(F.col("_multi")),
        "fsd": flag(F.col("_fsd")),
        "namediff": flag(F.col("_differ")),
        "risk": flag(F.col("_risk")),
        "county": F.coalesce(tx.string_field(F.col("outlet_county_code")), F.lit("unknown_county")),
    }
    key = F.concat_ws("|", *[F.concat(F.lit(f"{n}:"), c) for n, c in parts.items()])
    return rows.withColumn("stratum", key).drop("_taxpayer", "_multi", "_fsd", "_differ", "_risk")


def quotas(total: int, size: int = SAMPLE_SIZE) -> tuple[int, int]:
    """(priority, control) numbers of a sample of at most ``size``."""
    n = min(size, total)
    priority = int(n * PRIORITY_SHARE + 0.5)
    return priority, n - priority


def _draw(seed: int) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), "source_record_id"), 256)


def pilot_sample(observations: DataFrame, seed: int = 1, size: int = SAMPLE_SIZE) -> DataFrame:
    """Sample of unique observations: a stratified priority part and a random control part.

    The order within a stratum is that of a seeded hash, which does not depend on
    input order or partitioning. The first of every stratum comes first, then the
    second of every stratum, and so on until the quota is met.
    """
    rows = cut_lineage(with_stratum(observations).select("source_record_id", "stratum"))
    priority_n, control_n = quotas(rows.count(), size)
    w = Window.partitionBy("stratum").orderBy(_draw(seed), "source_record_id")
    # No stratum can give more than the quota, so Spark cuts each to that before the shuffle.
    ranked = rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= max(priority_n, 1))
    priority = ranked.orderBy("_rank", "stratum").limit(priority_n).select(
        "source_record_id", "stratum", F.lit("priority_stratified").alias("selection")
    )
    rest = rows.join(priority, "source_record_id", "left_anti")
    control = rest.orderBy(_draw(seed + 1), "source_record_id").limit(control_n).select(
        "source_record_id", "stratum", F.lit("random_control").alias("selection")
    )
    return priority.unionByName(control)


# ------------------------------------------------------------ directory statistics


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.coalesce(column, F.lit("(missing)")).alias("value")).agg(F.count("*").alias("n"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """(distinct keys that repeat, rows beyond the first of a key)."""
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg((F.count("*") - 1).alias("_extra"))
        .agg(F.count_if(F.col("_extra") > 0).alias("repeated_keys"), F.coalesce(F.sum("_extra"), F.lit(0)).alias("extra_rows"))
    )


def orphans(edges: DataFrame, side: str, records: DataFrame) -> DataFrame:
    """Distinct ids of one edge side that have no record."""
    ids = edges.select(F.col(f"{side}_id").alias("location_id")).distinct()
    return ids.join(records, "location_id", "left_anti")


def unseen_values(df: DataFrame, column: str, expected: list[str]) -> DataFrame:
    """Expected values that never occur."""
    table = df.sparkSession.createDataFrame([(v,) for v in expected], "value string")
    return table.join(df.select(F.col(column).alias("value")).distinct(), "value", "left_anti")


def population_check(df: DataFrame, expected: int) -> DataFrame:
    """Row count, expected count and whether it is off by more than a fifth."""
    n = F.count("*")
    return df.agg(
        n.alias("row_count"), F.lit(expected).cast("bigint").alias("expected_count"),
        (F.abs(n - expected) / F.lit(float(expected)) > DEVIATION).alias("deviates"),
    )


def directory_report(records: DataFrame, edges: DataFrame, order: str = "seq") -> DataFrame:
    """Everything the directory validation prints, as (section, item, n)."""
    classified = cut_lineage(classify_records(records, order).select("location_id", "status_code", "site_type_code", "row_status"))
    good = classified.where(F.col("row_status") == "valid")
    linked = valid_edges(edges)

    def section(name: str, df: DataFrame, item: Column, n: Column) -> DataFrame:
        return df.select(F.lit(name).alias("section"), item.alias("item"), n.cast("bigint").alias("n"))

    value, n = F.col("value"), F.col("n")
    parts = [
        section("rows", classified.groupBy("row_status").count(), F.col("row_status"), F.col("count")),
        section("repeated ids", repeated_keys(classified.where("row_status <> 'malformed'"), "location_id"),
                F.lit("distinct"), F.col("repeated_keys")),
        section("status", count_by(good, "status_code"), value, n),
        section("site type", count_by(good, "site_type_code"), value, n),
        section("relationship type", count_by(linked, "relationship_type"), value, n),
        section("edges", edges.agg(F.count("*").alias("n")), F.lit("total"), n),
        section("edges", linked.agg(F.count("*").alias("n")), F.lit("valid"), n),
        section("missing child", orphans(linked, "child", good).agg(F.count("*").alias("n")), F.lit("distinct"), n),
        section("missing parent", orphans(linked, "parent", good).agg(F.count("*").alias("n")), F.lit("distinct"), n),
        section("status not observed", unseen_values(good, "status_code", EXPECTED_STATUSES), value, F.lit(1)),
        section("relationship not observed", unseen_values(linked, "relationship_type", EXPECTED_RELATIONSHIPS), value, F.lit(1)),
        section("record count deviates", population_check(good, EXPECTED_RECORDS), F.lit("yes/no"), F.col("deviates").cast("int")),
        section("edge count deviates", population_check(linked, EXPECTED_EDGES), F.lit("yes/no"), F.col("deviates").cast("int")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
