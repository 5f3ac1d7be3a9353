"""Licence CSV and JSON discovery feeds, mapped to candidate drafts.

A mapped row has ``seq``, ``source_id``, ``record_id``, ``fingerprint`` and
``reject_reason`` next to the candidate columns; a rejected row keeps its reason
and is split off by a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefold.functions import codes
from sitefold.functions import text as tx
from sitefold.sources.master import in_file_order, read_csv

# Texts and columns of the two feeds.
MARKET = "DFW"
LICENCE_EVIDENCE = "county business license record"
LICENCE_SOURCE_TYPE = "county_business_license"
JSON_EVIDENCE = ["DFW chamber discovery feed", "company website", "chamber report URL"]
JSON_SOURCE_TYPE = "chamber_of_commerce"
# Dates that are read besides ISO form: the shape of the whole text (commas count as blanks) and its pattern.
DATE_FORMATS = [
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "M-d-yyyy"),
    (r"^[A-Za-z]{3} [0-9]{1,2} [0-9]{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{3,9} [0-9]{1,2} [0-9]{4}$", "MMMM d yyyy"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$", "d MMM yyyy"),
    (r"^[0-9]{1,2} [A-Za-z]{3,9} [0-9]{4}$", "d MMMM yyyy"),
]
LICENCE_COLUMNS = [
    "license_id", "business_name", "address", "city", "state", "zip", "phone", "website", "employees",
    "issued_date", "contact_name", "contact_email", "contact_phone", "site_type_code", "county",
]
JSON_STRINGS = [
    "reportId", "companyName", "address", "city", "state", "postalCode", "phone", "website", "sourceUrl",
    "notes", "contactName", "contactTitle", "contactEmail", "contactPhone", "siteTypeCode", "publishedAt",
]


def _item(path: Column | str, when: Column, value: Column, raw: Column) -> Column:
    """One observed field, null unless ``when`` holds."""
    path = F.lit(path) if isinstance(path, str) else path
    return F.when(
        when, F.struct(path.alias("path_key"), value.alias("value_json"), F.coalesce(raw, value).alias("raw_json"))
    )


def _observed(items: Column, source: Column, captured_at: Column) -> Column:
    """Evidence array of the populated fields, all directly observed in one source row.

    ``items`` is a staged column. It is read twice, which keeps the optimizer from
    pulling its expressions into the lambda, where they would run interpreted.
    """
    none = F.lit(None).cast("string")

    def element(i: Column) -> Column:
        return F.struct(
            i["path_key"].alias("path_key"),
            i["value_json"].alias("value_json"),
            none.alias("normalized_json"),
            i["raw_json"].alias("raw_json"),
            F.lit(codes.SINGLE_SOURCE_CONFIDENCE).alias("confidence"),
            source.alias("source"),
            captured_at.alias("captured_at"),
            none.alias("evidence_text"),
            F.lit("directly_observed").alias("derivation"),
        )

    return F.when(F.size(items) > 0, F.transform(F.filter(items, lambda i: i.isNotNull()), element))


def _evidence_source(source_type: str, source_id: Column, name: Column, url: Column, record_id: Column) -> Column:
    return F.struct(
        F.lit(source_type).alias("source_type"),
        source_id.alias("source_id"),
        name.alias("source_name"),
        url.alias("source_url"),
        record_id.alias("source_record_id"),
        F.lit(None).cast("string").alias("source_observation_id"),
    )


def issue_date(c: Column) -> Column:
    """Text to timestamp in one of ``DATE_FORMATS``, or in ISO form; null for any other text, a bare time among them."""
    text = F.regexp_replace(tx.trim_ws(c), r"\s*,\s*|\s+", " ")
    iso = F.when(text.rlike(r"^[0-9]{4}-"), F.try_to_timestamp(tx.trim_ws(c)))
    return F.coalesce(iso, *[F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern))) for shape, pattern in DATE_FORMATS])


def _contact_id(fingerprint: Column) -> Column:
    return F.concat(F.lit("contact-"), F.left(F.sha2(fingerprint, 256), F.lit(16)))


# ------------------------------------------------------------------ licence csv


def read_licence_csv(spark: SparkSession, path: str, source_id: str = "dfw-csv") -> DataFrame:
    """Header-keyed, trimmed records; a blank cell counts as missing."""
    raw = in_file_order(read_csv(spark, path))
    by_name = {c.strip().lstrip("﻿"): c for c in raw.columns}
    cells = [
        (tx.blank_to_null(F.col(f"`{by_name[c]}`")) if c in by_name else F.lit(None).cast("string")).alias(c)
        for c in LICENCE_COLUMNS
    ]
    return raw.select(F.col("_seq").alias("seq"), F.lit(source_id).alias("source_id"), *cells).withColumnRenamed(
        "license_id", "record_id"
    )


def map_licence_rows(rows: DataFrame, source_name: str = "DFW County Business License Export (CSV)",
                     now: str = "1970-01-01T00:00:00.000Z", keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat licence rows to candidate drafts.

    ``now`` stands in for a missing issue date; ``keep`` names input columns to carry along.
    """
    c = {n: F.col(n) if n in rows.columns else F.lit(None).cast("string") for n in LICENCE_COLUMNS}
    name = F.coalesce(tx.trim_ws(c["business_name"]), F.lit(""))
    date = issue_date(c["issued_date"])
    has_date = tx.truthy(c["issued_date"])
    captured = F.when(has_date, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    reason = F.when(name == "", "missing business_name").when(
        has_date & date.isNull(), "unexpected mapping error: Invalid Date"
    )
    place = [c["address"], c["city"], c["state"], c["zip"]]
    any_place = tx.truthy(F.concat_ws("", *place))
    address = F.when(
        any_place,
        F.struct(*[tx.non_empty(v).alias(n) for v, n in zip(place, ["street", "city", "state", "postal_code"])]),
    )
    address_json = F.to_json(
        F.struct(*[tx.non_empty(v).alias(n) for v, n in zip(place, ["street", "city", "state", "postalCode"])])
    )
    fp = tx.fingerprint(
        F.col("source_id"), F.col("record_id"),
        {"companyName": name, "city": tx.non_empty(c["city"]), "state": tx.non_empty(c["state"]),
         "address": tx.non_empty(c["address"]), "sourceUrl": F.lit(None).cast("string")},
    )
    staged = rows.withColumns(
        {"_name": name, "_captured": captured, "reject_reason": reason, "physical_address": address,
         "_address_json": address_json, "fingerprint": fp,
         "_employees": F.when(tx.truthy(c["employees"]), tx.number_or_null(c["employees"])),
         "_site": codes.site_type(c["site_type_code"])}
    ).withColumn("_contact", _contact_id(F.col("fingerprint")))
    has_contact = tx.truthy(c["contact_name"]) | tx.truthy(c["contact_email"])
    has_site = tx.truthy(c["site_type_code"])
    source = _evidence_source(LICENCE_SOURCE_TYPE, F.col("source_id"), F.lit(source_name),
                              F.lit(None).cast("string"), F.col("record_id"))
    estimate = F.col("_employees")

    def plain(path: Column | str, cell: Column) -> Column:
        return _item(path, tx.truthy(cell), tx.json_text(cell), tx.json_text(cell))

    contact = F.col("_contact")
    items = [
        _item("company.legalName", F.lit(True), tx.json_text(F.col("_name")), tx.json_text(c["business_name"])),
        plain("company.website", c["website"]),
        plain(F.concat_ws(".", F.lit("contact"), contact, F.lit("name")), c["contact_name"]),
        plain(F.concat_ws(".", F.lit("contact"), contact, F.lit("email")), c["contact_email"]),
        _item("location.physicalAddress", F.col("physical_address").isNotNull(), F.col("_address_json"), F.col("_address_json")),
        plain("location.phone", c["phone"]),
        _item("location.siteType", has_site, tx.json_text(F.col("_site.normalized")), tx.json_text(c["site_type_code"])),
        _item("location.employeeSizeSite", estimate.isNotNull(),
              F.concat(F.lit('{"estimate":'), tx.json_number(estimate), F.lit("}")), tx.json_text(c["employees"])),
    ]
    staged = staged.withColumn("_items", F.array(*items))
    evidence = _observed(F.col("_items"), source, F.col("_captured"))
    raw_cells = [n for n in LICENCE_COLUMNS if n in rows.columns]
    return staged.select(
        *keep, "seq", "source_id", "record_id", "fingerprint", "reject_reason",
        F.lit(source_name).alias("source_name"),
        F.lit(None).cast("string").alias("source_url"),
        F.struct(F.col("_name").alias("legal_name"), tx.non_empty(c["website"]).alias("website")).alias("company"),
        "physical_address",
        tx.non_empty(c["phone"]).alias("phone"),
        F.lit(MARKET).alias("market"),
        tx.non_empty(c["county"]).alias("county"),
        F.when(has_site, F.col("_site.normalized")).alias("site_type"),
        F.when(has_site, F.col("_site.raw_code")).alias("raw_site_type_code"),
        F.when(estimate.isNotNull(), F.struct(estimate.alias("estimate"))).alias("employee_size_site"),
        F.lit(None).cast("string").alias("description"),
        F.when(
            has_contact,
            F.array(F.struct(contact.alias("id"), tx.non_empty(c["contact_name"]).alias("name"),
                             tx.non_empty(c["contact_email"]).alias("email"),
                             tx.non_empty(c["contact_phone"]).alias("phone"))),
        ).otherwise(F.array()).alias("contacts"),
        F.coalesce("_captured", F.lit(now)).alias("captured_at"),
        F.array(F.lit(LICENCE_EVIDENCE)).alias("evidence"),
        evidence.alias("field_evidence"),
        F.to_json(F.struct(*raw_cells)).alias("raw_source_data"),
    )


# -------------------------------------------------------------------- json feed


def read_json_feed(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One VARIANT ``data`` per feed item, with ``seq``.

    A feed is one JSON array per file; ``lines=True`` reads newline-delimited
    items instead, which splits across tasks.
    """
    if lines:
        items = in_file_order(spark.read.text(path)).where(F.trim("value") != "")
        return items.select(F.parse_json("value").alias("data"), F.col("_seq").alias("seq"))
    # One row per file, numbered by file name; an item's place in its file comes second.
    files = in_file_order(spark.read.text(path, wholetext=True))
    whole = files.select(F.parse_json("value").alias("feed"), F.col("_seq").alias("first"))
    exploded = whole.lateralJoin(spark.tvf.variant_explode(F.col("feed").outer()))
    return exploded.select(F.col("value").alias("data"), (F.col("first") + F.col("pos")).alias("seq"))


def _typed(name: str) -> Column:
    """String member of ``data``; null when absent or of another JSON type."""
    return F.expr(
        f"CASE WHEN schema_of_variant(variant_get(data, '$.{name}', 'variant')) = 'STRING' "
        f"THEN variant_get(data, '$.{name}', 'string') END"
    )


def _member_truthy(name: str) -> Column:
    v = f"variant_get(data, '$.{name}', 'variant')"
    return F.expr(f"coalesce(cast({v} as string) not in ('', '0', 'false') and not is_variant_null({v}), false)")


def map_json_items(items: DataFrame, source_id: str = "dfw-json", source_name: str = "DFW Chamber Discovery Feed (JSON)",
                   now: str = "1970-01-01T00:00:00.000Z") -> DataFrame:
    """Feed items to candidate drafts; a member counts only if it has the right JSON type."""
    number = F.expr(
        "CASE WHEN schema_of_variant(variant_get(data, '$.employeeCount', 'variant')) RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)' "
        "THEN variant_get(data, '$.employeeCount', 'double') END"
    )
    any_place = _member_truthy("address") | _member_truthy("city") | _member_truthy("state") | _member_truthy("postalCode")
    flat = items.select(
        "seq", F.lit(source_id).alias("source_id"), F.to_json("data").alias("raw_source_data"),
        *[_typed(n).alias(n) for n in JSON_STRINGS], number.alias("employeeCount"), any_place.alias("_placed"),
    )
    c = {n: F.col(n) for n in JSON_STRINGS}
    place = list(zip([c["address"], c["city"], c["state"], c["postalCode"]],
                     ["street", "city", "state", "postal_code"], ["street", "city", "state", "postalCode"]))
    name = F.coalesce(tx.trim_ws(c["companyName"]), F.lit(""))
    staged = flat.withColumns(
        {
            "_name": name,
            "reject_reason": F.when(name == "", "missing companyName"),
            "fingerprint": tx.fingerprint(
                F.col("source_id"), c["reportId"],
                {"companyName": name, "city": F.when(F.col("_placed"), c["city"]),
                 "state": F.when(F.col("_placed"), c["state"]), "address": F.when(F.col("_placed"), c["address"]),
                 "sourceUrl": c["sourceUrl"]},
            ),
            "physical_address": F.when(F.col("_placed"), F.struct(*[v.alias(n) for v, n, _ in place])),
            "_address_json": F.to_json(F.struct(*[v.alias(j) for v, _, j in place])),
            "_site": codes.site_type(c["siteTypeCode"]),
        }
    ).withColumn("_contact", _contact_id(F.col("fingerprint")))
    source = _evidence_source(JSON_SOURCE_TYPE, F.col("source_id"), F.lit(source_name), c["sourceUrl"], c["reportId"])
    contact, estimate = F.col("_contact"), F.col("employeeCount")
    has_contact, has_site = tx.truthy(c["contactName"]), c["siteTypeCode"].isNotNull()

    def plain(path: Column | str, cell: Column, when: Column | None = None) -> Column:
        return _item(path, tx.truthy(cell) if when is None else when, tx.json_text(cell), tx.json_text(cell))

    items = [
        _item("company.legalName", F.lit(True), tx.json_text(F.col("_name")), tx.json_text(c["companyName"])),
        plain("company.website", c["website"]),
        plain(F.concat_ws(".", F.lit("contact"), contact, F.lit("name")), c["contactName"]),
        plain(F.concat_ws(".", F.lit("contact"), contact, F.lit("email")), c["contactEmail"],
              has_contact & tx.truthy(c["contactEmail"])),
        _item("location.physicalAddress", F.col("_placed"), F.col("_address_json"), F.col("_address_json")),
        plain("location.phone", c["phone"]),
        _item("location.siteType", has_site, tx.json_text(F.col("_site.normalized")), tx.json_text(c["siteTypeCode"])),
        _item("location.employeeSizeSite", estimate.isNotNull(),
              F.concat(F.lit('{"estimate":'), tx.json_number(estimate), F.lit("}")), tx.json_number(estimate)),
    ]
    staged = staged.withColumn("_items", F.array(*items))
    evidence = _observed(F.col("_items"), source, c["publishedAt"])
    first, web, url = JSON_EVIDENCE
    return staged.select(
        "seq", "source_id", c["reportId"].alias("record_id"), "fingerprint", "reject_reason",
        F.lit(source_name).alias("source_name"),
        c["sourceUrl"].alias("source_url"),
        F.struct(F.col("_name").alias("legal_name"), c["website"].alias("website")).alias("company"),
        "physical_address",
        "phone",
        F.lit(MARKET).alias("market"),
        F.lit(None).cast("string").alias("county"),
        F.when(has_site, F.col("_site.normalized")).alias("site_type"),
        F.when(has_site, F.col("_site.raw_code")).alias("raw_site_type_code"),
        F.when(estimate.isNotNull(), F.struct(estimate.alias("estimate"))).alias("employee_size_site"),
        c["notes"].alias("description"),
        F.when(
            has_contact,
            F.array(F.struct(contact.alias("id"), c["contactName"].alias("name"), c["contactTitle"].alias("title"),
                             c["contactEmail"].alias("email"), c["contactPhone"].alias("phone"))),
        ).otherwise(F.array()).alias("contacts"),
        F.coalesce(c["publishedAt"], F.lit(now)).alias("captured_at"),
        F.array_compact(F.array(
            F.lit(first), F.when(tx.truthy(c["website"]), web), F.when(tx.truthy(c["sourceUrl"]), url)
        )).alias("evidence"),
        evidence.alias("field_evidence"),
        "raw_source_data",
    )


# Source id -> function (spark, path) -> mapped drafts.
SOURCES = {
    "dfw-csv": lambda spark, path: map_licence_rows(read_licence_csv(spark, path)),
    "dfw-json": lambda spark, path: map_json_items(read_json_feed(spark, path)),
}
