"""Field-level evidence: lookup, summaries, research planning and merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold import schemas
from sitefold.functions import text as tx
from sitefold.operators.lineage import cut_lineage
from sitefold.operators.readiness import with_readiness

# Fields a research provider may propose, in order, with the readiness
# field each answers (None: optional only).
RESEARCH_FIELDS = {
    "company.legalName": "company.legalName",
    "company.website": None,
    "company.alphasort": "company.alphasort",
    "company.startYear": "company.startYear",
    "company.sicCode": "company.sicCode",
    "company.relationship": None,
    "location.physicalAddress": "location.physicalAddress",
    "location.mailingAddress": None,
    "location.phone": "location.phone",
    "location.market": None,
    "location.county": None,
    "location.siteType": "location.siteType",
    "location.employeeSizeSite": "location.employeeSizeSite",
    "location.employeeSizeCompanyWide": "location.employeeSizeCompanyWide",
    "contact.name": "contacts",
    "contact.email": "contacts",
}
DISPLAY_FIELDS = [
    "company.legalName", "company.website", "company.sicCode", "company.alphasort", "company.startYear",
    "location.physicalAddress", "location.phone", "location.siteType", "location.employeeSizeSite",
]
# Paths a merge can read and write, besides ``contact.<id>.name`` and ``.email`` of a contact that the candidate has;
# any other path reads as empty and is not written.
MERGE_PATHS = [f for f in RESEARCH_FIELDS if not f.startswith("contact.")]
CONTACT_FIELDS = ("name", "email")
STRUCTURED = {
    "company.relationship": schemas.RELATIONSHIP, "location.physicalAddress": schemas.ADDRESS, "location.mailingAddress": schemas.ADDRESS,
    "location.employeeSizeSite": schemas.BAND, "location.employeeSizeCompanyWide": schemas.BAND,
}


def valid_confidence(c: Column) -> Column:
    """Finite and within [0, 1]; anything else is refused, never clamped."""
    return F.coalesce(~F.isnan(c) & c.between(0.0, 1.0), F.lit(False))


def evidence_rows(candidates: DataFrame) -> DataFrame:
    """Long form: (candidate_id, seq, evidence fields)."""
    return candidates.select(F.col("id").alias("candidate_id"), F.posexplode("field_evidence").alias("seq", "e")).select(
        "candidate_id", "seq", "e.*"
    )


def evidence_for(rows: DataFrame, path_key: str) -> DataFrame:
    """Evidence of one field, in insertion order within a candidate."""
    return rows.where(F.col("path_key") == path_key).orderBy("candidate_id", "seq")


def source_ref_for_view(s: Column) -> Column:
    return F.coalesce(s["source_url"], s["source_observation_id"], s["source_record_id"], s["source_name"])


def source_ref_for_merge(s: Column) -> Column:
    return F.coalesce(s["source_observation_id"], s["source_record_id"], s["source_url"])


def source_identity(s: Column) -> Column:
    """Two pieces of evidence come from the same source if this text is equal."""
    ref = F.coalesce(source_ref_for_merge(s), F.lit(""))
    return F.to_json(F.array(F.coalesce(s["source_id"], F.lit("")), F.coalesce(s["source_type"], F.lit("")), ref))


# --------------------------------------------------------------------- summaries


def _has_value() -> dict[str, Column]:
    co, phys = F.col("company"), F.col("physical_address")
    return {
        "company.legalName": tx.filled(co["legal_name"]),
        "company.website": tx.filled(co["website"]),
        "company.sicCode": tx.filled(co["sic_code"]),
        "company.alphasort": tx.filled(co["alphasort"]),
        "company.startYear": co["start_year"].isNotNull(),
        "location.physicalAddress": tx.filled(phys["street"]) | tx.filled(phys["city"]),
        "location.phone": tx.filled(F.col("phone")),
        "location.siteType": F.col("site_type").isNotNull(),
        "location.employeeSizeSite": F.col("employee_size_site").isNotNull(),
    }


def _compact_evidence() -> Column:
    """What a summary reads of the evidence array."""
    return F.transform("field_evidence", lambda e: F.struct(
        e["path_key"].alias("path_key"), e["value_json"].alias("value_json"), e["confidence"].alias("confidence"),
        e["source"]["source_type"].alias("source_type"), source_ref_for_view(e["source"]).alias("source_ref"), e["evidence_text"].alias("evidence_text")))


def _field(key: Column, has_value: Column) -> Column:
    """A field with its own part of the row's ``_evidence``, so that exploding the fields copies each item once."""
    own = F.filter("_evidence", lambda e: e["path_key"] == key)
    return F.struct(key.alias("field_key"), has_value.alias("has_value"), own.alias("_items"))


def _summary(fields: DataFrame) -> DataFrame:
    """Summary of the evidence that each row carries for its field; nothing is shuffled."""
    return (
        fields.withColumns(
            {
                "evidence_count": F.size("_items"),
                "conflicting": F.size(F.array_distinct(F.transform("_items", lambda e: e["value_json"]))) > 1,
                "confidences": F.transform("_items", lambda e: e["confidence"]),
                "source_types": F.transform("_items", lambda e: e["source_type"]),
                "source_refs": F.transform("_items", lambda e: e["source_ref"]),
                "evidence_texts": F.filter(
                    F.transform("_items", lambda e: e["evidence_text"]), lambda t: tx.truthy(t)
                ),
            }
        )
        .withColumn("missing_evidence", F.col("has_value") & (F.col("evidence_count") == 0))
        .drop("_items")
    )


def field_summary(candidates: DataFrame) -> DataFrame:
    """One row per candidate and display field."""
    has = _has_value()
    flags = F.struct(*[has[f].alias(f) for f in DISPLAY_FIELDS])
    rows = candidates.select(F.col("id").alias("candidate_id"), flags.alias("has"), _compact_evidence().alias("_evidence"))
    fields = F.array(*[_field(F.lit(f), F.col("has")[f]) for f in DISPLAY_FIELDS])
    return _summary(rows.select("candidate_id", F.explode(fields).alias("f")).select("candidate_id", "f.*"))


def contact_summary(candidates: DataFrame) -> DataFrame:
    """Name and email summaries per contact; a contact without an id has none."""
    rows = candidates.select(F.col("id").alias("candidate_id"), "contacts", _compact_evidence().alias("_evidence"))
    one = rows.select("candidate_id", F.posexplode("contacts").alias("contact_index", "c"), "_evidence").where("c.id IS NOT NULL")
    key = lambda x: F.concat_ws(".", F.lit("contact"), F.col("c.id"), F.lit(x))
    fields = F.array(*[_field(key(x), tx.filled(F.col(f"c.{x}"))) for x in CONTACT_FIELDS])
    return _summary(one.select("candidate_id", "contact_index", F.explode(fields).alias("f")).select("candidate_id", "contact_index", "f.*"))


# ---------------------------------------------------------------------- planning


def target_contact() -> Column:
    """First contact that has an id."""
    return F.get(F.filter("contacts", lambda c: c["id"].isNotNull()), F.lit(0))


def _populated() -> dict[str, Column]:
    co, phys, mail = F.col("company"), F.col("physical_address"), F.col("mailing_address")
    rel, contact = co["relationship"], F.col("_target")
    out = {f: c for f, c in _has_value().items()}
    out |= {
        "company.relationship": tx.filled(rel["parent_company"]) | tx.filled(rel["affiliate"]),
        "location.mailingAddress": tx.filled(mail["street"]) | tx.filled(mail["city"]),
        "location.market": tx.filled(F.col("market")),
        "location.county": tx.filled(F.col("county")),
        "location.siteType": F.coalesce(F.col("site_type") != "unknown", F.lit(False)),
        "location.employeeSizeCompanyWide": F.col("employee_size_company_wide").isNotNull(),
        "contact.name": tx.filled(contact["name"]),
        "contact.email": tx.filled(contact["email"]),
    }
    return out


def plan_fields(assessed: DataFrame, supported: list[str], allowed: list[str] | None = None) -> DataFrame:
    """Fields to research per candidate: (candidate_id, field, mandatory, reason, plan_order).

    ``assessed`` comes from ``with_readiness``. Blocked fields first, then unresolved
    ones, in rule order, then optional gaps in field order. All row-local.
    """
    # Readiness fields in rule order.
    rules = [
        "company.legalName", "company.alphasort", "location.physicalAddress", "location.phone", "location.siteType",
        "location.employeeSizeSite", "company.startYear", "company.sicCode", "contacts",
        "location.employeeSizeCompanyWide",
    ]
    rows = assessed.withColumn("_target", target_contact())
    populated = _populated()
    plans = []
    for position, (field, answers) in enumerate(RESEARCH_FIELDS.items()):
        if field not in supported or (allowed is not None and field not in allowed):
            continue
        contact_field = field.startswith("contact.")
        rank = rules.index(answers) * 2 + (field == "contact.email") if answers else 0
        blocked = F.array_contains("blockers.field", answers) if answers else F.lit(False)
        open_ = F.array_contains("unresolved_rules.field", answers) if answers else F.lit(False)
        reason = F.when(blocked, "blocked_field").when(open_, "unresolved_field").otherwise("optional_gap")
        order = F.when(blocked, rank).when(open_, 100 + rank).otherwise(200 + position)
        wanted = ~populated[field]
        if contact_field:
            wanted = wanted & F.col("_target").isNotNull()
        plans.append(
            F.when(
                wanted,
                F.struct(F.lit(field).alias("field"), blocked.alias("mandatory"), reason.alias("reason"),
                         order.alias("plan_order")),
            )
        )
    return rows.select(
        F.col("id").alias("candidate_id"), F.col("_target.id").alias("target_contact_id"),
        F.explode(F.array_compact(F.array(*plans))).alias("p"),
    ).select("candidate_id", "target_contact_id", "p.*")


def provider_requests(plans: DataFrame, providers: DataFrame, max_providers: int | None = None) -> DataFrame:
    """One row per candidate and eligible provider: the planned fields it supports.

    ``providers`` has provider_id, position, can_run and field (one row per supported
    field). The field list of a request is bounded by the number of research fields.
    """
    usable = providers.where("can_run")
    if max_providers is not None:
        usable = usable.where(F.col("position") <= max_providers)
    return (
        plans.join(usable, "field")
        .groupBy("candidate_id", "provider_id", "position")
        .agg(F.array_sort(F.collect_list(F.struct("plan_order", "field")))["field"].alias("fields"))
    )


# ------------------------------------------------------------------------- merge


def canonical(path: Column, value: Column) -> Column:
    """One form for a field's value, whether it comes from evidence or from the candidate.

    A JSON string is its text; an address, band or relationship is JSON with the candidate's member names and order, without
    empty members. Any other text is left alone.
    """
    quoted = value.rlike(r'(?s)^\s*".*"\s*$')
    out = F.when(quoted, F.coalesce(F.try_variant_get(F.try_parse_json(value), "$", "string"), value)).otherwise(value)
    for name, ddl in STRUCTURED.items():
        members = [m.split(":")[0] for m in ddl[len("struct<"):-1].split(",")]
        renamed = value
        for m in members:
            first, *rest = m.split("_")
            if rest:
                renamed = F.replace(renamed, F.lit(f'"{first}{"".join(r.capitalize() for r in rest)}":'), F.lit(f'"{m}":'))
        text = F.nullif(F.to_json(F.from_json(renamed, ddl)), F.lit("{}"))
        out = F.when(path == name, F.coalesce(text, value)).otherwise(out)
    return out


# A field is looked at in one task unless the bin that it falls into holds more proposals than this, beyond twice the mean of the bins.
CROWDED = 1_000_000
FIELD_BINS = 4096


def classify_proposals(proposals: DataFrame, current: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """What each proposal does to its field: adds ``merge_class``.

    ``proposals``: candidate_id, path_key, seq, value, source_key, derivation, is_prior
    (evidence already present), force_conflict (a provider's own conflict).
    ``current``: candidate_id, path_key, current_value.

    Going through the proposals of a field in order, each row only asks whether
    something came *before* it: the same source and value, a human confirmation,
    another value. First positions answer that. The proposals are written once, dealt
    by field and sorted once; all first positions are windows over that one order, and
    the current values meet it as it is. A field of very many proposals is not looked
    at in one task: such fields, found by counting hash bins, go through aggregates that
    combine map-side (``_positions_by_joins``), with the same result.
    """
    field = ["candidate_id", "path_key"]
    rows = cut_lineage(proposals.withColumn("value", canonical(F.col("path_key"), F.coalesce("value", F.lit("")))))
    current = current.select(*field, canonical(F.col("path_key"), F.col("current_value")).alias("current_value"), F.lit(True).alias("_known"))
    number = F.pmod(F.xxhash64(*field), F.lit(FIELD_BINS)).cast("int")
    sizes = rows.groupBy(number.alias("bin")).agg(F.count("*").alias("n")).collect()
    most = crowded + 2 * sum(r["n"] for r in sizes) / FIELD_BINS
    large = [r["bin"] for r in sizes if r["n"] > most]
    if large:
        placed = _positions(rows.where(~number.isin(large))).unionByName(_positions_by_joins(rows.where(number.isin(large))))
    else:
        placed = _positions(rows)
    merge_class = _merge_class(F.col("seq"), F.col("_first"))
    return placed.join(current, field, "left").select(*proposals.columns, "current_value", merge_class.alias("merge_class"))


_POSITIONS = ("_first", "_first_any", "_lead", "_first_other", "_first_human", "_first_open")


def _differs(at: Column) -> Column:
    """Another value was there before position ``at``."""
    before = F.when(F.col("value") == F.col("_lead.value"), F.col("_first_other")).otherwise(F.col("_lead._first_any"))
    return F.coalesce(before < at, F.lit(False))


def _confirmed(at: Column) -> Column:
    return F.coalesce(F.col("_first_human") < at, F.lit(False))


def _special() -> Column:
    return F.col("is_prior") | F.col("force_conflict")


def _human() -> Column:
    return F.col("derivation") == "human_confirmed"


def _positions(rows: DataFrame) -> DataFrame:
    """First positions beside each row, from one sort by field, value and source: every window below needs a prefix of it."""
    field = ["candidate_id", "path_key"]
    in_group = Window.partitionBy(*field, "value", "source_key")
    in_value, in_field = Window.partitionBy(*field, "value"), Window.partitionBy(*field)
    seq, leads = F.col("seq"), F.col("value") == F.col("_lead.value")
    starts = seq == F.col("_first")
    # An open group has the first value, or starts at the same place.
    may_open = starts & ~_special() & (leads | (seq == F.col("_lead._first_any")))
    opened = F.col("_may_open")
    return (
        rows.repartition(*field)
        .withColumn("_first", F.min("seq").over(in_group))
        .withColumn("_first_any", F.min("seq").over(in_value))
        .withColumns({
            "_lead": F.min(F.struct("_first_any", "value")).over(in_field),
            # repeats are dropped and confirm nothing; prior rows and provider conflicts never are repeats
            "_first_human": F.min(F.when(_human() & (_special() | starts), seq)).over(in_field),
        })
        .withColumns({
            "_first_other": F.min(F.when(~leads, F.col("_first_any"))).over(in_field),
            "_may_open": F.min(F.when(may_open, seq)).over(in_field),
        })
        .withColumn("_first_open", F.when(~_confirmed(opened) & ~F.coalesce(F.col("_first_other") < opened, F.lit(False)), opened))
        .drop("_may_open")
    )


def _positions_by_joins(rows: DataFrame) -> DataFrame:
    """The same positions where a field may have any number of rows: aggregates per (field, source, value) and above, joined back."""
    names = rows.columns
    # As structs, so that rows without a source or path meet their like.
    rows = rows.withColumns({"_field": F.struct("candidate_id", "path_key"), "_source": F.struct("source_key")})
    group = ["_field", "_source", "value"]
    groups = cut_lineage(rows.groupBy(*group).agg(
        F.min("seq").alias("_first"),
        F.min_by(_special(), "seq").alias("_first_special"),
        F.min_by(_human(), "seq").alias("_first_is_human"),
        F.min(F.when(_special() & _human(), F.col("seq"))).alias("_special_human"),
    ))
    by_value = groups.groupBy("_field", "value").agg(F.min("_first").alias("_first_any"))
    lead = by_value.groupBy("_field").agg(F.min(F.struct("_first_any", "value")).alias("_lead"))
    other = (
        by_value.join(lead, "_field")
        .where(F.col("value") != F.col("_lead.value"))
        .groupBy("_field")
        .agg(F.min("_first_any").alias("_first_other"))
    )
    confirmed_at = groups.groupBy("_field").agg(
        F.min(F.least(F.when(F.col("_first_is_human"), F.col("_first")), "_special_human")).alias("_first_human")
    )
    facts = lead.join(other, "_field", "left").join(confirmed_at, "_field")
    groups = groups.join(by_value, ["_field", "value"]).join(facts, "_field")
    first = F.col("_first")
    groups = groups.withColumn("_open", ~F.col("_first_special") & ~_confirmed(first) & ~_differs(first))
    first_open = groups.where("_open").groupBy("_field").agg(F.min("_first").alias("_first_open"))
    groups = groups.join(first_open, "_field", "left").select(*group, *_POSITIONS)
    return rows.join(groups, group).select(*names, *_POSITIONS)


def _merge_class(seq: Column, first: Column) -> Column:
    empty = ~tx.filled(F.col("current_value"))
    # A blank value, or a path that cannot be written, leaves the field empty: the next one fills again.
    sticks = tx.filled(F.col("value")) & (F.col("path_key").isin(MERGE_PATHS) | (_is_contact(F.col("path_key")) & F.coalesce("_known", F.lit(False))))
    agrees = F.col("_first_any") < seq
    same_as_current = ~empty & (F.col("value") == F.col("current_value"))
    return (
        F.when(F.col("is_prior"), "prior")
        .when(F.col("force_conflict"), "provider_conflict")
        .when(seq > first, "repeat")
        .when(_confirmed(seq) & agrees, "agrees")
        .when(_confirmed(seq) | _differs(seq), "conflict")
        .when(empty & ((seq == F.col("_first_open")) | ~sticks), "fill")
        .when(agrees | same_as_current | empty, "agrees")
        .otherwise("conflict")
    )


def filled_values(classified: DataFrame) -> DataFrame:
    """(candidate_id, path_key, value) a merge writes; contacts that the candidate does not have are left out on writing."""
    written = F.col("path_key").isin(MERGE_PATHS) | _is_contact(F.col("path_key"))
    return classified.where((F.col("merge_class") == "fill") & written).groupBy(
        "candidate_id", "path_key"
    ).agg(F.max_by("value", "seq").alias("value"))


def get_field(path_key: str) -> Column:
    """Value of a merge path in the candidate row, as text; null for any other path."""
    co = F.col("company")
    plain = {
        "company.legalName": co["legal_name"],
        "company.website": co["website"],
        "company.alphasort": co["alphasort"],
        "company.startYear": co["start_year"].cast("string"),
        "company.sicCode": co["sic_code"],
        "company.relationship": F.to_json(co["relationship"]),
        "location.physicalAddress": F.to_json("physical_address"),
        "location.mailingAddress": F.to_json("mailing_address"),
        "location.phone": F.col("phone"),
        "location.market": F.col("market"),
        "location.county": F.col("county"),
        "location.siteType": F.col("site_type"),
        "location.employeeSizeSite": F.to_json("employee_size_site"),
        "location.employeeSizeCompanyWide": F.to_json("employee_size_company_wide"),
    }
    return plain.get(path_key, F.lit(None).cast("string"))


def _is_contact(path: Column) -> Column:
    return path.rlike(rf"(?s)^contact\..*\.({'|'.join(CONTACT_FIELDS)})$")


def _contact_path(contact: Column, field: str) -> Column:
    return F.concat(F.lit("contact."), contact["id"], F.lit(f".{field}"))


def contact_values(candidates: DataFrame) -> DataFrame:
    """(candidate_id, path_key, current_value) of name and email of each contact; the first of equal ids counts."""
    rows = candidates.select(F.col("id").alias("candidate_id"), F.posexplode("contacts").alias("at", "c")).where("c.id IS NOT NULL")
    first = rows.groupBy("candidate_id", "c.id").agg(F.min_by("c", "at").alias("c"))
    items = F.array(*[F.struct(_contact_path(F.col("c"), f).alias("path_key"), F.col("c")[f].alias("current_value")) for f in CONTACT_FIELDS])
    return first.select("candidate_id", F.inline(items))


def field_values(candidates: DataFrame, paths: list[str] = MERGE_PATHS) -> DataFrame:
    """Wide to long: (candidate_id, path_key, current_value), contacts included."""
    items = F.array(*[F.struct(F.lit(p).alias("path_key"), get_field(p).alias("current_value")) for p in paths])
    return candidates.select(F.col("id").alias("candidate_id"), F.inline(items)).unionByName(contact_values(candidates))


def set_fields(candidates: DataFrame, values: DataFrame) -> DataFrame:
    """Write (candidate_id, path_key, value) rows back into the nested candidate."""
    v = {p: f"_v{i}" for i, p in enumerate(MERGE_PATHS)}
    wide = values.groupBy("candidate_id").agg(
        *[F.max(F.when(F.col("path_key") == p, F.col("value"))).alias(c) for p, c in v.items()]
    )
    rows = candidates.join(wide.withColumnRenamed("candidate_id", "id"), "id", "left")
    # Only paths of contacts that are there: at most two entries for each of them.
    known = contact_values(candidates).select("candidate_id", "path_key")
    of_contacts = values.join(known, ["candidate_id", "path_key"]).groupBy(F.col("candidate_id").alias("id")).agg(
        F.map_from_entries(F.collect_list(F.struct("path_key", "value"))).alias("_contacts"))
    rows = rows.join(of_contacts, "id", "left")

    def with_values(c: Column) -> Column:
        for f in CONTACT_FIELDS:
            c = c.withField(f, F.coalesce(F.try_element_at("_contacts", _contact_path(c, f)), c[f]))
        return c

    types = dict(candidates.dtypes)
    rel_type = candidates.schema["company"].dataType["relationship"].dataType.simpleString()

    def new(path: str, old: Column) -> Column:
        return F.coalesce(F.col(v[path]), old)

    def parsed(path: str, ddl: str, old: Column) -> Column:
        return F.coalesce(F.from_json(F.col(v[path]), ddl), old)

    co = F.col("company")
    company = reduce(
        lambda c, kv: c.withField(*kv),
        [
            ("legal_name", new("company.legalName", co["legal_name"])),
            ("website", new("company.website", co["website"])),
            ("alphasort", new("company.alphasort", co["alphasort"])),
            ("start_year", F.coalesce(F.col(v["company.startYear"]).try_cast("int"), co["start_year"])),
            ("sic_code", new("company.sicCode", co["sic_code"])),
            ("relationship", parsed("company.relationship", rel_type, co["relationship"])),
        ],
        co,
    )
    out = rows.withColumns(
        {
            "contacts": F.transform("contacts", with_values),
            "company": company,
            "physical_address": parsed("location.physicalAddress", types["physical_address"], F.col("physical_address")),
            "mailing_address": parsed("location.mailingAddress", types["mailing_address"], F.col("mailing_address")),
            "phone": new("location.phone", F.col("phone")),
            "market": new("location.market", F.col("market")),
            "county": new("location.county", F.col("county")),
            "site_type": new("location.siteType", F.col("site_type")),
            "employee_size_site": parsed("location.employeeSizeSite", types["employee_size_site"], F.col("employee_size_site")),
            "employee_size_company_wide": parsed(
                "location.employeeSizeCompanyWide", types["employee_size_company_wide"], F.col("employee_size_company_wide")
            ),
        }
    )
    return out.select(candidates.columns)


def readiness_delta(candidates: DataFrame, classified: DataFrame) -> DataFrame:
    """Publication state before and after a merge, with fill and conflict counts."""
    # Written once: the values written and the counts both start from it.
    classified = cut_lineage(classified.select("candidate_id", "path_key", "seq", "value", "merge_class"))
    return state_change(with_readiness(candidates), set_fields(candidates, filled_values(classified)), classified)


def state_change(assessed: DataFrame, merged: DataFrame, classified: DataFrame) -> DataFrame:
    """The same, where the candidates with their readiness and the merged candidates are at hand."""
    before = assessed.select(
        F.col("id").alias("candidate_id"), F.col("publication_state").alias("initial_state"),
        F.size("blockers").alias("initial_blockers"),
    )
    after = with_readiness(merged).select(
        F.col("id").alias("candidate_id"), F.col("publication_state").alias("final_state"),
        F.size("blockers").alias("final_blockers"),
    )
    counts = classified.groupBy("candidate_id").agg(
        F.count_if(F.col("merge_class") == "fill").alias("filled_count"),
        F.count_if(F.col("merge_class").isin("conflict", "provider_conflict")).alias("conflict_count"),
    )
    zero = F.lit(0)
    return (
        before.join(after, "candidate_id")
        .join(counts, "candidate_id", "left")
        .withColumns(
            {"filled_count": F.coalesce("filled_count", zero), "conflict_count": F.coalesce("conflict_count", zero)}
        )
    )
