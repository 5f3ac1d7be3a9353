"""Publication readiness, research completeness and review priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitefold.functions import text as tx

# Completeness weights, in the order in which they are added.
COMPLETENESS_WEIGHTS = {
    "company.legalName": 0.2,
    "location.physicalAddress": 0.15,
    "location.phone": 0.15,
    "company.website": 0.1,
    "location.employeeSizeSite": 0.1,
    "location.description": 0.1,
    "company.sicCode": 0.1,
    "contacts": 0.1,
}


def has_meaningful_contact(contacts: Column) -> Column:
    return F.coalesce(F.exists(contacts, lambda c: tx.filled(c["name"]) | tx.filled(c["email"])), F.lit(False))


def acceptable_phone(phone: Column) -> Column:
    return F.length(tx.phone_digits(phone)) == 10


def acceptable_address(physical: Column, mailing: Column) -> Column:
    """Full street address, or a ZIP together with a mailing street or city."""
    zip_code = tx.filled(physical["postal_code"])
    full = tx.filled(physical["street"]) & tx.filled(physical["city"]) & tx.filled(physical["state"]) & zip_code
    return full | (zip_code & (tx.filled(mailing["street"]) | tx.filled(mailing["city"])))


def phone_state(phone: Column, physical: Column, mailing: Column) -> Column:
    digits = tx.phone_digits(phone)
    return (
        F.when(digits == tx.PLACEHOLDER_PHONE, "approved_exception")
        .when(F.length(digits) == 10, "valid_phone")
        .when(acceptable_address(physical, mailing), "exception_potentially_applicable")
        .otherwise("absent")
    )


def has_band(band: Column) -> Column:
    return (
        band["estimate"].isNotNull()
        | band["minimum"].isNotNull()
        | band["maximum"].isNotNull()
        | tx.filled(band["band_label"])
        | tx.filled(band["raw_code"])
    )


def _rule(
    rule_id: str, scope: str, field: str, satisfied: Column, explanation: Column | str,
    exception: bool = False, normalized: Column | None = None, raw: Column | None = None,
) -> Column:
    text = explanation if isinstance(explanation, Column) else F.lit(explanation)
    empty = F.lit(None).cast("string")
    return F.struct(
        F.lit(rule_id).alias("rule_id"),
        F.lit(scope).alias("scope"),
        F.lit(field).alias("field"),
        satisfied.alias("satisfied"),
        text.alias("explanation"),
        F.lit(exception).alias("exception_applicable"),
        (empty if normalized is None else normalized).alias("normalized_value"),
        (empty if raw is None else raw).alias("raw_value"),
    )


def base_rules() -> list[Column]:
    co = F.col("company")
    physical, mailing, phone = F.col("physical_address"), F.col("mailing_address"), F.col("phone")
    state = phone_state(phone, physical, mailing)
    contact = has_meaningful_contact(F.col("contacts"))
    site = F.col("site_type")
    return [
        _rule("company_name_present", "company", "company.legalName", tx.filled(co["legal_name"]),
              "Every record needs a company name."),
        _rule("alphasort_present", "company", "company.alphasort", tx.filled(co["alphasort"]),
              "Every record needs a sort name."),
        _rule("physical_address_or_exception", "location", "location.physicalAddress",
              acceptable_address(physical, mailing),
              "A full physical address is needed, or a ZIP with a usable mailing address.", exception=True),
        _rule("local_phone_or_exception", "location", "location.phone",
              state.isin("valid_phone", "approved_exception"),
              F.when(state == "exception_potentially_applicable",
                     "No local phone, but the address is confirmed: the unpublished-phone exception may apply.")
              .otherwise("A local phone is needed, or the agreed placeholder for unpublished numbers."),
              exception=True, raw=phone),
        _rule("building_type_present", "location", "location.buildingType", tx.filled(F.col("building_type")),
              "Every record needs a building type."),
        _rule("site_type_present", "location", "location.siteType",
              F.coalesce(site != "unknown", F.lit(False)),
              "Every record needs a known site type.", normalized=site, raw=F.col("raw_site_type_code")),
        _rule("site_employee_band_present", "location", "location.employeeSizeSite",
              has_band(F.col("employee_size_site")), "Every record needs the employee size of the site."),
        _rule("start_year_present", "company", "company.startYear", co["start_year"].isNotNull(),
              "Every record needs a start year."),
        _rule("sic_code_present", "company", "company.sicCode", tx.filled(co["sic_code"]),
              "Every record needs an SIC code."),
        _rule("min_one_contact", "contact", "contacts", contact,
              F.when(contact, "At least one contact has a name or an email.")
              .otherwise("At least one contact with a name or an email is needed.")),
    ]


def conditional_rules() -> list[Column]:
    """Rules for single sites and headquarters only."""
    return [
        _rule("company_wide_employee_band_present", "company", "location.employeeSizeCompanyWide",
              has_band(F.col("employee_size_company_wide")),
              "Single sites and headquarters need the company-wide employee size."),
        _rule("estimated_revenue_present", "company", "location.estimatedAnnualRevenue",
              has_band(F.col("estimated_annual_revenue")),
              "Single sites and headquarters need an estimated revenue band."),
        _rule("total_sites_present", "company", "location.totalSites", F.col("total_sites").isNotNull(),
              "Single sites and headquarters need the number of sites."),
    ]


def with_readiness(candidates: DataFrame) -> DataFrame:
    """Add blockers, unresolved_rules, satisfied_requirements, optional_missing_fields, publication_state."""
    site = F.col("site_type")
    state = phone_state(F.col("phone"), F.col("physical_address"), F.col("mailing_address"))
    undecided = _rule(
        "site_type_present", "location", "location.employeeSizeCompanyWide|estimatedAnnualRevenue|totalSites",
        F.lit(False),
        "Until the site type is known it is open whether the single-site and headquarters rules apply.",
        normalized=site,
    )
    base = F.array(*base_rules())
    extra = F.when(site.isin("single_site", "headquarters"), F.array(*conditional_rules()))
    rules = F.coalesce(F.concat(base, extra), base)

    def open_question(r: Column) -> Column:
        return (r["rule_id"] == "local_phone_or_exception") & (F.col("_phone_state") == "exception_potentially_applicable")

    def issue(r: Column) -> Column:
        return r.dropFields("satisfied")

    failed = F.filter("_rules", lambda r: ~r["satisfied"])
    unresolved = F.transform(F.filter(failed, open_question), issue)
    site_open = F.when(site.isNull() | (site == "unknown"), F.array(issue(undecided)))
    co = F.col("company")
    return (
        candidates.withColumns({"_rules": rules, "_phone_state": state})
        .withColumns(
            {
                "blockers": F.transform(F.filter(failed, lambda r: ~open_question(r)), issue),
                "unresolved_rules": F.coalesce(F.concat(unresolved, site_open), unresolved),
                "satisfied_requirements": F.transform(
                    F.filter("_rules", lambda r: r["satisfied"]),
                    lambda r: F.struct(r["rule_id"], r["scope"], r["field"], r["explanation"]),
                ),
                "optional_missing_fields": F.array_compact(
                    F.array(
                        F.when(~tx.filled(co["email_format"]), "company.emailFormat"),
                        F.when(
                            ~tx.filled(co["relationship"]["parent_company"])
                            & ~tx.filled(co["relationship"]["affiliate"]),
                            "company.relationship",
                        ),
                    )
                ),
            }
        )
        .withColumn(
            "publication_state",
            F.when(F.size("blockers") > 0, "blocked")
            .when(F.size("unresolved_rules") > 0, "provisionally_ready")
            .otherwise("confirmed_ready"),
        )
        .withColumn("publication_ready", F.col("publication_state") == "confirmed_ready")
        .drop("_rules", "_phone_state")
    )


# ----------------------------------------------------- completeness, priority


def _present() -> dict[str, Column]:
    """Presence tests of the completeness score: plain truthiness, no trimming."""
    estimate = F.col("employee_size_site.estimate")
    return {
        "company.legalName": tx.truthy(F.col("company.legal_name")),
        "location.physicalAddress": tx.truthy(F.col("physical_address.street")),
        "location.phone": tx.truthy(F.col("phone")),
        "company.website": tx.truthy(F.col("company.website")),
        "location.employeeSizeSite": F.coalesce((estimate != 0) & ~F.isnan(estimate), F.lit(False)),
        "location.description": tx.truthy(F.col("description")),
        "company.sicCode": tx.truthy(F.col("company.sic_code")),
        "contacts": has_meaningful_contact(F.col("contacts")),
    }


def with_completeness(candidates: DataFrame) -> DataFrame:
    """Add completeness_score, present_fields and missing_fields."""
    present = _present()
    total = F.lit(0.0)
    for field, weight in COMPLETENESS_WEIGHTS.items():
        total = total + F.when(present[field], F.lit(weight)).otherwise(F.lit(0.0))
    return candidates.withColumns(
        {
            "completeness_score": tx.fixed4(total),
            "present_fields": F.array_compact(F.array(*[F.when(c, f) for f, c in present.items()])),
            "missing_fields": F.array_compact(F.array(*[F.when(~c, f) for f, c in present.items()])),
        }
    )


def review_priority(completeness: Column, match_classification: Column) -> Column:
    """Reads employee_size_site and site_type of the row; uses the low-level match class."""
    n = F.col("employee_size_site.estimate")
    core_size = F.coalesce(n.between(10, 99), F.lit(False))
    core_site = F.coalesce(F.col("site_type").isin("single_site", "headquarters"), F.lit(True))
    score = (
        completeness * 0.45
        + F.when(match_classification == "likely_new", 0.35).otherwise(0.0)
        + F.when(core_size & core_site, 0.2).otherwise(0.0)
        + F.when(~core_size & (n >= 4), 0.05).otherwise(0.0)
        - F.when(match_classification == "possible_duplicate", 0.15).otherwise(0.0)
    )
    return tx.fixed4(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))
