"""Registered queries: each a Spark callable and, where SQL can say it, a DuckDB check."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle import parts as P
from oracle.views import VIEWS, register, with_views
from sitefold.functions import codes
from sitefold.functions import text as tx
from sitefold.operators import evaluation, evidence, matching, policy, profiling, readiness, review, tables
from sitefold.operators.lineage import cut_lineage, shared_folder
from sitefold.operators.similarity import similar_values
from sitefold.plans import decisions, enrich, evaluate, runs
from sitefold.plans import ingest as ingest_plan
from sitefold.plans.profile import profile_source
from sitefold.plans.queue import score_candidates
from sitefold.schemas import as_candidates, as_evidence
from sitefold.sources import feeds, master, permits
from sitefold.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
d = P.d


def query(name: str, sql: str | None = None) -> Callable[[Callable[[SparkSession], DataFrame]], Query]:
    """Register a query that reads the views of the given folder."""

    def add(fn: Callable[[SparkSession], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            register(spark, sf_dir)
            return fn(spark)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return run

    return add


# ------------------------------------------------------------- shared inputs


def joined(c: str | Column) -> Column:
    """Array of strings as one text, so that both engines compare plain values."""
    return F.concat_ws("|", c)


def long(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def candidates(spark: SparkSession) -> DataFrame:
    return as_candidates(
        spark.sql(
            """
            SELECT id, named_struct('legal_name', legal_name, 'website', website, 'sic_code', sic_code, 'alphasort', alphasort,
                'start_year', start_year, 'email_format', email_format,
                'relationship', named_struct('parent_company', parent_company)) AS company,
              named_struct('street', street, 'city', city, 'state', state, 'postal_code', postal_code) AS physical_address,
              named_struct('city', mailing_city) AS mailing_address, phone, site_type, building_type, total_sites, description,
              CASE WHEN employee_estimate IS NOT NULL THEN named_struct('estimate', employee_estimate) END AS employee_size_site,
              named_struct('band_label', company_band) AS employee_size_company_wide,
              CASE WHEN revenue IS NOT NULL THEN named_struct('minimum', revenue) END AS estimated_annual_revenue,
              CASE WHEN contact_name IS NULL THEN array() ELSE array(named_struct('id', 'contact-' || id, 'name', contact_name)) END AS contacts
            FROM fx_candidate
            """
        )
    )


def directory(spark: SparkSession) -> DataFrame:
    return spark.table("fx_company")


def edges(spark: SparkSession) -> DataFrame:
    return spark.table("fx_edge")


def drafts(spark: SparkSession) -> DataFrame:
    return feeds.map_licence_rows(spark.table("fx_source_row"), now="2024-01-01T00:00:00.000Z")


def observed(spark: SparkSession) -> DataFrame:
    return permits.observations(spark.table("fx_permit"))


TIES = ["tie_key", "tie_price"]
_RECORD_ID = f"CASE WHEN {P.field('taxpayer_number')} IS NOT NULL AND {P.field('outlet_number')} IS NOT NULL THEN {P.field('taxpayer_number')} || ':' || {P.field('outlet_number')} END"
WINDOW = ("1995-01-01", "2001-12-31")
COUNTIES = permits.DEFAULT_COUNTIES
_IN_WINDOW = "outlet_county_code IN ('043', '057', '061', '220') AND outlet_permit_issue_date >= DATE '1995-01-01' AND outlet_permit_issue_date < DATE '2001-12-31'"
_PERMIT_ORDER = "outlet_permit_issue_date, taxpayer_number, outlet_number, tie_key, tie_price"
_UNIQUE = f"""uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_record_id ORDER BY {_PERMIT_ORDER}) AS rn
  FROM (SELECT *, {_RECORD_ID} AS source_record_id FROM fx_permit) WHERE source_record_id IS NOT NULL) WHERE rn = 1)"""


# ---------------------------------------------------------------- text functions


@query(
    "company_name_normalised",
    f"SELECT id, {P.name('company_name')} AS normalised FROM fx_company UNION ALL SELECT id, {P.name('legal_name')} FROM fx_candidate",
)
def _(spark):
    a = directory(spark).select("id", tx.company_name(F.col("company_name")).alias("normalised"))
    b = spark.table("fx_candidate").select("id", tx.company_name(F.col("legal_name")).alias("normalised"))
    return a.unionByName(b)


@query("document_name_normalised", f"SELECT doc_id, md5({P.name('text')}) AS digest, length({P.name('text')}) AS n FROM documents")
def _(spark):
    n = tx.company_name(F.col("text"))
    return spark.table("documents").select("doc_id", F.md5(n).alias("digest"), long(F.length(n)).alias("n"))


@query("phone_normalised", f"SELECT doc_id AS k, {P.phone('text')} AS digits FROM documents UNION ALL SELECT k, {P.phone('phone')} FROM fx_company")
def _(spark):
    a = spark.table("documents").select(F.col("doc_id").alias("k"), tx.phone_digits(F.col("text")).alias("digits"))
    return a.unionByName(directory(spark).select("k", tx.phone_digits(F.col("phone")).alias("digits")))


@query(
    "address_normalised",
    f"SELECT k, {P.addr('address')} AS normalised FROM fx_company UNION ALL SELECT doc_id, md5({P.addr('text')}) FROM documents",
)
def _(spark):
    a = directory(spark).select("k", tx.street_address(F.col("address")).alias("normalised"))
    return a.unionByName(
        spark.table("documents").select(F.col("doc_id").alias("k"), F.md5(tx.street_address(F.col("text"))).alias("normalised"))
    )


@query(
    "domain_normalised",
    f"SELECT page_id AS k, {P.domain('url')} AS host FROM pages UNION ALL SELECT k, {P.domain('website')} FROM fx_company",
)
def _(spark):
    a = spark.table("pages").select(F.col("page_id").alias("k"), tx.web_domain(F.col("url")).alias("host"))
    return a.unionByName(directory(spark).select("k", tx.web_domain(F.col("website")).alias("host")))


@query(
    "dice_similarity",
    f"""WITH v AS (SELECT c.id, {P.name('c.legal_name')} AS a, {P.name('m.company_name')} AS b FROM fx_candidate c JOIN fx_company m ON m.id = c.base_id),
    g AS (SELECT *, {P.grams('a')} AS ga, {P.grams('b')} AS gb FROM v) SELECT id, {P.dice('ga', 'gb')} AS similarity FROM g""",
)
def _(spark):
    c = spark.table("fx_candidate").alias("c").join(directory(spark).alias("m"), F.expr("m.id = c.base_id"))
    a, b = tx.company_name(F.col("c.legal_name")), tx.company_name(F.col("m.company_name"))
    return c.select("c.id", a.alias("a"), b.alias("b")).select("id", tx.dice_text(F.col("a"), F.col("b")).alias("similarity"))


@query(
    "similar_part_names",
    f"""WITH l AS (SELECT DISTINCT c_name, c_ng FROM ck WHERE c_name IS NOT NULL), r AS (SELECT DISTINCT m_name, m_ng FROM mk WHERE m_name IS NOT NULL),
    p AS (SELECT c_name AS left_name, m_name AS right_name, {P.dice('c_ng', 'm_ng')} AS similarity FROM l CROSS JOIN r)
    SELECT * FROM p WHERE similarity >= {d(0.7)}""".replace("WITH ", f"WITH {P.KEYS}, ", 1),
)
def _(spark):
    ck, mk = matching.candidate_keys(candidates(spark)), matching.master_keys(directory(spark))
    return similar_values(ck, "c_name", mk, "m_name", 0.7).select(
        F.col("l_value").alias("left_name"), F.col("r_value").alias("right_name"), "similarity"
    )


@query(
    "site_type_codes",
    f"SELECT k, coalesce({P.site_name('site_type_code')}, 'unknown') AS normalized, site_type_code AS raw_code, {P.site_name('site_type_code')} IS NOT NULL AS recognized FROM fx_company",
)
def _(spark):
    return directory(spark).select("k", codes.site_type(F.col("site_type_code")).alias("s")).select("k", "s.*")


@query(
    "lifecycle_codes",
    f"SELECT k, coalesce({P.life_name('status')}, 'unknown') AS normalized, status AS raw_code, {P.life_name('status')} IS NOT NULL AS recognized FROM fx_company",
)
def _(spark):
    return directory(spark).select("k", codes.lifecycle(F.col("status")).alias("s")).select("k", "s.*")


@query("fixed4_rounding", f"SELECT l_orderkey, l_linenumber, l_partkey, l_discount * {d(0.45)} + l_tax AS x, {P.fixed4(f'l_discount * {d(0.45)} + l_tax')} AS rounded FROM lineitem")
def _(spark):
    x = F.col("l_discount") * 0.45 + F.col("l_tax")
    return spark.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", x.alias("x")).withColumn(
        "rounded", tx.fixed4(F.col("x"))
    )


_FP_FIELDS = f"""'address=' || coalesce(address, '') || '|city=' || coalesce(city, '') || '|companyName=' || {P.trim('business_name')} || '|sourceUrl=' || '|state=' || coalesce(state, '')"""
_FP = f"""CASE WHEN coalesce(record_id <> '', false) THEN source_id || ':' || record_id
  ELSE source_id || ':hash-' || substr(sha256(source_id || '|' || {_FP_FIELDS}), 1, 16) END"""


@query("fingerprints", f"SELECT seq, {_FP} AS fingerprint FROM fx_source_row")
def _(spark):
    return drafts(spark).select("seq", "fingerprint")


@query(
    "string_fields",
    f"SELECT taxpayer_organization_type, {P.field('taxpayer_number')} AS taxpayer, {P.field('outlet_name')} AS outlet, count(*) AS n FROM fx_permit GROUP BY ALL",
)
def _(spark):
    return (
        spark.table("fx_permit")
        .groupBy("taxpayer_organization_type", tx.string_field(F.col("taxpayer_number")).alias("taxpayer"),
                 tx.string_field(F.col("outlet_name")).alias("outlet"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "naics_and_city_limits",
    f"""WITH v AS (SELECT {P.field('outlet_naics_code')} AS c, upper({P.field('outlet_inside_outside_city_limits_indicator')}) AS l FROM fx_permit)
    SELECT CASE WHEN c IS NULL THEN '(missing)' WHEN length(c) >= 2 THEN left(c, 2) ELSE '(short)' END AS naics2,
      CASE WHEN c IS NULL THEN '(missing)' WHEN length(c) >= 3 THEN left(c, 3) ELSE '(short)' END AS naics3,
      CASE WHEN l LIKE 'I%' THEN 'inside' WHEN l LIKE 'O%' THEN 'outside' ELSE 'unknown' END AS limits, count(*) AS n FROM v GROUP BY ALL""",
)
def _(spark):
    code = F.col("outlet_naics_code")
    limits = tx.city_limits_bucket(F.col("outlet_inside_outside_city_limits_indicator"))
    return (
        spark.table("fx_permit")
        .groupBy(tx.naics_bucket(code, 2).alias("naics2"), tx.naics_bucket(code, 3).alias("naics3"), limits.alias("limits"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "city_state_keys",
    f"SELECT id, CASE WHEN {P.truthy('city')} AND {P.truthy('state')} THEN lower({P.trim('city')}) || '|' || lower({P.trim('state')}) END AS place FROM fx_candidate",
)
def _(spark):
    return spark.table("fx_candidate").select("id", tx.city_state_key(F.col("city"), F.col("state")).alias("place"))


@query(
    "address_risk_flags",
    r"""SELECT tie_key, tie_price, outlet_number, coalesce(regexp_matches(outlet_address, '\bP\.?\s*O\.?\s*BOX\b', 'i'), false) AS po_box,
    coalesce(regexp_matches(outlet_address, '\b(apt|apartment|unit|trlr|trailer|mobile\s*home)\b|#\s*\d+\s*$', 'i'), false) AS residential FROM fx_permit""",
)
def _(spark):
    a = F.col("outlet_address")
    return spark.table("fx_permit").select(
        *TIES, "outlet_number", tx.is_po_box(a).alias("po_box"), tx.is_residential_risk(a).alias("residential")
    )


@query(
    "field_path_keys",
    "SELECT candidate_id, seq, path_key, 'contact.' || source_id || '.name' AS contact_key FROM fx_proposal",
)
def _(spark):
    scope, field = F.split_part("path_key", F.lit("."), F.lit(1)), F.split_part("path_key", F.lit("."), F.lit(2))
    none = F.lit(None).cast("string")
    return spark.table("fx_proposal").select(
        "candidate_id", long("seq").alias("seq"), tx.field_path_key(scope, field, none).alias("path_key"),
        tx.field_path_key(F.lit("contact"), F.lit("name"), F.col("source_id")).alias("contact_key"),
    )


# -------------------------------------------------------------- sources, ingest

_DATE_OK = "try_cast(issued_date AS DATE) IS NOT NULL"
_REJECT = f"""CASE WHEN {P.trim('business_name')} = '' THEN 'missing business_name'
  WHEN coalesce(issued_date <> '', false) AND NOT {_DATE_OK} THEN 'unexpected mapping error: Invalid Date' END"""
_EMPLOYEES = "nullif(try_cast(employees AS DOUBLE), 0)"
_SITE = f"CASE WHEN {P.truthy('site_type_code')} THEN coalesce({P.site_name('site_type_code')}, 'unknown') END"


@query(
    "licence_mapping",
    f"""SELECT seq, {_FP} AS fingerprint, {_REJECT} AS reject_reason, {P.trim('business_name')} AS legal_name, website, address AS street, city, state,
      zip AS postal_code, phone, 'DFW' AS market, {_SITE} AS site_type, site_type_code AS raw_site_type_code, {_EMPLOYEES} AS employees,
      CASE WHEN {P.truthy('contact_name')} OR {P.truthy('contact_email')} THEN 1 ELSE 0 END AS n_contacts, contact_name, contact_email,
      CASE WHEN issued_date IS NULL OR NOT {_DATE_OK} THEN '2024-01-01T00:00:00.000Z' ELSE strftime(try_cast(issued_date AS DATE), '%Y-%m-%d') || 'T00:00:00.000Z' END AS captured_at
    FROM fx_source_row""",
)
def _(spark):
    contact = F.get("contacts", F.lit(0))
    return drafts(spark).select(
        "seq", "fingerprint", "reject_reason", "company.legal_name", "company.website", "physical_address.street",
        "physical_address.city", "physical_address.state", "physical_address.postal_code", "phone", "market", "site_type",
        "raw_site_type_code", F.col("employee_size_site.estimate").alias("employees"), F.size("contacts").alias("n_contacts"),
        contact["name"].alias("contact_name"), contact["email"].alias("contact_email"), "captured_at",
    )


@query(
    "json_feed_mapping",
    """SELECT event_id, json_extract_string(props, '$.k') IS NOT NULL AND event_id % 2 = 0 AS numbered, 'Firm ' || user_id AS legal_name,
      CASE WHEN event_id % 2 = 0 THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS employees,
      CASE WHEN event_id % 3 = 0 THEN 'Notes ' || event_type END AS description,
      CASE WHEN event_id % 3 = 0 THEN 'https://feed.example/' || event_id END AS source_url,
      CASE WHEN event_id % 3 = 0 THEN 'DFW chamber discovery feed|chamber report URL' ELSE 'DFW chamber discovery feed' END AS evidence,
      CASE WHEN event_id % 2 = 0 THEN 'City ' || (user_id % 25) END AS city FROM events""",
)
def _(spark):
    # Feed items as JSON text: employeeCount is a number on even events and text (to be ignored) on odd ones.
    items = spark.sql(
        """SELECT event_id AS seq, event_id, parse_json(to_json(named_struct('reportId', 'r-' || event_id, 'companyName', ' Firm ' || user_id || ' ',
          'city', CASE WHEN event_id % 2 = 0 THEN 'City ' || (user_id % 25) END,
          'notes', CASE WHEN event_id % 3 = 0 THEN 'Notes ' || event_type END,
          'sourceUrl', CASE WHEN event_id % 3 = 0 THEN 'https://feed.example/' || event_id END,
          'employeeCount', CASE WHEN event_id % 2 = 0 THEN CAST(get_json_object(props, '$.k') AS INT) END,
          'contactTitle', 7))) AS data FROM events"""
    )
    texts = spark.sql(
        """SELECT event_id AS seq, parse_json('{"reportId":"r-' || event_id || '","companyName":" Firm ' || user_id || ' ","employeeCount":"'
          || get_json_object(props, '$.k') || '"' || CASE WHEN event_id % 3 = 0 THEN ',"notes":"Notes ' || event_type || '","sourceUrl":"https://feed.example/' || event_id || '"' ELSE '' END || '}') AS data, event_id FROM events"""
    )
    rows = items.select("seq", F.when(F.col("event_id") % 2 == 0, F.to_json("data")).alias("j"))
    other = texts.select("seq", F.to_json("data").alias("t"))
    both = rows.join(other, "seq").select("seq", F.parse_json(F.coalesce("j", "t")).alias("data"))
    m = feeds.map_json_items(both)
    return m.select(
        F.col("seq").alias("event_id"), F.col("employee_size_site.estimate").isNotNull().alias("numbered"), "company.legal_name",
        F.col("employee_size_site.estimate").alias("employees"), "description", "source_url", joined("evidence").alias("evidence"),
        "physical_address.city",
    )


_DRAFT_SQL = f"dr AS (SELECT *, {_FP} AS fingerprint, {_REJECT} AS reject_reason FROM fx_source_row)"


@query(
    "row_rejections",
    f"WITH {_DRAFT_SQL} SELECT source_id, reject_reason, count(*) AS n FROM dr WHERE reject_reason IS NOT NULL GROUP BY ALL",
)
def _(spark):
    return ingest_plan.skip_reasons(drafts(spark))


# Ledger of an earlier run: what purchases had already brought in by then.
_LEDGER_SQL = f"""led AS (SELECT DISTINCT source_id, fingerprint FROM dr WHERE reject_reason IS NULL AND ts < TIMESTAMP '2024-01-08 00:00:00')"""


def _ledger(spark: SparkSession) -> DataFrame:
    rows = drafts(spark).join(spark.table("fx_source_row").select("seq", "ts"), "seq")
    early = rows.where((F.col("ts") < F.lit(dt.datetime(2024, 1, 8))) & F.col("reject_reason").isNull())
    return early.select("source_id", "fingerprint").distinct()


@query(
    "ingest_counters",
    f"""WITH {_DRAFT_SQL}, {_LEDGER_SQL},
    v AS (SELECT d.*, reject_reason IS NULL AS ok, l.fingerprint IS NOT NULL AS known,
      row_number() OVER (PARTITION BY d.source_id, d.fingerprint, reject_reason IS NULL ORDER BY seq) AS rn
      FROM dr d LEFT JOIN led l ON l.source_id = d.source_id AND l.fingerprint = d.fingerprint)
    SELECT source_id, count(*) AS raw_count, count(*) FILTER (ok) AS valid_count, count(*) FILTER (ok AND NOT known AND rn = 1) AS new_candidate_count,
      count(*) FILTER (ok AND (known OR rn > 1)) AS already_ingested_count, count(*) FILTER (NOT ok) AS skipped_count FROM v GROUP BY 1""",
)
def _(spark):
    return ingest_plan.run_counters(drafts(spark), _ledger(spark))


_NEW_SQL = f"""new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, fingerprint ORDER BY seq) AS rn FROM dr WHERE reject_reason IS NULL)
  WHERE rn = 1 AND (source_id, fingerprint) NOT IN (SELECT (source_id, fingerprint) FROM led))"""


@query(
    "ingest_new_candidates",
    f"""WITH {_DRAFT_SQL}, {_LEDGER_SQL}, {_NEW_SQL}
    SELECT 'loc-' || left(sha256(source_id || '|' || fingerprint), 32) AS id, 'co-' || left(sha256(source_id || '|' || fingerprint), 32) AS company_id,
      {P.trim('business_name')} AS legal_name, fingerprint, source_id, address AS street, {_SITE} AS site_type FROM new""",
)
def _(spark):
    r = ingest_plan.ingest(drafts(spark), _ledger(spark), "run-2", "2024-02-01T00:00:00.000Z")
    return r.candidates.select(
        "id", F.col("company.id").alias("company_id"), "company.legal_name", "source.fingerprint", "source.source_id",
        "physical_address.street", "site_type",
    )


@query(
    "already_ingested",
    f"""WITH {_DRAFT_SQL}, {_LEDGER_SQL} SELECT source_id, count(*) AS n FROM dr WHERE reject_reason IS NULL
      AND (source_id, fingerprint) IN (SELECT (source_id, fingerprint) FROM led) GROUP BY 1""",
)
def _(spark):
    valid = drafts(spark).where("reject_reason IS NULL")
    return valid.join(_ledger(spark), ["source_id", "fingerprint"], "left_semi").groupBy("source_id").agg(F.count("*").alias("n"))


@query(
    "dedup_ledger_insert",
    f"WITH {_DRAFT_SQL}, {_LEDGER_SQL}, {_NEW_SQL} SELECT source_id, fingerprint, seq, record_id FROM new",
)
def _(spark):
    new = drafts(spark).where("reject_reason IS NULL").select("source_id", "fingerprint", "seq", "record_id")
    return tables.insert_if_absent(_ledger(spark), new, ["source_id", "fingerprint"], ["seq"])


_RUN_SQL = """SELECT '{id}' AS run_id, 'success' AS status, count(*) AS raw_count, count(*) FILTER (ok) AS valid_count, count(DISTINCT k) FILTER (ok AND {fresh}) AS new_candidate_count,
  count(*) FILTER (ok) - count(DISTINCT k) FILTER (ok AND {fresh}) AS already_ingested_count, count(*) FILTER (NOT ok) AS skipped_count, false AS has_error FROM k WHERE {rows}"""


@query(
    "source_runs",
    f"""WITH {_DRAFT_SQL}, {_LEDGER_SQL}, k AS (SELECT *, reject_reason IS NULL AS ok, source_id || '|' || fingerprint AS k FROM dr),
    first AS ({_RUN_SQL.format(id='run-1', fresh='true', rows="ts < TIMESTAMP '2024-01-08 00:00:00'")}),
    second AS ({_RUN_SQL.format(id='run-2', fresh="k NOT IN (SELECT source_id || '|' || fingerprint FROM led)", rows='true')}),
    third AS ({_RUN_SQL.format(id='run-3', fresh='true', rows="source_id = 'no such feed'")})
    SELECT * FROM first UNION ALL SELECT * FROM second UNION ALL SELECT * FROM third UNION ALL SELECT 'run-4', 'failed', 0, 0, 0, 0, 0, true""",
)
def _(spark):
    # The feed of the first week, then all of it again, a feed without rows, and one that cannot be read.
    root = _scratch(spark, "runs")
    rows, source = drafts(spark), spark.table("fx_source_row")
    first = feeds.map_licence_rows(source.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 8))), now="2024-01-01T00:00:00.000Z")
    feeds_ = (
        ("run-1", lambda: first), ("run-2", lambda: rows),
        ("run-3", lambda: rows.where("source_id = 'no such feed'")), ("run-4", lambda: spark.read.parquet(f"{root}/missing")),
    )
    for run_id, fetch in feeds_:
        runs.run_source(spark, root, run_id, "feed", "Feed", fetch, lambda: "2024-02-01T00:00:00.000Z")
    return runs.source_runs(spark, root).select("run_id", "status", *runs.COUNTS, F.col("error_message").isNotNull().alias("has_error"))


_EVIDENCE_ITEMS = f"""
  SELECT seq, 1 AS o, 'company.legalName' AS path_key, {P.trim('business_name')} AS v FROM fx_source_row
  UNION ALL SELECT seq, 2, 'company.website', website FROM fx_source_row WHERE {P.truthy('website')}
  UNION ALL SELECT seq, 3, 'contact.name', contact_name FROM fx_source_row WHERE {P.truthy('contact_name')}
  UNION ALL SELECT seq, 4, 'contact.email', contact_email FROM fx_source_row WHERE {P.truthy('contact_email')}
  UNION ALL SELECT seq, 5, 'location.physicalAddress', city FROM fx_source_row WHERE address IS NOT NULL OR city IS NOT NULL OR state IS NOT NULL OR zip IS NOT NULL
  UNION ALL SELECT seq, 6, 'location.phone', phone FROM fx_source_row WHERE {P.truthy('phone')}
  UNION ALL SELECT seq, 7, 'location.siteType', {_SITE} FROM fx_source_row WHERE {P.truthy('site_type_code')}
  UNION ALL SELECT seq, 8, 'location.employeeSizeSite', CAST(CAST({_EMPLOYEES} AS BIGINT) AS STRING) FROM fx_source_row WHERE {_EMPLOYEES} IS NOT NULL"""


@query(
    "evidence_emission",
    f"""WITH ev AS ({_EVIDENCE_ITEMS}) SELECT seq, row_number() OVER (PARTITION BY seq ORDER BY o) - 1 AS position, path_key, v AS value,
      {d(0.6)} AS confidence, 'directly_observed' AS derivation FROM ev""",
)
def _(spark):
    e = drafts(spark).select("seq", F.posexplode("field_evidence").alias("position", "e"))
    key = F.col("e.path_key")
    path = F.when(F.startswith(key, F.lit("contact.")), F.concat(F.lit("contact."), F.substring_index(key, ".", -1))).otherwise(key)
    j = F.col("e.value_json")
    value = (
        F.when(path == "location.physicalAddress", F.get_json_object(j, "$.city"))
        .when(path == "location.employeeSizeSite", F.get_json_object(j, "$.estimate"))
        .otherwise(F.btrim(j, F.lit('"')))
    )
    return e.select("seq", long("position").alias("position"), path.alias("path_key"), value.alias("value"), "e.confidence", "e.derivation")


@query("contacts_and_phone_states", f"""WITH f AS (SELECT *, {P._address_ok} AS ok, {P.phone('phone')} AS digits FROM fx_candidate)
    SELECT id, {P.filled('contact_name')} AS meaningful_contact, length(digits) = 10 AS acceptable_phone, ok AS acceptable_address,
      CASE WHEN digits = '0000000000' THEN 'approved_exception' WHEN length(digits) = 10 THEN 'valid_phone' WHEN ok THEN 'exception_potentially_applicable' ELSE 'absent' END AS phone_state,
      employee_estimate IS NOT NULL AS site_band, {P.filled('company_band')} AS company_band, revenue IS NOT NULL AS revenue_band FROM f""")
def _(spark):
    p, m = F.col("physical_address"), F.col("mailing_address")
    return candidates(spark).select(
        "id", readiness.has_meaningful_contact(F.col("contacts")).alias("meaningful_contact"),
        readiness.acceptable_phone(F.col("phone")).alias("acceptable_phone"), readiness.acceptable_address(p, m).alias("acceptable_address"),
        readiness.phone_state(F.col("phone"), p, m).alias("phone_state"), readiness.has_band(F.col("employee_size_site")).alias("site_band"),
        readiness.has_band(F.col("employee_size_company_wide")).alias("company_band"),
        readiness.has_band(F.col("estimated_annual_revenue")).alias("revenue_band"),
    )


@query(
    "confidence_validity",
    f"SELECT o_orderpriority, count(*) FILTER (c BETWEEN 0 AND 1) AS valid, count(*) FILTER (NOT coalesce(c BETWEEN 0 AND 1, false)) AS refused FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice / {d(250000)} END AS c FROM orders) GROUP BY 1",
)
def _(spark):
    c = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice") / 250000.0)
    ok = evidence.valid_confidence(F.col("c"))
    return spark.table("orders").select("o_orderpriority", c.alias("c")).groupBy("o_orderpriority").agg(
        F.count_if(ok).alias("valid"), F.count_if(~ok).alias("refused")
    )


# -------------------------------------------------------------- directory checks

_CLEAN = "dir AS (SELECT seq, " + ", ".join(
    f"CASE WHEN lower({P.trim(c)}) NOT IN ('', 'null', 'none') THEN {P.trim(c)} END AS {c}"
    for c in ["location_id", "company_name", "status_code", "site_type_code", "address", "street", "city", "state", "zip", "phone", "website", "sic"]
) + " FROM fx_directory)"
_STATUS = f"""{_CLEAN}, marked AS (SELECT *, CASE WHEN location_id IS NULL OR company_name IS NULL OR status_code IS NULL THEN 'malformed'
  WHEN row_number() OVER (PARTITION BY location_id, location_id IS NULL OR company_name IS NULL OR status_code IS NULL ORDER BY seq) > 1 THEN 'duplicate' ELSE 'valid' END AS row_status FROM dir)"""


def _directory_rows(spark: SparkSession) -> DataFrame:
    return master.clean_records(spark.table("fx_directory"))


@query("directory_cleanup", f"WITH {_CLEAN} SELECT * FROM dir")
def _(spark):
    return _directory_rows(spark)


@query("directory_row_status", f"WITH {_STATUS} SELECT seq, location_id, row_status FROM marked")
def _(spark):
    return master.classify_records(_directory_rows(spark)).select("seq", "location_id", "row_status")


@query(
    "directory_repeated_ids",
    f"WITH {_STATUS}, g AS (SELECT location_id, count(*) - 1 AS extra FROM marked WHERE row_status <> 'malformed' GROUP BY 1) SELECT count(*) FILTER (extra > 0) AS repeated_keys, CAST(sum(extra) AS BIGINT) AS extra_rows FROM g",
)
def _(spark):
    rows = master.classify_records(_directory_rows(spark)).where("row_status <> 'malformed'")
    return profiling.repeated_keys(rows, "location_id")


@query(
    "directory_to_master",
    f"""WITH {_STATUS} SELECT location_id AS id, company_name, coalesce(address, street) AS address, city, state, zip AS postal_code, phone, website,
      sic AS sic_code, status_code AS status, coalesce({P.life_name('status_code')}, 'unknown') AS lifecycle_status FROM marked WHERE row_status = 'valid'""",
)
def _(spark):
    rows = master.classify_records(_directory_rows(spark)).where("row_status = 'valid'")
    return matching.snapshot_to_master(rows)


@query(
    "counts_by_code",
    "SELECT 'status' AS what, coalesce(status, '(missing)') AS value, count(*) AS n FROM fx_company GROUP BY 2 UNION ALL SELECT 'site type', coalesce(site_type_code, '(missing)'), count(*) FROM fx_company GROUP BY 2 UNION ALL SELECT 'relationship', relationship_type, count(*) FROM fx_edge GROUP BY 2",
)
def _(spark):
    def part(what, df, col):
        return profiling.count_by(df, col).select(F.lit(what).alias("what"), "value", "n")

    return part("status", directory(spark), "status").unionByName(part("site type", directory(spark), "site_type_code")).unionByName(
        part("relationship", edges(spark), "relationship_type")
    )


@query(
    "orphan_edges",
    "SELECT 'child' AS side, child_id AS location_id FROM fx_edge WHERE child_id NOT IN (SELECT id FROM fx_company) GROUP BY 2 UNION ALL SELECT 'parent', parent_id FROM fx_edge WHERE parent_id NOT IN (SELECT id FROM fx_company) GROUP BY 2",
)
def _(spark):
    known = directory(spark).select(F.col("id").alias("location_id"))
    both = [profiling.orphans(edges(spark), s, known).select(F.lit(s).alias("side"), "location_id") for s in ("child", "parent")]
    return both[0].unionByName(both[1])


@query(
    "expected_population",
    f"""SELECT 'records' AS what, count(*) AS row_count, CAST(241194 AS BIGINT) AS expected_count, abs(count(*) - 241194) / {d(241194)} > 0.2 AS deviates FROM fx_company
    UNION ALL SELECT 'edges', count(*), 57575, abs(count(*) - 57575) / {d(57575)} > 0.2 FROM fx_edge""",
)
def _(spark):
    a = profiling.population_check(directory(spark), profiling.EXPECTED_RECORDS).withColumn("what", F.lit("records"))
    b = profiling.population_check(edges(spark), profiling.EXPECTED_EDGES).withColumn("what", F.lit("edges"))
    return a.unionByName(b)


@query(
    "unseen_codes",
    "SELECT v AS value FROM (VALUES ('DIRE'), ('KEEP'), ('RSCH'), ('RDEL'), ('DELE')) t(v) WHERE v NOT IN (SELECT status FROM fx_company WHERE status IS NOT NULL) UNION ALL SELECT v FROM (VALUES ('AFFL'), ('HQTR')) t(v) WHERE v NOT IN (SELECT relationship_type FROM fx_edge)",
)
def _(spark):
    a = profiling.unseen_values(directory(spark), "status", profiling.EXPECTED_STATUSES)
    return a.unionByName(profiling.unseen_values(edges(spark), "relationship_type", profiling.EXPECTED_RELATIONSHIPS))


@query(
    "directory_report",
    f"""WITH {_STATUS}, good AS (SELECT * FROM marked WHERE row_status = 'valid')
    SELECT 'rows' AS section, row_status AS item, count(*) AS n FROM marked GROUP BY 2
    UNION ALL SELECT 'repeated ids', 'distinct', count(DISTINCT location_id) FROM marked WHERE row_status = 'duplicate'
    UNION ALL SELECT 'status', status_code, count(*) FROM good GROUP BY 2
    UNION ALL SELECT 'site type', coalesce(site_type_code, '(missing)'), count(*) FROM good GROUP BY 2
    UNION ALL SELECT 'relationship type', relationship_type, count(*) FROM fx_edge GROUP BY 2
    UNION ALL SELECT 'edges', 'total', count(*) FROM fx_edge UNION ALL SELECT 'edges', 'valid', count(*) FROM fx_edge
    UNION ALL SELECT 'missing child', 'distinct', count(DISTINCT child_id) FROM fx_edge WHERE child_id NOT IN (SELECT location_id FROM good)
    UNION ALL SELECT 'missing parent', 'distinct', count(DISTINCT parent_id) FROM fx_edge WHERE parent_id NOT IN (SELECT location_id FROM good)
    UNION ALL SELECT 'status not observed', v, 1 FROM (VALUES ('DIRE'), ('KEEP'), ('RSCH'), ('RDEL'), ('DELE')) t(v) WHERE v NOT IN (SELECT status_code FROM good)
    UNION ALL SELECT 'relationship not observed', v, 1 FROM (VALUES ('AFFL'), ('HQTR')) t(v) WHERE v NOT IN (SELECT relationship_type FROM fx_edge)
    UNION ALL SELECT 'record count deviates', 'yes/no', CAST(abs(count(*) - 241194) / 241194.0 > 0.2 AS INT) FROM good
    UNION ALL SELECT 'edge count deviates', 'yes/no', CAST(abs(count(*) - 57575) / 57575.0 > 0.2 AS INT) FROM fx_edge""",
)
def _(spark):
    return profiling.directory_report(_directory_rows(spark), edges(spark))


@query(
    "parents_and_children",
    "SELECT 'parent' AS kind, child_id AS id, arg_min(parent_id, edge_seq) AS other, CAST(NULL AS BIGINT) AS edge_seq FROM fx_edge GROUP BY 2 UNION ALL SELECT 'child', parent_id, child_id, min(edge_seq) FROM fx_edge GROUP BY 2, 3",
)
def _(spark):
    p = matching.first_parents(edges(spark)).select(
        F.lit("parent").alias("kind"), F.col("child_id").alias("id"), F.col("parent_id").alias("other"), F.lit(None).cast("bigint").alias("edge_seq")
    )
    c = matching.child_edges(edges(spark)).select(F.lit("child").alias("kind"), F.col("parent_id").alias("id"), F.col("child_id").alias("other"), "edge_seq")
    return p.unionByName(c)


@query(
    "referential_integrity",
    "SELECT 'base' AS link, base_id AS missing_key FROM fx_candidate WHERE base_id NOT IN (SELECT id FROM fx_company) GROUP BY 2 UNION ALL SELECT 'decision', candidate_id FROM fx_decision WHERE candidate_id NOT IN (SELECT id FROM fx_candidate) GROUP BY 2 UNION ALL SELECT 'label', CAST(doc_id AS STRING) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 2",
)
def _(spark):
    c = spark.table("fx_candidate")
    parts = [
        ("base", tables.missing_references(c, "base_id", directory(spark).select("id"), "id")),
        ("decision", tables.missing_references(spark.table("fx_decision"), "candidate_id", c.select("id"), "id")),
        ("label", tables.missing_references(spark.table("documents"), "doc_id", spark.table("labels").select("doc_id"), "doc_id")),
    ]
    out = [df.select(F.lit(n).alias("link"), F.col("missing_key").cast("string").alias("missing_key")) for n, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


# ----------------------------------------------------------------------- permits


@query("permit_window_page", f"SELECT taxpayer_number, outlet_number, outlet_county_code, tie_key, tie_price FROM fx_permit WHERE {_IN_WINDOW} ORDER BY {_PERMIT_ORDER} LIMIT 1000 OFFSET 500")
def _(spark):
    rows = permits.page(permits.in_window(spark.table("fx_permit"), WINDOW, COUNTIES), 1000, 500, TIES)
    return rows.select("taxpayer_number", "outlet_number", "outlet_county_code", *TIES)


@query("permit_unique", f"WITH {_UNIQUE} SELECT source_record_id, tie_key, tie_price, outlet_name FROM uniq")
def _(spark):
    return permits.unique_observations(spark.table("fx_permit"), TIES).select("source_record_id", *TIES, "outlet_name")


@query(
    "permit_pull",
    f"""WITH w AS (SELECT *, {_RECORD_ID} AS source_record_id FROM fx_permit WHERE {_IN_WINDOW}),
    u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_record_id ORDER BY {_PERMIT_ORDER}) AS rn FROM w WHERE source_record_id IS NOT NULL) WHERE rn = 1)
    SELECT source_record_id, tie_key, tie_price, '1995-01-01' AS query_window_start, '2001-12-31' AS query_window_end, '043|057|061|220' AS requested_counties
    FROM u ORDER BY {_PERMIT_ORDER} LIMIT 500""",
)
def _(spark):
    rows = permits.pull(spark.table("fx_permit"), WINDOW, COUNTIES, 500, TIES)
    return rows.select("source_record_id", *TIES, "query_window_start", "query_window_end", joined("requested_counties").alias("requested_counties"))


@query(
    "permit_pull_counts",
    f"""WITH w AS (SELECT {_RECORD_ID} AS id FROM fx_permit WHERE {_IN_WINDOW})
    SELECT count(*) AS raw_count, count(*) FILTER (id IS NULL) AS malformed_count, count(DISTINCT id) AS unique_count, count(id) - count(DISTINCT id) AS duplicate_count FROM w""",
)
def _(spark):
    return permits.pull_counts(spark.table("fx_permit"), WINDOW, COUNTIES)


@query(
    "profile_job",
    f"""WITH w AS (SELECT {_RECORD_ID} AS id FROM fx_permit WHERE {_IN_WINDOW}), n AS (SELECT count(DISTINCT id) AS n FROM w)
    SELECT 'raw' AS artifact, least(n, 500) AS row_count, CAST(n > 500 AS VARCHAR) AS truncated FROM n
    UNION ALL SELECT 'profile', 1, CAST(n > 500 AS VARCHAR) FROM n UNION ALL SELECT 'pull-counts', 1, CAST(n > 500 AS VARCHAR) FROM n""",
)
def _(spark):
    # The artifacts whose size does not depend on which of the equally ordered permits are pulled.
    manifest = profile_source(spark.table("fx_permit"), WINDOW, COUNTIES, _scratch(spark, "profile"), "2024-02-01", 500)
    sizes = manifest.where(F.col("artifact").isin("raw", "profile", "pull-counts"))
    return sizes.select("artifact", "row_count", F.get_json_object("facts", "$.truncated").alias("truncated"))


_DIFF = f"coalesce({P.field('taxpayer_name')} IS NOT NULL AND {P.field('outlet_name')} IS NOT NULL AND {P.name(P.field('taxpayer_name'))} <> {P.name(P.field('outlet_name'))}, false)"
_BOX = r"coalesce(regexp_matches(outlet_address, '\bP\.?\s*O\.?\s*BOX\b', 'i'), false)"
_RES = r"coalesce(regexp_matches(outlet_address, '\b(apt|apartment|unit|trlr|trailer|mobile\s*home)\b|#\s*\d+\s*$', 'i'), false)"


@query(
    "permit_profile",
    f"""WITH o AS (SELECT *, {_RECORD_ID} AS source_record_id, {P.field('taxpayer_number')} AS tp, upper({P.field('outlet_inside_outside_city_limits_indicator')}) AS l FROM fx_permit),
    t AS (SELECT tp, count(*) AS n FROM o WHERE tp IS NOT NULL GROUP BY 1)
    SELECT count(*) AS total_observations, count(DISTINCT source_record_id) AS unique_record_ids, count(*) - count(DISTINCT source_record_id) AS duplicate_record_ids,
      (SELECT count(*) FROM t) AS unique_taxpayers, (SELECT count(*) FROM t WHERE n > 1) AS taxpayers_with_multiple_outlets,
      count(*) FILTER ({P.field('outlet_name')} IS NULL) AS missing_outlet_name, count(*) FILTER ({P.field('outlet_address')} IS NULL) AS missing_outlet_address,
      count(*) FILTER ({P.field('outlet_city')} IS NULL) AS missing_outlet_city, count(*) FILTER ({P.field('outlet_zip_code')} IS NULL) AS missing_outlet_zip,
      count(*) FILTER ({P.field('outlet_naics_code')} IS NULL) AS missing_outlet_naics, count(*) FILTER (outlet_permit_issue_date IS NULL) AS missing_permit_issue_date,
      count(*) FILTER (outlet_first_sales_date IS NULL) AS missing_first_sales_date, count(*) FILTER ({_DIFF}) AS name_differs, count(*) FILTER ({_BOX}) AS po_box_like,
      count(*) FILTER ({_RES}) AS residential_risk, count(*) FILTER (coalesce(l LIKE 'I%', false)) AS inside_city_limits, count(*) FILTER (coalesce(l LIKE 'O%', false)) AS outside_city_limits,
      count(*) FILTER (NOT coalesce(l LIKE 'I%' OR l LIKE 'O%', false)) AS unknown_city_limits FROM o""",
)
def _(spark):
    return profiling.permit_profile(observed(spark))


_DIST = f"""dist AS (WITH v AS (SELECT *, {P.field('outlet_naics_code')} AS c FROM fx_permit)
  SELECT 'county' AS dimension, coalesce({P.field('outlet_county_code')}, '(missing)') AS bucket, count(*) AS n FROM v GROUP BY 2
  UNION ALL SELECT 'organization_type', coalesce({P.field('taxpayer_organization_type')}, '(missing)'), count(*) FROM v GROUP BY 2
  UNION ALL SELECT 'naics2', CASE WHEN c IS NULL THEN '(missing)' WHEN length(c) >= 2 THEN left(c, 2) ELSE '(short)' END, count(*) FROM v GROUP BY 2
  UNION ALL SELECT 'naics3', CASE WHEN c IS NULL THEN '(missing)' WHEN length(c) >= 3 THEN left(c, 3) ELSE '(short)' END, count(*) FROM v GROUP BY 2)"""


@query("permit_distributions", f"WITH {_DIST} SELECT * FROM dist")
def _(spark):
    return profiling.distributions(spark.table("fx_permit"))


@query(
    "permit_top_buckets",
    f"""WITH {_DIST}, r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, bucket) AS position, count(*) OVER (PARTITION BY dimension) AS k,
      CASE dimension WHEN 'naics3' THEN 15 ELSE 12 END AS top FROM dist)
    SELECT dimension, position, bucket, n, greatest(k - top, 0) AS more FROM r WHERE position <= top""",
)
def _(spark):
    return profiling.top_buckets(profiling.distributions(spark.table("fx_permit"))).withColumns({"position": long("position"), "more": long("more")})


_STRATUM = f"""strata AS (WITH m AS (SELECT {P.field('taxpayer_number')} AS tp, count(*) > 1 AS multi FROM uniq GROUP BY 1)
  SELECT u.source_record_id, 'org:' || coalesce({P.field('taxpayer_organization_type')}, 'unknown_org_type')
    || '|naics:' || CASE WHEN length({P.field('outlet_naics_code')}) >= 2 THEN left({P.field('outlet_naics_code')}, 2) ELSE 'unknown_naics' END
    || '|multi:' || coalesce(m.multi, false)::STRING || '|fsd:' || (outlet_first_sales_date IS NOT NULL)::STRING || '|namediff:' || ({_DIFF})::STRING
    || '|risk:' || ({_BOX} OR {_RES})::STRING || '|county:' || coalesce({P.field('outlet_county_code')}, 'unknown_county') AS stratum
  FROM uniq u LEFT JOIN m ON m.tp = {P.field('u.taxpayer_number')})"""


@query("sample_strata", f"WITH {_UNIQUE}, {_STRATUM} SELECT * FROM strata")
def _(spark):
    rows = permits.unique_observations(spark.table("fx_permit"), TIES)
    return profiling.with_stratum(rows).select("source_record_id", "stratum")


@query(
    "pilot_sample",
    f"""WITH {_UNIQUE}, {_STRATUM}, sized AS (SELECT least(100, count(*)) AS n, CAST(floor(least(100, count(*)) * {d(0.7)} + {d(0.5)}) AS BIGINT) AS pn FROM strata),
    r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY sha256('1:' || source_record_id), source_record_id) AS k FROM strata),
    o AS (SELECT *, row_number() OVER (ORDER BY k, stratum) AS pos FROM r), p AS (SELECT * FROM o WHERE pos <= (SELECT pn FROM sized)),
    c AS (SELECT *, row_number() OVER (ORDER BY sha256('2:' || source_record_id), source_record_id) AS cpos FROM strata WHERE source_record_id NOT IN (SELECT source_record_id FROM p))
    SELECT source_record_id, stratum, 'priority_stratified' AS selection FROM p UNION ALL
    SELECT source_record_id, stratum, 'random_control' FROM c WHERE cpos <= (SELECT n - pn FROM sized)""",
)
def _(spark):
    return profiling.pilot_sample(permits.unique_observations(spark.table("fx_permit"), TIES))


# ---------------------------------------------------------------------- matching

_RANKED_COLUMNS = ["candidate_id", "master_id", "rank", "score", "name_score", "address_score", "phone_match", "domain_match",
                   "sic_match", "city_state_match", "classification"]
_RANKED_SQL = "candidate_id, master_id, rnk AS rank, score, name_score, address_score, phone_match, domain_match, sic_match, city_state_match, classification"


def _ranked_out(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", long("rank")).select(*_RANKED_COLUMNS, joined(matching.match_reasons()).alias("reasons"))


def _retrieved(spark: SparkSession) -> DataFrame:
    return matching.rank_retrieved(candidates(spark), directory(spark), edges(spark), "k")


@query("retrieval_exact_keys", f"WITH {P.KEYS}, {P.HITS_EXACT}, c AS (SELECT *, row_number() OVER (PARTITION BY candidate_id, signal ORDER BY pos) AS n FROM exact_hits) SELECT candidate_id, master_id, signal, pos FROM c WHERE n <= 25")
def _(spark):
    ck, mk = matching.candidate_keys(candidates(spark)), matching.master_keys(directory(spark), "k")
    return matching.exact_key_hits(ck, mk).select("candidate_id", "master_id", "signal", "pos")


@query("retrieval_similar_keys", f"WITH {P.KEYS}, {P.HITS_SIMILAR}, c AS (SELECT *, row_number() OVER (PARTITION BY candidate_id, signal ORDER BY pos) AS n FROM similar_hits) SELECT candidate_id, master_id, signal, pos FROM c WHERE n <= 25")
def _(spark):
    ck, mk = matching.candidate_keys(candidates(spark)), matching.master_keys(directory(spark), "k")
    return matching.similar_key_hits(ck, mk).select("candidate_id", "master_id", "signal", "pos")


@query("retrieval_bounded_set", f"WITH {P.KEYS}, {P.HITS_EXACT}, {P.HITS_SIMILAR}, {P.FIRST_HITS} SELECT candidate_id, master_id, slot FROM hits")
def _(spark):
    ck, mk = matching.candidate_keys(candidates(spark)), matching.master_keys(directory(spark), "k")
    return matching.retrieve(ck, mk).select("candidate_id", "master_id", long("slot").alias("slot"))


@query(
    "retrieval_truncated",
    f"""WITH {P.KEYS}, {P.HITS_EXACT}, {P.HITS_SIMILAR}, {P.FIRST_HITS}, {P.EXPANDED} SELECT candidate_id, count(*) > 25 AS truncated FROM first_steps WHERE n = 1 GROUP BY 1""",
)
def _(spark):
    ck, mk = matching.candidate_keys(candidates(spark)), matching.master_keys(directory(spark), "k")
    return matching.retrieve(ck, mk, edges(spark)).groupBy("candidate_id").agg(F.bool_or("truncated").alias("truncated"))


@query("retrieval_with_relationships", f"WITH {P.KEYS}, {P.HITS_EXACT}, {P.HITS_SIMILAR}, {P.FIRST_HITS}, {P.EXPANDED} SELECT candidate_id, master_id, slot FROM retrieved")
def _(spark):
    ck, mk = matching.candidate_keys(candidates(spark)), matching.master_keys(directory(spark), "k")
    return matching.retrieve(ck, mk, edges(spark)).select("candidate_id", "master_id", long("slot").alias("slot"))


@query("retrieved_ranking", f"WITH {P.RETRIEVAL} SELECT {_RANKED_SQL}, {P.REASONS} AS reasons FROM ranked")
def _(spark):
    return _ranked_out(_retrieved(spark))


@query("exhaustive_top3", f"WITH {P.EXHAUSTIVE} SELECT {_RANKED_SQL}, {P.REASONS} AS reasons FROM ranked WHERE rnk <= 3")
def _(spark):
    return _ranked_out(matching.rank_all(candidates(spark), directory(spark), 3))


@query(
    "best_match",
    f"""WITH {P.RETRIEVAL} SELECT c.id AS candidate_id, r.master_id AS best_id, coalesce(score, {d(0)}) AS match_score,
      coalesce(classification, 'likely_new') AS match_classification, CASE WHEN r.master_id IS NULL THEN 'no comparison records available' ELSE {P.REASONS} END AS match_reasons
    FROM fx_candidate c LEFT JOIN ranked r ON r.candidate_id = c.id AND r.rnk = 1""",
)
def _(spark):
    found = policy.collect_matches(_retrieved(spark), with_related=False)
    rows = spark.table("fx_candidate").select(F.col("id").alias("candidate_id")).join(found, "candidate_id", "left")
    return rows.withColumns(policy.best_match_columns()).select("candidate_id", "best_id", "match_score", "match_classification", joined("match_reasons").alias("match_reasons"))


@query(
    "best_match_all",
    f"""WITH {P.EXHAUSTIVE} SELECT c.id AS candidate_id, a.master_id AS best_id, coalesce(a.score, {d(0)}) AS match_score,
      coalesce(a.classification, 'likely_new') AS match_classification, a.score - b.score AS margin, b.master_id AS second_id
    FROM fx_candidate c LEFT JOIN ranked a ON a.candidate_id = c.id AND a.rnk = 1 LEFT JOIN ranked b ON b.candidate_id = c.id AND b.rnk = 2""",
)
def _(spark):
    found = policy.collect_matches(matching.rank_all(candidates(spark), directory(spark), 3), with_related=False)
    rows = spark.table("fx_candidate").select(F.col("id").alias("candidate_id")).join(found, "candidate_id", "left")
    m = lambda i: F.get("matches", F.lit(i))
    return rows.withColumns(policy.best_match_columns()).select(
        "candidate_id", "best_id", "match_score", "match_classification", (m(0)["score"] - m(1)["score"]).alias("margin"), m(1)["master_id"].alias("second_id"))


@query(
    "runner_up_margin",
    f"""WITH {P.RETRIEVAL} SELECT a.candidate_id, a.score - b.score AS margin, b.master_id AS second_id, c.master_id AS third_id
    FROM ranked a LEFT JOIN ranked b ON b.candidate_id = a.candidate_id AND b.rnk = 2 LEFT JOIN ranked c ON c.candidate_id = a.candidate_id AND c.rnk = 3 WHERE a.rnk = 1""",
)
def _(spark):
    m = lambda i: F.get("matches", F.lit(i))
    return policy.collect_matches(_retrieved(spark), with_related=False).select(
        "candidate_id", (m(0)["score"] - m(1)["score"]).alias("margin"), m(1)["master_id"].alias("second_id"), m(2)["master_id"].alias("third_id")
    )


_DECISION_SQL = "candidate_id, outcome, decision_confidence, matched_id, requires_human_review, reasons, conflicts"


def _decision_out(df: DataFrame) -> DataFrame:
    return df.select("candidate_id", "outcome", "decision_confidence", "matched_id", "requires_human_review",
                     joined("reasons").alias("reasons"), joined("conflicts").alias("conflicts"))


@query("outcome_policy", f"WITH {P.RETRIEVAL}, {P.DECIDED} SELECT {_DECISION_SQL} FROM decided")
def _(spark):
    return _decision_out(policy.resolve_retrieved(candidates(spark), directory(spark), edges(spark), "k"))


@query("outcome_policy_exhaustive", f"WITH {P.EXHAUSTIVE}, {P.DECIDED} SELECT {_DECISION_SQL} FROM decided")
def _(spark):
    return _decision_out(policy.resolve_all(candidates(spark), directory(spark)))


@query(
    "related_records",
    f"WITH {P.EXHAUSTIVE}, {P.DECIDED} SELECT r.candidate_id, r.master_id AS related_id FROM ranked r JOIN decided d USING (candidate_id) WHERE d.b IN (3, 4) AND r.strong_company AND r.master_id <> d.matched_id",
)
def _(spark):
    c, m = candidates(spark), directory(spark)
    return policy.related_records(policy.resolve_all(c, m), c, m)


@query("company_site_counts", f"WITH {P.EXHAUSTIVE} SELECT candidate_id, count(*) AS n_sites FROM ranked WHERE strong_company GROUP BY 1")
def _(spark):
    return matching.company_links(candidates(spark), directory(spark)).counts()


@query(
    "company_chain",
    f"""WITH {P.EXHAUSTIVE}, s AS (SELECT candidate_id, master_id FROM ranked WHERE strong_company),
    top AS (SELECT candidate_id FROM s GROUP BY 1 ORDER BY count(*) DESC, candidate_id LIMIT 1) SELECT candidate_id, master_id FROM s WHERE candidate_id IN (SELECT candidate_id FROM top)""",
)
def _(spark):
    # The candidate with the most sites, ties by id: its rows only are expanded.
    found = matching.company_links(candidates(spark), directory(spark))
    return found.pairs(found.counts().orderBy(F.desc("n_sites"), "candidate_id").limit(1))


@query(
    "related_records_retrieved",
    f"WITH {P.RETRIEVAL}, {P.DECIDED} SELECT r.candidate_id, string_agg(r.master_id, '|' ORDER BY rnk) AS related_ids FROM ranked r JOIN decided d USING (candidate_id) WHERE d.b IN (3, 4) AND r.strong_company AND r.master_id <> d.matched_id GROUP BY 1",
)
def _(spark):
    r = policy.resolve_retrieved(candidates(spark), directory(spark), edges(spark), "k")
    return r.where("related_ids IS NOT NULL").select("candidate_id", joined("related_ids").alias("related_ids"))


@query(
    "lifecycle_conflicts",
    f"WITH {P.RETRIEVAL}, {P.DECIDED} SELECT outcome, conflicts, requires_human_review, count(*) AS n FROM decided GROUP BY ALL",
)
def _(spark):
    r = _decision_out(policy.resolve_retrieved(candidates(spark), directory(spark), edges(spark), "k"))
    return r.groupBy("outcome", "conflicts", "requires_human_review").agg(F.count("*").alias("n"))


# ----------------------------------------------------- scores, readiness, queue


@query("research_completeness", f"WITH {P.COMPLETENESS} SELECT candidate_id, completeness_score, present_fields, missing_fields FROM completeness")
def _(spark):
    return readiness.with_completeness(candidates(spark)).select(
        F.col("id").alias("candidate_id"), "completeness_score", joined("present_fields").alias("present_fields"), joined("missing_fields").alias("missing_fields")
    )


@query("publication_readiness", f"WITH {P.READINESS} SELECT candidate_id, publication_state, publication_state = 'confirmed_ready' AS publication_ready, blockers, unresolved, satisfied, optional_missing FROM readiness")
def _(spark):
    return readiness.with_readiness(candidates(spark)).select(
        F.col("id").alias("candidate_id"), "publication_state", "publication_ready", joined("blockers.rule_id").alias("blockers"),
        joined("unresolved_rules.rule_id").alias("unresolved"), joined("satisfied_requirements.rule_id").alias("satisfied"),
        joined("optional_missing_fields").alias("optional_missing"),
    )


def _scored(spark: SparkSession) -> DataFrame:
    return score_candidates(candidates(spark), directory(spark), edges(spark), "k", mode="retrieved")


def _scored_all(spark: SparkSession) -> DataFrame:
    return score_candidates(candidates(spark), directory(spark), mode="all")


_QUEUE_COLUMNS = ["candidate_id", "best_id", "match_score", "match_classification", "match_reasons", "resolution_outcome", "resolution_confidence",
                  "resolution_reasons", "resolution_conflicts", "matched_id", "requires_human_review", "completeness_score", "publication_state",
                  "blockers", "review_priority"]


@query("review_queue", f"WITH {P.QUEUE} SELECT {', '.join(_QUEUE_COLUMNS)} FROM queue")
def review_queue_query(spark):
    q = _scored(spark)
    return q.withColumns(
        {**{c: joined(c) for c in ("match_reasons", "resolution_reasons", "resolution_conflicts")}, "blockers": joined("blockers.rule_id")}
    ).select(_QUEUE_COLUMNS)


@query("review_queue_all", f"WITH {P.QUEUE_ALL} SELECT {', '.join(_QUEUE_COLUMNS)} FROM queue")
def _(spark):
    q = _scored_all(spark)
    return q.withColumns(
        {**{c: joined(c) for c in ("match_reasons", "resolution_reasons", "resolution_conflicts")}, "blockers": joined("blockers.rule_id")}
    ).select(_QUEUE_COLUMNS)


@query("review_priority", f"WITH {P.QUEUE} SELECT candidate_id, review_priority FROM queue")
def _(spark):
    return _scored(spark).select("candidate_id", "review_priority")


@query("queue_order", f"WITH {P.QUEUE} SELECT candidate_id, row_number() OVER (ORDER BY review_priority DESC, match_score DESC, candidate_id) AS position FROM queue")
def _(spark):
    return tables.queue_positions(_scored(spark).select("candidate_id", "review_priority", "match_score"))


@query(
    "queue_view",
    f"""WITH {P.QUEUE} SELECT q.candidate_id, coalesce(c.legal_name, '(unknown)') AS company_name, coalesce(c.site_type, '-') AS site_type, c.city, c.state,
      resolution_outcome, coalesce(m.company_name, '-') AS matched_existing, CASE WHEN requires_human_review THEN 'yes' ELSE 'no' END AS needs_extra_review,
      match_classification, publication_state, 'pending' AS review_status
    FROM queue q LEFT JOIN fx_candidate c ON c.id = q.candidate_id LEFT JOIN fx_company m ON m.id = q.matched_id""",
)
def _(spark):
    q = _scored(spark).withColumn("review_status", F.lit("pending"))
    return tables.queue_view(q, candidates(spark), directory(spark)).drop("match_score", "completeness_score", "review_priority")


@query("review_priority_all", f"WITH {P.QUEUE_ALL} SELECT candidate_id, review_priority FROM queue")
def _(spark):
    return _scored_all(spark).select("candidate_id", "review_priority")


@query("queue_order_all", f"WITH {P.QUEUE_ALL} SELECT candidate_id, row_number() OVER (ORDER BY review_priority DESC, match_score DESC, candidate_id) AS position FROM queue")
def _(spark):
    return tables.queue_positions(_scored_all(spark).select("candidate_id", "review_priority", "match_score"))


@query(
    "queue_view_all",
    f"""WITH {P.QUEUE_ALL} SELECT q.candidate_id, coalesce(c.legal_name, '(unknown)') AS company_name, coalesce(c.site_type, '-') AS site_type, c.city, c.state,
      resolution_outcome, coalesce(m.company_name, '-') AS matched_existing, CASE WHEN requires_human_review THEN 'yes' ELSE 'no' END AS needs_extra_review,
      match_classification, publication_state, 'pending' AS review_status
    FROM queue q LEFT JOIN fx_candidate c ON c.id = q.candidate_id LEFT JOIN fx_company m ON m.id = q.matched_id""",
)
def _(spark):
    q = _scored_all(spark).withColumn("review_status", F.lit("pending"))
    return tables.queue_view(q, candidates(spark), directory(spark)).drop("match_score", "completeness_score", "review_priority")


# A queue snapshot of an earlier run, one row per customer with an order, some already reviewed.
VIEWS["fx_old_queue"] = """
SELECT 'loc-' || lpad(CAST(o_custkey AS STRING), 7, '0') AS candidate_id, CAST(max(o_totalprice) AS DOUBLE) AS match_score,
  CASE WHEN o_custkey % 3 = 0 THEN 'approved' WHEN o_custkey % 3 = 1 THEN 'pending' ELSE 'duplicate' END AS review_status,
  CASE WHEN o_custkey % 3 = 0 THEN 'note ' || CAST(o_custkey AS STRING) ELSE NULL END AS reviewer_note,
  CAST(min(o_orderdate) AS STRING) AS created_at
FROM orders GROUP BY o_custkey
"""


@query(
    "queue_upsert",
    f"""WITH {P.COMPLETENESS}, n AS (SELECT candidate_id, completeness_score AS match_score FROM completeness)
    SELECT coalesce(n.candidate_id, p.candidate_id) AS candidate_id, CASE WHEN n.candidate_id IS NOT NULL THEN n.match_score ELSE p.match_score END AS match_score,
      coalesce(p.review_status, 'pending') AS review_status, p.reviewer_note, coalesce(p.created_at, 'now') AS created_at
    FROM n FULL OUTER JOIN fx_old_queue p ON p.candidate_id = n.candidate_id""",
)
def _(spark):
    new = readiness.with_completeness(candidates(spark)).select(F.col("id").alias("candidate_id"), F.col("completeness_score").alias("match_score"))
    return tables.upsert_queue(spark.table("fx_old_queue"), new, "now")


@query(
    "replace_by_key",
    """SELECT user_id, event_type, value, batch FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY batch DESC) AS n
      FROM (SELECT user_id, event_type, value, event_id AS batch FROM events)) WHERE n = 1""",
)
def _(spark):
    rows = spark.table("events").select("user_id", "event_type", "value", F.col("event_id").alias("batch"))
    cut = F.col("batch") < F.lit(5000)
    return tables.replace_by_key(rows.where(cut), rows.where(~cut), ["user_id", "event_type"], "batch")


@query(
    "master_reads",
    f"SELECT id, nullif(phone, '') AS phone, nullif(status, '') AS status, coalesce({P.life_name('status')}, 'unknown') AS lifecycle_status FROM fx_company",
)
def _(spark):
    return tables.read_master(directory(spark)).select("id", "phone", "status", "lifecycle_status")


@query(
    "keyed_reads",
    """SELECT 'queue' AS read, candidate_id AS id, CAST(count(*) AS BIGINT) AS n FROM fx_old_queue WHERE candidate_id IN (SELECT candidate_id FROM fx_decision) GROUP BY ALL
    UNION ALL SELECT 'candidate', 'company-' || id, 1 FROM fx_candidate WHERE id IN (SELECT candidate_id FROM fx_decision)
    UNION ALL SELECT 'identity', 'company-' || id, 1 FROM fx_candidate""",
)
def _(spark):
    decided = spark.table("fx_decision").select("candidate_id")
    owned = candidates(spark).withColumn("company", F.col("company").withField("id", F.concat(F.lit("company-"), "id")))
    counted = lambda df, what, key: df.groupBy(F.lit(what).alias("read"), F.col(key).alias("id")).agg(F.count("*").alias("n"))
    companies = decided.select(F.concat(F.lit("company-"), "candidate_id").alias("company_id"))
    return (
        counted(tables.queue_rows(spark.table("fx_old_queue"), decided), "queue", "candidate_id")
        .unionByName(counted(tables.candidates_of_companies(owned, companies), "candidate", "company.id"))
        .unionByName(counted(tables.identities(owned), "identity", "id"))
    )


# ------------------------------------------------------------------ review ledger

_ACTION_STATUS = """CASE WHEN action IN ('approve_new_company', 'approve_new_branch', 'link_existing_location') THEN 'approved' WHEN action = 'mark_duplicate' THEN 'duplicate'
  WHEN action = 'needs_more_research' THEN 'needs_more_research' WHEN action = 'reject_source_observation' THEN 'rejected' END"""
_CHECKED = f"""checked AS (SELECT *, {_ACTION_STATUS} AS new_status, CASE WHEN {_ACTION_STATUS} IS NULL THEN 'unknown action'
    WHEN action = 'approve_new_company' AND {P.filled('selected_id')} THEN 'record id not allowed'
    WHEN action IN ('approve_new_branch', 'link_existing_location', 'mark_duplicate') AND NOT {P.filled('selected_id')} THEN 'record id required'
    WHEN candidate_id NOT IN (SELECT id FROM fx_candidate) THEN 'no review queue row' END AS reject_reason FROM fx_decision),
  chained AS (SELECT *, row_number() OVER w AS sequence, lag(new_status, 1, 'pending') OVER w AS previous_status FROM checked
    WHERE reject_reason IS NULL WINDOW w AS (PARTITION BY candidate_id ORDER BY decided_at, event_id))"""
_ORDER = ["decided_at", "event_id"]


def _queued(spark: SparkSession) -> DataFrame:
    return spark.table("fx_candidate").select(F.col("id").alias("candidate_id"))


def _checked(spark: SparkSession) -> DataFrame:
    return review.validate_decisions(spark.table("fx_decision"), _queued(spark))


def _chained(spark: SparkSession) -> DataFrame:
    return review.chain(_checked(spark).where("reject_reason IS NULL"), _ORDER, F.to_date("decided_at"))


@query("action_statuses", f"SELECT action, {_ACTION_STATUS} AS new_status, count(*) AS n FROM fx_decision GROUP BY ALL")
def _(spark):
    return spark.table("fx_decision").groupBy("action", codes.status_for_action(F.col("action")).alias("new_status")).agg(F.count("*").alias("n"))


@query("decision_validation", f"WITH {_CHECKED} SELECT event_id, action, reject_reason FROM checked")
def _(spark):
    return _checked(spark).select("event_id", "action", "reject_reason")


@query("decision_chain", f"WITH {_CHECKED} SELECT event_id, candidate_id, sequence, previous_status, new_status FROM chained")
def _(spark):
    return _chained(spark).select("event_id", "candidate_id", long("sequence").alias("sequence"), "previous_status", "new_status")


@query("latest_decision", f"WITH {_CHECKED} SELECT candidate_id, max(sequence) AS sequence, arg_max(action, sequence) AS action, arg_max(new_status, sequence) AS new_status FROM chained GROUP BY 1")
def _(spark):
    ledger = _chained(spark).withColumn("notes", F.lit(None).cast("string"))
    return review.latest_decisions(ledger).select("candidate_id", long("sequence").alias("sequence"), "action", "new_status")


@query(
    "ledger_invariant",
    f"""WITH {_CHECKED}, l AS (SELECT candidate_id, arg_max(new_status, sequence) AS s FROM chained GROUP BY 1)
    SELECT q.candidate_id, review_status, coalesce(l.s, 'pending') AS ledger_status FROM fx_old_queue q LEFT JOIN l ON l.candidate_id = q.candidate_id
    WHERE review_status <> coalesce(l.s, 'pending')""",
)
def _(spark):
    ledger = _chained(spark).withColumn("notes", F.lit(None).cast("string"))
    return review.status_mismatches(spark.table("fx_old_queue"), ledger)


@query(
    "decision_snapshot",
    f"""WITH {P.QUEUE}, {_CHECKED} SELECT event_id, c.candidate_id, sequence, coalesce(matched_id, best_id) AS machine_selected_id, resolution_outcome, match_score, publication_state, blockers, review_priority
    FROM chained c JOIN queue q ON q.candidate_id = c.candidate_id""",
)
def _(spark):
    rows, _rejected = review.record(spark.table("fx_decision"), _scored(spark), _ORDER, F.to_date("decided_at"))
    m = F.col("machine_recommendation")
    return rows.select(
        "event_id", "candidate_id", long("sequence").alias("sequence"), m["machine_selected_id"].alias("machine_selected_id"), m["resolution_outcome"].alias("resolution_outcome"),
        m["match_score"].alias("match_score"), m["publication_state"].alias("publication_state"), joined(m["blocker_rule_ids"]).alias("blockers"), m["review_priority"].alias("review_priority"),
    )


@query(
    "queue_after_review",
    f"""WITH {_CHECKED}, l AS (SELECT candidate_id, arg_max(new_status, sequence) AS s, arg_max('by ' || reviewer, sequence) AS n FROM chained GROUP BY 1)
    SELECT q.candidate_id, coalesce(l.s, review_status) AS review_status, CASE WHEN l.candidate_id IS NOT NULL THEN l.n ELSE reviewer_note END AS reviewer_note
    FROM fx_old_queue q LEFT JOIN l ON l.candidate_id = q.candidate_id""",
)
def _(spark):
    appended = _chained(spark).withColumn("notes", F.concat(F.lit("by "), "reviewer"))
    return review.queue_after(spark.table("fx_old_queue"), appended).select("candidate_id", "review_status", "reviewer_note")


# ---------------------------------------------------------------------- evidence


def _ingested(spark: SparkSession) -> DataFrame:
    empty = spark.createDataFrame([], "source_id string, fingerprint string")
    return ingest_plan.ingest(drafts(spark), empty, "run-1", "2024-02-01T00:00:00.000Z").candidates


_FIRST_SQL = f"""{_DRAFT_SQL}, firsts AS (SELECT *, 'loc-' || left(sha256(source_id || '|' || fingerprint), 32) AS id FROM (SELECT *,
  row_number() OVER (PARTITION BY source_id, fingerprint ORDER BY seq) AS rn FROM dr WHERE reject_reason IS NULL) WHERE rn = 1)"""


@query(
    "field_evidence_summary",
    f"""WITH {_FIRST_SQL}, f AS (SELECT id, 'company.legalName' AS field_key, true AS has_value, true AS seen FROM firsts
      UNION ALL SELECT id, 'company.website', {P.filled('website')}, {P.truthy('website')} FROM firsts
      UNION ALL SELECT id, 'company.sicCode', false, false FROM firsts UNION ALL SELECT id, 'company.alphasort', false, false FROM firsts
      UNION ALL SELECT id, 'company.startYear', false, false FROM firsts
      UNION ALL SELECT id, 'location.physicalAddress', {P.filled('address')} OR {P.filled('city')}, true FROM firsts
      UNION ALL SELECT id, 'location.phone', {P.filled('phone')}, {P.truthy('phone')} FROM firsts
      UNION ALL SELECT id, 'location.siteType', {P.truthy('site_type_code')}, {P.truthy('site_type_code')} FROM firsts
      UNION ALL SELECT id, 'location.employeeSizeSite', {_EMPLOYEES} IS NOT NULL, {_EMPLOYEES} IS NOT NULL FROM firsts)
    SELECT id AS candidate_id, field_key, has_value, CASE WHEN seen THEN 1 ELSE 0 END AS evidence_count, has_value AND NOT seen AS missing_evidence, false AS conflicting,
      CASE WHEN seen THEN '0.6' ELSE '' END AS confidences, CASE WHEN seen THEN 'county_business_license' ELSE '' END AS source_types FROM f""",
)
def _(spark):
    s = evidence.field_summary(_ingested(spark))
    return s.select(
        "candidate_id", "field_key", "has_value", "evidence_count", "missing_evidence", "conflicting",
        joined(F.col("confidences").cast("array<string>")).alias("confidences"), joined("source_types").alias("source_types"),
    )


@query(
    "contact_evidence_summary",
    f"""WITH {_FIRST_SQL}, f AS (SELECT id, 'contact-' || left(sha256(fingerprint), 16) AS cid, contact_name, contact_email FROM firsts WHERE {P.truthy('contact_name')} OR {P.truthy('contact_email')})
    SELECT id AS candidate_id, 0 AS contact_index, 'contact.' || cid || '.name' AS field_key, {P.filled('contact_name')} AS has_value, CASE WHEN {P.truthy('contact_name')} THEN 1 ELSE 0 END AS evidence_count FROM f
    UNION ALL SELECT id, 0, 'contact.' || cid || '.email', {P.filled('contact_email')}, CASE WHEN {P.truthy('contact_email')} THEN 1 ELSE 0 END FROM f""",
)
def _(spark):
    return evidence.contact_summary(_ingested(spark)).select("candidate_id", "contact_index", "field_key", "has_value", "evidence_count")


@query(
    "evidence_lookup",
    f"WITH {_FIRST_SQL} SELECT id AS candidate_id, phone AS value, source_id || ':' || coalesce(record_id, '') AS ref FROM firsts WHERE {P.truthy('phone')}",
)
def _(spark):
    rows = evidence.evidence_for(evidence.evidence_rows(_ingested(spark)), "location.phone")
    value = F.get_json_object(F.concat(F.lit("["), "value_json", F.lit("]")), "$[0]")
    return rows.select("candidate_id", value.alias("value"), F.concat("source.source_id", F.lit(":"), F.coalesce("source.source_record_id", F.lit(""))).alias("ref"))


@query(
    "evidence_source_refs",
    f"""WITH {_FIRST_SQL} SELECT id AS candidate_id, coalesce(record_id, 'DFW County Business License Export (CSV)') AS view_ref, record_id AS merge_ref FROM firsts""",
)
def _(spark):
    e = evidence.evidence_rows(_ingested(spark)).where("path_key = 'company.legalName'")
    return e.select("candidate_id", evidence.source_ref_for_view(F.col("source")).alias("view_ref"), evidence.source_ref_for_merge(F.col("source")).alias("merge_ref"))


@query(
    "value_identity",
    "SELECT candidate_id, path_key, count(DISTINCT value) > 1 AS conflicting, count(*) AS n FROM fx_proposal GROUP BY 1, 2",
)
def _(spark):
    p = spark.table("fx_proposal").withColumn("value_json", tx.json_text(F.col("value")))
    per_value = p.groupBy("candidate_id", "path_key", "value_json").agg(F.count("*").alias("n"))
    return per_value.groupBy("candidate_id", "path_key").agg((F.count("*") > 1).alias("conflicting"), F.sum("n").alias("n"))


def _proposals(spark: SparkSession) -> DataFrame:
    return spark.table("fx_proposal").withColumnRenamed("source_id", "source_key")


def _classified(spark: SparkSession) -> DataFrame:
    return evidence.classify_proposals(_proposals(spark), spark.table("fx_field_value"))


# The check goes through the proposals of a field with window functions over the rows before each one.
_MERGE = f"""base AS (SELECT p.*, v.current_value, row_number() OVER (PARTITION BY p.candidate_id, p.path_key, source_id, value ORDER BY seq) > 1 AND NOT is_prior AND NOT force_conflict AS rerun
    FROM fx_proposal p LEFT JOIN fx_field_value v ON v.candidate_id = p.candidate_id AND v.path_key = p.path_key),
  hist AS (SELECT *, coalesce(bool_or(derivation = 'human_confirmed' AND NOT rerun) OVER w, false) AS human,
    coalesce(min(value) OVER w <> value OR max(value) OVER w <> value, false) AS differ, coalesce(list_contains(list(value) OVER w, value), false) AS agree
    FROM base WINDOW w AS (PARTITION BY candidate_id, path_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  opened AS (SELECT *, NOT is_prior AND NOT force_conflict AND NOT rerun AND NOT human AND NOT differ AS open, NOT {P.filled('current_value')} AS empty FROM hist),
  firsts AS (SELECT *, min(CASE WHEN open THEN seq END) OVER (PARTITION BY candidate_id, path_key) AS first_open FROM opened),
  merged AS (SELECT *, CASE WHEN is_prior THEN 'prior' WHEN force_conflict THEN 'provider_conflict' WHEN rerun THEN 'repeat' WHEN human AND agree THEN 'agrees'
    WHEN human OR differ THEN 'conflict' WHEN empty AND (seq = first_open OR path_key = 'location.buildingType') THEN 'fill'
    WHEN agree OR empty OR value = current_value THEN 'agrees' ELSE 'conflict' END AS merge_class FROM firsts)"""


@query("proposal_merge", f"WITH {_MERGE} SELECT candidate_id, path_key, seq, merge_class FROM merged")
def _(spark):
    return _classified(spark).select("candidate_id", "path_key", long("seq").alias("seq"), "merge_class")


@query(
    "merge_conflicts",
    f"WITH {_MERGE} SELECT merge_class, path_key, count(*) AS n, count(current_value) AS with_value FROM merged WHERE merge_class IN ('conflict', 'provider_conflict') GROUP BY ALL",
)
def _(spark):
    rows = _classified(spark).where(F.col("merge_class").isin("conflict", "provider_conflict"))
    return rows.groupBy("merge_class", "path_key").agg(F.count("*").alias("n"), F.count("current_value").alias("with_value"))


# Proposals about candidates: the order's customer is the candidate.
VIEWS["fx_candidate_proposal"] = """
SELECT 'loc-' || lpad(CAST(o.o_custkey AS STRING), 7, '0') AS candidate_id,
  row_number() OVER (PARTITION BY o.o_custkey ORDER BY p.candidate_id, p.seq) AS seq, p.path_key, p.value, p.source_id, p.derivation, p.confidence,
  false AS is_prior, p.force_conflict
FROM fx_proposal p JOIN orders o ON o.o_orderkey = p.candidate_id
"""


def _candidate_merge(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    c = candidates(spark)
    p = spark.table("fx_candidate_proposal").withColumnRenamed("source_id", "source_key")
    return c, evidence.classify_proposals(p, evidence.field_values(c, [*evidence.MERGE_PATHS, "location.buildingType"]))


_CMERGE = _MERGE.replace("fx_proposal", "fx_candidate_proposal").replace(
    "fx_field_value v",
    """(SELECT id AS candidate_id, 'company.sicCode' AS path_key, sic_code AS current_value FROM fx_candidate UNION ALL SELECT id, 'company.website', website FROM fx_candidate
      UNION ALL SELECT id, 'location.phone', phone FROM fx_candidate) v""",
)
_WRITTEN = "written AS (SELECT candidate_id, path_key, arg_max(value, seq) AS value FROM merged WHERE merge_class = 'fill' AND path_key <> 'location.buildingType' GROUP BY 1, 2)"


@query(
    "merged_fields",
    f"""WITH {_CMERGE}, {_WRITTEN} SELECT c.id, coalesce(a.value, c.sic_code) AS sic_code, coalesce(b.value, c.website) AS website, coalesce(p.value, c.phone) AS phone FROM fx_candidate c
      LEFT JOIN written a ON a.candidate_id = c.id AND a.path_key = 'company.sicCode' LEFT JOIN written b ON b.candidate_id = c.id AND b.path_key = 'company.website'
      LEFT JOIN written p ON p.candidate_id = c.id AND p.path_key = 'location.phone'""",
)
def _(spark):
    c, merged = _candidate_merge(spark)
    return evidence.set_fields(c, evidence.filled_values(merged)).select("id", "company.sic_code", "company.website", "phone")


@query(
    "readiness_delta",
    (f"""WITH {_CMERGE}, {_WRITTEN}, after_fields AS (SELECT c.* REPLACE (coalesce(a.value, c.sic_code) AS sic_code, coalesce(p.value, c.phone) AS phone) FROM fx_candidate c
      LEFT JOIN written a ON a.candidate_id = c.id AND a.path_key = 'company.sicCode' LEFT JOIN written p ON p.candidate_id = c.id AND p.path_key = 'location.phone'),
    {P.READINESS}, {P.READINESS.replace('facts', 'facts2').replace('assessed', 'assessed2').replace('readiness AS', 'readiness2 AS').replace('fx_candidate', 'after_fields')},
    n AS (SELECT candidate_id, count(*) FILTER (merge_class = 'fill') AS f, count(*) FILTER (merge_class IN ('conflict', 'provider_conflict')) AS c FROM merged GROUP BY 1)
    SELECT r.candidate_id, r.publication_state AS initial_state, s.publication_state AS final_state, coalesce(n.f, 0) AS filled_count, coalesce(n.c, 0) AS conflict_count
    FROM readiness r JOIN readiness2 s ON s.candidate_id = r.candidate_id LEFT JOIN n ON n.candidate_id = r.candidate_id"""),
)
def _(spark):
    c, merged = _candidate_merge(spark)
    return evidence.readiness_delta(c, merged).select("candidate_id", "initial_state", "final_state", "filled_count", "conflict_count")


# The same proposals about contacts (one that the candidate has, or lacks) and an employee band.
VIEWS["fx_rich_proposal"] = """
SELECT candidate_id, seq, CASE path_key WHEN 'company.sicCode' THEN 'contact.contact-' || candidate_id || '.name'
    WHEN 'company.website' THEN 'contact.contact-' || candidate_id || '.email' WHEN 'location.phone' THEN 'location.employeeSizeSite' ELSE 'contact.none.name' END AS path_key,
  CASE WHEN path_key = 'location.phone' THEN '{"estimate":' || substr(value, 2) || '}' ELSE value END AS value,
  source_id, derivation, is_prior, force_conflict
FROM fx_candidate_proposal
"""
_RICH = (
    _MERGE.replace("fx_proposal", "fx_rich_proposal")
    .replace("SELECT p.*, v.current_value,", "SELECT p.* REPLACE (CASE WHEN p.path_key LIKE 'location.%' THEN replace(p.value, '}', '.0}') ELSE p.value END AS value), v.current_value, v.path_key IS NOT NULL AS known,")
    .replace("path_key = 'location.buildingType'", "(path_key LIKE 'contact.%' AND NOT known)")
    .replace(
        "fx_field_value v",
        """(SELECT id AS candidate_id, 'contact.contact-' || id || '.name' AS path_key, contact_name AS current_value FROM fx_candidate WHERE contact_name IS NOT NULL
      UNION ALL SELECT id, 'contact.contact-' || id || '.email', NULL FROM fx_candidate WHERE contact_name IS NOT NULL
      UNION ALL SELECT id, 'location.employeeSizeSite', '{"estimate":' || CAST(employee_estimate AS VARCHAR) || '}' FROM fx_candidate) v""",
    )
)


def _rich_merge(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    c = candidates(spark)
    p = spark.table("fx_rich_proposal").withColumnRenamed("source_id", "source_key")
    return c, evidence.classify_proposals(p, evidence.field_values(c))


@query("contact_merge", f"WITH {_RICH} SELECT candidate_id, path_key, seq, merge_class, value FROM merged")
def _(spark):
    return _rich_merge(spark)[1].select("candidate_id", "path_key", long("seq").alias("seq"), "merge_class", "value")


@query(
    "merged_contacts",
    f"""WITH {_RICH}, written AS (SELECT candidate_id, path_key, arg_max(value, seq) AS value FROM merged WHERE merge_class = 'fill' AND known GROUP BY 1, 2)
    SELECT c.id, CASE WHEN contact_name IS NOT NULL THEN coalesce(a.value, contact_name) END AS contact_name, b.value AS contact_email,
      coalesce(CAST(regexp_extract(e.value, '([0-9.]+)', 1) AS DOUBLE), employee_estimate) AS estimate FROM fx_candidate c
      LEFT JOIN written a ON a.candidate_id = c.id AND a.path_key LIKE 'contact.%.name' LEFT JOIN written b ON b.candidate_id = c.id AND b.path_key LIKE 'contact.%.email'
      LEFT JOIN written e ON e.candidate_id = c.id AND e.path_key = 'location.employeeSizeSite'""",
)
def _(spark):
    c, merged = _rich_merge(spark)
    contact = F.get("contacts", F.lit(0))
    return evidence.set_fields(c, evidence.filled_values(merged)).select(
        "id", contact["name"].alias("contact_name"), contact["email"].alias("contact_email"), F.col("employee_size_site.estimate").alias("estimate"))


_SUPPORTED = list(evidence.RESEARCH_FIELDS)
_PLAN_FIELDS = [  # field, rule it answers, populated
    ("company.legalName", "company_name_present", P.filled("legal_name")), ("company.website", None, P.filled("website")),
    ("company.alphasort", "alphasort_present", P.filled("alphasort")), ("company.startYear", "start_year_present", "start_year IS NOT NULL"),
    ("company.sicCode", "sic_code_present", P.filled("sic_code")), ("company.relationship", None, P.filled("parent_company")),
    ("location.physicalAddress", "physical_address_or_exception", f"({P.filled('street')} OR {P.filled('city')})"),
    ("location.mailingAddress", None, P.filled("mailing_city")), ("location.phone", "local_phone_or_exception", P.filled("phone")),
    ("location.market", None, "false"), ("location.county", None, "false"), ("location.siteType", "site_type_present", "coalesce(site_type <> 'unknown', false)"),
    ("location.employeeSizeSite", "site_employee_band_present", "employee_estimate IS NOT NULL"),
    ("location.employeeSizeCompanyWide", "company_wide_employee_band_present", "true"),
    ("contact.name", "min_one_contact", P.filled("contact_name")), ("contact.email", "min_one_contact", "false"),
]
_PLAN = f"{P.READINESS}, planned AS (" + " UNION ALL ".join(
    f"SELECT f.id AS candidate_id, '{field}' AS field, "
    + (f"list_contains(string_split(r.blockers, '|'), '{rule}') AS blocked, list_contains(string_split(r.unresolved, '|'), '{rule}') AS open_rule" if rule else "false AS blocked, false AS open_rule")
    + f" FROM fx_candidate f JOIN readiness r ON r.candidate_id = f.id WHERE NOT {pop}" + (" AND contact_name IS NOT NULL" if field.startswith("contact") else "")
    for field, rule, pop in _PLAN_FIELDS
) + ")"


@query(
    "research_plan",
    f"WITH {_PLAN} SELECT candidate_id, field, blocked AS mandatory, CASE WHEN blocked THEN 'blocked_field' WHEN open_rule THEN 'unresolved_field' ELSE 'optional_gap' END AS reason FROM planned",
)
def _(spark):
    plans = evidence.plan_fields(readiness.with_readiness(candidates(spark)), _SUPPORTED)
    return plans.select("candidate_id", "field", "mandatory", "reason")


# A provider per nation, each supporting two fields; some may not run.
_PROVIDED = "'company.website,company.sicCode,location.phone,contact.email,company.alphasort'"
VIEWS["fx_provider"] = "\nUNION ALL\n".join(
    f"""SELECT n_name AS provider_id, n_nationkey + 1 AS position, n_nationkey % 7 <> 3 AS can_run,
  split_part({_PROVIDED}, ',', CAST((n_regionkey + {step}) % 5 AS INT) + 1) AS field FROM nation"""
    for step in (0, 2)
)


@query(
    "provider_requests",
    f"""WITH {_PLAN} SELECT candidate_id, provider_id, position, string_agg(p.field, '|' ORDER BY p.field) AS fields FROM planned p JOIN fx_provider v ON v.field = p.field
      WHERE can_run AND position <= 20 GROUP BY 1, 2, 3""",
)
def _(spark):
    plans = evidence.plan_fields(readiness.with_readiness(candidates(spark)), _SUPPORTED)
    r = evidence.provider_requests(plans, spark.table("fx_provider"), 20)
    return r.select("candidate_id", "provider_id", "position", joined(F.array_sort("fields")).alias("fields"))


@query(
    "provider_requests_all",
    f"""WITH {_PLAN} SELECT candidate_id, provider_id, position, string_agg(p.field, '|' ORDER BY p.field) AS fields FROM planned p JOIN fx_provider v ON v.field = p.field
      WHERE can_run GROUP BY 1, 2, 3""",
)
def _(spark):
    plans = evidence.plan_fields(readiness.with_readiness(candidates(spark)), _SUPPORTED)
    r = evidence.provider_requests(plans, spark.table("fx_provider"), None)
    return r.select("candidate_id", "provider_id", "position", joined(F.array_sort("fields")).alias("fields"))


# What the providers answered: the proposals about candidates, dealt over the providers; some fail, find nothing or give an invalid confidence.
VIEWS["fx_answer"] = """
SELECT p.candidate_id, n.n_name AS provider_id, CASE WHEN n.n_nationkey % 9 = 4 THEN 'failed' ELSE 'completed' END AS provider_status,
  CAST(p.seq AS BIGINT) AS outcome, CASE WHEN p.force_conflict THEN 'conflict' WHEN p.seq % 11 = 0 THEN 'not_found' ELSE 'success' END AS status,
  p.path_key, p.value, p.source_id, p.derivation, CASE WHEN p.seq % 17 = 0 THEN CAST(1.5 AS DOUBLE) ELSE CAST(p.confidence AS DOUBLE) END AS confidence
FROM fx_candidate_proposal p JOIN nation n ON n.n_nationkey = p.seq % 25
"""
# Evidence that candidates bring along.
VIEWS["fx_prior"] = """
SELECT id AS candidate_id, 0 AS place, 'company.sicCode' AS path_key, 'v0' AS value, 'p1' AS source_id,
  CASE WHEN variant = 3 THEN 'human_confirmed' ELSE 'directly_observed' END AS derivation FROM fx_candidate WHERE variant IN (1, 3, 6)
UNION ALL SELECT id, 1, 'location.phone', 'v1', 'p2', 'directly_observed' FROM fx_candidate WHERE variant IN (2, 3)
"""


def _evidence_of(rows: DataFrame) -> Column:
    source = F.struct(F.lit("web").alias("source_type"), "source_id")
    confidence = F.col("confidence") if "confidence" in rows.columns else F.lit(0.6)
    return F.struct("path_key", tx.json_text(F.col("value")).alias("value_json"), confidence.alias("confidence"), source.alias("source"), "derivation")


def _researched(spark: SparkSession) -> DataFrame:
    prior = spark.table("fx_prior")
    lists = prior.groupBy(F.col("candidate_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("place", _evidence_of(prior).alias("e"))))["e"].alias("field_evidence"))
    return as_candidates(candidates(spark).drop("field_evidence").join(lists, "id", "left"))


def _answers(spark: SparkSession) -> DataFrame:
    rows = spark.table("fx_answer")
    shaped = as_evidence(_evidence_of(rows), rows)
    return shaped.select("candidate_id", "provider_id", "provider_status", "outcome", "status", F.lit(0).alias("item"), "proposal")


_ENRICHED = f"""{_PLAN}, asked AS (SELECT candidate_id, provider_id, position, string_agg(p.field, '|' ORDER BY p.field) AS fields FROM planned p JOIN fx_provider v ON v.field = p.field
    WHERE can_run AND position <= 20 GROUP BY 1, 2, 3),
  answered AS (SELECT a.*, k.position FROM fx_answer a JOIN asked k USING (candidate_id, provider_id) WHERE provider_status = 'completed' AND status IN ('success', 'conflict')),
  run_rows AS (SELECT candidate_id, place - 1000000 AS seq, path_key, value, source_id, derivation, true AS is_prior, false AS force_conflict FROM fx_prior
    UNION ALL SELECT candidate_id, position * 1000000 + outcome, path_key, value, source_id, derivation, false, status = 'conflict' FROM answered WHERE confidence BETWEEN 0 AND 1),
  {_CMERGE.replace("fx_candidate_proposal", "run_rows")}"""


@query(
    "enrichment_requests",
    f"""WITH {_ENRICHED} SELECT k.candidate_id, k.provider_id, k.position, k.fields, CASE WHEN c.contact_name IS NOT NULL THEN 'contact-' || c.id END AS target_contact_id,
      r.blockers, (SELECT count(*) FROM fx_prior p WHERE p.candidate_id = k.candidate_id AND list_contains(string_split(k.fields, '|'), p.path_key)) AS existing
      FROM asked k JOIN fx_candidate c ON c.id = k.candidate_id JOIN readiness r ON r.candidate_id = k.candidate_id""",
)
def _(spark):
    r = enrich.requests(_researched(spark), spark.table("fx_provider"), "run-1", "2024-01-01T00:00:00.000Z", max_providers=20)
    return r.select("candidate_id", "provider_id", "position", joined(F.array_sort("fields")).alias("fields"), "target_contact_id",
                    joined("blockers.rule_id").alias("blockers"), long(F.size("existing_evidence")).alias("existing"))


@query(
    "enrichment_job",
    (f"""WITH {_ENRICHED}, {_WRITTEN}, after_fields AS (SELECT c.* REPLACE (coalesce(a.value, c.sic_code) AS sic_code, coalesce(p.value, c.phone) AS phone) FROM fx_candidate c
      LEFT JOIN written a ON a.candidate_id = c.id AND a.path_key = 'company.sicCode' LEFT JOIN written p ON p.candidate_id = c.id AND p.path_key = 'location.phone'),
    {P.READINESS.replace('facts', 'facts2').replace('assessed', 'assessed2').replace('readiness AS', 'readiness2 AS').replace('fx_candidate', 'after_fields')},
    n AS (SELECT candidate_id, count(*) FILTER (merge_class = 'fill') AS f, count(*) FILTER (merge_class IN ('conflict', 'provider_conflict')) AS c,
      count(*) FILTER (NOT is_prior AND merge_class <> 'repeat') AS added FROM merged GROUP BY 1)
    SELECT r.candidate_id, r.publication_state AS initial_state, s.publication_state AS final_state, coalesce(n.f, 0) AS filled_count, coalesce(n.c, 0) AS conflict_count,
      (SELECT count(*) FROM asked k WHERE k.candidate_id = r.candidate_id) AS n_requests,
      (SELECT count(*) FROM fx_prior p WHERE p.candidate_id = r.candidate_id) + coalesce(n.added, 0) AS n_evidence,
      (SELECT count(*) FROM answered a WHERE a.candidate_id = r.candidate_id AND NOT confidence BETWEEN 0 AND 1) AS refused
    FROM readiness r JOIN readiness2 s ON s.candidate_id = r.candidate_id LEFT JOIN n ON n.candidate_id = r.candidate_id"""),
)
def _(spark):
    done = enrich.enrich(_researched(spark), spark.table("fx_provider"), _answers(spark), "run-1", "2024-01-01T00:00:00.000Z", max_providers=20)
    kept = done.candidates.select(F.col("id").alias("candidate_id"), long(F.size("field_evidence")).alias("n_evidence"))
    refused = done.refused.groupBy("candidate_id").agg(F.count("*").alias("refused"))
    return done.summary.join(kept, "candidate_id").join(refused, "candidate_id", "left").select(
        "candidate_id", "initial_state", "final_state", "filled_count", "conflict_count", "n_requests", "n_evidence", F.coalesce("refused", F.lit(0)).alias("refused"))


# Answers of the first run are evidence already there when the second one comes.
_SECOND_RUN = """SELECT candidate_id, (outcome % 2) * 1000000000 + position * 1000000 + outcome, path_key, value, source_id,
  CASE WHEN outcome % 2 = 0 THEN 'directly_observed' ELSE derivation END, outcome % 2 = 0, outcome % 2 = 1 AND status = 'conflict'"""


@query(
    "enrichment_in_two_runs",
    f"""WITH {_ENRICHED.replace("SELECT candidate_id, position * 1000000 + outcome, path_key, value, source_id, derivation, false, status = 'conflict'", _SECOND_RUN)}
    SELECT candidate_id, path_key, value, source_id, merge_class FROM merged WHERE seq >= 1000000000""",
)
def _(spark):
    # The second run starts from the same candidates: what the first one accepted is in the store alone.
    store = enrich.store(spark, f"{shared_folder(spark)}/evidence-{uuid.uuid4().hex}", 16)
    researched, answered = cut_lineage(_researched(spark)), cut_lineage(_answers(spark))
    for run in (1, 2):
        answers = answered.where(F.col("outcome") % 2 == run - 1)
        if run == 1:
            answers = answers.withColumn("proposal", F.col("proposal").withField("derivation", F.lit("directly_observed")))
        done = enrich.enrich(researched, spark.table("fx_provider"), answers, f"run-{run}", "2024-01-01T00:00:00.000Z", run=run, known=store, max_providers=20)
    return done.merged.select("candidate_id", "path_key", "value", F.col("proposal.source.source_id").alias("source_id"), "merge_class")


@query(
    "research_field_sets",
    f"""WITH {_PLAN} SELECT candidate_id, count(*) FILTER (blocked) AS blocked, count(*) FILTER (open_rule AND NOT blocked) AS unresolved, count(*) FILTER (NOT blocked AND NOT open_rule) AS optional FROM planned GROUP BY 1""",
)
def _(spark):
    plans = evidence.plan_fields(readiness.with_readiness(candidates(spark)), _SUPPORTED)
    reason = F.col("reason")
    return plans.groupBy("candidate_id").agg(
        F.count_if(reason == "blocked_field").alias("blocked"), F.count_if(reason == "unresolved_field").alias("unresolved"), F.count_if(reason == "optional_gap").alias("optional")
    )


# -------------------------------------------------------------------- evaluation

# A labelled case per candidate: five directory rows, some alike, and the outcome its variant was made for.
VIEWS["fx_case"] = """
SELECT 'set-' || CAST(variant % 3 AS STRING) AS dataset_id, id AS case_id, variant,
  CASE variant WHEN 0 THEN 'same_existing_location' WHEN 7 THEN 'same_existing_location' WHEN 1 THEN 'new_branch_of_existing_company' WHEN 2 THEN 'new_headquarters_of_existing_company'
    WHEN 3 THEN 'possible_changed_location' WHEN 4 THEN 'possible_name_change' WHEN 5 THEN 'likely_new_company' ELSE 'ambiguous_manual_review' END AS expected_outcome,
  CASE WHEN variant IN (0, 1, 2, 3, 4, 7) THEN base_id ELSE NULL END AS expected_id
FROM fx_candidate
"""
VIEWS["fx_case_existing"] = "\nUNION ALL\n".join(
    f"""SELECT s.dataset_id, s.case_id, m.* FROM fx_case s JOIN fx_candidate c ON c.id = s.case_id AND c.postal_code IS NOT NULL
JOIN fx_company m ON m.k = CAST(substr(s.case_id, 5) AS BIGINT) + {step}"""
    for step in (0, 1, 10, 11, 110)
)


def _results(spark: SparkSession) -> DataFrame:
    c = candidates(spark).select(F.col("id").alias("case_id"), F.struct("company", "physical_address", "phone", "site_type").alias("candidate"))
    none = F.lit(None).cast("string")
    cases = spark.table("fx_case").join(c, "case_id").withColumns({"reviewer": none, "notes": none})
    return evaluation.evaluate_cases(cases, spark.table("fx_case_existing"))


_EVAL = f"""{P.KEYS}, pairs AS (SELECT ck.*, mk.* FROM fx_case_existing e JOIN ck ON ck.candidate_id = e.case_id JOIN mk ON mk.master_id = e.id), {P.SCORED}, {P.DECIDED},
  results AS (SELECT s.dataset_id, s.case_id, s.expected_outcome, d.outcome AS actual_outcome, d.outcome = s.expected_outcome AS outcome_correct, s.expected_id, d.matched_id AS actual_id,
    CASE WHEN s.expected_id IS NOT NULL THEN coalesce(d.matched_id = s.expected_id, false) END AS matched_record_correct,
    d.outcome = s.expected_outcome AND (s.expected_id IS NULL OR coalesce(d.matched_id = s.expected_id, false)) AS fully_correct,
    r.rnk AS retrieval_rank, d.decision_confidence, d.requires_human_review
    FROM fx_case s JOIN decided d ON d.candidate_id = s.case_id LEFT JOIN ranked r ON r.candidate_id = s.case_id AND r.master_id = s.expected_id)"""


@query("case_results", f"WITH {_EVAL} SELECT * FROM results")
def _(spark):
    return _results(spark).drop("reasons", "conflicts", "reviewer", "notes")


_ACC = f"count(*) AS case_count, avg(CAST(outcome_correct AS INT)) AS outcome_accuracy, avg(CAST(matched_record_correct AS INT)) AS matched_record_accuracy, avg(CAST(fully_correct AS INT)) AS full_case_accuracy"


@query("evaluation_accuracy", f"WITH {_EVAL} SELECT {_ACC} FROM results")
def _(spark):
    return evaluation.accuracy(_results(spark))


_OUTCOME_ENUM = "(VALUES " + ", ".join(f"('{o}')" for o in codes.OUTCOMES) + ") o(expected_outcome)"


@query(
    "confusion_matrix",
    f"WITH {_EVAL} SELECT o.expected_outcome, " + ", ".join(f"count(*) FILTER (actual_outcome = '{o}') AS {o}" for o in codes.OUTCOMES)
    + f" FROM {_OUTCOME_ENUM} LEFT JOIN results r ON r.expected_outcome = o.expected_outcome GROUP BY 1",
)
def _(spark):
    return evaluation.confusion_matrix(_results(spark))


@query(
    "outcome_breakdown",
    f"""WITH {_EVAL} SELECT o.expected_outcome, count(case_id) AS case_count, coalesce(avg(CAST(outcome_correct AS INT)), 0) AS outcome_accuracy, avg(CAST(matched_record_correct AS INT)) AS matched_record_accuracy,
      coalesce(avg(CAST(fully_correct AS INT)), 0) AS full_case_accuracy, coalesce(avg(CAST(requires_human_review AS INT)), 0) AS review_rate,
      coalesce(avg(CASE WHEN case_id IS NOT NULL THEN CAST(actual_outcome = 'ambiguous_manual_review' AS INT) END), 0) AS abstention_rate,
      {', '.join(f"count(*) FILTER (actual_outcome = '{o}') AS actual_{o}" for o in codes.OUTCOMES)}
    FROM {_OUTCOME_ENUM} LEFT JOIN results r ON r.expected_outcome = o.expected_outcome GROUP BY 1""",
)
def _(spark):
    return evaluation.breakdown(_results(spark))


@query(
    "retrieval_metrics",
    f"""WITH {_EVAL} SELECT count(*) AS applicable_cases, avg(CAST(retrieval_rank <= 1 AS INT)) AS recall_at_1, avg(CAST(retrieval_rank <= 3 AS INT)) AS recall_at_3,
      avg(CAST(retrieval_rank <= 5 AS INT)) AS recall_at_5, round(avg({d(1)} / retrieval_rank), 9) AS mean_reciprocal_rank, avg(retrieval_rank) AS mean_rank, median(retrieval_rank) AS median_rank
    FROM results WHERE retrieval_rank IS NOT NULL""",
)
def _(spark):
    # Rounded: the two engines add the reciprocals in different orders.
    return evaluation.retrieval(_results(spark)).withColumn("mean_reciprocal_rank", F.round("mean_reciprocal_rank", 9))


_RELATED = "('same_existing_location', 'new_branch_of_existing_company', 'new_headquarters_of_existing_company', 'possible_changed_location', 'possible_name_change')"


@query(
    "directional_errors",
    f"""WITH {_EVAL} SELECT count(*) FILTER (expected_outcome = 'likely_new_company') AS new_expected_count, count(*) FILTER (expected_outcome IN {_RELATED}) AS existing_related_expected_count,
      avg(CAST(actual_outcome IN {_RELATED} AS INT)) FILTER (expected_outcome = 'likely_new_company') AS false_existing_link_rate,
      avg(CAST(actual_outcome = 'likely_new_company' AS INT)) FILTER (expected_outcome IN {_RELATED}) AS false_new_rate,
      avg(CAST(actual_outcome = 'ambiguous_manual_review' AS INT)) AS abstention_rate FROM results""",
)
def _(spark):
    return evaluation.directional_errors(_results(spark))


_BAND = """CASE WHEN decision_confidence >= 0.8 AND decision_confidence <= 1 THEN '0.8-1.0' WHEN decision_confidence >= 0.6 AND decision_confidence < 0.8 THEN '0.6-0.8'
  WHEN decision_confidence >= 0.4 AND decision_confidence < 0.6 THEN '0.4-0.6' WHEN decision_confidence >= 0.2 AND decision_confidence < 0.4 THEN '0.2-0.4'
  WHEN decision_confidence >= 0 AND decision_confidence < 0.2 THEN '0.0-0.2' ELSE 'unscored' END"""


@query(
    "confidence_calibration",
    f"""WITH {_EVAL}, b AS (SELECT *, {_BAND} AS band FROM results)
    SELECT o.band, count(case_id) AS case_count, avg(CAST(fully_correct AS INT)) AS full_case_accuracy, avg(CAST(outcome_correct AS INT)) AS outcome_accuracy, round(avg(decision_confidence), 9) AS mean_confidence
    FROM (VALUES ('unscored'), ('0.0-0.2'), ('0.2-0.4'), ('0.4-0.6'), ('0.6-0.8'), ('0.8-1.0')) o(band) LEFT JOIN b ON b.band = o.band GROUP BY 1""",
)
def _(spark):
    return evaluation.calibration(_results(spark)).withColumn("mean_confidence", F.round("mean_confidence", 9))


@query("case_misses", f"WITH {_EVAL} SELECT dataset_id, case_id, expected_outcome, actual_outcome, expected_id, actual_id FROM results WHERE NOT fully_correct ORDER BY dataset_id, case_id LIMIT 25")
def _(spark):
    return evaluation.misses(_results(spark)).select("dataset_id", "case_id", "expected_outcome", "actual_outcome", "expected_id", "actual_id")


# Cases with the usual mistakes spread over them.
VIEWS["fx_raw_case"] = """
SELECT dataset_id, CAST(substr(case_id, 5) AS BIGINT) AS position, CAST(substr(case_id, 5) AS BIGINT) AS global_order,
  CASE WHEN CAST(substr(case_id, 5) AS BIGINT) % 40 = 3 THEN ' ' WHEN CAST(substr(case_id, 5) AS BIGINT) % 50 = 9 THEN 'loc-0000001' ELSE case_id END AS case_id,
  case_id AS real_id, case_id AS candidate_id, CASE WHEN CAST(substr(case_id, 5) AS BIGINT) % 60 = 5 THEN '' ELSE 'Name' END AS legal_name,
  CASE WHEN CAST(substr(case_id, 5) AS BIGINT) % 30 = 4 THEN 'moved' ELSE expected_outcome END AS expected_outcome,
  CASE WHEN CAST(substr(case_id, 5) AS BIGINT) % 35 = 6 THEN NULL WHEN CAST(substr(case_id, 5) AS BIGINT) % 45 = 7 THEN 'mst-x' WHEN variant = 5 AND CAST(substr(case_id, 5) AS BIGINT) % 4 = 1 THEN 'mst-0000001' ELSE expected_id END AS expected_id,
  CASE WHEN CAST(substr(case_id, 5) AS BIGINT) % 70 = 8 THEN NULL WHEN CAST(substr(case_id, 5) AS BIGINT) % 80 = 9 THEN 'guess' ELSE 'synthetic' END AS provenance_source
FROM fx_case
"""
VIEWS["fx_raw_existing"] = """
SELECT r.dataset_id, r.position, CASE WHEN e.k % 900 = 11 THEN '' WHEN e.k % 700 = 12 THEN 'mst-0000002' ELSE e.id END AS id
FROM fx_raw_case r JOIN fx_case_existing e ON e.case_id = r.real_id
UNION ALL SELECT r.dataset_id, r.position, e.id FROM fx_raw_case r JOIN fx_case_existing e ON e.case_id = r.real_id WHERE r.position % 90 = 1
"""


@query(
    "case_validation",
    f"""WITH f AS (SELECT case_id, min(global_order) AS first FROM fx_raw_case WHERE {P.filled('case_id')} GROUP BY 1),
    ids AS (SELECT dataset_id, position, id, count(*) AS n FROM fx_raw_existing GROUP BY ALL),
    per AS (SELECT dataset_id, position, bool_or(NOT {P.filled('id')}) AS blank_ids, bool_or({P.filled('id')} AND n > 1) AS rep FROM ids GROUP BY ALL),
    r AS (SELECT c.*, NOT {P.filled('c.case_id')} AS blank_case, coalesce(global_order > first, false) AS repeated, coalesce(blank_ids, false) AS blank_ids, coalesce(rep, false) AS rep,
      EXISTS (SELECT 1 FROM ids i WHERE i.dataset_id = c.dataset_id AND i.position = c.position AND i.id = c.expected_id) AS listed,
      expected_outcome IN ('likely_new_company', 'ambiguous_manual_review') OR expected_outcome IN {_RELATED} AS known, {P.filled('expected_id')} AS matched
      FROM fx_raw_case c LEFT JOIN f ON f.case_id = c.case_id LEFT JOIN per p ON p.dataset_id = c.dataset_id AND p.position = c.position),
    ok AS (SELECT * FROM r WHERE NOT blank_case AND NOT repeated)
    SELECT dataset_id, case_id, position, 'case id required' AS message FROM r WHERE blank_case
    UNION ALL SELECT dataset_id, case_id, position, 'repeated case id' FROM r WHERE NOT blank_case AND repeated
    UNION ALL SELECT dataset_id, case_id, position, 'candidate needs an id and a legal name' FROM ok WHERE legal_name = ''
    UNION ALL SELECT dataset_id, case_id, position, 'existing record without an id' FROM ok WHERE blank_ids
    UNION ALL SELECT dataset_id, case_id, position, 'repeated existing record id' FROM ok WHERE rep
    UNION ALL SELECT dataset_id, case_id, position, 'unknown expected outcome' FROM ok WHERE NOT known
    UNION ALL SELECT dataset_id, case_id, position, 'matched record not allowed' FROM ok WHERE expected_outcome = 'likely_new_company' AND matched
    UNION ALL SELECT dataset_id, case_id, position, 'matched record required' FROM ok WHERE expected_outcome IN {_RELATED} AND NOT matched
    UNION ALL SELECT dataset_id, case_id, position, 'matched record not among the existing ones' FROM ok WHERE known AND matched AND NOT listed
    UNION ALL SELECT dataset_id, case_id, position, 'provenance source required' FROM ok WHERE known AND provenance_source IS NULL
    UNION ALL SELECT dataset_id, case_id, position, 'unknown provenance source' FROM ok WHERE known AND provenance_source = 'guess'""",
)
def _(spark):
    return evaluation.validate_cases(spark.table("fx_raw_case"), spark.table("fx_raw_existing"))


@query(
    "labelled_case_scan",
    """WITH c AS (SELECT s.dataset_id || '-' || CAST(CAST(substr(case_id, 5) AS BIGINT) // 40 AS VARCHAR) AS dataset_id, case_id, c.legal_name, c.city, expected_outcome, expected_id FROM fx_case s JOIN fx_candidate c ON c.id = s.case_id),
    e AS (SELECT case_id, count(*) AS n FROM fx_case_existing GROUP BY 1)
    SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY c.case_id) - 1 AS position, c.case_id, legal_name, city, expected_outcome, expected_id, coalesce(n, 0) AS n_existing
    FROM c LEFT JOIN e ON e.case_id = c.case_id""",
)
def _(spark):
    # One envelope a file, as labelled cases are kept.
    e = spark.table("fx_case_existing").groupBy("case_id").agg(F.collect_list(F.struct("id", F.col("company_name").alias("companyName"), "city")).alias("existingCompanies"))
    c = spark.table("fx_candidate").select(F.col("id").alias("case_id"), F.struct(
        F.col("id").alias("id"), F.struct(F.col("legal_name").alias("legalName")).alias("company"), F.struct("city").alias("physicalAddress")).alias("candidate"))
    block = F.concat_ws("-", "dataset_id", F.floor(F.substring("case_id", 5, 20).cast("bigint") / 40).cast("string"))
    case = F.struct(F.col("case_id").alias("caseId"), "candidate", F.coalesce("existingCompanies", F.array().cast(e.schema["existingCompanies"].dataType)).alias("existingCompanies"),
                    F.struct(F.col("expected_outcome").alias("outcome"), F.col("expected_id").alias("matchedExistingCompanyId")).alias("expected"),
                    F.struct(F.lit("synthetic").alias("source")).alias("provenance"))
    rows = spark.table("fx_case").join(c, "case_id").join(e, "case_id", "left").groupBy(block.alias("datasetId")).agg(F.array_sort(F.collect_list(case)).alias("cases"))
    path = _scratch(spark, "cases")
    rows.withColumn("schemaVersion", F.lit(evaluation.SCHEMA_VERSIONS[0])).write.option("maxRecordsPerFile", 1).json(path)
    cases, existing, _errors = evaluate.read_cases(spark, [path])
    counts = existing.groupBy("dataset_id", "case_id").agg(F.count("*").alias("n"))
    return cases.join(counts, ["dataset_id", "case_id"], "left").select(
        "dataset_id", "position", "case_id", "legal_name", F.col("candidate.physical_address.city").alias("city"), "expected_outcome", "expected_id", F.coalesce("n", F.lit(0)).alias("n_existing"))


# ------------------------------------------------------------ scans, artifacts, streams


def _scratch(spark: SparkSession, what: str) -> str:
    """A new folder below the one all executors share."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def _as_csv(df: DataFrame, what: str) -> str:
    """``df`` as CSV files with a header, in a new folder; a file is read by one task, so larger tables have more files, not larger ones."""
    path = _scratch(df.sparkSession, what)
    df.repartition(F.xxhash64(*df.columns)).write.options(maxRecordsPerFile=100_000, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query("directory_scan", f"WITH {_CLEAN} SELECT * EXCLUDE (seq) FROM dir")
def _(spark):
    rows = spark.table("fx_directory").drop("seq")
    return master.read_records(spark, _as_csv(rows, "directory")).select(rows.columns)


@query("edge_scan", "SELECT relationship_type, parent_id, child_id FROM fx_edge")
def _(spark):
    rows = edges(spark).select("relationship_type", "parent_id", "child_id")
    return master.read_edges(spark, _as_csv(rows, "edges")).select(rows.columns)


_LICENCE_CELLS = [c for c in feeds.LICENCE_COLUMNS if c not in ("license_id", "county")]


@query("licence_scan", f"SELECT {P.trim('record_id')} AS record_id, {', '.join(f'nullif({P.trim(c)}, {chr(39) * 2}) AS {c}' for c in _LICENCE_CELLS)} FROM fx_source_row")
def _(spark):
    rows = spark.table("fx_source_row").select(F.col("record_id").alias("license_id"), *_LICENCE_CELLS)
    return feeds.read_licence_csv(spark, _as_csv(rows, "licences")).select("record_id", *_LICENCE_CELLS)


@query("feed_scan", "SELECT record_id, 'Firm ' || CAST(user_id AS VARCHAR) AS legal_name FROM (SELECT *, CAST(event_id AS VARCHAR) AS record_id FROM events)")
def _(spark):
    path = _scratch(spark, "feed")
    items = spark.table("events").select(F.col("event_id").cast("string").alias("reportId"), F.concat(F.lit(" Firm "), F.col("user_id").cast("string")).alias("companyName"))
    items.repartition(5).write.json(path)
    return feeds.map_json_items(feeds.read_json_feed(spark, path, lines=True)).select("record_id", "company.legal_name")


@query(
    "artifact_manifest",
    f"WITH {_UNIQUE}, {_DIST.replace('fx_permit', 'uniq')} SELECT 'distributions' AS artifact, count(*) AS row_count FROM dist UNION ALL SELECT 'strata', count(*) FROM uniq",
)
def _(spark):
    # Found once: each artifact, and the count of a taxpayer's outlets, would shuffle all observations again.
    used = ["source_record_id", "taxpayer_number", "taxpayer_organization_type", "outlet_county_code", "outlet_naics_code", "_fsd", "_differ", "_risk"]
    rows = cut_lineage(permits.unique_observations(profiling.with_flags(spark.table("fx_permit")), TIES).select(used))
    manifest = tables.write_artifacts(
        {"distributions": profiling.distributions(rows), "strata": profiling.with_stratum(rows).select("source_record_id", "stratum")},
        _scratch(spark, "artifacts"), "2024-02-01", {"seed": "1"},
    )
    return manifest.select("artifact", "row_count")


@query(
    "decision_log",
    f"""WITH {_CHECKED} SELECT event_id, candidate_id, sequence, previous_status, new_status, reviewer, nullif({P.trim('selected_id')}, '') AS selected_id, NULL AS reject_reason FROM chained
      UNION ALL SELECT event_id, candidate_id, NULL, NULL, NULL, reviewer, nullif({P.trim('selected_id')}, ''), reject_reason FROM checked WHERE reject_reason IS NOT NULL""",
)
def _(spark):
    # Two batches, one after the other in time, as a reviewer's log grows.
    root, rows = _scratch(spark, "decision-log"), spark.table("fx_decision")
    queue = cut_lineage(_scored(spark).withColumns({"review_status": F.lit("pending"), "reviewer_note": F.lit(None).cast("string")}))
    at = F.col("decided_at") < F.lit("2024-01-16").cast("timestamp")
    for name, part in (("1", rows.where(at)), ("2", rows.where(~at))):
        queue = review.queue_after(queue, decisions.append_decisions(part, queue, root, name))
    kept = decisions.stored_ledger(rows, root)
    refused = spark.read.parquet(f"{root}/rejected")
    names = ["event_id", "candidate_id", "reviewer", tx.blank_to_null(F.col("selected_id")).alias("selected_id")]
    return kept.select(*names, "sequence", "previous_status", "new_status").unionByName(refused.select(*names, "reject_reason"), allowMissingColumns=True)


_CORRECTED = "event_id % 4 = 0"


@query(
    "decision_corrections",
    f"""WITH {_CHECKED}, c AS (SELECT * FROM chained WHERE {_CORRECTED}) SELECT event_id, candidate_id, sequence, 0 AS place, 'location.phone' AS path_key, NULL AS previous_value, 'p' || event_id AS corrected_value, 'called' AS reason FROM c
    UNION ALL SELECT event_id, candidate_id, sequence, 1, 'company.website', 'w' || candidate_id, NULL, NULL FROM c""",
)
def _(spark):
    root = _scratch(spark, "corrections")
    queue = _queued(spark).withColumns({c: F.lit("x") for c in ("match_classification", "matched_id", "best_id", "resolution_outcome", "publication_state")}).withColumns(
        {c: F.lit(0.5) for c in ("match_score", "resolution_confidence", "completeness_score", "review_priority")}
    ).withColumns({
        "requires_human_review": F.lit(True), "resolution_reasons": F.array(F.lit("r")), "resolution_conflicts": F.array(F.lit("c")),
        "blockers": F.array(F.struct(F.lit("b").alias("rule_id"))), "review_status": F.lit("pending"), "reviewer_note": F.lit(None).cast("string"),
    })
    change = lambda key, old, new, why: F.struct(F.lit(key).alias("path_key"), old.cast("string").alias("previous_value"), new.cast("string").alias("corrected_value"), why.cast("string").alias("reason"))
    changes = F.array(
        change("location.phone", F.lit(None), F.concat(F.lit("p"), "event_id"), F.lit("called")), change("company.website", F.concat(F.lit("w"), "candidate_id"), F.lit(None), F.lit(None))
    )
    rows = spark.table("fx_decision").withColumn("field_corrections", F.when(F.expr(_CORRECTED), changes))
    decisions.append_decisions(rows, queue, root, "1")
    kept = decisions.stored_ledger(rows, root)
    return kept.select("event_id", "candidate_id", "sequence", F.posexplode("field_corrections").alias("place", "x")).select("event_id", "candidate_id", "sequence", "place", "x.*")


def _source_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed rows of the events file as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    raw.createOrReplaceTempView("events_stream")
    return raw


def _stream_sql(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(VIEWS[view].replace("FROM events", "FROM events_stream"))


def _register_stream(name: str, sql: str, fn: Callable[[SparkSession, str], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, sf_dir)
        _source_stream(spark, sf_dir)
        return fn(spark, sf_dir)

    QUERIES[name] = run
    ORACLE[name] = with_views(sql)


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark, "stream-ingest")
    mapper = lambda df: feeds.map_licence_rows(df, now="2024-01-01T00:00:00.000Z")
    q = jobs.ingest_stream(_stream_sql(spark, "fx_source_row"), mapper, f"{root}/out", f"{root}/checkpoint", "2024-02-01T00:00:00.000Z")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out/candidates").select("id", "company.legal_name", "source.fingerprint")


_register_stream(
    "streaming_ingest",
    f"WITH {_FIRST_SQL} SELECT id, {P.trim('business_name')} AS legal_name, fingerprint FROM firsts",
    _stream_ingest,
)


def _stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark, "stream-arrivals")
    rows = feeds.map_licence_rows(_stream_sql(spark, "fx_source_row"), keep=("ts",))
    # One wide window: which of several equal arrivals is kept then makes no difference to the counts.
    counted = jobs.arrival_counts(rows, delay="60 days", width="365 days")
    jobs.write_counts(counted, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return jobs.current_counts(spark, f"{root}/out").select("source_id", "status", "n")


_register_stream(
    "streaming_arrivals",
    f"""WITH {_DRAFT_SQL} SELECT source_id, CASE WHEN reject_reason IS NULL THEN 'valid' ELSE 'skipped' END AS status, count(DISTINCT fingerprint) AS n FROM dr GROUP BY ALL""",
    _stream_arrivals,
)


def _stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark, "stream-ledger")
    q = jobs.ledger_batches(_stream_sql(spark, "fx_decision"), _queued(spark), f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    kept = spark.read.parquet(f"{root}/out/ledger").select("event_id", "candidate_id", "sequence", "previous_status", "new_status")
    refused = spark.read.parquet(f"{root}/out/rejected").select("event_id", "candidate_id", "reject_reason")
    return kept.unionByName(refused, allowMissingColumns=True)


_register_stream(
    "streaming_ledger",
    f"""WITH {_CHECKED} SELECT event_id, candidate_id, sequence, previous_status, new_status, NULL AS reject_reason FROM chained
      UNION ALL SELECT event_id, candidate_id, NULL, NULL, NULL, reject_reason FROM checked WHERE reject_reason IS NOT NULL""",
    _stream_ledger,
)


def _in_steps(spark: SparkSession, rows: DataFrame, steps: list[str], what: str, start: Callable[[DataFrame, str], object]) -> str:
    """Land ``rows`` in steps, one condition after the other, and run the stream after each; returns its folder."""
    root = _scratch(spark, what)
    for condition in steps:
        rows.where(condition).write.mode("append").parquet(f"{root}/in")
        start(jobs.stream_files(spark, f"{root}/in", rows.schema, files_per_trigger=1_000_000), root).awaitTermination()
    return f"{root}/out"


# Four batches of arrivals; some rows come one batch after their time.
_STEP = """CASE WHEN ts < TIMESTAMP '2024-01-10 00:00:00' THEN 1 WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 2 ELSE 3 END + CASE WHEN seq % 50 = 7 THEN 1 ELSE 0 END"""
_STEPPED = f"""{_DRAFT_SQL}, b AS (SELECT *, {_STEP} AS step FROM dr),
  hi AS (SELECT step, max(max(ts)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 36 HOUR AS wm FROM b GROUP BY step),
  j AS (SELECT b.*, wm, coalesce(ts < wm, false) AS late FROM b JOIN hi ON hi.step = b.step)"""


def _stepped_arrivals(spark: SparkSession) -> str:
    rows = feeds.map_licence_rows(spark.table("fx_source_row"), keep=("ts",)).select("seq", "ts", "source_id", "fingerprint", "reject_reason")
    start = lambda s, root: jobs.windowed_arrivals(s, f"{root}/out", f"{root}/checkpoint", delay="36 hours")
    return _in_steps(spark, rows, [f"{_STEP} = {n}" for n in (1, 2, 3, 4)], "windows", start)


@query(
    "streaming_windows",
    f"""WITH {_STEPPED} SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, source_id, CASE WHEN reject_reason IS NULL THEN 'valid' ELSE 'skipped' END AS status,
      count(DISTINCT fingerprint) AS n FROM j WHERE NOT late GROUP BY ALL""",
)
def _(spark):
    return jobs.window_counts(spark, _stepped_arrivals(spark)).withColumn("window_start", F.unix_seconds("window_start"))


@query("streaming_late_rows", f"WITH {_STEPPED} SELECT seq, source_id, step - 1 AS batch, epoch_us(wm) AS watermark FROM j WHERE late")
def _(spark):
    return spark.read.parquet(f"{_stepped_arrivals(spark)}/late").select("seq", "source_id", "batch", F.unix_micros("watermark").alias("watermark"))


# A queue snapshot beside the ledger of the first days; a tenth of its rows claims to be approved.
_AFTER = "TIMESTAMP '2024-01-10 00:00:00'"


@query(
    "streaming_ledger_batches",
    f"""WITH {_CHECKED}, l AS (SELECT candidate_id, arg_max(new_status, sequence) AS s FROM chained WHERE decided_at < {_AFTER} GROUP BY 1),
    off AS (SELECT c.id FROM fx_candidate c LEFT JOIN l ON l.candidate_id = c.id WHERE c.id LIKE '%0' AND coalesce(l.s, 'pending') <> 'approved')
    SELECT event_id, candidate_id, sequence, previous_status, new_status, NULL AS reject_reason FROM chained WHERE decided_at >= {_AFTER} AND candidate_id NOT IN (SELECT id FROM off)
    UNION ALL SELECT event_id, candidate_id, NULL, NULL, NULL, coalesce(reject_reason, 'queue and ledger disagree') FROM checked
      WHERE decided_at >= {_AFTER} AND (reject_reason IS NOT NULL OR candidate_id IN (SELECT id FROM off))""",
)
def _(spark):
    past = cut_lineage(_chained(spark).where(f"decided_at < {_AFTER}").select("candidate_id", "sequence", "new_status"))
    last = past.groupBy("candidate_id").agg(F.max_by("new_status", "sequence").alias("_last"))
    said = F.when(F.col("candidate_id").endswith("0"), "approved").otherwise(F.coalesce("_last", F.lit("pending")))
    queue = _queued(spark).join(last, "candidate_id", "left").select("candidate_id", said.alias("review_status"))
    rows = spark.table("fx_decision")
    start = lambda s, root: jobs.ledger_batches(s, queue, f"{root}/out", f"{root}/checkpoint", past)
    days = [f"decided_at >= {_AFTER} AND decided_at < TIMESTAMP '2024-01-16 00:00:00'",
            "decided_at >= TIMESTAMP '2024-01-16 00:00:00' AND decided_at < TIMESTAMP '2024-01-23 00:00:00'", "decided_at >= TIMESTAMP '2024-01-23 00:00:00'"]
    out = _in_steps(spark, rows, days, "ledger-batches", start)
    kept = spark.read.parquet(f"{out}/ledger").select("event_id", "candidate_id", "sequence", "previous_status", "new_status")
    return kept.unionByName(spark.read.parquet(f"{out}/rejected").select("event_id", "candidate_id", "reject_reason"), allowMissingColumns=True)
