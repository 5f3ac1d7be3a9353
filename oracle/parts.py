"""Building blocks of the DuckDB check queries, written independently of the library."""

from __future__ import annotations

WS = r"[\s\x{00a0}\x{feff}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def trim(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def filled(x: str) -> str:
    return f"coalesce({trim(x)} <> '', false)"


def truthy(x: str) -> str:
    return f"coalesce({x} <> '', false)"


def field(x: str) -> str:
    return f"nullif({trim(x)}, '')"


def name(x: str) -> str:
    words = f"regexp_replace(regexp_replace(lower({x}), '&', ' and ', 'g'), '[^a-z0-9]', ' ', 'g')"
    bare = rf"regexp_replace({words}, '\b(inc|incorporated|llc|corp|corporation|co|company|ltd|limited|pllc|lp)\b', '', 'g')"
    return rf"coalesce(trim(regexp_replace({bare}, '\s+', ' ', 'g')), '')"


def addr(x: str) -> str:
    out = f"lower({x})"
    for word, short in [("street", "st"), ("road", "rd"), ("avenue", "ave"), ("boulevard", "blvd"), ("drive", "dr"), ("suite", "ste")]:
        out = rf"regexp_replace({out}, '\b{word}\b', '{short}', 'g')"
    return rf"coalesce(trim(regexp_replace(regexp_replace({out}, '[^a-z0-9]', ' ', 'g'), '\s+', ' ', 'g')), '')"


def phone(x: str) -> str:
    return f"coalesce(right(regexp_replace({x}, '[^0-9]', '', 'g'), 10), '')"


def domain(x: str) -> str:
    rest = rf"regexp_replace({trim(x)}, '^https?://', '', 'i')"
    authority = rf"regexp_extract({rest}, '^[/\\]*([^/?#\\]*)', 1)"
    host = rf"lower(regexp_replace(regexp_replace({authority}, '^.*@', ''), ':[0-9]*$', ''))"
    cut = r"regexp_extract(regexp_replace(lower(X), '^www\.', ''), '^[^/]*', 0)".replace("X", x)
    ok = rf"regexp_matches({host}, '^[^\x00-\x20#/:<>?@\[\\\]^|%\x7f]+$')"
    return rf"CASE WHEN NOT {truthy(x)} THEN '' WHEN {ok} THEN regexp_replace({host}, '^www\.', '') ELSE {cut} END"


def grams(x: str) -> str:
    return f"CASE WHEN {x} <> '' THEN list_distinct([substr(' ' || {x} || ' ', i, 2) FOR i IN range(1, length({x}) + 2)]) END"


def dice(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN CAST(0 AS DOUBLE) ELSE "
        f"CAST(2 AS DOUBLE) * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END"
    )


def d(x: float | str) -> str:
    return f"CAST({x} AS DOUBLE)"


def fixed4(x: str) -> str:
    """Round by the exact binary value: the product as a decimal of full width decides ties."""
    p, t = f"(({x}) * {d(10000)})", f"({d(134217729)} * ({x}))"
    hi = f"({t} - ({t} - ({x})))"
    e = f"(({hi} * {d(10000)} - {p}) + (({x}) - {hi}) * {d(10000)})"
    return f"((floor({p}) + CASE WHEN (({p} - floor({p})) - {d(0.5)}) + {e} >= 0 THEN {d(1)} ELSE {d(0)} END) / {d(10000)})"


CODES = {"S": "single_site", "H": "headquarters", "B": "branch", "R": "regional_headquarters", "U": "unknown"}


def site_name(x: str) -> str:
    """Normalised site type, null when not recognised."""
    t = trim(x)
    whens = " ".join(f"WHEN upper({t}) = '{k}' THEN '{v}'" for k, v in CODES.items())
    names = ", ".join(f"'{v}'" for v in CODES.values())
    snake = rf"regexp_replace(lower({t}), '\s+', '_', 'g')"
    return f"CASE {whens} WHEN {snake} IN ({names}) THEN {snake} END"


def life_name(x: str) -> str:
    t = trim(x)
    return (
        f"CASE WHEN upper({t}) = 'DIRE' THEN 'published' WHEN upper({t}) IN ('DEL', 'DELE') THEN 'deleted' "
        f"WHEN upper({t}) IN ('RDL', 'RDEL') THEN 'research_deleted' WHEN upper({t}) IN ('RESEARCH', 'RSCH') THEN 'research' "
        f"WHEN lower({t}) IN ('published', 'research', 'deleted', 'research_deleted') THEN lower({t}) END"
    )


# ------------------------------------------------------------------ matching

_both_c = f"{truthy('city')} AND {truthy('state')}"
KEYS = f"""
ck0 AS (SELECT id AS candidate_id, site_type, nullif({name('legal_name')}, '') AS c_name, nullif({addr('street')}, '') AS c_addr,
  nullif({phone('phone')}, '') AS c_phone, nullif({domain('website')}, '') AS c_domain, nullif(sic_code, '') AS c_sic,
  CASE WHEN {_both_c} THEN lower({trim('city')}) END AS c_city, CASE WHEN {_both_c} THEN lower({trim('state')}) END AS c_state,
  nullif({trim('postal_code')}, '') AS c_zip FROM fx_candidate),
ck AS MATERIALIZED (SELECT *, {grams('c_name')} AS c_ng, {grams('c_addr')} AS c_ag FROM ck0),
mk0 AS (SELECT id AS master_id, k AS pos, nullif({name('company_name')}, '') AS m_name, nullif({addr('address')}, '') AS m_addr,
  nullif({phone('phone')}, '') AS m_phone, nullif({domain('website')}, '') AS m_domain, nullif(sic_code, '') AS m_sic,
  CASE WHEN {_both_c} THEN lower({trim('city')}) END AS m_city, CASE WHEN {_both_c} THEN lower({trim('state')}) END AS m_state,
  nullif(postal_code, '') AS m_zip, coalesce({life_name('status')}, 'unknown') AS m_lifecycle FROM fx_company),
mk AS MATERIALIZED (SELECT *, {grams('m_name')} AS m_ng, {grams('m_addr')} AS m_ag FROM mk0)
"""

HITS_EXACT = """
exact_hits AS (
  SELECT candidate_id, master_id, pos, 1 AS signal FROM ck JOIN mk ON c_phone = m_phone
  UNION ALL SELECT candidate_id, master_id, pos, 2 FROM ck JOIN mk ON c_domain = m_domain
  UNION ALL SELECT candidate_id, master_id, pos, 3 FROM ck JOIN mk ON c_addr = m_addr
  UNION ALL SELECT candidate_id, master_id, pos, 6 FROM ck JOIN mk ON c_name = m_name)
"""
HITS_SIMILAR = f"""
similar_hits AS (
  SELECT candidate_id, master_id, pos, 4 AS signal FROM ck JOIN mk ON c_zip = m_zip WHERE {dice('c_ng', 'm_ng')} >= {d(0.55)}
  UNION ALL SELECT candidate_id, master_id, pos, 5 FROM ck JOIN mk ON c_city = m_city AND c_state = m_state WHERE {dice('c_ng', 'm_ng')} >= {d(0.55)})
"""
FIRST_HITS = """
first_hits AS (SELECT candidate_id, master_id, min(signal) AS signal, min(pos) AS pos
  FROM (SELECT * FROM exact_hits UNION ALL SELECT * FROM similar_hits) GROUP BY 1, 2),
hits AS (SELECT candidate_id, master_id, slot FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY signal, pos) AS slot
  FROM first_hits) WHERE slot <= 25)
"""
EXPANDED = """
known_child AS (SELECT parent_id, child_id, min(edge_seq) AS edge_seq FROM fx_edge WHERE child_id IN (SELECT master_id FROM mk) GROUP BY 1, 2),
first_parent AS (SELECT child_id, arg_min(parent_id, edge_seq) AS parent_id FROM fx_edge GROUP BY 1),
steps AS (
  SELECT candidate_id, master_id, 0 AS related, slot, 0 AS kind, 0 AS edge_seq FROM hits
  UNION ALL SELECT h.candidate_id, c.child_id, 1, h.slot, 1, c.edge_seq FROM hits h JOIN known_child c ON c.parent_id = h.master_id
  UNION ALL SELECT h.candidate_id, p.parent_id, 1, h.slot, 2, 0 FROM hits h JOIN first_parent p ON p.child_id = h.master_id
    WHERE p.parent_id IN (SELECT master_id FROM mk)),
first_steps AS (SELECT *, row_number() OVER (PARTITION BY candidate_id, master_id ORDER BY related, slot, kind, edge_seq) AS n FROM steps),
retrieved AS (SELECT candidate_id, master_id, slot FROM (SELECT candidate_id, master_id,
    row_number() OVER (PARTITION BY candidate_id ORDER BY related, slot, kind, edge_seq) AS slot FROM first_steps WHERE n = 1)
  WHERE slot <= 25)
"""
RETRIEVED_PAIRS = "pairs AS (SELECT ck.*, mk.* FROM retrieved JOIN ck USING (candidate_id) JOIN mk USING (master_id))"
ALL_PAIRS = "pairs AS (SELECT ck.*, mk.* FROM ck CROSS JOIN mk)"


def eq(a: str, b: str) -> str:
    return f"coalesce({a} = {b}, false)"


SCORED = f"""
evidence AS MATERIALIZED (SELECT candidate_id, site_type, master_id, m_lifecycle, {dice('c_ng', 'm_ng')} AS name_score, {dice('c_ag', 'm_ag')} AS address_score,
  {eq('c_phone', 'm_phone')} AS phone_match, {eq('c_domain', 'm_domain')} AS domain_match, {eq('c_sic', 'm_sic')} AS sic_match,
  {eq('c_city', 'm_city')} AND {eq('c_state', 'm_state')} AS city_state_match FROM pairs),
weighted AS (SELECT *, name_score * {d(0.5)} + address_score * {d(0.3)} + CASE WHEN phone_match THEN {d(0.15)} ELSE {d(0)} END
  + CASE WHEN domain_match THEN {d(0.05)} ELSE {d(0)} END AS w FROM evidence),
lifted AS (SELECT *, greatest(w, CASE WHEN phone_match AND name_score >= {d(0.65)} THEN {d(0.93)} ELSE {d(0)} END,
  CASE WHEN domain_match AND name_score >= {d(0.8)} THEN {d(0.9)} ELSE {d(0)} END) AS r FROM weighted),
scored AS (SELECT *, CASE WHEN score >= {d(0.9)} THEN 'likely_duplicate' WHEN score >= {d(0.68)} THEN 'possible_duplicate' ELSE 'likely_new' END AS classification,
  name_score >= {d(0.85)} OR ((domain_match OR sic_match) AND name_score >= {d(0.7)}) AS strong_company
  FROM (SELECT *, least({d(1)}, {fixed4('r')}) AS score FROM lifted)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY score DESC, address_score DESC, name_score DESC, master_id) AS rnk FROM scored)
"""

REASONS = f"""concat_ws('|', CASE WHEN phone_match THEN 'exact phone match' END, CASE WHEN domain_match THEN 'exact website domain match' END,
  CASE WHEN sic_match THEN 'matching SIC code' END, CASE WHEN city_state_match THEN 'matching city/state' END,
  CASE WHEN name_score >= {d(0.9)} THEN 'very similar normalized company name' WHEN name_score >= {d(0.7)} THEN 'similar normalized company name' END,
  CASE WHEN address_score >= {d(0.9)} THEN 'very similar normalized address' WHEN address_score >= {d(0.7)} THEN 'similar normalized address' END)"""

DECIDED = f"""
tops AS (SELECT * FROM ranked WHERE rnk = 1),
seconds AS (SELECT candidate_id, score AS second_score, master_id AS second_id FROM ranked WHERE rnk = 2),
strong AS (SELECT candidate_id, count(*) AS n_strong FROM ranked WHERE strong_company GROUP BY 1),
base AS (SELECT c.id AS candidate_id, c.site_type AS site, t.* EXCLUDE (candidate_id, site_type), s.second_score, coalesce(g.n_strong, 0) AS n_strong,
  t.address_score >= {d(0.85)} OR (t.phone_match AND t.city_state_match) OR (t.address_score >= {d(0.6)} AND t.city_state_match) AS strong_location
  FROM fx_candidate c LEFT JOIN tops t ON t.candidate_id = c.id LEFT JOIN seconds s ON s.candidate_id = c.id LEFT JOIN strong g ON g.candidate_id = c.id),
placed AS (SELECT *, CASE WHEN master_id IS NULL THEN 0
  WHEN second_score >= {d(0.3)} AND score >= {d(0.3)} AND score - second_score < {d(0.05)} THEN 1
  WHEN strong_company AND strong_location THEN 2
  WHEN strong_company AND site = 'branch' THEN 3 WHEN strong_company AND site = 'headquarters' THEN 4
  WHEN strong_company AND n_strong >= 2 THEN 5 WHEN strong_company THEN 6
  WHEN strong_location AND name_score < {d(0.5)} AND (domain_match OR phone_match) THEN 7
  WHEN strong_location THEN 8 WHEN score < {d(0.3)} THEN 9 ELSE 10 END AS b FROM base),
flagged AS (SELECT *, m_lifecycle IN ('deleted', 'research_deleted') AS gone,
  CASE WHEN b = 2 THEN m_lifecycle IN ('deleted', 'research_deleted') ELSE b NOT IN (0, 3, 9) END AS requires_human_review FROM placed),
decided AS (SELECT candidate_id, b, score, master_id, classification, requires_human_review,
  CASE WHEN b IN (0, 9) THEN 'likely_new_company' WHEN b = 2 THEN 'same_existing_location' WHEN b = 3 THEN 'new_branch_of_existing_company'
    WHEN b = 4 THEN 'new_headquarters_of_existing_company' WHEN b = 6 THEN 'possible_changed_location' WHEN b = 7 THEN 'possible_name_change'
    ELSE 'ambiguous_manual_review' END AS outcome,
  CASE WHEN b = 0 THEN {d(1)} WHEN requires_human_review THEN least(score, {d(0.6)}) ELSE score END AS decision_confidence,
  CASE WHEN b IN (2, 3, 4, 6, 7) THEN master_id END AS matched_id,
  CASE WHEN b = 0 THEN 'no_existing_locations_to_compare' WHEN b = 9 THEN 'weak_or_no_match_evidence' ELSE
    concat_ws('|', CASE WHEN domain_match THEN 'exact_domain_match' END, CASE WHEN sic_match THEN 'sic_match' END,
    CASE WHEN name_score >= {d(0.85)} THEN 'strong_company_name_match' WHEN name_score >= {d(0.7)} THEN 'similar_company_name_match' END,
    CASE WHEN address_score >= {d(0.85)} THEN 'exact_normalized_address_match' WHEN address_score >= {d(0.6)} THEN 'strong_normalized_address_match' END,
    CASE WHEN phone_match THEN 'exact_phone_match' END, CASE WHEN city_state_match THEN 'city_state_match' END,
    CASE WHEN b = 3 THEN 'candidate_site_type_branch' WHEN b = 4 THEN 'candidate_site_type_headquarters'
      WHEN b = 6 AND site = 'unknown' THEN 'candidate_site_type_unknown' WHEN b = 6 THEN 'candidate_site_type_missing' END,
    CASE WHEN b IN (3, 4) THEN 'existing_company_other_location_found' END) END AS reasons,
  CASE WHEN b IN (1, 5) THEN 'multiple_close_existing_location_matches'
    WHEN b = 2 AND m_lifecycle = 'deleted' THEN 'existing_location_is_deleted'
    WHEN b = 2 AND m_lifecycle = 'research_deleted' THEN 'existing_location_is_research_deleted'
    WHEN b = 6 AND address_score < {d(0.6)} THEN 'candidate_address_differs_from_best_existing_location'
    WHEN b IN (7, 8) THEN 'company_name_materially_different' ELSE '' END AS conflicts,
  CASE WHEN b = 0 THEN 'no comparison records available' ELSE {REASONS} END AS match_reasons
  FROM flagged)
"""

RETRIEVAL = ",".join([KEYS, HITS_EXACT, HITS_SIMILAR, FIRST_HITS, EXPANDED, RETRIEVED_PAIRS, SCORED])
EXHAUSTIVE = ",".join([KEYS, ALL_PAIRS, SCORED])

# ------------------------------------------------- readiness, completeness

_phone_len = f"length({phone('phone')}) = 10"
_address_ok = (
    f"({filled('street')} AND {filled('city')} AND {filled('state')} AND {filled('postal_code')}) "
    f"OR ({filled('postal_code')} AND {filled('mailing_city')})"
)
READINESS = f"""
facts AS (SELECT *, {_phone_len} AS phone_ok, {_address_ok} AS address_ok, {filled('contact_name')} AS contact_ok,
  coalesce(site_type <> 'unknown', false) AS site_ok, coalesce(site_type IN ('single_site', 'headquarters'), false) AS corporate FROM fx_candidate),
assessed AS (SELECT id AS candidate_id,
  concat_ws('|', CASE WHEN NOT {filled('legal_name')} THEN 'company_name_present' END, CASE WHEN NOT {filled('alphasort')} THEN 'alphasort_present' END,
    CASE WHEN NOT address_ok THEN 'physical_address_or_exception' END, CASE WHEN NOT phone_ok AND NOT address_ok THEN 'local_phone_or_exception' END,
    CASE WHEN NOT {filled('building_type')} THEN 'building_type_present' END, CASE WHEN NOT site_ok THEN 'site_type_present' END,
    CASE WHEN employee_estimate IS NULL THEN 'site_employee_band_present' END, CASE WHEN start_year IS NULL THEN 'start_year_present' END,
    CASE WHEN NOT {filled('sic_code')} THEN 'sic_code_present' END, CASE WHEN NOT contact_ok THEN 'min_one_contact' END,
    CASE WHEN corporate AND NOT {filled('company_band')} THEN 'company_wide_employee_band_present' END,
    CASE WHEN corporate AND revenue IS NULL THEN 'estimated_revenue_present' END,
    CASE WHEN corporate AND total_sites IS NULL THEN 'total_sites_present' END) AS blockers,
  concat_ws('|', CASE WHEN NOT phone_ok AND address_ok THEN 'local_phone_or_exception' END, CASE WHEN NOT site_ok THEN 'site_type_present' END) AS unresolved,
  concat_ws('|', CASE WHEN {filled('legal_name')} THEN 'company_name_present' END, CASE WHEN {filled('alphasort')} THEN 'alphasort_present' END,
    CASE WHEN address_ok THEN 'physical_address_or_exception' END, CASE WHEN phone_ok THEN 'local_phone_or_exception' END,
    CASE WHEN {filled('building_type')} THEN 'building_type_present' END, CASE WHEN site_ok THEN 'site_type_present' END,
    CASE WHEN employee_estimate IS NOT NULL THEN 'site_employee_band_present' END, CASE WHEN start_year IS NOT NULL THEN 'start_year_present' END,
    CASE WHEN {filled('sic_code')} THEN 'sic_code_present' END, CASE WHEN contact_ok THEN 'min_one_contact' END,
    CASE WHEN corporate AND {filled('company_band')} THEN 'company_wide_employee_band_present' END,
    CASE WHEN corporate AND revenue IS NOT NULL THEN 'estimated_revenue_present' END,
    CASE WHEN corporate AND total_sites IS NOT NULL THEN 'total_sites_present' END) AS satisfied,
  concat_ws('|', CASE WHEN NOT {filled('email_format')} THEN 'company.emailFormat' END,
    CASE WHEN NOT {filled('parent_company')} THEN 'company.relationship' END) AS optional_missing FROM facts),
readiness AS (SELECT *, CASE WHEN blockers <> '' THEN 'blocked' WHEN unresolved <> '' THEN 'provisionally_ready' ELSE 'confirmed_ready' END AS publication_state FROM assessed)
"""

_checks = [
    ("company.legalName", 0.2, truthy("legal_name")), ("location.physicalAddress", 0.15, truthy("street")),
    ("location.phone", 0.15, truthy("phone")), ("company.website", 0.1, truthy("website")),
    ("location.employeeSizeSite", 0.1, "coalesce(employee_estimate <> 0, false)"), ("location.description", 0.1, truthy("description")),
    ("company.sicCode", 0.1, truthy("sic_code")), ("contacts", 0.1, filled("contact_name")),
]
_sum = " + ".join(f"CASE WHEN {c} THEN {d(w)} ELSE {d(0)} END" for _, w, c in _checks)
_present = ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, _, c in _checks)
_missing = ", ".join(f"CASE WHEN NOT {c} THEN '{f}' END" for f, _, c in _checks)
COMPLETENESS = f"""
added AS (SELECT id AS candidate_id, {d(0)} + {_sum} AS x, concat_ws('|', {_present}) AS present_fields, concat_ws('|', {_missing}) AS missing_fields,
  employee_estimate AS n, site_type FROM fx_candidate),
completeness AS (SELECT *, {fixed4('x')} AS completeness_score FROM added)
"""
PRIORITY = f"""
bonus AS (SELECT c.candidate_id, c.completeness_score, d.classification, coalesce(n BETWEEN 10 AND 99, false) AS core, n,
  coalesce(c.site_type IN ('single_site', 'headquarters'), true) AS core_site
  FROM completeness c JOIN (SELECT candidate_id, coalesce(classification, 'likely_new') AS classification FROM decided) d USING (candidate_id)),
summed AS (SELECT *, greatest({d(0)}, least({d(1)}, completeness_score * {d(0.45)} + CASE WHEN classification = 'likely_new' THEN {d(0.35)} ELSE {d(0)} END
  + CASE WHEN core AND core_site THEN {d(0.2)} ELSE {d(0)} END + CASE WHEN NOT core AND n >= 4 THEN {d(0.05)} ELSE {d(0)} END
  - CASE WHEN classification = 'possible_duplicate' THEN {d(0.15)} ELSE {d(0)} END)) AS x FROM bonus),
priority AS (SELECT *, {fixed4('x')} AS review_priority FROM summed)
"""
_QUEUE = ",".join([DECIDED, READINESS, COMPLETENESS, PRIORITY]) + f""",
queue AS (SELECT candidate_id, d.master_id AS best_id, coalesce(d.score, {d(0)}) AS match_score, coalesce(d.classification, 'likely_new') AS match_classification,
  match_reasons, outcome AS resolution_outcome, decision_confidence AS resolution_confidence, reasons AS resolution_reasons,
  conflicts AS resolution_conflicts, matched_id, requires_human_review, p.completeness_score, r.publication_state, r.blockers, p.review_priority
  FROM decided d JOIN readiness r USING (candidate_id) JOIN priority p USING (candidate_id))
"""
QUEUE, QUEUE_ALL = f"{RETRIEVAL}, {_QUEUE}", f"{EXHAUSTIVE}, {_QUEUE}"
