"""Inputs derived from the given tables, as SQL that Spark and DuckDB read alike.

Every view is built from all rows of its base table; ``%`` only spreads values.
"""

from __future__ import annotations

import re

from sitefold import session

VIEWS: dict[str, str] = {}

# One company location per part row.
VIEWS["fx_company"] = """
SELECT p_partkey AS k,
  'mst-' || lpad(CAST(p_partkey AS STRING), 7, '0') AS id,
  split_part('Alder,Birch,Copper,Dune,Ember,Fjord,Granite,Harbor,Indigo,Juniper', ',', CAST(p_partkey % 10 AS INT) + 1) || ' ' ||
  split_part('Quarry,Lantern,Meadow,Zephyr,Orchid,Pylon,Velvet,Summit,Tundra,Wharf,Kestrel', ',', CAST(p_partkey % 11 AS INT) + 1) || ' ' ||
  split_part('Dental,Freight,Bakery,Analytics,Roofing,Textiles,Optics,Plumbing,Media,Brewing,Security,Robotics,Staffing', ',', CAST(p_partkey % 13 AS INT) + 1) ||
  split_part(', Inc.; LLC; Co; & Sons; Company;', ';', CAST(p_partkey % 6 AS INT) + 1) AS company_name,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(100 + (p_partkey * 37) % 9000 AS STRING) || ' ' ||
    split_part('Elm,Regent,Mockingbird,Cole,Preston,Hillcrest,Walnut', ',', CAST(p_partkey % 7 AS INT) + 1) || ' ' ||
    split_part('Street,Road,Avenue,Boulevard,Drive', ',', CAST(p_partkey % 5 AS INT) + 1) ||
    CASE WHEN p_partkey % 3 = 0 THEN ' Suite ' || CAST(p_size AS STRING) ELSE '' END END AS address,
  'City ' || CAST(p_partkey % 25 AS STRING) AS city,
  'S' || CAST(p_partkey % 5 AS STRING) AS state,
  CAST(10000 + p_partkey % 97 AS STRING) AS postal_code,
  CASE WHEN p_partkey % 43 = 0 THEN '000-000-0000' WHEN p_partkey % 19 = 0 THEN NULL
       ELSE '214-' || lpad(CAST((p_partkey * 7) % 1000 AS STRING), 3, '0') || '-' || lpad(CAST(p_partkey % 10000 AS STRING), 4, '0') END AS phone,
  CASE WHEN p_partkey % 4 = 2 THEN NULL ELSE 'https://www.site' || CAST(p_partkey % 5000 AS STRING) || '.example.com/about' END AS website,
  lpad(CAST((p_size * 37) % 10000 AS STRING), 4, '0') AS sic_code,
  nullif(split_part('DIRE,DIRE,DIRE,DEL,RDL,RDEL,research,KEEP,RSCH,DELE,', ',', CAST(p_partkey % 11 AS INT) + 1), '') AS status,
  nullif(split_part('S,H,B,R,U, h ,single site,Q,', ',', CAST(p_partkey % 9 AS INT) + 1), '') AS site_type_code,
  p_size AS employees
FROM part
"""

# One observed location per customer row: a perturbed copy of the company with the same key.
VIEWS["fx_candidate"] = """
SELECT 'loc-' || lpad(CAST(c.c_custkey AS STRING), 7, '0') AS id, b.id AS base_id,
  CAST(c.c_custkey % 8 AS INT) AS variant,
  CASE WHEN c.c_custkey % 8 IN (4, 6) THEN 'Xqz Vyvo ' || split_part('Jux,Kwip,Lopq,Mizz,Nuxo', ',', CAST(c.c_custkey % 5 AS INT) + 1)
       WHEN c.c_custkey % 8 = 5 THEN 'Zzyx Woq ' || split_part('Ujj,Vixx,Yaqq', ',', CAST(c.c_custkey % 3 AS INT) + 1)
       WHEN c.c_custkey % 8 = 7 THEN upper(replace(b.company_name, ' ', '  ')) || ' LLC'
       ELSE coalesce(b.company_name, c.c_name) END AS legal_name,
  CASE WHEN c.c_custkey % 8 IN (0, 4, 6, 7) THEN b.address
       WHEN c.c_custkey % 8 IN (1, 2) THEN CAST(c.c_custkey AS STRING) || ' Pqx Vzz Way' ELSE NULL END AS street,
  CASE WHEN c.c_custkey % 8 IN (0, 4, 6, 7) THEN b.city ELSE 'Elsewhere' END AS city,
  CASE WHEN c.c_custkey % 8 = 7 THEN lower(b.state) WHEN c.c_custkey % 8 IN (0, 4, 6) THEN b.state ELSE 'ZZ' END AS state,
  CASE WHEN c.c_custkey % 8 = 5 THEN NULL ELSE b.postal_code END AS postal_code,
  CASE WHEN c.c_custkey % 8 IN (0, 4) THEN b.phone WHEN c.c_custkey % 8 = 7 THEN '+1 ' || b.phone ELSE NULL END AS phone,
  CASE WHEN c.c_custkey % 8 IN (0, 1, 2, 3, 4) THEN b.website
       WHEN c.c_custkey % 8 = 7 THEN replace(b.website, 'https://', 'HTTP://') ELSE NULL END AS website,
  CASE WHEN c.c_custkey % 8 IN (0, 1, 2) THEN b.sic_code ELSE NULL END AS sic_code,
  CASE WHEN c.c_custkey % 8 = 1 THEN 'branch' WHEN c.c_custkey % 8 = 2 THEN 'headquarters'
       WHEN c.c_custkey % 8 = 7 THEN 'unknown' WHEN c.c_custkey % 8 = 0 THEN 'single_site' ELSE NULL END AS site_type,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE CAST(b.employees AS DOUBLE) END AS employee_estimate,
  CASE WHEN c.c_custkey % 5 = 0 THEN 'desc' ELSE NULL END AS description,
  CASE WHEN c.c_custkey % 7 = 0 THEN NULL WHEN c.c_custkey % 7 = 1 THEN '  '
       ELSE 'Person ' || CAST(c.c_custkey AS STRING) END AS contact_name,
  CASE WHEN c.c_custkey % 4 = 0 THEN c.c_name ELSE NULL END AS alphasort,
  CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE 'office' END AS building_type,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE CAST(1950 + c.c_custkey % 70 AS INT) END AS start_year,
  CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE c.c_mktsegment END AS company_band,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS revenue,
  CASE WHEN c.c_custkey % 12 = 0 THEN NULL ELSE CAST(1 + c.c_custkey % 4 AS BIGINT) END AS total_sites,
  CASE WHEN c.c_custkey % 11 = 0 THEN 'Box City' ELSE NULL END AS mailing_city,
  CASE WHEN c.c_custkey % 13 = 0 THEN 'first.last' ELSE NULL END AS email_format,
  CASE WHEN c.c_custkey % 15 = 0 THEN 'Parent Co' ELSE NULL END AS parent_company
FROM customer c LEFT JOIN fx_company b ON b.k = c.c_custkey
"""

# Parent-to-child edges; some parents and some children are not in the directory.
VIEWS["fx_edge"] = """
SELECT k AS edge_seq, CASE WHEN k % 3 = 0 THEN 'HQTR' ELSE 'AFFL' END AS relationship_type,
  CASE WHEN k % 9 = 0 THEN 'out-' ELSE 'mst-' END || lpad(CAST(CAST(floor(k / 20) AS BIGINT) * 20 + (k % 2) AS STRING), 7, '0') AS parent_id,
  CASE WHEN k % 13 = 0 THEN 'out-' ELSE 'mst-' END || lpad(CAST(k AS STRING), 7, '0') AS child_id
FROM fx_company
"""

# Directory rows as they look before cleaning: padded, NULL/None cells, repeated and blank keys.
VIEWS["fx_directory"] = """
SELECT k AS seq,
  CASE WHEN k % 101 = 0 THEN '  ' WHEN k % 50 = 7 THEN 'mst-' || lpad(CAST(k - 7 AS STRING), 7, '0') ELSE ' ' || id || ' ' END AS location_id,
  CASE WHEN k % 97 = 0 THEN 'NULL' ELSE company_name || ' ' END AS company_name,
  coalesce(status, 'none') AS status_code, site_type_code,
  CASE WHEN k % 6 = 0 THEN 'None' ELSE address END AS address,
  CAST(k % 400 AS STRING) || ' Fallback Street' AS street, city, state, postal_code AS zip, phone, website, sic_code AS sic
FROM fx_company
"""

# One permit observation per line item.
VIEWS["fx_permit"] = """
SELECT CASE WHEN l_orderkey % 211 = 0 THEN '  ' ELSE CAST(l_orderkey AS STRING) END AS taxpayer_number,
  lpad(CAST(l_linenumber AS STRING), 3, '0') AS outlet_number,
  split_part('043,057,061,220,113,', ',', CAST(l_orderkey % 6 AS INT) + 1) AS outlet_county_code,
  l_shipdate AS outlet_permit_issue_date,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_shipdate END AS outlet_first_sales_date,
  l_returnflag || l_linestatus AS taxpayer_organization_type,
  CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 29 = 0 THEN '7' ELSE lpad(CAST((l_partkey * 7919) % 1000000 AS STRING), 6, '0') END AS outlet_naics_code,
  CASE WHEN l_partkey % 31 = 0 THEN '' ELSE 'Outlet ' || CAST(l_partkey % 50 AS STRING) || ' LLC' END AS outlet_name,
  CASE WHEN l_suppkey % 6 = 0 THEN 'Holder ' || CAST(l_suppkey AS STRING) ELSE 'OUTLET ' || CAST(l_partkey % 50 AS STRING) || ', Inc.' END AS taxpayer_name,
  CASE WHEN l_partkey % 13 = 0 THEN 'P.O. Box ' || CAST(l_partkey AS STRING) WHEN l_partkey % 11 = 0 THEN CAST(l_partkey AS STRING) || ' Elm St Apt 4'
       WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) || ' Main St' END AS outlet_address,
  'City ' || CAST(l_suppkey % 40 AS STRING) AS outlet_city,
  CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(75000 + l_suppkey AS STRING) END AS outlet_zip_code,
  nullif(split_part('I,O,inside,x,', ',', CAST(l_suppkey % 5 AS INT) + 1), '') AS outlet_inside_outside_city_limits_indicator,
  l_partkey * 100000 + l_suppkey AS tie_key, l_extendedprice AS tie_price
FROM lineitem
"""

# Raw feed rows with repeats, missing record ids, blank names and a bad date here and there.
VIEWS["fx_source_row"] = """
SELECT event_id AS seq, 'src-' || event_type AS source_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS STRING) || '-' || CAST(event_id % 20 AS STRING) END AS record_id,
  CASE WHEN event_id % 23 = 0 THEN '  ' ELSE 'Firm ' || CAST(user_id AS STRING) END AS business_name,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(user_id AS STRING) || ' Main St' END AS address,
  'City ' || CAST(user_id % 25 AS STRING) AS city, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'TX' END AS state,
  CASE WHEN user_id % 3 = 0 THEN '75' || lpad(CAST(user_id AS STRING), 3, '0') ELSE NULL END AS zip,
  CASE WHEN event_id % 4 = 0 THEN '972-555-' || lpad(CAST(user_id AS STRING), 4, '0') ELSE NULL END AS phone,
  CASE WHEN event_id % 7 = 0 THEN 'firm' || CAST(user_id AS STRING) || '.example' ELSE NULL END AS website,
  CASE WHEN event_id % 11 = 0 THEN 'many' WHEN event_id % 8 = 0 THEN '0' ELSE CAST(event_id % 300 AS STRING) END AS employees,
  CASE WHEN event_id % 29 = 0 THEN 'soon' WHEN event_id % 13 = 0 THEN NULL ELSE substr(CAST(ts AS STRING), 1, 10) END AS issued_date,
  CASE WHEN event_id % 3 = 0 THEN 'Person ' || CAST(user_id AS STRING) ELSE NULL END AS contact_name,
  CASE WHEN event_id % 9 = 0 THEN 'p' || CAST(user_id AS STRING) || '@firm.example' ELSE NULL END AS contact_email,
  CAST(NULL AS STRING) AS contact_phone,
  nullif(split_part('s,H,b,,Q,U,', ',', CAST(event_id % 7 AS INT) + 1), '') AS site_type_code,
  ts
FROM events
"""

# Reviewer actions in time order.
VIEWS["fx_decision"] = """
SELECT event_id, 'loc-' || lpad(CAST(user_id AS STRING), 7, '0') AS candidate_id, ts AS decided_at,
  'reviewer-' || CAST(user_id % 3 AS STRING) AS reviewer,
  CASE event_type WHEN 'view' THEN 'needs_more_research' WHEN 'click' THEN 'link_existing_location' WHEN 'signup' THEN 'approve_new_company'
       WHEN 'purchase' THEN 'approve_new_branch' ELSE CASE WHEN event_id % 7 = 0 THEN 'bogus_action' WHEN event_id % 7 = 1 THEN 'reject_source_observation' ELSE 'mark_duplicate' END END AS action,
  CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN ' ' ELSE 'mst-' || lpad(CAST(event_id % 100 AS STRING), 7, '0') END AS selected_id
FROM events
"""

# Ordered field proposals; the first rows per order act as evidence already present.
VIEWS["fx_proposal"] = """
SELECT l_orderkey AS candidate_id,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_discount) AS seq,
  split_part('company.sicCode,company.website,location.phone,location.buildingType', ',', CAST(l_partkey % 4 AS INT) + 1) AS path_key,
  'v' || CAST(l_suppkey % 2 AS STRING) AS value, 'p' || CAST(l_suppkey % 4 AS STRING) AS source_id,
  CASE WHEN l_quantity > 48 THEN 'human_confirmed' ELSE 'directly_observed' END AS derivation,
  l_discount AS confidence, l_linenumber <= 2 AS is_prior, l_returnflag = 'R' AS force_conflict
FROM lineitem
"""

# Current field values the proposals meet: one row per order and path, some populated.
VIEWS["fx_field_value"] = "\nUNION ALL\n".join(
    f"""SELECT o_orderkey AS candidate_id, '{path}' AS path_key,
  CASE WHEN (o_orderkey + {len(path)}) % 4 = 0 THEN 'v' || CAST(o_custkey % 2 AS STRING)
       WHEN (o_orderkey + {len(path)}) % 4 = 1 THEN '  ' ELSE NULL END AS current_value
FROM orders"""
    for path in ["company.sicCode", "company.website", "location.phone", "location.buildingType"]
)


def needed(sql: str) -> list[str]:
    """Views a query text uses, in dependency order."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in found:
                visit(VIEWS[name])
                found.append(name)

    visit(sql)
    return found


def with_views(sql: str) -> str:
    """Query text with the views it uses in front, as common table expressions."""
    names = needed(sql)
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def register(spark, sf_dir: str) -> None:
    """Base tables and derived views as temporary views of the session."""
    session.apply(spark)
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)
