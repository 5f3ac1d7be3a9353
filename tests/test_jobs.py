"""Sources, ingest, readiness, review, merge, evaluation and streams on small fixtures."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from sitefold.operators import evidence, profiling, readiness, review, tables
from sitefold.plans import decisions, evaluate, ingest, runs
from sitefold.plans.profile import profile_source
from sitefold.plans.queue import score_candidates
from sitefold.sources import feeds, master, permits
from sitefold.streaming import jobs
from tests.test_matching import MASTER, candidate_frame

LICENCES = '''license_id,business_name,address,city,state,zip,phone,website,employees,issued_date,contact_name,contact_email,contact_phone,site_type_code
90-A,,7 Quay Rd,Ostend,OR,97001,,,,2025-11-30,,,,
91-B,"Moth & ""Lamp"" Lighting",,Brindle,,,,,5d,"March 9, 2025",,,,h
92-C,Tidewater Kayaks,55 Pier Ln,Ostend,OR,97004,503-555-0143,kayaks.example,12,3/14/2025,Ines Q,ines@kayaks.example,,
93-D,"Salt, Stone and Sons",4 Kiln Way,Brindle,OR,97009,,,0,12:30,,,,
92-C,Tidewater Kayaks,55 Pier Ln,Ostend,OR,97004,503-555-0143,kayaks.example,12,3/14/2025,Ines Q,ines@kayaks.example,,
'''
FEED = [
    {"reportId": 77, "companyName": "Numbered Ltd", "state": 3},
    {"reportId": "q9", "companyName": "Pell Orchards", "siteTypeCode": "?", "employeeCount": "8", "contactEmail": "o@pell.example"},
    {"reportId": "q7", "companyName": "Cinder Forge", "city": "Brindle", "state": "OR", "employeeCount": 8, "sourceUrl": "https://news.example/q7",
     "notes": "opened", "contactName": "Abe", "contactTitle": "Smith", "publishedAt": "2025-05-02T07:30:00.000Z"},
    {"reportId": "q8", "companyName": "\t"},
    {"reportId": "q7", "companyName": "Cinder Forge"},
]


@pytest.fixture()
def drafts(spark, tmp_path):
    (tmp_path / "l.csv").write_text(LICENCES)
    (tmp_path / "f.json").write_text(json.dumps(FEED))
    csv = feeds.SOURCES["dfw-csv"](spark, str(tmp_path / "l.csv"))
    return csv, feeds.SOURCES["dfw-json"](spark, str(tmp_path / "f.json"))


def empty_ledger(spark):
    return spark.createDataFrame([], "source_id string, fingerprint string")


def test_licence_feed(drafts):
    rows = drafts[0].orderBy("seq").collect()
    assert [r.reject_reason for r in rows] == ["missing business_name", None, None, "unexpected mapping error: Invalid Date", None]
    assert rows[1].company.legal_name == 'Moth & "Lamp" Lighting' and rows[1].captured_at == "2025-03-09T00:00:00.000Z"
    assert (rows[1].site_type, rows[1].raw_site_type_code) == ("headquarters", "h") and rows[1].physical_address.street is None
    assert rows[1].employee_size_site is None and rows[3].employee_size_site is None
    assert rows[2].employee_size_site.estimate == 12 and rows[2].captured_at == "2025-03-14T00:00:00.000Z"
    assert [e.path_key.split(".")[-1] for e in rows[2].field_evidence] == [
        "legalName", "website", "name", "email", "physicalAddress", "phone", "employeeSizeSite"]
    assert rows[2].field_evidence[4].value_json == '{"street":"55 Pier Ln","city":"Ostend","state":"OR","postalCode":"97004"}'
    assert rows[2].field_evidence[6].value_json == '{"estimate":12}' and rows[2].field_evidence[0].confidence == 0.6


@pytest.mark.parametrize("text, day", [
    ("2025-01-05", "2025-01-05"), ("1/5/2025", "2025-01-05"), ("2025/1/5", "2025-01-05"), ("01-05-2025", "2025-01-05"), ("Jan 5 2025", "2025-01-05"),
    ("January 5 , 2025", "2025-01-05"), ("5 January 2025", "2025-01-05"), ("12:30", None), ("5", None), ("13/13/2025", None), ("soon", None), (" ", None), (None, None)])
def test_issue_dates(spark, text, day):
    got = spark.range(1).select(F.date_format(feeds.issue_date(F.lit(text).cast("string")), "yyyy-MM-dd").alias("d")).first().d
    assert got == day


def test_rows_of_several_files_keep_their_order(spark, tmp_path):
    for n, size in enumerate([3, 40, 1]):  # packed by size, read by name
        (tmp_path / f"f{n}.json").write_text(json.dumps([{"reportId": f"{n}-{k:02d}", "companyName": "x"} for k in range(size)]))
        (tmp_path / f"f{n}.csv").write_text("license_id,business_name\n" + "".join(f"{n}-{k:02d},x\n" for k in range(size)))
        (tmp_path / f"f{n}.jsonl").write_text("".join(json.dumps({"reportId": f"{n}-{k:02d}"}) + "\n" for k in range(size)))
    want = [f"{n}-{k:02d}" for n, size in enumerate([3, 40, 1]) for k in range(size)]
    csv = feeds.read_licence_csv(spark, str(tmp_path / "*.csv"))
    arrays = feeds.map_json_items(feeds.read_json_feed(spark, str(tmp_path / "*.json")))
    lines = feeds.map_json_items(feeds.read_json_feed(spark, str(tmp_path / "*.jsonl"), lines=True))
    for rows in (csv, arrays, lines):
        assert [r.record_id for r in rows.orderBy("seq").collect()] == want and rows.select("seq").distinct().count() == len(want)


def test_json_feed_checks_member_types(drafts):
    rows = drafts[1].orderBy("seq").collect()
    assert [r.record_id for r in rows] == [None, "q9", "q7", "q8", "q7"]
    assert rows[2].employee_size_site.estimate == 8 and rows[1].employee_size_site is None
    assert rows[2].evidence == ["DFW chamber discovery feed", "chamber report URL"]
    assert rows[2].contacts[0].title == "Smith" and rows[1].contacts == []
    assert (rows[1].site_type, rows[1].raw_site_type_code) == ("unknown", "?")
    assert rows[3].reject_reason == "missing companyName"
    assert rows[0].physical_address is not None and rows[0].physical_address.state is None


def test_ingest_is_idempotent(spark, drafts, tmp_path):
    both = drafts[0].unionByName(drafts[1], allowMissingColumns=True)
    first = ingest.ingest(both, empty_ledger(spark), "run-1", "2026-08-01T00:00:00.000Z")
    counts = {r.source_id: r.asDict() for r in first.run.collect()}
    assert counts["dfw-csv"]["raw_count"] == 5 and counts["dfw-csv"]["new_candidate_count"] == 2
    assert counts["dfw-csv"]["already_ingested_count"] == 1 and counts["dfw-csv"]["skipped_count"] == 2
    assert first.candidates.count() == 5 == first.identities.select("id").distinct().count()
    ingest.append_run(first, str(tmp_path / "store"))
    ledger = spark.read.parquet(str(tmp_path / "store/ledger_rows"))
    again = ingest.ingest(both, ledger, "run-2", "2026-08-02T00:00:00.000Z")
    assert again.candidates.count() == 0
    assert again.run.agg(F.sum("new_candidate_count")).first()[0] == 0


def test_ingested_candidates_reach_the_queue(spark, drafts):
    c = ingest.ingest(drafts[0], empty_ledger(spark), "run-1", "2026-08-01T00:00:00.000Z").candidates
    m = spark.createDataFrame([(1, "rec-1", "Unheard Of Yarns", "9 Loom Ct", "Ostend", "OR", "97001", "503-555-0199", None, None, "DIRE")], MASTER)
    rows = score_candidates(c, m, None, "k", "all").collect()
    assert {(r.resolution_outcome, r.publication_state) for r in rows} == {("likely_new_company", "blocked")}
    q = tables.upsert_queue(spark.createDataFrame([], "candidate_id string, review_status string, reviewer_note string, created_at string, review_priority double"),
                            score_candidates(c, m, None, "k").select("candidate_id", "review_priority"), "now")
    assert {r.review_status for r in q.collect()} == {"pending"}


def test_directory_scan(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "Company_Name , mill_location_id,STATUS_CODE,site_type_code,zip\nOne, 007 ,DIRE,S,00501\nTwo,8,None,B,NULL\nThree,007,DEL,,x\n\"Fo\nur\",9,RDL,H,1\n")
    rows = master.classify_records(master.read_records(spark, str(tmp_path / "r.csv"), "mill")).orderBy("seq").collect()
    assert [(r.location_id, r.row_status) for r in rows] == [("007", "valid"), ("8", "malformed"), ("007", "duplicate"), ("9", "valid")]
    assert rows[0].zip == "00501" and rows[1].zip is None and rows[3].company_name == "Fo\nur" and rows[0].phone is None
    with pytest.raises(ValueError, match="duplicate location_id"):
        master.load_unique_records(master.read_records(spark, str(tmp_path / "r.csv"), "mill"))
    with pytest.raises(master.HeaderError, match="location_id"):
        master.read_records(spark, str(tmp_path / "r.csv"), "other")


def full_candidate(spark):
    c = candidate_frame(spark, [("loc-1", "Pell Orchards", "pell.example", "0175", "2 Press Ln", "Brindle", "OR", "97009", "503-555-0110", "branch")])
    band_type = c.schema["employee_size_site"].dataType.simpleString()
    return c.withColumns({
        "company": F.col("company").withField("alphasort", F.lit("PELL ORCHARDS")).withField("start_year", F.lit(1990)),
        "building_type": F.lit("office"),
        "employee_size_site": F.from_json(F.lit('{"estimate":0}'), band_type),
        "contacts": F.from_json(F.lit('[{"id":"c1","email":"a@b.example"}]'), c.schema["contacts"].dataType.simpleString()),
    })


def test_readiness_states(spark):
    c = full_candidate(spark)
    state = lambda df: readiness.with_readiness(df).first()
    assert state(c).publication_state == "confirmed_ready"
    no_phone = state(c.withColumn("phone", F.lit("123")))
    assert no_phone.publication_state == "provisionally_ready"
    assert [r.rule_id for r in no_phone.unresolved_rules] == ["local_phone_or_exception"]
    assert state(c.withColumn("phone", F.lit("000-000-0000"))).publication_state == "confirmed_ready"
    hq = state(c.withColumn("site_type", F.lit("headquarters")))
    assert [b.rule_id for b in hq.blockers] == ["company_wide_employee_band_present", "estimated_revenue_present", "total_sites_present"]
    unknown = state(c.withColumn("site_type", F.lit(None).cast("string")))
    assert [b.rule_id for b in unknown.blockers] == ["site_type_present"] == [u.rule_id for u in unknown.unresolved_rules]
    # an estimate of zero is a known band for readiness, yet a missing size for completeness
    done = readiness.with_completeness(c).first()
    assert "location.employeeSizeSite" in done.missing_fields and done.completeness_score == 0.8


def test_decision_chain_against_a_plain_loop(spark):
    rng = random.Random(4)
    actions = ["approve_new_company", "mark_duplicate", "needs_more_research", "reject_source_observation"]
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "hot" if rng.random() < 0.4 else f"c{rng.randint(0, 5)}", start + dt.timedelta(hours=rng.randint(0, 200)), rng.choice(actions)) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id bigint, candidate_id string, decided_at timestamp, action string")
    ledger = spark.createDataFrame([("hot", 3, "mark_duplicate", "duplicate", None)], "candidate_id string, sequence bigint, action string, new_status string, notes string")
    got = {r.event_id: (r.sequence, r.previous_status, r.new_status) for r in review.chain(df, ["decided_at", "event_id"], F.to_date("decided_at"), ledger).collect()}
    status = dict(zip(actions, ["approved", "duplicate", "needs_more_research", "rejected"]))
    seen, want = {"hot": (3, "duplicate")}, {}
    for i, c, at, action in sorted(rows, key=lambda r: (r[2], r[0])):
        n, last = seen.get(c, (0, "pending"))
        seen[c] = (n + 1, status[action])
        want[i] = (n + 1, last, status[action])
    assert got == want


def fold(proposals, current):
    """Plain sequential merge of one field's proposals."""
    out, held, value = {}, [], current
    for p in proposals:
        seq, v, source, human, prior, force = p
        if prior or force:
            out[seq] = "prior" if prior else "provider_conflict"
            held.append((v, source, human))
            continue
        if (v, source) in [(h[0], h[1]) for h in held]:
            out[seq] = "repeat"
            continue
        agree, differ, confirmed = any(h[0] == v for h in held), any(h[0] != v for h in held), any(h[2] for h in held)
        if confirmed:
            out[seq] = "agrees" if agree else "conflict"
        elif differ:
            out[seq] = "conflict"
        elif not (value or "").strip():
            out[seq], value = "fill", v
        else:
            out[seq] = "agrees" if agree or value == v else "conflict"
        held.append((v, source, human))
    return out


def test_merge_against_a_plain_fold(spark):
    rng = random.Random(8)
    rows, currents, want = [], [], {}
    for field in range(150):
        current = rng.choice([None, " ", "a", "b"])
        items = [(s, rng.choice(["a", "a", "b", " "]), rng.choice("pqr"), rng.random() < 0.15, s <= rng.randint(0, 2), rng.random() < 0.1) for s in range(1, rng.randint(2, 9))]
        currents.append((field, "company.sicCode", current))
        rows += [(field, "company.sicCode", s, v, src, "human_confirmed" if h else "derived", p, f) for s, v, src, h, p, f in items]
        want |= {(field, s): c for s, c in fold(items, current).items()}
    proposals = spark.createDataFrame(rows, "candidate_id bigint, path_key string, seq bigint, value string, source_key string, derivation string, is_prior boolean, force_conflict boolean")
    current = spark.createDataFrame(currents, "candidate_id bigint, path_key string, current_value string")
    got = {(r.candidate_id, r.seq): r.merge_class for r in evidence.classify_proposals(proposals, current).collect()}
    assert got == want


def _odd_proposals(spark):
    """Fields of one to forty proposals, one of 2,000, and some without a source, a path or a value."""
    rows = spark.range(6000).select(
        F.when(F.col("id") < 2000, 7).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 150).alias("candidate_id"), "id",
        F.when(F.col("id") % 89 == 0, None).when(F.col("id") % 2 == 0, "company.sicCode").otherwise("contact.x.name").alias("path_key"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("h"))
    return rows.select(
        "candidate_id", F.col("id").alias("seq"), "path_key", F.when(F.col("h") % 7 > 0, F.concat(F.lit("v"), (F.col("h") % 3).cast("string"))).alias("value"),
        F.when(F.col("h") % 11 > 0, F.concat(F.lit("p"), (F.col("h") % 4).cast("string"))).alias("source_key"),
        F.when(F.col("h") % 50 == 1, "human_confirmed").otherwise("directly_observed").alias("derivation"),
        (F.col("h") % 13 == 0).alias("is_prior"), (F.col("h") % 17 == 0).alias("force_conflict"))


def test_merge_is_the_same_for_crowded_fields_and_keeps_rows_without_a_source(spark):
    rows = _odd_proposals(spark).localCheckpoint()
    current = spark.range(150).select(F.col("id").alias("candidate_id"), F.lit("company.sicCode").alias("path_key"), F.when(F.col("id") % 3 == 0, "v1").alias("current_value"))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    one, joins, mixed = (sorted((tuple(r) for r in evidence.classify_proposals(rows, current, crowded=n).collect()), key=key) for n in (10**6, -10**6, 500))
    assert len(one) == 6000 and one == joins == mixed
    assert {r[-1] for r in one} == {"prior", "provider_conflict", "repeat", "agrees", "conflict", "fill"}


def test_merge_deals_the_proposals_once(spark):
    rows = _odd_proposals(spark).localCheckpoint()
    current = spark.range(150).select(F.col("id").alias("candidate_id"), F.lit("company.sicCode").alias("path_key"), F.lit("v1").alias("current_value"))
    plan = evidence.classify_proposals(rows, current)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") - plan.count("SortMergeJoin") == 1 and plan.count("Join") <= 1


def test_unsupported_path_counts_as_filled_but_is_not_written(spark):
    c = full_candidate(spark)
    p = spark.createDataFrame([("loc-1", "location.buildingName", s, "x", src, "derived", False, False) for s, src in [(1, "p"), (2, "q")]],
                              "candidate_id string, path_key string, seq bigint, value string, source_key string, derivation string, is_prior boolean, force_conflict boolean")
    merged = evidence.classify_proposals(p, evidence.field_values(c))
    assert [r.merge_class for r in merged.collect()] == ["fill", "fill"]
    assert evidence.filled_values(merged).count() == 0
    assert evidence.readiness_delta(c, merged).first().filled_count == 2


def test_merge_reaches_contacts_and_addresses(spark):
    c = full_candidate(spark).withColumn("physical_address", F.lit(None).cast("struct<street:string,suite:string,city:string,state:string,postal_code:string,country:string>"))
    yard = '{"street":"2 Press Ln","city":"Brindle","state":"OR","postalCode":"97009"}'
    rows = [("contact.c1.name", "Ana Roe", "p"), ("contact.c1.name", "Ana Roe", "q"), ("contact.c1.email", "other@pell.example", "p"), ("contact.c1.email", '"a@b.example"', "q"),
            ("contact.c2.name", "Nobody", "p"), ("contact.c2.name", "Nobody", "q"), ("location.physicalAddress", yard, "p"), ("location.physicalAddress", yard.replace("postalCode", "postal_code"), "q"),
            ("company.sicCode", '"0175"', "p"), ("location.employeeSizeSite", '{"estimate":0.0}', "p")]
    p = spark.createDataFrame([("loc-1", path, k, v, s, "derived", False, False) for k, (path, v, s) in enumerate(rows)],
                              "candidate_id string, path_key string, seq bigint, value string, source_key string, derivation string, is_prior boolean, force_conflict boolean")
    merged = evidence.classify_proposals(p, evidence.field_values(c))
    assert [r.merge_class for r in merged.orderBy("seq").collect()] == ["fill", "agrees", "conflict", "conflict", "fill", "fill", "fill", "agrees", "agrees", "agrees"]
    after = evidence.set_fields(c, evidence.filled_values(merged)).first()
    assert [(x.id, x.name, x.email) for x in after.contacts] == [("c1", "Ana Roe", "a@b.example")]
    assert (after.physical_address.street, after.physical_address.postal_code) == ("2 Press Ln", "97009")


def test_research_plan_order(spark):
    c = full_candidate(spark).withColumn("company", F.col("company").withField("sic_code", F.lit(None))).withColumn("phone", F.lit(None).cast("string"))
    plan = evidence.plan_fields(readiness.with_readiness(c), list(evidence.RESEARCH_FIELDS)).orderBy("plan_order").collect()
    assert [(p.field, p.reason) for p in plan][:3] == [("company.sicCode", "blocked_field"), ("location.phone", "unresolved_field"), ("company.relationship", "optional_gap")]
    assert [p.field for p in plan if p.mandatory] == ["company.sicCode"]


def case_file(path, cases, dataset="d-1", version="1.0"):
    path.write_text(json.dumps({"datasetId": dataset, "schemaVersion": version, "cases": cases}))


FORGE = {"id": "rec-7", "companyName": "Cinder Forge LLC", "address": "31 Bellows Rd", "city": "Brindle", "state": "OR", "postalCode": "97009",
         "phone": "503-555-0177", "website": "https://cinderforge.example", "sicCode": "3462", "status": "DIRE"}


def labelled(case_id, outcome, matched=None, existing=(FORGE,), name="Cinder Forge", website="https://cinderforge.example", **candidate):
    expected = {"outcome": outcome} | ({"matchedExistingCompanyId": matched} if matched else {})
    return {"caseId": case_id, "candidate": {"id": f"seen-{case_id}", "company": {"legalName": name, "website": website}, **candidate},
            "existingCompanies": list(existing), "expected": expected, "provenance": {"source": "synthetic"}}


def test_labelled_cases_reach_every_outcome(spark, tmp_path):
    yard = {"street": "31 Bellows Rd", "city": "Brindle", "state": "OR"}
    coast = {"street": "808 Jetty Blvd", "city": "Ostend", "state": "OR"}
    stranger = {"name": "Vuq Ympt", "website": None}
    cases = [
        labelled("none-known", "likely_new_company", existing=()),
        labelled("stranger", "likely_new_company", **stranger, physicalAddress=coast),
        labelled("same-door", "ambiguous_manual_review", **stranger, physicalAddress=yard),
        labelled("two-alike", "ambiguous_manual_review", existing=(FORGE, FORGE | {"id": "rec-8", "address": "31 Bellows Road"}), physicalAddress=yard),
        labelled("new-sign", "possible_name_change", "rec-7", name="Vuq Ympt", physicalAddress=yard, phone="503-555-0177"),
        labelled("gone-west", "possible_changed_location", "rec-7", physicalAddress=coast),
        labelled("head", "new_headquarters_of_existing_company", "rec-7", physicalAddress=coast, siteType="headquarters"),
        labelled("shop", "new_branch_of_existing_company", "rec-7", physicalAddress=coast, siteType="branch"),
        labelled("by-phone", "same_existing_location", "rec-7", phone="503-555-0177", physicalAddress={"city": "Brindle", "state": "OR"}),
        labelled("by-door", "same_existing_location", "rec-7", physicalAddress=yard),
    ]
    case_file(tmp_path / "cases.json", cases)
    rows = evaluate.evaluate_files(spark, [str(tmp_path)]).collect()
    assert [(r.case_id, r.actual_outcome) for r in rows if not r.fully_correct] == []
    assert {r.case_id: r.retrieval_rank for r in rows}["by-door"] == 1 and len(rows) == 10


def test_invalid_cases_are_refused(spark, tmp_path):
    (tmp_path / "bare.json").write_text("[]")
    (tmp_path / "broken.json").write_text("{")
    case_file(tmp_path / "old.json", [], "d-2", "0.9")
    case_file(tmp_path / "z.json", [labelled("a", "likely_new_company", "ex-100"), labelled("a", "likely_new_company"), labelled("b", "elsewhere")])
    with pytest.raises(evaluate.CaseErrors) as refused:
        evaluate.evaluate_files(spark, [str(tmp_path)])
    for part in ("bare array", "not readable", "schema version", "not allowed", "repeated case id", "unknown expected outcome"):
        assert part in str(refused.value)
    assert refused.value.count == refused.value.errors.count() >= 6


def permits_frame(spark, n=300):
    rows = [(str(i % 90), f"{i % 3:03d}", "043" if i % 2 else "057", dt.datetime(2026, 7, 1) + dt.timedelta(days=i % 20), "CT" if i % 5 else None,
             f"{i % 7}{i % 10}1100", "Out LLC", f"Holder {i % 4}", "P.O. Box 1" if i % 9 == 0 else "1 Main St") for i in range(n)]
    return spark.createDataFrame(rows, "taxpayer_number string, outlet_number string, outlet_county_code string, outlet_permit_issue_date timestamp, "
                                 "taxpayer_organization_type string, outlet_naics_code string, outlet_name string, taxpayer_name string, outlet_address string"
                                 ).withColumns({c: F.lit(None).cast("string") for c in ("outlet_city", "outlet_zip_code", "outlet_first_sales_date", "outlet_inside_outside_city_limits_indicator")})


def test_sample_is_reproducible_and_meets_its_quota(spark):
    rows = permits.unique_observations(permits_frame(spark))
    a = {tuple(r) for r in profiling.pilot_sample(rows, 1, 40).collect()}
    b = {tuple(r) for r in profiling.pilot_sample(rows.repartition(7, "outlet_name"), 1, 40).collect()}
    assert a == b and len(a) == 40 and sum(r[2] == "priority_stratified" for r in a) == 28
    assert a != {tuple(r) for r in profiling.pilot_sample(rows, 2, 40).collect()}
    assert profiling.pilot_sample(rows, 1, 10_000).count() == rows.count()


def test_profile_job_writes_its_artifacts(spark, tmp_path):
    manifest = profile_source(permits_frame(spark), ("2026-07-01", "2026-07-15"), ["043", "057"], str(tmp_path), "2026-07-20", limit=50)
    counts = {r.artifact: r.row_count for r in manifest.collect()}
    assert counts["raw"] == 50 == counts["pilot-sample"] and counts["profile"] == 1
    assert (tmp_path / "pull_date=2026-07-20" / "manifest").exists()


def test_checksum_counts_equal_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    sums = [tables.content_checksum(df).first().checksum for df in (rows, rows.repartition(3), rows.distinct(), rows.where("k = 1"), rows.limit(0))]
    assert sums[0] == sums[1] and len(set(sums)) == 4 and sums[4] == "0"


def test_queue_positions_cover_every_row(spark):
    rng = random.Random(3)
    rows = [(f"c{k:03d}", rng.randint(0, 4) / 4, rng.randint(0, 9) / 9) for k in range(500)]
    got = {r.candidate_id: r.position for r in tables.queue_positions(spark.createDataFrame(rows, "candidate_id string, review_priority double, match_score double")).collect()}
    assert [c for c, _ in sorted(got.items(), key=lambda x: x[1])] == [r[0] for r in sorted(rows, key=lambda r: (-r[1], -r[2], r[0]))] and min(got.values()) == 1


def test_decisions_appended_in_batches(spark, tmp_path):
    at = dt.datetime(2025, 5, 1)
    queue = spark.createDataFrame([("a", "pending", None), ("b", "pending", None)], "candidate_id string, review_status string, reviewer_note string")
    machine = ["match_classification", "matched_id", "best_id", "resolution_outcome", "publication_state"]
    queue = queue.withColumns({c: F.lit("x") for c in machine} | {c: F.lit(0.5) for c in ("match_score", "resolution_confidence", "completeness_score", "review_priority")}
                              | {"requires_human_review": F.lit(True), "resolution_reasons": F.array(F.lit("r")), "resolution_conflicts": F.array(F.lit("c")),
                                 "blockers": F.array(F.struct(F.lit("b").alias("rule_id")))})
    schema = "event_id bigint, candidate_id string, decided_at timestamp, action string, selected_id string, notes string"
    first = spark.createDataFrame([(1, "a", at, "needs_more_research", None, "ask"), (2, "zz", at, "needs_more_research", None, None)], schema)
    second = spark.createDataFrame([(3, "a", at, "approve_new_company", None, None), (4, "b", at, "mark_duplicate", None, None)], schema)
    for _ in range(2):  # run again: nothing changes
        rows = decisions.append_decisions(first, queue, str(tmp_path), "1")
    after = review.queue_after(queue, rows)
    decisions.append_decisions(second, after, str(tmp_path), "2")
    kept = decisions.stored_ledger(first, str(tmp_path)).orderBy("sequence").collect()
    assert [(r.event_id, r.sequence, r.previous_status, r.new_status, r.notes) for r in kept] == [
        (1, 1, "pending", "needs_more_research", "ask"), (3, 2, "needs_more_research", "approved", None)]
    refused = spark.read.parquet(f"{tmp_path}/rejected").orderBy("event_id").collect()
    assert [(r.event_id, r.reject_reason) for r in refused] == [(2, "no review queue row"), (4, "record id required")]


def test_run_records(spark, drafts, tmp_path):
    root, clock = str(tmp_path), iter(f"t{k}" for k in range(99))
    tick = lambda: next(clock)

    def broken():
        assert runs.source_runs(spark, root).where("status = 'running' and finished_at is null").count() == 1
        raise OSError("feed is down")

    for k, fetch in enumerate([lambda: drafts[0], lambda: drafts[0], lambda: drafts[0].where("false"), broken, lambda: drafts[0]]):
        # The last one repeats the first run: it finds what it wrote itself, and nothing changes.
        runs.run_source(spark, root, f"run-{k % 4}", "dfw-csv", "CSV", fetch, tick)
    got = {r["run_id"]: r for r in runs.source_runs(spark, root).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"run-0": "success", "run-1": "success", "run-2": "success", "run-3": "failed"}
    counts = [tuple(got[f"run-{k}"][c] for c in runs.COUNTS) for k in range(4)]
    assert counts == [(5, 3, 2, 1, 2), (5, 3, 0, 3, 2), (0, 0, 0, 0, 0), (0, 0, 0, 0, 0)]
    assert got["run-3"]["error_message"] == "feed is down" and got["run-3"]["started_at"] == "t6" and got["run-3"]["finished_at"] == "t7"
    assert spark.read.parquet(f"{root}/candidates").count() == 2 == spark.read.parquet(f"{root}/identities").count()


def test_a_run_groups_its_drafts_once(spark, drafts, tmp_path, monkeypatch):
    # Identities and ledger are read off the candidates written, not computed from the drafts again.
    whole = runs.batch.ingest
    want = whole(drafts[0], runs.known_observations(spark, str(tmp_path), "run-0"), "run-0", "t")

    def candidates_alone(*args):
        got = whole(*args)
        got.identities = got.ledger_rows = None
        return got

    monkeypatch.setattr(runs.batch, "ingest", candidates_alone)
    done = runs.run_source(spark, str(tmp_path), "run-0", "dfw-csv", "CSV", lambda: drafts[0], lambda: "t")
    assert done["status"] == "success" and done["new_candidate_count"] == 2
    for name in ("identities", "ledger_rows"):
        kept = spark.read.parquet(f"{tmp_path}/{name}/run=run-0")
        assert sorted(map(str, kept.collect())) == sorted(map(str, getattr(want, name).collect()))


def test_corrections_stay_with_the_decision(spark, tmp_path):
    queue = spark.createDataFrame([("a", "pending", None)], "candidate_id string, review_status string, reviewer_note string")
    machine = ["match_classification", "matched_id", "best_id", "resolution_outcome", "publication_state"]
    queue = queue.withColumns({c: F.lit("x") for c in machine} | {c: F.lit(0.5) for c in ("match_score", "resolution_confidence", "completeness_score", "review_priority")}
                              | {"requires_human_review": F.lit(True), "resolution_reasons": F.array(F.lit("r")), "resolution_conflicts": F.array(F.lit("c")),
                                 "blockers": F.array(F.struct(F.lit("b").alias("rule_id")))})
    schema = ("event_id bigint, candidate_id string, decided_at timestamp, action string, selected_id string, "
              "field_corrections array<struct<path_key:string,previous_value:string,corrected_value:string,reason:string>>")
    at = dt.datetime(2025, 5, 1)
    rows = spark.createDataFrame([(1, "a", at, "needs_more_research", None, [("location.phone", None, "1", "typo"), ("location.phone", "1", "2", None)]), (2, "a", at, "needs_more_research", None, None)], schema)
    decisions.append_decisions(rows, queue, str(tmp_path), "1")
    kept = decisions.stored_ledger(rows, str(tmp_path)).orderBy("sequence").collect()
    assert [[tuple(c) for c in r.field_corrections] for r in kept] == [[("location.phone", None, "1", "typo"), ("location.phone", "1", "2", None)], []]


def test_reads_by_key(spark):
    q = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "candidate_id string, x int")
    assert [r.x for r in tables.queue_rows(q, ["a", "zz"]).collect()] == [1] and tables.queue_rows(q, []).count() == 0
    keys = spark.createDataFrame([("b",), ("b",), (None,)], "`k.k` string")
    assert [r.x for r in tables.queue_rows(q, keys).collect()] == [2]


def test_window_arguments():
    now = dt.datetime(2026, 7, 20, 5, tzinfo=dt.timezone.utc)
    assert permits.resolve_window(now=now) == ("2026-07-13", "2026-07-20")
    for bad in ({"from_": "2026-07-01"}, {"from_": "2026-7-1", "to": "2026-07-02"}, {"from_": "2026-07-02", "to": "2026-07-02"}, {"days": 0}):
        with pytest.raises(ValueError):
            permits.resolve_window(**bad)
    assert permits.parse_counties(" 043, ,061") == ["043", "061"]
    with pytest.raises(ValueError):
        permits.parse_counties(" , ")


def test_streamed_ingest_over_several_batches(spark, tmp_path):
    schema = "seq bigint, source_id string, record_id string, business_name string, city string, ts timestamp"
    at = dt.datetime(2026, 7, 1)
    for n, rows in enumerate([[(1, "s", "a", "One", "X", at), (2, "s", "a", "One", "X", at)], [(3, "s", "a", "One", "X", at), (4, "s", "b", "Two", "X", at), (5, "s", "c", " ", "X", at)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, files_per_trigger=1)
    jobs.ingest_stream(stream, feeds.map_licence_rows, str(tmp_path / "out"), str(tmp_path / "cp"), "now").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out/candidates"))
    assert sorted(r.fingerprint for r in got.select("source.fingerprint").collect()) == ["s:a", "s:b"]
    assert got.select("batch").distinct().count() == 2


def test_streamed_ingest_reads_only_the_buckets_of_its_batch(spark, tmp_path):
    ledger = jobs.dedup_ledger(spark, str(tmp_path), buckets=16)
    rows = spark.range(200).selectExpr(
        "'s' AS source_id", "concat('f', id) AS fingerprint", "'r' AS source_record_id", "'c' AS candidate_id", "'run' AS first_run_id", "'now' AS first_ingested_at"
    )
    ledger.append(rows, 0)
    batch = rows.where("fingerprint IN ('f7', 'f8')")
    assert len(ledger.of(batch).inputFiles()) <= 2 < len(ledger.all().inputFiles())
    assert ledger.of(batch).where("fingerprint IN ('f7', 'f8')").count() == 2


def _land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return jobs.stream_files(spark, path, spark.createDataFrame([], schema).schema)


def test_windows_count_once_and_keep_late_rows(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2026, 7, 1, h, m)
    schema = "seq bigint, ts timestamp, source_id string, fingerprint string, reject_reason string"
    steps = [
        [(1, at(3), "s", "a", None), (2, at(3, 20), "s", "a", None), (3, at(3, 30), "s", "b", None), (4, None, "s", "c", None), (5, at(5), "s", None, "bad")],
        # the watermark is 4:00 here: an equal time is on time, an earlier one is late
        [(6, at(4), "s", "a", None), (7, at(3, 59), "s", "z", None), (8, at(5, 30), "s", None, "bad"), (9, at(8), "s", "a", None)],
        [],
        [(10, at(7), "s", "d", None), (11, at(8, 10), "s", "a", None), (12, at(6, 59), "s", "d", None)],
    ]
    for rows in steps:
        stream = _land(spark, str(tmp_path / "in"), rows, schema)
        jobs.windowed_arrivals(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.window_start.hour, r.status): r.n for r in jobs.window_counts(spark, str(tmp_path / "out")).collect()}
    assert got == {(3, "valid"): 2, (5, "skipped"): 1, (4, "valid"): 1, (8, "valid"): 1, (7, "valid"): 1}
    late = {r.seq: r.watermark and r.watermark.hour for r in spark.read.parquet(str(tmp_path / "out/late")).collect()}
    assert late == {4: None, 7: 4, 12: 7}


def test_streamed_ledger_chains_over_batches_without_reading_the_ledger(spark, tmp_path):
    schema = "event_id bigint, candidate_id string, decided_at timestamp, action string, selected_id string"
    day = lambda n: dt.datetime(2026, 7, n)
    queue = spark.createDataFrame([("a", "approved"), ("b", "pending"), ("c", "approved"), ("d", "pending"), ("d", "approved")], "candidate_id string, review_status string")
    before = spark.createDataFrame([("a", 1, "rejected"), ("a", 2, "approved")], "candidate_id string, sequence bigint, new_status string")
    steps = [
        [(1, "a", day(1), "needs_more_research", None), (2, "c", day(1), "needs_more_research", None), (3, "x", day(1), "needs_more_research", None), (9, "d", day(1), "needs_more_research", None)],
        [(4, "a", day(2), "reject_source_observation", None), (5, "b", day(2), "approve_new_company", None), (6, "b", day(1), "needs_more_research", None)],
        [(7, "b", day(3), "mark_duplicate", None), (8, "b", day(3), "mark_duplicate", "rec-1")],
    ]
    for n, rows in enumerate(steps):
        stream = _land(spark, str(tmp_path / "in"), rows, schema)
        # a queue that says something else later does not matter for candidates that the stream knows
        jobs.ledger_batches(stream, queue if n == 0 else queue.withColumn("review_status", F.lit("?")), str(tmp_path / "out"), str(tmp_path / "cp"), before).awaitTermination()
    ledger = spark.read.parquet(str(tmp_path / "out/ledger"))
    got = {r.event_id: (r.sequence, r.previous_status, r.new_status) for r in ledger.collect()}
    assert got == {
        1: (3, "approved", "needs_more_research"), 4: (4, "needs_more_research", "rejected"), 6: (1, "pending", "needs_more_research"),
        5: (2, "needs_more_research", "approved"), 8: (3, "approved", "duplicate"),
    }
    why = {r.event_id: r.reject_reason for r in spark.read.parquet(str(tmp_path / "out/rejected")).collect()}
    assert why == {2: "queue and ledger disagree", 3: "no review queue row", 7: "record id required", 9: "queue and ledger disagree"}


def test_larger_tables_are_more_csv_files(spark):
    from oracle import queries

    path = queries._as_csv(spark.range(600_000).selectExpr("cast(id as string) as id"), "range")
    files = spark.read.option("header", True).csv(path).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 600_000 and max(r["count"] for r in files) <= 100_000


def test_artifacts_are_compressed(spark, tmp_path):
    rows = spark.createDataFrame([(f"id-{i}", "a|b") for i in range(50)], "source_record_id string, stratum string")
    line = tables.write_artifacts({"strata": rows}, str(tmp_path), "2024-02-01", {"seed": "1"}).first()
    files = list((tmp_path / "pull_date=2024-02-01" / "strata").glob("part-*"))
    assert line.row_count == 50 and files and all(f.name.endswith(".json.gz") for f in files)
