"""Bucketed tables and the enrichment job."""

import pytest
from pyspark.sql import functions as F

from sitefold.operators.buckets import BucketedTable
from sitefold.plans import enrich
from sitefold.schemas import as_candidates, as_evidence


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "ledger"), "source_id string, fingerprint string, n bigint", ["source_id", "fingerprint"], buckets=32)
    rows = spark.range(4000).select(F.lit("s").alias("source_id"), F.col("id").cast("string").alias("fingerprint"), F.col("id").alias("n"))
    assert table.all().count() == 0 and table.of(rows).count() == 0
    for batch in range(3):
        table.append(rows.where(F.col("n") % 3 == batch), batch)
    table.append(rows.where(F.col("n") % 3 == 2), 2)  # repeated after a failure
    assert table.all().count() == 4000
    few = rows.where("n IN (7, 8)")
    hit = {r["bucket"] for r in few.select(table.bucket()).collect()}
    seen = table.of(few)
    assert {r["n"] for r in seen.join(few.select("fingerprint"), "fingerprint").collect()} == {7, 8}
    assert len(seen.inputFiles()) == 3 * len(hit) and all(any(f"bucket={b}/" in f for b in hit) for f in seen.inputFiles())
    small = table.compacted(str(tmp_path / "compact"))
    assert len(small.of(few).inputFiles()) == len(hit) and small.all().select("n").distinct().count() == 4000


@pytest.fixture(scope="module")
def world(spark):
    rows = [("c1", None, None), ("c2", "7372", "2145550101"), ("c3", None, None)]
    found = spark.createDataFrame(rows, "id string, sic string, phone string")
    prior = F.when(F.col("id") == "c3", F.array(_evidence("company.sicCode", "1111", "old", "human_confirmed", 1.0)))
    candidates = as_candidates(found.select("id", F.struct(F.lit("Acme").alias("legal_name"), F.col("sic").alias("sic_code")).alias("company"), "phone", prior.alias("field_evidence")))
    providers = spark.createDataFrame([("p1", 1, True, f) for f in ("company.sicCode", "location.phone")] + [("p2", 2, True, "company.sicCode"), ("p3", 3, False, "company.sicCode")],
                                      "provider_id string, position int, can_run boolean, field string")
    return candidates, providers


def _evidence(path, value, source, derivation, confidence):
    return F.struct(F.lit(path).alias("path_key"), F.lit(f'"{value}"').alias("value_json"), F.lit(confidence).alias("confidence"),
                    F.struct(F.lit("web").alias("source_type"), F.lit(source).alias("source_id")).alias("source"), F.lit(derivation).alias("derivation"))


def _answers(spark, rows):
    df = spark.createDataFrame(rows, "candidate_id string, provider_id string, provider_status string, outcome int, status string, path string, value string, source string, confidence double")
    e = F.struct(F.col("path").alias("path_key"), F.concat(F.lit('"'), "value", F.lit('"')).alias("value_json"), "confidence",
                 F.struct(F.lit("web").alias("source_type"), F.col("source").alias("source_id")).alias("source"), F.lit("directly_observed").alias("derivation"))
    return as_evidence(e, df).withColumn("item", F.lit(0))


ANSWERS = [
    ("c1", "p1", "completed", 0, "success", "company.sicCode", "7372", "a", 0.8), ("c1", "p1", "completed", 1, "success", "location.phone", "2145550101", "a", 1.7),
    ("c1", "p2", "completed", 0, "success", "company.sicCode", "7372", "b", 0.8), ("c1", "p3", "completed", 0, "success", "company.sicCode", "9999", "d", 0.8),
    ("c3", "p1", "completed", 0, "success", "company.sicCode", "2222", "a", 0.5), ("c3", "p1", "completed", 1, "conflict", "location.phone", "1", "a", 0.5),
    ("c3", "p2", "failed", 0, "success", "company.sicCode", "3333", "b", 0.5),
]


def test_a_run_asks_merges_and_appends(spark, world):
    candidates, providers = world
    done = enrich.enrich(candidates, providers, _answers(spark, ANSWERS), "r1", "2024-01-01T00:00:00.000Z")
    asked = {(r.candidate_id, r.provider_id): r for r in done.requests.collect()}
    assert set(asked) == {("c1", "p1"), ("c1", "p2"), ("c3", "p1"), ("c3", "p2")}  # nothing to ask about c2, and p3 cannot run
    assert sorted(asked["c1", "p1"].fields) == ["company.sicCode", "location.phone"] and asked["c1", "p1"].blockers
    assert [e.path_key for e in asked["c3", "p2"].existing_evidence] == ["company.sicCode"] and asked["c1", "p2"].existing_evidence == []
    assert {(r.candidate_id, r.path_key, r.source_key, r.merge_class) for r in done.merged.select("*").collect()} == {
        ("c1", "company.sicCode", '["a","web",""]', "fill"), ("c1", "company.sicCode", '["b","web",""]', "agrees"),
        ("c3", "company.sicCode", '["a","web",""]', "conflict"), ("c3", "location.phone", '["a","web",""]', "provider_conflict")}
    assert [(r.candidate_id, r.reject_reason) for r in done.refused.collect()] == [("c1", "invalid_confidence")]
    after = {r.id: r for r in done.candidates.collect()}
    assert (after["c1"].company.sic_code, after["c1"].phone, len(after["c1"].field_evidence)) == ("7372", None, 2)
    assert (after["c3"].company.sic_code, [e.value_json for e in after["c3"].field_evidence]) == (None, ['"1111"', '"2222"', '"1"'])
    assert after["c2"].company.sic_code == "7372"
    row = {r.candidate_id: r for r in done.summary.collect()}
    assert (row["c1"].filled_count, row["c1"].conflict_count, row["c3"].conflict_count, row["c2"].n_requests) == (1, 0, 2, 0)
    assert row["c1"].final_blockers == row["c1"].initial_blockers - 1


def test_a_second_run_knows_the_first_one_from_the_store(spark, world, tmp_path):
    candidates, providers = world
    store = enrich.store(spark, str(tmp_path / "evidence"), 8)
    for _ in range(2):  # a repeated run replaces itself
        enrich.enrich(candidates, providers, _answers(spark, ANSWERS), "r1", "2024-01-01T00:00:00.000Z", run=1, known=store)
    assert store.all().count() == 4
    again = enrich.enrich(candidates, providers, _answers(spark, ANSWERS), "r2", "2024-01-02T00:00:00.000Z", run=2, known=store)
    # a provider's own conflict is kept every time
    assert sorted(r.merge_class for r in again.merged.collect()) == ["provider_conflict", "repeat", "repeat", "repeat"]
    other = [("c1", "p1", "completed", 0, "success", "company.sicCode", "8888", "a", 0.8)]
    assert [r.merge_class for r in enrich.enrich(candidates, providers, _answers(spark, other), "r3", "2024-01-03T00:00:00.000Z", run=3, known=store).merged.collect()] == ["conflict"]
