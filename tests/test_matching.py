"""Similarity join, retrieval and ranking against brute force in plain Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sitefold.operators import evaluation, matching, policy, tables
from sitefold.operators.similarity import similar_values
from sitefold.plans.queue import score_candidates
from sitefold.schemas import as_candidates
from tests.test_text import plain_dice

MASTER = "k bigint, id string, company_name string, address string, city string, state string, postal_code string, phone string, website string, sic_code string, status string"


def candidate_frame(spark, rows):
    df = spark.createDataFrame(
        rows, "id string, name string, website string, sic string, street string, city string, state string, zip string, phone string, site_type string")
    return as_candidates(df.select(
        "id", F.struct(F.col("name").alias("legal_name"), "website", F.col("sic").alias("sic_code")).alias("company"),
        F.struct("street", "city", "state", F.col("zip").alias("postal_code")).alias("physical_address"), "phone", "site_type"))


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.55, 0.7, 0.9])
def test_similarity_join_is_complete(spark, threshold):
    rng = random.Random(11)
    words = ["alder", "birch", "optics", "media", "zz", "9", "qx", "harbor", "a"]
    names = sorted({" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(60)})
    left = spark.createDataFrame([(n,) for n in names[::2]], "a string")
    right = spark.createDataFrame([(n,) for n in names], "b string")
    got = {(r.l_value, r.r_value): r.similarity for r in similar_values(left, "a", right, "b", threshold).collect()}
    want = {(a, b): plain_dice(a, b) for a, b in itertools.product(names[::2], names)}
    assert got == {k: v for k, v in want.items() if (v >= threshold if threshold else v > 0)}


def test_similarity_join_within_keys(spark):
    left = spark.createDataFrame([("x", "acme one"), ("y", "acme one")], "k string, a string")
    right = spark.createDataFrame([("x", "acme one"), ("z", "acme one")], "k string, b string")
    assert [(r.k, r.l_value) for r in similar_values(left, "a", right, "b", 0.5, ["k"]).collect()] == [("x", "acme one")]


def brute_rank(cands, masters, k):
    """Scores every pair; names and addresses are given in normal form."""
    out = {}
    for c in cands:
        rows = []
        for m in masters:
            n, a = plain_dice(c["name"], m["name"]), plain_dice(c["street"], m["street"])
            phone = bool(c["phone"] and c["phone"] == m["phone"])
            domain = bool(c["web"] and c["web"] == m["web"])
            s = n * 0.5 + a * 0.3 + (0.15 if phone else 0) + (0.05 if domain else 0)
            if phone and n >= 0.65:
                s = max(s, 0.93)
            if domain and n >= 0.8:
                s = max(s, 0.9)
            rows.append((-min(1.0, float(f"{s:.4f}")), -a, -n, m["id"]))
        out[c["id"]] = [r[3] for r in sorted(rows)[:k]]
    return out


def random_world(seed, n_c, n_m):
    rng = random.Random(seed)
    words = ["alder", "birch", "copper", "quarry", "optics", "media", "qzx", "7"]
    streets = ["1 elm st", "2 elm st", "77 oak rd", "5 q", "", ""]

    def entity(prefix, i):
        hot = rng.random() < 0.33  # a third share one name and the placeholder phone
        return {
            "id": f"{prefix}-{i:04d}", "name": "alder optics" if hot else " ".join(rng.choices(words, k=rng.randint(1, 3))),
            "street": rng.choice(streets), "phone": "0000000000" if hot else rng.choice(["", "2145550101", "2145550102"]),
            "web": rng.choice(["", "", "a.example", "b.example"]),
        }

    return [entity("loc", i) for i in range(n_c)], [entity("mst", i) for i in range(n_m)]


def frames(spark, cands, masters):
    c = candidate_frame(spark, [
        (x["id"], x["name"], x["web"] or None, None, x["street"] or None, None, None, None, x["phone"] or None, None) for x in cands])
    m = spark.createDataFrame([
        (i, x["id"], x["name"], x["street"] or None, None, None, None, x["phone"] or None, x["web"] or None, None, "DIRE")
        for i, x in enumerate(masters)], MASTER)
    return c, m


@pytest.mark.parametrize("seed,n_m", [(1, 60), (2, 2)])
def test_rank_all_equals_brute_force(spark, seed, n_m):
    cands, masters = random_world(seed, 25, n_m)
    cands.append({"id": "loc-none", "name": "ww yy", "street": "", "phone": "", "web": ""})
    c, m = frames(spark, cands, masters)
    got = {}
    for r in matching.rank_all(c, m, 3).orderBy("candidate_id", "rank").collect():
        got.setdefault(r.candidate_id, []).append(r.master_id)
    assert got == brute_rank(cands, masters, 3)


def test_rank_does_not_depend_on_input_order(spark):
    cands, masters = random_world(5, 10, 30)
    a = matching.rank_all(*frames(spark, cands, masters)).select("candidate_id", "rank", "master_id").collect()
    b = matching.rank_all(*frames(spark, cands[::-1], masters[::-1])).select("candidate_id", "rank", "master_id").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_rank_all_makes_few_rows_where_all_addresses_are_alike(spark, monkeypatch):
    masters = [{"id": f"mst-{i:04d}", "name": f"alder {i % 40} optics", "street": f"{100 + i * 37 % 9000} elm {'st' if i % 2 else 'rd'}", "phone": "", "web": ""} for i in range(2000)]
    cands = [{"id": f"loc-{i:02d}", "name": "xqz vyvo", "street": masters[i * 31]["street"], "phone": "", "web": ""} for i in range(40)]
    c, m = frames(spark, cands, masters)
    made, score_pairs, similar_sets = [], matching.score_pairs, matching.similar_sets

    def scored(pairs, *more):
        made.append(pairs.count())
        return score_pairs(pairs, *more)

    def similar(*args, **more):
        found = similar_sets(*args, **more)
        made.append(found.count())
        return found

    monkeypatch.setattr(matching, "score_pairs", scored)
    monkeypatch.setattr(matching, "similar_sets", similar)
    got = {}
    for r in matching.rank_all(c, m, 3).orderBy("candidate_id", "rank").collect():
        got.setdefault(r.candidate_id, []).append(r.master_id)
    assert got == brute_rank(cands, masters, 3)
    # All pairs are 80,000. Many records here are equally far from a profile, and those that reach its bound are scored.
    assert sum(made) < 40_000


def test_labelled_cases_are_scored_once(spark):
    c = candidate_frame(spark, [("loc-1", "alder optics", None, None, "1 elm st", None, None, None, None, None)])
    cases = c.select(F.lit("set").alias("dataset_id"), F.lit("case").alias("case_id"), F.struct("company", "physical_address", "phone", "site_type").alias("candidate"),
                     F.lit("possible_changed_location").alias("expected_outcome"), F.lit("m1").alias("expected_id"), F.lit(None).cast("string").alias("reviewer"), F.lit(None).cast("string").alias("notes"))
    m = spark.createDataFrame([(i, f"m{i}", n, None, None, None, None, None, None, None, None) for i, n in enumerate(["birch media", "alder optics", "alder"])], MASTER)
    found = evaluation.evaluate_cases(cases, m.withColumns({"dataset_id": F.lit("set"), "case_id": F.lit("case")}))
    assert [(r.actual_id, r.retrieval_rank) for r in found.collect()] == [("m1", 1)]
    # Neither a bit set nor a normalised name of the records is left to be made by the two steps that read the ranking.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftleft" not in plan and "m_name" not in plan


def test_hot_key_is_cut_at_the_cap(spark):
    masters = [(i, f"mst-{i:04d}", f"firm {i}", None, None, None, None, "000-000-0000", None, None, "DIRE") for i in range(60)]
    m = spark.createDataFrame(masters, MASTER)
    c = candidate_frame(spark, [("loc-1", "someone else", None, None, None, None, None, None, "0000000000", None)])
    rows = matching.retrieve(matching.candidate_keys(c), matching.master_keys(m, "k")).orderBy("slot").collect()
    assert [r.master_id for r in rows] == [f"mst-{i:04d}" for i in range(25)]


def test_queue_finds_the_row_past_the_cap(spark):
    masters = [(i, f"mst-{i:04d}", f"firm {i}", None, None, None, None, "000-000-0000", None, None, "DIRE") for i in range(40)]
    masters.append((40, "right", "alder optics works", None, None, None, None, "000-000-0000", None, None, "DIRE"))
    m = spark.createDataFrame(masters, MASTER)
    c = candidate_frame(spark, [("loc-1", "alder optics", None, None, None, None, None, None, "0000000000", None)])
    row = score_candidates(c, m, None, "k").collect()[0]
    assert (row.best_id, row.truncated) == ("right", False)


def test_relationship_expansion(spark):
    m = spark.createDataFrame(
        [(i, f"m{i}", n, None, None, None, None, None, None, None, None) for i, n in enumerate(["acme", "kid one", "kid two", "head"])], MASTER)
    edges = spark.createDataFrame(
        [(1, "m0", "m2"), (2, "m0", "m1"), (3, "m0", "gone"), (4, "m3", "m0"), (5, "m1", "m0"), (6, "m0", "m2")],
        "edge_seq bigint, parent_id string, child_id string")
    c = candidate_frame(spark, [("loc-1", "acme", None, None, None, None, None, None, None, None), ("loc-2", "nobody", None, None, None, None, None, None, None, None)])
    rows = matching.retrieve(matching.candidate_keys(c), matching.master_keys(m, "k"), edges).orderBy("candidate_id", "slot").collect()
    assert [(r.candidate_id, r.master_id) for r in rows] == [("loc-1", "m0"), ("loc-1", "m2"), ("loc-1", "m1"), ("loc-1", "m3")]


def test_blocked_best_never_beats_exhaustive(spark):
    cands, masters = random_world(9, 20, 40)
    c, m = frames(spark, cands, masters)
    blocked = {r.candidate_id: r.score for r in matching.rank_retrieved(c, m, None, "k").where("rank = 1").collect()}
    full = {r.candidate_id: r.score for r in matching.rank_all(c, m, 1).collect()}
    assert all(s <= full[i] for i, s in blocked.items())


def test_no_master_rows(spark):
    c = candidate_frame(spark, [("loc-1", "acme", None, None, None, None, None, None, None, None)])
    m = spark.createDataFrame([], MASTER)
    r = policy.resolve_retrieved(c, m, None, "k").collect()[0]
    assert (r.outcome, r.reasons, r.decision_confidence, r.match_score, r.match_classification) == (
        "likely_new_company", ["no_existing_locations_to_compare"], 1.0, 0.0, "likely_new")
    assert r.match_reasons == ["no comparison records available"]


def test_a_chain_is_one_link_however_many_sites_it_has(spark):
    rows = [(i, f"rec-{i:03d}", "Loom And Spindle", f"{i} Weft Rd", f"Town {i % 7}", "OR", None, None, None, None, "DIRE") for i in range(300)]
    rows += [(900, "rec-900", "Unheard Of Yarns", None, None, None, None, None, None, None, "DIRE"), (901, "rec-901", None, None, None, None, None, None, None, None, None)]
    m = spark.createDataFrame(rows, MASTER)
    c = candidate_frame(spark, [(i, name, *[None] * 8) for i, name in (("a", "Loom and Spindle Inc"), ("b", "LOOM  AND SPINDLE"), ("c", "Quite Another"), ("d", None))])
    found = matching.company_links(c, m)
    assert found.links.count() <= 2 and found.links.agg(F.max("n_sites")).first()[0] == 300
    counts = {r.candidate_id: r.n_sites for r in found.counts().collect()}
    assert counts["a"] == 300 and "c" not in counts and "d" not in counts
    one = found.pairs(c.where("id = 'a'").select(F.col("id").alias("candidate_id")))
    assert one.count() == 300 == one.select("master_id").distinct().count()
    assert found.pairs().count() == sum(counts.values())
    assert matching.company_links(c, m.limit(0)).counts().count() == 0


def test_a_block_of_many_similar_names_is_merged_from_its_first_records(spark):
    """60 similar names with 30 records each in one ZIP: the first records of all, as one list per candidate and signal."""
    names = [f"alder optics {a}{b}" for a in "abcdef" for b in "klmnpqrstu"]
    rng = random.Random(3)
    owners = [n for n in names for _ in range(30)]
    rng.shuffle(owners)
    m = spark.createDataFrame([(i, f"mst-{i:04d}", n, None, None, None, "75001", None, None, None, "DIRE") for i, n in enumerate(owners)], MASTER)
    c = candidate_frame(spark, [(f"loc-{i}", n, None, None, None, None, None, "75001", None, None) for i, n in enumerate([*names[:4], "alder", "unheard of"])])
    ck, mk = matching.candidate_keys(c), matching.master_keys(m, "k")
    for cap in (1, 7, 26):
        got = {r.candidate_id: [h.master_id for h in r.hits] for r in matching.similar_key_lists(ck, mk, cap).collect()}
        near = {f"loc-{i}": [f"mst-{k:04d}" for k, o in enumerate(owners) if plain_dice(n, o) >= 0.55][:cap] for i, n in enumerate([*names[:4], "alder", "unheard of"])}
        assert got == {k: v for k, v in near.items() if v}
    edges = spark.createDataFrame([], "edge_seq bigint, parent_id string, child_id string")
    assert "b21" not in matching.rank_retrieved(c, m, edges, "k")._jdf.queryExecution().optimizedPlan().toString()  # no bit sets cross the pairs' shuffle


def test_the_queue_view_broadcasts_no_master(spark, tmp_path):
    c, m = frames(spark, *random_world(4, 10, 30))
    m.write.parquet(str(tmp_path / "m"))
    q = score_candidates(c, m, None, "k", mode="retrieved").withColumn("review_status", F.lit("pending"))
    q.write.parquet(str(tmp_path / "q"))
    view = tables.queue_view(spark.read.parquet(str(tmp_path / "q")), c, spark.read.parquet(str(tmp_path / "m")))
    assert "Broadcast" not in view._jdf.queryExecution().executedPlan().toString()
    assert view.count() == 10 and view.where("company_name = '(unknown)'").count() == 0


def test_company_links_do_not_grow_with_pairs_of_identities(spark):
    """One name on 40 domains: 1,600 pairs of identities are one link; counts and pairs as by comparing all."""
    rng = random.Random(12)
    names = ["alder optics", "alder optics two", "alder optic", "birch media", None]
    one = lambda: (rng.choice(names), rng.choice([None, "a.example", "b.example"]), rng.choice([None, "0001", "0002"]))
    theirs, ours = [one() for _ in range(80)], [one() for _ in range(40)]
    m = spark.createDataFrame([(i, f"rec-{i:03d}", n, None, None, None, None, None, w, s, "DIRE") for i, (n, w, s) in enumerate(theirs)], MASTER)
    c = candidate_frame(spark, [(f"c{i}", n, w, s, *[None] * 6) for i, (n, w, s) in enumerate(ours)])
    want = set()
    for (i, x), (k, y) in itertools.product(enumerate(ours), enumerate(theirs)):
        name = plain_dice(x[0], y[0]) if x[0] and y[0] else 0
        if name >= 0.85 or (name >= 0.7 and any(x[j] and x[j] == y[j] for j in (1, 2))):
            want.add((f"c{i}", f"rec-{k:03d}"))
    found = matching.company_links(c, m)
    rows = [tuple(r) for r in found.pairs().collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert {r.candidate_id: r.n_sites for r in found.counts().collect()} == {x: sum(1 for w in want if w[0] == x) for x, _ in want}
    wide = lambda n: [(i, f"rec-{i:03d}", "alder optics", None, None, None, None, None, f"w{i}.example", None, "DIRE") for i in range(n)]
    c = candidate_frame(spark, [(f"c{i}", "alder optics", f"v{i}.example", *[None] * 7) for i in range(40)])
    assert matching.company_links(c, spark.createDataFrame(wide(40), MASTER)).links.count() == 1


def test_company_chains_broadcast_nothing(spark):
    rows = [(i, f"rec-{i:03d}", f"loom {i % 3}", None, None, None, None, None, None, None, "DIRE") for i in range(30)]
    c = candidate_frame(spark, [(f"c{i}", f"loom {i}", *[None] * 8) for i in range(3)])
    found = matching.company_links(c, spark.createDataFrame(rows, MASTER))
    assert found.links.count() > 0
    for df in (found.counts(), found.pairs(c.select(F.col("id").alias("candidate_id"))), found.pairs(found.counts().orderBy(F.desc("n_sites"), "candidate_id").limit(1))):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString() and df.count() > 0


def test_rank_all_meets_no_address_where_equal_phones_settle_the_rank(spark, monkeypatch):
    masters = [{"id": f"mst-{i:04d}", "name": f"alder {i % 5} optics", "street": f"{i} elm st", "phone": f"214555{i // 5:04d}", "web": ""} for i in range(200)]
    cands = [{**masters[i * 7], "id": f"loc-{i:02d}"} for i in range(20)]
    met, all_pairs = [], matching._all_pairs

    def counted(left, right, left_key, right_key, cell):
        met.append((left_key, left.count()))
        return all_pairs(left, right, left_key, right_key, cell)

    monkeypatch.setattr(matching, "_all_pairs", counted)
    got = {}
    for r in matching.rank_all(*frames(spark, cands, masters), 3).orderBy("candidate_id", "rank").collect():
        got.setdefault(r.candidate_id, []).append(r.master_id)
    assert got == brute_rank(cands, masters, 3)
    assert met and all(n == 0 for key, n in met if key == "profile_no")
