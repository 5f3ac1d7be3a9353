"""Labelled evaluation: per-case results, accuracy, retrieval, errors, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.functions import codes
from sitefold.functions import text as tx
from sitefold.operators import matching, policy
from sitefold.operators.lineage import cut_lineage

# Confidence bands of the calibration table and ranks of the recall figures.
BANDS = ["unscored", "0.0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8", "0.8-1.0"]
RECALL_AT = [1, 3, 5]
SCHEMA_VERSIONS = ["1.0"]
PROVENANCE_SOURCES = ["synthetic", "real_reviewer_case"]
MISSES_SHOWN = 25


def evaluate_cases(cases: DataFrame, existing: DataFrame) -> DataFrame:
    """One result row per case.

    ``cases``: dataset_id, case_id, candidate (struct), expected_outcome, expected_id,
    reviewer, notes. ``existing``: dataset_id, case_id and master columns; each case
    is compared with its own rows only, so everything is keyed by the case.
    """
    key = ["dataset_id", "case_id"]
    case_key = F.to_json(F.array(*key))
    labelled = cases.withColumn("_case", case_key)
    ck = matching.candidate_keys(labelled.select(F.col("_case").alias("id"), *[
        F.col(f"candidate.{c}").alias(c) for c in ("company", "physical_address", "phone", "site_type")
    ]))
    # The case takes the place of the file position: it rides along as the join key.
    own = existing.withColumn("_case", case_key)
    mk = matching.master_keys(own, "_case").withColumnRenamed("pos", "candidate_id")
    # A row takes part in few pairs and crosses a shuffle: short arrays are made faster than bit sets, and are a quarter as wide.
    pairs = matching.with_codes(mk, "m").join(matching.with_codes(ck, "c"), "candidate_id")
    scored = matching.score_pairs(pairs, tx.dice)
    w = Window.partitionBy("candidate_id").orderBy(*matching.rank_order())
    # Written once: the matches and the rank of the expected record both start from it.
    ranked = cut_lineage(scored.withColumn("rank", F.row_number().over(w)).select("candidate_id", "rank", *policy.MATCH_FIELDS))
    found = policy.collect_matches(ranked, with_related=True)
    rows = (
        labelled.withColumn("candidate_id", F.col("_case"))
        .join(ck.select("candidate_id", "site_type"), "candidate_id")
        .join(found, "candidate_id", "left")
        .withColumn("has_several", F.coalesce(F.size("related_ids") >= 2, F.lit(False)))
    )
    ranks = ranked.join(
        labelled.select(F.col("_case").alias("candidate_id"), F.col("expected_id").alias("master_id")),
        ["candidate_id", "master_id"], "left_semi",
    ).select("candidate_id", F.col("rank").alias("retrieval_rank"))
    outcome_ok = F.col("outcome") == F.col("expected_outcome")
    record_ok = F.when(
        F.col("expected_id").isNotNull(), F.coalesce(F.col("matched_id") == F.col("expected_id"), F.lit(False))
    )
    return (
        policy.decide(rows)
        .join(ranks, "candidate_id", "left")
        .select(
            *key, "expected_outcome", F.col("outcome").alias("actual_outcome"), outcome_ok.alias("outcome_correct"),
            "expected_id", F.col("matched_id").alias("actual_id"), record_ok.alias("matched_record_correct"),
            (outcome_ok & F.coalesce(record_ok, F.lit(True))).alias("fully_correct"),
            F.col("retrieval_rank").cast("bigint").alias("retrieval_rank"),
            "decision_confidence", "requires_human_review", "reasons", "conflicts", "reviewer", "notes",
        )
    )


def _rate(condition: Column, among: Column | None = None) -> Column:
    """Share of rows; null for an empty denominator."""
    if among is None:
        return F.avg(condition.cast("double"))
    return F.avg(F.when(among, condition.cast("double")))


def _accuracy() -> list[Column]:
    zero = F.lit(0.0)
    return [
        F.count("case_id").alias("case_count"),
        F.coalesce(_rate(F.col("outcome_correct")), zero).alias("outcome_accuracy"),
        F.avg(F.col("matched_record_correct").cast("double")).alias("matched_record_accuracy"),
        F.coalesce(_rate(F.col("fully_correct")), zero).alias("full_case_accuracy"),
    ]


def accuracy(results: DataFrame) -> DataFrame:
    return results.agg(*_accuracy())


def _enum(df: DataFrame, name: str, values: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(values)], f"position int, {name} string")


def confusion_matrix(results: DataFrame) -> DataFrame:
    """One row per expected outcome, one zero-filled column per actual outcome."""
    counts = [
        F.count_if(F.col("actual_outcome") == o).alias(o) for o in codes.OUTCOMES
    ]
    # Seven groups whatever the number of cases: combined map-side before the small join.
    found = results.groupBy("expected_outcome").agg(*counts)
    return (
        _enum(results, "expected_outcome", codes.OUTCOMES)
        .join(found, "expected_outcome", "left")
        .select("expected_outcome", *[F.coalesce(o, F.lit(0)).alias(o) for o in codes.OUTCOMES])
    )


def breakdown(results: DataFrame) -> DataFrame:
    """Accuracy, review and abstention rates and the counts of actual outcomes per expected outcome; all seven rows."""
    found = results.groupBy("expected_outcome").agg(
        *_accuracy(),
        _rate(F.col("requires_human_review")).alias("review_rate"),
        _rate(F.col("actual_outcome") == codes.ABSTENTION_OUTCOME).alias("abstention_rate"),
        *[F.count_if(F.col("actual_outcome") == o).alias(f"actual_{o}") for o in codes.OUTCOMES],
    )
    zero = F.lit(0.0)
    return (
        _enum(results, "expected_outcome", codes.OUTCOMES)
        .join(found, "expected_outcome", "left")
        .select(
            "expected_outcome", F.coalesce("case_count", F.lit(0)).alias("case_count"),
            F.coalesce("outcome_accuracy", zero).alias("outcome_accuracy"), "matched_record_accuracy",
            F.coalesce("full_case_accuracy", zero).alias("full_case_accuracy"),
            F.coalesce("review_rate", zero).alias("review_rate"),
            F.coalesce("abstention_rate", zero).alias("abstention_rate"),
            *[F.coalesce(f"actual_{o}", F.lit(0)).alias(f"actual_{o}") for o in codes.OUTCOMES],
        )
    )


def retrieval(results: DataFrame) -> DataFrame:
    """Recall, mean reciprocal rank, mean and median rank over cases whose record was ranked."""
    rank = F.col("retrieval_rank")
    zero = F.lit(0.0)
    # Ranks first become (rank, count) pairs, so that the exact median never needs all cases in one place.
    ranks = results.where(rank.isNotNull()).groupBy("retrieval_rank").agg(F.count("*").alias("n"))
    total = F.sum("n")

    def weighted(value: Column) -> Column:
        return F.sum(value * F.col("n")) / total

    return ranks.agg(
        F.coalesce(total, F.lit(0)).alias("applicable_cases"),
        *[F.coalesce(weighted((rank <= k).cast("double")), zero).alias(f"recall_at_{k}") for k in RECALL_AT],
        F.coalesce(weighted(F.lit(1.0) / rank), zero).alias("mean_reciprocal_rank"),
        weighted(rank).alias("mean_rank"),
        F.percentile("retrieval_rank", 0.5, F.col("n")).alias("median_rank"),
    )


def directional_errors(results: DataFrame) -> DataFrame:
    expected, actual = F.col("expected_outcome"), F.col("actual_outcome")
    new_expected = expected == codes.NEW_COMPANY_OUTCOME
    related_expected = expected.isin(codes.EXISTING_RELATED_OUTCOMES)
    return results.agg(
        F.count_if(new_expected).alias("new_expected_count"),
        F.count_if(related_expected).alias("existing_related_expected_count"),
        _rate(actual.isin(codes.EXISTING_RELATED_OUTCOMES), new_expected).alias("false_existing_link_rate"),
        _rate(actual == codes.NEW_COMPANY_OUTCOME, related_expected).alias("false_new_rate"),
        _rate(actual == codes.ABSTENTION_OUTCOME).alias("abstention_rate"),
    )


def confidence_band(c: Column) -> Column:
    """Five equal bands, the top one closed; null and out-of-range values are unscored."""
    out = F.lit("unscored")
    for label in BANDS[1:]:
        low, high = (float(x) for x in label.split("-"))
        top = c <= high if high == 1.0 else c < high
        out = F.when((c >= low) & top, label).otherwise(out)
    return out


def calibration(results: DataFrame) -> DataFrame:
    found = results.groupBy(confidence_band(F.col("decision_confidence")).alias("band")).agg(
        F.count("*").alias("case_count"),
        _rate(F.col("fully_correct")).alias("full_case_accuracy"),
        _rate(F.col("outcome_correct")).alias("outcome_accuracy"),
        F.avg("decision_confidence").alias("mean_confidence"),
    )
    return (
        _enum(results, "band", BANDS)
        .join(found, "band", "left")
        .select("band", F.coalesce("case_count", F.lit(0)).alias("case_count"), "full_case_accuracy",
                "outcome_accuracy", "mean_confidence")
    )


def misses(results: DataFrame, limit: int = MISSES_SHOWN) -> DataFrame:
    return results.where(~F.col("fully_correct")).orderBy("dataset_id", "case_id").limit(limit)


def validate_cases(cases: DataFrame, existing: DataFrame) -> DataFrame:
    """Error rows (dataset_id, case_id, position, message); any row refuses the evaluation.

    ``cases``: dataset_id, position, case_id, candidate_id, legal_name, expected_outcome,
    expected_id, provenance_source, global_order. ``existing``: dataset_id, position, id.
    """
    key = ["dataset_id", "position"]
    ids = existing.groupBy(*key, "id").agg(F.count("*").alias("n"))
    per_case = ids.groupBy(*key).agg(
        F.count_if(~tx.filled(F.col("id"))).alias("_blank_ids"),
        F.count_if(tx.filled(F.col("id")) & (F.col("n") > 1)).alias("_repeated_ids"),
    )
    has_expected = (
        cases.select(*key, F.col("expected_id").alias("id")).join(ids, [*key, "id"], "left_semi")
        .select(*key, F.lit(True).alias("_listed"))
    )
    # The first case with an id reserves it, valid or not.
    first = cases.where(tx.filled(F.col("case_id"))).groupBy("case_id").agg(F.min("global_order").alias("_first"))
    rows = cases.join(first, "case_id", "left").join(per_case, key, "left").join(has_expected, key, "left")
    outcome, matched = F.col("expected_outcome"), tx.filled(F.col("expected_id"))
    known = F.coalesce(outcome.isin(codes.OUTCOMES), F.lit(False))
    blank_case = ~tx.filled(F.col("case_id"))
    repeated = F.coalesce(F.col("global_order") > F.col("_first"), F.lit(False))
    source = F.col("provenance_source")
    checks = F.array(
        F.when(~tx.filled(F.col("candidate_id")) | ~tx.filled(F.col("legal_name")), "candidate needs an id and a legal name"),
        F.when(F.col("_blank_ids") > 0, "existing record without an id"),
        F.when(F.col("_repeated_ids") > 0, "repeated existing record id"),
        F.when(~known, "unknown expected outcome"),
        F.when(known & (outcome == codes.NEW_COMPANY_OUTCOME) & matched, "matched record not allowed"),
        F.when(known & outcome.isin(codes.EXISTING_RELATED_OUTCOMES) & ~matched, "matched record required"),
        F.when(known & matched & F.col("_listed").isNull(), "matched record not among the existing ones"),
        F.when(known & ~tx.filled(source), "provenance source required"),
        F.when(known & tx.filled(source) & ~source.isin(PROVENANCE_SOURCES), "unknown provenance source"),
    )
    messages = (
        F.when(blank_case, F.array(F.lit("case id required")))
        .when(repeated, F.array(F.lit("repeated case id")))
        .otherwise(F.array_compact(checks))
    )
    return rows.select("dataset_id", "case_id", "position", F.explode(messages).alias("message"))
