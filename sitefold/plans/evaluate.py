"""Evaluation job over labelled-case files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefold.operators import evaluation

_ADDRESS = "STRUCT<street:STRING,suite:STRING,city:STRING,state:STRING,postalCode:STRING,country:STRING>"
# Layout of a labelled-case file as it is written: one dataset envelope per file.
ENVELOPE = f"""
datasetId STRING, schemaVersion STRING, cases ARRAY<STRUCT<
  caseId:STRING, description:STRING,
  candidate:STRUCT<id:STRING,
    company:STRUCT<legalName:STRING,website:STRING,sicCode:STRING>,
    physicalAddress:{_ADDRESS}, phone:STRING, siteType:STRING>,
  existingCompanies:ARRAY<STRUCT<id:STRING,companyName:STRING,address:STRING,city:STRING,state:STRING,
    postalCode:STRING,phone:STRING,website:STRING,sicCode:STRING,status:STRING>>,
  expected:STRUCT<outcome:STRING,matchedExistingCompanyId:STRING>,
  provenance:STRUCT<source:STRING,reviewer:STRING,notes:STRING>>>
"""


class CaseErrors(ValueError):
    """The labelled cases hold errors; nothing was evaluated. ``errors`` is the DataFrame of all of them."""

    def __init__(self, errors: DataFrame, count: int, first: list[str]):
        super().__init__(f"{count} error(s), among them: {'; '.join(first)}")
        self.errors, self.count = errors, count


def read_cases(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cases, existing records, file-level errors) of files or folders of ``*.json``."""
    raw = spark.read.text(paths, wholetext=True, pathGlobFilter="*.json").select(
        F.col("_metadata.file_path").alias("file"), F.col("value")
    )
    parsed = raw.select(
        "file",
        F.try_parse_json("value").alias("v"),
        F.from_json("value", ENVELOPE).alias("d"),
    ).withColumn("kind", F.schema_of_variant("v"))
    is_array = F.expr("schema_of_variant(variant_get(v, '$.cases', 'variant'))").startswith("ARRAY")
    first_file = parsed.where("d.datasetId IS NOT NULL").groupBy(F.col("d.datasetId").alias("dataset_id")).agg(
        F.min("file").alias("_first_file")
    )
    files = parsed.withColumn("dataset_id", F.col("d.datasetId")).join(first_file, "dataset_id", "left").withColumn(
        "error",
        F.when(F.col("v").isNull(), "not readable as JSON")
        .when(F.col("kind").startswith("ARRAY"), "bare array, an envelope is required")
        .when(~F.col("kind").startswith("OBJECT"), "top level must be an object")
        .when(~F.coalesce(F.trim("dataset_id") != "", F.lit(False)), "dataset id required")
        .when(~F.coalesce(F.col("d.schemaVersion").isin(evaluation.SCHEMA_VERSIONS), F.lit(False)), "unsupported schema version")
        .when(F.col("file") > F.col("_first_file"), "repeated dataset id")
        .when(~F.coalesce(is_array, F.lit(False)), "cases must be an array"),
    )
    errors = files.where("error IS NOT NULL").select("file", "dataset_id", F.col("error").alias("message"))
    rows = files.where("error IS NULL").select(
        "file", "dataset_id", F.posexplode("d.cases").alias("position", "c")
    )
    cases = rows.select(
        "dataset_id", "position", F.col("c.caseId").alias("case_id"),
        F.col("c.candidate.id").alias("candidate_id"), F.col("c.candidate.company.legalName").alias("legal_name"),
        F.struct(
            F.struct(
                F.col("c.candidate.company.legalName").alias("legal_name"),
                F.col("c.candidate.company.website").alias("website"),
                F.col("c.candidate.company.sicCode").alias("sic_code"),
            ).alias("company"),
            F.struct(
                F.col("c.candidate.physicalAddress.street").alias("street"),
                F.col("c.candidate.physicalAddress.city").alias("city"),
                F.col("c.candidate.physicalAddress.state").alias("state"),
                F.col("c.candidate.physicalAddress.postalCode").alias("postal_code"),
            ).alias("physical_address"),
            F.col("c.candidate.phone").alias("phone"),
            F.col("c.candidate.siteType").alias("site_type"),
        ).alias("candidate"),
        F.col("c.expected.outcome").alias("expected_outcome"),
        F.col("c.expected.matchedExistingCompanyId").alias("expected_id"),
        F.col("c.provenance.source").alias("provenance_source"),
        F.col("c.provenance.reviewer").alias("reviewer"),
        F.col("c.provenance.notes").alias("notes"),
        F.struct("file", "position").alias("global_order"),
    )
    existing = rows.select("dataset_id", "position", F.col("c.caseId").alias("case_id"), F.explode("c.existingCompanies").alias("e")).select(
        "dataset_id", "position", "case_id", F.col("e.id").alias("id"), F.col("e.companyName").alias("company_name"),
        "e.address", "e.city", "e.state", F.col("e.postalCode").alias("postal_code"), "e.phone", "e.website",
        F.col("e.sicCode").alias("sic_code"), "e.status",
    )
    return cases, existing, errors


def evaluate_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Result rows of all cases; refuses to evaluate if any file or case is invalid."""
    cases, existing, errors = read_cases(spark, paths)
    problems = errors.select("message").unionByName(
        evaluation.validate_cases(cases, existing).select("message")
    )
    count = problems.count()
    if count:
        raise CaseErrors(problems, count, [r.message for r in problems.groupBy("message").count().orderBy("message").limit(20).collect()])
    return evaluation.evaluate_cases(cases, existing.drop("position"))
