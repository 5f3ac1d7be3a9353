"""Schemas shared by sources, operators and jobs (DDL strings)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ADDRESS = "struct<street:string,suite:string,city:string,state:string,postal_code:string,country:string>"
BAND = "struct<estimate:double,minimum:double,maximum:double,band_label:string,raw_code:string>"
CONTACT = "struct<id:string,name:string,title:string,email:string,phone:string>"
RELATIONSHIP = "struct<parent_company:string,affiliate:string,ticker_symbol:string>"
COMPANY = (
    "struct<id:string,legal_name:string,dba_name:string,alphasort:string,website:string,"
    "email_format:string,sic_code:string,start_year:int,"
    f"relationship:{RELATIONSHIP},international:boolean,team_page_url:string,linkedin_url:string>"
)
PROVENANCE = (
    "struct<source_id:string,source_name:string,source_url:string,source_record_id:string,"
    "fingerprint:string,ingested_at:string>"
)
EVIDENCE_SOURCE = (
    "struct<source_type:string,source_id:string,source_name:string,source_url:string,"
    "source_record_id:string,source_observation_id:string>"
)
INHERITANCE = (
    "struct<from_existing_company_id:string,from_source_observation_id:string,"
    "reason:string,independently_confirmed:boolean>"
)
EVIDENCE = (
    "struct<path_key:string,value_json:string,normalized_json:string,raw_json:string,confidence:double,"
    f"source:{EVIDENCE_SOURCE},captured_at:string,evidence_text:string,derivation:string,"
    f"inheritance:{INHERITANCE}>"
)
CANDIDATE = {
    "id": "string",
    "company": COMPANY,
    "physical_address": ADDRESS,
    "mailing_address": ADDRESS,
    "phone": "string",
    "toll_free_phone": "string",
    "market": "string",
    "county": "string",
    "site_type": "string",
    "raw_site_type_code": "string",
    "building_name": "string",
    "building_type": "string",
    "lease_or_own": "string",
    "employee_size_site": BAND,
    "employee_size_company_wide": BAND,
    "employee_count_exact": "bigint",
    "total_sites": "bigint",
    "estimated_annual_revenue": BAND,
    "description": "string",
    "contacts": f"array<{CONTACT}>",
    "source": PROVENANCE,
    "captured_at": "string",
    "evidence": "array<string>",
    "field_evidence": f"array<{EVIDENCE}>",
    "raw_source_data": "string",
}
MASTER = {
    "id": "string",
    "company_name": "string",
    "address": "string",
    "city": "string",
    "state": "string",
    "postal_code": "string",
    "phone": "string",
    "website": "string",
    "sic_code": "string",
    "status": "string",
    "lifecycle_status": "string",
}


def as_candidates(df: DataFrame) -> DataFrame:
    """Candidate schema from whatever part of it ``df`` holds.

    Struct columns may carry a subset of their fields; what is missing is null
    (``contacts``, ``evidence`` and ``field_evidence`` become empty arrays).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name, ddl in CANDIDATE.items():
        want = T.DataType.fromDDL(ddl)
        if name not in have:
            col = F.array() if isinstance(want, T.ArrayType) else F.lit(None)
        elif isinstance(want, T.StructType) and isinstance(have[name], T.StructType):
            col = _fit_struct(F.col(name), have[name], want)
        elif isinstance(want, T.ArrayType) and isinstance(want.elementType, T.StructType):
            col = _fit_array(F.col(name), have[name].elementType, want.elementType)
        else:
            col = F.col(name)
        cols.append(col.cast(want).alias(name))
    return df.select(cols)


def as_evidence(value, df: DataFrame) -> DataFrame:
    """``df`` with a column ``proposal``: the struct ``value`` in the evidence schema, what is missing null."""
    have = df.select(value.alias("e")).schema["e"].dataType
    want = T.DataType.fromDDL(EVIDENCE)
    return df.withColumn("proposal", value).withColumn("proposal", _fit_struct(F.col("proposal"), have, want).cast(want))


def _fit_array(col, have: T.StructType, want: T.StructType):
    if not isinstance(have, T.StructType):  # an empty literal array
        return col
    return F.transform(col, lambda x: _fit_struct(x, have, want))


def _fit_struct(col, have: T.StructType, want: T.StructType):
    fields = []
    for f in want.fields:
        if f.name not in have.names:
            value = F.lit(None)
        elif isinstance(f.dataType, T.StructType) and isinstance(have[f.name].dataType, T.StructType):
            value = _fit_struct(col[f.name], have[f.name].dataType, f.dataType)
        else:
            value = col[f.name]
        fields.append(value.cast(f.dataType).alias(f.name))
    return F.when(col.isNotNull(), F.struct(*fields))
