"""Source-profile job: pull a window, profile it, draw a sample, write dated artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitefold.operators import profiling, tables
from sitefold.operators.lineage import cut_lineage
from sitefold.sources import permits


def profile_source(landing: DataFrame, window: tuple[str, str], counties: list[str], out: str, pull_date: str,
                   limit: int, seed: int = 1) -> DataFrame:
    """Run the whole profile of the first ``limit`` observations; the manifest says whether there were more."""
    pulled = cut_lineage(permits.pull(landing, window, counties, limit))
    counts = permits.pull_counts(landing, window, counties)
    distribution = profiling.distributions(pulled)
    artifacts = {
        "raw": pulled.withColumn("requested_counties", F.concat_ws(",", "requested_counties")),
        "profile": profiling.permit_profile(pulled),
        "distributions": profiling.top_buckets(distribution),
        "pilot-sample": profiling.pilot_sample(pulled, seed),
        "pull-counts": counts,
    }
    facts = {"window": "/".join(window), "counties": ",".join(counties), "seed": str(seed), "limit": str(limit),
             "truncated": str(counts.first()["unique_count"] > limit).lower()}
    return tables.write_artifacts(artifacts, out, pull_date, facts)
