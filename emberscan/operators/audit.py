"""Audit of boundary names against the reference regencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import loose_name_key


def name_matches(boundaries: DataFrame, regencies: DataFrame) -> DataFrame:
    """Distinct boundary names with the regencies of the same loose name.

    One name may match a city and a regency; both are listed.
    """
    names = boundaries.select("WADMKK", "WADMPR").distinct().withColumn(
        "match_name", loose_name_key(F.col("WADMKK"))
    )
    reference = regencies.select(
        "regency_id", "province_id", "regency_name", loose_name_key(F.col("regency_name")).alias("match_name")
    )
    return names.join(reference, "match_name", "left")


def match_counts(matches: DataFrame) -> DataFrame:
    found = F.col("regency_id").isNotNull()
    return matches.agg(
        F.count_if(found).alias("matched"), F.count_if(~found).alias("unmatched")
    )


def unmatched_names(matches: DataFrame) -> DataFrame:
    return matches.where("regency_id is null").select("WADMKK", "WADMPR")
