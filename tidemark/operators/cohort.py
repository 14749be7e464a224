"""Cohort operators.

``IN`` / ``NOT IN`` subqueries are written as semi / anti joins. Rates are
computed from pre-aggregated (entity, bucket) counts, so the join with the
cohort table sees one row per entity and bucket, never the raw events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def semi_join(df: DataFrame, keys_df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df`` (each row once)."""
    return df.join(keys_df, on, "left_semi")


def anti_join(df: DataFrame, keys_df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key never occurs in ``keys_df``."""
    return df.join(keys_df, on, "left_anti")


def rate_per_member(events: DataFrame, cohorts: DataFrame, entity: str, cohort: str,
                    by: Sequence[str]) -> DataFrame:
    """A10: events per ``by`` bucket divided by cohort size, all cohorts at
    once. ``cohorts`` is (entity, cohort), an entity may be in several."""
    per_entity = events.groupBy(entity, *by).agg(F.count(F.lit(1)).alias("__n"))
    sizes = cohorts.groupBy(cohort).agg(F.count(F.lit(1)).alias("members"))
    agg = (per_entity.join(cohorts, entity).groupBy(cohort, *by)
           .agg(F.sum("__n").alias("plays")))
    return agg.join(sizes, cohort).withColumn("rate", F.col("plays") / F.col("members"))
