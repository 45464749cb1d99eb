"""A1-A3 with mergeable counts of counter-entities.

Exact distinct counts of two days can't be added up. A sketch (HyperLogLog,
``2 ** LG_K`` registers, a few KB at most) can: states hold one per entity and
UTC day, and any union of days, batches or entities is read from them without
the log. The relative standard error of an estimate is ``ERROR``; counts of
events, days, first and last times stay exact. The exact summaries remain
beside them (``summaries``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.operators.summaries import IP_BASED, USER_BASED, _tagged_logins, failed_login_relations

LG_K = 12
ERROR = 1.04 / 2 ** (LG_K / 2)
ENTITY = ("detection_type", "entity_type", "entity_id")


def login_sketches(d1: DataFrame, families=(IP_BASED, USER_BASED)) -> DataFrame:
    """A state per entity and UTC day: failed logins, first and last, and the sketch of who was met.

    Entities that are NULL are left out, as in A1-A3; NULL counter-entities
    are not counted. States of several batches may hold the same day.
    """
    return _tagged_logins(d1, list(families)).groupBy(
        "detection_type", "entity_type", F.col("entity").alias("entity_id"), F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("failed_attempts"), F.min("event_time").alias("first_attempt"),
        F.max("event_time").alias("last_attempt"), F.hll_sketch_agg("other", F.lit(LG_K)).alias("others"))


def merged_sketches(states: DataFrame, keys=ENTITY, first_day=None, last_day=None) -> DataFrame:
    """States added up to ``keys`` (some of ``ENTITY``, or day) over whole days: counts, and an estimate of the distinct others."""
    if first_day is not None:
        states = states.where(F.col("day") >= F.lit(first_day))
    if last_day is not None:
        states = states.where(F.col("day") <= F.lit(last_day))
    return states.groupBy(*keys).agg(
        F.sum("failed_attempts").alias("failed_attempts"), F.min("first_attempt").alias("first_attempt"),
        F.max("last_attempt").alias("last_attempt"), F.hll_sketch_estimate(F.hll_union_agg("others")).alias("unique_estimate"))


def measured_sketches(states: DataFrame, d1: DataFrame, deviations: float = 4.0) -> DataFrame:
    """The merged states of every entity beside the exact count, and whether they agree within ``deviations`` standard errors (or one)."""
    exact = failed_login_relations(d1, None, None).groupBy("detection_type", F.col("entity").alias("entity_id")).agg(
        F.count_distinct("other").alias("unique_entities"))
    off = F.abs(F.col("unique_estimate") - F.col("unique_entities"))
    return merged_sketches(states).join(exact, ["detection_type", "entity_id"]).withColumn(
        "within_error", off <= F.greatest(F.lit(1.0), F.col("unique_entities") * (deviations * ERROR)))
