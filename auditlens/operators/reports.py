"""Q1-Q18: the report queries over the assessed summaries.

Windows are relative to ``as_of``. JSON fields are read with
``get_json_object`` (arrays come back as compact JSON text). ``ORDER BY``
is kept where the report has one; for display, pair it with ``limit``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.exprs import json_field, since
from auditlens.functions.scoring import ANALYSIS_COLUMN, POSTURE_COLUMN

HIGH_LEVELS = ("HIGH", "CRITICAL")

# Labels, thresholds and texts of the report queries.
Q12_ANALYSIS_TYPE = "CROSS_CORRELATION"
Q12_RECOMMENDATION = ("Investigate IPs with high failed login attempts that also have "
                      "privilege escalation events")
Q12_MIN_ATTEMPTS = 10
Q10_MIN_EXPORTS = 5
Q10_MIN_ACTIVITY = 3
Q4_MIN_EVENTS = 1
LEVEL_RANK = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}
Q13_METRICS = ("AI_ANALYSIS_PERFORMANCE", "DATA_EXPORT_ANALYSIS", "PRIVILEGE_ESCALATION_ANALYSIS")


def _rl(column: str = ANALYSIS_COLUMN):
    return json_field(column, "risk_level")


def _field(name: str, column: str = ANALYSIS_COLUMN):
    return json_field(column, name).alias(name)


def _high(column: str = ANALYSIS_COLUMN):
    return _rl(column).isin(*HIGH_LEVELS)


def q1_failed_login_actions(r_fl: DataFrame, as_of, hours=24) -> DataFrame:
    """Q1: failed-login patterns that *started* in the window, with the assessment fields."""
    return since(r_fl, as_of, hours, "first_attempt").select(
        "entity_name", "failed_attempts", _rl().alias("risk_level"),
        _field("immediate_actions"), _field("risk_factors"), _field("long_term_recommendations"))


def q2_high_risk_exports(r_de: DataFrame, as_of, hours=24) -> DataFrame:
    """Q2: HIGH/CRITICAL export groups active in the window."""
    return since(r_de.filter(_high()), as_of, hours, "last_activity").select(
        "actor", "source", "artifact", "export_count", _rl().alias("risk_level"),
        _field("risk_factors"), _field("immediate_actions"), _field("long_term_recommendations"))


def q3_critical_escalations(c1: DataFrame, as_of, hours=168) -> DataFrame:
    """Q3: CRITICAL/HIGH escalations, latest first."""
    return since(c1.filter(_high()), as_of, hours, "actor_last_activity").select(
        "escalation_type", "actor", "target_user", "actor_activity_count", "actor_unique_entities",
        "actor_first_activity", "actor_last_activity", _rl().alias("risk_level"),
        _field("immediate_actions"), _field("investigation_steps"),
    ).orderBy(F.col("actor_last_activity").desc())


def q4_actor_frequency(c1: DataFrame, as_of, hours=168) -> DataFrame:
    """Q4: escalation groups per (actor, type, level) seen more than once."""
    return since(c1, as_of, hours, "actor_last_activity").groupBy(
        "actor", "escalation_type", _rl().alias("risk_level")
    ).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("actor_activity_count").alias("avg_actor_activity"),
        F.max("actor_unique_entities").alias("max_unique_entities"),
        F.min("actor_first_activity").alias("earliest_activity"),
        F.max("actor_last_activity").alias("latest_activity"),
    ).filter(F.col("total_events") > Q4_MIN_EVENTS).select(
        "actor", "escalation_type", "total_events", "avg_actor_activity", "max_unique_entities",
        "earliest_activity", "latest_activity", "risk_level",
    ).orderBy(F.col("total_events").desc())


def q5_posture_fields(c3: DataFrame) -> DataFrame:
    """Q5: the posture assessment as columns."""
    return c3.select(
        "analysis_type", "analysis_timestamp",
        *[json_field(POSTURE_COLUMN, name).alias(name) for name in (
            "overall_risk_level", "key_risk_areas", "immediate_actions",
            "strategic_recommendations", "compliance_considerations")])


def _explode_json_list(doc: str, name: str):
    return F.explode(F.from_json(json_field(doc, name), "array<string>"))


def q6_export_risk_factors(r_de: DataFrame, as_of, hours=24) -> DataFrame:
    """Q6: one row per risk factor of export groups active in the window."""
    return since(r_de, as_of, hours, "last_activity").select(
        "actor", "source", _rl().alias("risk_level"),
        _explode_json_list(ANALYSIS_COLUMN, "risk_factors").alias("individual_risk_factor"))


def q7_investigation_steps(c1: DataFrame, as_of, hours=168) -> DataFrame:
    """Q7: one row per investigation step of consolidated escalations."""
    return since(c1, as_of, hours, "actor_last_activity").select(
        "escalation_type", "actor", "target_user",
        _explode_json_list(ANALYSIS_COLUMN, "investigation_steps").alias("individual_investigation_step"))


def q8_strategic_recommendations(c3: DataFrame) -> DataFrame:
    """Q8: one row per strategic recommendation of the posture."""
    return c3.select(
        "analysis_type",
        _explode_json_list(POSTURE_COLUMN, "strategic_recommendations")
        .alias("individual_strategic_recommendation"))


def _level_rank():
    rank = None
    for level, value in LEVEL_RANK.items():
        hit = F.col("risk_level") == level
        rank = F.when(hit, F.lit(value)) if rank is None else rank.when(hit, F.lit(value))
    return rank


def q9_risk_level_counts(r_fl: DataFrame, r_de: DataFrame, c1: DataFrame, as_of,
                         hours=168) -> DataFrame:
    """Q9: groups per risk level in three families; unknown levels sort first."""
    def levels(frame, label, time_col):
        return since(frame, as_of, hours, time_col).select(
            F.lit(label).alias("detection_type"), _rl().alias("risk_level"))
    out = reduce(DataFrame.unionByName, [
        levels(r_fl, "FAILED_LOGINS", "first_attempt"),
        levels(r_de, "DATA_EXPORTS", "last_activity"),
        levels(c1, "PRIVILEGE_ESCALATIONS", "actor_last_activity"),
    ]).groupBy("detection_type", "risk_level").agg(F.count(F.lit(1)).alias("event_count"))
    return out.orderBy("detection_type", _level_rank().asc_nulls_first())


def q10_high_frequency_actors(r_de: DataFrame, c1: DataFrame, as_of, hours=168) -> DataFrame:
    """Q10: busy export groups and busy escalation groups (names from the first branch)."""
    exports = since(r_de.filter(F.col("export_count") > Q10_MIN_EXPORTS), as_of, hours,
                    "last_activity").select(
        F.lit("DATA_EXPORTS").alias("event_type"), "actor",
        F.col("export_count").alias("activity_count"),
        F.col("source").alias("unique_source"),
        F.col("artifact").alias("unique_artifact"),
        _rl().alias("risk_level"))
    escalations = since(c1.filter(F.col("actor_activity_count") > Q10_MIN_ACTIVITY), as_of, hours,
                        "actor_last_activity").select(
        F.lit("PRIVILEGE_ESCALATIONS").alias("event_type"), "actor",
        F.col("actor_activity_count").alias("activity_count"),
        F.col("target_user").alias("unique_source"),
        F.lit(None).cast("string").alias("unique_artifact"),
        _rl().alias("risk_level"))
    return exports.unionByName(escalations).orderBy("event_type", F.col("activity_count").desc())


def q11_compliance_report(c1: DataFrame, as_of, hours=168) -> DataFrame:
    """Q11: escalations with their long-term controls, latest first."""
    return since(c1, as_of, hours, "actor_last_activity").orderBy(
        F.col("actor_last_activity").desc()).select(
        "escalation_type", "actor", "target_user", "actor_activity_count",
        _rl().alias("risk_level"), _field("long_term_controls"))


def q12_cross_correlation(r_fl: DataFrame, c1: DataFrame, as_of, hours=168) -> DataFrame:
    """Q12: count of noisy IPs and of high-risk actors, in one row.

    The source cross-joins the two sets and counts distinct values; that
    equals the two distinct counts when both sets are non-empty and 0/0
    otherwise. Here each side is reduced to one row (its row count and
    distinct count), the two rows are stacked and folded by one global
    aggregate: no join, no |ips| x |actors| product.
    """
    ips = since(r_fl.filter(F.col("entity_type") == "source_ip"), as_of, hours, "first_attempt") \
        .groupBy("entity_id").agg(F.max("failed_attempts").alias("_attempts")) \
        .filter(F.col("_attempts") > Q12_MIN_ATTEMPTS) \
        .agg(F.count(F.lit(1)).alias("_ip_rows"), F.count("entity_id").alias("_ips"))
    actors = since(c1.filter(_high()), as_of, hours, "actor_last_activity") \
        .agg(F.count(F.lit(1)).alias("_actor_rows"), F.count_distinct("actor").alias("_actors"))
    sides = ips.unionByName(actors, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("_ip_rows", "_ips", "_actor_rows", "_actors")])
    both = (F.col("_ip_rows") > 0) & (F.col("_actor_rows") > 0)
    return sides.select(
        F.lit(Q12_ANALYSIS_TYPE).alias("analysis_type"),
        F.when(both, F.col("_ips")).otherwise(F.lit(0)).cast("bigint").alias("suspicious_ips"),
        F.when(both, F.col("_actors")).otherwise(F.lit(0)).cast("bigint").alias("high_risk_actors"),
        F.lit(Q12_RECOMMENDATION).alias("recommendation"))


def q13_analysis_volume(r_fl: DataFrame, r_de: DataFrame, c1: DataFrame, as_of,
                        hours=24) -> DataFrame:
    """Q13: number of assessments and mean assessment length per family."""
    def rows(frame, label, filter_col, first_col, last_col):
        return since(frame, as_of, hours, filter_col).select(
            F.lit(label).alias("metric"), F.lit(1).alias("n"),
            F.length(F.col(ANALYSIS_COLUMN).cast("string")).alias("size"),
            F.col(first_col).alias("first"), F.col(last_col).alias("last"))
    parts = [
        rows(r_fl, Q13_METRICS[0], "first_attempt", "first_attempt", "last_attempt"),
        rows(r_de, Q13_METRICS[1], "last_activity", "first_activity", "last_activity"),
        rows(c1, Q13_METRICS[2], "actor_last_activity", "actor_first_activity", "actor_last_activity"),
    ]
    # a row for each family, also for one without assessments
    none = r_fl.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, Q13_METRICS))).alias("metric"), F.lit(0).alias("n"))
    return reduce(DataFrame.unionByName, parts).unionByName(none, allowMissingColumns=True).groupBy("metric").agg(
        F.sum("n").cast("bigint").alias("total_analyses"),
        F.avg("size").alias("avg_response_length"),
        F.min("first").alias("earliest_event"),
        F.max("last").alias("latest_event"))


def _drill_down(frame: DataFrame, as_of, hours, columns, fields) -> DataFrame:
    return since(frame.filter(_high()), as_of, hours, "last_activity").select(
        *columns, _rl().alias("risk_level"), *[_field(f) for f in fields])


def q14_account_admin(r_aa: DataFrame, as_of, hours=24) -> DataFrame:
    """Q14: CRITICAL/HIGH admin grants active in the window."""
    return _drill_down(r_aa, as_of, hours,
                       ["actor", "target_user", "admin_assignments_count", "unique_targets"],
                       ["immediate_actions", "investigation_steps"])


def q15_workspace_acl(r_wa: DataFrame, as_of, hours=24) -> DataFrame:
    """Q15: HIGH/CRITICAL workspace ACL changes active in the window."""
    return _drill_down(r_wa, as_of, hours, ["actor", "target_user", "new_acl", "acl_changes_count"],
                       ["immediate_actions"])


def q16_sensitive_group(r_sg: DataFrame, as_of, hours=24) -> DataFrame:
    """Q16: HIGH/CRITICAL sensitive-group additions active in the window."""
    return _drill_down(r_sg, as_of, hours,
                       ["actor", "target_user", "group_name", "group_additions_count"],
                       ["immediate_actions"])


def q17_uc_permission(r_uc: DataFrame, as_of, hours=24) -> DataFrame:
    """Q17: HIGH/CRITICAL catalog permission escalations active in the window."""
    return _drill_down(r_uc, as_of, hours,
                       ["actor", "target_principal", "securable_type", "securable_full_name",
                        "permissions"],
                       ["immediate_actions"])


def q18_account_setting(r_as: DataFrame, as_of, hours=24) -> DataFrame:
    """Q18: HIGH/CRITICAL account setting changes active in the window."""
    return _drill_down(r_as, as_of, hours,
                       ["actor", "key_type", "key_name", "settings", "setting_changes_count"],
                       ["immediate_actions"])
