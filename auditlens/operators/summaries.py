"""Per actor / entity summaries over a look-back window.

Window: ``event_time >= as_of - hours`` with no upper bound. The bound is a
literal, so it reaches the scan. Aggregates are partial + final hash
aggregates (map-side combine), so a hot key ships one partial row per map
task, never its raw rows.

All aggregates merge, so every summary also takes rows that stand for many
events each (``PARTIAL``: the states that plans.incremental keeps per day).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.exprs import since, ts_literal

LOOKBACK_HOURS = 168

# Labels of the two failed-login pattern families.
IP_BASED = ("IP_BASED", "source_ip")
USER_BASED = ("USER_BASED", "user")


class Measure(NamedTuple):
    """Columns of a summary's input: how many events a row stands for (None: one), its first and its last event."""

    n: str | None = None
    first: str = "event_time"
    last: str = "event_time"

    def count(self) -> Column:
        return F.count(F.lit(1)) if self.n is None else F.coalesce(F.sum(self.n), F.lit(0)).cast("bigint")

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(c for c in self if c is not None))


EVENTS = Measure()
PARTIAL = Measure("n", "first_event", "last_event")


def _present(column: str) -> Column:
    """COUNT(DISTINCT key) inside a group where ``key`` is a grouping key: 1, or 0 for NULL."""
    return F.when(F.col(column).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _tagged_logins(d1: DataFrame, families, measure: Measure = EVENTS) -> DataFrame:
    """One row per (family, failed login) with its entity and counter-entity."""
    options = {
        "IP_BASED": ("source_ip", "username"),
        "USER_BASED": ("username", "source_ip"),
    }
    tagged = [
        F.struct(
            F.lit(detection_type).alias("detection_type"),
            F.lit(entity_type).alias("entity_type"),
            F.col(options[detection_type][0]).alias("entity"),
            F.col(options[detection_type][1]).alias("other"),
        )
        for detection_type, entity_type in families
    ]
    if len(tagged) == 1:
        rows = d1.select(tagged[0].alias("t"), "user_agent", *measure.columns)
    else:
        rows = d1.select(F.explode(F.array(*tagged)).alias("t"), "user_agent", *measure.columns)
    return rows.select("t.*", "user_agent", *measure.columns).filter(F.col("entity").isNotNull())


_ENTITY = ["detection_type", "entity_type", "entity"]


def _login_patterns(d1: DataFrame, as_of, hours, families, lists: bool = True, measure: Measure = EVENTS) -> DataFrame:
    """Failed-login patterns, aggregated in two phases.

    Phase 1 groups by (entity, counter-entity) with count/min/max, which
    spreads a hot entity over many tasks; phase 2 groups by entity and counts
    the counter-entities, one row each, so no task holds a set of them.
    ``lists`` adds the sorted arrays, which are as large as an entity's
    counter-entities: for display, not for the reports.
    """
    rows = _tagged_logins(since(d1, as_of, hours), families, measure)
    phase1 = rows.groupBy(*_ENTITY, "other").agg(
        measure.count().alias("n"),
        F.min(measure.first).alias("first_attempt"),
        F.max(measure.last).alias("last_attempt"),
    )
    phase2 = phase1.groupBy(*_ENTITY).agg(
        F.sum("n").cast("bigint").alias("failed_attempts"),
        F.count("other").alias("unique_entities"),
        F.min("first_attempt").alias("first_attempt"),
        F.max("last_attempt").alias("last_attempt"),
    )
    out = phase2.select(
        "detection_type",
        F.col("entity").alias("entity_id"),
        F.col("entity").alias("entity_name"),
        "entity_type",
        "failed_attempts",
        "unique_entities",
        "first_attempt",
        "last_attempt",
        ts_literal(as_of, d1.schema[measure.last].dataType).alias("detection_timestamp"),
    )
    if not lists:
        return out
    return out.join(failed_login_lists(d1, as_of, hours, families, measure), ["detection_type", "entity_id"])


def failed_login_relations(d1: DataFrame, as_of, hours: float | None = LOOKBACK_HOURS,
                           families=(IP_BASED, USER_BASED), measure: Measure = EVENTS) -> DataFrame:
    """Who met whom, as a long relation: entity, counter-entity, agent and number of failed logins."""
    rows = _tagged_logins(since(d1, as_of, hours), list(families), measure)
    return rows.groupBy(*_ENTITY, "other", "user_agent").agg(measure.count().alias("failed_attempts"))


def failed_login_lists(d1: DataFrame, as_of, hours: float | None = LOOKBACK_HOURS,
                       families=(IP_BASED, USER_BASED), measure: Measure = EVENTS) -> DataFrame:
    """The counter-entities and agents of every entity as sorted arrays."""
    relations = failed_login_relations(d1, as_of, hours, families, measure)
    return relations.groupBy("detection_type", F.col("entity").alias("entity_id")).agg(
        F.sort_array(F.collect_set("other")).alias("related_entities"),
        F.sort_array(F.collect_set("user_agent")).alias("user_agents"))


def failed_logins_by_ip(d1: DataFrame, as_of, hours: float | None = LOOKBACK_HOURS, measure: Measure = EVENTS) -> DataFrame:
    """A1: failed logins per source IP (NULL IPs left out)."""
    return _login_patterns(d1, as_of, hours, [IP_BASED], measure=measure)


def failed_logins_by_user(d1: DataFrame, as_of, hours: float | None = LOOKBACK_HOURS, measure: Measure = EVENTS) -> DataFrame:
    """A2: failed logins per user name (NULL names left out)."""
    return _login_patterns(d1, as_of, hours, [USER_BASED], measure=measure)


def failed_login_patterns(d1: DataFrame, as_of, hours: float | None = LOOKBACK_HOURS,
                          lists: bool = True, measure: Measure = EVENTS) -> DataFrame:
    """A3: A1 UNION ALL A2, computed in one pass over D1 (each login tagged twice)."""
    return _login_patterns(d1, as_of, hours, [IP_BASED, USER_BASED], lists, measure)


def _activity(detection: DataFrame, as_of, hours, keys: list[str], count_name: str,
              uniques: list[tuple[str, str]], measure: Measure = EVENTS) -> DataFrame:
    """GROUP BY ALL over ``keys`` with count, first/last and the per-key ``unique_*`` flags."""
    windowed = since(detection, as_of, hours)
    grouped = windowed.groupBy(*keys).agg(
        measure.count().alias(count_name),
        F.min(measure.first).alias("first_activity"),
        F.max(measure.last).alias("last_activity"),
    )
    return grouped.select(
        *keys,
        count_name,
        *[_present(source).alias(name) for name, source in uniques],
        "first_activity",
        "last_activity",
    )


def account_admin_activity(d2: DataFrame, as_of, hours=LOOKBACK_HOURS, measure: Measure = EVENTS) -> DataFrame:
    """A4: account-admin grants per (service, workspace, actor, target, action)."""
    return _activity(d2, as_of, hours,
                     ["service_name", "workspace_id", "actor", "target_user", "action_name"],
                     "admin_assignments_count", [("unique_targets", "target_user")], measure)


def workspace_acl_activity(d3: DataFrame, as_of, hours=LOOKBACK_HOURS, measure: Measure = EVENTS) -> DataFrame:
    """A5: workspace ACL changes per A4 keys + new ACL."""
    return _activity(d3, as_of, hours,
                     ["service_name", "workspace_id", "actor", "target_user", "action_name", "new_acl"],
                     "acl_changes_count", [("unique_targets", "target_user")], measure)


def sensitive_group_activity(d4: DataFrame, as_of, hours=LOOKBACK_HOURS, measure: Measure = EVENTS) -> DataFrame:
    """Sensitive-group additions per A4 keys + group."""
    return _activity(d4, as_of, hours,
                     ["service_name", "workspace_id", "actor", "target_user", "group_name", "action_name"],
                     "group_additions_count",
                     [("unique_targets", "target_user"), ("unique_groups", "group_name")], measure)


def uc_permission_activity(d6: DataFrame, as_of, hours=LOOKBACK_HOURS, measure: Measure = EVENTS) -> DataFrame:
    """UC permission changes per securable, principal and permission text."""
    return _activity(d6, as_of, hours,
                     ["service_name", "workspace_id", "actor", "securable_type", "securable_full_name",
                      "action_name", "escalation_type", "target_principal", "permissions"],
                     "permission_changes_count",
                     [("unique_targets", "target_principal"), ("unique_securables", "securable_full_name")], measure)


def account_setting_activity(d7: DataFrame, as_of, hours=LOOKBACK_HOURS, measure: Measure = EVENTS) -> DataFrame:
    """Account-setting changes per key and value."""
    return _activity(d7, as_of, hours,
                     ["service_name", "workspace_id", "actor", "action_name", "key_type", "key_name",
                      "settings"],
                     "setting_changes_count", [("unique_keys", "key_name")], measure)


def export_activity(d8: DataFrame, measure: Measure = EVENTS) -> DataFrame:
    """Exports per (workspace, actor, source, action, artifact); D8 is already bounded."""
    keys = ["workspace_id", "actor", "source", "action_name", "artifact"]
    return d8.groupBy(*keys).agg(
        F.min(measure.first).alias("first_activity"),
        F.max(measure.last).alias("last_activity"),
        measure.count().alias("export_count"),
    ).select(*keys, "first_activity", "last_activity", "export_count")


def actor_unique_targets(detection: DataFrame, as_of, target: str = "target_user",
                         hours: float | None = LOOKBACK_HOURS) -> DataFrame:
    """Distinct targets of every actor in the look-back: actor, actor_unique_targets (NULL targets not counted).

    Two grouped aggregates, not a window over the actor, so the NULL actor and
    hot ones are combined before the shuffle; join it to a summary with
    ``eqNullSafe``.
    """
    pairs = since(detection, as_of, hours).groupBy("actor", target).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("actor").agg(F.count(target).alias("actor_unique_targets"))
