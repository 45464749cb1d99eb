"""One pass over the audit log for every windowed detection.

Written as separate views, every rule reads the audit log again, and
Catalyst does not merge the scans of a union. ``detection_candidates`` reads
the common look-back once, tags each row with its rule and brings all rules
into one shape; it is written once (``SecurityPipeline.refresh``) and split
back into the detection shapes by ``windowed_detections``. Only D6, whose
alert looks back further than the summaries, adds a second, narrow scan of
the older days: its own service, action and columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.exprs import DatePartition, actor, param, parse_as_of, since, time_type, ts_literal
from auditlens.operators import detections as D
from auditlens.sources.tags import with_tags


def after(df: DataFrame, as_of, hours: float) -> Column:
    bound = parse_as_of(as_of) - dt.timedelta(hours=hours)
    return F.col("event_time") >= ts_literal(bound, time_type(df))


# Rule ids of the windowed detections.
D1, D2, D3, D4, D6, D7, D8 = "D1", "D2", "D3", "D4", "D6", "D7", "D8"
CANDIDATE_COLUMNS = (
    "rule", "event_time", "event_date", "service_name", "workspace_id", "action_name", "actor",
    "username", "authentication_method", "user_agent", "response_code", "response_message", "result",
    "source_ip", "target_user", "new_acl", "group_name", "securable_type", "securable_full_name",
    "changes", "key_type", "key_name", "settings", "source", "artifact",
)


def detection_candidates(audit: DataFrame, as_of=None, hours: float | None = 168, uc_hours: float | None = 720,
                         export_hours: float = D.EXPORT_LOOKBACK_HOURS, contract: DatePartition | None = None) -> DataFrame:
    """Every audit row any windowed rule keeps, tagged with its rule, in one shape.

    Each rule matches its own action names, so a row belongs to at most one
    rule and a ``when`` chain tags it. D8 keeps its own look-back
    (``export_hours``) whatever ``hours`` is, and D6 is kept for ``uc_hours``
    with its raw ``changes``: the tag lookup and the explode run later on the
    small D6 subset. ``hours=None`` keeps every row (a stream appending to a
    detections table; see ``within_windows``).
    """
    predicates = [
        (D1, D.auth_failure_filter()),
        (D2, D.account_admin_filter()),
        (D3, (F.col("service_name") == D.ACCOUNTS) & (F.col("action_name") == D.WORKSPACE_ACL_ACTION)),
        (D4, (F.col("service_name") == D.ACCOUNTS) & F.col("action_name").isin(*D.GROUP_ADD_ACTIONS)
         & param("targetGroupName").isin(*D.SENSITIVE_GROUPS)),
        (D6, D.uc_candidate_filter()),
        (D7, (F.col("service_name") == D.ACCOUNTS) & F.col("action_name").isin(*D.SETTING_ACTIONS)),
        (D8, D.export_filter()),
    ]
    rule = None
    for name, pred in predicates:
        rule = F.when(pred, F.lit(name)) if rule is None else rule.when(pred, F.lit(name))
    actions = set(D.LOGIN_ACTIONS) | set(D.ADMIN_ACTIONS) | {D.WORKSPACE_ACL_ACTION, D.UC_ACTION}
    actions |= set(D.GROUP_ADD_ACTIONS) | set(D.SETTING_ACTIONS)
    for _, acts, _, _, _ in D.EXPORT_BRANCHES.values():
        actions |= set(acts)
    rule_actions = F.col("action_name").isin(*sorted(actions))
    if hours is None:
        return _shaped(audit.filter(rule_actions).select("*", rule.alias("rule")).filter(F.col("rule").isNotNull()))
    recent = max(hours, export_hours)
    tagged = since(audit, as_of, recent, contract=contract).filter(rule_actions).select("*", rule.alias("rule"))
    kept = _shaped(tagged.filter(F.col("rule").isNotNull() & _in_window(audit, as_of, hours, export_hours)))
    if uc_hours is None or uc_hours <= recent:
        return kept
    older = since(audit, as_of, uc_hours, contract=contract).filter(
        ~after(audit, as_of, recent) & D.uc_candidate_filter()).select("*", F.lit(D6).alias("rule"))
    return kept.unionByName(_shaped(older))


def _in_window(df: DataFrame, as_of, hours: float, export_hours: float) -> Column:
    """Rows within the look-back of their rule (D6 rows all pass)."""
    return (F.when(F.col("rule") == D6, F.lit(True)).when(F.col("rule") == D8, after(df, as_of, export_hours))
            .otherwise(after(df, as_of, hours)))


def _shaped(kept: DataFrame) -> DataFrame:
    def only(rules, value):
        return F.when(F.col("rule").isin(*rules), value)

    source = artifact = None
    for branch in D.EXPORT_BRANCHES.values():
        service, _, label, key, _ = branch
        hit = (F.col("rule") == D8) & (F.col("service_name") == service)
        src = F.col("service_name") if label is None else F.lit(label)
        source = F.when(hit, src) if source is None else source.when(hit, src)
        artifact = F.when(hit, param(key)) if artifact is None else artifact.when(hit, param(key))
    return kept.select(
        "rule", "event_time", "event_date", "service_name", "workspace_id", "action_name",
        actor().alias("actor"),
        only([D1], F.coalesce(F.col("user_identity.email"), param("user"))).alias("username"),
        only([D1], param("authenticationMethod")).alias("authentication_method"),
        "user_agent",
        only([D1], F.col("response.status_code")).alias("response_code"),
        only([D1], F.col("response.error_message")).alias("response_message"),
        only([D1], F.col("response.result")).alias("result"),
        F.col("source_ip_address").alias("source_ip"),
        F.when(F.col("rule").isin(D2, D4), param("targetUserName"))
         .when(F.col("rule") == D3, param("targetUserId")).alias("target_user"),
        only([D3], param("aclPermissionSet")).alias("new_acl"),
        only([D4], param("targetGroupName")).alias("group_name"),
        only([D6], param("securable_type")).alias("securable_type"),
        only([D6], param("securable_full_name")).alias("securable_full_name"),
        only([D6], param("changes")).alias("changes"),
        only([D7], param("settingKeyTypeName")).alias("key_type"),
        only([D7], param("settingKeyName")).alias("key_name"),
        only([D7], param("settingValueForAudit")).alias("settings"),
        source.alias("source"),
        artifact.cast("string").alias("artifact"),
    )


def within_windows(candidates: DataFrame, as_of, hours: float = 168, uc_hours: float = 720,
                   export_hours: float = D.EXPORT_LOOKBACK_HOURS) -> DataFrame:
    """The rows of a full detections table that a run at ``as_of`` uses (the same rows the windowed scan keeps)."""
    reach = max(hours, export_hours, uc_hours)
    widest = since(candidates, as_of, reach)
    if "day" in candidates.columns:  # the UTC day of the event, by which kept detections are partitioned
        widest = widest.filter(F.col("day") >= F.lit((parse_as_of(as_of) - dt.timedelta(hours=reach)).date()))
    return widest.filter(_in_window(candidates, as_of, hours, export_hours))


#: The detections that the tagged rows hold.
WINDOWED = {"d1": D1, "d2": D2, "d3": D3, "d4": D4, "d6": D6, "d7": D7, "d8": D8}
_BY = ("event_time", "service_name", "workspace_id", "actor")


def windowed_detections(candidates: DataFrame, tags: DataFrame, dedupe_tags: bool = False,
                        carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Split the tagged rows back into the detection shapes (same columns as D1-D8, and those of ``carry``)."""
    return {name: windowed_detection(name, candidates, tags, dedupe_tags, carry) for name in WINDOWED}


def windowed_detection(name: str, candidates: DataFrame, tags: DataFrame, dedupe_tags: bool = False,
                       carry: tuple[str, ...] = ()) -> DataFrame:
    """One detection of the tagged rows."""
    rows = candidates.filter(F.col("rule") == WINDOWED[name])

    def labelled(indicator: str, severity: str, *columns: str) -> DataFrame:
        return rows.select(*_BY, *columns, F.lit(indicator).alias("indicator"), F.lit(severity).alias("severity"), *carry)

    if name == "d1":
        return rows.select("event_time", "event_date", "service_name", "username", "authentication_method", "user_agent", "action_name",
                           "response_code", "response_message", "result", "source_ip", *carry)
    if name == "d2":
        return labelled("ACCOUNT_ADMIN_GRANTED", "Critical", "target_user", "action_name")
    if name == "d3":
        return labelled("WORKSPACE_ACL_CHANGED", "Medium", "target_user", "action_name", "new_acl")
    if name == "d4":
        return labelled("SENSITIVE_GROUP_ADDED", "Medium", "target_user", "group_name", "action_name")
    if name == "d7":
        return rows.select(*_BY, "action_name", "key_type", "key_name", "settings", *carry)
    if name == "d8":
        return rows.select("workspace_id", "actor", "source", "action_name", "artifact", "event_time", *carry)
    securable = F.col("securable_full_name")
    kept = with_tags(rows, tags, dedupe_tags).filter(
        securable.like("%pii%") | (securable == D.UC_SYSTEM_NAME) | F.col("_tagged_name").isNotNull())
    item = F.explode(F.from_json(F.col("changes"), D.CHANGES_SCHEMA)).alias("_item")
    return kept.select("*", item).select(
        *_BY, "securable_type", "securable_full_name", "action_name", F.lit("UC_PERMISSION_CHANGE").alias("escalation_type"),
        F.col("_item.principal").alias("target_principal"), F.col("_item.add").alias("permissions"), *carry)
