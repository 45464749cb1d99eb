"""Typed detections (scan -> filter -> project).

Each function takes the audit DataFrame (batch or streaming) and returns a
lazy DataFrame. Predicates use plain column comparisons so that Catalyst
pushes them into the parquet scan; only the columns used are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.exprs import actor, param, since, status_code
from auditlens.sources.tags import SENSITIVE_GROUPS, with_tags

# Service and action names the rules match, and their labels.
LOGIN_ACTIONS = ("login",)
ACCOUNTS = "accounts"
ADMIN_ACTIONS = ("setAccountAdmin", "setAdmin")
WORKSPACE_ACL_ACTION = "changeDatabricksWorkspaceAcl"
GROUP_ADD_ACTIONS = ("addPrincipalToGroup", "addPrincipalsToGroup")
SQL_ACL_ACTION = "changeDatabricksSqlAcl"
UC_SERVICE = "unityCatalog"
UC_ACTION = "updatePermissions"
UC_CHANGE_PATTERNS = ("%OWNERSHIP%", "%ALL_PRIVILEGES%", "%MANAGE%")
UC_SECURABLE_TYPES = ("CATALOG", "SCHEMA", "TABLE")
UC_SYSTEM_NAME = "system"
SETTING_ACTIONS = ("setSetting", "deleteSetting")
CHANGES_SCHEMA = "array<struct<principal:string, add:string>>"

# The four export sources (service, actions, source label, artifact key, strict status).
EXPORT_BRANCHES = {
    "sql": ("databrickssql", ("downloadQueryResult",), None, "queryId", False),
    "files": ("filesystem", ("filesGet",), "filesystem", "path", False),
    "notebook": ("notebook", ("downloadLargeResults", "downloadPreviewResults"), "notebook",
                 "notebookFullPath", False),
    "dashboards": ("dashboards", ("triggerDashboardSnapshot",), "dashboards", "dashboard_id", True),
}
EXPORT_LOOKBACK_HOURS = 168


def _service(name: str) -> Column:
    return F.col("service_name") == name


def auth_failure_filter() -> Column:
    """Row predicate of D1 (a NULL status is not a failure)."""
    return F.col("action_name").isin(*LOGIN_ACTIONS) & (status_code() != 200)


def account_admin_filter() -> Column:
    """Row predicate of D2."""
    return _service(ACCOUNTS) & F.col("action_name").isin(*ADMIN_ACTIONS)


def auth_events(audit: DataFrame) -> DataFrame:
    """Failed logins (status present and not 200), any service, no time bound."""
    return audit.filter(auth_failure_filter()).select(
        "event_time",
        "event_date",
        "service_name",
        F.coalesce(F.col("user_identity.email"), param("user")).alias("username"),
        param("authenticationMethod").alias("authentication_method"),
        "user_agent",
        "action_name",
        status_code().alias("response_code"),
        F.col("response.error_message").alias("response_message"),
        F.col("response.result").alias("result"),
        F.col("source_ip_address").alias("source_ip"),
    )


def account_admin_assignments(audit: DataFrame) -> DataFrame:
    """Account or workspace admin granted."""
    return audit.filter(account_admin_filter()).select(
        "event_time", "service_name", "workspace_id",
        actor().alias("actor"),
        param("targetUserName").alias("target_user"),
        "action_name",
        F.lit("ACCOUNT_ADMIN_GRANTED").alias("indicator"),
        F.lit("Critical").alias("severity"),
    )


def workspace_acl_assignments(audit: DataFrame) -> DataFrame:
    """D3: workspace ACL changed."""
    return audit.filter(
        _service(ACCOUNTS) & (F.col("action_name") == WORKSPACE_ACL_ACTION)
    ).select(
        "event_time", "service_name", "workspace_id",
        actor().alias("actor"),
        param("targetUserId").alias("target_user"),
        "action_name",
        param("aclPermissionSet").alias("new_acl"),
        F.lit("WORKSPACE_ACL_CHANGED").alias("indicator"),
        F.lit("Medium").alias("severity"),
    )


def sensitive_group_additions(audit: DataFrame, groups=SENSITIVE_GROUPS) -> DataFrame:
    """Principal added to a sensitive group.

    The inner join with the duplicate-free group list is an ``isin`` test:
    no join, and the list is a parameter.
    """
    return audit.filter(
        _service(ACCOUNTS)
        & F.col("action_name").isin(*GROUP_ADD_ACTIONS)
        & param("targetGroupName").isin(*groups)
    ).select(
        "event_time", "service_name", "workspace_id",
        actor().alias("actor"),
        param("targetUserName").alias("target_user"),
        param("targetGroupName").alias("group_name"),
        "action_name",
        F.lit("SENSITIVE_GROUP_ADDED").alias("indicator"),
        F.lit("Medium").alias("severity"),
    )


def workspace_db_sql_acl_changes(audit: DataFrame) -> DataFrame:
    """Workspace or SQL ACL change."""
    return audit.filter(
        _service(ACCOUNTS) & F.col("action_name").isin(SQL_ACL_ACTION)
    ).select(
        "event_time", "service_name", "workspace_id",
        actor().alias("actor"),
        param("targetUserId").alias("target_principal"),
        "action_name",
        param("aclPermissionSet").alias("new_acl"),
        F.lit("WORKSPACE_OR_DBSQL_ACL_CHANGE").alias("indicator"),
        F.lit("Medium").alias("severity"),
    )


def uc_candidate_filter() -> Column:
    """Row predicate of D6 that needs no tag lookup.

    The LIKE tests run on the whole ``changes`` text (``_`` is a one-letter
    wildcard), so one matching element keeps every element of the event.
    """
    changes = param("changes")
    like_any = changes.like(UC_CHANGE_PATTERNS[0])
    for pattern in UC_CHANGE_PATTERNS[1:]:
        like_any = like_any | changes.like(pattern)
    return (
        _service(UC_SERVICE)
        & (F.col("action_name") == UC_ACTION)
        & like_any
        & param("securable_type").isin(*UC_SECURABLE_TYPES)
    )


def uc_permission_escalations(audit: DataFrame, tags: DataFrame, dedupe_tags: bool = False) -> DataFrame:
    """Ownership / all-privileges / manage grants on sensitive securables.

    A securable is sensitive when its name contains ``pii``, is ``system``,
    or is tagged (left join with S2; a table with several matching tags
    repeats the event once per tag unless ``dedupe_tags``). The audit side is
    filtered before the join, and AQE picks the join from the sizes it
    measures. Each element of ``changes`` becomes a row. A tag table with
    validity intervals is joined as of the event's time.
    """
    item = F.explode(F.from_json(F.col("_changes"), CHANGES_SCHEMA)).alias("_item")
    return _sensitive_changes(audit, tags, dedupe_tags).select("*", item).select(
        "event_time", "service_name", "workspace_id", "actor",
        "securable_type", "securable_full_name", "action_name",
        F.lit("UC_PERMISSION_CHANGE").alias("escalation_type"),
        F.col("_item.principal").alias("target_principal"),
        F.col("_item.add").alias("permissions"),
    )


def _sensitive_changes(audit: DataFrame, tags: DataFrame, dedupe_tags: bool) -> DataFrame:
    """The events of D6 before their ``changes`` are taken apart."""
    candidates = audit.filter(uc_candidate_filter()).select(
        "event_time", "service_name", "workspace_id", "action_name",
        actor().alias("actor"),
        param("securable_type").alias("securable_type"),
        param("securable_full_name").alias("securable_full_name"),
        param("changes").alias("_changes"),
    )
    name = F.col("securable_full_name")
    return with_tags(candidates, tags, dedupe_tags).filter(
        name.like("%pii%") | (name == UC_SYSTEM_NAME) | F.col("_tagged_name").isNotNull())


def uc_refused_changes(audit: DataFrame, tags: DataFrame, dedupe_tags: bool = False) -> DataFrame:
    """The events of D6 that give it no row, because their ``changes`` can't be taken apart, with the reason.

    ``malformed``: no JSON; ``not_an_array``: another JSON value; ``empty``: an array of nothing;
    ``unexpected_elements``: an array, but not of objects with the declared fields. Every event is either here or
    in D6 with a row for each element.
    """
    parsed = F.from_json(F.col("_changes"), CHANGES_SCHEMA)
    value = F.try_parse_json("_changes")
    elements = F.try_variant_get(value, "$", "array<variant>")
    reason = (F.when(value.isNull(), "malformed").when(elements.isNull(), "not_an_array")
              .when(F.size(elements) == 0, "empty").otherwise("unexpected_elements"))
    refused = _sensitive_changes(audit, tags, dedupe_tags).filter(parsed.isNull() | (F.size(parsed) == 0))
    return refused.select("event_time", "service_name", "workspace_id", "actor", "securable_type", "securable_full_name",
                          F.col("_changes").alias("changes"), reason.alias("reason"))


def account_setting_changes(audit: DataFrame) -> DataFrame:
    """Account-level setting set or deleted."""
    return audit.filter(
        _service(ACCOUNTS) & F.col("action_name").isin(*SETTING_ACTIONS)
    ).select(
        "event_time", "service_name", "workspace_id",
        actor().alias("actor"),
        "action_name",
        param("settingKeyTypeName").alias("key_type"),
        param("settingKeyName").alias("key_name"),
        param("settingValueForAudit").alias("settings"),
    )


def _export_predicate(branch: str) -> Column:
    service, actions, _, _, strict = EXPORT_BRANCHES[branch]
    status_ok = (status_code() == 200) if strict else (F.coalesce(status_code(), F.lit(200)) == 200)
    return _service(service) & F.col("action_name").isin(*actions) & status_ok


def export_filter() -> Column:
    """Row predicate of D8: any of the four export branches (without the look-back).

    Led by a superset test on plain columns (service and action lists) that
    parquet can evaluate; the exact branch disjunction follows.
    """
    names = list(EXPORT_BRANCHES)
    any_branch = _export_predicate(names[0])
    for name in names[1:]:
        any_branch = any_branch | _export_predicate(name)
    services = [b[0] for b in EXPORT_BRANCHES.values()]
    actions = [a for b in EXPORT_BRANCHES.values() for a in b[1]]
    return F.col("service_name").isin(*services) & F.col("action_name").isin(*actions) & any_branch


def _export_columns(source: Column, artifact: Column) -> list[Column]:
    return [
        "workspace_id",
        actor().alias("actor"),
        source.alias("source"),
        "action_name",
        artifact.cast("string").alias("artifact"),
        "event_time",
    ]


def data_export_branch(audit: DataFrame, branch: str, as_of=None,
                       hours: float | None = EXPORT_LOOKBACK_HOURS) -> DataFrame:
    """D8a-d: one export source (``sql``, ``files``, ``notebook``, ``dashboards``)."""
    service, _, label, key, _ = EXPORT_BRANCHES[branch]
    if hours is not None and as_of is None:
        raise ValueError("as_of is required when a look-back is set")
    source = F.col("service_name") if label is None else F.lit(label)
    rows = audit.filter(_export_predicate(branch))
    rows = since(rows, as_of, hours) if hours is not None else rows
    return rows.select(*_export_columns(source, param(key)))


def data_export_detection(audit: DataFrame, as_of=None,
                          hours: float | None = EXPORT_LOOKBACK_HOURS) -> DataFrame:
    """All four export sources in one scan.

    The branches select disjoint services, so the union of the four
    filtered projections equals one filter on their disjunction with the
    source label and artifact picked by a ``when`` chain: one audit scan
    instead of four. ``hours=None`` drops the look-back (streams).
    """
    if hours is not None and as_of is None:
        raise ValueError("as_of is required when a look-back is set")
    names = list(EXPORT_BRANCHES)
    rows = audit.filter(export_filter())
    rows = since(rows, as_of, hours) if hours is not None else rows
    source = None
    artifact = None
    for name in names:
        service, _, label, key, _ = EXPORT_BRANCHES[name]
        branch_source = F.col("service_name") if label is None else F.lit(label)
        hit = F.col("service_name") == service
        source = F.when(hit, branch_source) if source is None else source.when(hit, branch_source)
        artifact = F.when(hit, param(key)) if artifact is None else artifact.when(hit, param(key))
    return rows.select(*_export_columns(source, artifact))
