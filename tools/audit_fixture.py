"""Audit-log fixture derived from the ``events`` test table.

The expressions are the ones fixed in FIXTURES.md section 3; they are SQL
text so that the same definitions feed the Spark fixture and the DuckDB
oracle. Only ``k`` (the JSON field of ``props``) differs between dialects.
The work grows with ``events``: one projection per input row.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.session import ensure_checkpoint_dir

K_SPARK = "CAST(get_json_object(props, '$.k') AS INT)"
K_DUCKDB = "CAST(json_extract_string(props, '$.k') AS INT)"
S_EXPR = "(event_id*7+user_id)%20"

# The fixture definition (FIXTURES.md section 3), flat column -> SQL.
FLAT_COLUMNS: list[tuple[str, str]] = [
    ("event_id", "event_id"),
    ("event_time", "ts"),
    ("event_date", "CASE WHEN event_id%29=0 THEN NULL WHEN event_id%31=0 THEN CAST(ts AS DATE) - 3 ELSE CAST(ts AS DATE) END"),
    ("workspace_id", "CAST(user_id%2 AS BIGINT)"),
    ("service_name", "CASE WHEN s IN (12,13) THEN 'unityCatalog' WHEN s=15 THEN 'databrickssql' "
                     "WHEN s=16 THEN 'filesystem' WHEN s=17 THEN 'notebook' WHEN s=18 THEN 'dashboards' "
                     "WHEN s=19 THEN 'clusters' ELSE 'accounts' END"),
    ("action_name", "CASE WHEN s<=5 THEN 'login' WHEN s=6 THEN 'setAdmin' WHEN s=7 THEN 'setAccountAdmin' "
                    "WHEN s=8 THEN 'changeDatabricksWorkspaceAcl' WHEN s=9 THEN 'addPrincipalToGroup' "
                    "WHEN s=10 THEN 'addPrincipalsToGroup' WHEN s=11 THEN 'changeDatabricksSqlAcl' "
                    "WHEN s IN (12,13) THEN 'updatePermissions' WHEN s=14 AND k%2=0 THEN 'setSetting' "
                    "WHEN s=14 THEN 'deleteSetting' WHEN s=15 THEN 'downloadQueryResult' "
                    "WHEN s=16 THEN 'filesGet' WHEN s=17 AND k%2=0 THEN 'downloadLargeResults' "
                    "WHEN s=17 THEN 'downloadPreviewResults' WHEN s=18 THEN 'triggerDashboardSnapshot' "
                    "ELSE 'create' END"),
    ("email", "CASE WHEN event_id%7>1 THEN 'user'||CAST(CASE WHEN event_id%5<3 THEN user_id%4 ELSE user_id END AS STRING)"
              "||'@example.com' END"),
    ("run_by", "CASE WHEN event_id%7<>0 THEN 'svc'||CAST(user_id%3 AS STRING) END"),
    ("source_ip", "CASE WHEN event_id%13=0 THEN NULL WHEN event_id%3=0 THEN '10.0.0.1' WHEN event_id%4=0 "
                  "THEN '10.0.1.'||CAST(event_id%37 AS STRING) ELSE '10.1.'||CAST(event_id-event_id%40 AS STRING) END"),
    ("user_agent", "'agent/'||CAST(k%4 AS STRING)"),
    ("status_code", "CASE WHEN event_type='error' THEN 401 WHEN event_type='signup' AND s<=5 THEN 403 "
                    "WHEN event_type='view' THEN NULL ELSE 200 END"),
    ("error_message", "CASE WHEN event_type='error' THEN 'denied' END"),
    ("result", "CASE WHEN event_type='error' THEN 'fail' ELSE 'ok' END"),
    ("p_user", "CASE WHEN s<=5 AND k%5<>0 THEN 'user'||CAST(user_id AS STRING)||'@example.com' END"),
    ("p_auth", "CASE WHEN s>5 THEN NULL WHEN k%3=0 THEN 'password' WHEN k%3=1 THEN 'sso' ELSE 'token' END"),
    ("p_target_name", "CASE WHEN s IN (6,7,9,10) AND event_id%17<>0 THEN 'target'||CAST(CASE WHEN k%3=0 THEN user_id ELSE user_id%2 END AS STRING) END"),
    ("p_target_id", "CASE WHEN s IN (8,11) AND event_id%17<>0 THEN 'target'||CAST(CASE WHEN k%3=0 THEN user_id ELSE user_id%2 END AS STRING) END"),
    ("p_acl", "CASE WHEN s IN (8,11) THEN 'acl'||CAST(k%2 AS STRING) END"),
    ("p_group", "CASE WHEN s NOT IN (9,10) THEN NULL WHEN k%6=0 THEN 'admins' WHEN k%6=1 THEN 'account_admins' "
                "WHEN k%6=2 THEN 'metastore_admins' WHEN k%6=3 THEN 'security-admins' ELSE 'analysts' END"),
    ("p_sec_type", "CASE WHEN s NOT IN (12,13) THEN NULL WHEN k%5=4 THEN 'FUNCTION' WHEN k%4=2 THEN 'CATALOG' "
                   "ELSE 'TABLE' END"),
    ("p_sec_name", "CASE WHEN s NOT IN (12,13) THEN NULL WHEN k%4=0 THEN 'main.pii.t1' "
                   "WHEN k%4=1 THEN 'main.hr.t'||CAST(user_id%500+1 AS STRING) "
                   "WHEN k%4=2 THEN 'system' ELSE 'main.sales.t'||CAST(user_id AS STRING) END"),
    ("p_changes", "CASE WHEN s NOT IN (12,13) THEN NULL "
                  "WHEN k%3=0 THEN '[{\"principal\":\"p1\",\"add\":[\"ALL_PRIVILEGES\"]},{\"principal\":\"p2\",\"add\":[\"SELECT\"]}]' "
                  "WHEN k%3=1 THEN '[{\"principal\":\"p1\",\"add\":[\"MANAGE\"]}]' "
                  "WHEN event_id%2=0 THEN '[{\"principal\":\"p3\",\"add\":[\"OWNERSHIP\"]}]' "
                  "ELSE '[{\"principal\":\"p1\",\"add\":[\"SELECT\"]}]' END"),
    ("p_key_type", "CASE WHEN s=14 THEN 'type'||CAST(k%2 AS STRING) END"),
    ("p_key_name", "CASE WHEN s=14 THEN 'key'||CAST(k%3 AS STRING) END"),
    ("p_setting", "CASE WHEN s=14 AND k%7<>0 THEN 'on' END"),
    ("p_query_id", "CASE WHEN s=15 THEN 'query'||CAST(CASE WHEN k%3=0 THEN user_id ELSE user_id%2 END AS STRING) END"),
    ("p_path", "CASE WHEN s=16 THEN '/data/f'||CAST(CASE WHEN k%3=0 THEN user_id ELSE user_id%2 END AS STRING) END"),
    ("p_notebook", "CASE WHEN s=17 THEN '/nb/n'||CAST(CASE WHEN k%3=0 THEN user_id ELSE user_id%2 END AS STRING) END"),
    ("p_dashboard", "CASE WHEN s=18 THEN 'dash'||CAST(CASE WHEN k%3=0 THEN user_id ELSE user_id%2 END AS STRING) END"),
]

# request_params key carried by each flat fixture column.
PARAM_KEYS: list[tuple[str, str]] = [
    ("user", "p_user"),
    ("authenticationMethod", "p_auth"),
    ("targetUserName", "p_target_name"),
    ("targetUserId", "p_target_id"),
    ("aclPermissionSet", "p_acl"),
    ("targetGroupName", "p_group"),
    ("securable_type", "p_sec_type"),
    ("securable_full_name", "p_sec_name"),
    ("changes", "p_changes"),
    ("settingKeyTypeName", "p_key_type"),
    ("settingKeyName", "p_key_name"),
    ("settingValueForAudit", "p_setting"),
    ("queryId", "p_query_id"),
    ("path", "p_path"),
    ("notebookFullPath", "p_notebook"),
    ("dashboard_id", "p_dashboard"),
]

#: The table-tag fixture as SQL over ``supplier`` (every tenth table has two tags).
TAGS_SQL = """
SELECT 'main' AS catalog_name, 'hr' AS schema_name, 't' || CAST(s_suppkey AS STRING) AS table_name,
       CASE s_suppkey % 3 WHEN 0 THEN 'pii_email' WHEN 1 THEN 'public' ELSE 'pii_name' END AS tag_value FROM supplier
UNION ALL
SELECT 'main', 'hr', 't' || CAST(s_suppkey AS STRING), 'pii_phone' FROM supplier WHERE s_suppkey % 10 = 2
"""


#: The tag fixture with its history as SQL: tags begin on different days, and every fourth table's end after six days.
TAG_HISTORY_SQL = """
SELECT t.*, CAST(DATE '2024-01-05' + CAST(s.s_suppkey % 20 AS INT) AS {ts}) AS valid_from,
       CASE WHEN s.s_suppkey % 4 = 0 THEN CAST(DATE '2024-01-11' + CAST(s.s_suppkey % 20 AS INT) AS {ts}) END AS valid_to
FROM (""" + TAGS_SQL + """) t JOIN supplier s ON t.table_name = 't' || CAST(s.s_suppkey AS STRING)
"""

ARRIVALS = 6
#: When a row arrives: with the five days of its time, and some rows one or two such spans late (the same SQL for both sides).
ARRIVAL = (f"LEAST({ARRIVALS - 1}, CAST(FLOOR((CAST({{day}} AS INT) - 1) / 5) AS INT) + CASE WHEN event_id % 23 = 7 THEN 2 "
           "WHEN event_id % 11 = 5 THEN 1 ELSE 0 END)")


def flat_audit(events: DataFrame) -> DataFrame:
    """The flat fixture columns, one row per event."""
    base = events.selectExpr("*", f"{K_SPARK} AS k", f"{S_EXPR} AS s")
    return base.selectExpr(*[f"{expr} AS {name}" for name, expr in FLAT_COLUMNS])


def audit_from_events(events: DataFrame) -> DataFrame:
    """Nest the flat fixture into the audit-log shape (structs + map)."""
    flat = flat_audit(events)
    pairs = []
    for key, column in PARAM_KEYS:
        pairs += [F.lit(key), F.col(column)]
    params = F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull())
    return flat.select(
        "event_id",
        "event_time",
        "event_date",
        "service_name",
        "action_name",
        "workspace_id",
        "user_agent",
        F.col("source_ip").alias("source_ip_address"),
        F.struct(F.col("email")).alias("user_identity"),
        F.struct(F.col("run_by")).alias("identity_metadata"),
        F.struct("status_code", "error_message", "result").alias("response"),
        params.alias("request_params"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def audit_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit fixture as a lazy projection of ``events`` (recomputed on every read)."""
    return audit_from_events(events(spark, sf_dir))


_BUILT: dict[str, str] = {}
_LOCK = threading.Lock()


def _fixture_key(sf_dir: str) -> str:
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    try:
        st = os.stat(path)
        stamp = f"{os.path.realpath(path)}:{st.st_size}:{st.st_mtime_ns}"
    except OSError:
        stamp = path
    return hashlib.sha1(stamp.encode()).hexdigest()[:16]


def audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit fixture written once as a parquet table, then read like the real audit log.

    A deployment reads a physical audit table; this gives the tests the
    same shape: a scan partitioned by ``event_date`` (look-backs prune
    whole days) where ``service_name`` / ``action_name`` / ``event_time``
    predicates are pushed into parquet. The table is built by Spark from
    ``events`` (one pass, whole table) into the session's checkpoint
    folder, files of AQE's advisory size, sorted by day, service and action so that
    row-group statistics can skip unrelated rows, and reused for the session.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    key = _fixture_key(sf_dir)
    with _LOCK:
        path = _BUILT.get(key)
        if path is None:
            path = f"{root}/auditlens-fixture-{key}"
            frame = audit_from_events(events(spark, sf_dir))
            (frame.hint("rebalance", "event_date")
                  .sortWithinPartitions("event_date", "service_name", "action_name", "event_time")
                  .write.mode("overwrite").partitionBy("event_date").parquet(path))
            _BUILT[key] = path
    return spark.read.parquet(path)


def tag_history_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tags with the time each holds."""
    return spark.sql(TAG_HISTORY_SQL.format(ts="TIMESTAMP_NTZ").replace("supplier", "{supplier}"),
                     supplier=spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet"))


def tags_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TAGS_SQL.replace("supplier", "{supplier}"),
                     supplier=spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet"))
