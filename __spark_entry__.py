"""

Every query reads the ``events`` table of the given scale directory,
derives the audit-log fixture from it (FIXTURES.md) and runs the library's
operators over the whole table. Array columns are shown as sorted,
comma-joined text and averages are rounded to 6 places so the results can
be hashed against the oracle.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import timedelta
from pathlib import Path

_HERE = Path(__file__).resolve().parent
if str(_HERE) not in sys.path:
    sys.path.insert(0, str(_HERE))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from auditlens.functions.exprs import joined_set  # noqa: E402
from auditlens.operators import assess as R  # noqa: E402
from auditlens.operators import correlation as X  # noqa: E402
from auditlens.operators import posture as C  # noqa: E402
from auditlens.operators import sketches as K  # noqa: E402
from auditlens.operators import summaries as A  # noqa: E402
from auditlens.plans.incremental import DailyStates  # noqa: E402
from auditlens.plans.pipeline import SecurityPipeline  # noqa: E402
from auditlens.session import configure  # noqa: E402
from auditlens.sources.audit import resolve_as_of  # noqa: E402
from auditlens.operators import detections as D  # noqa: E402
from auditlens.operators.memory import AssessmentMemory  # noqa: E402
from tools.audit_fixture import (  # noqa: E402
    ARRIVAL,
    ARRIVALS,
    audit_fixture,
    audit_from_events,
    audit_table,
    events,
    tag_history_fixture,
    tags_fixture,
)
from auditlens.sources.sinks import snapshot_root  # noqa: E402
from auditlens.sources.sql_surface import register_sql  # noqa: E402
from auditlens.streaming.detections import (  # noqa: E402
    read_audit_stream,
    start_append,
    start_uc_escalations,
    stream_candidates,
    stream_detections,
)
from auditlens.streaming.thresholds import login_threshold  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
_AS_OF: dict[tuple, object] = {}
_REFRESHED: dict[tuple, SecurityPipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str, refresh: bool = True) -> SecurityPipeline:
    """The audit table of ``sf_dir`` with every layer attached.

    With ``refresh`` the job's snapshots (one shared detection pass, then
    R-FL, R-DE, C1, C3) are written once per session and directory, as the
    source job refreshes its materialised views before the reports read them.
    Without it (the unbounded detection views) nothing is written.
    """
    configure(spark)
    key = (id(spark), str(Path(sf_dir).resolve()))
    if refresh and key in _REFRESHED:
        return _REFRESHED[key]
    audit = audit_table(spark, sf_dir)
    if key not in _AS_OF:
        _AS_OF[key] = resolve_as_of(audit)
    p = SecurityPipeline(audit, tags_fixture(spark, sf_dir), as_of=_AS_OF[key])
    if refresh:
        _REFRESHED[key] = p.refresh()
    return p


def _text_sets(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: joined_set(F.col(c)) for c in cols})


def _round(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.round(F.col(col), 6))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: who granted account admin in the last 7 days, how often, how risky."""
    return pipeline(spark, SMOKE_DIR).r_aa


def _q(fn: Callable[[SecurityPipeline], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A windowed layer: reads the refreshed snapshots."""
    return lambda spark, sf_dir: fn(pipeline(spark, sf_dir))


def _view(fn: Callable[[SecurityPipeline], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """An unbounded detection view: a scan of the audit table, no refresh needed."""
    return lambda spark, sf_dir: fn(pipeline(spark, sf_dir, refresh=False))


def _st2(p: SecurityPipeline) -> DataFrame:
    return login_threshold(p.d1, ("source_ip", "user"))


def _added() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators and their pipeline, where those modules are there."""
    found: tuple[dict, dict] = ({}, {})
    try:
        from auditlens.llm import queries as operators
        found[0].update(operators.QUERIES)
        found[1].update(operators.ORACLE_SQL)
    except ImportError as e:
        if not (e.name or "").startswith("auditlens.llm"):
            raise
    try:
        import corpus_pipeline
        found[0]["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            found[1]["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ImportError as e:
        if not (e.name or "").startswith(("corpus_pipeline", "auditlens.llm")):
            raise
    return found


#: A catalogue of the user's own: two windows on one metric, a metric over D7, one over A3.
CUSTOM_RULES = {
    "global": {},
    "time_intervals": {"day": 24, "week": 168, "month": 720, "default": 168},
    "alerts": {
        "logins_day": {"metric": "auth_events_count", "time_interval": "day",
                       "comparison_operator": "GREATER_THAN", "threshold_value": 1000000},
        "logins_month": {"metric": "auth_events_count", "time_interval": "month",
                         "comparison_operator": "GREATER_THAN", "threshold_value": 0},
        "settings": {"metric": {"source": "d7", "aggregate": "count_distinct", "column": "key_name",
                                "filter": [{"column": "action_name", "operator": "EQUAL", "value": "setSetting"}]},
                     "time_interval": "week", "comparison_operator": "NOT_EQUAL", "threshold_value": 0},
        "busiest_ip": {"metric": {"source": "a3", "aggregate": "max", "column": "failed_attempts",
                                  "filter": [{"column": "entity_type", "operator": "IN", "value": ["source_ip"]}]},
                       "time_interval": "week", "comparison_operator": "LESS_THAN_OR_EQUAL", "threshold_value": 5},
    },
}


def _custom_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 over the whole log with a catalogue of the user's own."""
    p = pipeline(spark, sf_dir, refresh=False)
    return SecurityPipeline(p.audit, p.tags, as_of=p.as_of, rules=CUSTOM_RULES, shared_scan=False).l6()


#: Rules whose state changes within days, at any scale: short windows, a distinct count, a value that may be missing.
CHANGING_RULES = {
    "global": {"notify_on_ok": True, "retrigger_seconds": 0},
    "time_intervals": {"hour": 1, "six": 6, "week": 168, "ten_days": 240, "default": 168},
    "alerts": {
        "settings_hour": {"metric": {"source": "d7"}, "time_interval": "hour", "comparison_operator": "GREATER_THAN",
                          "threshold_value": 0, "retrigger_seconds": 50000},
        "key_hour": {"metric": {"source": "d7", "filter": [{"column": "key_name", "operator": "EQUAL", "value": "key1"}]},
                     "time_interval": "hour", "comparison_operator": "GREATER_THAN", "threshold_value": 0, "retrigger_seconds": 1},
        "admin_targets": {"metric": {"source": "d2", "aggregate": "count_distinct", "column": "target_user"}, "time_interval": "six",
                          "comparison_operator": "GREATER_THAN", "threshold_value": 3, "notify_on_ok": False, "retrigger_seconds": 40000},
        "worst_code": {"metric": {"source": "d1", "aggregate": "max", "column": "response_code"}, "time_interval": "hour",
                       "comparison_operator": "GREATER_THAN", "threshold_value": 401, "retrigger_seconds": 100000},
        "exports": {"metric": {"source": "d8"}, "time_interval": "six", "comparison_operator": "LESS_THAN", "threshold_value": 10},
        "busiest_admin": {"metric": {"source": "a4", "aggregate": "max", "column": "admin_assignments_count"}, "time_interval": "ten_days",
                          "comparison_operator": "GREATER_THAN", "threshold_value": 2, "retrigger_seconds": 90000},
    },
}


def _alert_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 over time: states, changes and due notifications of ten moments, five hours apart, from the kept detections."""
    p = _incremental(spark, sf_dir)
    job = SecurityPipeline(p.audit, p.tags, as_of=p.as_of, rules=CHANGING_RULES, detections=p.detections)
    return job.alert_states([p.as_of - timedelta(hours=5 * k) for k in range(10)])


def _states_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 through the library's SQL functions, as a SQL user would write it."""
    register_sql(spark)
    p = pipeline(spark, sf_dir)
    return spark.sql("""
        SELECT name, value, alert_state(value, comparison_operator => comparison_operator, threshold_value => threshold_value) AS state
        FROM {values} JOIN {definitions} USING (name)""", values=p.metrics(), definitions=p.definitions)


_STREAMED: dict[tuple, str] = {}


def _audit_files(audit: DataFrame) -> str:
    """The folder of the audit table."""
    return os.path.commonpath([f.rpartition("/event_date=")[0] for f in audit.inputFiles()]).replace("file:/", "/")


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: the detections table that the streaming job keeps, after it has read the whole audit table."""
    key = (id(spark), str(Path(sf_dir).resolve()))
    if key not in _STREAMED:
        audit = audit_table(spark, sf_dir)
        base = f"{snapshot_root(spark)}/stream-{uuid.uuid4().hex}"
        stream = read_audit_stream(spark, _audit_files(audit), audit.schema)
        start_append(stream_candidates(stream), f"{base}/checkpoint", path=f"{base}/detections",
                     trigger={"availableNow": True}, partition_by=["rule"]).awaitTermination()
        _STREAMED[key] = f"{base}/detections"
    return spark.read.parquet(_STREAMED[key])


def _appended(layer: str) -> Callable[[SparkSession, str], DataFrame]:
    """ST1: one streaming detection view appended to a table, read back after the whole log went through."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        audit = audit_table(spark, sf_dir)
        base = f"{snapshot_root(spark)}/stream-{layer}-{uuid.uuid4().hex}"
        frame = stream_detections(read_audit_stream(spark, _audit_files(audit), audit.schema), tags_fixture(spark, sf_dir))[layer]
        start_append(frame, f"{base}/checkpoint", path=f"{base}/rows", trigger={"availableNow": True}).awaitTermination()
        return spark.read.schema(frame.schema).parquet(f"{base}/rows")
    return run


def _arrivals(spark: SparkSession, sf_dir: str, folder: str):
    """Writes the audit log as it arrives (late rows with a later arrival), each arrival by all cores; a step for each."""
    arrival = F.expr(ARRIVAL.format(day="extract(DAY FROM ts)"))
    for i in range(ARRIVALS):
        arrived = events(spark, sf_dir).where(arrival == i).repartition(spark.sparkContext.defaultParallelism)
        audit_from_events(arrived).write.mode("append").parquet(folder)
        yield i


def _login_windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2 as a stream: an arrival for each micro-batch, a watermark of a day, late rows within and beyond it.

    The stream goes on with every arrival and takes its files, however many, as one micro-batch; only after the
    last one it goes on without new files, to show the windows that the last watermark closes.
    """
    base = f"{snapshot_root(spark)}/st2-{uuid.uuid4().hex}"
    for i in _arrivals(spark, sf_dir, f"{base}/arrival"):
        stream = read_audit_stream(spark, f"{base}/arrival", audit_fixture(spark, sf_dir).schema)
        windows = login_threshold(D.auth_events(stream), ("source_ip", "user"), "72 hours", 3, "24 hours")
        trigger = {"availableNow": True} if i == ARRIVALS - 1 else {"once": True}
        start_append(windows, f"{base}/checkpoint", path=f"{base}/windows", trigger=trigger).awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{base}/windows")


def _uc_stream_with_new_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on a stream: half of the tables are tagged only after the third file was read."""
    base = f"{snapshot_root(spark)}/uc-{uuid.uuid4().hex}"
    tags, odd = tags_fixture(spark, sf_dir), F.expr("CAST(substring(table_name, 2) AS INT) % 2 = 1")
    for i in _arrivals(spark, sf_dir, f"{base}/arrival"):
        if i in (0, 3):
            tags.where(odd if i else ~odd).write.mode("append").parquet(f"{base}/tags")
        if i in (2, ARRIVALS - 1):
            stream = read_audit_stream(spark, f"{base}/arrival", audit_fixture(spark, sf_dir).schema)
            start_uc_escalations(stream, lambda s: s.read.parquet(f"{base}/tags"), f"{base}/checkpoint", f"{base}/rows").awaitTermination()
    return spark.read.parquet(f"{base}/rows").drop("batch")


def _damaged_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log with ``changes`` cut off, replaced by a text or by a list of texts in three of five events."""
    params = F.expr("""transform_values(request_params, (k, v) -> CASE WHEN k <> 'changes' THEN v WHEN event_id % 5 = 0 THEN
        substring(v, 1, length(v) - 2) WHEN event_id % 5 = 1 THEN '"OWNERSHIP"' WHEN event_id % 5 = 2 THEN '["MANAGE"]' ELSE v END)""")
    return audit_table(spark, sf_dir).withColumn("request_params", params)


def _remembered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 with a memory: the assessments of a week in a memory that holds those of the week up to a day before."""
    p = pipeline(spark, sf_dir, refresh=False)
    memory = AssessmentMemory(spark, f"{snapshot_root(spark)}/memory-{uuid.uuid4().hex}")
    before = SecurityPipeline(p.audit, p.tags, as_of=p.as_of, memory=memory).at(p.as_of - timedelta(days=1))
    before.r_de.count()
    return SecurityPipeline(p.audit, p.tags, as_of=p.as_of, memory=memory).r_de


def _stream_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).where("rule IN ('D1', 'D2', 'D3', 'D4', 'D7')").groupBy("rule").agg(
        F.count("*").alias("n"), F.min("event_time").alias("first_event"), F.max("event_time").alias("last_event"))


def _alerts_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 of the periodic job over the stream-kept table: no audit scan."""
    p = pipeline(spark, sf_dir, refresh=False)
    return SecurityPipeline(p.audit, p.tags, as_of=p.as_of, detections=_streamed(spark, sf_dir)).l6()


_STATES: dict[tuple, SecurityPipeline] = {}


def _incremental(spark: SparkSession, sf_dir: str) -> SecurityPipeline:
    """The job over daily states, after a store took in the audit log as it arrived.

    The log comes in two cuts: most of it, then the newest 36 hours together
    with a seventh of the older rows, which are late and reopen their days.
    """
    key = (id(spark), str(Path(sf_dir).resolve()))
    if key not in _STATES:
        p = pipeline(spark, sf_dir, refresh=False)
        base = f"{snapshot_root(spark)}/states-{uuid.uuid4().hex}"
        early = F.expr(f"event_time < TIMESTAMP_NTZ '{p.as_of}' - INTERVAL 36 HOUR AND event_id % 7 <> 3")
        store = DailyStates(spark, f"{base}/store")
        for rows in (p.audit.where(early), p.audit.where(~early)):
            rows.write.mode("append").parquet(f"{base}/arrival")
            stream = read_audit_stream(spark, f"{base}/arrival", p.audit.schema)
            store.advance(stream, f"{base}/checkpoint").awaitTermination()
        store.compact()
        _STATES[key] = SecurityPipeline(p.audit, p.tags, states=store)
    return _STATES[key]


def _from_states(fn: Callable[[SecurityPipeline], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A layer that builds on the daily states of two refreshes."""
    return lambda spark, sf_dir: fn(_incremental(spark, sf_dir))


def _prompts(fn, family, key=("actor",)):
    return _q(lambda p: R.with_prompt(fn(p), family).select(*key, "prompt"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    sets = ("related_entities", "user_agents")
    return {
        "d1_auth_events": _view(lambda p: p.d1),
        "d2_account_admin_assignments": _view(lambda p: p.d2),
        "d3_workspace_acl_assignments": _view(lambda p: p.d3),
        "d4_sensitive_group_additions": _view(lambda p: p.d4),
        "d5_workspace_db_sql_acl_changes": _view(lambda p: p.d5),
        "d6_uc_permission_escalations": _view(lambda p: p.d6),
        "d7_account_setting_changes": _view(lambda p: p.d7),
        "d8_data_export_detection": _view(lambda p: p.d8),
        "d8a_sql_downloads": _view(lambda p: p.d8_branch("sql")),
        "d8b_file_reads": _view(lambda p: p.d8_branch("files")),
        "d8c_notebook_downloads": _view(lambda p: p.d8_branch("notebook")),
        "d8d_dashboard_snapshots": _view(lambda p: p.d8_branch("dashboards")),
        "a1_failed_logins_by_ip": _q(lambda p: _text_sets(p.a1, *sets)),
        "a2_failed_logins_by_user": _q(lambda p: _text_sets(p.a2, *sets)),
        "a3_failed_login_patterns": _q(lambda p: _text_sets(p.a3, *sets)),
        "a4_account_admin_activity": _q(lambda p: p.a4),
        "a5_workspace_acl_activity": _q(lambda p: p.a5),
        "a6_sensitive_group_activity": _q(lambda p: p.a6),
        "a7_uc_permission_activity": _q(lambda p: p.a7),
        "a8_account_setting_activity": _q(lambda p: p.a8),
        "a9_export_activity": _q(lambda p: p.a9),
        "a10_actor_unique_targets": _q(lambda p: A.actor_unique_targets(p.w("d2"), p.as_of)),
        "a11_failed_login_relations": _q(lambda p: A.failed_login_relations(p.w("d1"), p.as_of)),
        "a12_failed_login_sketches": _view(lambda p: K.measured_sketches(K.login_sketches(p.d1), p.d1).select(
            *K.ENTITY, "failed_attempts", "first_attempt", "last_attempt", "unique_entities", "within_error")),
        "r_fl_failed_login_analysis": _q(lambda p: _text_sets(p.r_fl_full, *sets)),
        "r1_failed_login_prompts": _prompts(lambda p: p.a3_counts, R.FAILED_LOGIN, ("detection_type", "entity_id")),
        "r1_data_export_prompts": _prompts(lambda p: p.a9, R.DATA_EXPORT),
        "r1_account_admin_prompts": _prompts(lambda p: p.a4, R.ACCOUNT_ADMIN),
        "r1_workspace_acl_prompts": _prompts(lambda p: p.a5, R.WORKSPACE_ACL),
        "r1_sensitive_group_prompts": _prompts(lambda p: p.a6, R.SENSITIVE_GROUP),
        "r1_uc_permission_prompts": _prompts(lambda p: p.a7, R.UC_PERMISSION),
        "r1_account_setting_prompts": _prompts(lambda p: p.a8, R.ACCOUNT_SETTING),
        "r1_posture_prompt": _q(lambda p: C.posture_prompt(p.c2)),
        "r_de_data_export_analysis": _q(lambda p: p.r_de),
        "r_aa_account_admin_analysis": _q(lambda p: p.r_aa),
        "r_wa_workspace_acl_analysis": _q(lambda p: p.r_wa),
        "r_sg_sensitive_group_analysis": _q(lambda p: p.r_sg),
        "r_uc_uc_permission_analysis": _q(lambda p: p.r_uc),
        "r_as_account_setting_analysis": _q(lambda p: p.r_as),
        "c1_privilege_escalation_consolidated": _q(lambda p: p.c1),
        "c2_posture_event_counts": _q(lambda p: p.c2),
        "c3_security_posture_summary": _q(lambda p: p.c3),
        "q1_failed_login_actions": _q(lambda p: p.q1()),
        "q2_high_risk_exports": _q(lambda p: p.q2()),
        "q3_critical_escalations": _q(lambda p: p.q3()),
        "q4_actor_frequency": _q(lambda p: _round(p.q4(), "avg_actor_activity")),
        "q5_posture_fields": _q(lambda p: p.q5()),
        "q6_export_risk_factors": _q(lambda p: p.q6()),
        "q7_investigation_steps": _q(lambda p: p.q7()),
        "q8_strategic_recommendations": _q(lambda p: p.q8()),
        "q9_risk_level_counts": _q(lambda p: p.q9()),
        "q10_high_frequency_actors": _q(lambda p: p.q10()),
        "q11_compliance_report": _q(lambda p: p.q11()),
        "q12_cross_correlation": _q(lambda p: p.q12()),
        "q12_actions_after_failed_logins": _q(lambda p: p.actions_after_failed_logins(6)),
        "q12_actors_after_failed_logins": _q(lambda p: X.actors_after_failed_logins(p.actions_after_failed_logins(48, 2))),
        "q13_analysis_volume": _q(lambda p: _round(p.q13(), "avg_response_length")),
        "q14_account_admin_drilldown": _q(lambda p: p.q14()),
        "q15_workspace_acl_drilldown": _q(lambda p: p.q15()),
        "q16_sensitive_group_drilldown": _q(lambda p: p.q16()),
        "q17_uc_permission_drilldown": _q(lambda p: p.q17()),
        "q18_account_setting_drilldown": _q(lambda p: p.q18()),
        "l1_failed_login_alert": _q(lambda p: p.l1()),
        "l2_account_admin_alert": _q(lambda p: p.l2()),
        "l3_data_export_alert": _q(lambda p: p.l3()),
        "l4_uc_permission_alert": _q(lambda p: p.l4()),
        "l5_data_export_ai_alert": _q(lambda p: p.l5()),
        "l6_alert_evaluation": _q(lambda p: p.l6()),
        "l6_custom_rules": _custom_rules,
        "l6_alert_states": _alert_states,
        "l6_states_by_sql_function": _states_by_sql,
        "st1_stream_detections": _stream_detections,
        "st1_alerts_from_stream": _alerts_from_stream,
        "st2_login_threshold_batch": _q(_st2),
        "d6_tags_over_time": lambda spark, sf_dir: D.uc_permission_escalations(
            audit_table(spark, sf_dir), tag_history_fixture(spark, sf_dir)),
        "d6_refused_changes": lambda spark, sf_dir: D.uc_refused_changes(_damaged_changes(spark, sf_dir), tags_fixture(spark, sf_dir)),
        "d6_kept_changes": lambda spark, sf_dir: D.uc_permission_escalations(_damaged_changes(spark, sf_dir), tags_fixture(spark, sf_dir)),
        "st1_stream_d5": _appended("d5"),
        "st1_stream_d6": _appended("d6"),
        "st1_stream_d8": _appended("d8"),
        "st1_stream_d6_new_tags": _uc_stream_with_new_tags,
        "st2_login_threshold_stream": _login_windows_stream,
        "r3_remembered_assessments": _remembered,
        "s6_incremental_login_patterns": _from_states(lambda p: _text_sets(p.a3, *sets)),
        "s6_incremental_group_activity": _from_states(lambda p: p.a6),
        "s6_incremental_permission_activity": _from_states(lambda p: p.a7),
        "s6_incremental_export_activity": _from_states(lambda p: p.a9),
        "s6_incremental_consolidated": _from_states(lambda p: p.c1),
        "s6_incremental_event_counts": _from_states(lambda p: p.c2),
        "s6_incremental_alerts": _from_states(lambda p: p.l6()),
        **_added()[0],
    }


def oracle_sql() -> dict[str, str]:
    from oracle.duckdb_sql import oracle_sql as _oracle
    return _oracle() | _added()[1]
