"""Summaries, scoring and consolidation: unit rows and properties."""

import json

import pandas as pd
from pyspark.sql import functions as F

from auditlens.functions import scoring as S
from auditlens.operators import assess as R
from auditlens.operators import detections as D
from auditlens.operators import posture as C
from auditlens.operators import summaries as A
from auditlens.sources.audit import resolve_as_of
from tools.audit_fixture import audit_fixture, tags_fixture
from audit_rows import AS_OF, SF_SMALL, audit_row, bag


def _logins(make_audit):
    rows = []
    # a hot IP: many failures from several users, plus a NULL-user failure
    for i in range(40):
        rows.append(audit_row(t_hours_ago=1 + i, status=401, email=f"u{i % 3}@x", ip="9.9.9.9",
                              agent=f"agent/{i % 2}"))
    rows.append(audit_row(t_hours_ago=2, status=401, ip="9.9.9.9"))
    rows.append(audit_row(t_hours_ago=3, status=401, email="solo@x", ip=None))
    rows.append(audit_row(t_hours_ago=500, status=401, email="old@x", ip="8.8.8.8"))   # outside window
    return make_audit(rows)


def test_login_patterns_match_naive_grouping(make_audit):
    d1 = D.auth_events(_logins(make_audit))
    a3 = A.failed_login_patterns(d1, AS_OF)
    ip = a3.filter(F.col("entity_id") == "9.9.9.9").first()
    assert ip.failed_attempts == 41 and ip.unique_entities == 3
    assert ip.related_entities == ["u0@x", "u1@x", "u2@x"] and ip.user_agents == ["agent/0", "agent/1"]
    assert ip.detection_type == "IP_BASED" and ip.entity_type == "source_ip"
    # A3 = A1 UNION ALL A2
    assert bag(a3) == bag(A.failed_logins_by_ip(d1, AS_OF).unionByName(A.failed_logins_by_user(d1, AS_OF)))
    users = {r.entity_id: r.failed_attempts for r in a3.filter(F.col("detection_type") == "USER_BASED").collect()}
    assert users == {"u0@x": 14, "u1@x": 13, "u2@x": 13, "solo@x": 1}
    solo = a3.filter(F.col("entity_id") == "solo@x").first()
    assert solo.unique_entities == 0 and solo.related_entities == []


def test_property_attempts_equal_d1_rows(spark):
    audit = audit_fixture(spark, SF_SMALL)
    as_of = resolve_as_of(audit)
    d1 = D.auth_events(audit)
    a3 = A.failed_login_patterns(d1, as_of)
    window = d1.filter(F.col("event_time") >= F.lit(str(as_of - __import__("datetime").timedelta(hours=168)))
                       .cast("timestamp_ntz"))
    for det, key in (("IP_BASED", "source_ip"), ("USER_BASED", "username")):
        total = a3.filter(F.col("detection_type") == det).agg(F.sum("failed_attempts")).first()[0]
        assert total == window.filter(F.col(key).isNotNull()).count()


def test_unique_flags_and_group_counts(make_audit):
    audit = make_audit([
        audit_row(action="setAdmin", email="a@x", params={"targetUserName": "t1"}),
        audit_row(action="setAdmin", email="a@x", params={"targetUserName": "t1"}, t_hours_ago=30),
        audit_row(action="setAdmin", email="a@x", params={}),
    ])
    a4 = A.account_admin_activity(D.account_admin_assignments(audit), AS_OF)
    got = sorted((r.target_user or "", r.admin_assignments_count, r.unique_targets) for r in a4.collect())
    assert got == [("", 1, 0), ("t1", 2, 1)]


def test_scoring_levels_and_null_prompt(make_audit):
    rows = [audit_row(action="setAdmin", email="a@x", params={"targetUserName": "t1"}, t_hours_ago=i + 1)
            for i in range(6)]
    rows += [audit_row(action="setAdmin", email=None, params={"targetUserName": "t2"})]   # NULL actor
    a4 = A.account_admin_activity(D.account_admin_assignments(make_audit(rows)), AS_OF)
    r = R.assess_account_admin(a4)
    by_target = {x.target_user: x[S.ANALYSIS_COLUMN] for x in r.collect()}
    assert by_target["t2"] is None                    # NULL prompt -> NULL analysis
    doc = pd.read_json(__import__("io").StringIO("[" + by_target["t1"] + "]"))
    assert doc.risk_level[0] == "CRITICAL"
    assert list(doc.risk_factors[0]) == ["high_volume", "sensitive_target"]
    assert list(doc.immediate_actions[0]) == S.IMMEDIATE_ACTIONS["CRITICAL"]


def test_pandas_scorer_is_called_per_batch_and_keeps_nulls(make_audit):
    rows = [audit_row(action="setAdmin", email="a@x", params={"targetUserName": "t1"}),
            audit_row(action="setAdmin", email=None, params={"targetUserName": "t2"})]
    a4 = A.account_admin_activity(D.account_admin_assignments(make_audit(rows)), AS_OF)

    def fake_model(prompts: pd.Series, family: str) -> pd.Series:
        return prompts.map(lambda p: '{"risk_level":"HIGH","family":"%s","n":%d}' % (family, len(p)))

    raw = R.assess_account_admin(a4, S.pandas_scorer(fake_model, conform=False))
    out = {x.target_user: x[S.ANALYSIS_COLUMN] for x in raw.collect()}
    assert out["t2"] is None and '"family":"account_admin_analysis"' in out["t1"]
    conformed = R.assess_account_admin(a4, S.pandas_scorer(fake_model))
    out = {x.target_user: x[S.ANALYSIS_COLUMN] for x in conformed.collect()}
    assert out["t2"] is None and out["t1"] == '{"risk_level":"HIGH"}'      # unknown fields dropped
    parsed = conformed.select(S.parse_assessment(F.col(S.ANALYSIS_COLUMN), R.ACCOUNT_ADMIN).alias("a"))
    assert parsed.filter("a.risk_level = 'HIGH'").count() == 1
    assert "investigation_steps ARRAY<STRING>" in S.family_schema(R.ACCOUNT_ADMIN)


def test_consolidation_row_count_and_posture(spark):
    audit = audit_fixture(spark, SF_SMALL)
    tags = tags_fixture(spark, SF_SMALL)
    as_of = resolve_as_of(audit)
    r = [R.assess_account_admin(A.account_admin_activity(D.account_admin_assignments(audit), as_of)),
         R.assess_workspace_acl(A.workspace_acl_activity(D.workspace_acl_assignments(audit), as_of)),
         R.assess_sensitive_group(A.sensitive_group_activity(D.sensitive_group_additions(audit), as_of)),
         R.assess_uc_permission(A.uc_permission_activity(D.uc_permission_escalations(audit, tags), as_of)),
         R.assess_account_setting(A.account_setting_activity(D.account_setting_changes(audit), as_of))]
    c1 = C.privilege_escalation_consolidated(*r)
    assert c1.count() == sum(x.count() for x in r)
    c2 = C.posture_event_counts(D.auth_events(audit), D.data_export_detection(audit, as_of), c1, as_of)
    assert c2.count() == 3
    c3 = C.posture_summary(c2, as_of)
    row = c3.first()
    assert row.analysis_type == "Security Posture Analysis"
    assert '"overall_risk_level"' in row[S.POSTURE_COLUMN]


def test_posture_counts_absent_read_as_zero(spark):
    c2 = spark.createDataFrame([], "event_type string, event_count bigint, last_event timestamp_ntz")
    doc = C.posture_summary(c2, AS_OF).first()[S.POSTURE_COLUMN]
    assert doc.startswith('{"overall_risk_level":"LOW","key_risk_areas":[]')


def test_posture_with_pluggable_scorer(spark):
    c2 = spark.createDataFrame([("FAILED_LOGINS", 3, None), ("DATA_EXPORTS", 0, None),
                                ("PRIVILEGE_ESCALATIONS", 7, None)],
                               "event_type string, event_count bigint, last_event timestamp_ntz")

    def fake(prompts: pd.Series, family: str) -> pd.Series:
        return prompts.map(lambda p: '{"overall_risk_level":"%s","seen":%d}' % (family, len(p)))

    row = C.posture_summary(c2, AS_OF, S.pandas_scorer(fake)).first()
    assert row[S.POSTURE_COLUMN] == '{"overall_risk_level":"security_posture_summary"}'
    row = C.posture_summary(c2, AS_OF, S.pandas_scorer(fake, conform=False)).first()
    assert '"seen":' in row[S.POSTURE_COLUMN]
    default = C.posture_summary(c2, AS_OF).first()[S.POSTURE_COLUMN]
    assert default.startswith('{"overall_risk_level":"HIGH","key_risk_areas":["failed_logins","privilege_escalations"]')


def test_prompt_is_null_when_a_field_is_null(make_audit):
    rows = [audit_row(service="filesystem", action="filesGet", params={"path": "/f"}, email="a@x"),
            audit_row(service="filesystem", action="filesGet", params={}, email="a@x")]    # no artifact
    a9 = A.export_activity(D.data_export_detection(make_audit(rows), AS_OF))
    out = {r.artifact: r.prompt for r in R.with_prompt(a9, R.DATA_EXPORT).collect()}
    assert out[None] is None
    asked, _, data = out["/f"].partition(" Data: ")
    assert "risk_level is one of HIGH, MEDIUM, LOW; risk_factors, immediate_actions, long_term_recommendations" in asked
    assert json.loads(data)["actor"] == "a@x" and json.loads(data)["source"] == "filesystem"


def test_property_group_counts_sum_to_window_rows(spark):
    import datetime as dt
    from auditlens.operators import alerts as L
    audit = audit_fixture(spark, SF_SMALL)
    as_of = resolve_as_of(audit)
    bound = F.lit((as_of - dt.timedelta(hours=168)).isoformat(sep=" ")).cast("timestamp_ntz")
    d2 = D.account_admin_assignments(audit)
    a4 = A.account_admin_activity(d2, as_of)
    assert a4.agg(F.sum("admin_assignments_count")).first()[0] == d2.filter(F.col("event_time") >= bound).count()
    d8 = D.data_export_detection(audit, as_of)
    assert L.data_export_alert(d8, as_of).first().value == d8.count()
    assert A.export_activity(d8).agg(F.sum("export_count")).first()[0] == d8.count()


def test_lookback_keeps_rows_without_a_date(make_audit):
    from auditlens.functions.exprs import since
    d1 = D.auth_events(make_audit([audit_row(status=401, email="a@x", ip="1.1.1.1")]))
    assert since(d1.withColumn("event_date", F.lit(None).cast("date")), AS_OF, 24).count() == 1


def test_lagging_dates_lose_no_row_and_a_declared_contract_prunes(spark):
    from auditlens.functions.exprs import DatePartition, since
    from auditlens.operators import alerts as L
    audit = audit_fixture(spark, "/root/testdata/sf0.01")
    as_of = resolve_as_of(audit)
    late = audit.withColumn("event_date", F.date_sub(F.col("event_time").cast("date"), 3))
    assert resolve_as_of(late) == resolve_as_of(late.withColumn("event_date", F.lit(None).cast("date"))) == as_of
    want = L.failed_login_alert(D.auth_events(audit), as_of).first().value
    assert want > 0 and L.failed_login_alert(D.auth_events(late), as_of).first().value == want
    assert since(late, as_of, 24, contract=DatePartition("event_date", 3)).count() == since(late, as_of, 24).count()


def test_actor_unique_targets_with_a_null_actor(make_audit):
    rows = [audit_row(action="setAdmin", email=e, params={"targetUserName": t} if t else {})
            for e, t in (("a@x", "t1"), ("a@x", "t2"), ("a@x", "t2"), (None, "t1"), (None, None))]
    got = A.actor_unique_targets(D.account_admin_assignments(make_audit(rows)), AS_OF)
    assert {(r.actor, r.actor_unique_targets) for r in got.collect()} == {("a@x", 2), (None, 1)}
