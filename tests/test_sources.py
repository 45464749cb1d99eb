"""S1 as_of, S5 views, S6 snapshots, S7 previews, S4 rule catalogue."""

import datetime as dt

from auditlens.operators import detections as D
from auditlens.sources.audit import resolve_as_of
from tools.audit_fixture import audit_fixture, audit_table
from auditlens.sources.rules import load_rules
from auditlens.sources.sinks import preview, register_views, snapshot
from audit_rows import SF_SMALL, bag


def test_as_of_same_on_partitioned_table_and_projection(spark):
    part = resolve_as_of(audit_table(spark, SF_SMALL))
    flat = resolve_as_of(audit_fixture(spark, SF_SMALL))
    assert part == flat == dt.datetime(2024, 1, 30, 23, 26, 16, 220708)
    assert resolve_as_of(audit_table(spark, SF_SMALL), "2024-01-02T03:04:05") == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_views_and_snapshots(spark):
    audit = audit_table(spark, SF_SMALL)
    d2 = D.account_admin_assignments(audit)
    register_views(spark, {"sec_account_admin_assignments": d2})
    assert spark.sql("SELECT count(*) AS n FROM sec_account_admin_assignments").first().n == d2.count()
    snap = snapshot(d2, "d2")
    assert bag(snap) == bag(d2)
    from test_plans import _explain
    assert "auditlens-fixture" not in _explain(snap)


def test_snapshot_versions(spark, tmp_path):
    from auditlens.sources.sinks import latest_snapshot
    base = str(tmp_path / "snap")
    first = snapshot(spark.range(1), "s", base)
    snapshot(spark.range(2), "s", base)
    assert first.count() == 1                                     # a reader keeps its version
    snapshot(spark.range(3), "s", base)
    assert latest_snapshot(spark, base).count() == 3 and len(list((tmp_path / "snap").iterdir())) == 2


def test_table_names_and_paths(spark, tmp_path):
    from auditlens.sources.audit import audit
    path = str(tmp_path / "log")
    spark.range(2).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("audit_log")
    assert audit("audit_log", spark).count() == audit(path, spark).count() == 2


def test_preview_filters_and_limits(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(30)], "k int, a string")
    rows = preview(df, "a", "k").collect()
    assert len(rows) == 10 and all(r.a == "x" for r in rows)


def test_rule_catalogue():
    rules = load_rules()
    names = [a["name"] for a in rules["alerts"]]
    assert names == ["failed_login_alert", "account_admin_assignment", "data_export_alert",
                     "uc_permission_escalation", "data_export_ai_alert"]
    assert rules["time_intervals"] == {"short": 24, "medium": 168, "long": 720, "default": 168}
    assert [a["threshold_value"] for a in rules["alerts"]] == [0, 5, 10, 5, 10]


def test_detection_rule_metadata(spark):
    from auditlens.sources.rules import detection_rules
    rows = {r.detection: r for r in detection_rules(spark).collect()}
    assert sorted(rows) == ["D1", "D2", "D3", "D4", "D5", "D6", "D7", "D8"]
    assert rows["D6"].rule_id == "AUTH-002" and rows["D6"].tactic.startswith("TA0004")
    assert rows["D8"].technique.startswith("T1041") and rows["D1"].tactic is None
