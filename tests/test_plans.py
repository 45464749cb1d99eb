"""Plan shape: pushdown, one scan where promised, broadcast only behind a bound."""

from auditlens.operators import detections as D
from auditlens.plans.pipeline import SecurityPipeline
from tools.audit_fixture import audit_table, tags_fixture
from audit_rows import SF_SMALL


def _scans(text):
    import re
    return len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M))


def _explain(df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_detection_predicates_reach_the_scan(spark):
    audit = audit_table(spark, SF_SMALL)
    text = _explain(D.account_admin_assignments(audit))
    assert "PushedFilters: [IsNotNull(service_name), EqualTo(service_name,accounts)" in text
    assert "In(action_name, [setAccountAdmin,setAdmin])" in text
    read = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "event_date" not in read and "source_ip_address" not in read      # column pruning


def test_lookback_reaches_the_scan(spark):
    p = SecurityPipeline(audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL))
    text = _explain(p.a4)
    assert "GreaterThanOrEqual(event_time," in text


def test_d8_is_one_scan(spark):
    p = SecurityPipeline(audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL))
    assert _scans(_explain(p.d8)) == 1


def test_building_a_frame_runs_no_job(spark):
    audit, tags = audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL)
    as_of = SecurityPipeline(audit, tags).as_of
    tracker, group = spark.sparkContext.statusTracker(), "lazy-frames"
    spark.sparkContext.setJobGroup(group, "frames are only built")
    p = SecurityPipeline(audit, tags, as_of=as_of)
    for name in ("d6", "d8", "a3", "r_uc", "c1", "c3"):
        getattr(p, name)
    p.l6()
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rules_on_one_layer_share_a_scan(spark):
    from auditlens.operators import alerts as L
    p = SecurityPipeline(audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL))
    rules = [("a", 24, L.METRICS["auth_events_count"]), ("b", 168, L.METRICS["auth_events_count"])]
    text = _explain(L.rule_values(lambda layer, hours: p.d1, rules, p.as_of))
    assert _scans(text) == 1 and "GreaterThanOrEqual" not in text.split("PushedFilters")[0]


def test_summaries_use_partial_aggregation(spark):
    p = SecurityPipeline(audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL))
    assert "partial_collect_set" in _explain(p.a3)
    lean = _explain(p.a3_counts)
    assert "partial_count" in lean and "collect_set" not in lean
