"""Report semantics and alerts-as-data."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from auditlens.functions.scoring import ANALYSIS_COLUMN
from auditlens.operators import alerts as L
from auditlens.operators import reports as Q
from auditlens.functions.exprs import since
from auditlens.operators import detections as D
from auditlens.plans.pipeline import SecurityPipeline
from tools.audit_fixture import audit_fixture, tags_fixture
from audit_rows import AS_OF, SF_SMALL

C1_SCHEMA = ("escalation_type string, actor string, target_user string, actor_activity_count bigint, "
             "actor_unique_entities bigint, actor_first_activity timestamp_ntz, "
             "actor_last_activity timestamp_ntz, ai_comprehensive_analysis string")
RFL_SCHEMA = ("detection_type string, entity_id string, entity_name string, entity_type string, "
              "failed_attempts bigint, first_attempt timestamp_ntz, ai_comprehensive_analysis string")


def _c1(spark, rows):
    t = AS_OF - dt.timedelta(hours=1)
    return spark.createDataFrame(
        [(e, a, "x", n, 1, t, t, None if lvl is None else json.dumps({"risk_level": lvl})) for e, a, n, lvl in rows],
        C1_SCHEMA)


def _rfl(spark, rows):
    t = AS_OF - dt.timedelta(hours=1)
    return spark.createDataFrame(
        [("IP_BASED", ip, ip, "source_ip", n, t, '{"risk_level":"LOW"}') for ip, n in rows], RFL_SCHEMA)


@pytest.mark.parametrize("ips,actors,expected", [
    ([("1.1.1.1", 20), ("2.2.2.2", 11)], [("A", "u1", 1, "HIGH"), ("A", "u2", 1, "CRITICAL")], (2, 2)),
    ([("1.1.1.1", 20)], [], (0, 0)),                               # empty side: cross join is empty
    ([], [("A", "u1", 1, "HIGH")], (0, 0)),
    ([("1.1.1.1", 20)], [("A", None, 1, "HIGH")], (1, 0)),         # NULL-only actor side still makes rows
    ([("1.1.1.1", 5)], [("A", "u1", 1, "HIGH")], (0, 0)),          # below threshold
])
def test_q12_matches_cross_join_semantics(spark, ips, actors, expected):
    out = Q.q12_cross_correlation(_rfl(spark, ips), _c1(spark, actors), AS_OF).first()
    assert (out.suspicious_ips, out.high_risk_actors) == expected
    assert out.analysis_type == "CROSS_CORRELATION"


def test_q9_orders_unknown_levels_first(spark):
    c1 = _c1(spark, [("A", "u", 1, "LOW"), ("A", "v", 1, None), ("A", "w", 1, "CRITICAL"), ("A", "z", 1, "HIGH")])
    empty = spark.createDataFrame([], RFL_SCHEMA)
    rde = spark.createDataFrame([], "last_activity timestamp_ntz, ai_comprehensive_analysis string")
    rows = Q.q9_risk_level_counts(empty, rde, c1, AS_OF).collect()
    assert [r.risk_level for r in rows] == [None, "CRITICAL", "HIGH", "LOW"]


def test_q4_counts_groups_and_having(spark):
    c1 = _c1(spark, [("A", "u", 2, "HIGH"), ("A", "u", 4, "HIGH"), ("A", "v", 1, "LOW")])
    rows = Q.q4_actor_frequency(c1, AS_OF).collect()
    assert len(rows) == 1 and rows[0].total_events == 2 and rows[0].avg_actor_activity == 3.0


@pytest.mark.parametrize("op,value,threshold,state", [
    ("GREATER_THAN", 5, 5, "OK"), ("GREATER_THAN", 6, 5, "TRIGGERED"),
    ("GREATER_THAN_OR_EQUAL", 5, 5, "TRIGGERED"), ("LESS_THAN", 4, 5, "TRIGGERED"),
    ("LESS_THAN_OR_EQUAL", 6, 5, "OK"), ("EQUAL", 5, 5, "TRIGGERED"), ("NOT_EQUAL", 5, 5, "OK"),
    ("GREATER_THAN", None, 5, "UNKNOWN"),
])
def test_alert_operators_and_empty_state(spark, op, value, threshold, state):
    rules = {"global": {}, "time_intervals": {"short": 24},
             "alerts": [{"name": "r", "display_name": "r", "metric": "auth_events_count", "time_interval": "short",
                         "comparison_operator": op, "threshold_value": threshold}]}
    defs = L.alert_definitions(spark, rules)
    values = spark.createDataFrame([("r", value)], "name string, value bigint")
    assert L.evaluate_alerts(values, defs, AS_OF).first().state == state


def test_unknown_interval_falls_back_and_bad_operator_fails(spark):
    rules = {"global": {}, "time_intervals": {"default": 168},
             "alerts": [{"name": "r", "display_name": "r", "metric": "auth_events_count", "time_interval": "weird",
                         "comparison_operator": "GREATER_THAN", "threshold_value": 1}]}
    with pytest.warns(UserWarning):
        row = L.definition_rows(rules)[0]
    assert row[5] == 168 and row[6] is True
    rules["alerts"][0]["comparison_operator"] = "LIKE"
    with pytest.raises(ValueError):
        L.definition_rows(rules)


def test_alert_document_round_trip(spark):
    defs = L.alert_definitions(spark)
    docs = L.alert_document(defs)
    listing = docs.agg(F.concat(F.lit('{"results":['), F.concat_ws(",", F.collect_list(
        F.regexp_replace("alert_document", "^\\{", '{"owner_user_name":"me",'))), F.lit("]}")).alias("text"))
    inv = L.alert_inventory(listing, "me").orderBy("display_name").collect()
    assert len(inv) == 5
    first = {r.display_name: r for r in inv}
    assert first["account_admin_assignment"].threshold == 5.0
    assert first["account_admin_assignment"].op == "GREATER_THAN"
    assert first["account_admin_assignment"].cron == "0 0 10 1/7 * ?"
    assert L.alert_inventory(listing, "someone else").count() == 0
    one = json.loads(docs.filter(F.col("name") == "failed_login_alert").first().alert_document)
    assert one["evaluation"]["source"] == {"aggregation": "FIRST", "display": "value", "name": "value"}
    assert one["notification"]["subscriptions"] == [{}]          # NULL e-mail left out


def _catalogue(*alerts, **intervals):
    return {"global": {}, "time_intervals": {"day": 24, "week": 168, "month": 720, **intervals}, "alerts": list(alerts)}


def _alert(name, metric, interval="day", op="GREATER_THAN", threshold=0):
    return {"name": name, "metric": metric, "time_interval": interval, "comparison_operator": op, "threshold_value": threshold}


def test_two_rules_on_one_metric_keep_their_windows(spark):
    from auditlens.streaming.detections import stream_candidates
    audit, tags = audit_fixture(spark, SF_SMALL), tags_fixture(spark, SF_SMALL)
    rules = _catalogue(_alert("d", "auth_events_count"), _alert("w", "auth_events_count", "week"),
                       _alert("m", "auth_events_count", "month"), _alert("x", "data_export_count", "month"),
                       _alert("u", "uc_permission_escalations_count", "month"),
                       _alert("s", {"source": "d7", "aggregate": "count_distinct", "column": "key_name"}, "month"))
    table = stream_candidates(audit)
    for hours in (24, 168, 336):
        plain = SecurityPipeline(audit, tags, lookback_hours=hours, rules=rules, shared_scan=False)
        got = {r.name: r.value for r in plain.l6().collect()}
        d1 = D.auth_events(audit)
        for name, h in (("d", 24), ("w", 168), ("m", 720)):
            assert got[name] == since(d1, plain.as_of, h).count()
        assert got["x"] == D.data_export_detection(audit, plain.as_of).count() == plain.l3().first().value
        for other in (SecurityPipeline(audit, tags, as_of=plain.as_of, lookback_hours=hours, rules=rules),
                      SecurityPipeline(audit, tags, as_of=plain.as_of, lookback_hours=hours, rules=rules, detections=table)):
            assert {r.name: r.value for r in other.l6().collect()} == got
            assert other.l3().first().value == got["x"]


def test_catalogue_as_mapping_and_its_errors():
    listed = _catalogue(_alert("a", "auth_events_count"))
    keyed = {**listed, "alerts": {"a": {k: v for k, v in listed["alerts"][0].items() if k != "name"}}}
    assert L.definition_rows(listed) == L.definition_rows(keyed)
    for bad in ("no_such_metric", {"source": "d9"}, {"source": "d1", "aggregate": "median", "column": "user"},
                {"source": "d1", "aggregate": "sum"}, {"source": "d1", "sql": "x"},
                {"source": "d1", "filter": [{"column": "user", "operator": "LIKE", "value": "x"}]}):
        with pytest.raises(ValueError):
            L.definition_rows(_catalogue(_alert("a", bad)))
    with pytest.raises(ValueError):
        L.definition_rows(_catalogue(_alert("a", "auth_events_count"), _alert("a", "data_export_count")))


def test_the_same_instant_in_any_session_time_zone(spark, tmp_path):
    from auditlens.sources.audit import resolve_as_of
    path = str(tmp_path / "audit")  # instants on disk, as a real log has them
    audit_fixture(spark, SF_SMALL).withColumn("event_time", F.col("event_time").cast("timestamp")).write.parquet(path)
    tags, got = tags_fixture(spark, SF_SMALL), {}
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            audit = spark.read.parquet(path)
            p = SecurityPipeline(audit, tags, as_of=dt.datetime(2024, 1, 30, 20, tzinfo=dt.timezone.utc))
            got[zone] = [resolve_as_of(audit), p.as_of, *(f().first()[0] for f in (p.l1, p.l2, p.l3, p.l4)),
                         sorted((r.name, r.value) for r in p.l6().collect())]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["UTC"] == got["America/New_York"] and got["UTC"][2] > 0


def test_l5_sum_is_null_when_nothing_high(spark):
    rde = spark.createDataFrame([(3, '{"risk_level":"LOW"}')], "export_count bigint, ai_comprehensive_analysis string")
    assert L.data_export_ai_alert(rde).first().value is None


def test_l6_states_on_fixture(spark):
    p = SecurityPipeline(audit_fixture(spark, "/root/testdata/sf0.01"), tags_fixture(spark, "/root/testdata/sf0.01"))
    states = {r.name: (r.value, r.state) for r in p.l6().collect()}
    for name, layer, hours in (("failed_login_alert", p.d1, 24), ("account_admin_assignment", p.d2, 24)):
        assert states[name] == (since(layer, p.as_of, hours).count(), "TRIGGERED")
    assert set(states) == {"failed_login_alert", "account_admin_assignment", "data_export_alert",
                           "uc_permission_escalation", "data_export_ai_alert"}
