"""The job entry point and SQL over the registered views."""

import datetime as dt

from auditlens.plans.job import run_job
from auditlens.plans.pipeline import VIEW_NAMES, SecurityPipeline
from tools.audit_fixture import audit_table, tags_fixture
from audit_rows import SF_SMALL, bag


def test_run_job_writes_reports_and_alerts(spark, tmp_path):
    audit = audit_table(spark, SF_SMALL)
    tags_path = str(tmp_path / "tags")
    tags_fixture(spark, SF_SMALL).write.parquet(tags_path)
    out = run_job(spark, audit, tags_path, str(tmp_path / "out"))
    assert set(out) == {f"q{i}" for i in range(1, 19)} | {"l6"}
    states = spark.read.parquet(out["l6"])
    assert states.count() == 5
    ref = SecurityPipeline(audit, tags_fixture(spark, SF_SMALL))
    assert bag(spark.read.parquet(out["q9"])) == bag(ref.q9())


def test_report_sql_runs_on_registered_views(spark):
    p = SecurityPipeline(audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL))
    assert set(p.register_views()) == set(VIEW_NAMES)
    since = (p.as_of - dt.timedelta(hours=168)).isoformat(sep=" ")
    by_sql = spark.sql(f"""
        SELECT actor, escalation_type, get_json_object(ai_comprehensive_analysis, '$.risk_level') AS risk_level,
               count(*) AS n
        FROM sec_mv_ai_privilege_escalation_consolidated
        WHERE actor_last_activity >= TIMESTAMP_NTZ '{since}'
        GROUP BY ALL""")
    by_api = p.c1.filter(f"actor_last_activity >= TIMESTAMP_NTZ '{since}'").groupBy(
        "actor", "escalation_type", "ai_comprehensive_analysis").count()
    assert by_sql.agg({"n": "sum"}).first()[0] == by_api.agg({"count": "sum"}).first()[0]
    n = spark.sql("SELECT count(*) AS n FROM sec_v_auth_events").first().n
    assert n == p.d1.count()


def test_job_with_a_pluggable_scorer(spark, tmp_path):
    from auditlens.plans.job import load_scorer
    audit = audit_table(spark, SF_SMALL)
    out = run_job(spark, audit, tags_fixture(spark, SF_SMALL), str(tmp_path / "out"), scorer=load_scorer("fake_model:score", spark))
    q3 = spark.read.parquet(out["q3"])
    assert q3.count() > 0 and {r.risk_level for r in q3.collect()} == {"HIGH"}
    q5 = spark.read.parquet(out["q5"]).first()
    assert q5.overall_risk_level == "LOW"


def test_each_group_is_scored_once(spark):
    from auditlens.functions import scoring as S
    audit, tags = audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL)
    sent = spark.sparkContext.accumulator(0)

    def count(prompts, family):
        sent.add(len(prompts))
        return prompts.map(lambda p: '{"risk_level":"HIGH"}')

    p = SecurityPipeline(audit, tags, scorer=S.pandas_scorer(count)).refresh()
    for i in range(1, 19):
        getattr(p, f"q{i}")().collect()
    scored = sum(f.where("ai_comprehensive_analysis IS NOT NULL").count() for f in (
        p.r_fl, p.r_de, p.r_aa, p.r_wa, p.r_sg, p.r_uc, p.r_as))
    assert sent.value == scored + 1  # and the posture


def test_job_takes_a_catalogue(spark, tmp_path):
    rules = {"global": {}, "alerts": {"mine": {"metric": {"source": "d7"}, "comparison_operator": "GREATER_THAN", "threshold_value": 0}}}
    out = run_job(spark, audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL), str(tmp_path / "out"), rules=rules)
    assert [r.name for r in spark.read.parquet(out["l6"]).collect()] == ["mine"]


def test_catalogue_from_shared_storage(spark, tmp_path):
    """The catalogue is read through Spark's file systems, by URI too."""
    import json

    from auditlens.sources.rules import load_rules
    rules = load_rules() | {"note": "é"}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    assert load_rules(f"file://{tmp_path}/rules.json", spark) == rules == load_rules(tmp_path / "rules.json")
