"""Alert states over time: transitions, due notifications, the kept state table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from auditlens.operators import alert_states as LS
from auditlens.operators import alerts as L
from auditlens.plans.pipeline import SecurityPipeline
from audit_rows import AS_OF, audit_row

DEFINED = [("told_once", True, 0), ("again", True, 7200), ("quiet", False, 3600)]
EVALUATION = "name string, as_of timestamp_ntz, value double, state string"


def expected(rows):
    """Plain loop over the evaluations of each rule."""
    out = {}
    for name, ok, again in DEFINED:
        last = since = told = None
        for moment, state in sorted((t, s) for n, t, s in rows if n == name):
            changed = state != last
            due = state == "TRIGGERED" and (changed or (again > 0 and told is not None and (moment - told).total_seconds() >= again))
            due = due or (state == "OK" and last == "TRIGGERED" and ok)
            since = moment if changed else since
            told = moment if due else told
            out[name, moment] = (state, last, changed, since, due, told)
            last = state
    return out


def evaluations(seed, n=14):
    r = random.Random(seed)
    return [(name, AS_OF + dt.timedelta(minutes=47 * i), r.choice(["OK", "TRIGGERED", "TRIGGERED", "TRIGGERED", "UNKNOWN"]))
            for name, *_ in DEFINED for i in range(n) if r.random() < 0.9]


def found(df):
    return {(r["name"], r["as_of"]): (r["state"], r["previous_state"], r["changed"], r["since"], r["due"], r["last_notified"]) for r in df.collect()}


@pytest.fixture
def definitions(spark):
    return spark.createDataFrame(DEFINED, "name string, notify_on_ok boolean, retrigger_seconds int")


@pytest.mark.parametrize("seed", [1, 2])
def test_states_over_time_equal_a_plain_loop(spark, definitions, seed):
    rows = evaluations(seed)
    frame = spark.createDataFrame([(n, t, 1.0, s) for n, t, s in rows], EVALUATION)
    assert found(LS.next_states(spark.createDataFrame([], LS.STATE_SCHEMA), frame, definitions)) == expected(rows)


def test_kept_states_step_by_step(spark, definitions, tmp_path):
    """From run to run; a step that is run again, or comes late, changes nothing."""
    rows, want = evaluations(3, 5), expected(evaluations(3, 5))
    kept = LS.AlertStates(spark, str(tmp_path / "states"))
    got = {}
    for moment in sorted({t for _, t, _ in rows}):
        frame = spark.createDataFrame([(n, t, None, s) for n, t, s in rows if t == moment], EVALUATION)
        got |= found(kept.step(frame, definitions))
        assert kept.step(frame, definitions).count() == 0
    assert got == want
    assert kept.current().count() == len(DEFINED)
    assert kept.step(spark.createDataFrame([("again", AS_OF - dt.timedelta(days=1), 1.0, "OK")], EVALUATION), definitions).count() == 0


CATALOGUE = {
    "global": {}, "time_intervals": {"hour": 1, "day": 24, "long": 300},
    "alerts": {
        "n": {"metric": {"source": "d1"}, "time_interval": "day", "comparison_operator": "GREATER_THAN", "threshold_value": 2},
        "code": {"metric": {"source": "d1", "aggregate": "max", "column": "response_code"}, "time_interval": "hour",
                 "comparison_operator": "GREATER_THAN", "threshold_value": 401},
        "users": {"metric": {"source": "d1", "aggregate": "count_distinct", "column": "username",
                             "filter": [{"column": "source_ip", "operator": "EQUAL", "value": "1.1.1.1"}]},
                  "time_interval": "hour", "comparison_operator": "GREATER_THAN", "threshold_value": 0, "retrigger_seconds": 5, "notify_on_ok": False},
        "exports": {"metric": {"source": "d8"}, "time_interval": "long", "comparison_operator": "GREATER_THAN", "threshold_value": 3},
        "groups": {"metric": {"source": "a3", "aggregate": "max", "column": "failed_attempts"}, "time_interval": "long",
                   "comparison_operator": "GREATER_THAN", "threshold_value": 5},
    },
}


@pytest.fixture
def job(make_audit, empty_tags):
    r = random.Random(8)
    rows = [audit_row(t_hours_ago=r.uniform(0, 400), status=r.choice([401, 403]), email=r.choice(["a", "b"]), ip="1.1.1.1") for _ in range(60)]
    rows += [audit_row(t_hours_ago=r.uniform(0, 400), service="filesystem", action="filesGet", params={"path": "/x"}) for _ in range(40)]
    return SecurityPipeline(make_audit(rows), empty_tags, as_of=AS_OF, rules=CATALOGUE)


def test_evaluations_at_many_moments_equal_one_at_a_time(job):
    """Each moment sees its past alone; windows wider than the summaries' own are honoured."""
    times = [AS_OF - dt.timedelta(hours=h) for h in (0, 3, 50, 700)]
    got = {(r["name"], r["as_of"]): (r["value"], r["state"]) for r in job.evaluations(times).collect()}
    want = {}
    for moment in times:
        for r in job.at(moment).l6().collect():
            want[r["name"], moment] = (r["value"], r["state"])
    assert got == want
    assert got["n", times[-1]] == (0.0, "OK") and got["code", times[-1]] == (None, "UNKNOWN")


def test_rules_on_summaries_count_their_own_window(job):
    """A 300 hour rule over a3 (built over 168) sees 300 hours."""
    value = {r["name"]: r["value"] for r in job.l6().collect()}["groups"]
    bound = AS_OF - dt.timedelta(hours=300)
    logins = job.d1.where(F.col("event_time") >= F.lit(bound)).groupBy("source_ip").count().agg(F.max("count")).first()[0]
    assert value == logins > job.a3_counts.agg(F.max("failed_attempts")).first()[0]


def test_catalogue_may_set_notifications_per_rule():
    rows = {r[0]: r for r in L.definition_rows(CATALOGUE)}
    at = [f.split()[0] for f in L.DEFINITION_SCHEMA.split(", ")]
    assert rows["users"][at.index("notify_on_ok")] is False and rows["users"][at.index("retrigger_seconds")] == 5
    assert rows["n"][at.index("notify_on_ok")] is True and rows["n"][at.index("retrigger_seconds")] == 0
