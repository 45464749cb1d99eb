"""Privileged actions after failed logins, against a plain loop; no pairs are made."""

import datetime as dt
import random

import pytest

from auditlens.operators import correlation as X
from auditlens.plans.pipeline import SecurityPipeline
from audit_rows import AS_OF, audit_row


def plain(logins, actions, hours, least):
    out = set()
    for kind, actor, t in set(actions):
        hits = [x for user, x in logins if user is not None and user == actor and t - dt.timedelta(hours=hours) <= x <= t]
        if len(hits) >= least:
            out.add((kind, actor, t, actions.count((kind, actor, t)), len(hits), max(hits)))
    return out


@pytest.mark.parametrize(("hours", "kind"), [(1, "timestamp_ntz"), (6, "timestamp_ntz"), (48, "timestamp")])
def test_equals_a_plain_loop(spark, hours, kind):
    r = random.Random(hours)
    start = dt.datetime(2024, 1, 10)

    def moment():  # many at bin edges, and exactly the look-back apart
        return start + dt.timedelta(hours=r.choice([r.randrange(0, 72), hours * r.randrange(0, 8)]), microseconds=r.choice([0, 0, 1, 5_000_000]))

    logins = [(r.choice(["a", "b", "c", None]), moment()) for _ in range(150)]
    actions = [(r.choice(["X", "Y"]), r.choice(["a", "b", "d", None]), moment()) for _ in range(120)]
    d1 = spark.createDataFrame(logins, f"username string, event_time {kind}")
    layer = spark.createDataFrame(actions, f"escalation_type string, actor string, event_time {kind}")
    counted = layer.groupBy("escalation_type", "actor", "event_time").count().withColumnRenamed("count", "n_actions")
    for least in (1, 3):
        got = {tuple(x) for x in X.actions_after_failed_logins(d1, counted, hours, least).collect()}
        assert got == plain(logins, actions, hours, least)


def test_a_hot_user_makes_no_pairs(spark):
    """20,000 logins and 20,000 actions of one user within hours: rows stay in proportion, and no join is planned."""
    d1 = spark.range(20_000).selectExpr("'hot' AS username", "timestampadd(SECOND, CAST(id % 7200 AS INT), TIMESTAMP_NTZ '2024-01-01') AS event_time")
    acts = spark.range(20_000).selectExpr("'X' AS escalation_type", "'hot' AS actor", "1L AS n_actions",
                                          "timestampadd(MICROSECOND, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 01:00:00') AS event_time")
    found = X.actions_after_failed_logins(d1, acts, 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    row = found.agg({"failed_before": "max", "*": "count"}).first()
    assert row["count(1)"] == 20_000 and row["max(failed_before)"] > 7000


def test_of_the_job(make_audit, empty_tags):
    rows = [audit_row(t_hours_ago=h, status=401, email="mallory") for h in (5, 4, 300)]
    rows += [audit_row(t_hours_ago=3, action="setAdmin", email="mallory", params={"targetUserName": "x"}),
             audit_row(t_hours_ago=299, action="setAdmin", email="mallory"), audit_row(t_hours_ago=3, action="setSetting", email="alice")]
    found = SecurityPipeline(make_audit(rows), empty_tags, as_of=AS_OF).actions_after_failed_logins()
    assert [(r["escalation_type"], r["actor"], r["failed_before"]) for r in found.collect()] == [("ACCOUNT_ADMIN", "mallory", 2)]
    assert X.actors_after_failed_logins(found).first()["actions"] == 1
