"""Mergeable distinct counts of failed logins."""

import datetime as dt

from audit_rows import AS_OF, bag
from pyspark.sql import functions as F

from auditlens.operators.sketches import ENTITY, ERROR, login_sketches, measured_sketches, merged_sketches

SCHEMA = "event_time timestamp_ntz, username string, source_ip string, user_agent string"


def logins(spark, n):
    """One IP meets n users over four days, twice each; every user also has an IP of its own."""
    return spark.range(2 * n).select(
        (F.lit(AS_OF) - F.make_dt_interval(F.col("id").cast("int") % 4)).cast("timestamp_ntz").alias("event_time"),
        F.concat(F.lit("u"), F.col("id") % n).alias("username"),
        F.when(F.col("id") % 5 > 0, "hot").otherwise(F.concat(F.lit("ip"), F.col("id") % n)).alias("source_ip"),
        F.lit("agent").alias("user_agent"))


def test_days_and_batches_merge_to_the_whole(spark):
    d1 = logins(spark, 30000)
    early = F.pmod(F.xxhash64("username", "event_time"), F.lit(3)) == 0
    once, batches = login_sketches(d1), login_sketches(d1.where(early)).unionByName(login_sketches(d1.where(~early)))
    exact = ("failed_attempts", "first_attempt", "last_attempt")
    assert bag(merged_sketches(once).select(*ENTITY, *exact)) == bag(merged_sketches(batches).select(*ENTITY, *exact))
    for states in (once, batches):
        got = measured_sketches(states, d1)
        assert got.where("NOT within_error").count() == 0
        hot = got.where("entity_id = 'hot'").first()
        assert abs(hot["unique_estimate"] / hot["unique_entities"] - 1) < 3 * ERROR


def test_windows_and_wider_keys(spark):
    d1 = logins(spark, 4000)
    states, today = login_sketches(d1), AS_OF.date()
    last = merged_sketches(states, ("detection_type", "day"), first_day=today - dt.timedelta(days=1), last_day=today)
    assert {r["day"] for r in last.collect()} == {today, today - dt.timedelta(days=1)}
    family = merged_sketches(states, ("detection_type",)).where("detection_type = 'IP_BASED'").first()
    assert family["failed_attempts"] == 8000 and abs(family["unique_estimate"] / 4000 - 1) < 4 * ERROR


def test_nulls_repeats_and_an_empty_log(spark):
    rows = [(AS_OF, None, "a", "x"), (AS_OF, "u", None, "x"), (AS_OF, "u", "b", None), (AS_OF, "u", "b", None)]
    d1 = spark.createDataFrame(rows, SCHEMA)
    got = measured_sketches(login_sketches(d1), d1).select("detection_type", "entity_id", "failed_attempts", "unique_estimate", "within_error")
    assert bag(got) == [("IP_BASED", "a", 1, 0, True), ("IP_BASED", "b", 2, 1, True), ("USER_BASED", "u", 3, 1, True)]
    empty = spark.createDataFrame([], SCHEMA)
    assert measured_sketches(login_sketches(empty), empty).collect() == []
