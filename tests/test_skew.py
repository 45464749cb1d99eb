"""A third of all rows on one key: the two-phase summary equals the naive aggregate."""

from pyspark.sql import functions as F

from auditlens.operators import summaries as A
from audit_rows import AS_OF, bag


def _skewed_d1(spark, n=30_000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0                                     # one IP holds a third of the rows
    return ids.select(
        (F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp_ntz") - F.make_dt_interval(
            F.lit(0), F.lit(0), (F.col("id") % 120).cast("int"))).alias("event_time"),
        F.lit(None).cast("date").alias("event_date"),
        F.lit("accounts").alias("service_name"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("user"), (F.col("id") % 5000).cast("string"))).alias("username"),
        F.lit(None).cast("string").alias("authentication_method"),
        F.concat(F.lit("agent/"), (F.col("id") % 3).cast("string")).alias("user_agent"),
        F.lit("login").alias("action_name"),
        F.lit(401).alias("response_code"),
        F.lit(None).cast("string").alias("response_message"),
        F.lit(None).cast("string").alias("result"),
        F.when(hot, F.lit("10.9.9.9")).otherwise(
            F.concat(F.lit("10.1.0."), (F.col("id") % 200).cast("string"))).alias("source_ip"),
    ).drop("event_date")


def test_two_phase_equals_naive_under_skew(spark):
    d1 = _skewed_d1(spark)
    got = A.failed_logins_by_ip(d1, AS_OF, hours=None).select(
        "entity_id", "failed_attempts", "unique_entities", "related_entities", "user_agents",
        "first_attempt", "last_attempt")
    naive = d1.filter(F.col("source_ip").isNotNull()).groupBy(F.col("source_ip").alias("entity_id")).agg(
        F.count(F.lit(1)).alias("failed_attempts"),
        F.count_distinct("username").alias("unique_entities"),
        F.sort_array(F.collect_set("username")).alias("related_entities"),
        F.sort_array(F.collect_set("user_agent")).alias("user_agents"),
        F.min("event_time").alias("first_attempt"),
        F.max("event_time").alias("last_attempt"))
    assert bag(got) == bag(naive)
    hot = got.filter(F.col("entity_id") == "10.9.9.9").first()
    lean = A.failed_login_patterns(d1, AS_OF, hours=None, lists=False).filter("detection_type = 'IP_BASED'")
    assert bag(lean.select("entity_id", "failed_attempts", "unique_entities")) == bag(
        naive.select("entity_id", "failed_attempts", "unique_entities"))
    assert hot.failed_attempts == 10_000 and hot.unique_entities == len(hot.related_entities) > 1000
