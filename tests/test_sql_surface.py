"""The SQL functions give what the DataFrame functions give."""

import json

import pytest
from pyspark.sql import functions as F

from auditlens.operators import alerts as L
from auditlens.sources.sql_surface import OWNER, register_sql


@pytest.fixture(scope="module")
def sql(spark):
    assert register_sql(spark) == ["alert_document", "alert_state", "alert_inventory"]
    return spark


def test_document_equals_the_dataframe_path(sql):
    definitions = L.alert_definitions(sql)
    columns = [c for c in definitions.columns if c in ("display_name", "metric", "hours", "comparison_operator", "threshold_value",
                                                       "empty_result_state", "warehouse_id", "user_email", "notify_on_ok", "retrigger_seconds",
                                                       "pause_status", "cron_schedule", "timezone_id")]
    call = "alert_document(" + ", ".join(f"{c} => {c}" for c in columns) + ")"
    got = {r["name"]: r["d"] for r in definitions.selectExpr("name", f"{call} AS d").collect()}
    assert got == {r["name"]: r["alert_document"] for r in L.alert_document(definitions).collect()}


def test_named_arguments_and_defaults(sql):
    row = sql.sql("SELECT alert_document(metric => 'm', display_name => 'd', threshold_value => 5) AS d").first()
    doc = json.loads(row["d"])
    assert doc["evaluation"]["threshold"]["value"]["double_value"] == 5 and doc["query_text"] == "m over the last 168 hours"
    assert doc["notification"] == {"notify_on_ok": True, "retrigger_seconds": 0, "subscriptions": [{}]}


def test_state_equals_the_dataframe_path(sql):
    rows = [(v, t, op, "EMPTY") for v in (None, 1.0, 2.0, 3.0) for t in (2.0,) for op in (*L.OPERATORS, "ODD")]
    frame = sql.createDataFrame(rows, "value double, t double, op string, e string")
    own = frame.select("*", L.alert_state(F.col("value"), F.col("op"), F.col("t"), F.col("e")).alias("s"),
                       F.expr("alert_state(value, comparison_operator => op, threshold_value => t, empty_result_state => e)").alias("q"))
    assert own.where("NOT s <=> q").count() == 0
    assert sql.sql("SELECT alert_state(value => 1)").first()[0] == "TRIGGERED"


def test_inventory_by_owner(sql):
    listing = json.dumps({"results": [{"id": "1", "display_name": "a", "owner_user_name": "me", "schedule": {"pause_status": "PAUSED"},
                                       "evaluation": {"comparison_operator": "EQUAL", "threshold": {"value": {"double_value": 2}}}},
                                      {"id": "2", "owner_user_name": "you"}]})
    want = [tuple(r) for r in L.alert_inventory(sql.createDataFrame([(listing,)], "text string"), "me").collect()]
    register_sql(sql, owner="me")
    assert [tuple(r) for r in sql.sql(f"SELECT * FROM alert_inventory(:t, {OWNER})", args={"t": listing}).collect()] == want
    sql.createDataFrame([(listing,), (None,), ("no json",)], "text string").createOrReplaceTempView("listings")
    joined = sql.sql(f"SELECT i.* FROM listings, LATERAL alert_inventory(listing => text, owner => {OWNER}) i")
    assert [tuple(r) for r in joined.collect()] == want
