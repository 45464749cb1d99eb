"""The SQL surface: functions with named arguments and defaults, and a session variable for the owner.

SQL users call the alert document and the alert listing as they would call
any function, leaving out what they don't care for::

    SELECT alert_document(display_name => 'logins', metric => 'auth_events_count', threshold_value => 5);
    SET VAR alert_owner = 'me@example.com';
    SELECT * FROM alert_inventory(listing => (SELECT text FROM listings LIMIT 1), owner => alert_owner);

The bodies are expressions over the arguments, so calls are inlined into the
query's plan like any other column.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from auditlens.operators.alerts import DEFAULT_INTERVAL_HOURS, LISTING_SCHEMA, SOURCE_BLOCK
from auditlens.sources.rules import DEFAULT_CRON

#: Arguments of alert_document: name, type, default (None: none, the argument is required).
DOCUMENT_ARGUMENTS = (
    ("display_name", "STRING", None), ("metric", "STRING", None), ("hours", "INT", str(DEFAULT_INTERVAL_HOURS)),
    ("comparison_operator", "STRING", "'GREATER_THAN'"), ("threshold_value", "DOUBLE", "0"), ("empty_result_state", "STRING", "'UNKNOWN'"),
    ("warehouse_id", "STRING", "NULL"), ("user_email", "STRING", "NULL"), ("notify_on_ok", "BOOLEAN", "TRUE"),
    ("retrigger_seconds", "INT", "0"), ("pause_status", "STRING", "'PAUSED'"), ("cron_schedule", "STRING", f"'{DEFAULT_CRON}'"),
    ("timezone_id", "STRING", "'UTC'"),
)
FUNCTIONS = ("alert_document", "alert_state", "alert_inventory")
OWNER = "alert_owner"

_source = ", ".join(f"'{k}', '{v}'" for k, v in SOURCE_BLOCK.items())
_DOCUMENT = f"""to_json(named_struct(
  'display_name', display_name,
  'query_text', concat(metric, ' over the last ', CAST(hours AS STRING), ' hours'),
  'warehouse_id', warehouse_id,
  'evaluation', named_struct(
    'comparison_operator', comparison_operator, 'empty_result_state', empty_result_state, 'source', named_struct({_source}),
    'threshold', named_struct('value', named_struct('double_value', threshold_value))),
  'notification', named_struct(
    'notify_on_ok', notify_on_ok, 'retrigger_seconds', retrigger_seconds, 'subscriptions', array(named_struct('user_email', user_email))),
  'schedule', named_struct('pause_status', pause_status, 'quartz_cron_schedule', cron_schedule, 'timezone_id', timezone_id)))"""

_STATE = """CASE WHEN value IS NULL THEN empty_result_state
  WHEN CASE comparison_operator WHEN 'GREATER_THAN' THEN value > threshold_value WHEN 'GREATER_THAN_OR_EQUAL' THEN value >= threshold_value
            WHEN 'LESS_THAN' THEN value < threshold_value WHEN 'LESS_THAN_OR_EQUAL' THEN value <= threshold_value
            WHEN 'EQUAL' THEN value = threshold_value WHEN 'NOT_EQUAL' THEN value <> threshold_value END THEN 'TRIGGERED'
  WHEN comparison_operator IN ('GREATER_THAN', 'GREATER_THAN_OR_EQUAL', 'LESS_THAN', 'LESS_THAN_OR_EQUAL', 'EQUAL', 'NOT_EQUAL') THEN 'OK' END"""

_INVENTORY = """SELECT a.id, a.display_name, a.owner_user_name, a.create_time, a.update_time, a.schedule.quartz_cron_schedule AS cron,
  a.schedule.pause_status AS paused, a.evaluation.comparison_operator AS op, a.evaluation.threshold.value.double_value AS threshold
FROM (SELECT explode(from_json(alert_inventory.listing, '{schema}').results) AS a)
WHERE a.owner_user_name = alert_inventory.owner"""


def register_sql(spark: SparkSession, owner: str | None = None) -> list[str]:
    """Register the functions and the variable ``alert_owner`` in the session (again: replaced)."""
    arguments = ", ".join(f"{name} {kind}" + ("" if default is None else f" DEFAULT {default}") for name, kind, default in DOCUMENT_ARGUMENTS)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION alert_document({arguments}) RETURNS STRING RETURN {_DOCUMENT}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION alert_state(value DOUBLE, threshold_value DOUBLE DEFAULT 0, "
              "comparison_operator STRING DEFAULT 'GREATER_THAN', empty_result_state STRING DEFAULT 'UNKNOWN') "
              f"RETURNS STRING RETURN {_STATE}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION alert_inventory(listing STRING, owner STRING) RETURNS TABLE (id STRING, display_name STRING, "
              "owner_user_name STRING, create_time STRING, update_time STRING, cron STRING, paused STRING, op STRING, threshold DOUBLE) "
              f"RETURN {_INVENTORY.format(schema=LISTING_SCHEMA)}")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {OWNER} STRING DEFAULT NULL")
    if owner is not None:
        spark.sql(f"SET VAR {OWNER} = :owner", args={"owner": owner})
    return list(FUNCTIONS)
