"""Alerts as data.

A rule is a metric over a layer, a window, an operator and a threshold.
A metric is the id of a packaged one, or declared in the catalogue: source
layer, aggregate, column, filters. L1-L5 compute one-row metrics, L7 turns
the catalogue into a definitions DataFrame, L6 evaluates each rule's own
metric over its own window, L8 renders the alert document, L9 flattens an
alert listing, L10 summarises rules.
"""

from __future__ import annotations

import datetime as dt
import json
import warnings
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.exprs import json_field, parse_as_of, since, ts_literal
from auditlens.functions.scoring import ANALYSIS_COLUMN
from auditlens.sources.rules import DEFAULT_CRON, load_rules


# Comparison operators and the alert document's source block.
OPERATORS = {
    "GREATER_THAN": lambda v, t: v > t,
    "GREATER_THAN_OR_EQUAL": lambda v, t: v >= t,
    "LESS_THAN": lambda v, t: v < t,
    "LESS_THAN_OR_EQUAL": lambda v, t: v <= t,
    "EQUAL": lambda v, t: v == t,
    "NOT_EQUAL": lambda v, t: v != t,
}
SOURCE_BLOCK = {"aggregation": "FIRST", "display": "value", "name": "value"}
DEFAULT_INTERVAL_HOURS = 168

DEFINITION_SCHEMA = (
    "name string, display_name string, description string, metric string, time_interval string, "
    "hours int, interval_fallback boolean, comparison_operator string, threshold_value double, "
    "empty_result_state string, cron_schedule string, timezone_id string, pause_status string, "
    "notify_on_ok boolean, retrigger_seconds int, user_email string, warehouse_id string"
)

# The fields of the host's alert listing that the inventory reads.
LISTING_SCHEMA = (
    "results ARRAY<STRUCT<id: STRING, display_name: STRING, owner_user_name: STRING, "
    "create_time: STRING, update_time: STRING, "
    "schedule: STRUCT<quartz_cron_schedule: STRING, pause_status: STRING>, "
    "evaluation: STRUCT<comparison_operator: STRING, "
    "threshold: STRUCT<value: STRUCT<double_value: DOUBLE>>>>>"
)

AGGREGATES = {
    "count": lambda hit, col: F.count_if(hit),
    "count_distinct": lambda hit, col: F.count_distinct(F.when(hit, col)),
    "sum": lambda hit, col: F.sum(F.when(hit, col)),
    "avg": lambda hit, col: F.avg(F.when(hit, col)),
    "min": lambda hit, col: F.min(F.when(hit, col)),
    "max": lambda hit, col: F.max(F.when(hit, col)),
}
EVENT_LAYERS = ("d1", "d2", "d3", "d4", "d5", "d6", "d7", "d8")
#: The layers a metric may read, and the time column its window bounds (none: the layer is bounded already).
METRIC_SOURCES = {**dict.fromkeys(EVENT_LAYERS, "event_time"),
                  **dict.fromkeys(("a1", "a2", "a3", "r_fl"), "last_attempt"),
                  **dict.fromkeys(("a4", "a5", "a6", "a7", "a8", "a9", "r_de", "r_aa", "r_wa", "r_sg", "r_uc", "r_as"), "last_activity"),
                  "c1": "actor_last_activity", "c2": None, "c3": None}


class Filter(NamedTuple):
    """``column operator value``; with ``json_field`` that field of the column's JSON text."""

    column: str
    operator: str
    value: object
    json_field: str | None = None

    def test(self) -> Column:
        col = F.col(self.column) if self.json_field is None else json_field(self.column, self.json_field)
        if self.operator == "IN":
            return col.isin(*self.value)
        return OPERATORS[self.operator](col, F.lit(self.value))


class Metric(NamedTuple):
    """A layer, an aggregate over a column of it, filters, and the time column of the window (None: no window)."""

    source: str
    aggregate: str = "count"
    column: str | None = None
    filters: tuple[Filter, ...] = ()
    time_column: str | None = "event_time"


# The packaged metrics.
METRICS = {
    "auth_events_count": Metric("d1"),
    "account_admin_assignments_count": Metric("d2"),
    "data_export_count": Metric("d8"),
    "uc_permission_escalations_count": Metric("d6"),
    "high_risk_export_sum": Metric("r_de", "sum", "export_count", (
        Filter(ANALYSIS_COLUMN, "IN", ("HIGH", "CRITICAL"), "risk_level"),), None),
}


# --- L1-L5: metrics --------------------------------------------------------------------------

def count_metric(detection: DataFrame, as_of, hours) -> DataFrame:
    """COUNT(*) of a detection over a look-back: one row, column ``value`` (0 when empty)."""
    return since(detection, as_of, hours).agg(F.count(F.lit(1)).alias("value"))


def failed_login_alert(d1: DataFrame, as_of, hours=24) -> DataFrame:
    """L1: failed logins in the window."""
    return count_metric(d1, as_of, hours)


def account_admin_alert(d2: DataFrame, as_of, hours=24) -> DataFrame:
    """L2: admin grants in the window."""
    return count_metric(d2, as_of, hours)


def data_export_alert(d8: DataFrame, as_of, hours=168) -> DataFrame:
    """L3: export events in the window (on top of D8's own look-back)."""
    return count_metric(d8, as_of, hours)


def uc_permission_alert(d6: DataFrame, as_of, hours=720) -> DataFrame:
    """L4: catalog permission escalation rows in the window."""
    return count_metric(d6, as_of, hours)


def data_export_ai_alert(r_de: DataFrame) -> DataFrame:
    """Exports of HIGH/CRITICAL export groups; NULL when there is none."""
    high = json_field(ANALYSIS_COLUMN, "risk_level").isin("HIGH", "CRITICAL")
    return r_de.filter(high).agg(F.sum("export_count").cast("bigint").alias("value"))


# --- L7 / L10: definitions --------------------------------------------------------------------

def metric_of(value, name: str) -> Metric:
    """The metric of a rule: a packaged id, or a declaration ``{source, aggregate, column, filter, time_column}``."""
    if isinstance(value, str):
        if value not in METRICS:
            raise ValueError(f"alert '{name}': unknown alert metric '{value}'")
        return METRICS[value]
    unknown = set(value) - {"source", "aggregate", "column", "filter", "time_column"}
    source, aggregate, column = value.get("source"), value.get("aggregate", "count"), value.get("column")
    if unknown or source not in METRIC_SOURCES or aggregate not in AGGREGATES or (aggregate != "count" and not column):
        raise ValueError(f"alert '{name}': no metric: {value}")
    filters = []
    for f in value.get("filter", ()):
        many = f.get("operator") == "IN"
        if f.get("operator") not in (*OPERATORS, "IN") or many != isinstance(f.get("value"), list) or not f.get("column"):
            raise ValueError(f"alert '{name}': no filter: {f}")
        filters.append(Filter(f["column"], f["operator"], tuple(f["value"]) if many else f["value"], f.get("json_field")))
    return Metric(source, aggregate, column, tuple(filters), value.get("time_column", METRIC_SOURCES[source]))


def catalogue_alerts(rules: dict) -> list[dict]:
    """The rules of a catalogue, which holds them as a list or keyed by name; names are unique."""
    alerts = rules["alerts"]
    if isinstance(alerts, dict):
        alerts = [{"name": name, **alert} for name, alert in alerts.items()]
    out = [{**a, "name": a.get("name", a.get("display_name"))} for a in alerts]
    names = [a["name"] for a in out]
    if None in names or len(set(names)) < len(names):
        raise ValueError("every alert needs a name of its own")
    return out


def rule_window(alert: dict, rules: dict) -> tuple[str, int, bool]:
    """Name of the window, its hours, and whether the catalogue's default stands in for an unknown name."""
    intervals = rules.get("time_intervals", {})
    interval = alert.get("time_interval", "default")
    hours = intervals.get(interval, intervals.get("default", DEFAULT_INTERVAL_HOURS))
    return interval, int(hours), interval not in intervals


def rule_metrics(rules: dict | None = None) -> list[tuple[str, int, Metric]]:
    """Name, window in hours and metric of every rule (checked)."""
    rules = rules or load_rules()
    return [(a["name"], rule_window(a, rules)[1], metric_of(a["metric"], a["name"])) for a in catalogue_alerts(rules)]


def definition_rows(rules: dict | None = None) -> list[tuple]:
    """Resolve each rule's window and merge the global settings (driver-side, catalogue-sized)."""
    rules = rules or load_rules()
    glob = rules["global"]
    allowed = set(rules.get("comparison_operators", OPERATORS))
    rows = []
    for alert in catalogue_alerts(rules):
        name = alert["name"]
        interval, hours, fallback = rule_window(alert, rules)
        if fallback:
            warnings.warn(f"time_interval '{interval}' unknown for alert '{name}'; using {hours} hours")
        op = alert["comparison_operator"]
        if op not in OPERATORS or op not in allowed:
            raise ValueError(f"alert '{name}': unsupported comparison operator {op}")
        metric_of(alert["metric"], name)
        metric = alert["metric"] if isinstance(alert["metric"], str) else json.dumps(alert["metric"], sort_keys=True)
        rows.append((
            name, alert.get("display_name", name), alert.get("description"), metric, interval,
            hours, fallback, op, float(alert["threshold_value"]),
            alert.get("empty_result_state", "UNKNOWN"),
            alert.get("cron_schedule", glob.get("cron_schedule", DEFAULT_CRON)),
            glob.get("timezone_id", "UTC"), glob.get("pause_status", "PAUSED"),
            bool(alert.get("notify_on_ok", glob.get("notify_on_ok", True))),
            int(alert.get("retrigger_seconds", glob.get("retrigger_seconds", 0))),
            glob.get("user_email"), glob.get("warehouse_id"),
        ))
    return rows


def alert_definitions(spark: SparkSession, rules: dict | None = None) -> DataFrame:
    """One row per rule with its window in hours and the global settings."""
    return spark.createDataFrame(definition_rows(rules), DEFINITION_SCHEMA)


def alert_summary(definitions: DataFrame) -> DataFrame:
    """What each rule checks."""
    return definitions.select("display_name", "description", "comparison_operator",
                              "threshold_value", "time_interval", "hours")


# --- L6: evaluation ---------------------------------------------------------------------------

def alert_state(value: Column, operator: Column, threshold: Column, empty_state: Column) -> Column:
    """TRIGGERED / OK, or the rule's empty-result state when the metric is NULL."""
    state = F.when(value.isNull(), empty_state)
    for name, test in OPERATORS.items():
        state = state.when(operator == name,
                           F.when(test(value, threshold), F.lit("TRIGGERED")).otherwise(F.lit("OK")))
    return state


def within(frame: DataFrame, metric: Metric, as_of, hours: float) -> Column:
    """Rows of the frame that a rule counts: its filters, within its window."""
    tests = [f.test() for f in metric.filters]
    if metric.time_column is not None:
        lower = parse_as_of(as_of) - dt.timedelta(hours=hours)
        tests.append(F.col(metric.time_column) >= ts_literal(lower, frame.schema[metric.time_column].dataType))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def rule_values(source: Callable[[str, float], DataFrame], metrics: list[tuple[str, int, Metric]], as_of) -> DataFrame:
    """Rows (name, value): each rule's metric over its own window.

    ``source(layer, hours)`` gives the layer with at least so many hours of
    history. Rules that read the same layer share one scan: a global
    aggregate with a conditional aggregate per rule.
    """
    by_layer: dict[str, list[tuple[str, int, Metric]]] = {}
    for rule in metrics:
        by_layer.setdefault(rule[2].source, []).append(rule)
    parts = []
    for layer, rules in by_layer.items():
        windows = [hours for _, hours, m in rules if m.time_column is not None or layer in EVENT_LAYERS]
        frame = source(layer, max(windows, default=0))
        columns = [AGGREGATES[m.aggregate](within(frame, m, as_of, hours), F.col(m.column) if m.column else None)
                   .cast("double").alias(f"v{i}") for i, (_, hours, m) in enumerate(rules)]
        named = F.array(*(F.struct(F.lit(name).alias("name"), F.col(f"v{i}").alias("value")) for i, (name, _, _) in enumerate(rules)))
        parts.append(frame.agg(*columns).select(F.explode(named).alias("r")).select("r.name", "r.value"))
    return reduce(DataFrame.unionByName, parts)


def evaluate_alerts(values: DataFrame, definitions: DataFrame, as_of) -> DataFrame:
    """Compare each rule's value with its threshold.

    ``values`` has rows ``(name, value)``, one per rule at most; a rule
    without one gets its empty-result state.
    """
    joined = definitions.join(values.groupBy("name").agg(F.first("value").alias("value")), "name", "left")
    return _evaluated(joined, ts_literal(as_of))


def evaluate_over_time(values: DataFrame, definitions: DataFrame) -> DataFrame:
    """L6 at several moments: ``values`` has rows (name, as_of, value)."""
    return _evaluated(definitions.join(values, "name"), F.col("as_of"))


def _evaluated(joined: DataFrame, as_of: Column) -> DataFrame:
    value = F.col("value").cast("double")
    return joined.select(
        "name", "metric", value.alias("value"), "comparison_operator", "threshold_value", "hours",
        alert_state(value, F.col("comparison_operator"), F.col("threshold_value"),
                    F.col("empty_result_state")).alias("state"),
        as_of.alias("as_of"),
    )


# --- L8 / L9: documents and listings ----------------------------------------------------------

def alert_document(definitions: DataFrame) -> DataFrame:
    """The nested alert document (evaluation / notification / schedule) as JSON text.

    ``to_json`` leaves NULL fields out, so a missing e-mail gives an empty
    subscription object.
    """
    query_text = F.concat(F.col("metric"), F.lit(" over the last "), F.col("hours").cast("string"),
                          F.lit(" hours"))
    doc = F.struct(
        F.col("display_name"),
        query_text.alias("query_text"),
        F.col("warehouse_id"),
        F.struct(
            F.col("comparison_operator"),
            F.col("empty_result_state"),
            F.struct(*[F.lit(v).alias(k) for k, v in SOURCE_BLOCK.items()]).alias("source"),
            F.struct(F.struct(F.col("threshold_value").alias("double_value")).alias("value"))
            .alias("threshold"),
        ).alias("evaluation"),
        F.struct(
            F.col("notify_on_ok"),
            F.col("retrigger_seconds"),
            F.array(F.struct(F.col("user_email"))).alias("subscriptions"),
        ).alias("notification"),
        F.struct(
            F.col("pause_status"),
            F.col("cron_schedule").alias("quartz_cron_schedule"),
            F.col("timezone_id"),
        ).alias("schedule"),
    )
    return definitions.select("name", F.to_json(doc).alias("alert_document"))


def alert_inventory(listing: DataFrame, owner: str, text_col: str = "text") -> DataFrame:
    """Flatten an alert listing (JSON ``{"results": [...]}``) and keep one owner's alerts."""
    parsed = listing.select(F.from_json(F.col(text_col), LISTING_SCHEMA).alias("payload"))
    alerts = parsed.select(F.explode("payload.results").alias("a"))
    return alerts.select(
        F.col("a.id").alias("id"),
        F.col("a.display_name").alias("display_name"),
        F.col("a.owner_user_name").alias("owner_user_name"),
        F.col("a.create_time").alias("create_time"),
        F.col("a.update_time").alias("update_time"),
        F.col("a.schedule.quartz_cron_schedule").alias("cron"),
        F.col("a.schedule.pause_status").alias("paused"),
        F.col("a.evaluation.comparison_operator").alias("op"),
        F.col("a.evaluation.threshold.value.double_value").alias("threshold"),
    ).filter(F.col("owner_user_name") == F.lit(owner))
