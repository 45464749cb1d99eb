"""L6 over time: what an evaluation changes, and whether a notification is due.

An evaluation (``alerts.evaluate_alerts``) says how a rule stands at one
moment. The state table says how it stood before, since when, and when its
owner was last told. ``next_states`` joins the two; ``AlertStates`` keeps the
table in shared storage from run to run. Nothing is sent: a due row is what
a sender would pick up.

Due is a rule that goes to TRIGGERED; one that still is, when
``retrigger_seconds`` (if above 0) have passed since the last time; and one
that goes back from TRIGGERED to OK, if it has ``notify_on_ok``. A rule
without a result (UNKNOWN) tells nobody.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.exprs import parse_as_of, time_type, ts_literal
from auditlens.operators import alerts as L
from auditlens.operators.detections import EXPORT_LOOKBACK_HOURS
from auditlens.sources.sinks import prune_published, publish, published, write_version

#: A rule's state: how it stands, since when, when its owner was last told, and the evaluation that says so.
STATE_SCHEMA = "name string, state string, since timestamp_ntz, last_notified timestamp_ntz, as_of timestamp_ntz"
TRIGGERED, OK = "TRIGGERED", "OK"
#: Aggregates that are 0, not NULL, over no rows.
COUNTS = ("count", "count_distinct")


def next_states(states: DataFrame, evaluations: DataFrame, definitions: DataFrame) -> DataFrame:
    """Evaluations of the rules, one moment after the other, against their states.

    ``states``: STATE_SCHEMA, one row for a rule at most (none: first seen); ``evaluations``: name, value, state,
    as_of; ``definitions``: name, notify_on_ok, retrigger_seconds. Gives name, as_of, value, state, previous_state,
    changed, since, due, last_notified. An evaluation that is not newer than the state is left out (run again, late).
    Rules without an evaluation keep their state and give no row. The moments of one rule are folded in one row,
    as when it is next due depends on when it last was: as many as are asked for.
    """
    before = states.select("name", F.col("state").alias("_state"), F.col("since").alias("_since"),
                           F.col("last_notified").alias("_told"), F.col("as_of").alias("_as_of"))
    rows = evaluations.select("name", F.struct(F.col("as_of").cast("timestamp_ntz").alias("as_of"), F.col("value").cast("double").alias("value"),
                                               F.col("state")).alias("e"))
    rules = rows.groupBy("name").agg(F.array_sort(F.collect_list("e")).alias("e")).join(
        definitions.select("name", "notify_on_ok", "retrigger_seconds"), "name").join(before, "name", "left")
    fresh = F.filter("e", lambda e: F.col("_as_of").isNull() | (e["as_of"] > F.col("_as_of")))

    def step(acc: Column, e: Column) -> Column:
        same = acc["state"].eqNullSafe(e["state"])
        waited = F.timestamp_diff("SECOND", acc["told"], e["as_of"]) >= F.col("retrigger_seconds")
        due = F.coalesce(F.when(e["state"] == TRIGGERED, ~same | ((F.col("retrigger_seconds") > 0) & waited))
                         .when(e["state"] == OK, (acc["state"] == TRIGGERED) & F.col("notify_on_ok")), F.lit(False))
        since, told = F.when(same, acc["since"]).otherwise(e["as_of"]), F.when(due, e["as_of"]).otherwise(acc["told"])
        row = F.struct(e["as_of"].alias("as_of"), e["value"].alias("value"), e["state"].alias("state"), acc["state"].alias("previous_state"),
                       (~same).alias("changed"), since.alias("since"), due.alias("due"), told.alias("last_notified"))
        return F.struct(e["state"].alias("state"), since.alias("since"), told.alias("told"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    zero = F.struct(F.col("_state").alias("state"), F.col("_since").alias("since"), F.col("_told").alias("told"),
                    F.array().cast(f"array<struct<{_ROW}>>").alias("rows"))
    return rules.select("name", F.explode(F.aggregate(fresh, zero, step)["rows"]).alias("r")).select("name", "r.*")


_ROW = ("as_of: timestamp_ntz, value: double, state: string, previous_state: string, changed: boolean, since: timestamp_ntz, "
        "due: boolean, last_notified: timestamp_ntz")


def state_table(rows: DataFrame) -> DataFrame:
    """The state table that rows of ``next_states`` leave."""
    last = F.max_by(F.struct("state", "since", "last_notified", "as_of"), "as_of").alias("s")
    return rows.groupBy("name").agg(last).select("name", "s.*")


class AlertStates:
    """The state table of a catalogue's rules under a shared folder, with the rows of each step beside it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def current(self) -> DataFrame:
        content = published(self.spark, self.path)
        if content is None:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(content["states"])

    def step(self, evaluations: DataFrame, definitions: DataFrame) -> DataFrame:
        """Take in evaluations; returns their rows (``next_states``), written. Running it again gives no row."""
        states = self.current()
        rows = next_states(states, evaluations, definitions)
        folder = write_version(rows, f"{self.path}/steps")
        rows = self.spark.read.schema(rows.schema).parquet(folder)
        seen = state_table(rows)
        table = write_version(seen.unionByName(states.join(seen.select("name"), "name", "left_anti")), f"{self.path}/states")
        publish(self.spark, self.path, {"states": table, "step": folder})
        prune_published(self.spark, self.path, lambda c: [c["states"]])
        return rows


# --- evaluations at many moments ----------------------------------------------------------------

def event_values_at(source: Callable[[str, float], DataFrame], metrics: list[tuple[str, int, L.Metric]], times) -> DataFrame:
    """Rows (name, as_of, value): rules over event layers at each of ``times``, as they would have been then.

    Rules that read one layer share a scan: each event is counted for every (rule, moment) whose window holds it, so
    moments that lie close together cost no more scans. Events after a moment don't count for it.
    """
    times = sorted(map(parse_as_of, times))
    by_layer: dict[str, list[tuple[str, int, L.Metric]]] = {}
    for rule in metrics:
        by_layer.setdefault(rule[2].source, []).append(rule)
    spark, parts = None, []
    for layer, rules in by_layer.items():
        hours = [min(h, EXPORT_LOOKBACK_HOURS) if layer == "d8" else h for _, h, _ in rules]
        frame = source(layer, max(hours))
        spark, kind = frame.sparkSession, time_type(frame)
        frame = frame.where(F.col("event_time") >= ts_literal(times[0] - dt.timedelta(hours=max(hours))))
        moments = F.array(*(ts_literal(t, kind) for t in times))

        def held(i: int, h: float, metric: L.Metric) -> Column:
            tests = reduce(lambda a, b: a & b, (f.test() for f in metric.filters), F.lit(True))
            near = F.filter(moments, lambda t: (F.col("event_time") <= t) & (F.col("event_time") >= t - F.make_interval(hours=F.lit(int(h)))))
            return F.when(tests, F.transform(near, lambda t: F.struct(F.lit(i).alias("i"), t.alias("t"))))

        hits = F.array_compact(F.array(*(held(i, h, rule[2]) for i, (h, rule) in enumerate(zip(hours, rules, strict=True)))))
        columns = sorted({m.column for _, _, m in rules if m.column})
        rows = frame.select(F.explode(F.flatten(hits)).alias("hit"), *columns)
        values = [L.AGGREGATES[m.aggregate](F.col("hit.i") == i, F.col(m.column) if m.column else None).cast("double")
                  for i, (_, _, m) in enumerate(rules)]
        value = reduce(lambda a, b: a.when(F.col("i") == b[0], b[1]), enumerate(F.col(f"v{i}") for i in range(len(rules))), F.when(F.lit(False), None))
        name = F.array(*(F.lit(n) for n, _, _ in rules))[F.col("i")]
        parts.append(rows.groupBy("hit.i", "hit.t").agg(*(v.alias(f"v{i}") for i, v in enumerate(values))).select(
            name.alias("name"), F.col("t").cast("timestamp_ntz").alias("as_of"), value.alias("value")))
    found = reduce(DataFrame.unionByName, parts)
    # a moment without any event: counts are 0, other aggregates NULL
    grid = spark.createDataFrame([(n, t, 0.0 if m.aggregate in COUNTS else None) for n, _, m in metrics for t in times],
                                 "name string, as_of timestamp_ntz, none double")
    return grid.join(found, ["name", "as_of"], "left").select("name", "as_of", F.coalesce("value", "none").alias("value"))
