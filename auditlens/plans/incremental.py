"""Summaries that build on the last refresh: mergeable states per day.

A refresh aggregates its whole look-back again, although all but the newest
rows were there the last time. Here every batch of new audit rows is read
once: its detections are kept, and counted per day and group (number of
events, first, last). A look-back is then the sum of whole days of such
states; only the day in which it begins is cut, from that one day's kept
detections. The summaries take the states as they take events
(``summaries.PARTIAL``), so assessments, posture and reports follow.

A late row adds to its own day, whenever it comes: its batch brings another
state of that day, and states add up. Batches come from any DataFrame
(``add``) or from a stream over the folder in which the log's files arrive
(``advance``), which remembers the files it has seen.

What the store holds is published by a manifest written last: a batch that
fails on its way leaves the state before, and one that is tried again after
it was published is left out.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from auditlens.functions.exprs import parse_as_of, time_type, ts_literal
from auditlens.operators.detections import EXPORT_LOOKBACK_HOURS
from auditlens.operators.summaries import PARTIAL
from auditlens.plans import shared_scan as SS
from auditlens.sources.audit import resolve_as_of
from auditlens.sources.sinks import prune_published, publish, published, write_version
from auditlens.sources.tags import has_validity

_PLACE = ("service_name", "workspace_id", "actor")
#: What the summaries group by, by rule: the keys of a state.
STATE_KEYS = {
    SS.D1: ("username", "source_ip", "user_agent"),
    SS.D2: (*_PLACE, "target_user", "action_name"),
    SS.D3: (*_PLACE, "target_user", "action_name", "new_acl"),
    SS.D4: (*_PLACE, "target_user", "group_name", "action_name"),
    SS.D6: (*_PLACE, "securable_type", "securable_full_name", "action_name", "changes"),
    SS.D7: (*_PLACE, "action_name", "key_type", "key_name", "settings"),
    SS.D8: ("workspace_id", "actor", "source", "action_name", "artifact"),
}
KEY_COLUMNS = tuple(dict.fromkeys(c for keys in STATE_KEYS.values() for c in keys))


def utc_day(df: DataFrame) -> Column:
    """The UTC day of ``event_time``, whatever the session's time zone."""
    if isinstance(time_type(df), T.TimestampNTZType):
        return F.to_date("event_time")
    return F.date_from_unix_date(F.floor(F.unix_micros("event_time") / F.lit(86_400_000_000)).cast("int"))


def keyed(detections: DataFrame) -> list[Column]:
    """The key columns of tagged rows, null where the rule's summaries don't group by them."""
    return [F.when(F.col("rule").isin([r for r, keys in STATE_KEYS.items() if c in keys]), F.col(c)).alias(c) for c in KEY_COLUMNS]


def partial_states(detections: DataFrame) -> DataFrame:
    """Tagged rows (with ``day``) counted per rule, day and keys: n, first_event, last_event."""
    rows = detections.select("rule", "day", *keyed(detections), "event_time")
    return rows.groupBy("rule", "day", *KEY_COLUMNS).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_time").alias("first_event"), F.max("event_time").alias("last_event"))


def merged(states: DataFrame) -> DataFrame:
    """States of the same rule, day and keys added up."""
    return states.groupBy("rule", "day", *KEY_COLUMNS).agg(
        F.sum("n").cast("bigint").alias("n"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))


class DailyStates:
    """A store of kept detections and of their daily states, under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def content(self) -> dict:
        return published(self.spark, self.path) or {"done": {}, "detections": [], "states": [], "schemas": {}, "latest": None}

    # writing
    def add(self, audit_rows: DataFrame, run: str, number: int) -> bool:
        """Take in a batch of new audit rows, the ``number``-th of a ``run`` (in rising order).

        False if it was taken in before: a batch that is tried again counts once.
        """
        content, spark = self.content(), audit_rows.sparkSession
        if number <= content["done"].get(run, -1):
            return False
        kept = SS.detection_candidates(audit_rows, hours=None)
        kept = kept.withColumn("day", utc_day(kept))
        rows = write_version(kept, f"{self.path}/detections", partition_by=["day"])
        states = partial_states(spark.read.schema(kept.schema).parquet(rows))
        folder = write_version(states, f"{self.path}/states", partition_by=["day"])
        try:
            latest = resolve_as_of(audit_rows).isoformat(sep=" ")
        except ValueError:  # a batch without rows
            latest = None
        publish(spark, self.path, {
            "done": content["done"] | {run: number}, "detections": [*content["detections"], rows], "states": [*content["states"], folder],
            "schemas": {"detections": json.loads(kept.schema.json()), "states": json.loads(states.schema.json())},
            "latest": max(filter(None, (content["latest"], latest)), default=None)})
        return True

    def advance(self, audit_stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Take in what a stream of audit rows brings, each micro-batch once (by default: what is there now, then stop)."""
        def fold(rows: DataFrame, number: int) -> None:
            self.add(rows, checkpoint, number)

        return (audit_stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())

    def compact(self, first_day: dt.date | None = None, keep: int = 2) -> None:
        """Add up the states of all batches into one folder of few files, and likewise the detections.

        ``first_day``: older days are forgotten. States that the ``keep`` newest manifests don't name are deleted.
        """
        content = self.content()
        if not content["states"]:
            return
        recent = F.lit(True) if first_day is None else F.col("day") >= F.lit(first_day)
        now = View(self.spark, content)
        rows = write_version(now.detections.where(recent), f"{self.path}/detections", partition_by=["day"])
        states = write_version(merged(now.states.where(recent)), f"{self.path}/states", partition_by=["day"])
        publish(self.spark, self.path, content | {"detections": [rows], "states": [states]})
        prune_published(self.spark, self.path, lambda c: [*c["detections"], *c["states"]], keep)

    def view(self) -> "View":
        """What the store holds now; later batches don't change it."""
        return View(self.spark, self.content())


class View:
    """One published state of a store: its detections, states and look-backs."""

    def __init__(self, spark: SparkSession, content: dict):
        self.spark, self.content = spark, content

    def view(self) -> "View":
        return self

    def _read(self, kind: str) -> DataFrame:
        if kind not in self.content["schemas"]:
            raise ValueError("no batch was added yet")
        schema = T.StructType.fromJson(self.content["schemas"][kind])
        parts = [self.spark.read.schema(schema).parquet(f).select(*schema.names) for f in self.content[kind]]
        return reduce(DataFrame.unionByName, parts)

    @property
    def detections(self) -> DataFrame:
        """Every kept row with its rule and day: the table ``SecurityPipeline(detections=...)`` reads."""
        return self._read("detections")

    @property
    def states(self) -> DataFrame:
        return self._read("states")

    def latest(self) -> dt.datetime | None:
        """The latest event time of all audit rows taken in (the default ``as_of``): no scan."""
        latest = self.content["latest"]
        return None if latest is None else parse_as_of(latest)

    def window(self, as_of, hours: float) -> DataFrame:
        """The look-back as states: whole days, and the first day cut from its detections."""
        bound = parse_as_of(as_of) - dt.timedelta(hours=hours)
        day = F.lit(bound.date())
        if bound.time() == dt.time():
            return self.states.where(F.col("day") >= day).drop("day")
        rows = self.detections.where(F.col("day") == day)
        cut = rows.where(F.col("event_time") >= ts_literal(bound, time_type(rows))).select(
            "rule", *keyed(rows), F.lit(1).cast("bigint").alias("n"), F.col("event_time").alias("first_event"),
            F.col("event_time").alias("last_event"))
        return self.states.where(F.col("day") > day).drop("day").unionByName(cut)

    def layer(self, name: str, as_of, hours: float, tags: DataFrame) -> DataFrame:
        """A detection (d1 .. d8) of the look-back as states, for the summaries with ``measure=PARTIAL``."""
        if name == "d6" and has_validity(tags):  # which tags hold is a question of the event's time, not of its day
            rows = self.detections.where((F.col("rule") == SS.D6) & SS.after(self.detections, as_of, hours))
            rows = rows.withColumns({"n": F.lit(1).cast("bigint"), "first_event": F.col("event_time"), "last_event": F.col("event_time")})
        else:
            kinds = {f.name: f.dataType for f in self.detections.schema}
            window = self.window(as_of, EXPORT_LOOKBACK_HOURS if name == "d8" else hours)  # D8 has a look-back of its own
            rows = window.select(*(F.col(c) if c in window.columns else F.lit(None).cast(kinds[c]).alias(c) for c in SS.CANDIDATE_COLUMNS),
                                 *PARTIAL.columns)
        return SS.windowed_detection(name, rows, tags, carry=tuple(PARTIAL.columns))
