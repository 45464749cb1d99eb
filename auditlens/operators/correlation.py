"""Q12 in earnest: privileged actions of a user soon after failed logins of the same user.

The report's own Q12 sets two unrelated counts side by side. Here each
privileged action is held against the failed logins of its actor in the
``hours`` before it. Pairs of logins and actions are never made: a user with
a million of each in one hour would make a million times a million. Time is
cut into bins as wide as the look-back, so a look-back reaches into the
action's bin and the one before, and the count is the running number of
logins in the one plus what is left of the other: one sort of logins and
actions per user and bin, however many there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

#: Layers of privileged actions and their labels.
PRIVILEGED = {"d2": "ACCOUNT_ADMIN", "d3": "WORKSPACE_ACL", "d4": "SENSITIVE_GROUP", "d6": "UC_PERMISSIONS", "d7": "ACCOUNT_SETTINGS"}


def privileged_actions(layers: dict[str, DataFrame]) -> DataFrame:
    """The privileged detections as one relation: escalation_type, actor, event_time, n_actions (equal ones counted)."""
    parts = [layers[name].select(F.lit(label).alias("escalation_type"), "actor", "event_time") for name, label in PRIVILEGED.items() if name in layers]
    return reduce(DataFrame.unionByName, parts).groupBy("escalation_type", "actor", "event_time").agg(F.count(F.lit(1)).alias("n_actions"))


def _seconds(time: Column, naive: bool) -> Column:
    """Microseconds since 1970 (a naive time as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time) if naive else F.unix_micros(time)


def actions_after_failed_logins(logins: DataFrame, actions: DataFrame, hours: int = 6, least: int = 1) -> DataFrame:
    """Actions with at least ``least`` failed logins of their actor in the ``hours`` before (both ends included).

    ``logins``: D1 (username, event_time); ``actions``: ``privileged_actions``. Gives escalation_type, actor,
    event_time, n_actions, failed_before, last_failed. Null users match nobody.
    """
    naive = isinstance(actions.schema["event_time"].dataType, TimestampNTZType)
    width = hours * 3_600_000_000
    key = F.struct("escalation_type", "event_time", "n_actions")
    at = _seconds(F.col("event_time"), naive)
    none = F.lit(None).cast(actions.select(key.alias("k")).schema["k"].dataType)
    failed = logins.where("username IS NOT NULL").select(F.col("username").alias("user"), at.alias("at"), F.lit(1).alias("kind"), none.alias("action"))
    known = actions.where("actor IS NOT NULL").select(F.col("actor").alias("user"), at.alias("at"), key.alias("action"))
    # an action asks twice: where its look-back begins (before the logins of that instant) and where it ends (after them)
    asks = known.select("user", F.explode(F.array(
        F.struct((F.col("at") - width).alias("at"), F.lit(0).alias("kind")), F.struct(F.col("at"), F.lit(2).alias("kind")))).alias("q"), "action").select(
        "user", "q.at", "q.kind", "action")
    rows = failed.unionByName(asks).withColumn("bin", F.floor(F.col("at") / F.lit(width)))
    upto = Window.partitionBy("user", "bin").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("user", "bin")
    login = F.when(F.col("kind") == 1, F.col("at"))
    counted = rows.withColumns({"before": F.count(login).over(upto), "last": F.max(login).over(upto),
                                "all": F.count(login).over(whole), "last_of_all": F.max(login).over(whole)}).where("kind != 1")
    ends = F.col("kind") == 2
    found = counted.groupBy("user", "action").agg(
        F.sum(F.when(ends, F.col("before")).otherwise(F.col("all") - F.col("before"))).alias("failed_before"),
        # of the earlier bin the last login counts if it lies in the look-back: then it comes after the first question
        F.max(F.when(ends, F.col("last")).when(F.col("all") > F.col("before"), F.col("last_of_all"))).alias("last"))
    last = F.timestamp_micros("last")
    return found.where(F.col("failed_before") >= least).select(
        "action.escalation_type", F.col("user").alias("actor"), "action.event_time", "action.n_actions", "failed_before",
        (F.to_timestamp_ntz(F.date_format(last, "yyyy-MM-dd HH:mm:ss.SSSSSS")) if naive else last).alias("last_failed"))


def actors_after_failed_logins(found: DataFrame) -> DataFrame:
    """Per actor: how many actions came after failed logins, the most failures before one, first and last such action."""
    return found.groupBy("actor").agg(F.sum("n_actions").cast("bigint").alias("actions"), F.max("failed_before").alias("most_failed_before"),
                                      F.min("event_time").alias("first_action"), F.max("event_time").alias("last_action"))
