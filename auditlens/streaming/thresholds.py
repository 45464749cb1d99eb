"""ST2: failed logins per IP or per user above a threshold in a time window.

The same function serves batch and stream. On a stream, the watermark
bounds the state: a window is emitted (append mode) once the watermark
passes its end, and rows later than the watermark are dropped. Partial
aggregation keeps a hot IP to one partial row per task. Several entity
kinds are counted in one pass (each login tagged once per kind).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Entity -> (entity column, entity_type label).
ENTITIES = {
    "source_ip": ("source_ip", "source_ip"),
    "user": ("username", "user"),
}


def login_threshold(d1: DataFrame, entity: str | tuple[str, ...] = "source_ip", window: str = "24 hours",
                    threshold: int = 5, watermark: str | None = "1 hour",
                    slide: str | None = None) -> DataFrame:
    """Windows in which one entity has at least ``threshold`` failed logins.

    ``entity`` is ``"source_ip"``, ``"user"`` or a tuple of both (one scan,
    one aggregation for all). Output: window_start, window_end,
    entity_type, entity, failed_attempts, first_attempt, last_attempt.
    Only combinable aggregates (count, min, max) are kept, so the state per
    (window, entity) is a few numbers no matter how many accounts one
    address tries; no per-key set is held.
    """
    kinds = (entity,) if isinstance(entity, str) else tuple(entity)
    naive = isinstance(d1.schema["event_time"].dataType, TimestampNTZType)
    # watermarks need TIMESTAMP: use a UTC-read copy of a naive event time (session zone is UTC)
    clock = F.col("event_time").cast("timestamp") if naive else F.col("event_time")
    tagged = [F.struct(F.lit(ENTITIES[k][1]).alias("entity_type"), F.col(ENTITIES[k][0]).alias("entity"))
              for k in kinds]
    pick = tagged[0] if len(tagged) == 1 else F.explode(F.array(*tagged))
    rows = d1.select(pick.alias("t"), "event_time", clock.alias("_clock")) \
        .select("t.*", "event_time", "_clock").filter(F.col("entity").isNotNull())
    if watermark and d1.isStreaming:
        rows = rows.withWatermark("_clock", watermark)
    win = F.window("_clock", window, slide) if slide else F.window("_clock", window)
    grouped = rows.groupBy(win.alias("w"), "entity_type", "entity").agg(
        F.count(F.lit(1)).alias("failed_attempts"),
        F.min("event_time").alias("first_attempt"),
        F.max("event_time").alias("last_attempt"),
    )
    bound_type = "timestamp_ntz" if naive else "timestamp"
    return grouped.filter(F.col("failed_attempts") >= threshold).select(
        F.col("w.start").cast(bound_type).alias("window_start"),
        F.col("w.end").cast(bound_type).alias("window_end"),
        "entity_type", "entity", "failed_attempts", "first_attempt", "last_attempt",
    )
