"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
that it stays inside whole-stage codegen and can be pushed into scans.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def actor() -> Column:
    """The acting principal: e-mail of the user, else the job's run-as name."""
    return F.coalesce(F.col("user_identity.email"), F.col("identity_metadata.run_by"))


def param(key: str) -> Column:
    """A ``request_params`` value; a missing key gives NULL."""
    return F.col("request_params").getItem(key)


def status_code() -> Column:
    return F.col("response.status_code")


def parse_as_of(value) -> dt.datetime:
    """Normalise an ``as_of`` argument (datetime or ISO text) to a naive UTC datetime."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value).strip())


def ts_literal(value, like=None) -> Column:
    """A constant timestamp column of the type of the column it is compared with.

    The moment is UTC wall time. For ``timestamp_ntz`` it is taken as such;
    for ``timestamp`` (an instant) it is built from the epoch, so neither the
    session's nor the driver's time zone changes which rows a look-back keeps.
    Catalyst folds either form and pushes the comparison into the scan.
    """
    moment = parse_as_of(value)
    if like is None or isinstance(like, TimestampNTZType):
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    micros = (moment.replace(tzinfo=dt.timezone.utc) - _EPOCH) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def time_type(df: DataFrame, column: str = "event_time"):
    return df.schema[column].dataType


class DatePartition(NamedTuple):
    """What a caller declares of the source's date column: rows are at most ``max_skew_days`` away from their time."""

    column: str = "event_date"
    max_skew_days: int = 1


def since(df: DataFrame, as_of, hours: float | None, column: str = "event_time",
          contract: DatePartition | None = None) -> DataFrame:
    """Keep rows with ``column >= as_of - hours`` (no upper bound, as in a look-back).

    ``hours=None`` keeps everything (used for streams and unbounded views).
    Only with a declared ``contract`` the date column is tested as well, so
    that whole partitions are skipped: without it, a row whose date is
    missing or lags its time counts like any other.
    """
    if hours is None:
        return df
    lower = parse_as_of(as_of) - dt.timedelta(hours=hours)
    cond = F.col(column) >= ts_literal(lower, time_type(df, column))
    if contract is not None:
        first_day = (lower - dt.timedelta(days=contract.max_skew_days)).date().isoformat()
        day = F.col(contract.column)
        cond = cond & ((day >= F.lit(first_day).cast("date")) | day.isNull())
    return df.filter(cond)


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours from ``start`` to ``end`` (truncated, like TIMESTAMPDIFF(HOUR))."""
    return F.timestamp_diff("HOUR", start, end)


def joined_set(values: Column, sep: str = ",") -> Column:
    """Stable text form of a set-valued array: sorted, joined."""
    return F.array_join(F.sort_array(values), sep)


def json_field(doc: str | Column, field: str) -> Column:
    """Extract one top-level field of a JSON text column (arrays as compact JSON text)."""
    column = F.col(doc) if isinstance(doc, str) else doc
    return F.get_json_object(column, f"$.{field}")
