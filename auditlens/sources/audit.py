"""The audit-log source and the evaluation clock (``as_of``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from auditlens.functions.exprs import parse_as_of

AUDIT_SCHEMA = (
    "event_time TIMESTAMP, event_date DATE, service_name STRING, action_name STRING, "
    "workspace_id BIGINT, user_agent STRING, source_ip_address STRING, "
    "user_identity STRUCT<email: STRING>, identity_metadata STRUCT<run_by: STRING>, "
    "response STRUCT<status_code: INT, error_message: STRING, result: STRING>, "
    "request_params MAP<STRING, STRING>"
)

AUDIT_COLUMNS = [
    "event_time", "event_date", "service_name", "action_name", "workspace_id", "user_agent",
    "source_ip_address", "user_identity", "identity_metadata", "response", "request_params",
]


def audit(source, spark: SparkSession | None = None, fmt: str = "parquet") -> DataFrame:
    """Open the audit log.

    ``source`` is a DataFrame (returned as is), a path (it holds a ``/``, a
    backslash or a ``:``, or ends in ``.<fmt>``) read with ``fmt``, or a table
    name with or without a dot. Nothing is read here: filters and column
    lists of the operators reach the scan through Catalyst.
    """
    if isinstance(source, DataFrame):
        return source
    if spark is None:
        spark = SparkSession.getActiveSession()
    text = str(source)
    if any(c in text for c in "/\\:") or text.endswith(f".{fmt}"):
        return spark.read.format(fmt).load(text)
    return spark.table(text)


def missing_columns(df: DataFrame) -> list[str]:
    """Audit columns an operator may read that the source lacks."""
    present = set(df.columns)
    return [c for c in AUDIT_COLUMNS if c not in present]


def resolve_as_of(df: DataFrame, as_of=None, column: str = "event_time") -> dt.datetime:
    """The evaluation instant (UTC wall time).

    An explicit value wins (a scheduled job passes its run time). Otherwise
    the latest ``column`` value of the whole log is taken with a global
    aggregate over that one column: a scalar comes back to the driver and
    becomes a literal that Catalyst pushes into every later scan.
    """
    if as_of is not None:
        return parse_as_of(as_of)
    if isinstance(df.schema[column].dataType, TimestampType):
        micros = df.agg(F.unix_micros(F.max(column)).alias("t")).first()["t"]
        if micros is not None:
            return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    else:
        text = df.agg(F.max(column).cast("string").alias("t")).first()["t"]
        if text is not None:
            return parse_as_of(text)
    raise ValueError("cannot derive as_of from an empty audit log")
