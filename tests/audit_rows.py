"""Rows, names and dates that the tests of the library share."""

import datetime as dt

import __spark_entry__ as entry_point
from auditlens.sources.audit import AUDIT_SCHEMA

#: The registered queries of the library itself (those of the training-data operators have tests of their own).
OWN = {k for k in entry_point.queries() if not k.startswith("op") and k != "pipeline"}
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
AS_OF = dt.datetime(2024, 1, 30, 12, 0, 0)
TEST_SCHEMA = AUDIT_SCHEMA.replace("event_time TIMESTAMP,", "event_time TIMESTAMP_NTZ,")


def audit_row(t_hours_ago=1.0, service="accounts", action="login", status=200, email=None, run_by=None,
              ip=None, agent="agent/0", params=None, workspace=1):
    """One audit row, ``t_hours_ago`` before AS_OF."""
    t = AS_OF - dt.timedelta(hours=t_hours_ago)
    return (t, t.date(), service, action, workspace, agent, ip, (email,), (run_by,),
            (status, None, None), params or {})


def bag(df):
    """Rows of a DataFrame as an order-free comparable list."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
