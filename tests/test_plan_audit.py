"""Every registered query: no cross product, no nested-loop join, no Python on the default path."""

import io
import contextlib

import pytest

import __spark_entry__ as E
from audit_rows import OWN, SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _explain(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(OWN))
def test_plan_has_no_product_and_no_python(spark, name):
    text = _explain(E.queries()[name](spark, SF_SMALL))
    found = [op for op in FORBIDDEN if op in text]
    assert not found, f"{name}: {found}"
