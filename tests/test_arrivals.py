"""The audit log as it arrives: every core writes, and an arrival is one micro-batch however many files it has."""

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from audit_rows import bag
from auditlens.operators import detections as D
from auditlens.sources.sinks import snapshot_root
from auditlens.streaming.detections import read_audit_stream, start_append
from auditlens.streaming.thresholds import login_threshold
from tools.audit_fixture import ARRIVAL, ARRIVALS, audit_from_events


def _events(folder, gap: bool) -> str:
    """Half of the logins fail; with ``gap`` nothing happens or comes late between the first and the last days."""
    rows = []
    for i in range(4000):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=30) * (i / 4000)
        if gap and (5 < ts.day < 26 or i % 23 == 7 or i % 11 == 5):
            continue
        rows.append({"event_id": i, "ts": ts, "user_id": i % 40, "event_type": "error" if i % 2 else "click", "value": 1.0,
                     "props": f'{{"k": {i % 100}}}'})
    rows += [rows[5], {**rows[7], "ts": None}, {**rows[9], "event_id": None}]
    schema = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()),
                        ("value", pa.float64()), ("props", pa.string())])
    pq.write_table(pa.Table.from_pylist(rows, schema), folder / "events.parquet")
    return str(folder)


def test_every_core_writes_an_arrival(spark, tmp_path):
    sf, folder, seen = _events(tmp_path, False), tmp_path / "arrival", 0
    for _ in E._arrivals(spark, sf, str(folder)):
        files = len(list(folder.glob("*.parquet")))
        assert files - seen == spark.sparkContext.defaultParallelism
        seen = files
    whole = audit_from_events(spark.read.parquet(f"{sf}/events.parquet"))
    assert bag(spark.read.parquet(str(folder))) == bag(whole)


@pytest.mark.parametrize("gap", [False, True])
def test_st2_takes_an_arrival_of_many_files_as_one_micro_batch(spark, tmp_path, gap):
    sf = _events(tmp_path, gap)
    # one file for each arrival, one file for each micro-batch
    audit = audit_from_events(spark.read.parquet(f"{sf}/events.parquet"))
    for i in range(ARRIVALS):
        arrived = audit.where(F.expr(ARRIVAL.format(day="extract(DAY FROM event_time)")) == i)
        arrived.coalesce(1).write.mode("append").parquet(f"{sf}/single")
    stream = read_audit_stream(spark, f"{sf}/single", audit.schema, max_files_per_trigger=1)
    windows = login_threshold(D.auth_events(stream), ("source_ip", "user"), "72 hours", 3, "24 hours")
    start_append(windows, f"{sf}/checkpoint", path=f"{sf}/windows", trigger={"availableNow": True}).awaitTermination()
    expected = bag(spark.read.schema(windows.schema).parquet(f"{sf}/windows"))

    root = Path(snapshot_root(spark).removeprefix("file:"))
    before = set(root.glob("st2-*"))
    assert expected and bag(E._login_windows_stream(spark, sf)) == expected
    (run,) = set(root.glob("st2-*")) - before
    done = {p.name for p in (run / "checkpoint" / "commits").iterdir() if p.name.isdigit()}
    assert done == {p.name for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()}
    assert len(list((run / "arrival").glob("*.parquet"))) > ARRIVALS
