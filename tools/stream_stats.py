"""Replay `events` of a scale directory as one file per day through ST1 (D2) and ST2.

Prints micro-batch latency (median / max trigger ms) and ST2 state size
(rows, bytes) from Spark's streaming progress. Usage:
    python tools/stream_stats.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pyarrow.compute as pc  # noqa: E402
import pyarrow.parquet as pq  # noqa: E402

from auditlens.operators import detections as D  # noqa: E402
from auditlens.session import local_session  # noqa: E402
from tools.audit_fixture import audit_from_events  # noqa: E402
from auditlens.streaming.thresholds import login_threshold  # noqa: E402

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def split_by_day(sf_dir: str, folder: Path) -> int:
    table = pq.read_table(f"{sf_dir}/events.parquet").sort_by("ts")
    days = pc.cast(pc.floor(pc.divide(pc.cast(pc.cast(table["ts"], "int64"), "double"), 86400e6)), "int64")
    for i, day in enumerate(sorted(set(days.to_pylist()))):
        path = folder / f"part-{i:03d}.parquet"
        pq.write_table(table.filter(pc.equal(days, day)), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return i + 1


def run(spark, df, name, checkpoint):
    q = (df.writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(900)
    progress = [p for p in q.recentProgress if p.get("numInputRows", 0) > 0]
    trig = [p["durationMs"].get("triggerExecution", 0) for p in progress]
    state = [op for p in progress for op in p.get("stateOperators", [])]
    out = {"batches": len(progress), "median_trigger_ms": statistics.median(trig) if trig else None,
           "max_trigger_ms": max(trig) if trig else None, "rows_out": spark.table(name).count()}
    if state:
        out["state_rows_max"] = max(s["numRowsTotal"] for s in state)
        out["state_bytes_max"] = max(s["memoryUsedBytes"] for s in state)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    work = Path(tempfile.mkdtemp(prefix="auditlens-stream-"))
    files = work / "events"
    files.mkdir()
    n = split_by_day(sf_dir, files)
    spark = local_session(8)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(files))
    audit = audit_from_events(stream)
    st1 = run(spark, D.account_admin_assignments(audit), "st1_d2", str(work / "ck1"))
    st2 = run(spark, login_threshold(D.auth_events(audit), "source_ip", "24 hours", 5, "1 hour"),
              "st2_ip", str(work / "ck2"))
    print(json.dumps({"sf_dir": sf_dir, "files": n, "st1_d2": st1, "st2_source_ip": st2}))


if __name__ == "__main__":
    main()
