"""ST1 / ST2: replaying the fixture as a file stream gives the batch results."""

import datetime as dt
import os

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from auditlens.operators import detections as D
from tools.audit_fixture import audit_from_events, tags_fixture
from auditlens.streaming.detections import stream_detections
from auditlens.streaming.thresholds import login_threshold
from audit_rows import SF_MID, bag

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@pytest.fixture(scope="module")
def event_files(tmp_path_factory):
    """The sf0.01 events split by day into 30 files, modification times in time order."""
    folder = tmp_path_factory.mktemp("events_stream")
    table = pq.read_table(f"{SF_MID}/events.parquet").sort_by("ts")
    days = pc.cast(pc.floor(pc.divide(pc.cast(pc.cast(table["ts"], "int64"), "double"), 86400e6)), "int64")
    base = 1_700_000_000
    for i, day in enumerate(sorted(set(days.to_pylist()))):
        part = table.filter(pc.equal(days, day))
        path = folder / f"part-{i:03d}.parquet"
        pq.write_table(part, path)
        os.utime(path, (base + i, base + i))
    return folder


def _run(spark, df, name, checkpoint):
    q = (df.writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name)


def test_st1_stream_equals_batch(spark, event_files, tmp_path):
    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 3).parquet(str(event_files))
    batch_audit = audit_from_events(spark.read.parquet(f"{SF_MID}/events.parquet"))
    tags = tags_fixture(spark, SF_MID)
    frames = stream_detections(audit_from_events(stream), tags)
    for key, batch in (("d2", D.account_admin_assignments(batch_audit)),
                       ("d6", D.uc_permission_escalations(batch_audit, tags)),
                       ("d8", D.data_export_detection(batch_audit, hours=None))):
        got = _run(spark, frames[key], f"st1_{key}", tmp_path / key)
        assert bag(got) == bag(batch), key


def test_st2_windows_equal_batch_and_late_rows_are_dropped(spark, event_files, tmp_path):
    events = spark.read.parquet(f"{SF_MID}/events.parquet")
    batch = login_threshold(D.auth_events(audit_from_events(events)), "source_ip", "24 hours", 5)
    last = events.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(str(last - dt.timedelta(hours=1))).cast("timestamp_ntz"))

    # one late file: a failed login three weeks before the end, after the watermark passed it
    late_dir = tmp_path / "with_late"
    late_dir.mkdir()
    for i, f in enumerate(sorted(os.listdir(event_files))):
        os.link(event_files / f, late_dir / f)
    first_fail = events.filter("event_type = 'error' AND ((event_id*7+user_id)%20) <= 5").orderBy("ts").first()
    import pyarrow as pa
    late = pa.table({"event_id": [first_fail.event_id], "ts": pa.array([first_fail.ts], pa.timestamp("us")),
                     "user_id": [first_fail.user_id], "event_type": ["error"], "value": [0.0],
                     "props": [first_fail.props]})
    pq.write_table(late, late_dir / "part-999.parquet")
    os.utime(late_dir / "part-999.parquet", (1_800_000_000, 1_800_000_000))

    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(late_dir))
    st = login_threshold(D.auth_events(audit_from_events(stream)), "source_ip", "24 hours", 5, "1 hour")
    got = _run(spark, st, "st2_ip", tmp_path / "ck")
    assert got.count() > 0
    assert bag(got) == bag(closed)          # the duplicate of an old row did not change any window


def test_stream_kept_detections_table_feeds_the_job(spark, event_files, tmp_path):
    from auditlens.plans.pipeline import SecurityPipeline
    from auditlens.streaming.detections import start_append, stream_candidates

    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 5).parquet(str(event_files))
    table = str(tmp_path / "detections")
    q = start_append(stream_candidates(audit_from_events(stream)), str(tmp_path / "ck_det"), "parquet",
                     path=table, trigger={"availableNow": True}, partition_by=["rule", "event_date"])
    q.awaitTermination(600)

    audit = audit_from_events(spark.read.parquet(f"{SF_MID}/events.parquet"))
    tags = tags_fixture(spark, SF_MID)
    batch = SecurityPipeline(audit, tags)
    fed = SecurityPipeline(audit, tags, as_of=batch.as_of, detections=spark.read.parquet(table))
    for name in ("a3", "a7", "a9", "c1", "c2"):
        assert bag(getattr(fed, name)) == bag(getattr(batch, name)), name
    assert bag(fed.l6()) == bag(batch.l6())
    assert bag(fed.q9()) == bag(batch.q9())

    from auditlens.sources.sinks import latest_snapshot
    from auditlens.streaming.detections import compact
    compact(spark, table, str(tmp_path / "compacted"))
    small = latest_snapshot(spark, str(tmp_path / "compacted"))
    assert bag(small.select("rule", "event_time", "actor")) == bag(spark.read.parquet(table).select("rule", "event_time", "actor"))
    assert len(small.inputFiles()) < len(spark.read.parquet(table).inputFiles())


def test_st2_both_entities_in_one_pass_equals_separate(spark):
    d1 = D.auth_events(audit_from_events(spark.read.parquet(f"{SF_MID}/events.parquet")))
    both = login_threshold(d1, ("source_ip", "user"))
    separate = login_threshold(d1, "source_ip").unionByName(login_threshold(d1, "user"))
    assert bag(both) == bag(separate)


def test_streaming_job_cli_keeps_the_detections_table(spark, tmp_path):
    from auditlens.plans import shared_scan as SS
    from tools.audit_fixture import audit_table
    from auditlens.streaming import detections as ST

    audit = audit_table(spark, "/root/testdata/sf0.001")
    source = audit.inputFiles()[0].split("/event_date=")[0].replace("file://", "")
    out = str(tmp_path / "detections")
    ST.main(["--audit", source, "--schema-from", source, "--out", out,
             "--checkpoint", str(tmp_path / "ck"), "--available-now"])
    kept = spark.read.parquet(out)
    expected = SS.detection_candidates(audit, hours=None)
    assert bag(kept.select(*expected.columns)) == bag(expected)
