"""Remembered assessments, and tags that change over time."""

import datetime as dt

from pyspark.sql import functions as F

from auditlens.functions import scoring as S
from auditlens.operators import assess as R
from auditlens.operators import detections as D
from auditlens.operators.memory import AssessmentMemory
from auditlens.plans.incremental import DailyStates
from auditlens.plans.pipeline import SecurityPipeline
from auditlens.streaming.detections import read_audit_stream, start_uc_escalations
from audit_rows import AS_OF, SF_SMALL, audit_row, bag
from tools.audit_fixture import audit_table, tags_fixture


def counting(spark, sent, level="HIGH"):
    def score(prompts, family):
        sent.add(len(prompts))
        return prompts.map(lambda p: None if '"actor":"silent"' in p else f'{{"risk_level":"{level}","risk_factors":["{len(p)}"]}}')
    return S.pandas_scorer(score)


def activity(spark, rows):
    return spark.createDataFrame(rows, "service_name string, workspace_id long, actor string, target_user string, action_name string, "
                                 "admin_assignments_count long, unique_targets long, first_activity timestamp_ntz, last_activity timestamp_ntz")


def group(actor, n, workspace=1):
    return ("accounts", workspace, actor, "t", "setAdmin", n, 1, AS_OF, AS_OF)


def test_only_unseen_prompts_are_sent(spark, tmp_path):
    sent = spark.sparkContext.accumulator(0)
    scorer, memory = counting(spark, sent), AssessmentMemory(spark, str(tmp_path / "m"), most_parts=2)

    def run(rows, memory=memory):
        frame = activity(spark, rows)
        before = sent.value
        got = bag(R.assess(frame, R.ACCOUNT_ADMIN, scorer, memory=memory))
        asked = sent.value - before
        assert got == bag(R.assess(frame, R.ACCOUNT_ADMIN, counting(spark, spark.sparkContext.accumulator(0))))
        return asked

    first = [group("a", 1), group("b", 2), group("a", 1, workspace=2), group(None, 3)]
    assert run(first) == 2  # two groups share a prompt, a null prompt is not sent
    assert run(first) == 0
    assert run([*first, group("b", 4), group("silent", 1)]) == 2
    assert run([*first, group("silent", 1)]) == 1  # no answer: asked again
    assert run(first) == 0
    assert run(first, AssessmentMemory(spark, str(tmp_path / "m"), version="2")) == 2
    assert memory.answers().groupBy("version", "family", "prompt").count().where("count > 1").count() == 0


def test_refresh_with_a_memory_sends_what_changed(spark, tmp_path):
    audit, tags = audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL)
    sent = spark.sparkContext.accumulator(0)
    memory = AssessmentMemory(spark, str(tmp_path / "m"))
    first = SecurityPipeline(audit, tags, scorer=counting(spark, sent), memory=memory)
    frames = ("r_de", "r_sg")
    first.refresh(frames=frames)
    want = {n: bag(getattr(first, n)) for n in frames}
    prompts = sent.value
    again = SecurityPipeline(audit, tags, scorer=counting(spark, sent), memory=memory).refresh(frames=frames)
    assert {n: bag(getattr(again, n)) for n in frames} == want
    assert sent.value == prompts > 0


UC = {"securable_type": "TABLE", "changes": '[{"principal":"p","add":["MANAGE"]}]'}


def grant(hours, name):
    return audit_row(t_hours_ago=hours, service="unityCatalog", action="updatePermissions", params=UC | {"securable_full_name": name})


TAGS = "catalog_name string, schema_name string, table_name string, tag_value string"


def test_tags_hold_as_of_the_event(spark, make_audit, tmp_path):
    rows = [grant(h, n) for h in (50, 30, 10, 1) for n in ("m.s.a", "m.s.b", "m.s.c", "m.pii.x")]
    at = [AS_OF - dt.timedelta(hours=h) for h in (40, 30, 5)]
    tags = spark.createDataFrame([
        ("m", "s", "a", "pii", at[0], None), ("m", "s", "b", "pii", None, at[1]), ("m", "s", "c", "public", None, None),
        ("m", "s", "b", "pii2", at[2], None), ("m", "s", "b", "pii3", at[2], None)], TAGS + ", valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = D.uc_permission_escalations(make_audit(rows), tags)
    by = {(r["securable_full_name"], r["hours"]): r["count"] for r in got.groupBy(
        "securable_full_name", F.timestamp_diff("HOUR", F.col("event_time"), F.lit(AS_OF)).alias("hours")).count().collect()}
    # from 40 hours ago on; until before 30 hours ago, and twice from 5 hours ago on; always by name
    assert by == {("m.s.a", 30): 1, ("m.s.a", 10): 1, ("m.s.a", 1): 1, ("m.s.b", 50): 1, ("m.s.b", 1): 2,
                  ("m.pii.x", 50): 1, ("m.pii.x", 30): 1, ("m.pii.x", 10): 1, ("m.pii.x", 1): 1}
    whole = SecurityPipeline(make_audit(rows), tags, as_of=AS_OF)
    assert bag(whole.w("d6")) == bag(got.select(whole.w("d6").columns))
    store = DailyStates(spark, str(tmp_path / "store"))
    store.add(make_audit(rows), "run", 0)
    assert bag(SecurityPipeline(whole.audit, tags, as_of=AS_OF, states=store).a7) == bag(whole.a7)


def test_a_tag_added_between_two_batches_counts_from_then_on(spark, make_audit, tmp_path):
    arrival, tags, out = str(tmp_path / "arrival"), str(tmp_path / "tags"), str(tmp_path / "out")
    spark.createDataFrame([("m", "s", "a", "pii")], TAGS).write.parquet(tags)
    seen = []
    for hours, new in ((9, None), (8, "b"), (7, None)):
        if new:
            spark.createDataFrame([("m", "s", new, "pii")], TAGS).write.mode("append").parquet(tags)
        make_audit([grant(hours, "m.s.a"), grant(hours, "m.s.b")]).coalesce(1).write.mode("append").parquet(arrival)
        stream = read_audit_stream(spark, arrival, make_audit([]).schema)
        start_uc_escalations(stream, lambda s: s.read.parquet(tags), str(tmp_path / "ck"), out).awaitTermination()
        seen.append(sorted(r["securable_full_name"] for r in spark.read.parquet(out).collect()))
    assert seen == [["m.s.a"], ["m.s.a"] * 2 + ["m.s.b"], ["m.s.a"] * 3 + ["m.s.b"] * 2]
