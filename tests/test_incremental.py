"""Daily states: summaries over several refreshes equal one over everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import auditlens.plans.incremental as I
from auditlens.plans.pipeline import SecurityPipeline
from auditlens.sources import sinks
from auditlens.streaming.detections import read_audit_stream
from audit_rows import AS_OF, SF_SMALL, audit_row, bag
from tools.audit_fixture import audit_table, tags_fixture

LAYERS = ("a3", "a5", "a6", "a7", "a8", "a9", "c2")


def rows_of(frame):
    """Rows with arrays as tuples, so that they compare."""
    return bag(frame.select(sorted(frame.columns)))


def equal_layers(one, other, names=LAYERS):
    for name in names:
        assert rows_of(getattr(one, name)) == rows_of(getattr(other, name)), name


def mixed_rows(seed, n):
    r = random.Random(seed)
    kinds = [dict(status=401), dict(action="setAdmin", params={"targetUserName": "t"}),
             dict(action="changeDatabricksWorkspaceAcl", params={"aclPermissionSet": "x", "targetUserId": None}),
             dict(action="addPrincipalToGroup", params={"targetGroupName": "admins", "targetUserName": "g"}),
             dict(service="unityCatalog", action="updatePermissions", params={
                 "securable_type": "TABLE", "securable_full_name": r.choice(["main.pii.a", "main.hr.t", "x"]),
                 "changes": '[{"principal":"p","add":["MANAGE"]},{"principal":"q","add":["OWNERSHIP"]}]'}),
             dict(action="setSetting", params={"settingKeyName": "k"}), dict(service="filesystem", action="filesGet", params={"path": "/f"}),
             dict(action="other")]
    return [audit_row(t_hours_ago=r.choice([r.uniform(-3, 200), 168.0, 24.0 * r.randrange(9) + 12]), email=r.choice([None, "a", "b"]),
                      run_by=r.choice([None, "svc"]), ip=r.choice([None, "1.1.1.1", "2.2.2.2"]), agent=f"agent/{r.randrange(3)}",
                      **r.choice(kinds)) for _ in range(n)]


@pytest.fixture
def tags(spark):
    """One table with two tags: its rows count twice, as in the view."""
    return spark.createDataFrame([("main", "hr", "t", "pii_x"), ("main", "hr", "t", "pii_y"), ("main", "hr", "u", "public")],
                                 "catalog_name string, schema_name string, table_name string, tag_value string")


def test_batches_in_any_order_equal_one_pass(spark, make_audit, tags, tmp_path):
    rows = mixed_rows(1, 400)
    whole = SecurityPipeline(make_audit(rows), tags, as_of=AS_OF)
    random.Random(1).shuffle(rows)
    store = I.DailyStates(spark, str(tmp_path / "store"))
    for i, batch in enumerate((rows[:250], rows[250:260], [], rows[260:])):
        assert store.add(make_audit(batch), "run", i)
    assert not store.add(make_audit(rows[260:]), "run", 3)  # tried again
    equal_layers(SecurityPipeline(whole.audit, tags, as_of=AS_OF, states=store), whole)
    store.compact()
    assert len(store.content()["states"]) == 1
    for as_of, hours in ((AS_OF.replace(hour=0), 24), (AS_OF - dt.timedelta(days=2, minutes=7), 100.5)):
        again = SecurityPipeline(whole.audit, tags, as_of=as_of, lookback_hours=hours, states=store)
        equal_layers(again, SecurityPipeline(whole.audit, tags, as_of=as_of, lookback_hours=hours), ("a1", "a4", "a7", "a9"))
    assert store.view().latest() == max(r[0] for r in rows)


def test_second_refresh_reads_only_new_files(spark, tmp_path):
    """Over the whole fixture: the second advance gets the new rows alone, and a late row reopens its day."""
    audit, tags = audit_table(spark, SF_SMALL), tags_fixture(spark, SF_SMALL)
    arrival, store = str(tmp_path / "arrival"), I.DailyStates(spark, str(tmp_path / "store"))
    late = F.expr("event_id % 5 = 1")
    read = []
    for rows in (audit.where(~late), audit.where(late)):
        rows.write.mode("append").parquet(arrival)
        query = store.advance(read_audit_stream(spark, arrival, audit.schema), str(tmp_path / "checkpoint"))
        query.awaitTermination()
        read.append(sum(x["numInputRows"] for x in query.recentProgress))
    # each batch is scanned for its detections and for its latest time
    assert read[1] <= 2 * audit.where(late).count() < audit.count()
    equal_layers(SecurityPipeline(audit, tags, states=store), SecurityPipeline(audit, tags), ("a2", "a7"))
    days = store.view().states.groupBy("rule", "day").agg(F.sum("n").alias("n"))
    assert days.agg(F.sum("n")).first()[0] == store.view().detections.count()


def test_look_back_reads_its_own_days(spark, make_audit, tmp_path):
    """States of older days and detections of other days are pruned by partition."""
    store = I.DailyStates(spark, str(tmp_path / "store"))
    store.add(make_audit(mixed_rows(3, 200)), "run", 0)
    window = store.view().window(AS_OF, 30)
    files = {f.rpartition("/day=")[2].partition("/")[0] for f in window.inputFiles()}
    assert "day=" in "".join(window.inputFiles()) and len(files) > 0
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(day") == 2


def test_a_batch_that_fails_changes_nothing(spark, make_audit, tags, tmp_path, monkeypatch):
    rows = mixed_rows(4, 120)
    store = I.DailyStates(spark, str(tmp_path / "store"))
    store.add(make_audit(rows[:60]), "run", 0)
    before = rows_of(store.view().states)
    plain, calls = sinks.write_version, []

    def fails(df, base, *args, **more):
        calls.append(base)
        if len(calls) == 2:
            raise OSError("lost")
        return plain(df, base, *args, **more)

    monkeypatch.setattr(I, "write_version", fails)
    with pytest.raises(OSError, match="lost"):
        store.add(make_audit(rows[60:]), "run", 1)
    assert rows_of(store.view().states) == before
    assert store.add(make_audit(rows[60:]), "run", 1)
    whole = SecurityPipeline(make_audit(rows), tags, as_of=AS_OF)
    equal_layers(SecurityPipeline(whole.audit, tags, as_of=AS_OF, states=store), whole, ("a7", "a9"))


def test_empty_store_and_forgotten_days(spark, make_audit, tmp_path):
    store = I.DailyStates(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="no batch"):
        store.view().states  # noqa: B018
    store.compact()
    store.add(make_audit(mixed_rows(5, 100)), "run", 0)
    held = store.view()
    count = held.states.count()
    store.compact(first_day=AS_OF.date() - dt.timedelta(days=1))
    assert store.view().states.agg(F.min("day")).first()[0] >= AS_OF.date() - dt.timedelta(days=1)
    assert held.states.count() == count  # a reader of the version before keeps it


def test_refresh_publishes_one_version(spark, make_audit, tags, tmp_path, monkeypatch):
    """A refresh that fails half-way leaves the version before, whole; the next one cleans up."""
    import auditlens.plans.pipeline as P
    base, rows = str(tmp_path / "out"), mixed_rows(6, 200)
    audit = make_audit(rows)
    with pytest.raises(ValueError, match="no refresh"):
        SecurityPipeline.open(audit, tags, base)
    frames = ("r_de", "r_aa")
    first = SecurityPipeline(make_audit(rows[:100]), tags, as_of=AS_OF).refresh(base, frames)
    want = {name: rows_of(getattr(first, name)) for name in frames}
    plain = sinks.write_version

    def fails(df, folder, *args, **more):
        if folder.endswith("/r_aa"):
            raise OSError("lost")
        return plain(df, folder, *args, **more)

    for _ in range(2):
        with monkeypatch.context() as m, pytest.raises(OSError, match="lost"):
            m.setattr(P, "write_version", fails)
            SecurityPipeline(audit, tags, as_of=AS_OF).refresh(base, frames)
    opened = SecurityPipeline.open(audit, tags, base)
    assert opened.as_of == AS_OF
    for name, rows_ in want.items():
        assert rows_of(getattr(opened, name)) == rows_, name
    for _ in range(2):
        last = SecurityPipeline(audit, tags, as_of=AS_OF).refresh(base, frames)
    assert rows_of(SecurityPipeline.open(audit, tags, base).r_de) == rows_of(last.r_de)
    assert len([p for p in (tmp_path / "out" / "r_de").iterdir() if p.name.startswith("v")]) == 2
    assert len(sinks.manifests(spark, base)) == 2
