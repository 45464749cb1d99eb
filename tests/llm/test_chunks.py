"""The exchange between chunks and slots: bounded packages, nothing lost."""

import numpy as np
import pyarrow as pa
import pytest
from auditlens.llm import chunks as exchange
from auditlens.llm.chunks import Chunks, Runs, restored_runs, together, widths

FAN = 4


def chunks_of(spark, n, folder):
    docs = spark.range(0, n, 1, n).selectExpr("id doc_id", "cast(id as string) text")
    return Chunks(docs, folder, 1, fan=FAN)


def all_slots(slots):
    """Every chunk has a record for every slot."""
    return lambda chunk, batch: (np.arange(slots), np.arange(slots, dtype="<u8") + np.uint64(chunk << 8))


@pytest.mark.parametrize(("n", "levels"), [(8, 2), (16, 2), (48, 3)])
def test_packages_of_a_chunk_do_not_grow_with_the_corpus(spark, tmp_path, n, levels):
    chunks = chunks_of(spark, n, str(tmp_path / "run"))
    assert chunks.count == n and len(widths(n, FAN)) == levels
    sent = chunks.sent(n, all_slots(n), ["<u8"])
    rows = sent.collect()
    # chunk by chunk it would be n * n packages
    assert len(rows) <= 2 * FAN * n + FAN * n // 2
    seen = {(s, int(v)) for r in rows for s, v in [(r["dest"], x) for x in restored_runs(pa.py_buffer(bytes(r["body"])), ["<u8"]).fields[0]]}
    want = {(s, s + ((c << 20) << 8)) for s in range(n) for c in range(n)}
    assert seen == want


def test_answers_reach_their_chunk(spark, tmp_path):
    n = 21
    chunks = chunks_of(spark, n, str(tmp_path / "run"))

    def answer(slot, owner, owners, fields):
        by = np.argsort(owner, kind="stable")
        return owner[by], (fields[0][by] + np.uint64(1)).astype("<u8"), np.array([len(owner), owners], "<i8").tobytes()

    answers = chunks.ask("round", n, all_slots(n), ["<u8"], answer, "<u8")
    notes = [np.frombuffer(bytes(r["payload"]), "<i8").tolist() for r in answers.notes().collect()]
    assert notes == [[n, n]] * n

    def told(chunk, batch, slots, found):
        ok = slots.tolist() == list(range(n)) and found.tolist() == [s + 1 + (chunk << 8) for s in range(n)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([ok] * batch.num_rows)], names=[*batch.schema.names, "ok"])

    from pyspark.sql import types as T

    got = chunks.map(told, [T.StructField("ok", T.BooleanType())], answers).collect()
    assert len(got) == n and all(r["ok"] for r in got)


def test_runs_round_trip():
    runs = Runs(np.array([5, 3]), np.array([1, 0]), np.array([2, 1]), (np.array([7, 8, 9], "<u8"), np.array([1, 0, 1], "u1")))
    back = together([pa.py_buffer(runs.stored()), pa.py_buffer(runs.stored())], ["<u8", "u1"])
    assert back.n.tolist() == [2, 1, 2, 1] and back.fields[0].tolist() == [7, 8, 9, 7, 8, 9]
    turned = runs.ordered(np.array([1, 0]))
    assert turned.chunk.tolist() == [3, 5] and turned.fields[0].tolist() == [9, 7, 8] and turned.fields[1].tolist() == [1, 1, 0]
    assert [d for d, _ in turned.divided(np.array([0, 1]))] == [0, 1]
    empty = Runs(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), (np.zeros(0, "<u8"), np.zeros(0, "u1")))
    assert list(restored_runs(pa.py_buffer(empty.stored()), ["<u8", "u1"]).divided(np.zeros(0, int))) == []


def held_by_groups(rows):
    """Records that meet in each group of packages that one task deals on."""
    out = {}
    for r in rows.collect():
        out[r["dest"], r["home"]] = out.get((r["dest"], r["home"]), 0) + int(restored_runs(pa.py_buffer(bytes(r["body"])), ["<u8"]).n.sum())
    return out


@pytest.mark.parametrize("slots", [17, 40, 256])
def test_a_task_deals_about_a_chunk_just_above_the_fan_too(spark, tmp_path, monkeypatch, slots):
    monkeypatch.setattr(exchange, "dealt_on", lambda rows, *_, **__: rows)
    docs = spark.range(0, 96, 1, 96).selectExpr("id doc_id", "cast(id as string) text")
    chunks = Chunks(docs, str(tmp_path / "run"), 1, fan=16)
    held = held_by_groups(chunks.sent(slots, all_slots(slots), ["<u8"]))
    assert sum(held.values()) == 96 * slots
    assert max(held.values()) <= 4 * slots  # 16 chunks' records for 17 slots met in one task when a range held 16 of them


def test_a_task_deals_the_answers_of_about_a_slot(spark, tmp_path, monkeypatch):
    docs = spark.range(0, 20, 1, 20).selectExpr("id doc_id", "cast(id as string) text")
    chunks = Chunks(docs, str(tmp_path / "run"), 1, fan=16)
    given = []
    dealt_on = exchange.dealt_on

    def seen(rows, levels, types, *more, by_chunk):
        if by_chunk:
            given.append(rows)
        return dealt_on(rows, levels, types, *more, by_chunk=by_chunk)

    monkeypatch.setattr(exchange, "dealt_on", seen)
    chunks.ask("round", 64, all_slots(64), ["<u8"], lambda slot, owner, owners, fields: (np.sort(owner), fields[0], None), "<u8")
    held = held_by_groups(given[0])
    assert sum(held.values()) == 20 * 64
    assert max(held.values()) <= 2 * 20


@pytest.mark.parametrize("fan", [2, 5, 256])
def test_levels_have_equally_many_ranges(fan):
    for places in (1, 2, fan, fan + 1, 720, fan * fan, fan * fan + 1):
        levels = widths(places, fan)
        steps = {a // b for a, b in zip(levels, levels[1:])}
        assert levels[-1] == 1 and len(steps) <= 1
        assert all(1 < n <= fan for n in steps) and -(-places // levels[0]) <= max(steps or {fan})
        assert len(levels) == 1 or fan ** (len(levels) - 1) < places
