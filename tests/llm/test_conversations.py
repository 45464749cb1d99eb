"""Operator 11 against a plain search over edit scripts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from auditlens.llm import conversations as C
from auditlens.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = "[^\x20\x09-\x0D]"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()))


def cheapest(rows):
    """(cost, audit) and repaired rows of the best script, forward over (rows done, state)."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        signs = re.findall(BLANKS, text)
        faults.append("blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else "")
        seen.add((role, text))
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                new = "a" if state == "u" else "u"
                offer = (cost + 2, audit + "I", [*out, ({"u": "user", "a": "assistant"}[new], "")])
                if new not in best or offer[:2] < best[new][:2]:
                    best[new] = offer
        return best

    best = inserted({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, out) in best.items():
            offers = [(state, (cost + 3, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                cut = int(fault == "truncated")
                new = moves.get((state, role[:1]))
                if new:
                    offers.append((new, (cost + cut, audit + "K", [*out, (role, text)])))
                for to, name in (("u", "user"), ("a", "assistant")):
                    if (state, to) in moves:
                        offers.append((to, (cost + 2 + cut, audit + "R", [*out, (name, text)])))
            for new, offer in offers:
                if new not in after or offer[:2] < after[new][:2]:
                    after[new] = offer
        best = inserted(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2]), faults


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = in_order(damage([r for r in rows if r[0] == conv]))
        (cost, audit, kept), faults = cheapest(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine[:-1], mine[1:], strict=True)]
        body = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(body.encode()).hexdigest())
    return out


def found(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = [tuple(r) for r in df.select(*names).collect()]
    out = {r[0]: r for r in rows}
    assert len(out) == len(rows)
    return out


def conversation(r, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, " ", "User"]
    texts = ["Yes.", "No!", "why", "", "  ", None, "a b c.", "wait?\n", "cut off", "日本。", "x. \x0b", "\xa0"]
    return [(conv, r.choice([i, i, i, None, i - 1]), r.choice(roles[:4] if r.random() < 0.7 else roles), r.choice(texts) if r.random() < 0.5 else f"t{i}.") for i in range(n)]


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(C, "PIECE_ROWS", 3)


def test_equals_a_plain_search(spark):
    r = random.Random(11)
    rows = [x for c in range(300) for x in conversation(r, c if c else None, r.randrange(1, 12))]
    r.shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(C.report(C.repair(C.damaged(table)))) == expected(rows)


@pytest.mark.parametrize("fixups", [0, 1, 3])
def test_long_conversations_in_pieces(spark, monkeypatch, fixups):
    """Pieces of seven rows: guessed vectors, fix-up passes and, without enough of them, unit vectors."""
    monkeypatch.setattr(C, "PIECE_ROWS", 7)
    r = random.Random(fixups)
    rows = [(c, i, *x[2:]) for c in (1, 2, 3) for i, x in enumerate(conversation(r, c, 60 * c))]
    rows += [(4, i, "user", f"only user {i}.") for i in range(90)] + [(5, i, "system", f"only system {i}.") for i in range(91)]
    rows += [(6, i % 3, "user", "the same row.") for i in range(200)] + [(7, None, "assistant", f"no turn {i}") for i in range(50)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(C.report(C.repair(C.damaged(table), fixups=fixups))) == expected(rows)


def test_a_run_of_one_role_never_converges_and_is_right(spark, monkeypatch):
    """Two phases stay apart: fix-up passes alone would take one pass for each piece."""
    monkeypatch.setattr(C, "PIECE_ROWS", 10)
    passes = []
    plain = C.written
    monkeypatch.setattr(C, "written", lambda df, path: passes.append(path.rsplit("/", 1)[-1]) or plain(df, path))
    rows = [(1, i, "user", f"u{i}.") for i in range(400)]
    got = found(C.report(C.repair(spark.createDataFrame(rows, SCHEMA))))
    (cost, audit, _), _ = cheapest(rows)
    assert got[1][6:8] == (cost, audit)
    assert "pass-exact" in passes and f"pass-{C.FIXUPS + 1}" not in passes


def test_vectors_that_differ_by_a_constant_end_a_run():
    codes, copies = bytes([1, 2] * 50), np.ones(100, "<i4")
    right = C.backward(codes, copies, C.FINAL)
    again = C.backward(codes, copies, C.FINAL, C.backward(codes, copies, C.GUESS))
    assert (again == right).all()
    assert (C.loaded(C.saved(right)) == right).all()


def test_lost_rows_extra_columns_and_empty_tables(spark):
    rows = [(1, 0, "user", "a."), (2, 5, "user", "b."), (2, 6, "assistant", "c.")]
    table = spark.createDataFrame([(*r, "x", r[0] != 1, 7) for r in rows], SCHEMA + ", key string, present boolean, cost int")
    got = found(C.report(C.repair(table)))
    assert got[1] == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2][6:8] == (0, "KK")
    assert C.report(C.repair(spark.createDataFrame([], SCHEMA))).count() == 0


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "long " * 400_000 + "."), (1, 1, "assistant", "y" * 3_000_000 + " \n"), (1, 2, "user", "z.")]
    got = found(C.report(C.repair(spark.createDataFrame(rows, SCHEMA))))
    (cost, audit, kept), _ = cheapest(rows)
    assert got[1][6:] == (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def test_query_against_a_plain_search(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_conversations"](spark, d)) == expected(rows)
