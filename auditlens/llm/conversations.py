"""Repair of the order of roles in conversations, by Viterbi runs in parallel (operator 11).

The rows of a conversation are kept, given another role or deleted, and empty
ones inserted, at the least cost that leaves roles ``(s?(ua)+)?``. That is a
shortest path over four states (nothing yet, after s, after u, after a), and
a backward cost vector (the cheapest way to the end from each state) per row.

Rows are sorted by conversation and turn over range partitions and cut into
pieces of bounded size, so that a conversation may be as long as it likes.
Most conversations are one piece and are done in one go. The pieces of a long
one run side by side: each but the last begins with a guessed cost vector at
its end. Fix-up passes then run those pieces again whose successor came out
with another vector than was guessed, but only as far back as the new vectors
differ from the old ones by more than a constant; costs that differ by a
constant choose the same edits. Mostly one pass is enough. Where two phases
of a repeated pattern never meet (a long run of one role), passes would go on
piece by piece; after ``FIXUPS`` of them the pieces of such a conversation are
run from the four unit vectors, which tell the result for any vector, these
are put together along the conversation, and each piece is run once more.

The stitched vectors then lead the way forward: at each row the first edit in
ASCII order that is on a cheapest path. A piece is traced from all four
states, the states are chained, and the piece's own trace is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.shared import nullable, run_folder, slots, tidy, written

PIECE_ROWS, PIECE_BYTES = 1 << 16, 4 << 20  # rows, bytes of text
FIXUPS = 3  # passes that start from the successor's vector
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after an inserted or re-roled row, from each state: user after nothing, s and a, assistant after u.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: The state after a kept row, by class of its role (s, u, a, any other) and state; -1: not allowed.
KEEP = ((AFTER_S, -1, -1, -1), (AFTER_U, AFTER_U, -1, AFTER_U), (-1, -1, AFTER_A, -1), (-1, -1, -1, -1))
GIVEN = {AFTER_U: "user", AFTER_A: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1  # costs
FORCED, TRUNCATED = 4, 8  # codes of rows: class of the role, or FORCED; and TRUNCATED
FINAL = (0, 4, 2, 0)  # cost to an allowed end from each state by insertions alone
GUESS = (0, 0, 0, 0)
FAR = 1 << 40
_SPACE = " \t\n\v\f\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after damage, with ``present`` (false: the row is lost, only its conv_id counts).

    By crc32 of ``conv_id:turn`` modulo 20: 0 loses the row, 1 empties the text, 2 takes its ``[.!?]`` away, 3 repeats
    the row, 4 makes its role user. Null roles and texts are one blank, also within the checksum's text.
    """
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fate = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (fate != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("_")).drop("_")


def judged(rows: DataFrame) -> DataFrame:
    """Equal rows once, with ``copies`` and ``fault``: -1 lost, 0 none, 1 blank, 2 duplicate, 3 truncated.

    Of equal rows the first alone is not a duplicate: ``fault`` is its fault, the copies behind it are duplicates.
    """
    there = F.coalesce(F.col("present"), F.lit(False)) if "present" in rows.columns else F.lit(True)
    rows = rows.withColumn("present", there)
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    one = rows.select("conv_id", *(F.when(there, c).alias(n) for n, c in (("turn", F.col("turn").cast("long")), ("role", role), ("text", text))),
                      "present").groupBy("conv_id", "turn", "role", "text", "present").agg(F.count("*").cast("int").alias("copies"))
    body = F.rtrim(F.col("text"), F.lit(_SPACE))
    one = one.withColumns({"key": F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")), "blank": body == ""})
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))  # null turns come first
    firsts = one.where("present AND NOT blank").groupBy("conv_id", "key").agg(F.min(turn).alias("first")).select(
        F.col("conv_id").alias("_conv"), F.col("key").alias("_key"), F.col("first.turn").alias("_turn"))
    whole = one.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key")), "left")
    fault = (F.when(~F.col("present"), -1).when(F.col("blank"), 1).when(~F.col("turn").eqNullSafe(F.col("_turn")), 2)
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), 3).otherwise(0))
    return whole.select("conv_id", "turn", "role", "text", "key", "copies", fault.alias("fault"))


class Piece:
    """Rows of one conversation, in order, as they are packed."""

    def __init__(self, conv):
        self.conv, self.codes, self.copies, self.roles, self.texts = conv, [], [], [], []
        self.bytes = self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.least = self.most = None

    def add(self, turn, role: str, text: str, copies: int, fault: int) -> None:
        if fault < 0:
            return
        kind = ("sua".find(role[0]) if role else -1) % 4
        if self.last is not None and (self.last, kind) not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1
        self.first, self.last = kind if self.first is None else self.first, kind
        if turn is not None and turn != self.most:
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        self.n += copies
        if fault in (1, 2):
            self.codes.append(FORCED)
            self.blank, self.duplicate = self.blank + copies * (fault == 1), self.duplicate + copies * (fault == 2)
        else:
            self.codes.append(kind | TRUNCATED * (fault == 3))
            self.duplicate, self.truncated = self.duplicate + copies - 1, self.truncated + (fault == 3)
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(role) + len(text)
        self.copies.append(copies)

    def full(self) -> bool:
        return len(self.codes) >= PIECE_ROWS or self.bytes >= PIECE_BYTES

    def row(self, part: int, seq: int, chained: bool) -> dict:
        return {"conv_id": self.conv, "part": part, "seq": seq, "chained": chained, "codes": bytes(self.codes),
                "copies": np.array(self.copies, "<i4").tobytes(), "roles": self.roles, "texts": self.texts,
                "stats": {k: getattr(self, k) for k in STATS}}


STATS = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "first", "last", "least", "most")
_STATS = "struct<" + ", ".join(f"{k}: long" for k in STATS) + ">"


def backward(codes: bytes, copies: np.ndarray, end: tuple, known: np.ndarray | None = None) -> np.ndarray:
    """Cost vectors before each row and, last, at the end (``end``).

    ``known``: vectors of an earlier run; as soon as the new ones differ from them by a constant only, the rest is shifted.
    """
    n = len(codes)
    out = np.empty((n + 1, 4), np.int64)
    out[n] = v = tuple(int(x) for x in end)
    counts = copies.tolist()
    for i in range(n - 1, -1, -1):
        code, k = codes[i], counts[i]
        if code == FORCED:
            v = tuple(x + DELETE * k for x in v)
        else:
            cut, keep = CUT_OFF * (code >= TRUNCATED), KEEP[code & 3]
            more = DELETE * (k - 1)
            a, b, c, d = (min(DELETE + v[s], REROLE + cut + v[NEXT[s]], cut + v[keep[s]] if keep[s] >= 0 else FAR) + more for s in range(4))
            c, d = min(c, INSERT + d), min(d, INSERT + c)
            v = (min(a, INSERT + c), min(b, INSERT + c), c, d)
        out[i] = v
        if known is not None:
            shift = v[0] - int(known[i, 0])
            if all(v[s] - int(known[i, s]) == shift for s in (1, 2, 3)):
                out[:i] = known[:i] + shift
                break
    return out


def traced(codes: bytes, copies: np.ndarray, costs: np.ndarray, state: int, last: bool) -> tuple[str, list[tuple[int, int]], int, int]:
    """The least edits from ``state`` on: their initials, the repaired rows, the state at the end, the cost.

    A repaired row is (number of the row among those that are not forced out, or -1; state it was given, or -1).
    """
    audit, rows, i, own, cost = [], [], 0, 0, 0
    counts, v = copies.tolist(), costs.tolist()
    n = len(codes)
    while True:
        if i == n:
            if not last or state in (START, AFTER_A):
                return "".join(audit), rows, state, cost
            code, k = -1, 1
        else:
            code, k = codes[i], counts[i]
        if code == FORCED:
            audit.append("D" * k)
            cost, i = cost + DELETE * k, i + 1
            continue
        now, to = v[i][state], NEXT[state]
        if code >= 0:
            cut, keep, more = CUT_OFF * (code >= TRUNCATED), KEEP[code & 3][state], DELETE * (k - 1)
            if DELETE + more + v[i + 1][state] == now:
                audit.append("D" * k)
                cost, i, own = cost + DELETE + more, i + 1, own + 1
                continue
        if code < 0 or INSERT + v[i][to] == now:
            audit.append("I")
            rows.append((-1, to))
            cost, state = cost + INSERT, to
            continue
        if keep >= 0 and cut + more + v[i + 1][keep] == now:
            audit.append("K")
            rows.append((own, -1))
            cost, state = cost + cut + more, keep
        else:
            audit.append("R")
            rows.append((own, to))
            cost, state = cost + REROLE + cut + more, to
        audit.append("D" * (k - 1))
        i, own = i + 1, own + 1


class Repaired(NamedTuple):
    """Conversations after repair, a row for each piece: conv_id, no, stats, audit, cost, and roles and texts of the repaired rows."""

    whole: DataFrame  # conversations of one piece
    pieces: DataFrame  # of longer ones, or such as lie at the edge of a partition


def _cut(folder: str, rows: DataFrame) -> DataFrame:
    """Pieces of conversations, sorted, in shared storage."""
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(
        f"part int, seq int, chained boolean, codes binary, copies binary, roles array<string>, texts array<string>, stats {_STATS}").fields])
    order = ["conv_id", "turn", "role", "key"]
    dealt = rows.repartitionByRange(slots(rows.sparkSession), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, seq, edge, out, kind, size = TaskContext.get().partitionId(), None, 0, True, [], None, 0
        for batch in batches:
            kind = kind or pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), *_PIECE_FIELDS])
            for c, turn, role, text, _, copies, fault in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if piece is None or piece.conv != c or piece.full():
                    if piece is not None:
                        more = piece.conv == c
                        out.append(piece.row(part, seq, edge or more or seq > 0))
                        size += piece.bytes
                        seq, edge = (seq + 1, edge) if more else (0, False)
                    piece = Piece(c)
                    if size > PIECE_BYTES or len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist(out, schema=kind)
                        out, size = [], 0
                piece.add(turn, role, text, copies, fault)
        if piece is not None:
            out.append(piece.row(part, seq, True))
            yield pa.RecordBatch.from_pylist(out, schema=kind)
        tidy()

    return written(dealt.mapInArrow(pack, schema), f"{folder}/pieces")


_PIECE_FIELDS = [pa.field("part", pa.int32()), pa.field("seq", pa.int32()), pa.field("chained", pa.bool_()), pa.field("codes", pa.binary()),
                 pa.field("copies", pa.binary()), pa.field("roles", pa.list_(pa.string())), pa.field("texts", pa.list_(pa.string())),
                 pa.field("stats", pa.struct([pa.field(k, pa.int64()) for k in STATS]))]


def _edited(pieces: DataFrame, folder: str | None) -> DataFrame:
    """The pieces with their traces. ``folder``: None if each is a conversation by itself, from no state to the end."""
    conv = pieces.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(
        f"no int, stats {_STATS}, audit string, cost long, roles array<string>, texts array<string>").fields])
    alone = folder is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                copies = np.frombuffer(r["copies"], "<i4")
                costs = backward(r["codes"], copies, FINAL) if alone else loaded(r["costs"])
                audit, rows, _, cost = traced(r["codes"], copies, costs, START if alone else r["state"], alone or r["last"])
                out.append({"conv_id": r["conv_id"], "no": 0 if alone else r["no"], "stats": r["stats"], "audit": audit, "cost": cost,
                            "roles": [r["roles"][i] if to < 0 else GIVEN[to] for i, to in rows],
                            "texts": [r["texts"][i] if i >= 0 else "" for i, _ in rows]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), *_EDITED_FIELDS]))
        tidy()

    return pieces.mapInArrow(run, schema)


_EDITED_FIELDS = [pa.field("no", pa.int32()), _PIECE_FIELDS[-1], pa.field("audit", pa.string()), pa.field("cost", pa.int64()),
                  pa.field("roles", pa.list_(pa.string())), pa.field("texts", pa.list_(pa.string()))]


def saved(costs: np.ndarray) -> bytes:
    """Cost vectors, as differences along the rows, compressed."""
    return np.array([len(costs)], "<i8").tobytes() + pa.compress(np.diff(costs, axis=0, prepend=0).astype("<i8").T.tobytes(), codec="zstd", asbytes=True)


def loaded(body: bytes) -> np.ndarray:
    n = int(np.frombuffer(body, "<i8", 1)[0])
    return np.cumsum(np.frombuffer(pa.decompress(body[8:], 32 * n, codec="zstd"), "<i8").reshape(4, n).T, axis=0)


def level(vector) -> list[int]:
    """A vector less its smallest cost: equal for vectors that differ by a constant."""
    return [int(x) - int(min(vector)) for x in vector]


def _mapped(df: DataFrame, added: str, fn) -> DataFrame:
    """``df`` with the columns (a DDL string) that ``fn`` adds to each row, given as a dict."""
    fields = T.StructType.fromDDL(added).fields
    schema = T.StructType([*(f for f in nullable(df.schema).fields if f.name not in [a.name for a in fields]), *fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        more = {f.name: to_arrow_type(f.dataType) for f in fields}
        for batch in batches:
            kind = pa.schema([pa.field(n, more.get(n) or batch.schema.field(n).type) for n in names])
            yield pa.RecordBatch.from_pylist([r | fn(r) for r in batch.to_pylist()], schema=kind)
        tidy()

    return df.mapInArrow(run, schema)


def _beside(df: DataFrame, other: DataFrame, how: str, *, on: tuple = ("conv_id", "no")) -> DataFrame:
    """A join on conversation (null: a conversation of its own) and number."""
    names = {c: f"_{c}" for c in on}
    other = other.withColumnsRenamed(names)
    where = F.col(on[0]).eqNullSafe(F.col(f"_{on[0]}"))
    for c in on[1:]:
        where &= F.col(c) == F.col(f"_{c}")
    return df.join(other, where, how).drop(*names.values())


def _settled(links: DataFrame, folder: str, fixups: int) -> DataFrame:
    """``links`` (conv_id, no, last, codes, copies) with the cost vectors of each piece, right up to a constant."""
    ends = "end array<long>, begin array<long>, costs binary"

    def first(r: dict) -> dict:
        return ran(r, FINAL if r["last"] else GUESS)

    def ran(r: dict, end, known: np.ndarray | None = None) -> dict:
        costs = backward(r["codes"], np.frombuffer(r["copies"], "<i4"), tuple(end), known)
        return {"end": list(end), "begin": level(costs[0]), "costs": saved(costs)}

    def again(r: dict) -> dict:
        if r["wanted"] is None or r["wanted"] == r["end"]:
            return {k: r[k] for k in ("end", "begin", "costs")}
        return ran(r, r["wanted"], loaded(r["costs"]))

    state = written(_mapped(links, ends, first), f"{folder}/pass-0")
    for k in range(1, fixups + 1):
        after = state.select("conv_id", (F.col("no") - 1).alias("no"), F.col("begin").alias("wanted"))
        held = _beside(state, after, "left")
        if held.where("wanted IS NOT NULL AND wanted != end").isEmpty():
            return state
        state = written(_mapped(held, ends, again).drop("wanted"), f"{folder}/pass-{k}")
    after = state.select("conv_id", (F.col("no") - 1).alias("no"), F.col("begin").alias("wanted"))
    open_ = _beside(state, after, "inner").where("wanted != end").select("conv_id").distinct()
    if open_.isEmpty():
        return state

    def units(r: dict) -> dict:
        copies = np.frombuffer(r["copies"], "<i4")
        if r["last"]:
            return {"matrix": [int(x) for x in backward(r["codes"], copies, FINAL)[0]] * 4}
        each = [backward(r["codes"], copies, tuple(0 if s == t else FAR for s in range(4)))[0] for t in range(4)]
        return {"matrix": [int(min(x, FAR)) for v in each for x in v]}

    def chain(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: -r["no"])
        out, v = [], None
        for r in rows:
            m = np.array(r["matrix"], np.int64).reshape(4, 4)
            out.append(list(FINAL) if v is None else v)
            v = level(m[0]) if v is None else level((m + np.array(v)[:, None]).min(axis=0))
        return pa.table({"conv_id": pa.array([r["conv_id"] for r in rows], table.schema.field("conv_id").type),
                         "no": pa.array([r["no"] for r in rows], pa.int32()), "wanted": pa.array(out, pa.list_(pa.int64()))})

    stuck = _beside(state, open_, "left_semi", on=("conv_id",))
    matrices = _mapped(stuck, "matrix array<long>", units).select("conv_id", "no", "matrix")
    conv = T.StructField("conv_id", state.schema["conv_id"].dataType)
    schema = T.StructType([conv, T.StructField("no", T.IntegerType()), T.StructField("wanted", T.ArrayType(T.LongType()))])
    wanted = matrices.groupBy("conv_id").applyInArrow(chain, schema)  # a few numbers for each piece of a conversation
    return written(_mapped(_beside(state, wanted, "left"), ends, again).drop("wanted"), f"{folder}/pass-exact")


def repair(rows: DataFrame, folder: str | None = None, fixups: int = FIXUPS) -> Repaired:
    """The cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text; and present, if it is there).

    Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty row of user or assistant) 2, and a
    truncated row that stays 1 more; blank and duplicate rows must go. Of equally cheap repairs the one whose initials
    are ASCII-least. Rows go by turn (null first), in one turn by role and the md5 of role and text. Null roles and
    texts are one blank; a null conv_id is a conversation of its own. A row that is not present only says that the
    conversation exists: without other rows it has no edits. Other columns are not used. An empty table gives no rows.
    A very long text stays whole, in a worker by itself; a very long conversation is cut into pieces.
    """
    folder = folder or run_folder(rows.sparkSession, "conversations")
    pieces = _cut(folder, judged(rows))
    alone = _edited(pieces.where("NOT chained"), None)
    chained = pieces.where("chained")
    # a conversation of a billion rows has some 15,000 pieces; the window holds their numbers alone
    number = Window.partitionBy("conv_id").orderBy("part", "seq")
    every = Window.partitionBy("conv_id")
    numbered = chained.select("conv_id", "part", "seq").withColumns(
        {"no": (F.row_number().over(number) - 1).cast("int"), "last": F.row_number().over(number) == F.count("*").over(every)})
    linked = _beside(chained.select("conv_id", "part", "seq", "codes", "copies"), numbered, "inner", on=("conv_id", "part", "seq"))
    settled = _settled(linked, folder, fixups)

    def passages(r: dict) -> dict:
        copies, costs = np.frombuffer(r["copies"], "<i4"), loaded(r["costs"])
        return {"to": [traced(r["codes"], copies, costs, s, r["last"])[2] for s in ((START,) if r["no"] == 0 else range(4))]}

    def chain(table: pa.Table) -> pa.Table:
        found, state = [], START
        rows = sorted(table.to_pylist(), key=lambda r: r["no"])
        for r in rows:
            found.append(state)
            state = r["to"][state]
        return pa.table({"conv_id": pa.array([r["conv_id"] for r in rows], table.schema.field("conv_id").type),
                         "no": pa.array([r["no"] for r in rows], pa.int32()), "state": pa.array(found, pa.int32())})

    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T.StructType.fromDDL("no int, state int").fields])
    states = _mapped(settled, "to array<int>", passages).select("conv_id", "no", "to").groupBy("conv_id").applyInArrow(chain, schema)
    known = _beside(settled.select("conv_id", "no", "last", "part", "seq", "costs"), states, "inner")
    return Repaired(alone, _edited(_beside(chained, known, "inner", on=("conv_id", "part", "seq")), folder))


def report(repaired: Repaired) -> DataFrame:
    """A row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The pieces of a long conversation go through one task in order, which keeps its running sums, audit and SHA-256.
    """
    conv = repaired.whole.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = None, None
        for batch in batches:
            done = []
            kind = pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), *_REPORT_FIELDS])
            for r in batch.to_pylist():
                if total is None or total.conv != r["conv_id"] or r["no"] == 0:
                    if total is not None:
                        done.append(total.row())
                    total = _Total(r["conv_id"])
                total.add(r)
            yield pa.RecordBatch.from_pylist(done, schema=kind)
        if total is not None:
            yield pa.RecordBatch.from_pylist([total.row()], schema=kind)
        tidy()

    long = repaired.pieces.repartition("conv_id").sortWithinPartitions("conv_id", "no")
    return repaired.whole.mapInArrow(run, schema).unionByName(long.mapInArrow(run, schema))


_REPORT_FIELDS = [*(pa.field(k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                  pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())]


class _Total:
    """What the pieces of a conversation come to."""

    def __init__(self, conv):
        self.conv, self.sums, self.cost, self.audit = conv, dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0), 0, []
        self.sha, self.any = hashlib.sha256(), False
        self.last = self.least = self.most = None

    def add(self, r: dict) -> None:
        s = r["stats"]
        for k in self.sums:
            self.sums[k] += s[k]
        if s["n"]:
            if self.last is not None and (self.last, s["first"]) not in LEGAL:
                self.sums["illegal"] += 1
            self.last = s["last"]
        if s["least"] is not None:
            self.sums["turns"] -= s["least"] == self.most  # a turn in two pieces
            self.least, self.most = s["least"] if self.least is None else self.least, s["most"]
        self.cost += r["cost"]
        self.audit.append(r["audit"])
        for role, text in zip(r["roles"], r["texts"], strict=True):
            self.sha.update((b"\n" if self.any else b"") + f"{role}:{text}".encode())
            self.any = True

    def row(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.sums.pop("turns")
        return {"conv_id": self.conv, "gaps": gaps, **{k: v for k, v in self.sums.items() if k != "turns"}, "cost": self.cost,
                "audit": "".join(self.audit), "repaired_sha256": self.sha.hexdigest()}
