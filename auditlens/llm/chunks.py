"""Look-ups of very many keys, asked chunk by chunk and answered by owners of key ranges.

Some operators must ask for each word window or byte context of the corpus
how often it occurs elsewhere. The table of answers is as large as the
corpus, so it can't be broadcast, and a join would carry every position of
every text. Here the texts are written once as chunks of a few megabytes
(a row each); every chunk sends its *distinct* keys, packed, to the slots that
own them; each slot sees all chunks' records for its keys at once and answers
each chunk. The answers are written to shared storage by the writer task of
the chunk, and the next pass over the chunks reads those of its own. No text
is shuffled, a key that is frequent in a chunk travels once, and a slot holds
as many keys whatever the size of the corpus, if the caller deals them out
evenly (operator 9 splits its large contexts for that).

Chunks and slots both grow with the corpus, so a chunk can't send a package
to every slot. It sends one to each of at most ``fan`` ranges of slots; the
packages of as many chunks as there are ranges are, for one range, as large
as a chunk again, and one task deals them to the ranges within it, until a
range is one slot. Answers go back to the writer tasks in the same way. So a
chunk makes at most ``fan`` packages on each level, whatever the size of the
corpus, and the levels grow with its logarithm (one up to 256 slots, two up
to 65,536). All levels have equally many ranges: 27 and 27 for 720 slots, as
with 256 and 3 a task would get a third of 256 chunks.
Records are arrays in runs of one chunk and one slot; nothing loops over runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.shared import blocks, filesystem, mix, nullable, tidy, written

CHUNK_BYTES = 8 << 20
FAN = 256  # ranges that a task deals its records to
BATCH_BYTES = 4 << 20  # of packages in one batch
_SHIFT = 20  # chunk = task << 20 | number within the task


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(body: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(body.as_buffer()).read_next_batch()


class Runs(NamedTuple):
    """Records in runs: the chunk, the slot and the number of records of each run, and the records' fields."""

    chunk: np.ndarray
    slot: np.ndarray
    n: np.ndarray
    fields: tuple[np.ndarray, ...]

    def stored(self) -> bytes:
        head = np.array([len(self.n), self.n.sum()], "<i8")
        return b"".join(x.tobytes() for x in (head, self.chunk.astype("<i8"), self.slot.astype("<i4"), self.n.astype("<u4"), *self.fields))

    def ordered(self, order: np.ndarray) -> Runs:
        n = self.n[order]
        at = np.repeat((np.cumsum(self.n) - self.n)[order] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return Runs(self.chunk[order], self.slot[order], n, tuple(x[at] for x in self.fields))

    def divided(self, dest: np.ndarray) -> Iterator[tuple[int, Runs]]:
        """The runs of each destination; ``dest``: that of each run, ascending."""
        ends = np.concatenate([[0], np.cumsum(self.n)])
        cuts = np.flatnonzero(np.concatenate([[True], dest[1:] != dest[:-1], [True]])) if len(dest) else np.zeros(0, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield int(dest[a]), Runs(self.chunk[a:b], self.slot[a:b], self.n[a:b], tuple(x[ends[a]:ends[b]] for x in self.fields))


def restored_runs(body: pa.Buffer, types: Sequence[str]) -> Runs:
    runs, records = np.frombuffer(body, "<i8", 2).tolist()
    out, at = [], 16
    for kind, size in (("<i8", runs), ("<i4", runs), ("<u4", runs), *((t, records) for t in types)):
        out.append(np.frombuffer(body, kind, size, at))
        at += out[-1].nbytes
    return Runs(out[0], out[1].astype(np.int64), out[2].astype(np.int64), tuple(out[3:]))


def together(bodies: list[pa.Buffer], types: Sequence[str]) -> Runs:
    parts = [restored_runs(b, types) for b in bodies]
    return Runs(*(np.concatenate([p[i] for p in parts]) for i in range(3)),
                tuple(np.concatenate([p.fields[i] for p in parts]) for i in range(len(types))))


def widths(places: int, fan: int) -> list[int]:
    """Places in one range on each level, down to one: as few levels as ``fan`` allows, each dealt to equally many ranges."""
    levels = 1
    while fan ** levels < places:
        levels += 1
    step = next(n for n in range(1, fan + 1) if n ** levels >= places) if levels > 1 else 1
    return [step ** i for i in reversed(range(levels))]


PACKAGES = "dest long, home long, body binary"


def packages(rows: list[tuple[int, int, bytes]]) -> dict[str, pa.Array]:
    dest, home, body = zip(*rows, strict=True) if rows else ((), (), ())
    return {"dest": pa.array(dest, pa.int64()), "home": pa.array(home, pa.int64()), "body": pa.array(body, pa.binary())}


def dealt_on(rows: DataFrame, levels: list[int], types: Sequence[str], by_chunk: bool) -> DataFrame:
    """Packages for ranges, dealt to the single places within them: slots, or the writer tasks of chunks.

    A range's packages go to tasks by their home, to each about as many as the range has ranges within it.
    """
    def dealer(width: int, step: int) -> Callable:
        def regroup(table: pa.Table) -> pa.Table:
            dest, home = table.column("dest")[0].as_py(), table.column("home")[0].as_py()
            if dest < 0:  # notes to the caller
                return table
            runs = together([x.as_buffer() for x in table.column("body")], types)
            to = (runs.chunk >> _SHIFT if by_chunk else runs.slot) // width
            order = np.lexsort((runs.slot, runs.chunk, to))
            return pa.table(packages([(d, home // step, part.stored()) for d, part in runs.ordered(order).divided(to[order])]))

        return regroup

    for wide, width in zip(levels[:-1], levels[1:], strict=True):
        rows = rows.groupBy("dest", "home").applyInArrow(dealer(width, wide // width), PACKAGES)
    return rows


class Chunks:
    """The rows of ``docs`` as chunks in shared storage.

    ``tally``, if given, is made once in each task and called with each
    block of rows; what its ``result`` returns is kept beside the chunks.
    ``fan``: the ranges that a chunk or a task deals its records to.
    """

    def __init__(self, docs: DataFrame, folder: str, size: int = CHUNK_BYTES, tally: Callable | None = None, fan: int = FAN):
        self.folder, self.docs_schema, self.fan = folder, nullable(docs.schema), fan

        def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = TaskContext.get().partitionId() << _SHIFT
            own = tally() if tally else None
            held: list[pa.RecordBatch] = []
            taken, n = 0, 0

            def row(number: int, body: bytes) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([body], pa.binary())],
                                                  names=["chunk", "body"])

            for block in blocks(batches, "text"):
                if own:
                    own(block)
                held.append(block)
                taken += block.column(block.schema.get_field_index("text")).nbytes
                if taken >= size - (1 << 20):
                    yield row(first + n, packed(pa.Table.from_batches(held).combine_chunks().to_batches()[0]))
                    held, taken, n = [], 0, n + 1
            if held:
                yield row(first + n, packed(pa.Table.from_batches(held).combine_chunks().to_batches()[0]))
            if own:
                yield row(-1, own.result())

        stored = written(docs.mapInArrow(store, "chunk long, body binary"), f"{folder}/chunks")
        self.rows = stored.where("chunk >= 0")
        self.tallies = stored.where("chunk < 0").select("body")
        self.count, last = self.rows.agg(F.count("chunk"), F.coalesce(F.max("chunk"), F.lit(0))).first()
        self.parts = (last >> _SHIFT) + 1  # writer tasks

    def sent(self, slots: int, emit: Callable, types: Sequence[str], source: DataFrame | None = None) -> DataFrame:
        """The packages of all chunks at their slots: dest (the slot), home, body. See ``ask``."""
        plain = source is not None
        levels = widths(slots, self.fan)
        homes = max(1, -(-self.count // -(-slots // levels[0])))

        def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for batch in batches:
                for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    slot, *fields = emit(chunk, body.as_buffer() if plain else unpacked(body))
                    first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
                    runs = Runs(np.full(len(first), chunk), slot[first], np.diff(np.append(first, len(slot))), tuple(fields))
                    home = int(mix(np.array([chunk], np.uint64))[0] % np.uint64(homes))
                    for dest, part in runs.divided(runs.slot // levels[0]):
                        rows.append((dest, home, part.stored()))
                        size += len(rows[-1][2])
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pydict(packages(rows))
                            rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pydict(packages(rows))
            tidy()

        return dealt_on((source if plain else self.rows).mapInArrow(questions, PACKAGES), levels, types, by_chunk=False)

    def ask(self, name: str, slots: int, emit: Callable, types: Sequence[str], answer: Callable, reply: str,
            source: DataFrame | None = None) -> Answers:
        """A round of questions and answers.

        ``emit(chunk, batch)`` gives the slots of a chunk's records, ascending,
        and the records' fields, of the given ``types``. ``answer(slot, owner,
        owners, fields)`` gets all records of a slot, with the number of the
        chunk that each is from; it gives its answers' owners, ascending, the
        answers (of type ``reply``) and a note to the caller or None.
        ``source``: rows of chunk and body to emit from in place of the texts;
        ``emit`` gets the body as it is.
        """
        levels = widths(self.parts, self.fan)
        ranges = -(-self.parts // levels[0])

        def answers(table: pa.Table) -> pa.Table:
            slot = table.column("dest")[0].as_py()
            runs = together([x.as_buffer() for x in table.column("body")], types)
            by_chunk = np.argsort(runs.chunk, kind="stable")
            rank = np.empty(len(by_chunk), np.int32)
            rank[by_chunk] = np.arange(len(by_chunk), dtype=np.int32)
            chunk = runs.chunk[by_chunk]
            owner, replies, note = answer(slot, np.repeat(rank, runs.n), len(chunk), runs.fields)
            n = np.bincount(owner, minlength=len(chunk))
            some = n > 0
            given = Runs(chunk[some], np.full(some.sum(), slot), n[some], (replies,))
            rows = [(to, slot // ranges, part.stored()) for to, part in given.divided((given.chunk >> _SHIFT) // levels[0])]
            return pa.table(packages(rows + ([(-1, slot // ranges, note)] if note else [])))

        given = self.sent(slots, emit, types, source).groupBy("dest").applyInArrow(answers, PACKAGES)
        given = dealt_on(given, levels, [reply], by_chunk=True).select(F.col("dest").alias("part"), "body")
        path = f"{self.folder}/{name}"
        given.repartition("part").write.mode("error").option("compression", "zstd").partitionBy("part").parquet(path)
        return Answers(path, reply, given.sparkSession)

    def map(self, fn: Callable, added: list[T.StructField], answers: Answers) -> DataFrame:
        """The rows of the documents with the columns that ``fn(chunk, batch, slots, answers)`` adds; see ``Reader.of``."""
        schema = T.StructType([*self.docs_schema.fields, *added])
        path, reply = answers.path, answers.reply

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = answers_at(path, reply)
            for batch in batches:
                for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield from fn(chunk, unpacked(body), *reader.of(chunk))
            tidy()

        return self.rows.mapInArrow(run, schema)


class Answers:
    def __init__(self, path: str, reply: str, spark):
        self.path, self.reply, self.spark = path, reply, spark

    def notes(self) -> DataFrame:
        """The notes to the caller: one column, payload."""
        found = self.spark.read.schema("body binary, part long").parquet(self.path)
        return found.where(F.col("part") == -1).select(F.col("body").alias("payload"))


class Reader:
    """Answers of the chunks that a task reads; holds those of one writer task."""

    def __init__(self, path: str, reply: str):
        self.path, self.reply, self.part, self.found = path, reply, None, {}

    def of(self, chunk: int) -> tuple[np.ndarray, np.ndarray]:
        """The slots of a chunk's answers, ascending, and the answers."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        if self.part != chunk >> _SHIFT:
            self.part, self.found = chunk >> _SHIFT, {}
            store, root = filesystem(self.path)
            bodies = []
            for f in store.get_file_info(fs.FileSelector(f"{root}/part={self.part}", allow_not_found=True)):
                if f.path.endswith(".parquet"):
                    bodies += [x.as_buffer() for x in pq.ParquetFile(store.open_input_file(f.path)).read(["body"]).column(0)]
            if bodies:
                runs = together(bodies, [self.reply])
                del bodies
                runs = runs.ordered(np.lexsort((runs.slot, runs.chunk)))
                self.found = dict(runs.divided(runs.chunk))
        if chunk not in self.found:
            return np.zeros(0, np.int64), np.zeros(0, self.reply)
        runs = self.found[chunk]
        return np.repeat(runs.slot, runs.n), runs.fields[0]


_reader: list[Reader] = []


def answers_at(path: str, reply: str) -> Reader:
    """The worker's reader of a folder of answers (the last one is kept)."""
    if not _reader or _reader[0].path != path:
        _reader[:] = [Reader(path, reply)]
    return _reader[0]
