"""Best-fit packing of token sequences into bins of fixed capacity (operator 1).

Method: pieces above one third of the capacity go at most two to a bin, so
they are matched greedily, longest first, each with the longest piece that
still fits beside it; shorter pieces then go, longest first, into the
smallest gap that holds them, and open new bins where none does.

Lengths are whole numbers up to the capacity, and pieces of one length are
interchangeable. So the plan is made on the counts per length (never more
numbers than the capacity has) and says which *ranks* of a length go to
which bins; its size depends on the capacity alone, not on the data. Every
piece then finds its bin by a join on its length and rank: no piece passes
through the driver, and the packing is the same as if all pieces had been
packed one after the other.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.shared import blocks, run_folder, written
from auditlens.llm.tokens import encoder
from auditlens.session import ship_module

PLAN = "length int, rank_from long, rank_to long, first_bin long, per_bin long, base int"
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, text: str = "text",
              doc_id: str = "doc_id") -> DataFrame:
    """Token pieces of whole texts: doc_id, piece, start, length, ids (little-endian unsigned 32-bit).

    A document is its ids and ``end_id``. Documents above ``capacity`` are
    cut into pieces of that length, of which the first takes the rest. A
    null or empty text is one piece that holds ``end_id`` alone; a null
    doc_id stays null; repeated rows give repeated pieces.
    """
    ship_module(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for block in blocks(batches, "text"):
            ids, bounds = enc.encode(block.column(1))
            out: tuple[list, list, list, list, list] = ([], [], [], [], [])
            for doc, a, b in zip(block.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                whole = np.append(ids[a:b], end_id).astype("<u4")
                first = len(whole) % capacity or capacity
                edges = [0, *range(first, len(whole) + 1, capacity)]
                for k, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    for column, value in zip(out, (doc, k, x, y - x, whole[x:y].tobytes()), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        cut, PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of PLAN: ranks [from, to) of a length go ``per_bin`` to a bin, from ``first_bin`` and offset ``base`` on."""
    left = {n: c for n, c in counts.items() if c > 0}
    taken: dict[int, int] = defaultdict(int)
    rows: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room: runs of (first bin, bins)
    bins = 0

    def place(length: int, n: int, first: int, per_bin: int, base: int) -> None:
        rows.append((length, taken[length], taken[length] + n, first, per_bin, base))
        taken[length] += n
        left[length] -= n

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        for mate in large:
            if mate + length > capacity or mate > length or not left[length]:
                continue
            n = left[length] // 2 if mate == length else min(left[length], left[mate])
            if not n:
                continue
            if mate == length:
                place(length, 2 * n, bins, 2, 0)
            else:
                place(length, n, bins, 1, 0)
                place(mate, n, bins, 1, length)
            gaps[capacity - length - mate].append((bins, n))
            bins += n
        if n := left[length]:
            place(length, n, bins, 1, 0)
            gaps[capacity - length].append((bins, n))
            bins += n
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in range(length, capacity + 1):
            runs = gaps.pop(gap, []) if left[length] else []
            while runs and left[length]:
                first, n = runs.pop()
                fit = gap // length
                full = min(n, left[length] // fit)
                if full:
                    place(length, full * fit, first, fit, capacity - gap)
                    gaps[gap - fit * length].append((first, full))
                    first, n = first + full, n - full
                if n and left[length]:
                    rest = left[length]
                    place(length, rest, first, rest, capacity - gap)
                    gaps[gap - rest * length].append((first, 1))
                    first, n = first + 1, n - 1
                if n:
                    runs.append((first, n))
            if runs:
                gaps[gap].extend(runs)
            if not left[length]:
                break
        if n := left[length]:
            fit = capacity // length
            full, rest = divmod(n, fit)
            if full:
                place(length, full * fit, bins, fit, 0)
                gaps[capacity - fit * length].append((bins, full))
                bins += full
            if rest:
                place(length, rest, bins, rest, 0)
                gaps[capacity - rest * length].append((bins, 1))
                bins += 1
    return rows


def pack(pieces: DataFrame, capacity: int = 2048, length: str = "length", folder: str | None = None) -> DataFrame:
    """``pieces`` with sequence_id and offset: every piece whole in one sequence, gapless from 0.

    Lengths must lie in 1..capacity (else an error). All other columns pass
    through, nulls and repeated rows too; an input that has columns of the
    added names loses those. An empty input gives an empty result.
    """
    spark = pieces.sparkSession
    folder = folder or run_folder(spark, "pack")
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    # one Python worker per task at most: rows are numbered by Spark, and ranked without their payload
    held = written(pieces.select(F.col(length).cast("long").alias("_l"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"),
                                 F.monotonically_increasing_id().alias("_id"), F.spark_partition_id().alias("_task")), f"{folder}/pieces")
    of_task = Window.partitionBy("_l", "_task").orderBy("_id")
    ranked = held.select("_l", "_task", "_id", (F.row_number().over(of_task) - 1).alias("_rank"))
    per_task = held.groupBy("_l", "_task").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy("_l").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    counts = {r["_l"]: r["n"] for r in per_task.groupBy("_l").agg(F.sum("_n").alias("n")).collect()}  # <= capacity rows
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    rows = plan({int(k): int(v) for k, v in counts.items()}, capacity)
    steps = F.broadcast(spark.createDataFrame(rows, PLAN))  # bounded by capacity
    placed = ranked.join(before.drop("_n"), ["_l", "_task"])
    placed = placed.withColumn("_r", F.col("_rank") + F.col("_before")).join(
        steps, (F.col("_l") == F.col("length")) & (F.col("_r") >= F.col("rank_from")) & (F.col("_r") < F.col("rank_to")))
    at = F.col("_r") - F.col("rank_from")
    placed = placed.select("_id", (F.col("first_bin") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
                           (F.col("base") + at % F.col("per_bin") * F.col("_l")).cast("long").alias("offset"))
    return held.select("_id", "_row").join(placed, "_id").select("_row.*", "sequence_id", "offset")
