"""Benchmark decontamination by greedy string tiling (operator 2).

Method: a text and a benchmark item share seeds, windows of ``min_match``
words with equal rolling (Karp-Rabin) hashes. For each pair with seeds the
longest common run of words that are not marked yet is marked in both, and
again, until no run of ``min_match`` words is left. The marked share of the
item is its coverage; order does not count, so passages whose parts were
put in another order are found too.

The benchmark is taken in blocks of about ``block_bytes``: each block's
seeds go to all executors (so that much and no more is broadcast), and the
documents are read once per block, without a shuffle. Words are compared in
lower case (A-Z).
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.shared import blocks, nullable
from auditlens.llm.words import Words
from auditlens.session import ship_module

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK = 8 << 20
PAIRS = 1 << 20  # of a text's distinct seeds and their places in items, at once (always one text at least)


def tiles(a: np.ndarray, b: np.ndarray, starts: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in ``a``, place in ``b``, words), longest first.

    ``starts`` are the places of equal windows of ``k`` words. Of equally
    long runs the first in ``a``, then in ``b``, goes first.
    """
    runs: list[tuple[int, int, int]] = []
    diagonals = defaultdict(list)
    for i, j in starts:
        diagonals[i - j].append(i)
    for d, places in diagonals.items():
        places.sort()
        first = last = places[0]
        for i in places[1:]:
            if i != last + 1:
                runs.append((first - last - k, first, first - d))
                first = i
            last = i
        runs.append((first - last - k, first, first - d))
    heapq.heapify(runs)
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out = []
    while runs:
        size, i, j = heapq.heappop(runs)
        free = free_a[i:i - size] & free_b[j:j - size]
        if free.all():
            out.append((i, j, -size))
            free_a[i:i - size] = free_b[j:j - size] = False
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if y - x >= k:
                heapq.heappush(runs, (x - y, i + x, j + x))
    return out


class Index:
    """Seeds of a block of benchmark items."""

    def __init__(self, ids: list, texts: list[str | None], min_match: int):
        words = Words(pa.array(texts, pa.string()), lower=True)
        self.ids = ids
        self.items = [words.hashes[x:y] for x, y in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
        counts = words.counts()
        self.seeds, self.windows = {}, {}
        owner = words.doc_of_word()
        for k in sorted({min(int(n), min_match) for n in counts if n}):
            at, hashes = words.windows(k)
            mine = (counts[owner[at]] >= k) & ((k == min_match) | (counts[owner[at]] == k))
            at, hashes = at[mine], hashes[mine]
            self.windows[k] = (hashes, np.searchsorted(at, words.bounds))  # item by item
            order = np.argsort(hashes, kind="stable")
            item = owner[at[order]]
            self.seeds[k] = (hashes[order], item, at[order] - words.bounds[item])

    def matches(self, column: pa.Array, threshold: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """Row of the text, number of the item, tiles: of all pairs at or above the threshold.

        A seed that a text repeats counts once as long as it is only asked how much of an item its seeds could
        cover; the places of a seed in the text are looked up for the pairs that can reach the threshold alone.
        """
        words = Words(column, lower=True)
        owner = words.doc_of_word()
        size = np.fromiter(map(len, self.items), np.int64, len(self.items))
        for k, (seeds, item, place) in self.seeds.items():
            at, hashes = words.windows(k)
            first_window = np.searchsorted(at, words.bounds)
            lo, hi = np.searchsorted(seeds, hashes), np.searchsorted(seeds, hashes, "right")
            hit = np.flatnonzero(hi > lo)
            seen, once = np.unique(owner[at[hit]] * (len(seeds) + 1) + lo[hit], return_index=True)  # by row, then seed
            row, lo, n = seen // (len(seeds) + 1), lo[hit][once], (hi - lo)[hit][once]
            upto = np.concatenate([[0], np.cumsum(n)])
            ends = np.flatnonzero(np.diff(row, append=-1)) + 1  # of each text's seeds
            x = 0
            while x < len(row):
                y = int(ends[max(np.searchsorted(upto[ends], upto[x] + PAIRS, "right") - 1, np.searchsorted(ends, x, "right"))])
                yield from self.some(words, hashes, first_window, k, row[x:y], lo[x:y], n[x:y], item, place, threshold * size)
                x = y

    def some(self, words: Words, hashes: np.ndarray, first_window: np.ndarray, k: int, row: np.ndarray, lo: np.ndarray, n: np.ndarray,
             item: np.ndarray, place: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """Matches of some texts, given as their distinct seeds; ``least``: words of each item that must be covered."""
        which = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        row, item, place = np.repeat(row, n), item[which], place[which]
        order = np.lexsort((place, item, row))
        row, item, place = row[order], item[order], place[order]
        new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
        step = np.minimum(np.diff(place, append=0), k)  # words that a seed covers before the next one begins
        step[np.append(new[1:] - 1, len(row) - 1)] = k
        covered = np.add.reduceat(step, new)
        for p in np.flatnonzero(covered >= least[item[new]]).tolist():
            r, i = int(row[new[p]]), int(item[new[p]])
            a, b = first_window[r], first_window[r + 1]
            own, cut = self.windows[k]
            goal = own[cut[i]:cut[i + 1]]
            by = np.argsort(goal, kind="stable")
            left, right = np.searchsorted(goal[by], hashes[a:b]), np.searchsorted(goal[by], hashes[a:b], "right")
            m = right - left
            starts = np.repeat(np.arange(b - a), m), by[np.repeat(left - np.cumsum(m) + m, m) + np.arange(m.sum())]
            text = words.hashes[words.bounds[r]:words.bounds[r + 1]]
            found = tiles(text, self.items[i], list(zip(starts[0].tolist(), starts[1].tolist(), strict=True)), k)
            if sum(t[2] for t in found) >= least[i]:
                yield r, i, found


def benchmark_blocks(benchmark: DataFrame, min_match: int, block_bytes: int) -> Iterator[Index]:
    """Indexes over the benchmark's items, block by block (items without words never match)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes)
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
        yield Index([r[0] for r in rows], [r[1] for r in rows], min_match)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = COVERAGE,
                 block_bytes: int = BLOCK) -> DataFrame:
    """A row for each pair of document and benchmark item at or above the threshold.

    Columns: doc_id, item_id, item_words, matched_words, coverage, tiles
    (array of doc_from, item_from, words). An item with fewer than
    ``min_match`` words matches as a whole. Null and empty texts match
    nothing; null ids stay null; repeated documents or items give a row
    each; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    ship_module(spark)
    schema = ("doc_id long, item_id long, item_words int, matched_words int, coverage double, "
              "tiles array<struct<doc_from: int, item_from: int, words: int>>")
    kind = pa.list_(pa.struct([("doc_from", pa.int32()), ("item_from", pa.int32()), ("words", pa.int32())]))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], schema)
    for index in benchmark_blocks(benchmark, min_match, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for block in blocks(batches, "text"):
                ids = block.column(0).to_pylist()
                rows = [(ids[r], own.ids[i], len(own.items[i]), sum(t[2] for t in found), found)
                        for r, i, found in own.matches(block.column(1), threshold)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()),
                     pa.array([x[2] for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.int32()),
                     pa.array([x[3] / x[2] for x in rows], pa.float64()),
                     pa.array([[dict(zip(("doc_from", "item_from", "words"), t, strict=True)) for t in x[4]] for x in rows], kind)],
                    names=["doc_id", "item_id", "item_words", "matched_words", "coverage", "tiles"])

        out = out.unionByName(narrow.mapInArrow(search, schema))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = COVERAGE,
                   block_bytes: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that are at or above the threshold with no benchmark item, all columns as they were."""
    spark = docs.sparkSession
    ship_module(spark)
    for index in benchmark_blocks(benchmark, min_match, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, "text"):
                clean = np.ones(block.num_rows, bool)
                for r, _, _ in shared.value.matches(block.column(block.schema.get_field_index("text")), threshold):
                    clean[r] = False
                yield block.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, nullable(docs.schema))
    return docs
