"""Ranked lexical search by branch-and-bound over document FP-trees (operator 13).

The items (queries) are a stated set and are taken in blocks of bounded size.
For a block one pass over the documents keeps, for each of them, its length
and its vector restricted to the terms of the items, and counts document
frequencies. The vectors are written; then every task gathers some thousand
of them into a tree: the terms of a vector are put in order of falling
document frequency, so that vectors share the paths of their frequent terms,
and a node stands for the documents below one path. Each node knows the
largest count of every term below it and the smallest length norm m, which
together bound the score of all its documents. An item goes through the tree
depth first, best bound first, and leaves out what can't reach its k-th best
score so far, which it takes along from tree to tree. What is left of all
tasks is ranked by Spark.

A term is ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower
case, and is held as a 64-bit hash.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.shared import blocks, mix, places, run_folder, text_bytes, tidy, written
from auditlens.llm.words import LOWER, inverse, powers

QUERY_BYTES = 2 << 20  # of item texts whose terms are looked for in one pass over the documents
TREE_ROWS, TREE_ENTRIES = 8192, 1 << 20  # documents, and terms of their vectors, in one tree
LEAF_ROWS = 64  # documents that are scored together
PARTS = 64  # first step of the final ranking
NO_ID = -(1 << 63)  # stands for a null id while ranking
_BASE = 0x9FB21C651E98DF25
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of a block of texts, and each text's bounds."""
    data, offsets = text_bytes(column)
    data, n = LOWER[data], len(data)
    solid = _TERM[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(inverse(_BASE), n + 1)[starts]), np.searchsorted(starts, offsets)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score for each unit of its weight: grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Item(NamedTuple):
    key: str
    terms: np.ndarray  # places in order of falling document frequency
    weights: np.ndarray  # weight of each, times its repeats in the item


class Best:
    """The k best documents of an item so far: higher score first, then smaller id."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def reaches(self, score: int, least_id: int) -> bool:
        """Whether a document of at most this score and at least this id can be among the best."""
        return score > 0 and (len(self.heap) < self.k or (score, -least_id) > self.heap[0])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = self.heap[0][0] if len(self.heap) == self.k else 1
        for i in np.flatnonzero(scores >= floor).tolist():
            entry = (int(scores[i]), -int(ids[i]))
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


class Tree:
    """FP-tree of documents. Rows are in order of their paths, so a node is a range of rows.

    ``term`` and ``tf``: the vectors one after the other, each in order of its terms; ``bounds``: of each vector.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, bounds: np.ndarray, term: np.ndarray, tf: np.ndarray, leaf_rows: int = LEAF_ROWS):
        paths = [term[a:b].astype(">u4").tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        order = sorted(range(len(ids)), key=lambda i: (paths[i], ids[i]))
        paths = [paths[i] for i in order]
        order = np.array(order, np.int64)
        size = np.diff(bounds)[order]
        self.bounds = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(bounds[:-1][order] - self.bounds[:-1], size) + np.arange(self.bounds[-1])
        self.ids, self.m = ids[order], m[order]
        self.term, self.tf = term[take], tf[take]
        self.gain = gain(self.tf, np.repeat(self.m, size))
        self.grow(shared_lengths(paths), leaf_rows)
        self.summarise()

    def grow(self, shared: np.ndarray, leaf_rows: int) -> None:
        """Nodes with many documents branch where their paths part; small neighbouring branches make one leaf."""
        self.ranges, self.children = [(0, len(self.ids))], [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = self.ranges[node]
            if b - a <= leaf_rows or shared[a + 1:b].min() >= 1 << 31:
                continue
            cuts = [a, *(a + 1 + np.flatnonzero(shared[a + 1:b] == shared[a + 1:b].min())).tolist(), b]
            first = cuts[0]
            for last, end in zip(cuts[1:], [*cuts[2:], None], strict=True):
                if end is None or end - first > leaf_rows:
                    self.children[node].append(len(self.ranges))
                    todo.append(len(self.ranges))
                    self.ranges.append((first, last))
                    self.children.append([])
                    first = last
            if len(self.children[node]) == 1:  # the same rows again: no further parting
                todo.pop()
                self.ranges.pop()
                self.children.pop()
                self.children[node] = []

    def summarise(self) -> None:
        """Of each node the largest tf of each term below, the smallest m and id; filed by term."""
        n = len(self.ranges)
        self.least_id, least_m = np.zeros(n, np.int64), np.zeros(n, np.int64)
        below: list = [None] * n
        for node in range(n - 1, -1, -1):  # children have higher numbers
            a, b = self.ranges[node]
            self.least_id[node], least_m[node] = self.ids[a:b].min(), self.m[a:b].min()
            if self.children[node]:
                term = np.concatenate([below[c][0] for c in self.children[node]])
                tf = np.concatenate([below[c][1] for c in self.children[node]])
            else:
                term, tf = self.term[self.bounds[a]:self.bounds[b]], self.tf[self.bounds[a]:self.bounds[b]]
            order = np.argsort(term, kind="stable")
            term, tf = term[order], tf[order]
            new = np.flatnonzero(np.diff(term, prepend=-1))
            below[node] = (term[new], np.maximum.reduceat(tf, new)) if len(new) else (term, tf)
        node = np.repeat(np.arange(n), [len(t) for t, _ in below])
        term, tf = (np.concatenate([x[i] for x in below]) for i in (0, 1))
        order = np.argsort(term, kind="stable")
        self.node_of, most = node[order], gain(tf, least_m[node])[order]
        self.most, self.filed = most, term[order]

    def search(self, item: Item, best: Best, weights: np.ndarray) -> int:
        """Adds the tree's documents to the best ones of an item; says how many were scored.

        ``weights``: zeros, as many as terms (and zeros again afterwards).
        """
        bound = np.zeros(len(self.ranges), np.int64)
        a, b = np.searchsorted(self.filed, item.terms), np.searchsorted(self.filed, item.terms, "right")
        for first, last, w in zip(a.tolist(), b.tolist(), item.weights.tolist(), strict=True):
            bound[self.node_of[first:last]] += w * self.most[first:last]  # a node has a term once
        weights[item.terms] = item.weights
        bound_of, least, scored = bound.tolist(), self.least_id.tolist(), 0
        stack = [0]
        while stack:
            node = stack.pop()
            if not best.reaches(bound_of[node], least[node]):
                continue
            if self.children[node]:
                stack.extend(sorted(self.children[node], key=bound_of.__getitem__))  # the best bound is next
                continue
            a, b = self.ranges[node]
            lo, hi = self.bounds[a], self.bounds[b]
            parts = weights[self.term[lo:hi]] * self.gain[lo:hi]
            best.add(np.add.reduceat(parts, self.bounds[a:b] - lo), self.ids[a:b])  # no vector is empty
            scored += b - a
        weights[item.terms] = 0
        return scored


def shared_lengths(paths: list[bytes]) -> np.ndarray:
    """How many terms each path shares with the one before it (a very large number if they are the same)."""
    out = np.zeros(len(paths), np.int64)
    for i in range(1, len(paths)):
        p, q = paths[i - 1], paths[i]
        if p == q:
            out[i] = 1 << 31
            continue
        n = min(len(p), len(q)) // 4
        differ = np.frombuffer(p, ">u4", n) != np.frombuffer(q, ">u4", n)
        out[i] = int(differ.argmax()) if differ.any() else n
    return out


def query_blocks(texts: DataFrame, size: int) -> int:
    """Number of blocks of the distinct texts such that none is much larger than ``size`` bytes, unless it is one text."""
    n = max(1, -(-int(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // size))
    while True:
        block = texts.groupBy(F.pmod(F.xxhash64("text"), F.lit(n)).alias("block")).agg(
            F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("texts"))
        if block.where((F.col("bytes") > 4 * size) & (F.col("texts") > 1)).isEmpty():
            return n
        n *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 20, folder: str | None = None, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank (int, from 1), doc_id and score (long): the ``k`` best documents of each item.

    ``docs``: doc_id and text, ``items``: item_id and text; other columns are not read. Null and empty texts have no
    terms: such documents count nowhere and such items find nothing. Equal scores go by ascending doc_id (null first);
    rows of ``docs`` that are repeated are documents of their own, rows of ``items`` that are repeated are ranked each.
    Empty tables give no rows. Very long texts are read whole, with about forty times their bytes in a worker.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "lexical")
    texts = items.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    parts = query_blocks(texts, query_bytes)
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for part in range(parts):
        mine = [r["text"] for r in texts.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()]  # query_blocks bounds it
        ranked(held, mine, k, f"{folder}/block-{part}").write.mode("error").parquet(f"{folder}/found/part={part}")
    found = spark.read.schema("key string, rank int, doc_id long, score long").parquet(f"{folder}/found/part=*")
    asked = items.select("item_id", F.sha2(F.col("text").cast("string"), 256).alias("key"))
    return asked.join(found, "key").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, texts: list[str], k: int, folder: str) -> DataFrame:
    """The best documents of a block of item texts: key (of the text), rank, doc_id, score."""
    import hashlib

    spark = docs.sparkSession
    hashes, bounds = terms(pa.array(texts, pa.string()))
    vocabulary = np.unique(hashes)
    known = spark.sparkContext.broadcast(vocabulary)  # bounded by the block of texts

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with a term of the items; then, of the task: frequencies, documents, terms."""
        vocabulary = known.value
        df, counted, total = np.zeros(len(vocabulary), np.int64), 0, 0
        kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("vector", pa.binary()), ("tally", pa.bool_())])
        for block in blocks(batches, "text"):
            own, cut = terms(block.column(block.schema.get_field_index("text")))
            n = np.diff(cut)
            counted, total = counted + int((n > 0).sum()), total + int(n.sum())
            if not len(vocabulary) or not len(own):
                continue
            at = np.minimum(places(vocabulary, own), len(vocabulary) - 1)
            hit = np.flatnonzero(vocabulary[at] == own)
            row = np.repeat(np.arange(block.num_rows), n)[hit]
            entry, tf = np.unique(row * len(vocabulary) + at[hit], return_counts=True)
            row, term = entry // len(vocabulary), entry % len(vocabulary)
            df += np.bincount(term, minlength=len(vocabulary))
            some = np.unique(row)
            ends = np.searchsorted(row, some, "right").tolist()
            both = np.stack([term, tf]).astype("<u4")
            packed = [both[:, a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([block.column(block.schema.get_field_index("doc_id")).take(pa.array(some)), pa.array(n[some]),
                                              pa.array(packed, pa.binary()), pa.array(np.zeros(len(some), bool))], schema=kind)
        tally = np.concatenate([[counted, total], df]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([tally], pa.binary()),
                                          pa.array([True])], schema=kind)

    stored = written(docs.mapInArrow(vectors, "doc_id long, n long, vector binary, tally boolean"), f"{folder}/vectors")

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.value) + 2, np.int64)
        for batch in batches:
            for body in batch.column(0):
                total += np.frombuffer(body.as_buffer(), "<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    totals = np.zeros(len(vocabulary) + 2, np.int64)
    for r in stored.where("tally").select("vector").mapInArrow(unfold, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        totals[r["at"]] = r["n"]  # at most one row for each term of the items
    n_docs, n_terms, df = int(totals[0]), int(totals[1]), totals[2:]
    order = np.argsort(-df, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    asked = []
    for text, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own, times = np.unique(np.searchsorted(vocabulary, hashes[a:b]), return_counts=True)
        asked.append(Item(hashlib.sha256(text.encode()).hexdigest(), place[own], weights[own] * times))
    shared = spark.sparkContext.broadcast((place, asked))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, asked = shared.value
        zeros = np.zeros(len(place), np.int64)
        best = [Best(k) for _ in asked]
        for ids, n, bodies in gathered(batches):
            size = np.fromiter((len(x) // 8 for x in bodies), np.int64, len(bodies))
            cut = np.concatenate([[0], np.cumsum(size)])
            both = [np.frombuffer(x, "<u4").reshape(2, -1) for x in bodies]
            term, tf = place[np.concatenate([x[0] for x in both])], np.concatenate([x[1] for x in both]).astype(np.int64)
            order = np.argsort(np.repeat(np.arange(len(ids)), size) * len(place) + term)
            tree = Tree(ids, 75 + (25 * n * n_docs) // n_terms, cut, term[order], tf[order])
            for item, own in zip(asked, best, strict=True):
                tree.search(item, own, zeros)
        rows = [(item.key, -minus, score) for item, own in zip(asked, best, strict=True) for score, minus in own.heap]
        part = TaskContext.get().partitionId() % PARTS
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([part] * len(rows), pa.int32()),
                                          pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                                         names=["key", "part", "id", "score"])
        tidy()

    found = stored.where("NOT tally").select("doc_id", "n", "vector").mapInArrow(find, "key string, part int, id long, score long")
    by = [F.desc("score"), F.asc("id")]
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("key", "part").orderBy(*by))).where(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*by))).where(F.col("rank") <= k)
    return last.select("key", "rank", F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "score")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Documents for one tree after the other: ids, lengths, vectors."""
    ids, n, bodies, entries = [], [], [], 0
    for batch in batches:
        for i, own, body in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            ids.append(NO_ID if i is None else i)
            n.append(own)
            bodies.append(body)
            entries += len(body) // 8
            if len(ids) >= TREE_ROWS or entries >= TREE_ENTRIES:
                yield np.array(ids, np.int64), np.array(n, np.int64), bodies
                ids, n, bodies, entries = [], [], [], 0
    if ids:
        yield np.array(ids, np.int64), np.array(n, np.int64), bodies
