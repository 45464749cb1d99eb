"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal (operator 3).

Features are n-grams of words and n-grams of word shapes (letters, capitals,
digits and signs with runs collapsed), and the number of words in coarse
steps, hashed into ``2**bits`` weights. A
feature's value is its share of the text's n-grams of its kind, so a score
is a sparse dot product of counts and weights. Training updates weights by
the follow-the-regularised-leader rule with per-coordinate rates; it runs
in one task on at most about ``max_rows`` labelled rows (the one documented
bound of this module), and only the weights (bounded by ``bits``) travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.shared import blocks, boxed, mix, nullable, tidy, unboxed
from auditlens.llm.words import Words, inverse, powers
from auditlens.session import ship_module

MAX_ROWS = 10_000
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("a"):ord("z") + 1] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")
_BASE = 0x9FB21C651E98DF25


def shapes(words: Words) -> np.ndarray:
    """Hashes of the words' shapes: ``Thed,###`` and ``Onea.#`` have the shapes ``Aa,#`` and ``Aa.#``."""
    shape = _SHAPE[words.data]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[words.starts] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    values = (shape[keep].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values) * powers(_BASE, len(values)))])
    a, b = kept[words.starts], kept[words.ends]
    return mix((sums[b] - sums[a]) * powers(inverse(_BASE), len(values) + 1)[a])


def features(column: pa.Array, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each kind of n-gram the hashed features of all texts, and each feature's text."""
    words = Words(column, lower=False)
    text = words.doc_of_word()
    plain, shape = words.hashes, shapes(words)
    same = np.zeros(len(plain), np.uint64)
    same[1:] = (plain[1:] == plain[:-1]) & (text[1:] == text[:-1])
    top = np.uint64(64 - bits)
    out: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    for kind, source, n in ((1, plain, 1), (2, plain, 2), (3, shape, 1), (4, shape, 2), (5, shape, 3), (6, same, 2)):
        m = max(0, len(source) - n + 1)
        h = np.full(m, kind, np.uint64)
        for i in range(n):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + source[i:i + m])
        whole = text[:m] == text[n - 1:n - 1 + m]
        out.append((h[whole] >> top).astype(np.int64))
        owners.append(text[:m][whole])
    counts = words.counts()
    level = np.where(counts <= 8, counts, 8 + np.log2(np.maximum(counts, 1)).astype(np.int64)).astype(np.uint64)
    out.append((mix(np.uint64(7 << 32) + level) >> top).astype(np.int64))
    owners.append(np.arange(len(counts)))
    return out, owners


def sparse(found: list[np.ndarray], owners: list[np.ndarray], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct features and their values."""
    cuts = [np.searchsorted(o, np.arange(rows + 1)) for o in owners]
    for r in range(rows):
        at, value = [], []
        for f, cut in zip(found, cuts, strict=True):
            own = f[cut[r]:cut[r + 1]]
            if len(own):
                index, n = np.unique(own, return_counts=True)
                at.append(index)
                value.append(n / len(own))
        yield (np.concatenate(at), np.concatenate(value)) if at else (np.zeros(0, np.int64), np.zeros(0))


class Ftrl:
    """FTRL-proximal logistic regression with a bias that is not regularised."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.size = size

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        at, value = np.append(at, self.size), np.append(value, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-float(w @ value))) - label) * value
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = 18, epochs: int = 3,
        max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights (``2**bits`` and the bias) learned from the documents that ``labels`` marks.

    Rows without id or label are left out; of several labels for one id the
    majority counts (a tie: 1). Above ``max_rows`` labelled ids, those are
    taken whose hash is smallest in share. Without any labels all weights are 0.
    """
    spark = docs.sparkSession
    ship_module(spark)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("_y")).dropna()
    known = known.groupBy("doc_id").agg((F.avg("_y") >= 0.5).cast("int").alias("_y"))
    n = known.count()
    share = min(1.0, max_rows / max(n, 1))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))  # about max_rows ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id").select("text", "_y", F.xxhash64("doc_id", "text").alias("_o"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for block in blocks(batches, "text"):
            found, owners = features(block.column(0), bits)
            examples += [(a.astype(np.int32), v.astype(np.float32), y) for (a, v), y in zip(
                sparse(found, owners, block.num_rows), block.column(1).to_pylist(), strict=True)]
        model = Ftrl(1 << bits)
        for _ in range(epochs):
            for at, value, y in examples:
                model.learn(at, value, y)
        weights = model.weights(slice(None)).astype("<f4")
        del examples, model
        tidy()
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])

    fitted = rows.repartition(1).sortWithinPartitions("_o").mapInArrow(train, "weights binary").collect()
    return np.frombuffer(fitted[0][0], "<f4") if fitted else np.zeros((1 << bits) + 1, "<f4")


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on).

    Every row keeps its columns, whatever they are called (columns of the two names are replaced). A
    null or empty text has no n-grams and is scored by its length alone.
    """
    spark = docs.sparkSession
    ship_module(spark)
    docs = docs.drop("score", "predicted")
    held = boxed(docs)
    shared = spark.sparkContext.broadcast(weights)
    bits = (len(weights) - 1).bit_length() - 1

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for block in blocks(batches, "text"):
            found, owners = features(block.column(block.schema.get_field_index("text")), bits)
            total = np.full(block.num_rows, w[-1])
            for f, o in zip(found, owners, strict=True):
                n = np.bincount(o, minlength=block.num_rows)
                total += np.bincount(o, w[f], minlength=block.num_rows) / np.maximum(n, 1)
            p = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=[*block.schema.names, "score", "predicted"])

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    scored = held.mapInArrow(judge, T.StructType([*nullable(held.schema).fields, *added]))
    return unboxed(scored, docs.columns, F.col("score"), F.col("predicted"))
