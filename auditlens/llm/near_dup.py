"""Near-duplicates by HyperMinHash (operator 6).

Method: each text's distinct word shingles are dealt to ``bands * rows``
buckets by hash, and each bucket keeps the smallest hash in compressed form:
its leading-zero count and ten mantissa bits (empty buckets borrow from the
bucket that a fixed random order names, so that registers agree with the
probability of the Jaccard similarity for small sets too). Bands of ``rows``
registers are the keys under which texts meet. For texts that meet, the
similarity is estimated from all registers, corrected for the registers that
agree by accident; what is clearly below the threshold is left out, and the
others are confirmed on their full shingle sets.

Texts with equal sets are one class from the start, so copies cost nothing.
Within a band's bucket each class is first held against one class only (the
smallest id of the bucket), never all against all; connected components of
the confirmed links follow. Then the buckets whose classes still lie in
different components are gone through in blocks of bounded size: within a
block the registers of classes of different components are compared as
arrays, and only those whose estimate comes near the threshold are confirmed
on their sets. So no link between components is lost, and no pairs but the
links come out. With the defaults a pair at the threshold meets in no band
with a probability of (1 - 0.75**5)**48, about 2 in a million.

All intermediate tables go to shared storage; nothing but counts and check
sums goes to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.shared import blocks, mix, run_folder, unboxed, written
from auditlens.llm.words import Words, shingles

WORDS = 5
THRESHOLD = 75  # per cent
BANDS, ROWS = 48, 5
MANTISSA = 10
_VALUE_BITS = 40
#: Below this estimate a pair is not confirmed: seven standard errors under the threshold, and room for tiny sets.
ESTIMATE = 0.5
BLOCK = 1024  # classes of a bucket that are compared at once


class Sketcher:
    """Compressed registers of shingle sets."""

    def __init__(self, registers: int):
        self.m = registers
        order = np.random.default_rng(5).random((registers, registers)).argsort(axis=1)
        self.rank = np.empty((registers, registers), np.int16)
        np.put_along_axis(self.rank, order, np.arange(registers, dtype=np.int16)[None, :].repeat(registers, 0), axis=1)

    def registers(self, row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
        """Registers (unsigned 16-bit) of ``rows`` sets; rows without shingles are all zero."""
        h = mix(hashes ^ np.uint64(0x6A09E667F3BCC909))
        bucket = (h % np.uint64(self.m)).astype(np.int64)
        value = mix(h + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _VALUE_BITS)
        none = np.uint64(1 << _VALUE_BITS)
        least = np.full(rows * self.m, none, np.uint64)
        np.minimum.at(least, row * self.m + bucket, value)
        mantissa, exponent = np.frexp(np.maximum(least, 1).astype(np.float64))
        packed = (_VALUE_BITS + 1 - exponent) << MANTISSA | ((2 * mantissa - 1) * (1 << MANTISSA)).astype(np.int64)
        out = packed.astype(np.uint16).reshape(rows, self.m)
        empty = (least == none).reshape(rows, self.m)
        for r in np.flatnonzero(empty.any(axis=1)).tolist():
            gaps, full = np.flatnonzero(empty[r]), np.flatnonzero(~empty[r])
            out[r, gaps] = out[r, full[self.rank[np.ix_(gaps, full)].argmin(axis=1)]] if len(full) else 0
        return out


def by_accident(na: np.ndarray, nb: np.ndarray, m: int) -> np.ndarray:
    """Probability that registers of two sets without common shingles agree."""
    k = np.arange(_VALUE_BITS + 1)

    def octave(n: np.ndarray) -> np.ndarray:
        load = np.maximum(n / m, 1.0)[:, None]
        return (1 - 2.0 ** -(k + 1)) ** load - (1 - 2.0 ** -k) ** load

    return (octave(na) * octave(nb)).sum(axis=1) / (1 << MANTISSA)


def sketch(docs: DataFrame, folder: str, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row_key, n_shingles, set_id (null without words), registers: a row for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands * rows)
        for block in blocks(batches, "text"):
            row, hashes = shingles(Words(block.column(2), lower=True), k)
            registers = sketcher.registers(row, hashes, block.num_rows)
            cut = np.searchsorted(row, np.arange(block.num_rows + 1)).tolist()
            ids = [set_id(hashes[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), pa.array(np.diff(cut), pa.int64()), pa.array(ids, pa.int64()),
                 pa.array([r.tobytes() for r in registers], pa.binary())],
                names=["doc_id", "row_key", "n_shingles", "set_id", "registers"])

    return written(keyed(docs).mapInArrow(run, "doc_id long, row_key long, n_shingles long, set_id long, registers binary"),
                   f"{folder}/sketches")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"),
                       F.col("text").cast("string").alias("text"))


def row_key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def set_id(hashes: np.ndarray) -> int | None:
    """64 bits for a sorted shingle set; none for an empty one."""
    if not len(hashes):
        return None
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def members(classes: DataFrame, folder: str, bands: int, rows: int) -> DataFrame:
    """key, band, set_id, hub: the classes of every bucket that holds at least two; hub is the bucket's smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            parts = registers_of(batch.column(1)).reshape(n, bands, rows).astype(np.uint64)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
            for i in range(rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i] + np.uint64(1))
            ids, band = batch.column(0).to_numpy(), np.arange(bands, dtype=np.int32)
            step = max(1, 200_000 // bands)
            for a in range(0, n, step):
                some = ids[a:a + step]
                yield pa.RecordBatch.from_arrays([pa.array(key[a:a + step].reshape(-1).view(np.int64)), pa.array(np.tile(band, len(some))),
                                                  pa.array(np.repeat(some, bands))], names=["key", "band", "set_id"])

    rows_ = classes.select("set_id", "registers").mapInArrow(run, "key long, band int, set_id long")
    shared = rows_.groupBy("key").agg(F.min("set_id").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    return written(rows_.join(shared, "key"), f"{folder}/members")


def registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def likeness(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard estimates of pairs of sets: the share of equal registers, corrected for those equal by accident."""
    accident = by_accident(na, nb, ra.shape[-1])
    return ((ra == rb).mean(axis=-1) - accident) / (1 - accident)


def promising(pairs: DataFrame, classes: DataFrame, threshold: int, estimate: float) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose estimate comes near it."""
    side = classes.select("set_id", "n_shingles", "registers")
    a = side.select(F.col("set_id").alias("a"), F.col("n_shingles").alias("na"), F.col("registers").alias("ra"))
    b = side.select(F.col("set_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("registers").alias("rb"))
    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = likeness(registers_of(batch.column(4)), registers_of(batch.column(5)), batch.column(2).to_numpy(),
                            batch.column(3).to_numpy())
            yield batch.select([0, 1]).filter(pa.array(near >= estimate))

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def full_sets(ids: DataFrame, docs: DataFrame, classes: DataFrame, folder: str, k: int) -> DataFrame:
    """set_id, hashes: the shingle sets of the classes in ``ids``, made anew from one text of each."""
    wanted = classes.select("set_id", "row_key").join(ids.distinct(), "set_id")
    texts = docs.select(row_key().alias("row_key"), F.col("text").cast("string").alias("text")).join(wanted, "row_key")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            row, hashes = shingles(Words(block.column(1), lower=True), k)
            cut = np.searchsorted(row, np.arange(block.num_rows + 1)).tolist()
            own = [hashes[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
            right = [set_id(s) == i for s, i in zip(own, block.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([s.tobytes() for s in own], pa.binary())],
                                             names=["set_id", "hashes"]).filter(pa.array(right))

    return written(texts.select("set_id", "text").mapInArrow(sets, "set_id long, hashes binary").dropDuplicates(["set_id"]),
                   f"{folder}/sets")


def linked(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= threshold * (len(both) - common)


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, folder: str, k: int, threshold: int) -> DataFrame:
    """Links (a, b) of the pairs whose full sets reach the threshold."""
    pairs = written(pairs, f"{folder}/pairs")
    full = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("set_id")), docs, classes, folder, k)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            link = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), threshold)
                    for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(link, pa.bool_()))

    a = full.select(F.col("set_id").alias("a"), F.col("hashes").alias("ha"))
    b = full.select(F.col("set_id").alias("b"), F.col("hashes").alias("hb"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "ha", "hb")
    return written(joined.mapInArrow(compare, "a long, b long"), f"{folder}/links")


def across(met: DataFrame, found: DataFrame, docs: DataFrame, classes: DataFrame, folder: str, k: int, rows: int,
           threshold: int, estimate: float) -> DataFrame:
    """Links (a, b) of the classes that met and lie in different components of ``found``, as their roots."""
    apart = met.drop("hub").join(found.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id"))
    mixed = apart.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where(
        "lo <> hi and n > 2").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    # a block against each block of its bucket (itself too); buckets of one block stay as they are
    mine = apart.join(mixed, "key").withColumn("mine", F.pmod(F.xxhash64("set_id"), "parts").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    grouped = mine.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "band",
                          F.when(F.col("mine") == F.col("other"), 0).otherwise(F.when(F.col("mine") < F.col("other"), 1).otherwise(2)).alias("side"),
                          "set_id", "root").join(classes.select("set_id", "n_shingles", "registers"), "set_id")

    def near(table: pa.Table) -> pa.Table:
        """The block's classes that come near another of a different component, with those of a larger id."""
        table = table.sort_by("set_id").combine_chunks()
        ids, root, side, size = (table.column(c).to_numpy() for c in ("set_id", "root", "side", "n_shingles"))
        registers = registers_of(table.column("registers").combine_chunks())
        band = table.column("band")[0].as_py()
        partners: dict[int, list[int]] = {}
        for i in range(len(ids)):
            with_ = np.flatnonzero((root[i + 1:] != root[i]) & ((side[i + 1:] == 0) | (side[i + 1:] != side[i]))
                                   & (ids[i + 1:] != ids[i])
                                   & (100 * np.minimum(size[i + 1:], size[i]) >= threshold * np.maximum(size[i + 1:], size[i]))) + i + 1
            if not len(with_):
                continue
            same = registers[with_] == registers[i]
            close = same.mean(axis=1) >= estimate  # before the correction, which only lowers it
            with_, same = with_[close], same[close]
            if not len(with_):
                continue
            close = likeness(registers[with_], registers[i], size[with_], np.broadcast_to(size[i], len(with_))) >= estimate
            # once only, in the first band that the two share
            close &= same.reshape(len(with_), -1, rows).all(axis=2).argmax(axis=1) == band
            for j in with_[close].tolist():
                partners.setdefault(i, []).append(int(ids[j]))
                partners.setdefault(j, [])
        at = sorted(partners)
        return pa.table({"group": pa.array([table.column("group")[0].as_py()] * len(at), pa.int64()),
                         "set_id": pa.array(ids[at], pa.int64()), "root": pa.array(root[at], pa.int64()),
                         "partners": pa.array([partners[i] for i in at], pa.list_(pa.int64()))})

    candidates = written(grouped.groupBy("group").applyInArrow(
        near, "group long, set_id long, root long, partners array<long>"), f"{folder}/candidates")
    full = full_sets(candidates.select("set_id"), docs, classes, folder, k)

    def compare(table: pa.Table) -> pa.Table:
        ids, roots, partners = (table.column(c).to_pylist() for c in ("set_id", "root", "partners"))
        sets = dict(zip(ids, (np.frombuffer(h.as_buffer(), np.uint64) for h in table.column("hashes")), strict=True))
        root = dict(zip(ids, roots, strict=True))
        links = {(root[a], root[b]) for a, own in zip(ids, partners, strict=True) for b in own if linked(sets[a], sets[b], threshold)}
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return written(candidates.join(full, "set_id").groupBy("group").applyInArrow(compare, "a long, b long"), f"{folder}/links")


def components(links: DataFrame, folder: str) -> DataFrame:
    """node, root (the smallest node reachable) of every node that has a link.

    Large-star and small-star steps in turn, until nothing changes: a few
    rounds also for long chains. Each round is written to shared storage.
    """
    def down(edges: DataFrame) -> DataFrame:
        return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = written(down(links.toDF("u", "v")).distinct(), f"{folder}/edges-0")
    before, n = state(edges), 0
    while before[0]:
        n += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = down(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smallest.select("u", F.col("m").alias("v")))
        edges = written(down(small).distinct(), f"{folder}/edges-{n}")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, k: int = WORDS, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    estimate: float = ESTIMATE, folder: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id, row_key: a row for each row of ``docs``.

    component_id is the smallest doc_id of the component; kept is doc_id =
    component_id; class_id is shared by texts with equal shingle sets. Texts
    without words, empty and null ones are components of their own. Null
    ids take part in links but are never a component_id unless all ids of the
    component are null. Repeated rows fall into one class.
    """
    folder = folder or run_folder(docs.sparkSession, "near-dup")
    sketches = sketch(docs, folder, k, bands, rows)
    classes = written(sketches.where("set_id is not null").dropDuplicates(["set_id"]).drop("doc_id"), f"{folder}/classes")
    met = members(classes, folder, bands, rows)
    first = met.where("set_id <> hub").select(F.col("set_id").alias("a"), F.col("hub").alias("b")).distinct()
    links = confirmed(promising(first, classes, threshold, estimate), docs, classes, f"{folder}/first", k, threshold)
    found = written(components(links, f"{folder}/first"), f"{folder}/first/components")
    more = across(met, found, docs, classes, f"{folder}/second", k, rows, threshold, estimate)
    if more.limit(1).count():
        joined = components(more, f"{folder}/second").select(F.col("node").alias("root"), F.col("root").alias("top"))
        found = written(found.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct().select(
            "node", F.col("node").alias("root"))).distinct().join(joined, "root", "left").select(
            "node", F.coalesce("top", "root").alias("root")), f"{folder}/components")
    of_class = sketches.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least")).join(
        found.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    of_root = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_class.join(of_root, "root").select("set_id", "root", "component_id")
    out = sketches.drop("registers").join(named, "set_id", "left")
    own = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"),
                      F.col("set_id").alias("class_id"), "row_key", "root")


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id stays.

    Texts without words all stay. Of rows equal in id and text, one stays.
    """
    spark = docs.sparkSession
    folder = options.pop("folder", None) or run_folder(spark, "near-dup")
    found = written(near_duplicates(docs, folder=folder, **options), f"{folder}/result")
    best = found.where("class_id is not null").groupBy("root").agg(
        F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("row_key"))
    stay = written(best.select("row_key").unionByName(found.where("class_id is null").select("row_key")).distinct(),
                   f"{folder}/stay")
    repeated = found.where("class_id is not null").join(best.select("row_key"), "row_key").groupBy("row_key").count().where(
        "count > 1")
    columns = docs.columns
    kept = docs.select(row_key().alias("row_key"), F.col("text").cast("string").alias("text"),
                       F.struct(*(F.col(f"`{c}`") for c in columns if c != "text"), F.lit(True).alias("_")).alias("row"))
    out = kept.join(stay, "row_key", "left_semi")
    if repeated.limit(1).count():
        words = F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
        out = out.where(~words).unionByName(out.where(words).dropDuplicates(["row_key"]))
    return unboxed(out, columns)
