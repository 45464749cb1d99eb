"""Token files: frequency-ranked ids in byte-aligned variable-length code (operator 4).

Method: ids are replaced by their rank in the corpus' frequencies (rank 0
is the most frequent id), so that frequent ids need one byte. A number of
one to four bytes is written without leading zero bytes; its length minus
one goes as two bits into a separate run of control bytes (four numbers to
a control byte). Decoding looks each control byte up in a table of 256 rows
and reads all numbers of a block with a few numpy operations.

Files, all little-endian, in a folder of shared storage:

* ``vocabulary``: Parquet (rank, id, n), at most one row per id of the vocabulary.
* ``data/<number>-<attempt>.bin``: ``FREQ`` + version byte, then blocks. A block
  is a header of five unsigned 32-bit numbers (documents, tokens, control
  bytes, data bytes, 0), the documents' ids (signed 64-bit), a byte for each
  document (1: its id is null), their token counts (unsigned 32-bit), the
  control bytes and the data bytes.
* ``manifest``: Parquet (number, file, documents, tokens), one row per file. Only files
  named here count, so a task that ran twice does no harm.

Files hold documents in ascending doc_id order (null ids first), file after file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.llm.shared import blocks, filesystem, run_folder, slots, written
from auditlens.llm.tokens import encoder

MAGIC = b"FREQ\x01"
BLOCK_TOKENS = 1 << 20
#: For each control byte the lengths of its four numbers.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = numbers.astype("<u4")
    size = 1 + (numbers > 0xFF) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    codes = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    codes[:len(numbers)] = size - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    spread = numbers.view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), spread[np.arange(4) < size[:, None]].tobytes()


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of control and data bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(size)
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    at = ends - size
    out = np.zeros(n, np.uint32)
    for k in range(4):
        out |= padded[at + k].astype(np.uint32) << np.uint32(8 * k)
    return out & _MASKS[size - 1]


def write_token_files(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = 2, text: str = "text",
                      doc_id: str = "doc_id", files: int | None = None) -> str:
    """Writes the ids of all texts (null: empty), each with ``end_id``; returns the folder.

    Null doc_ids come first, repeated rows are written as often as they
    occur (rows of one doc_id in the order of their ids), other columns are
    left out; an empty table gives a folder without data files.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "tokens")
    size = len_of_vocabulary(vocabulary)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, counts = encoder(vocabulary), np.zeros(max(size, end_id + 1), np.int64)
        for block in blocks(batches, "text"):
            ids, bounds = enc.encode(block.column(1))
            counts += np.bincount(ids, minlength=len(counts))
            counts[end_id] += block.num_rows
            narrow = ids.astype("<u2" if len(counts) <= 1 << 16 else "<u4")
            yield rows(block.column(0), [narrow[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        if counts.any():
            yield rows(pa.array([None], pa.int64()), [b""], counts.astype("<i8").tobytes())

    def rows(ids: pa.Array, bodies: list[bytes], counts: bytes | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, pa.array(bodies, pa.binary()),
                                           pa.array([counts] * len(bodies), pa.binary())], names=["doc_id", "ids", "counts"])

    encoded = written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
                      .mapInArrow(tokenize, "doc_id long, ids binary, counts binary"), f"{folder}/work/ids")

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for x in batch.column(0):
                one = np.frombuffer(x.as_py(), "<i8")
                total = one + total if len(total) <= len(one) else total
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids])], names=["id", "n"])

    counted = encoded.where("counts is not null").select("counts").mapInArrow(unfold, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))
    ranks = counted.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).alias("rank"), "id", "n")
    ranks = written(ranks, f"{folder}/vocabulary")  # one row per id of the vocabulary at most
    ranking = spark.sparkContext.broadcast(rank_array(ranks, max(size, end_id + 1)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, rank = TaskContext.get(), ranking.value
        number = context.partitionId()
        name = f"data/{number:08d}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}.bin"
        store, root = filesystem(folder)
        out, documents, tokens = None, 0, 0
        for ids, nulls, bodies in gathered(batches):
            if out is None:
                store.create_dir(f"{root}/data", recursive=True)
                out = store.open_output_stream(f"{root}/{name}")
                out.write(MAGIC)
            each = [np.append(np.frombuffer(b, "<u2" if len(rank) <= 1 << 16 else "<u4"), end_id) for b in bodies]
            counts = np.fromiter(map(len, each), "<u4", len(each))
            control, data = encode_numbers(rank[np.concatenate(each)])
            out.write(np.array([len(each), counts.sum(), len(control), len(data), 0], "<u4").tobytes())
            for part in (ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), counts.tobytes(), control, data):
                out.write(part)
            documents, tokens = documents + len(each), tokens + int(counts.sum())
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"number": [number], "file": [name], "documents": [documents], "tokens": [tokens]})

    n = files or slots(spark)
    ordered = encoded.where("counts is null").select("doc_id", "ids").repartitionByRange(n, "doc_id").sortWithinPartitions(
        "doc_id", "ids")
    written(ordered.mapInArrow(write, "number long, file string, documents long, tokens long"), f"{folder}/manifest")
    return folder


def len_of_vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def rank_array(ranks: DataFrame, size: int) -> np.ndarray:
    """The rank of each id (bounded by the vocabulary)."""
    out = np.zeros(size, np.uint32)
    for row in ranks.select("id", "rank").collect():
        out[row["id"]] = row["rank"]
    return out


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Documents in runs of about BLOCK_TOKENS tokens: ids, null flags, bodies."""
    ids: list[int] = []
    nulls: list[bool] = []
    bodies: list[bytes] = []
    size = 0
    for batch in batches:
        for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(doc if doc is not None else 0)
            nulls.append(doc is None)
            bodies.append(body)
            size += len(body)
            if size >= 2 * BLOCK_TOKENS:
                yield np.array(ids, np.int64), np.array(nulls), bodies
                ids, nulls, bodies, size = [], [], [], 0
    if ids:
        yield np.array(ids, np.int64), np.array(nulls), bodies


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of a folder of token files: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids (binary, unsigned 32-bit)."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    ranks = spark.read.parquet(f"{folder}/vocabulary")
    size = (ranks.agg(F.max("rank")).first()[0] or 0) + 1
    lookup = np.zeros(size, "<u4")
    for row in ranks.select("id", "rank").collect():  # bounded by the vocabulary
        lookup[row["rank"]] = row["id"]
    shared = spark.sparkContext.broadcast(lookup)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        ids_of = shared.value
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(f"{root}/{name}") as f:
                    if f.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"{name} is no token file")
                    while head := f.read(20):
                        docs, tokens, control, data, _ = np.frombuffer(head, "<u4").tolist()
                        doc_ids = np.frombuffer(f.read(8 * docs), "<i8")
                        nulls = np.frombuffer(f.read(docs), np.uint8).astype(bool)
                        counts = np.frombuffer(f.read(4 * docs), "<u4").astype(np.int64)
                        ids = ids_of[decode_numbers(f.read(control), f.read(data), tokens)]
                        bounds = np.concatenate([[0], np.cumsum(counts)])
                        bodies = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                        columns = [pa.array(doc_ids, pa.int64(), mask=nulls), pa.array(start + bounds[:-1]), pa.array(counts),
                                   pa.array([zlib.crc32(b) for b in bodies], pa.int64())]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            columns.append(pa.array(bodies, pa.binary()))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(columns, names=names)
                        start += tokens

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return files.repartition(max(1, min(manifest.count(), 10_000)), "file").mapInArrow(read, schema)
