"""Byte-level BPE by a global shuffle of distinct words (operator 12).

Encoding: the texts are taken in blocks of some megabytes. A block is split
into pre-tokens ("words"); it keeps the word number at every position and
sends its *distinct* words, dealt by hash into groups, through a shuffle. A
group sees the words of all blocks, merges each distinct one once and answers
each block with the ids of the words it asked for; the answers meet the
block's positions again (a second shuffle), and the ids of every text are
put together by position. No text is shuffled, a word that is frequent in a
block travels once, and a group is about ``GROUP_BYTES`` of words whatever
the size of the corpus: the groups grow in number.

Decoding: ids are joined with the table of the tokens' bytes, which is as
large as the vocabulary and so goes to every executor, and the bytes of a
text are gathered by position.

Words are split as the rank files' pattern says: runs of letters, of numbers
or of other signs, each with one blank before it, the endings ``'s 't 're
've 'm 'll 'd``, and runs of white space. Here the runs are found for a whole
block at once from the classes of its code points.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.shared import blocks, held, mix, nullable, run_folder, text_bytes, slots, tidy
from auditlens.llm.words import inverse, powers

BLOCK_TEXT = 16 << 20  # bytes of text that share one list of distinct words
GROUP_BYTES = 8 << 20  # bytes of distinct words that one group answers
LEAST_GROUPS = 64
_BASE = 0xC2B2AE3D27D4EB4F
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SHIFT = 24  # block = task << 24 | number within the task
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Letters after an apostrophe that make a word of their own (fixed values of the pattern).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class Classes:
    """The class of every code point, as the tiktoken library has it.

    Newer Unicode versions have letters and numbers that the library may not
    know yet; those that Python doesn't know are tried with the library.
    """

    def __init__(self):
        import unicodedata

        import regex
        import tiktoken

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        self.table = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
            found = regex.findall(pattern, every)
            new = [c for c in found if unicodedata.category(c) == "Cn"]
            if new:
                own = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
                unknown = {c for c in new if not own.encode_ordinary(c)}
                found = [c for c in found if c not in unknown]
            self.table[np.fromiter(map(ord, found), np.int64, len(found))] = kind


def classes() -> Classes:
    return held("code point classes", Classes)


def split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a block, first bytes of its words and the end of the last one, and each text's bounds in them."""
    data, offsets = text_bytes(column)
    point = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    kind = classes().table[point]
    size = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
    at = np.concatenate([[0], np.cumsum(size)])
    if at[-1] != len(data):  # no valid UTF-8: one text at a time, repaired
        fixed = pa.array([t.decode("utf-8", "replace") for t in column.fill_null("").cast(pa.binary()).to_pylist()], pa.string())
        return split(fixed)
    n = len(point)
    begin = np.searchsorted(at, offsets)  # code points before each text
    if not n:
        return data, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    opens = np.ones(n + 1, bool)  # a word begins here
    opens[1:n] = kind[1:] != kind[:-1]
    opens[begin] = True
    run = np.flatnonzero(opens)  # runs of one class within one text; the last is the end
    first, last = run[:-1], run[1:] - 1
    text_end = np.zeros(n + 1, bool)
    text_end[begin] = True
    space = kind[first] == SPACE
    inner = space & ~text_end[last + 1]  # white space before something else of the text
    blank = inner & (point[last] == 0x20)
    # of such a run the last sign stands apart; a blank belongs to the word after it
    opens[last[inner]] = True
    opens[(last + 1)[blank]] = False
    # endings: an apostrophe alone (no blank before it), then letters
    quote = (point[first] == 0x27) & (last == first) & ~text_end[np.minimum(last + 1, n)] & opens[first]
    quote = first[quote]
    quote = quote[kind[np.minimum(quote + 1, n - 1)] == LETTER]
    if len(quote):
        one, two = point[quote + 1], np.where(quote + 2 < n, point[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(text_end[np.minimum(quote + 2, n)], 0, two)
        length = np.zeros(len(quote), np.int64)
        for ending in ENDINGS:
            hit = one == ord(ending[0])
            if len(ending) == 2:
                hit &= two == ord(ending[1])
            length[hit & (length == 0)] = len(ending)
        quote, length = quote[length > 0], length[length > 0]
        opens[quote + 1] = False
        after = quote + 1 + length
        follows = (after < n) & ~text_end[np.minimum(after, n)]
        opens[after[follows & (kind[np.minimum(after, n - 1)] == LETTER)]] = True
    starts = np.flatnonzero(opens[:n])
    return data, np.append(at[starts], len(data)), np.searchsorted(starts, begin)


def hashes_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words (``starts`` ends with the end of the last)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[starts[1:]] - sums[starts[:-1]]) * powers(inverse(_BASE), len(data) + 1)[starts[:-1]])


class Ranks:
    """The merges of a rank file (given as its bytes)."""

    def __init__(self, file: bytes):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines()) if token}

    def encode(self, word: bytes) -> list[int]:
        """Ids of a word: the adjacent pair of the lowest rank (the leftmost of equals) is merged until none is left."""
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        ends = list(range(1, n + 1))  # end of the part that begins at each place
        before = list(range(-1, n - 1))
        alive = bytearray(b"\1" * n)
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, end = heapq.heappop(queue)
            middle = ends[i]
            if not alive[i] or middle >= n or ends[middle] != end:
                continue  # one of its parts was merged meanwhile
            alive[middle] = 0
            ends[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(word[i:ends[end]])) is not None:
                    heapq.heappush(queue, (r, i, ends[end]))
            j = before[i]
            if j >= 0 and (r := ranks.get(word[j:end])) is not None:
                heapq.heappush(queue, (r, j, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i:ends[i]]])
            i = ends[i]
        return out


class TokenBytes:
    """The bytes of every id, one after the other."""

    def __init__(self, file: bytes):
        ranks = Ranks(file).ranks
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.known = np.zeros(len(tokens), bool)
        self.known[np.fromiter(ranks.values(), np.int64, len(ranks))] = True
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids one after the other, and the bounds of each id's bytes."""
        if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id that the vocabulary does not have")
        size = self.size[ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        return self.data[np.repeat(self.start[ids] - upto[:-1], size) + np.arange(upto[-1])], upto


def squeezed(*arrays: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, each array byte by byte, compressed."""
    body = b"".join(np.ascontiguousarray(a, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays)
    return np.array([len(a) for a in arrays], "<u4").tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def stretched(body: pa.Buffer, arrays: int) -> list[np.ndarray]:
    sizes = np.frombuffer(body, "<u4", arrays).tolist()
    data = np.frombuffer(pa.decompress(body.slice(4 * arrays), 4 * sum(sizes), codec="zstd"), np.uint8)
    out, at = [], 0
    for n in sizes:
        out.append(np.ascontiguousarray(data[at:at + 4 * n].reshape(4, n).T).view("<u4").ravel())
        at += 4 * n
    return out


def listed(words: list[bytes]) -> bytes:
    """Words with their lengths, compressed."""
    lengths = squeezed(np.fromiter(map(len, words), np.int64, len(words)))
    body = b"".join(words)
    return np.array([len(lengths), len(body)], "<u4").tobytes() + lengths + pa.compress(body, codec="zstd", asbytes=True)


def unlisted(body: pa.Buffer) -> list[bytes]:
    head, size = np.frombuffer(body, "<u4", 2).tolist()
    ends = np.cumsum(stretched(body.slice(8, head), 1)[0].astype(np.int64)).tolist()
    data = pa.decompress(body.slice(8 + head), size, codec="zstd", asbytes=True)
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Block:
    """Texts taken together: the word at every position, the distinct words, the other columns."""

    def __init__(self):
        self.bytes, self.known, self.words, self.spots, self.counts, self.rows = 0, [], [], [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        data, starts, bounds = split(batch.column(batch.schema.get_field_index("text")))
        new, first, spots = np.unique(hashes_of(data, starts), return_index=True, return_inverse=True)
        body = data.tobytes()
        self.words += [body[a:b] for a, b in zip(starts[first].tolist(), starts[first + 1].tolist(), strict=True)]
        self.known.append(new)
        self.spots.append(spots.astype(np.uint32))
        self.counts.append(np.diff(bounds))
        self.rows.append(batch.select([i for i, name in enumerate(batch.schema.names) if name != "text"]))
        self.bytes += len(data) + self.rows[-1].nbytes

    def sent(self, number: int, groups: int) -> Iterator[tuple[int, int, bytes]]:
        """Rows (group, block, payload): the positions (group -1), and the words by group."""
        key, first, back = np.unique(np.concatenate(self.known), return_index=True, return_inverse=True)
        group = (key % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cut = np.searchsorted(group[order], np.arange(groups + 1)).tolist()
        words, first = self.words, first.tolist()
        for g, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if b > a:
                mine = sorted(order[a:b].tolist(), key=lambda k: words[first[k]])  # alike words compress well
                order[a:b] = mine
                yield g, number, listed([words[first[k]] for k in mine])
        place = np.empty(len(key), np.uint32)  # of each word in the list of all answers
        place[order] = np.arange(len(key))
        place, at, spots = place[back], 0, []
        for new, own in zip(self.known, self.spots, strict=True):
            spots.append(place[at:at + len(new)][own])
            at += len(new)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for batch in self.rows:
                out.write_batch(batch)
        kept = sink.getvalue().to_pybytes()
        yield -1, number, np.array([len(kept)], "<u8").tobytes() + kept + squeezed(np.concatenate(self.counts), np.concatenate(spots))


def bucketed(df: DataFrame, path: str, buckets: int, key: str) -> DataFrame:
    """``df`` written at ``path`` in buckets of ``key``, which later joins on the key need not shuffle."""
    spark, name = df.sparkSession, f"blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("compression", "zstd").option("path", path).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and ``found`` knows them
    return found


def carried(docs: DataFrame) -> DataFrame:
    """``text`` as it is, all other columns in one struct."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(True).alias("_")]
    return docs.select(F.col("text").cast("string").alias("text"), F.struct(*others).alias("row"))


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file for every executor (bounded by the vocabulary, whatever the data)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, folder: str | None = None, block_bytes: int = BLOCK_TEXT,
           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit numbers) in place of ``text``.

    ``path``: a rank file (base64 token and rank a line). A null or empty text has no ids. Every row stays with its
    other columns, repeated rows and null ids too; columns named n_tokens or ids are replaced; an empty table gives
    no rows. Very long texts: a worker holds one whole text at a time, with about thirty times its bytes; a word of
    any length is merged in n log n steps. Bytes that are no UTF-8 count as the replacement sign.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "bpe")
    columns = [c for c in docs.columns if c not in ("text", "n_tokens", "ids")]
    file = vocabulary(spark, path)
    # groups: the texts' bytes say how many words there can be, a seventh of them at most being distinct ones
    size = int(docs.select(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0)
    groups = max(LEAST_GROUPS, -(-size // (7 * group_bytes)))
    row = docs.select(*(F.col(f"`{c}`") for c in columns), "text")
    boxed = carried(row)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _SHIFT
        block = Block()

        def rows() -> Iterator[pa.RecordBatch]:
            for some in block.sent(number, groups):
                yield pa.RecordBatch.from_arrays([pa.array([some[0]], pa.int32()), pa.array([some[1]], pa.int64()),
                                                  pa.array([some[2]], pa.binary())], names=["group", "block", "payload"])

        for batch in blocks(batches, "text"):
            block.add(batch)
            if block.bytes >= block_bytes:
                yield from rows()
                block, number = Block(), number + 1
        if block.rows:
            yield from rows()

    schema = "group int, block long, payload binary"
    asked = bucketed(boxed.mapInArrow(ask, schema), f"{folder}/blocks", slots(spark), "block")

    def answer(table: pa.Table) -> pa.Table:
        ranks = held(f"ranks of {path}", lambda: Ranks(file.value))
        tidy()  # a worker has one group or block after another
        known: dict[bytes, int] = {}
        lists: list[list[int]] = []
        out = []
        for body in table.column("payload"):
            mine = []
            for word in unlisted(body.as_buffer()):
                k = known.get(word)
                if k is None:
                    k = known[word] = len(lists)
                    lists.append(ranks.encode(word))
                mine.append(lists[k])
            sizes = np.fromiter(map(len, mine), np.int64, len(mine))
            out.append(squeezed(sizes, np.fromiter((i for ids in mine for i in ids), np.int64, int(sizes.sum()))))
        return pa.table({"group": table.column("group").cast(pa.int32()), "block": table.column("block"), "payload": pa.array(out, pa.binary())})

    answers = asked.where("group >= 0").groupBy("group").applyInArrow(answer, schema)
    added = T.StructType([*nullable(boxed.select("row").schema).fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def assemble(block: pa.Table, answered: pa.Table) -> pa.Table:
        tidy()
        body = block.column("payload")[0].as_buffer()
        kept = int(np.frombuffer(body, "<u8", 1)[0])
        rows = pa.ipc.open_stream(body.slice(8, kept)).read_all()
        counts, spots = stretched(body.slice(8 + kept), 2)
        got = [stretched(x.as_buffer(), 2) for x in answered.sort_by("group").column("payload")]
        sizes = np.concatenate([np.zeros(0, np.int64), *(s for s, _ in got)]).astype(np.int64)
        ids = np.concatenate([np.zeros(0, "<u4"), *(i for _, i in got)]).astype("<u4")
        starts = np.cumsum(sizes) - sizes
        ends = np.cumsum(counts.astype(np.int64))
        n_of, ids_of = [], []
        for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            at = spots[a:b]
            upto = np.concatenate([[0], np.cumsum(sizes[at])])
            own = ids[np.repeat(starts[at] - upto[:-1], sizes[at]) + np.arange(upto[-1])]
            n_of.append(len(own))
            ids_of.append(own.tobytes())
        return pa.table({"row": rows.column("row"), "n_tokens": pa.array(n_of, pa.int64()), "ids": pa.array(ids_of, pa.binary())})

    whole = asked.where("group < 0").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(assemble, added)
    return whole.select(*(F.col("row").getField(c).alias(c) for c in columns), "n_tokens", "ids")


def decode(encoded: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids in column ``to``.

    Null ids give null, no ids no bytes; an id that the vocabulary does not have is an error. Rows and other columns
    stay, a column named ``to`` is replaced. A worker holds the bytes of one block of rows at a time.
    """
    file = vocabulary(encoded.sparkSession, path)
    rest = [c for c in encoded.columns if c != to]
    boxed = encoded.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), F.col(f"`{ids}`").alias("ids"))
    schema = T.StructType([*nullable(boxed.select("row").schema).fields, T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held(f"tokens of {path}", lambda: TokenBytes(file.value))
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                column = some.column(at)
                out = [None if x is None else table.join(np.frombuffer(x, "<u4"))[0].tobytes() for x in column.to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(1 - at), pa.array(out, pa.binary())], names=["row", "bytes"])
        tidy()

    found = boxed.mapInArrow(run, schema)
    return found.select(*(F.col("row").getField(c).alias(c) for c in rest), F.col("bytes").alias(to))
