"""Removal of repeated word passages by fixed-block anchors (operator 8).

Method: every text is cut into reference blocks of ``anchor`` words that do
not overlap, and the blocks' hashes are indexed. Every rolling window of
``anchor`` words probes the index. As ``anchor`` is at most (window + 1) / 2,
a window of ``window`` words contains a whole block wherever it stands, so
a passage that occurs twice is hit in at least one place. The windows around
hits are extended: their full hashes are held against those of all other
hits, which leaves exactly the windows that occur elsewhere, and consecutive
ones are the maximal exact repeats. Words under such a window go.

Index and probes meet through ``chunks``: no text is shuffled, nothing is
compared pair by pair, and a passage that a third of all texts hold costs
one entry for each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.chunks import CHUNK_BYTES, FAN, Chunks, answers_at
from auditlens.llm.shared import blocks, boxed, places, run_folder, unboxed
from auditlens.llm.words import Words

WINDOW = 35
SLOT_BYTES = 12 << 20  # of text for each slot of the index


def columns_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return blocks([batch], "text")


def text_of(block: pa.RecordBatch) -> pa.Array:
    return block.column(block.schema.get_field_index("text"))


def place(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each hash and 32 bits of its place in the slot's range."""
    wide = hashes & np.uint64(0xFFFFFFFF)
    wide *= np.uint64(slots)
    wide >>= np.uint64(32)
    high = hashes >> np.uint64(32)
    high *= np.uint64(slots)
    wide += high
    rest = wide.astype(np.uint32)
    wide >>= np.uint64(32)
    return wide.view(np.int64), rest


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int | None = None, folder: str | None = None,
                   chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (the words that stay, joined by one space).

    Every row stays, with its other columns (columns of the added names are
    replaced). Null and empty texts have no words and an empty kept_text.
    Repeated rows repeat each other, so all their windows go. Windows are
    judged on the input, not on what is left.
    """
    anchor = anchor or (window + 1) // 2
    if not 0 < 2 * anchor <= window + 1:
        raise ValueError("a window must hold a whole anchor block wherever it stands: anchor <= (window + 1) / 2")
    folder = folder or run_folder(docs.sparkSession, "repeats")
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    chunks = Chunks(boxed(docs), folder, chunk_bytes, fan=fan)
    slots = max(1, -(-chunks.count * chunk_bytes // SLOT_BYTES))

    def probes(chunk: int, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """All rolling windows' hashes, those of reference blocks marked."""
        found, blocks_ = [], []
        for block in columns_of(batch):
            words = Words(text_of(block), lower=False)
            at, hashes = words.windows(anchor)
            found.append(hashes)
            blocks_.append((at - words.bounds[words.doc_of_word()[at]]) % anchor == 0)
        slot, rest = place(np.concatenate(found), slots)
        del found
        key = slot.view(np.uint64)  # in place: these are the largest arrays of the operator
        key <<= np.uint64(33)
        rest = rest.astype(np.uint64)
        rest <<= np.uint64(1)
        key |= rest
        key |= ~np.concatenate(blocks_)
        del slot, rest, blocks_
        key.sort()
        whole = key >> np.uint64(1)
        first = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]])) if len(key) else np.zeros(0, np.int64)
        many = np.diff(np.append(first, len(key))) > 1
        indexed = (key[first] & np.uint64(1)) == 0  # a block's key sorts before the same key without a block
        whole = whole[first]
        flags = indexed.astype(np.uint8) | many.astype(np.uint8) << 1
        return (whole >> np.uint64(32)).astype(np.int64), whole.astype("<u4"), flags

    def hits(slot: int, owner: np.ndarray, owners: int, fields: tuple) -> tuple[np.ndarray, np.ndarray, None]:
        """For each chunk its hashes that the index holds and that occur twice at least."""
        value, flags = fields
        order = np.argsort(value, kind="stable")
        value, flags = value[order], flags[order]
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        size = np.diff(np.append(first, len(value)))
        seen = np.bitwise_or.reduceat(flags, first)
        good = np.repeat((seen & 1 > 0) & ((size > 1) | (seen & 2 > 0)), size)
        return (*by_owner(owner[order][good], value[good]), None)

    first = chunks.ask("anchors", slots, probes, ("<u4", "u1"), hits, "<u4")
    anchors = first.path

    def extended(chunk: int, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Full hashes of the windows that contain a hit."""
        own, rest = answers_at(anchors, "<u4").of(chunk)
        if not len(rest):
            return np.zeros(0, np.int64), np.zeros(0, "<u8"), np.zeros(0, np.uint8)
        known = np.sort(own.astype(np.uint64) << np.uint64(32) | rest.astype(np.uint64))
        full = []
        for block in columns_of(batch):
            words = Words(text_of(block), lower=False)
            at, hashes = words.windows(anchor)
            slot, rest = place(hashes, slots)
            hit = np.zeros(len(words) + 1, np.int64)
            hit[at + 1] = member(known, slot.astype(np.uint64) << np.uint64(32) | rest)
            upto = np.cumsum(hit)
            starts, whole = words.windows(window)
            full.append(whole[upto[starts + window - anchor + 1] > upto[starts]])
        value, n = np.unique(np.concatenate(full), return_counts=True)
        return place(value, slots)[0], value.astype("<u8"), (n > 1).astype(np.uint8)  # sorted by hash, so by slot

    def repeats(slot: int, owner: np.ndarray, owners: int, fields: tuple) -> tuple[np.ndarray, np.ndarray, None]:
        """For each chunk its windows that occur twice at least."""
        value, many = fields
        order = np.argsort(value, kind="stable")
        value = value[order]
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        size = np.diff(np.append(first, len(value)))
        good = np.repeat((size > 1) | (np.bitwise_or.reduceat(many[order], first) > 0), size)
        return (*by_owner(owner[order][good], value[good]), None)

    second = chunks.ask("windows", slots, extended, ("<u8", "u1"), repeats, "<u8")

    def cut(chunk: int, batch: pa.RecordBatch, _, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        known = np.sort(found)
        for block in columns_of(batch):
            words = Words(text_of(block), lower=False)
            gone = np.zeros(len(words), bool)
            if len(known):
                at, hashes = words.windows(window)
                at = at[member(known, hashes)]
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                gone = np.cumsum(change)[:-1] > 0
            removed = np.concatenate([[0], np.cumsum(gone)])[words.bounds]
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(words.counts().astype(np.int64)), pa.array(np.diff(removed).astype(np.int64)),
                 kept_words(words, ~gone)], names=[*block.schema.names, "n_words", "n_removed", "kept_text"])

    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
             T.StructField("kept_text", T.StringType())]
    return unboxed(chunks.map(cut, added, second), columns, *(F.col(f.name) for f in added))


def by_owner(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(owner, kind="stable")
    return owner[order], value[order]


def member(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    at = np.minimum(places(known, values), len(known) - 1)
    return known[at] == values


def kept_words(words: Words, keep: np.ndarray) -> pa.Array:
    """The texts of the kept words, joined by one space."""
    data = words.data.copy()
    mask = np.zeros(len(data) + 1, np.int64)
    starts, ends = words.starts[keep], words.ends[keep]
    mask[starts] += 1
    mask[ends] -= 1
    mask = np.cumsum(mask)[:-1] > 0 if len(data) else np.zeros(0, bool)
    text = words.doc_of_word()[keep]
    later = np.zeros(len(starts), bool)
    later[1:] = text[1:] == text[:-1]
    before = starts[later] - 1  # white space, as a word of the same text stands before it
    data[before] = 0x20
    mask[before] = True
    offsets = np.concatenate([[0], np.cumsum(mask)])[words.offsets].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[mask])])
