"""Token ids of whole texts, encoded once per distinct part of a text.

The byte-level vocabularies split a text before every run of white space
that follows other characters, and encode each part by itself. So the ids
of a text are the ids of its parts (white space and the word after it) one
after the other, and a part that was seen before need not be encoded again.
Parts are found, hashed and looked up for a whole block of texts at once.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from auditlens.llm.shared import held, text_bytes
from auditlens.llm.words import Words

#: First bytes of the white space outside ASCII, in UTF-8 (fixed values of the vocabulary's pattern).
_WIDE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", *(b"\xe2\x80" + bytes([x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)),
         b"\xe2\x81\x9f", b"\xe3\x80\x80"]
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class Table:
    """Open-addressed map from 64-bit hashes to runs of ids."""

    def __init__(self, bits: int):
        self.mask = np.int64((1 << bits) - 1)
        self.limit = 1 << (bits - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(int(self.mask) + 1, np.uint64)
        self.slot = np.zeros(int(self.mask) + 1, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.size = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry number of each hash, -1 where it has none."""
        at = (hashes & np.uint64(self.mask)).astype(np.int64)
        held = self.keys[at]
        out = np.where(held == hashes, self.slot[at], -1)
        left = np.flatnonzero((held != hashes) & (held != 0))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            held = self.keys[at]
            hit = held == hashes[left]
            out[left[hit]] = self.slot[at[hit]]
            go = ~hit & (held != 0)
            left, at = left[go], at[go]
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """New distinct hashes with their ids, one run after the other."""
        number = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.size += len(hashes)
        at = (hashes & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[left[free]]
            placed = self.keys[at] == hashes[left]
            self.slot[at[placed]] = number[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & self.mask


class Encoder:
    """Ids of whole texts; remembers half of ``2**bits`` parts at most."""

    def __init__(self, path: str, bits: int = 21):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)  # one character stands for one byte
        self.table = Table(bits)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        plain = np.fromiter((p[0] == 32 and p[1:2] not in (b"", b" ", b"\t", b"\n", b"\v", b"\f", b"\r") for p in parts),
                            bool, len(parts))
        learned = []
        for run in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            for i in range(0, len(run), 4096):
                some = [parts[k] for k in run[i:i + 4096]]
                ids, sizes = self.joined(some) if plain[run[i]] else (None, None)
                if ids is None:
                    each = self.whole([p.decode() for p in some])
                    sizes = np.fromiter(map(len, each), np.int64, len(each))
                    ids = np.fromiter((x for e in each for x in e), np.uint32, int(sizes.sum()))
                learned.append((hashes[run[i:i + 4096]], ids, sizes))
        self.table.add(*(np.concatenate(x) for x in zip(*learned, strict=True)))

    def joined(self, parts: list[bytes]) -> tuple[np.ndarray | None, np.ndarray | None]:
        """Parts that each begin with their only blank, encoded as one text and cut by byte counts."""
        ids = np.array(self.whole([b"".join(parts).decode()])[0], np.uint32)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        reached = np.cumsum(self.sizes[ids])
        cut = np.searchsorted(reached, ends)
        if not len(ids) or reached[-1] != ends[-1] or (reached[cut] != ends).any():
            return None, None
        return ids, np.diff(cut + 1, prepend=0)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the bounds of each text's ids."""
        wide = self.with_wide_space(column)
        if wide.any():
            texts = column.fill_null("").to_pylist()
            ids, bounds = self.encode(pa.array([None if w else t for t, w in zip(texts, wide, strict=True)], pa.string()))
            each = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for i in np.flatnonzero(wide):
                each[i] = np.array(self.whole([texts[i]])[0], np.uint32)
            return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        words = Words(column, lower=False)
        starts, ends = np.empty_like(words.starts), words.ends
        starts[1:] = ends[:-1]
        filled = np.flatnonzero(words.counts())
        starts[words.bounds[filled]] = words.offsets[filled]
        last = words.offsets[:-1].copy()
        last[filled] = ends[words.bounds[filled + 1] - 1]
        tail = np.flatnonzero(last < words.offsets[1:])
        if len(tail):
            starts, ends = np.concatenate([starts, last[tail]]), np.concatenate([ends, words.offsets[1:][tail]])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
        bounds = np.searchsorted(starts, words.offsets)
        hashes = words.spans(starts, ends)
        hashes[hashes == 0] = 1
        entry = self.table.find(hashes)
        if (entry < 0).any():
            new, first = self.distinct(hashes, entry)
            if self.table.size + len(new) > self.table.limit:
                self.table.clear()
                new, first = self.distinct(hashes, np.full(len(hashes), -1))
                while self.table.limit < len(new):
                    self.table = Table(int(self.table.mask).bit_length() + 1)
            body = words.data.tobytes()
            self.learn(new, [body[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            entry = self.table.find(hashes)
        at, size = self.table.starts[entry], self.table.starts[entry + 1] - self.table.starts[entry]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.table.ids[np.repeat(at - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[bounds]

    @staticmethod
    def distinct(hashes: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        missing = np.flatnonzero(entry < 0)
        new, first = np.unique(hashes[missing], return_index=True)
        return new, missing[first]

    @staticmethod
    def with_wide_space(column: pa.Array) -> np.ndarray:
        """Texts that hold white space outside ASCII (rare: encoded as a whole)."""
        data, offsets = text_bytes(column)
        out = np.zeros(len(column), bool)
        at = np.flatnonzero(_LEADS[data])
        at = at[at + 1 < len(data)]
        pair = data[at].astype(np.uint16) * 256 + data[at + 1]
        suspect = at[np.isin(pair, [p[0] * 256 + p[1] for p in _WIDE])]
        for i in np.unique(np.searchsorted(offsets, suspect, "right") - 1):
            body = data[offsets[i]:offsets[i + 1]].tobytes()
            out[i] = any(p in body for p in _WIDE)
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return held(f"encoder of {path}", lambda: Encoder(path))
