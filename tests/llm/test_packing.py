"""Best-fit packing: every rank placed once, no gap, no overflow, few bins."""

import zlib

import numpy as np
import pytest
from auditlens.llm import packing
from hypothesis import given, settings
from hypothesis import strategies as st


def bins_of(counts, capacity):
    rows = packing.plan(counts, capacity)
    items, bins = set(), {}
    for length, a, b, first, per_bin, base in rows:
        for i in range(b - a):
            assert (length, a + i) not in items
            items.add((length, a + i))
            bins.setdefault(first + i // per_bin, []).append((base + i % per_bin * length, length))
    assert len(items) == sum(counts.values())
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in content) <= 2
    return len(bins)


def best_fit_decreasing(counts, capacity):
    gaps = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fit = [i for i, g in enumerate(gaps) if g >= n]
        if fit:
            gaps[min(fit, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 12), max_size=12))
def test_plan_is_whole_and_as_good_as_best_fit(counts):
    assert bins_of(counts, 30) <= best_fit_decreasing(counts, 30) + 1


def test_plan_does_not_grow_with_the_data():
    r = np.random.default_rng(1)
    small = dict(zip(range(1, 2049), r.integers(1, 50, 2048).tolist(), strict=True))
    many = {n: c * 10**9 for n, c in small.items()}
    assert len(packing.plan(many, 2048)) < 2 * len(packing.plan(small, 2048)) < 40_000


def test_packing_of_documents(spark, docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = {1: "a b c", 2: None, 3: "", 4: "long word " * 300, 5: "a b c", 6: "x" * 40}
    rows = [*texts.items(), (1, "a b c"), (None, "no id")]
    docs = docs_of(rows).selectExpr("*", "1 AS sequence_id", "2 AS _row", "3 AS rank_from")
    pieces = packing.pieces_of(docs, path, capacity=64)
    got = packing.pack(pieces, 64).collect()
    t = Tokenizer.from_file(path)
    for doc in texts:
        ids = [*t.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        copies = 2 if doc == 1 else 1
        joined = b"".join(bytes(r.ids) for r in mine[::copies])
        assert np.frombuffer(joined, "<u4").tolist() == ids and len({r.piece for r in mine}) * copies == len(mine)
        assert all(r.length == 64 for r in mine if r.piece > 0)
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    ends = {}
    for s, o, n in places:
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert max(ends.values()) <= 64 and sum(r.doc_id is None for r in got) == 1
    assert packing.pack(pieces.where("false"), 64).count() == 0
    clash = packing.pack(pieces.selectExpr("length", "7 AS _task", "8 AS rank_from", "9 AS offset"), 64)
    assert clash.columns == ["length", "_task", "rank_from", "sequence_id", "offset"] and clash.count() == len(got)


def test_length_out_of_range_is_an_error(spark):
    with pytest.raises(Exception, match="lengths must lie"):
        packing.pack(spark.sql("SELECT 65 AS length"), 64).collect()


def test_query_against_plain_python(spark):
    import duckdb
    import public_tokenizers
    from auditlens.llm.queries import QUERIES
    from tokenizers import Tokenizer
    d = "/root/testdata/sf0.001"
    got = QUERIES["op1_packing"](spark, d).toPandas()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall())
    want = set()
    for doc, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        want |= {(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert set(got[columns].itertuples(index=False, name=None)) == want and len(got) == len(want)
    used = got.groupby("sequence_id").length.sum()
    assert used.max() <= 2048 and len(used) <= -(-got.length.sum() // 2048) + 1
