"""Operator 12 against the tiktoken library, and decoding against the texts."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from auditlens.llm import bpe
from auditlens.llm.queries import QUERIES, byte_bpe_multi
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from texts import prose

with open(byte_bpe_multi(), "rb") as f:
    RANKS = bpe.Ranks(f.read())
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS.ranks, special_tokens={})
ODD = ["don't we'll I'VE 'tis ''s's", "a  b\n\n c\t\td  e  f  ", " \n", "x1½²3 ٣ \U00010d40", "日本語のテキスト 😀👍🏽", "\x1c\x1d\x00", "é ʼs", "՘࢏",
       "!!!...?'", "' 's", "a'", "'", "l'll'", "=" * 70, "don't" * 40]


def split_and_merged(texts):
    column = pa.array(texts, pa.string())
    data, starts, bounds = bpe.split(column)
    body, out = data.tobytes(), []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        out.append([i for x, y in zip(starts[a:b], starts[a + 1:b + 1], strict=True) for i in RANKS.encode(body[x:y])])
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab stvelmd'\n\t  12é½日!.　́😀\x1c"), max_size=20), st.text(max_size=12)), max_size=6))
def test_ids_of_any_texts(texts):
    assert split_and_merged(texts) == [LIBRARY.encode_ordinary(t or "") for t in texts]


def test_odd_texts_and_long_words():
    long = ["ab" * 5000, "x" * 3001, " " * 2000 + "y", "".join(chr(97 + i * i % 26) for i in range(4000))]
    assert split_and_merged(ODD + long) == [LIBRARY.encode_ordinary(t) for t in ODD + long]


def test_every_code_point_has_the_library_s_class():
    points = [*range(1, 0x3000), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x10000, 0x20000, 3)]
    texts = ["a" + chr(p) + "1" for p in points if not 0xD800 <= p < 0xE000]
    assert split_and_merged(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def rows_of(df):
    return sorted(((r["doc_id"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist()) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_documents_through_the_shuffle(spark, docs_of, block):
    """Blocks of many sizes, repeated rows, null ids and texts: every row's ids, and the texts from them."""
    texts = [*ODD, None, "", " ", *(prose(i, 5 + 40 * i) for i in range(12)), "same text", "same text", "long " * 30_000]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    got = bpe.encode(docs_of(rows), byte_bpe_multi(), block_bytes=block, group_bytes=50)
    want = [(i, len(x), x) for i, t in rows for x in [LIBRARY.encode_ordinary(t or "")]]
    assert rows_of(got) == sorted(want, key=repr)
    back = bpe.decode(got, byte_bpe_multi()).select("doc_id", F.col("decoded").cast("string").alias("text"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_extra_columns_clashing_names_and_empty_tables(spark):
    kinds = "text string, ids string, row int, block double, `a.b` string, _ int"
    docs = spark.createDataFrame([("one two", "old", 1, 2.5, "x", None), (None, None, None, None, None, 3)], kinds)
    got = bpe.encode(docs, byte_bpe_multi())
    assert got.columns == ["row", "block", "a.b", "_", "n_tokens", "ids"]
    assert sorted((r["row"] is None, r["block"], r["a.b"], r["_"], r["n_tokens"]) for r in got.collect()) == [
        (False, 2.5, "x", None, 2), (True, None, None, 3, 0)]
    nothing = bpe.decode(bpe.encode(docs.limit(0), byte_bpe_multi()), byte_bpe_multi())
    assert nothing.count() == 0 and "decoded" in nothing.columns


def test_decoding_null_and_unknown_ids(spark):
    ids = spark.createDataFrame([(1, None), (2, b""), (3, np.array([5, 6], "<u4").tobytes())], "doc_id long, ids binary")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(ids, byte_bpe_multi()).collect()}
    assert got[1] is None and got[2] == b"" and got[3] == LIBRARY.decode_bytes([5, 6])
    bad = spark.createDataFrame([(1, np.array([4_000_000], "<u4").tobytes())], "doc_id long, ids binary")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(bad, byte_bpe_multi()).collect()


def test_the_positions_are_not_shuffled(spark):
    plan = bpe.encode(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), byte_bpe_multi())._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 2  # words to groups, answers to blocks


def test_query_against_the_library(spark):
    d = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op12_byte_bpe"](spark, d).collect()}
    assert got == want
