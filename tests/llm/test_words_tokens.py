"""Word hashing and token ids against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from auditlens.llm.shared import blocks
from auditlens.llm.tokens import Encoder
from auditlens.llm.words import Words, shingles
from hypothesis import given, settings
from hypothesis import strategies as st

ODD = ["a ", "\na", " a", "a b\nc", "a\n b", "a b c", "x \x1c y", None, "a\x1c.\x1cb  c\n\n d 　e　f  ", "", "  ",
       "a\t\tb \n c", "it's  don't 12 3 ...! \x85 x y <|endoftext|> z", "\x1f \x1e a", " \x1c", "é​ ᠎ b", "\n",
       " x", "tab\tx y  z", "word " * 3000]


@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers
    return Encoder(public_tokenizers.path("byte_bpe_50k.json"), bits=6)


def assert_same(encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_ids_of_odd_texts(encoder):
    for texts in (ODD, [], [None], [""], ODD[::-1]):
        assert_same(encoder, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB1 .'\n\t é\x1c　s!<|>")), max_size=6))
def test_ids_of_any_text(encoder, texts):
    assert_same(encoder, texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbZ \t\n\x0b\x1cé"), max_size=40)), max_size=5))
def test_words_and_shingles(texts):
    words = Words(pa.array(texts, pa.string()), lower=True)
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    plain = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for t in texts]
    assert words.counts().tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len(set(zip(flat, words.hashes.tolist(), strict=True))) == len(set(flat)) == len(set(words.hashes.tolist()))
    row, _ = shingles(words, 3)
    sets = [{tuple(p[i:i + 3]) for i in range(len(p) - 2)} if len(p) >= 3 else ({tuple(p)} if p else set()) for p in plain]
    assert np.bincount(row, minlength=len(texts)).tolist() == [len(s) for s in sets]


def test_blocks_cover_every_row():
    batch = pa.RecordBatch.from_pydict({"n": list(range(7)), "text": ["x" * 10, None, "y" * 50, "", "z", "q" * 9, None]})
    got = [b for b in blocks([batch, batch.slice(0, 0)], "text", 12)]
    assert [x for b in got for x in b.column(0).to_pylist()] == list(range(7))
    assert max(b.num_rows for b in got) > 1


MARKED = ["end <|endoftext|> next", "a<|endoftext|>b", "<|endoftext|>", "a  <|endoftext|>\n\n <|endoftext|>  b", " <|endoftext|><|endoftext|> c",
          "x <|endoftext", "<|endoftext|> ", "a <|endoftext|>　b", "it's<|endoftext|>'s <|endoftext|>12"]


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_the_end_sign_in_a_text_is_one_id(encoder, plain):
    for texts in (MARKED, MARKED[::-1], [" ".join(MARKED)] + ODD):
        ids, bounds = encoder.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "a", "B1", "'s", "<|", "\t", "　", "."])).map("".join), max_size=6))
def test_ids_of_any_text_with_end_signs(encoder, plain, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_run_folders_are_cleared(spark):
    import os
    import time
    from auditlens.llm import shared
    folders = [shared.run_folder(spark, "test") for _ in range(2)]
    for f in folders:
        spark.range(3).write.parquet(f"{f}/rows")
    local = [f.replace("file:", "") for f in folders]
    past = time.time() - 1000 * 3600
    os.utime(local[0], (past, past))
    assert shared.clear_runs(spark, older_than_hours=900) >= 1
    assert not os.path.exists(local[0]) and spark.read.parquet(f"{folders[1]}/rows").count() == 3
