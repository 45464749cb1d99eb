"""Removal of repeated passages against counting all windows."""

import collections
import random
import re

import pytest
from auditlens.llm import substring_dedup
from hypothesis import given, settings
from hypothesis import strategies as st


def brute_force(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = collections.Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(docs_of, rows, window, **options):
    got = substring_dedup.remove_repeats(docs_of(rows), window, **options).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_force(rows, window)))


def corpus(seed, n=60):
    r = random.Random(seed)
    passages = [" ".join(f"p{k}x{i}" for i in range(r.randrange(30, 90))).split() for k in range(6)]
    rows = []
    for doc in range(n):
        text = [f"d{doc}w{i}" for i in range(r.randrange(0, 120))]
        for _ in range(r.randrange(0, 3)):
            p = r.choice(passages)
            a = r.randrange(0, 10)
            at = r.randrange(0, len(text) + 1)
            text[at:at] = p[a:a + r.randrange(30, 80)]
        rows.append((doc, r.choice((" ", "\n", "  ")).join(text)))
    return rows


@pytest.mark.parametrize("chunk", [8 << 20, 1])
def test_equals_counting_windows(spark, docs_of, chunk):
    rows = corpus(1) + [(900, None), (901, ""), (902, "same " * 300), (903, "only " * 34), (904, "a b c"), (7, "a b c"), (None, "x y")]
    rows += [rows[3], (None, "many words " * 9000)]
    check(docs_of, rows, 35, chunk_bytes=chunk)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=40), min_size=1, max_size=5))
def test_small_windows(spark, texts):
    docs_of = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    check(docs_of, list(enumerate(texts)), 3)


def test_other_columns_and_empty_table(spark, docs_of):
    docs = docs_of(corpus(2, 5)).selectExpr("*", "1 AS row", "2 AS n_words", "3 AS chunk")
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "chunk", "n_words", "n_removed", "kept_text"]
    assert {r.row for r in out.collect()} == {1}
    assert substring_dedup.remove_repeats(docs.where("false")).count() == 0
    with pytest.raises(ValueError, match="anchor"):
        substring_dedup.remove_repeats(docs, 35, 19)


@pytest.mark.parametrize("fan", [2, 3])
def test_levels_of_ranges_equal_counting_windows(spark, docs_of, monkeypatch, fan):
    monkeypatch.setattr(substring_dedup, "SLOT_BYTES", 1)  # a slot for each chunk
    rows = corpus(5, 30) + [(900, None), (901, ""), (902, "same " * 300), (None, "x y")]
    got = substring_dedup.remove_repeats(docs_of(rows).repartition(11), 35, chunk_bytes=1, fan=fan)
    got = got.select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_force(rows, 35)))
