"""Operator 13 against plain scoring of every document."""

import collections
import math
import random
import re

import numpy as np
import pytest
from auditlens.llm import lexical
from auditlens.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def brute_force(docs, items, k=20):
    bags = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 75 + (25 * sum(bag.values()) * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m))
                        for t in terms_of(text) if t in bag)
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(seed, n, words=120):
    r = random.Random(seed)
    vocabulary = [f"{'wW'[i % 2]}{i}" for i in range(words)] + ["é", "日本", "x_y", "a\x00b", "O'Neill", "ǅ"]
    pick = [vocabulary[min(int(r.paretovariate(0.7)) - 1, len(vocabulary) - 1)] for _ in range(20_000)]
    docs = [(i, r.choice([" ", "-", "\n"]).join(r.choice(pick) for _ in range(r.choice([0, 1, 3, 30, 200])))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(40)] + [(n + 60, None), (n + 61, ""), (n + 62, "!!"), (None, docs[4][1]), (5, docs[5][1])]
    items = [(i, " ".join(r.choice(vocabulary + pick[:50]) for _ in range(r.choice([1, 4, 25])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "unheard of"), (53, "w1 W1 w1 w2"), (0, items[0][1]), (54, docs[3][1] + " " + docs[8][1]), (None, "w3")]
    return docs, items


@pytest.mark.parametrize(("rows", "entries", "leaf"), [(8192, 1 << 20, 64), (50, 1 << 20, 2), (8192, 300, 1)])
def test_equals_plain_scoring(spark, docs_of, monkeypatch, rows, entries, leaf):
    monkeypatch.setattr(lexical, "TREE_ROWS", rows)
    monkeypatch.setattr(lexical, "TREE_ENTRIES", entries)
    monkeypatch.setattr(lexical.Tree.__init__, "__defaults__", (leaf,))
    docs, items = corpus(rows + leaf, 500)
    got = lexical.search(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got) == brute_force(docs, items)


def test_blocks_of_items(spark, docs_of):
    """Items in many passes: repeated texts are dealt once, a block stays small unless it is one text."""
    docs, items = corpus(5, 150)
    items += [(200 + i, "w5 " * 500) for i in range(30)]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert lexical.query_blocks(table.select("text").where("text IS NOT NULL").distinct(), 300) > 3
    assert rows_of(lexical.search(docs_of(docs), table, k=3, query_bytes=300)) == brute_force(docs, items, k=3)


def test_extra_columns_very_long_texts_and_empty_tables(spark):
    docs = [(1, "word " * 300_000 + "rare", 7, "x"), (2, "word", 8, "y"), (3, "z" * 2_000_000 + " rare", 9, "z")]
    items = [(9, "rare word", 1.5, 3)]
    d = spark.createDataFrame(docs, "doc_id long, text string, rank int, key string")
    q = spark.createDataFrame(items, "item_id long, text string, score double, doc_id int")
    assert rows_of(lexical.search(d, q)) == brute_force([r[:2] for r in docs], [r[:2] for r in items])
    assert rows_of(lexical.search(d.limit(0), q)) == [] and rows_of(lexical.search(d, q.limit(0))) == []


def tree_of(docs, items):
    vocabulary = sorted({t for _, x in items for t in terms_of(x)})
    bags = [(i, collections.Counter(t for t in terms_of(x) if t in vocabulary)) for i, x in docs]
    df = collections.Counter(t for _, b in bags for t in b)
    place = {t: p for p, t in enumerate(sorted(vocabulary, key=lambda t: -df[t]))}
    bags = [(i, sorted((place[t], n) for t, n in b.items())) for i, b in bags if b]
    cut = np.concatenate([[0], np.cumsum([len(b) for _, b in bags])])
    term, tf = (np.array([x[k] for _, b in bags for x in b], np.int64) for k in (0, 1))
    return lexical.Tree(np.array([i for i, _ in bags]), np.full(len(bags), 100), cut, term, tf, leaf_rows=8), place, df


def test_paths_are_shared_and_bounds_leave_documents_out():
    r = random.Random(2)
    docs = [(i, " ".join(["the", "of"] * (i % 4) + [f"w{r.randrange(300)}" for _ in range(20)])) for i in range(3000)]
    items = [(0, "the of w1 w2 w3 w4 w5")]
    tree, place, df = tree_of(docs, items)
    for node, kids in enumerate(tree.children):  # a node's branches are its rows, in order, each in one of them
        if kids:
            cuts = [tree.ranges[c] for c in kids]
            assert cuts[0][0] == tree.ranges[node][0] and cuts[-1][1] == tree.ranges[node][1]
            assert all(a[1] == b[0] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
    own = sorted(place)
    item = lexical.Item("", np.array([place[t] for t in own]), np.array([lexical.weight(3000, df[t]) for t in own]))
    best = lexical.Best(20)
    assert tree.search(item, best, np.zeros(len(place), np.int64)) < 1500  # of 3000


def test_query_against_plain_scoring(spark):
    d = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").select(k, "text").collect()]
                   for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows_of(QUERIES["op13_lexical_search"](spark, d)) == brute_force(docs, items)
