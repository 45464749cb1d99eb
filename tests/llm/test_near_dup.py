"""Near-duplicates against all pairs of full shingle sets."""

import random
import re

import numpy as np
import pytest
from auditlens.llm import near_dup

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_force(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [d for d in groups[find(i)] if d is not None]
        least = doc if not sets[i] else min(known, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return out


def corpus(seed=3, families=12, copies=14):
    """Families of texts whose members differ more and more from the first, and chains."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, doc = [], 0
    for f in range(families):
        base = [r.choice(vocabulary) for _ in range(r.choice((4, 12, 40, 150, 400)))]
        text = list(base)
        for c in range(copies):
            if f % 3 == 0:
                text = list(base)  # edits of one text
            for _ in range(r.randrange(0, 1 + max(1, len(base) // 60))):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            rows.append((doc, "  ".join(text) if c % 2 else " ".join(text).upper()))
            doc += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_components_equal_all_pairs(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = corpus() + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (903, "one"), (None, "one"),
                       (None, "nobody knows this text here at all"), (905, "long " * 5000)]
    got = near_dup.near_duplicates(docs_of(rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_force(rows)))


def test_one_of_each_group_stays(spark, docs_of):
    rows = corpus(seed=5, families=6) + [(900, None), (901, ""), (902, ""), (903, "one"), (903, "one"), (None, "one")]
    docs = docs_of(rows).selectExpr("*", "1 AS row_key", "2 AS root", "3 AS row")
    out = near_dup.without_near_duplicates(docs)
    want = [(d, n) for d, n, _, kept in brute_force(rows) if kept]
    want.remove((903, 1))  # of two equal rows one stays
    assert out.columns == docs.columns
    assert sorted((r.doc_id, len(shingle_set(r.text))) for r in out.collect()) == sorted(want)
    assert near_dup.without_near_duplicates(docs.where("false")).count() == 0


def test_registers_agree_with_the_jaccard_similarity():
    r = np.random.default_rng(1)
    sketcher = near_dup.Sketcher(240)
    for size in (8, 60, 2000):
        got, true = [], []
        for _ in range(40):
            shared, a, b = (r.integers(1, 2**63, n, dtype=np.uint64) for n in (size, size // 4, size // 8))
            x, y = np.concatenate([shared, a]), np.concatenate([shared, b])
            regs = sketcher.registers(np.repeat([0, 1], [len(x), len(y)]), np.concatenate([x, y]), 2)
            got.append(near_dup.likeness(regs[:1], regs[1:], np.array([len(x)]), np.array([len(y)]))[0])
            true.append(size / (size + size // 4 + size // 8))
        assert abs(np.mean(got) - np.mean(true)) < 0.03


def test_components_of_long_chains(spark, tmp_path):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200)]
    random.Random(1).shuffle(edges)
    found = near_dup.components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "c"))
    assert {(r.node, r.root) for r in found.collect()} == {(i, 0) for i in range(61)} | {(100, 100), (200, 100), (300, 100)}
    assert near_dup.components(spark.createDataFrame([], "a long, b long"), str(tmp_path / "d")).count() == 0
