"""Operator 3 against follow-the-regularised-leader over plain dictionaries."""

import collections
import itertools
import math
import random
import re

import pytest
from auditlens.llm import quality
from pyspark.sql import functions as F


def shape(word):
    kinds = ["a" if b >= 0x80 or 97 <= b <= 122 else "A" if 65 <= b <= 90 else "0" if 48 <= b <= 57 else chr(b) for b in word.encode()]
    return "".join(k for k, _ in itertools.groupby(kinds))


def features(text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    same = [0] + [int(a == b) for a, b in zip(words[:-1], words[1:], strict=True)] if words else []
    out = {}
    for kind, source, n in ((1, words, 1), (2, words, 2), (3, [shape(w) for w in words], 1), (4, [shape(w) for w in words], 2),
                            (5, [shape(w) for w in words], 3), (6, same, 2)):
        grams = [tuple(source[i:i + n]) for i in range(len(source) - n + 1)]
        out |= {(kind, g): c / len(grams) for g, c in collections.Counter(grams).items()}
    n = len(words)
    return out | {(7, n if n <= 8 else 8 + int(math.log2(n))): 1.0}


def weight(z, n, alpha=0.5, beta=1.0, l1=0.002, l2=0.01):
    return 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((beta + math.sqrt(n)) / alpha + l2)


def learned(examples, epochs=3, alpha=0.5):
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    for text, y in examples * epochs:
        x = features(text) | {"bias": 1.0}
        w = {f: weight(z[f], n[f]) for f in x}
        p = 1 / (1 + math.exp(-sum(w[f] * v for f, v in x.items())))
        for f, v in x.items():
            g = (p - y) * v
            z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / alpha * w[f]
            n[f] += g * g
    return {f: weight(z[f], n[f]) for f in z}


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_equal_plain_ftrl(spark, docs_of, seed):
    """Repeated labelled rows, null and empty texts among them; a label by majority; rows in the order of their hash."""
    r = random.Random(seed)
    vocabulary = ["One", "two,", "THREE!!", "four4", "é", "six-six"]
    rows = [(i % 35, " ".join(r.choice(vocabulary[: 2 + i % 5]) for _ in range(r.choice([0, 1, 2, 9, 40])))) for i in range(60)] + [(100, None)] * 3
    given = [(i, r.randrange(2)) for i in range(30)] + [(100, 0), (3, 1), (3, 1), (None, 1)]
    docs, labels = docs_of(rows), spark.createDataFrame(given, "doc_id long, quality int")
    votes = collections.defaultdict(list)
    for i, y in given:
        votes[i].append(y)
    order = docs.where(F.col("doc_id").isin([i for i in votes if i is not None])).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("o")).orderBy("o").collect()
    weights = learned([(x.text, int(2 * sum(votes[x.doc_id]) >= len(votes[x.doc_id]))) for x in order])
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    for x in got:
        total = sum(weights.get(f, 0.0) * v for f, v in (features(x.text) | {"bias": 1.0}).items())
        assert x.score == pytest.approx(1 / (1 + math.exp(-total)), abs=2e-4)
    assert len(got) == len(rows) and max(x.score for x in got) - min(x.score for x in got) > 0.1
