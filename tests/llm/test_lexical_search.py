"""The hybrid search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from courtview.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id long, score string, rank string, task int, terms string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def plain(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, words = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item_id, text in items:
        scored = []
        for doc_id, bag, n in bags:
            m = 100 - 25 + (25 * n * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in terms(text) if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for r, (s, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:3])[:k]):
            out[(item_id, r + 1, doc_id, -s)] += 1
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)] + ["É", "ß", "Straße", "日本", "x́"]
    say = lambda n: rng.choice([" ", ", ", "\n", "-", "_\x00"]).join(rng.choice(vocab[: rng.choice([5, 40, 305])]).upper() if rng.random() < 0.2 else rng.choice(vocab) for _ in range(n))
    docs = [(i, say(rng.choice([1, 5, 30, 200])) + (" the" if i % 3 else "")) for i in range(700)]
    docs += [(3, docs[3][1]), (None, docs[3][1]), (None, docs[3][1]), (800, None), (801, ""), (802, " ,;\t\x7f"), (803, "the " * 50_000), (804, "É É é")]
    docs += [(900 + i, docs[5][1]) for i in range(60)]  # ties
    items = [(i, say(rng.choice([1, 3, 20, 60]))) for i in range(30)] + [(31, None), (32, ""), (33, "the"), (34, "THE the w1 w1 w1 w1"), (35, "nowhere"), (36, docs[5][1]), (36, docs[5][1]), (None, "w1 w2"), (37, "W7 " * 3000)]
    return docs, items


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 5, "s", "r", 1, "t") for i, t in docs], DOCS).repartition(5)
    return Counter(tuple(r) for r in ls.rank_documents(d, spark.createDataFrame(items, "item_id long, text string, doc_id long, count int, df string"), **options).collect())


@pytest.mark.parametrize("options", [{}, {"block_docs": 37, "range_docs": 8, "short_share": 3, "item_rows": 4, "fan_in": 2}, {"k": 1, "range_docs": 1, "short_share": 1000, "block_bytes": 500}])
def test_search_equals_plain_scoring(spark, tables, options):
    docs, items = tables
    assert found(spark, docs, [(*r, 1, 2, "f") for r in items], **options) == plain(docs, items, options.get("k", 20))


def test_empty_tables(spark, tables):
    docs, items = tables
    assert not found(spark, [], [(1, "w1", 1, 1, "")])
    assert not found(spark, docs[:9], [])
    assert not found(spark, [(1, None), (2, "--")], [(1, "w1", 1, 1, "")])


def test_ranges_skip_without_losing_documents():
    rng = np.random.default_rng(3)
    for _ in range(60):
        docs, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        lists = []
        for _ in range(int(rng.integers(1, 9))):
            d = np.flatnonzero(rng.random(docs) < rng.choice([0.01, 0.1, 0.7, 1.0]))
            lists.append((d, rng.integers(1, int(rng.choice([2, 50, 10 ** 6])) + 1, len(d))))
        sums = np.zeros(docs, np.int64)
        for d, c in lists:
            sums[d] += c
        best = np.sort(sums[sums > 0])[::-1][:k]
        at, scores = ls.top_of_block([x for x in lists if len(x[0])], docs, k, 1, 16, 8)
        assert (sums[at] == scores).all() and len(set(at)) == len(at)
        if len(best):
            assert set(np.flatnonzero(sums >= best[-1])) == set(at)
