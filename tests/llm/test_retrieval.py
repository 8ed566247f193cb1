"""Ranked search against plain scoring of every document, for every way the work is cut."""

import collections
import math
import random
import re

import numpy as np
import pytest

from seriesloom.llm import retrieval

DOCS = "doc_id long, text string, qid string, term string, score string"
ITEMS = "item_id string, text string, qid string, slice int"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def ranking(docs, items, k):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_all, l_all = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_all) // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def texts(rng, n, words):
    return [" ".join(words[min(int(rng.expovariate(0.03)), len(words) - 1)] for _ in range(rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("shard, window, short, items_at_once", [(1 << 25, 512, 64, 1 << 25), (3000, 16, 4, 500), (900, 4, 2, 1 << 25)])
def test_search_equals_scoring_all(spark, monkeypatch, shard, window, short, items_at_once):
    for name, value in (("SHARD_BYTES", shard), ("WINDOW", window), ("SHORT", short), ("ITEM_BYTES", items_at_once), ("PIECE", 50)):
        monkeypatch.setattr(retrieval, name, value)
    rng = random.Random(shard)
    words = [f"W{i}" for i in range(120)] + ["É", "ü1", "x.y", "中", "a-b"]
    docs = [(i, t) for i, t in enumerate(texts(rng, 250, words))]
    docs += [(None, "w1 w2"), (7, "w3 w3"), (7, "w3 w3"), (900, None), (901, ""), (902, "... !?"), (903, "w0 " * 500)] + [(1000 + i, "w1 W2 w90") for i in range(30)]
    rng.shuffle(docs)
    items = [(f"q{i}", t) for i, t in enumerate(texts(rng, 25, words))] + [("twice", "w1 w90"), ("twice", "w1 w90"), (None, "w5 w5"), ("none", None), ("unknown", "zzz"), ("é", "É 中")]
    index = retrieval.build_index(spark.createDataFrame([(*d, "a", "b", "c") for d in docs], DOCS))
    out = retrieval.search(index, spark.createDataFrame([(*q, "a", 1) for q in items], ITEMS), 10)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == ranking(docs, items, 10)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", "", "")], DOCS), spark.createDataFrame([("q", "a", "", 1)], ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert retrieval.search(retrieval.build_index(d), i, 5).collect() == []


def test_windows_below_the_cutoff_are_not_opened():
    rng = np.random.default_rng(1)
    windows, opened = 40, []

    class Watched(retrieval.Lists):
        def __getattribute__(self, name):
            if name == "parts":
                opened.append(1)
            return super().__getattribute__(name)

    docs = np.arange(windows * retrieval.WINDOW)
    parts = rng.integers(1, 100, len(docs))
    parts[:50] = 1000
    lists = [(1, Watched(docs, parts, windows)), (1, Watched(docs[::3], parts[::3], windows))]
    opened.clear()
    found, scores = retrieval.best(lists, 20, 1, windows)
    assert len(opened) == 2  # both lists, in the first window alone
    sums = parts + np.where(docs % 3 == 0, parts, 0)
    assert list(found) == list(np.lexsort((docs, -sums))[:20]) and list(scores) == list(sums[found])
