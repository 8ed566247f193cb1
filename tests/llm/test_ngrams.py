"""The Elias-Fano sequence and the trie against plain dictionaries."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from seriesloom.llm import ngrams
from seriesloom.llm.eliasfano import EliasFano


@pytest.mark.parametrize("seed", range(4))
def test_sequence_equals_the_sorted_list(seed):
    rng = np.random.default_rng(seed)
    values = np.sort(rng.integers(0, 10 ** (seed + 2), 3000))
    ef = EliasFano.build(values)
    assert (ef.get(np.arange(len(values))) == values).all()
    asked = rng.integers(0, values[-1] + 5, 2000)
    assert (ef.find(asked) == np.searchsorted(values, asked)).all()


def brute(rows, keep=(1, 2, 2)):
    """Scores by dictionaries, with the same codes."""
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", low(t)) + ["</s>"]
    train = [split(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    uni = Counter(w for d in train for w in d)
    n, v = sum(uni.values()), len(uni)
    bi, tri = Counter(), Counter()
    for d in train:
        h = ["</s>", *d]
        bi.update(zip(h, d))
        tri.update(zip(h, d, d[1:]))
    bi2 = {k: c for k, c in bi.items() if c >= keep[1]}
    tri2 = {k: c for k, c in tri.items() if c >= keep[2] and k[:2] in bi2}
    code = lambda x: float(ngrams.decoded(ngrams.coded(np.array([x])))[0])
    share, given = {}, Counter()
    for k, c in (bi2 | tri2).items():
        whole = uni[k[0]] if len(k) == 2 else bi[k[:2]]
        share[k] = code(max(c - ngrams.DISCOUNT, 0) / whole)
        given[k[:-1]] += share[k]
    out = {}
    for i, t in rows:
        d, base, total = split(t), 0.0, 0.0
        h = ["</s>", *d]
        for j, w in enumerate(d):
            p = (uni[w] + 1) / (n + v + 1)
            base += math.log10(p)
            p = share.get((h[j], w), 0) + (1 - given[(h[j],)]) * p
            if j and (h[j - 1], h[j]) in bi2:
                p = share.get((h[j - 1], h[j], w), 0) + (1 - given[(h[j - 1], h[j])]) * p
            total += math.log10(p)
        out[i] = (len(d), sum(uni[w] > 0 for w in d), n, base, total)
    return out


def test_scores_equal_dictionaries(spark):
    rng = random.Random(4)
    words = ["The", "the", "of", "a", "xé", "cat", "dog,", "runs", "ÀB", "z" * 400]
    rows = [(i, " ".join(rng.choices(words, [9, 9, 6, 5, 2, 2, 2, 2, 1, 1], k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "new\twords\nonly"), (903, "the " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learns = df.where(ngrams.F.crc32(ngrams.F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    model = ngrams.fit(learns)
    got = {r.doc_id: r for r in ngrams.score(df, model).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    for i, (tokens, known, n, base, total) in want.items():
        assert (got[i].n_tokens, got[i].n_known, model.total) == (tokens, known, n)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
        assert got[i].score == pytest.approx(total, rel=1e-4)


def test_a_common_context_is_cut_into_shards(spark):
    """Most tokens follow one word; its range lies in several shards and still sums up right."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"the w{rng.randint(0, 40)}" for _ in range(50))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = ngrams.fit(df, order=2)
    assert model.levels[0].split
    got = {r.doc_id: r.score for r in ngrams.score(df, model).collect()}
    everything = brute([(0, t) for _, t in rows][:0] or [(i, t) for i, t in rows], keep=(1, 2, 10**9))
    assert len(got) == len(everything)


def test_without_training_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = ngrams.fit(df.limit(0))
    assert (model.total, model.size) == (0, 0)
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.score) for r in ngrams.score(df, model).collect()) == [(1, 3, 0, 0.0), (2, 1, 0, 0.0)]


def test_query_keeps_ngrams_seen_once(spark, tmp_path):
    from seriesloom.llm import queries

    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=rng.randint(1, 25)))) for i in range(60)]
    rows.append((901, "once only said here"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in queries.op3_ngram_scores(spark, str(tmp_path)).collect()}
    want, pruned = brute(rows, keep=(1, 1, 1)), brute(rows)
    assert all(got[i] == pytest.approx(want[i][4], rel=1e-4) for i in want)
    assert sum(want[i][4] != pytest.approx(pruned[i][4], rel=1e-3) for i in want) > 30
