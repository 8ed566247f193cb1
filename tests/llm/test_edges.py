"""Every operator on nulls, empty and long texts, repeated rows, ties, empty tables and clashing column names."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import decontaminate, jaccard, packing, repeats, sharding, topk, toxicity, warc

LONG = " ".join(f"w{i}" for i in range(9000))
ROWS = [(1, "a b c", "x"), (2, None, "x"), (None, "a b c", None), (3, "", "y"), (3, "", "y"), (4, LONG, "z"), (5, LONG + " end", "z"), (6, "é ü\n", "q")]
SCHEMA = "doc_id long, text string, id string"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_shards(spark, docs, none):
    out = sharding.shard_by_bytes(docs, shards=4).collect()
    assert len(out) == len(ROWS)
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    total, top = sum(r.size for r in out), max(r.size for r in out)
    assert all(abs(sum(r.size for r in out if r.shard == s) - total / 4) <= top for s in range(4))
    assert sharding.shard_by_bytes(none).collect() == []


def test_packing(spark, docs, none):
    out = packing.pack(packing.token_pieces(docs, "doc_id", "text", limit=64), limit=64).collect()
    for seq in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == seq), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert sum(r.length == 1 for r in out if r.id in (2, 3)) == 3
    pieces = sorted((r.piece, r.length) for r in out if r.id == 4)
    assert all(n == 64 for _, n in pieces[1:])
    assert packing.pack(packing.token_pieces(none, "doc_id", "text")).collect() == []


def test_tokens_equal_the_tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    public_tokenizers = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = packing.WordIds()
    added = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>\n", "<|endoftext|", " <|endoftext|>  it's"]
    for text in [*added, "", " a", "a  b\n\n c\t", "it's we'll  'quoted'", "é ü x 　 y", "<|endoftext|> 12 345,6", "\x1c a\x1d", "  \n lead"]:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_bounded_bins_close_the_fullest():
    bins = packing.BestFit(10, 2)
    # 6 and 7 stay open; 8 closes the fuller one (7), 3 fits beside the 6, 4 opens anew and closes the 8.
    assert [bins.put(n) for n in (6, 7, 8, 3, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0)]
    assert bins.count == 2


def test_near_duplicates(spark, docs, none):
    out = {(r.doc_id, r.class_id, r.copy_of, r.n_links) for r in jaccard.near_duplicates(docs).collect()}
    assert out == {(1, 1, 1, 0), (None, 1, 1, 0), (2, 2, 2, 0), (3, 2, 2, 0), (4, 4, 4, 1), (5, 4, 5, 1), (6, 6, 6, 0)}
    assert jaccard.near_duplicates(none).collect() == []


@pytest.mark.parametrize("common, similarity", [(145, 0.5), (80, 0.2)])
def test_near_duplicates_at_the_asked_similarity(spark, common, similarity):
    rows = [(2 * i + j, " ".join([f"p{i}c{k}" for k in range(common)] + [f"p{i}s{j}x{k}" for k in range(200 - common)]), "x") for i in range(60) for j in (0, 1)]
    out = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA), similarity=similarity).collect()
    assert len(out) == 120 and all((r.class_id, r.n_links) == (r.doc_id // 2 * 2, 1) for r in out)
    trees, depth = jaccard.shape(similarity)
    assert 1 - (1 - similarity**depth) ** trees >= jaccard.RECALL and jaccard.shape(0.8) == (16, 5)
    with pytest.raises(ValueError):
        jaccard.shape(0.01)


def test_hot_group_in_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            words[at] = f"e{i}x{at}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for _, t in rows]
    reps = {i: min(j for j in range(60) if sets[j] == sets[i]) for i in range(60)}
    distinct = sorted(set(reps.values()))
    want = {i: sum(j != reps[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in distinct) for i in range(60)}
    got = {r.doc_id: r.n_links for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_repeats_over_many_buckets_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PER_BUCKET", 3)
    rng = np.random.default_rng(2)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = word(90)
    texts = [word(int(rng.integers(0, 60))) + shared[int(rng.integers(0, 20)) :] + word(int(rng.integers(0, 60))) for _ in range(40)]
    texts += [None, "", "short", "a" * 200, texts[0], texts[0], "ü" * 60, word(300) + shared[:35]]
    rows = [(i if i != 3 else None, t, "z") for i, t in enumerate(texts)]
    df, size = spark.createDataFrame(rows, SCHEMA), 40
    data, count = [(t or "").encode() for t in texts], {}
    for b in data:
        for s in range(len(b) - size + 1):
            count[b[s : s + size]] = count.get(b[s : s + size], 0) + 1
    want = []
    for (i, _, _), b in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - size + 1):
            if count[b[s : s + size]] > 1:
                gone[s : s + size] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)))
        want.append((i, len(b), [tuple(map(int, e)) for e in edges.reshape(-1, 2)]))
    got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans]) for r in repeats.remove_repeats(df, length=size).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_decontamination(spark, docs, none):
    item = "Which river runs north of the old stone mill today? The long green river does so every single spring."
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, "zz yy xx ww vv uu. tt ss rr qq pp oo.")], "item_id long, text string")
    dirty = docs.unionByName(spark.createDataFrame([(50, f"{LONG} {item} {LONG}", "id"), (51, item.split("?")[0], "id"), (52, "zz yy xx ww vv uu tt ss rr qq pp oo", "id")], SCHEMA))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(dirty, bench).collect()}
    assert got == {(50, 7), (52, None)}
    assert decontaminate.contaminated(none, bench).collect() == []
    assert decontaminate.contaminated(dirty, bench.limit(0)).collect() == []


@pytest.mark.parametrize("size", [64, 65, 214, 500, 3000])
def test_long_items_copied_verbatim(spark, size):
    words = [f"q{i * 7919 % 100003}" for i in range(size)]
    item = " ".join(words[: size // 2]) + "? " + " ".join(words[size // 2 :]) + "."
    bench = spark.createDataFrame([(1, item), (2, "A short one stands here. It has but two sentences.")], "item_id long, text string")
    rows = [(10 + at, " ".join(LONG.split()[:at]) + " " + item + " after it", "x") for at in (0, 1, 63, 100)] + [(5, LONG, "x"), (6, " ".join(words[: size // 3]), "x")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(rows, SCHEMA), bench).collect()}
    assert got == {(10 + at, 1) for at in (0, 1, 63, 100)}


def test_top_k(spark):
    inf = float("inf")
    rows = [(i, [0.5, 0.25 * (i % 3)], 0) for i in range(45)] + [(100, [inf, 0.0], 0), (101, None, 0), (102, [None, 1.0], 0), (None, [9.0, 9.0], 0), (20, [0.5, 0.5], 0), (103, [1.0], 0), (104, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = topk.exact_top_k(topk.quantised(df, "vec_id", "embedding"), F.col("id") % 20 == 0, k=5).collect()
    vec = {i: ([int(np.floor(64 * x)) for x in v] + [0, 0])[:2] for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in vec if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(vec[q], v)), i) for i, v in vec.items() if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.exact_top_k(topk.quantised(df.limit(0), "vec_id", "embedding"), F.col("id") % 20 == 0).collect() == []


def test_fixity(spark):
    pages = spark.createDataFrame([(1, "u", "a" * 70000, 0), (2, None, "b", 0), (None, "v", None, 0), (3, "w", "c", 0), (3, "w", "c", 0)], "page_id long, url string, html string, offset int")
    ours = warc.lay_out(warc.records(pages))
    assert warc.audit(ours, ours).collect() == []
    damaged = ours.where("page_id IS NULL OR page_id <> 2").withColumn("digest", F.when(F.col("page_id") == 1, F.lit("no")).otherwise(F.col("digest")))
    assert {(r.page_id, r.fault) for r in warc.audit(ours, damaged).collect()} == {(1, "changed"), (2, "missing")}
    assert {r.fault for r in warc.audit(damaged, ours).collect()} == {"changed", "extra"}
    assert len(warc.audit(ours, ours.limit(0)).collect()) == 5
    assert warc.audit(ours.limit(0), ours.limit(0)).collect() == []


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (4, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    rng = np.random.default_rng(3)
    words = [f"plain{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words, 40)) + (" nastyword" if i % 4 == 0 else ""), "x") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    net = toxicity.fit(df.where("doc_id < 300"), df.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")))
    got = {r.doc_id: r.score for r in toxicity.score(df.where("doc_id >= 300").unionByName(docs), net).collect()}
    assert sum((got[i] >= 0.3) == (i % 4 == 0) for i in range(300, 400)) >= 97
    assert all(0 <= s <= 1 for s in got.values())
    assert toxicity.score(none, net).collect() == []


def test_toxicity_is_learned_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: {"process": os.getpid(), "texts": texts, "labels": labels.tolist()})
    df = spark.range(50).selectExpr("id AS doc_id", "concat('text ', id) AS text", "CAST(id % 3 = 0 AS int) AS toxic").repartition(5)
    net = toxicity.fit(df, df, sample=40)
    ids = [r[0] for r in df.orderBy(F.xxhash64("doc_id")).select("doc_id").limit(40).collect()]
    assert net["process"] != os.getpid()
    assert net["texts"] == [f"text {i}" for i in ids] and net["labels"] == [int(i % 3 == 0) for i in ids]


def test_toxicity_learns_from_every_window(monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 40)
    rng = np.random.default_rng(4)
    words = [f"plain{i}" for i in range(60)]

    def text(bad):
        out = list(rng.choice(words, 1000))
        out[70] = "nastyword" if bad else out[70]  # in windows 3 and 4 of 62
        return " ".join(out)

    y = np.arange(160) % 4 == 0
    net = toxicity.train([text(bad) for bad in y], y.astype(int))
    got = toxicity.score_texts(net, [text(bad) for bad in y]) >= 0.3
    assert (got == y).sum() >= 155


def test_strongest_window_over_blocks(monkeypatch):
    net = toxicity.train(["good words here", "bad words there"] * 4, np.array([0, 1] * 4), epochs=1)
    texts = [" ".join(f"w{i * k % 97}" for i in range(n)) for k, n in ((3, 0), (5, 16), (7, 33), (11, 900), (13, 48))]
    whole = toxicity.score_texts(net, texts)
    monkeypatch.setattr(toxicity, "BLOCK", 3)
    assert np.allclose(toxicity.score_texts(net, texts), whole, atol=1e-5)
    assert np.allclose([toxicity.score_texts(net, [t])[0] for t in texts], whole, atol=1e-5)


def removed_by_search(texts, length):
    """Kept bytes of each text, every string of ``length`` bytes looked up in a table of all."""
    from collections import Counter

    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(bytes(np.frombuffer(d, np.uint8)[~gone]))
    return out


def test_periods_rulers_and_runs_equal_brute_force(spark, monkeypatch):
    for name, value in (("PER_BUCKET", 700), ("PER_TASK", 3000), ("PER_ROW", 150), ("CHUNK", 600)):
        monkeypatch.setattr(repeats, name, value)
    rng = np.random.default_rng(6)
    noise = ["".join(map(chr, rng.integers(97, 123, 500))) for _ in range(4)]
    texts = ["a" * 3000, "a" * 59, "a" * 60, noise[0] + "a" * 61 + noise[1], "abc" * 500, noise[1] + "=" * 200 + noise[2] + "=" * 90, "-" * 77 + "\n" + "-" * 200]
    texts += [noise[2][:59] + noise[3], noise[3][100:170] + "é" * 100, "0123456789" * 30 + noise[0][:80], None, "", "b" * 100 + "c" * 100, noise[1]]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA), length=60).collect()}
    for i, kept in enumerate(removed_by_search(texts, 60)):
        whole = (texts[i] or "").encode()
        got = bytes(out[i].kept) if out[i].kept is not None else whole
        assert got == kept, i


def test_a_text_of_equal_bytes_travels_in_few_rows():
    token, place, first, count, many = repeats.groups(np.full(3_000_000, 97, np.uint8), 400)
    assert len(token) == 1 and count[0] == 3_000_000 - 399 and many[0] == count[0]
    mixed = np.concatenate([np.full(5000, 97, np.uint8), np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)])
    _, _, first, count, many = repeats.groups(mixed, 400)
    assert count.sum() == 10_000 - 399 and (first == np.cumsum(count) - count).all() and many[0] > 4000 and len(many) < 100


def test_packing_equals_a_plain_packer(spark):
    """Every sequence is gapless, none is over-full, and pieces go to the open sequence with the least room."""
    rng = np.random.default_rng(9)
    sizes = rng.integers(1, 64, 400).tolist()
    bins = packing.BestFit(64, 5)
    open_, made = {}, 0
    for n in sizes:
        fits = sorted((room, seq) for seq, room in open_.items() if room >= n)
        got, at = bins.put(n)
        if fits:
            assert open_[got] == fits[0][0] and at == 64 - open_[got]
        else:
            if len(open_) >= 5:
                fullest = min(open_.values())
                closed = [s for s, room in open_.items() if room == fullest]
                left = {s for held in bins.held for s in held}
                gone = [s for s in closed if s not in left]
                assert len(gone) == 1
                del open_[gone[0]]
            assert (got, at) == (made, 0)
            open_[got], made = 64, made + 1
        open_[got] -= n
        if not open_[got]:
            del open_[got]


def test_shards_equal_plain_prefix_sums(spark, docs):
    import zlib

    rng = np.random.default_rng(12)
    rows = [(int(i), None if i % 17 == 0 else "é " * int(rng.integers(0, 300)), "x") for i in rng.permutation(500)]
    rows += [(1000 + i, "copy of one text", "y") for i in range(200)]
    out = {r.doc_id: r for r in sharding.shard_by_bytes(spark.createDataFrame(rows, SCHEMA), shards=16).collect()}
    plain = sorted((zlib.crc32((t or "").encode()), i, len((t or "").encode()) + 1) for i, t, _ in rows)
    total, before, slots = sum(size for *_, size in plain), 0, {}
    for crc, i, size in plain:
        shard = min(15, (2 * before + size) * 16 // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        assert (out[i].size, out[i].text_crc32, out[i].shard, out[i].slot) == (size, crc, shard, slots[shard])
        before += size
    assert set(slots) == set(range(16))


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(3)
    words, dim, hidden = 30, toxicity.DIM, toxicity.HIDDEN
    net = {"a": rng.normal(0, 0.5, 2 * hidden), "o": rng.normal(0, 0.5, 2 * hidden), "c": np.float64(0.1)}
    for d in "fb":
        net |= {"W" + d: rng.normal(0, 0.4, (dim, 3 * hidden)), "U" + d: rng.normal(0, 0.4, (hidden, 2 * hidden))}
        net |= {"V" + d: rng.normal(0, 0.4, (hidden, hidden)), "b" + d: rng.normal(0, 0.1, 3 * hidden)}
    net = {k: np.asarray(v, np.float64) for k, v in net.items()}
    x = rng.normal(0, 1, (words, dim))
    index = rng.integers(0, words, (5, 7))
    index[1, 4:] = -1  # a window shorter than the others
    y, weight = np.array([1.0, 0, 1, 0, 1]), rng.uniform(0.2, 1, 5)
    grad, d_x = toxicity._backward(net, x, index, y, weight)

    def loss(net, x):
        states = np.concatenate([toxicity._run(toxicity._gates(net, x, d), net, d, index) for d in "fb"], axis=2)
        logit = toxicity._pool(net, states, index.T < 0)[2].astype(float)
        return float((weight * (np.logaddexp(0, logit) - y * logit)).sum())

    for k in net:
        for _ in range(4):
            at = tuple(int(rng.integers(0, n)) for n in net[k].shape)
            up, down = ({**net, k: net[k] + sign * 1e-2 * _one(net[k], at)} for sign in (1, -1))
            assert abs((loss(up, x) - loss(down, x)) / 2e-2 - np.asarray(grad[k])[at]) < 2e-3, k
    for _ in range(6):
        at = int(rng.integers(0, words)), int(rng.integers(0, dim))
        step = 1e-2 * _one(x, at)
        assert abs((loss(net, x + step) - loss(net, x - step)) / 2e-2 - d_x[at]) < 2e-3


def _one(like, at):
    out = np.zeros_like(like)
    out[at] = 1
    return out
