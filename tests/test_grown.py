"""Leaf-capped trees against a plain best-first learner, and the ensembles against their recurrences."""

import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from queries import grow
from seriesloom.models import capped, grown, trees
from seriesloom.models.grown import Caps, Member


def plain_tree(x, y, w, caps):
    """Best-first growth over raw values: predictions of all rows and the number of leaves."""
    rows = w > 0

    def look(inside):
        best, n = None, len(inside)
        if n < max(2, caps.split):
            return None
        sums = lambda r: ((w[r, None] * y[r]).sum(axis=0) ** 2 / w[r].sum()).sum()
        for f in range(x.shape[1]):
            values = np.unique(x[inside, f])
            for v in values[:-1]:
                low, high = inside[x[inside, f] <= v], inside[x[inside, f] > v]
                if min(len(low), len(high)) < caps.leaf:
                    continue
                gain = sums(low) + sums(high) - sums(inside)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, low, high)
        return best

    leaves = [(np.flatnonzero(rows), 0)]
    found = [look(leaves[0][0]) if caps.depth is None or caps.depth > 0 else None]
    while caps.leaves is None or len(leaves) < caps.leaves:
        gains = [g[0] if g else -1 for g in found]
        at = int(np.argmax(gains))
        if gains[at] <= 0:
            break
        _, low, high = found[at]
        depth = leaves[at][1] + 1
        for side in (low, high):
            leaves.append((side, depth))
            found.append(look(side) if caps.depth is None or depth < caps.depth else None)
        del leaves[at], found[at]
    out = np.full((len(x), y.shape[1]), np.nan)
    for inside, _ in leaves:
        out[inside] = (w[inside, None] * y[inside]).sum(axis=0) / w[inside].sum()
    return out, len(leaves)


def data(seed, n=240):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = np.column_stack([np.round(9 * np.sin(x[:, 0]) + x[:, 1] + rng.integers(0, 5, n)), x[:, 2] * 2 + (x[:, 0] > 5) * 7 + rng.integers(0, 4, n)])
    return x, y


def frame(spark, x, y):
    rows = [(i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(x, y))]
    return trees.assemble(spark.createDataFrame(rows, "id int, a double, b double, c double, y double, z double").repartition(3), ["a", "b", "c"])


def table(spark, x, y, weight="1.0"):
    return capped._table(frame(spark, x, y), ["id"], [F.col("y"), F.col("z")], [F.expr(weight)])


CASES = [Caps(leaves=3), Caps(leaves=9, split=8, leaf=4), Caps(depth=3), Caps(leaves=30, leaf=3), Caps(leaves=1), Caps(split=500), Caps(depth=0)]


@pytest.mark.parametrize("in_memory", [0, 60, 20_000])
def test_trees_equal_plain_growth(spark, monkeypatch, in_memory):
    monkeypatch.setattr(grown, "IN_MEMORY", in_memory)
    x, y = data(1)
    made = table(spark, x, y, "CAST(id % 3 AS double)")
    w = np.array([float(i % 3) for i in range(len(x))])
    bins = np.column_stack([np.searchsorted(b, x[:, i], "left") for i, b in enumerate(made.bounds)]).astype(np.uint8)
    for caps in CASES:
        members = [Member((0,), 0, 1), Member((1,), 0, 2), Member((0, 1), 0, 3)]
        for member, tree in zip(members, made.grow(members, caps)):
            own = y[:, list(member.targets)]
            expected, leaves = plain_tree(x, own, w, caps)
            assert tree.n_leaves == leaves
            got = tree.predict(bins)
            assert np.allclose(got[w > 0], expected[w > 0])
            assert caps.leaves is None or tree.n_leaves <= caps.leaves
            assert tree.rows[tree.feature < 0].min() >= min(caps.leaf, len(x))


def test_few_rows_and_histograms_find_the_same_split():
    rng = np.random.default_rng(4)
    for _ in range(50):
        x = rng.integers(0, 30, (60, 4)).astype(np.uint8)
        stats = np.column_stack([np.ones(60), rng.integers(1, 4, 60), rng.integers(-9, 9, (60, 2))]).astype(float)
        caps = Caps(leaf=int(rng.integers(1, 9)))
        a, b = grown.best_split(grown.histogram(x, stats, 30), caps), grown.best_split_of_rows(x, stats, caps)
        assert a[:3] == pytest.approx(b[:3]) and np.allclose(a[3], b[3]) and np.allclose(a[4], b[4])


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select((F.col("id") * 1.0).alias("v"), (F.col("id") % 7).alias("few"), F.lit(None).cast("double").alias("none"))
    many, few, none = grown.fit_bins(df, [F.col("v"), F.col("few"), F.col("none")])
    assert 200 < len(many) < grown.BINS and list(few) == [i + 0.5 for i in range(6)] and len(none) == 0


def test_features_of_few_values_are_read_once_and_without_sketches(spark, monkeypatch):
    """Sketches of every feature in one aggregate took 19 of the 48 s before the first tree."""
    refused = lambda *_: pytest.fail("a second look at features of few values")
    monkeypatch.setattr(grown.F, "approx_count_distinct", refused)
    monkeypatch.setattr(grown.F, "percentile_approx", refused)
    monkeypatch.setattr(grown.F, "expr", refused)
    df = spark.range(0, 4000, 1, 5).select((F.col("id") % 204).cast("double").alias("most"), F.when(F.col("id") % 2 == 0, F.col("id") % 6).alias("holed"))
    most, holed = grown.fit_bins(df, [F.col("most"), F.col("holed")])
    assert list(most) == [i + 0.5 for i in range(203)] and list(holed) == [1.0, 3.0]


def test_values_few_in_each_task_but_many_in_all_are_cut_at_quantiles(spark):
    df = spark.range(0, 3000, 1, 30).select(F.col("id").alias("v"))  # 100 values a task
    (bounds,) = grown.fit_bins(df, [F.col("v")])
    assert 200 < len(bounds) < grown.BINS and abs(bounds[len(bounds) // 2] - 1500) < 30


def test_fits_of_the_fold_search_run_side_by_side(spark, monkeypatch):
    met = threading.Barrier(2, timeout=20)

    class Zero:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.0))

    def fit(df, keys, labels, **_):
        met.wait()
        return [Zero() for _ in labels]

    for name in ("forest", "boosted", "adaboost"):
        monkeypatch.setattr(capped, name, fit)
    rows = spark.range(40).select(F.col("id").alias("user_id"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(int(id % 31), 0)").alias("ts"), F.lit(0).alias("data_set"))
    rows = rows.withColumns({c: F.lit(1.0) for c in grow.SPEC.hourly_features} | {f"log_{s}_diff": F.lit(2.0) for s in grow.SEGMENTS})
    monkeypatch.setattr(grow.fitted, "_inputs", lambda *_: rows)
    out = grow.leaf_fold_scores(spark, "").collect()
    assert len({(r.family, r.segment, r.fold) for r in out}) == len(out) == 12 and all(r.mse == 4.0 and r.n > 0 for r in out)


def test_draws_follow_the_rate_and_repeat():
    rid = np.arange(200_000) * 7919
    counts = grown.drawn(rid, Member((0,), 0, 5, ("poisson", 0.7)))
    assert abs(counts.mean() - 0.7) < 0.01 and abs(counts.var() - 0.7) < 0.02
    assert abs(grown.drawn(rid, Member((0,), 0, 5, ("part", 0.3))).mean() - 0.3) < 0.01
    assert (grown.drawn(rid, Member((0,), 0, 5, ("poisson", 0.7))) == counts).all()
    assert (grown.drawn(rid, Member((0,), 0, 6, ("poisson", 0.7))) != counts).any()


def test_forest_averages_trees_of_its_draws(spark):
    x, y = data(2)
    df = frame(spark, x, y)
    caps = Caps(leaves=20, leaf=2)
    for joint in (False, True):
        models = capped.forest(df, ["id"], ["y", "z"], 6, caps, joint=joint)
        out = models[0].transform(df, ["p", "q"] if joint else "p")
        out = out if joint else models[1].transform(out, "q")
        got = np.array([(r.p, r.q) for r in out.orderBy("id").collect()])
        rid = np.array([r[0] for r in df.select("id", F.xxhash64("id").alias("r")).orderBy("id").select("r").collect()])
        seeds = [[7 * 1_000_003 + i * (1 if joint else 2) + j for i in range(6)] for j in range(1 if joint else 2)]
        expected = np.zeros_like(y)
        for j, own in enumerate(seeds):
            cols = [0, 1] if joint else [j]
            parts = []
            for s in own:
                w = grown.drawn(rid, Member(tuple(cols), 0, s, ("poisson", 1.0)))
                tree = grown.grow_branch(*_local(x, y[:, cols], w), caps=caps, seed=s)
                parts.append(grown._tree(tree, grown._chosen(tree, caps)[0]).predict(_bins(x)))
            expected[:, cols] = np.mean(parts, axis=0)
        assert np.allclose(got, expected)
        assert abs(models[0].featureImportances.toArray().sum() - 1) < 1e-9


def _bins(x):
    return np.column_stack([np.searchsorted(np.unique(c), c) for c in x.T]).astype(np.uint8)


def _local(x, y, w):
    part = w > 0
    stats = np.column_stack([np.ones(part.sum()), w[part], y[part] * w[part, None]])
    return _bins(x)[part], stats, grown._Node(stats.sum(axis=0), 0, 0), 12


def test_features_are_drawn_for_every_node(spark):
    x, y = data(3)
    model = capped.forest(frame(spark, x, y), ["id"], ["y"], 30, Caps(share=0.34, leaves=4))[0]
    roots = {int(t.feature[0]) for t in model.trees}
    assert roots == {0, 1, 2}  # one of three is looked at, whichever explains most


def test_boosting_follows_its_recurrence(spark, monkeypatch):
    monkeypatch.setattr(capped, "RESTAGE", 2)
    x, y = data(5)
    df = frame(spark, x, y)
    models = capped.boosted(df, ["id"], ["y", "z"], 7, 0.3, Caps(leaves=5))
    for j, model in enumerate(models):
        left = y[:, j] - y[:, j].mean()
        for tree in model.trees:
            expected, leaves = plain_tree(x, left[:, None], np.ones(len(x)), Caps(leaves=5))
            assert np.allclose(tree.predict(_bins(x))[:, 0], expected[:, 0]) and tree.n_leaves == leaves
            left = left - 0.3 * expected[:, 0]
        out = np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])
        assert np.allclose(out, y[:, j] - left)


def test_boosting_is_no_worse_than_the_library_at_equal_rounds(spark):
    x, y = data(6, 600)
    df = frame(spark, x, y)
    error = lambda out: out.agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    ours = error(capped.boosted(df, ["id"], ["y"], 20, 0.4, Caps(leaves=16, depth=4))[0].transform(df))
    theirs = error(trees.boosted("y", maxIter=20, maxDepth=4, stepSize=0.4).fit(df).transform(df))
    assert ours <= theirs * 1.05


def test_bagged_adaboost_follows_its_recurrence_in_few_jobs(spark):
    from seriesloom.models.adaboost import poisson_weight

    x, y = data(7, 150)
    df = frame(spark, x, y)
    bags, rounds, rate, caps = 4, 5, 0.5, Caps(leaves=6, split=4, leaf=2)
    sc = spark.sparkContext
    sc.setJobGroup("bags", "bags")
    models = capped.adaboost(df, ["id"], ["y", "z"], rounds, rate, caps, bags=bags)
    jobs = len(sc.statusTracker().getJobIdsForGroup("bags"))
    sc.setJobGroup("", "")
    assert jobs < 10 * rounds  # 20 bags of 50 rounds: the same jobs a round
    draws = np.array([[r[f"d{b}"] for b in range(bags)] for r in df.select("id", *(poisson_weight(["id"], b, 0.7, 7).alias(f"d{b}") for b in range(bags))).orderBy("id").collect()])
    for j, model in enumerate(models):
        medians, at = [], 0
        for b in range(bags):
            w, preds, votes = draws[:, b].copy(), [], []
            for _ in range(rounds):
                pred = plain_tree(x, y[:, [j]], w, caps)[0]
                tree = model.trees[at + len(preds)]
                full = tree.predict(_bins(x))[:, 0]
                assert np.allclose(full[w > 0], pred[w > 0, 0])
                miss = np.abs(y[:, j] - full)
                worst = miss[w > 0].max()
                loss = (w * miss / worst)[w > 0].sum() / w.sum()
                assert 0 < loss < 0.5
                beta = loss / (1 - loss)
                preds.append(full)
                votes.append(rate * math.log(1 / beta))
                w = np.where(w > 0, w / w.sum() * beta ** ((1 - miss / worst) * rate), 0)
            at += rounds
            preds, votes = np.array(preds), np.array(votes)
            order = preds.argsort(axis=0, kind="stable")
            pick = (votes[order].cumsum(axis=0) >= 0.5 * votes.sum() - 1e-12).argmax(axis=0)
            medians.append(np.take_along_axis(preds, np.take_along_axis(order, pick[None], 0), 0)[0])
        got = [r.prediction for r in model.transform(df).orderBy("id").collect()]
        assert np.allclose(got, np.mean(medians, axis=0))


def test_no_rows(spark):
    x, y = data(1, 5)
    df = frame(spark, x, y).where("id < 0")
    assert capped.forest(df, ["id"], ["y"], 2, Caps())[0].trees[0].n_leaves == 1
    with pytest.raises(ValueError):
        capped.adaboost(df, ["id"], ["y"], 2, 1.0, Caps())


@pytest.mark.parametrize("in_memory", [40, 20_000])
def test_trees_without_a_leaf_cap_are_stored_and_predict_the_same(spark, monkeypatch, in_memory):
    x, y = data(8)
    df = frame(spark, x, y)
    caps = Caps(depth=9, share=0.67)
    (whole,) = capped.forest(df, ["id"], ["y", "z"], 5, caps, joint=True)
    assert isinstance(whole, capped.Ensemble)
    monkeypatch.setattr(capped, "KEPT", 0)
    monkeypatch.setattr(grown, "IN_MEMORY", in_memory)
    (stored,) = capped.forest(df, ["id"], ["y", "z"], 5, caps, joint=True)
    assert isinstance(stored, capped.Stored)
    read = lambda m: np.array([(r.p, r.q) for r in m.transform(df, ["p", "q"]).orderBy("id").collect()])
    assert np.allclose(read(stored), read(whole))
    assert np.allclose(stored.featureImportances.toArray(), whole.featureImportances.toArray())


def test_growth_by_level_is_that_by_node():
    rng = np.random.default_rng(9)
    for caps in (Caps(), Caps(depth=6, share=0.4), Caps(split=6, leaf=3)):
        x = rng.integers(0, 40, (900, 5)).astype(np.uint8)
        stats = np.column_stack([np.ones(900), rng.integers(1, 4, 900), rng.normal(size=(900, 2))])
        nodes = grown.grow_branch(x, stats, grown._Node(stats.sum(axis=0), 0, 0), 40, caps, 5)
        slow = grown._tree(nodes, grown._chosen(nodes, caps)[0])
        fast = grown._cut(grown.grow_whole(x, stats, 0, 0, 40, caps, 5), caps)
        assert fast.n_leaves == slow.n_leaves
        other = rng.integers(0, 40, (500, 5)).astype(np.uint8)
        assert (fast.predict(other) == slow.predict(other)).all()


def test_the_driver_gets_trees_of_the_cap_only(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(grown, "IN_MEMORY", 100)
    got, plain = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: [got.append(r) or r for r in plain(self)])
    x, y = data(10, 2000)
    y = y + np.random.default_rng(1).normal(size=y.shape)
    made = table(spark, x, y)
    got.clear()
    (tree,) = made.grow([Member((0,), 0, 1)], Caps(leaves=50))
    assert tree.n_leaves == 50
    assert sum(len(r.found) for r in got if "found" in r) < 40_000  # large nodes alone; branches stay in their tasks
    assert [len(r.tree) < 5_000 for r in got if "tree" in r] == [True]
