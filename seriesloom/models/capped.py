"""Forests, boosting and AdaBoost.R2 of leaf-capped trees, all labels and bags of a round grown in the same jobs.

Settings of the original are the constants below. Several labels are fitted side
by side, as one model each, or (``joint``) by the same trees, whose leaves then
hold a value for each label.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.models.adaboost import _mean_of_medians, poisson_weight
from seriesloom.models import lanes as tasks
from seriesloom.models.grown import SENT_AT_ONCE, Caps, Member, Top, Tree, _bytes, _matrix, binned, codes, fit_bins, grow, grow_stored
from seriesloom.session import stage

# The settings of the original models.
FOREST = {"trees": 500, "caps": Caps(leaves=2**10, depth=20, split=8, leaf=4)}
DAILY_FOREST = {"trees": 10_000, "caps": Caps(depth=20, share=0.2), "joint": True}
BOOSTED = {"rounds": 500, "rate": 0.01, "part": 0.7, "caps": Caps(leaves=100, depth=10)}
ADABOOST = {"rounds": 500, "rate": 0.01, "caps": Caps(leaves=2**7, split=8, leaf=4)}
BAGS = {"bags": 20, "sample": 0.7, "rounds": 50, "rate": 0.1, "caps": Caps(leaves=2**10, split=8, leaf=4)}
STACK_FOREST = {"trees": 1000, "caps": Caps(leaves=2**14, depth=20, split=4, leaf=2)}
STACK_BOOSTED = {"rounds": 1000, "rate": 0.005, "part": 0.5, "caps": Caps(leaves=100, depth=10)}

RESTAGE = 4  # boosting rounds between two written tables of residuals; every job of a round applies the trees since
KEPT = 1_500_000  # leaves of all trees that the driver may hold


@dataclass
class Ensemble:
    """Trees, and the rule that makes one number of their predictions (rows x trees)."""

    trees: list[Tree]
    bounds: list[np.ndarray]
    combine: Callable[[np.ndarray], np.ndarray]
    weights: list[float] = field(default_factory=list)

    @property
    def featureImportances(self) -> DenseVector:
        """Shares of the gain by feature, averaged over the trees (by ``weights`` where given)."""
        total = np.zeros(len(self.bounds))
        for tree, w in zip(self.trees, self.weights or [1.0] * len(self.trees)):
            inner = tree.feature >= 0
            own = np.bincount(tree.feature[inner], tree.gain[inner], len(self.bounds))
            total += w * own / (own.sum() or 1.0)
        return DenseVector(total / (total.sum() or 1.0))

    def transform(self, df: DataFrame, out: str | list[str] = "prediction", rows_at_once: int = 4000) -> DataFrame:
        """Adds the prediction; of joint trees, one column a label."""
        combine, outs = self.combine, [out] if isinstance(out, str) else out
        bounds = self.bounds
        compact = [Tree(t.feature, t.bin, t.left, t.right, t.value, None, None) for t in self.trees]

        @F.pandas_udf("array<double>")
        def score(features: pd.Series) -> pd.Series:
            parts = []
            for at in range(0, len(features), rows_at_once):
                x = codes(np.stack(features.iloc[at : at + rows_at_once].to_list()), bounds)
                each = np.stack([t.predict(x) for t in compact], axis=1)
                parts.append(np.stack([combine(each[:, :, k]) for k in range(each.shape[2])], axis=1))
            return pd.Series(list(np.concatenate(parts)) if parts else [], dtype=object)

        scored = df.withColumn("__score", score(vector_to_array("features")))
        return scored.withColumns({name: F.col("__score")[i] for i, name in enumerate(outs)}).drop("__score")


@dataclass
class Stored:
    """A mean of trees that grow with the rows: their upper parts, and a staged table (member, node, tree) of the branches below.

    ``members`` are this ensemble's numbers in the table.
    """

    tops: list[Top]
    branches: DataFrame
    members: range
    bounds: list[np.ndarray]

    @property
    def _own(self) -> DataFrame:
        return self.branches.where(F.col("member").between(self.members.start, self.members.stop - 1))

    @property
    def featureImportances(self) -> DenseVector:
        """Shares of the gain by feature, averaged over the trees; what comes to the driver is a row a tree and feature."""
        width = len(self.bounds)

        def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for m, tree in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    own = Tree(**pickle.loads(tree))
                    inner = own.feature >= 0
                    total = np.bincount(own.feature[inner], own.gain[inner], width)
                    yield pa.RecordBatch.from_arrays([pa.array([m] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array(total)], names=["member", "feature", "gain"])

        found = self._own.select("member", "tree").mapInArrow(gains, "member int, feature int, gain double").groupBy("member", "feature").agg(F.sum("gain").alias("gain"))
        each = np.zeros((len(self.members), width))
        for m, top in zip(self.members, self.tops):
            inner = top.tree.feature >= 0
            each[m - self.members.start] += np.bincount(top.tree.feature[inner], top.tree.gain[inner], width)
        for r in found.collect():
            each[r.member - self.members.start, r.feature] += r.gain
        sums = each.sum(axis=1, keepdims=True)
        total = (each / np.where(sums > 0, sums, 1.0)).sum(axis=0)
        return DenseVector(total / (total.sum() or 1.0))

    def transform(self, df: DataFrame, out: str | list[str] = "prediction") -> DataFrame:
        """Adds the prediction; of joint trees, one column a label.

        Rows are staged, sent to the branch they fall into in every tree, and
        their predictions summed by row.
        """
        outs, bounds, spark = [out] if isinstance(out, str) else out, self.bounds, df.sparkSession
        kept = stage(df.withColumn("__row", F.monotonically_increasing_id()), "scored")
        sent = spark.sparkContext.broadcast(cloudpickle.dumps([(m, top.tree, top.branch) for m, top in zip(self.members, self.tops)]))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops = pickle.loads(sent.value)
            for b in batches:
                if not b.num_rows:
                    continue
                row, raw = b.column(0).to_numpy(), _matrix(b.column(1))
                x = codes(raw, bounds)
                moved, size = [], 0
                for m, tree, branch in tops:
                    at = tree.leaf_of(x)
                    for leaf, node in branch.items():
                        here = np.flatnonzero(at == leaf)
                        if len(here):
                            moved.append((m, node, 1, None, row[here].tobytes() + x[here].tobytes()))
                            size += len(moved[-1][4])
                    if size > SENT_AT_ONCE:
                        yield _batch(moved, _ROUTED)
                        moved, size = [], 0
                if moved:
                    yield _batch(moved, _ROUTED)

        width, k = len(bounds), len(outs)
        names = [f"__p{i}" for i in range(k)]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = None
            for b in batches:
                done = []
                for kind, branch, rows in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                    if kind == 0:
                        tree = Tree(**pickle.loads(branch))
                        continue
                    n = len(rows) // (8 + width)
                    value = tree.predict(np.frombuffer(rows, np.uint8, n * width, 8 * n).reshape(n, width))
                    done.append(np.column_stack((np.frombuffer(rows, np.int64, n), value.astype(float).view(np.int64))))
                if done:
                    all_ = np.concatenate(done)
                    yield pa.RecordBatch.from_arrays([pa.array(all_[:, 0]), *(pa.array(np.ascontiguousarray(all_[:, 1 + i]).view(float)) for i in range(k))], names=["__row", *names])

        routed = kept.select("__row", vector_to_array("features").alias("f")).mapInArrow(route, "member int, node int, kind int, tree binary, rows binary")
        trees = self._own.select("member", "node", F.lit(0).alias("kind"), "tree", F.lit(None).cast("binary").alias("rows"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        met = routed.unionByName(trees).repartition(parts, "member", "node").sortWithinPartitions("member", "node", "kind")
        each = met.mapInArrow(score, "__row long, " + ", ".join(f"{n} double" for n in names))
        means = each.groupBy("__row").agg(*((F.sum(n) / F.lit(float(len(self.members)))).alias(o) for n, o in zip(names, outs)))
        return kept.join(means, "__row", "left").drop("__row")


class Regrown(Stored):
    """A mean of more trees than the driver may hold, of rows that a task may hold: they are
    grown where they predict, by tasks that take some of them each, and not kept."""

    def __init__(self, data: _Table, targets: tuple[int, ...], members: list[Member], caps: Caps):
        self.data, self.targets, self.grown, self.caps, self.bounds = data, targets, list(enumerate(members)), caps, data.bounds

    def _run(self, work: Callable, result: dict[str, pa.DataType], asked: DataFrame | None = None) -> DataFrame:
        n = min(len(self.grown), self.data.slots)
        shares = [tasks.Share(self.targets, 0, work(self.grown[g::n], self.caps, self.data.n_bins)) for g in range(n)]
        return tasks.run(self.data.rows, len(self.bounds), shares, {"share": pa.int32()} | result, asked)

    @property
    def featureImportances(self) -> DenseVector:
        found = self._run(tasks.forest_gains, {"none": pa.binary(), "gains": pa.binary()}).orderBy("share").collect()
        total = sum((np.frombuffer(r.gains, float) for r in found), np.zeros(len(self.bounds)))
        return DenseVector(total / (total.sum() or 1.0))

    def transform(self, df: DataFrame, out: str | list[str] = "prediction") -> DataFrame:
        """Adds the prediction; of joint trees, one column a label. Where a task can't hold all rows, parts of them are predicted one after the other."""
        outs, bounds, width = [out] if isinstance(out, str) else out, self.bounds, len(self.bounds)
        kept = stage(df.withColumn("__row", F.monotonically_increasing_id()), "scored")
        names = [f"__p{i}" for i in range(len(outs))]

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = codes(_matrix(b.column(1)), bounds)
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["row", "x"])

        def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for rows, sums in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    values = np.frombuffer(sums, float).reshape(len(names), -1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rows, np.int64)), *map(pa.array, values)], names=["__row", *names])

        asked = kept.select("__row", vector_to_array("features").alias("f")).mapInArrow(cut, "row long, x binary")
        parts = -(-kept.count() * (width + 8 * len(outs) + 48) // tasks.IN_TASK) or 1
        found = None
        for i in range(parts):
            own = asked if parts == 1 else asked.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == i)
            sums = self._run(tasks.forest_means, {"rows": pa.binary(), "sums": pa.binary()}, own)
            sums = sums.mapInArrow(apart, "__row long, " + ", ".join(f"{n} double" for n in names))
            sums = stage(sums.groupBy("__row").agg(*((F.sum(n) / F.lit(float(len(self.grown)))).alias(o) for n, o in zip(names, outs))), "means")
            found = sums if found is None else found.unionByName(sums)
        return kept.join(found, "__row", "left").drop("__row")


_ROUTED = {"member": pa.int32(), "node": pa.int32(), "kind": pa.int32(), "tree": pa.binary(), "rows": pa.binary()}


def _batch(rows: list[tuple], schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.values())], names=list(schema))


@dataclass
class _Table:
    rows: DataFrame
    bounds: list[np.ndarray]
    n: int

    def grow(self, members: list[Member], caps: Caps, **offset) -> list[Tree]:
        return grow(self.rows, members, caps, len(self.bounds), self.n_bins, self.n, **offset)

    @property
    def n_bins(self) -> int:
        return max(map(len, self.bounds), default=0) + 1

    @property
    def slots(self) -> int:
        """Tasks that may grow side by side."""
        return max(1, self.rows.sparkSession.sparkContext.defaultParallelism)

    def in_task(self, targets: int = 1, share: float = 1.0) -> bool:
        """Whether a task may hold that share of the rows."""
        return self.n > 0 and tasks.fits(math.ceil(self.n * share), len(self.bounds), targets)

    def in_tasks(self, shares: list[tasks.Share]) -> dict[int, list[tuple[float, Tree]]]:
        return tasks.collected(tasks.run(self.rows, len(self.bounds), shares, tasks.TREES))


def _table(df: DataFrame, keys: list[str], targets: list[Column], weights: list[Column]) -> _Table:
    """Binned rows of an assembled table (``features``, keys and labels)."""
    width = df.schema["features"].metadata["ml_attr"]["num_attrs"]
    df = df.withColumn("__f", vector_to_array("features"))
    features = [F.col("__f")[i] for i in range(width)]
    bounds = fit_bins(df, features)
    rows = binned(df, features, bounds, keys, targets, weights)
    return _Table(rows, bounds, rows.count())


def _mean(each: np.ndarray) -> np.ndarray:
    return each.mean(axis=1)


def forest(df: DataFrame, keys: list[str], labels: list[str], trees: int, caps: Caps, sample: float = 1.0, joint: bool = False, seed: int = 7) -> list[Ensemble | Stored]:
    """Bagged trees: one ensemble a label, or a single one whose trees hold all labels. ``sample``: draws per row.

    Trees without a leaf cap are stored where the driver could not hold them.
    """
    data = _table(df, keys, [F.col(c) for c in labels], [F.lit(1.0)])
    lanes = [tuple(range(len(labels)))] if joint else [(i,) for i in range(len(labels))]
    members = [Member(lane, 0, seed * 1_000_003 + i * len(lanes) + j, ("poisson", sample)) for j, lane in enumerate(lanes) for i in range(trees)]
    many = len(members) * min(data.n, caps.leaves or data.n) > KEPT
    if data.in_task(len(lanes[0])):
        if many:
            return [Regrown(data, lane, members[j * trees : (j + 1) * trees], caps) for j, lane in enumerate(lanes)]
        return [Ensemble(own, data.bounds, _mean) for own in _grown_in_tasks(data, lanes, members, caps)]
    if caps.leaves is None and many:
        tops, branches = grow_stored(data.rows, members, caps, len(data.bounds), data.n_bins, data.n)
        own = [range(j * trees, (j + 1) * trees) for j in range(len(lanes))]
        return [Stored([tops[m] for m in r], branches, r, data.bounds) for r in own]
    made = data.grow(members, caps)
    return [Ensemble(made[j * trees : (j + 1) * trees], data.bounds, _mean) for j in range(len(lanes))]


def _grown_in_tasks(data: _Table, lanes: list[tuple[int, ...]], members: list[Member], caps: Caps) -> list[list[Tree]]:
    """The trees of each lane, dealt to as many tasks as run side by side."""
    trees = len(members) // len(lanes)
    per = max(1, min(trees, data.slots // len(lanes)))
    numbered = [list(enumerate(members))[j * trees : (j + 1) * trees][g::per] for j in range(len(lanes)) for g in range(per)]
    found = data.in_tasks([tasks.Share(own[0][1].targets, 0, tasks.forest_share(own, caps, data.n_bins)) for own in numbered])
    made = {m: tree for share, own in found.items() for (m, _), (_, tree) in zip(numbered[share], own)}
    return [[made.get(j * trees + i) or _leaf(len(lane)) for i in range(trees)] for j, lane in enumerate(lanes)]


def _leaf(targets: int) -> Tree:
    """The tree of no rows."""
    zero = np.zeros(1, np.int32)
    return Tree(np.full(1, -1, np.int16), zero, zero, zero, np.zeros((1, targets)), np.zeros(1), zero)


def single(df: DataFrame, keys: list[str], labels: list[str], caps: Caps, joint: bool = False) -> list[Ensemble]:
    """One tree a label (or one for all) on every row, each once."""
    data = _table(df, keys, [F.col(c) for c in labels], [F.lit(1.0)])
    lanes = [tuple(range(len(labels)))] if joint else [(i,) for i in range(len(labels))]
    return [Ensemble([t], data.bounds, _mean) for t in data.grow([Member(lane, 0, j) for j, lane in enumerate(lanes)], caps)]


def _subtract(rows: DataFrame, offset: list[tuple[int, Tree]], rate: float) -> DataFrame:
    def less(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = _bytes(b.column(1)), _matrix(b.column(2)).copy()
                for target, tree in offset:
                    y[:, target] -= rate * tree.predict(x)[:, 0]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(y), pa.list_(pa.float64())), b.column(3)], names=["rid", "x", "y", "w"])

    return stage(rows.mapInArrow(less, rows.schema), "residuals")


def boosted(df: DataFrame, keys: list[str], labels: list[str], rounds: int, rate: float, caps: Caps, part: float = 1.0, seed: int = 7) -> list[Ensemble]:
    """Squared-loss boosting; a round fits the next tree of every label to what is left, on a drawn part of the rows."""
    means = [m or 0.0 for m in df.agg(*(F.avg(c) for c in labels)).first()]
    data = _table(df, keys, [F.col(c) - F.lit(m) for c, m in zip(labels, means)], [F.lit(1.0)])
    made: list[list[Tree]] = [[] for _ in labels]
    offset: list[tuple[int, Tree]] = []
    member = lambda r, i: Member((i,), 0, seed * 1_000_003 + r * len(labels) + i, ("part", part) if part < 1 else None)
    if data.in_task():
        found = data.in_tasks([tasks.Share((i,), 0, tasks.boosted_share([member(r, i) for r in range(rounds)], rate, caps, data.n_bins)) for i in range(len(labels))])
        made = [[t for _, t in found[i]] if i in found else [_leaf(1)] * rounds for i in range(len(labels))]
    for r in range(0 if data.in_task() else rounds):
        if len(offset) >= RESTAGE * len(labels):
            data.rows, offset = _subtract(data.rows, offset, rate), []
        members = [member(r, i) for i in range(len(labels))]
        for i, tree in enumerate(data.grow(members, caps, offset=offset, rate=rate)):
            made[i].append(tree)
            offset.append((i, tree))
    return [Ensemble(own, data.bounds, _Sum(mean, rate)) for own, mean in zip(made, means)]


@dataclass
class _Sum:
    base: float
    rate: float

    def __call__(self, each: np.ndarray) -> np.ndarray:
        return self.base + self.rate * each.sum(axis=1)


def adaboost(df: DataFrame, keys: list[str], labels: list[str], rounds: int, rate: float, caps: Caps, bags: int | None = None, sample: float = 0.7, seed: int = 7) -> list[Ensemble]:
    """AdaBoost.R2 (Drucker 1997) with linear loss, once a label or for ``bags`` draws with replacement of each."""
    bounds, lanes = boosted_lanes(df, keys, labels, rounds, rate, caps, bags, sample, seed)
    per = len(lanes) // len(labels)
    out = []
    for i in range(len(labels)):
        own = lanes[i * per : (i + 1) * per]
        out.append(Ensemble([t for trees, _ in own for t in trees], bounds, _mean_of_medians([votes for _, votes in own]), [v for _, votes in own for v in votes]))
    return out


def boosted_lanes(
    df: DataFrame, keys: list[str], labels: list[str], rounds: int, rate: float, caps: Caps, bags: int | None = None, sample: float = 0.7, seed: int = 7, weight: str | None = None
) -> tuple[list[np.ndarray], list[tuple[list[Tree], list[float]]]]:
    """Bounds of the bins, and the trees and votes of every lane: of all bags of the first label, then of the next. ``weight``: a column to start from.

    Lanes (label and bag) whose rows a task can hold run there, all rounds of one in
    one task. Otherwise a round grows one weighted tree per lane, measures all lanes
    in one aggregate and writes the rows with their next weights. A lane stops
    at a perfect tree, or at one no better than a coin.
    """
    start = F.col(weight) if weight else F.lit(1.0)
    draws = [start] if bags is None else [poisson_weight(keys, b, sample, seed) for b in range(bags)]
    data = _table(df, keys, [F.col(c) for c in labels], draws)
    lanes = [(label, label * len(draws) + b) for label in range(len(labels)) for b in range(len(draws))]
    trees: list[list[Tree]] = [[] for _ in lanes]
    votes: list[list[float]] = [[] for _ in lanes]
    active = list(range(len(lanes)))
    # Bags of Poisson draws hold 1 - exp(-sample) of the rows, by far less than a hundredth more.
    in_task = data.in_task(share=1.0 if bags is None else min(1.0, 1.01 - math.exp(-sample)))
    if in_task:
        seeds = [[seed * 1_000_003 + r * len(lanes) + a for r in range(rounds)] for a in active]
        found = data.in_tasks([tasks.Share((label,), weight % len(draws), tasks.adaboost_share(own, rate, caps, data.n_bins)) for (label, weight), own in zip(lanes, seeds)])
        if len(found) < len(lanes) and rounds:
            raise ValueError("no training rows")
        for a, own in found.items():
            votes[a], trees[a] = ([p[i] for p in own] for i in (0, 1))
    else:
        data.rows = data.rows.withColumn("w", F.flatten(F.array_repeat("w", len(labels))))
    for r in range(0 if in_task else rounds):
        members = [Member((lanes[a][0],), lanes[a][1], seed * 1_000_003 + r * len(lanes) + a) for a in active]
        fresh = dict(zip(active, data.grow(members, caps)))
        measured = {m.lane: m for m in _measure(data.rows, {a: (*lanes[a], t) for a, t in fresh.items()}).collect()}
        go_on = {}
        for a, tree in fresh.items():
            m = measured.get(a)
            if m is None:
                raise ValueError("no training rows")
            loss = m.weighted / (m.worst * m.total) if m.worst > 0 else 0.0
            if loss <= 0 or (loss >= 0.5 and not trees[a]):
                trees[a].append(tree)
                votes[a].append(1.0)
            elif loss < 0.5:
                beta = loss / (1.0 - loss)
                trees[a].append(tree)
                votes[a].append(rate * math.log(1.0 / beta))
                go_on[a] = (*lanes[a], tree, beta, m.worst, m.total)
        active = list(go_on)
        if not active or r + 1 == rounds:
            break
        data.rows = _reweighted(data.rows, list(go_on.values()), rate)
    return data.bounds, list(zip(trees, votes))


def _measure(rows: DataFrame, lanes: dict) -> DataFrame:
    """lane, worst miss, weighted miss and total weight of the new trees."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y, w = _bytes(b.column(1)), _matrix(b.column(2)), _matrix(b.column(3))
            out = []
            for lane, (label, weight, tree) in lanes.items():
                part = np.flatnonzero((w[:, weight] > 0) & ~np.isnan(y[:, label]))
                if len(part):
                    miss = np.abs(y[part, label] - tree.predict(x[part])[:, 0])
                    out.append((lane, miss.max(), (w[part, weight] * miss).sum(), w[part, weight].sum()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["lane", "worst", "weighted", "total"])

    found = rows.mapInArrow(measure, "lane long, worst double, weighted double, total double")
    return found.groupBy("lane").agg(F.max("worst").alias("worst"), F.sum("weighted").alias("weighted"), F.sum("total").alias("total"))


def _reweighted(rows: DataFrame, lanes: list[tuple], rate: float) -> DataFrame:
    """Rows a tree got right lose weight; weights are rescaled to stay in range."""

    def reweigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y, w = _bytes(b.column(1)), _matrix(b.column(2)), _matrix(b.column(3)).copy()
                for label, weight, tree, beta, worst, total in lanes:
                    right = (1.0 - np.abs(y[:, label] - tree.predict(x)[:, 0]) / worst) * rate
                    w[:, weight] = np.where(w[:, weight] > 0, w[:, weight] / total * beta**right, 0.0)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(list(np.nan_to_num(w)), pa.list_(pa.float64()))], names=["rid", "x", "y", "w"])

    return stage(rows.mapInArrow(reweigh, rows.schema), "weights")


class Capped:
    """One label's model in the manner of an estimator, for plans and fold searches: ``Capped("y", keys, forest, **FOREST)``."""

    def __init__(self, label: str, keys: list[str], how: Callable[..., list[Ensemble]], **settings):
        self.label, self.keys, self.how, self.settings = label, keys, how, settings

    def fit(self, df: DataFrame) -> Ensemble:
        return self.how(df, self.keys, [self.label], **self.settings)[0]
