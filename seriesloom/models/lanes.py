"""Whole fits inside tasks: a task that can hold the binned rows grows all trees of its share, so no job runs a tree or a round.

A share is what one task does: the rounds of one lane (a label, or a bag of one), or some trees of
a forest. Each share gets the rows it draws from once. Draws, splits and ties are those of
``grown``, whose jobs grow the trees of larger tables; results differ by the rounding of sums only.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.models.grown import FEW_ROWS, SENT_AT_ONCE, Caps, Member, Tree, _bytes, _compact, _gain, _grain, _looked_at, _matrix, best_split, drawn, grow_whole

IN_TASK = 320 << 20  # bytes of rows and work that a task may hold
SIBLINGS = 50_000  # rows from which a node's histogram is its parent's less its sibling's
TREES = {"share": pa.int32(), "number": pa.int32(), "vote": pa.float64(), "tree": pa.binary()}


def fits(n_rows: int, width: int, targets: int = 1) -> bool:
    """Whether a task may hold a table: bins, targets, weights and what growth needs beside them."""
    return n_rows * (width + 16 * targets + 40) <= IN_TASK


@dataclass(frozen=True)
class Share:
    """The columns that one task reads, and what it does with their rows: rows for the result, without the share's number."""

    targets: tuple[int, ...]
    weight: int
    work: Callable[["Rows"], Iterator[tuple]]


@dataclass
class Rows:
    """A share's rows, a feature's bins in one piece; and rows to predict (numbers, bins), where asked for."""

    rid: np.ndarray
    x: np.ndarray  # features x rows
    y: np.ndarray  # rows x targets
    w: np.ndarray
    asked: np.ndarray
    asked_x: np.ndarray

    @property
    def differing(self) -> np.ndarray:
        """The features that have more than one bin, and the first, whose histogram gives a node's sums."""
        return np.flatnonzero([f == 0 or (len(c) > 0 and c.min() < c.max()) for f, c in enumerate(self.x)])


# Jobs


def run(table: DataFrame, width: int, shares: list[Share], result: dict[str, pa.DataType], asked: DataFrame | None = None) -> DataFrame:
    """What all shares make of a ``binned`` table. ``asked``: rows to predict, as (row, x)."""
    spark = table.sparkSession
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(shares))
    schema = "share int, kind int, part long, payload binary"
    moved = table.mapInArrow(_sender([(list(s.targets), s.weight) for s in shares]), schema)
    if asked is not None:
        moved = moved.unionByName(asked.mapInArrow(_asker(len(shares)), schema))
    dealt = moved.repartitionById(len(shares), F.col("share")).sortWithinPartitions("share", "kind", "part")
    names = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary"}
    return dealt.mapInArrow(_worker(sent, width, result), ", ".join(f"{n} {names[t]}" for n, t in result.items()))


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


_SENT = ([pa.int32(), pa.int32(), pa.int64(), pa.binary()], ["share", "kind", "part", "payload"])


def _sender(asks: list[tuple[list[int], int]]):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 20
        for b in batches:
            if not b.num_rows:
                continue
            rid, x, y, w = b.column(0).to_numpy(), _bytes(b.column(1)), _matrix(b.column(2)), _matrix(b.column(3))
            out, size, part = [], 0, part + 1
            for share, (targets, weight) in enumerate(asks):
                own = y[:, targets]
                here = np.flatnonzero((w[:, weight] > 0) & ~np.isnan(own).any(axis=1))
                if len(here):
                    payload = b"".join(a.tobytes() for a in (np.array([len(here)], np.int64), rid[here].astype(np.int64), w[here, weight], own[here], x[here].T))
                    out.append((share, 0, part, payload))
                    size += len(payload)
                if size > SENT_AT_ONCE:
                    yield _batch(out, *_SENT)
                    out, size = [], 0
            if out:
                yield _batch(out, *_SENT)

    return send


def _asker(shares: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 20
        for b in batches:
            if b.num_rows:
                part += 1
                payload = np.array([b.num_rows], np.int64).tobytes() + b.column(0).to_numpy().astype(np.int64).tobytes() + _bytes(b.column(1)).tobytes()
                for share in range(shares):
                    yield _batch([(share, 1, part, payload)], *_SENT)

    return send


def _worker(sent, width: int, result: dict[str, pa.DataType]):
    types, names = list(result.values()), list(result)

    def rows_of(held: tuple[list, list], targets: int) -> Rows:
        parts, asked = held
        n = [int(np.frombuffer(p, np.int64, 1)[0]) for p in parts]
        total, at = sum(n), 0
        out = Rows(np.empty(total, np.int64), np.empty((width, total), np.uint8), np.empty((total, targets)), np.empty(total), np.zeros(0, np.int64), np.zeros((0, width), np.uint8))
        for m, p in zip(n, parts):
            to, base = slice(at, at + m), 8
            for into, kind, size in ((out.rid, np.int64, m), (out.w, float, m), (out.y, float, m * targets)):
                into[to] = np.frombuffer(p, kind, size, base).reshape(into[to].shape)
                base += 8 * size
            out.x[:, to] = np.frombuffer(p, np.uint8, width * m, base).reshape(width, m)
            at += m
        if asked:
            n = [int(np.frombuffer(p, np.int64, 1)[0]) for p in asked]
            out.asked = np.concatenate([np.frombuffer(p, np.int64, m, 8) for m, p in zip(n, asked)])
            out.asked_x = np.concatenate([np.frombuffer(p, np.uint8, m * width, 8 + 8 * m).reshape(m, width) for m, p in zip(n, asked)])
        held[0].clear()
        held[1].clear()
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares, share, held = pickle.loads(sent.value), None, ([], [])

        def done() -> Iterator[pa.RecordBatch]:
            out, size = [], 0
            for row in shares[share].work(rows_of(held, len(shares[share].targets))):
                out.append((share, *row))
                size += sum(len(v) for v in row if isinstance(v, bytes))
                if size > SENT_AT_ONCE:
                    yield _batch(out, types, names)
                    out, size = [], 0
            if out:
                yield _batch(out, types, names)

        for b in batches:
            for s, kind, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if s != share:
                    if share is not None:
                        yield from done()
                    share = s
                held[kind].append(payload.as_buffer())
        del batches
        if share is not None:
            yield from done()

    return work


def collected(found: DataFrame) -> dict[int, list[tuple[float, Tree]]]:
    """Votes and trees of every share, in their order."""
    out: dict[int, list] = {}
    for r in sorted(found.collect(), key=lambda r: (r.share, r.number)):
        out.setdefault(r.share, []).append((r.vote, Tree(**pickle.loads(r.tree))))
    return out


# Growth


def _histogram(x: np.ndarray, stats: list[np.ndarray | None], inside: np.ndarray, n_bins: int) -> np.ndarray:
    """Counts and sums over (feature, bin). ``None``: a statistic that is 1 a row."""
    out = np.empty((1 + len(stats), len(x), n_bins))
    own = [None if s is None else s.take(inside) for s in stats]
    for f, column in enumerate(x):
        at = column.take(inside).astype(np.intp)
        out[0, f] = np.bincount(at, minlength=n_bins)
        for i, s in enumerate(own):
            out[1 + i, f] = out[0, f] if s is None else np.bincount(at, s, n_bins)
    return out


def _best_of_few(x: np.ndarray, stats: np.ndarray, caps: Caps, mask: np.ndarray | None) -> tuple | None:
    """``best_split_of_rows`` of features x rows."""
    n, total = x.shape[1], stats.sum(axis=0)
    key = np.sort((x.astype(np.uint16) << 8) + np.arange(n, dtype=np.uint16), axis=1)
    order, values = (key & 255).astype(np.intp), key >> 8
    left = stats.T[1:].take(order, axis=1).cumsum(axis=2)[:, :, :-1]
    rows = np.arange(1.0, n)
    left = np.concatenate((np.broadcast_to(rows, (1, *left.shape[1:])), left))
    right = total[:, None, None] - left
    ok = (values[:, 1:] != values[:, :-1]) & (left[1] > 0) & (right[1] > 0)
    if caps.leaf > 1:
        ok &= (rows >= caps.leaf) & (n - rows >= caps.leaf)
    if mask is not None:
        ok &= mask[:, None]
    if not ok.any():
        return None
    gain = np.where(ok, _gain(left, right, total[:, None, None]), -np.inf)
    f, i = divmod(int(gain.argmax()), n - 1)
    if not gain[f, i] > _grain(total):
        return None
    return float(gain[f, i]), f, int(values[f, i]), left[:, f, i], right[:, f, i]


def grow_best(x: np.ndarray, stats: list[np.ndarray | None], inside: np.ndarray, features: np.ndarray, n_bins: int, caps: Caps, seed: int, width: int) -> tuple[Tree, dict[int, np.ndarray]]:
    """The tree that ``grow_branch`` grows from the rows ``inside``, and the rows of each of its leaves.

    ``x`` holds the ``features`` that differ; ``stats`` weights and weighted targets of all rows.
    """
    weight, *own_sums = (np.ones(len(inside)) if s is None else s.take(inside) for s in stats)
    total = np.array([float(len(inside)), *(s.cumsum()[-1] if len(s) else 0.0 for s in (weight, *own_sums))])  # one after the other, as ``grow_branch`` sums
    noise = 1e-15 * sum(float((s * s / weight).sum()) for s in own_sums)  # gains up to this may come from a difference of histograms
    del weight, own_sums
    keep = max(SIBLINGS, len(inside) // 256)
    sums, depths, places, rows = [total], [0], [0], {0: inside}
    feature, cut, low, high, gains = [-1], [0], [0], [0], [0.0]
    heap: list[tuple] = []
    numbers, given_out = [0], 1  # as ``grow_branch`` numbers nodes, which decides between equal gains

    def may(n: int, depth: int) -> bool:
        return n >= max(2, caps.split, 2 * caps.leaf) and (caps.depth is None or depth < caps.depth)

    def look(at: int, hist: np.ndarray | None = None, derived: bool = False) -> None:
        nonlocal given_out
        own = rows[at]
        if not len(x) or not may(len(own), depths[at]):
            return
        mask = _looked_at(seed, places[at], width, caps.share)
        mask = None if mask is None else mask[features]
        if len(own) <= FEW_ROWS:
            own_stats = np.column_stack([np.ones(len(own)), *(np.ones(len(own)) if s is None else s.take(own) for s in stats)])
            found, hist = _best_of_few(x.take(own, axis=1), own_stats, caps, mask), None
        else:
            hist = _histogram(x, stats, own, n_bins) if hist is None else hist
            found = best_split(hist, caps, mask)
        if found is not None and not (derived and found[0] <= noise):
            heapq.heappush(heap, (-found[0], numbers[at], at, given_out, found, hist if len(own) > keep else None, derived))
            given_out += 2

    look(0)
    leaves = 1
    while heap and (caps.leaves is None or leaves < caps.leaves):
        gain, _, at, number, (_, f, b, *both), hist, derived = heapq.heappop(heap)
        leaves += 1
        own = rows.pop(at)
        goes = x[f].take(own) <= b
        first = len(sums)
        feature[at], cut[at], low[at], high[at], gains[at] = int(features[f]), b, first, first + 1, -gain
        for side, part in enumerate((own[goes], own[~goes])):
            rows[first + side] = part
            sums.append(both[side])
            depths.append(depths[at] + 1)
            places.append(2 * places[at] + 1 + side)
            numbers.append(number + side)
            feature.append(-1), cut.append(0), low.append(first + side), high.append(first + side), gains.append(0.0)
        if caps.leaves is not None and leaves == caps.leaves:
            break
        given: list = [None, None]
        larger = int(len(rows[first + 1]) > len(rows[first]))
        if hist is not None and len(rows[first + larger]) > keep and may(len(rows[first + larger]), depths[first]):
            given[1 - larger] = _histogram(x, stats, rows[first + 1 - larger], n_bins)
            given[larger] = hist - given[1 - larger]
        hist = None
        for side in (0, 1):
            look(first + side, given[side], derived or (given[side] is not None and side == larger))
    all_ = np.array(sums)
    weight = all_[:, 1:2]
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(weight > 0, all_[:, 2:] / weight, 0.0)
    small = lambda v, t: np.array(v, t)
    return Tree(small(feature, np.int16), small(cut, np.int16), small(low, np.int32), small(high, np.int32), value, small(gains, float), all_[:, 0].astype(np.int32)), rows


def _grown(rows: Rows, x: np.ndarray, weight: np.ndarray | None, y: np.ndarray, inside: np.ndarray, features: np.ndarray, n_bins: int, caps: Caps, seed: int) -> tuple[Tree, dict[int, np.ndarray] | None]:
    """A tree of some rows, and the rows of its leaves where growth has them."""
    if caps.leaves is None:
        own = np.ones(len(inside)) if weight is None else weight[inside]
        stats = np.column_stack((np.ones(len(inside)), own, y[inside] * own[:, None]))
        nodes = grow_whole(np.ascontiguousarray(rows.x[:, inside].T), stats, 0, 0, n_bins, caps, seed)
        return _compact(nodes, nodes["low"] >= 0), None
    stats = [weight, *(np.ascontiguousarray(y[:, k]) if weight is None else weight * y[:, k] for k in range(y.shape[1]))]
    return grow_best(x, stats, inside, features, n_bins, caps, seed, len(rows.x))


def leaf_rows(tree: Tree, x: np.ndarray, inside: np.ndarray) -> dict[int, np.ndarray]:
    """The rows ``inside`` that come to each leaf; ``x`` is features x rows."""
    rows = {0: inside}
    for at in np.flatnonzero(tree.feature >= 0).tolist():  # parents come before their children
        own = rows.pop(at)
        goes = x[tree.feature[at]].take(own) <= tree.bin[at]
        rows[int(tree.left[at])], rows[int(tree.right[at])] = own[goes], own[~goes]
    return rows


# Shares


def forest_share(members: list[tuple[int, Member]], caps: Caps, n_bins: int) -> Callable[[Rows], Iterator[tuple]]:
    """Some trees of a forest, by their numbers."""

    def work(rows: Rows) -> Iterator[tuple]:
        for number, tree in forest_trees(rows, members, caps, n_bins):
            yield number, 1.0, pickle.dumps(vars(tree))

    return work


def forest_trees(rows: Rows, members: list[tuple[int, Member]], caps: Caps, n_bins: int) -> Iterator[tuple[int, Tree]]:
    features = rows.differing
    x = rows.x[features]
    for number, member in members:
        weight = rows.w * drawn(rows.rid, member)
        inside = np.flatnonzero(weight > 0).astype(np.int32)
        yield number, _grown(rows, x, weight, rows.y, inside, features, n_bins, caps, member.seed)[0]


def forest_means(members: list[tuple[int, Member]], caps: Caps, n_bins: int, parts: int = 50_000) -> Callable[[Rows], Iterator[tuple]]:
    """Sums of the predictions of some trees for the rows asked for; the trees are not kept."""

    def work(rows: Rows) -> Iterator[tuple]:
        sums = np.zeros((len(rows.asked), rows.y.shape[1]))
        for _, tree in forest_trees(rows, members, caps, n_bins):
            for at in range(0, len(sums), parts):
                sums[at : at + parts] += tree.predict(rows.asked_x[at : at + parts])
        for at in range(0, len(sums), parts):
            yield rows.asked[at : at + parts].tobytes(), sums[at : at + parts].T.tobytes()

    return work


def forest_gains(members: list[tuple[int, Member]], caps: Caps, n_bins: int) -> Callable[[Rows], Iterator[tuple]]:
    """Gain shares by feature, summed over some trees."""

    def work(rows: Rows) -> Iterator[tuple]:
        width = len(rows.x)
        total = np.zeros(width)
        for _, tree in forest_trees(rows, members, caps, n_bins):
            inner = tree.feature >= 0
            own = np.bincount(tree.feature[inner], tree.gain[inner], width)
            total += own / (own.sum() or 1.0)
        yield b"", total.tobytes()

    return work


def boosted_share(members: list[Member], rate: float, caps: Caps, n_bins: int) -> Callable[[Rows], Iterator[tuple]]:
    """All rounds of one label; ``members`` hold the draws of each."""

    def work(rows: Rows) -> Iterator[tuple]:
        features = rows.differing
        x, left = rows.x[features], rows.y.copy()
        for r, member in enumerate(members):
            taken = drawn(rows.rid, member) > 0
            inside = np.flatnonzero(taken).astype(np.int32)
            tree, leaves = _grown(rows, x, None if (rows.w == 1).all() else rows.w, left, inside, features, n_bins, caps, member.seed)
            rest = np.arange(len(taken), dtype=np.int32) if leaves is None else np.flatnonzero(~taken).astype(np.int32)
            for group in (leaves or {}, leaf_rows(tree, rows.x, rest)):
                for leaf, own in group.items():
                    left[own] -= rate * tree.value[leaf]
            yield r, 1.0, pickle.dumps(vars(tree))

    return work


def adaboost_share(seeds: list[int], rate: float, caps: Caps, n_bins: int) -> Callable[[Rows], Iterator[tuple]]:
    """All rounds of AdaBoost.R2 on one lane, with their votes; the lane stops at a perfect tree, or at one no better than a coin."""

    def work(rows: Rows) -> Iterator[tuple]:
        features = rows.differing
        x, y, w = rows.x[features], rows.y[:, 0], rows.w.copy()
        for r, seed in enumerate(seeds):
            inside = np.flatnonzero(w > 0).astype(np.int32)
            tree, leaves = _grown(rows, x, w, rows.y, inside, features, n_bins, caps, seed)
            miss = np.zeros(len(w))
            for leaf, own in (leaf_rows(tree, rows.x, inside) if leaves is None else leaves).items():
                miss[own] = np.abs(y[own] - tree.value[leaf, 0])
            worst, total = miss[inside].max(), w[inside].sum()
            loss = (w[inside] * miss[inside]).sum() / (worst * total) if worst > 0 else 0.0
            if loss <= 0 or loss >= 0.5:
                if loss <= 0 or r == 0:
                    yield r, 1.0, pickle.dumps(vars(tree))
                return
            beta = loss / (1.0 - loss)
            yield r, rate * math.log(1.0 / beta), pickle.dumps(vars(tree))
            w[inside] = w[inside] / total * beta ** ((1.0 - miss[inside] / worst) * rate)

    return work
