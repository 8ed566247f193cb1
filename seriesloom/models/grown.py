"""Regression trees with leaf, split and leaf-size caps, many grown together.

All trees of an ensemble, or all bags of a round, grow in the same jobs. A job
sends every row's statistics to the open nodes of every tree: of a node with
more than ``IN_MEMORY`` rows, tasks sum histograms over (feature, bin), and one
reducer a node picks the split, which comes back to the driver. Once no such
node is open, the rows of the smaller ones go to one task each, which grows the
whole branch (Panda et al., PLANET, 2009). Branches stay in the tasks: another
one a tree joins them and cuts the tree, so the driver gets trees of at most the
leaf cap, or none at all (``grow_stored``).

Trees grow best first: the leaf whose split takes most off the squared error is
split next, until the cap. Large nodes are opened as if no branch had a better
split, so none that the result splits is missed; the final tree is cut in that
order. Without a leaf cap the order is of no account, and a branch grows level
by level, nodes of equal size at once. Several targets share a tree: gains are
summed over them and leaves hold a vector.

A feature with at most ``BINS`` values is split between any two of them, others
between approximate quantiles. Rows are drawn by a hash of their key, so a
recomputed task draws the same.
"""

from __future__ import annotations

import heapq
import json
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.session import stage

BINS, IN_MEMORY, MEMBERS_AT_ONCE = 255, 200_000, 250
FEW_ROWS, SENT_AT_ONCE = 200, 8 << 20  # ways to the same result: a node's rows sorted, bytes a batch
PARTS = "member int, node int, feature int, part long, payload binary"


@dataclass(frozen=True)
class Caps:
    leaves: int | None = None
    depth: int | None = None
    split: int = 2  # rows a node needs
    leaf: int = 1  # rows each side keeps
    share: float = 1.0  # of the features, drawn for every node


@dataclass(frozen=True)
class Member:
    """One tree to grow: its lane (target and weight columns of the table) and how it draws rows."""

    targets: tuple[int, ...]
    weight: int
    seed: int
    draw: tuple[str, float] | None = None  # ("poisson", rate) or ("part", share)


@dataclass
class Tree:
    """Nodes in order of creation, root first; a leaf has feature -1 and points at itself."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # nodes x targets
    gain: np.ndarray
    rows: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int((self.feature < 0).sum())

    def leaf_of(self, x: np.ndarray, bounds: list[np.ndarray] | None = None) -> np.ndarray:
        """The leaf of each row of bins, or of raw features where ``bounds`` are given."""
        limit = self.bin if bounds is None else np.array([bounds[f][b] if f >= 0 else 0.0 for f, b in zip(self.feature, self.bin)])
        n, width = x.shape
        flat, split = np.ascontiguousarray(x).ravel(), np.maximum(self.feature, 0).astype(np.intp)
        child = np.column_stack((self.right, self.left)).astype(np.intp).ravel()
        inner, at, begin = self.feature >= 0, np.zeros(n, np.intp), np.arange(0, n * width, width) if width else np.zeros(n, np.intp)
        out, open_ = at, None  # the rows that are still on their way
        while True:
            going = inner.take(at)
            left = int(np.count_nonzero(going))
            if left < 0.7 * len(at) or not left:
                if open_ is None:
                    out, open_ = at.copy(), np.arange(n)
                out[open_] = at
                if not left:
                    return out
                at, begin, open_ = at[going], begin[going], open_[going]
            below = flat.take(begin + split.take(at)) <= limit.take(at)
            at = child.take(2 * at + below)

    def predict(self, x: np.ndarray, bounds: list[np.ndarray] | None = None) -> np.ndarray:
        return self.value[self.leaf_of(x, bounds)]


# Bins


def fit_bins(df: DataFrame, features: list[Column]) -> list[np.ndarray]:
    """Split points of each feature: midpoints of neighbouring values, or of quantiles where values are many.

    Tasks list the values of each feature until these are many, so only the features
    that have many are read again, for their quantiles.
    """
    plain = df.select(F.array(*(c.cast("double") for c in features)).alias("f"))
    few, width = int(BINS * 0.8), len(features)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0)] * width
        for b in batches:
            f = _matrix(b.column(0))
            for i in range(width if b.num_rows else 0):
                if len(seen[i]) <= few:
                    seen[i] = np.unique(np.concatenate((seen[i], f[~np.isnan(f[:, i]), i])))
        rows = [(i, v) for i, own in enumerate(seen) for v in (own.tolist() if len(own) <= few else [None])]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.float64()))], names=["feature", "value"])

    values = plain.mapInArrow(listed, "feature int, value double").groupBy("feature").agg(F.collect_set("value").alias("held"), F.bool_or(F.col("value").isNull()).alias("many"))
    held: list = [[] for _ in range(width)]
    for r in values.select("feature", F.when(~F.col("many") & (F.size("held") <= few), F.col("held")).alias("held")).collect():
        held[r.feature] = r.held
    many = [i for i, own in enumerate(held) if own is None]
    if many:
        steps = ", ".join(f"{i / BINS!r}D" for i in range(BINS + 1))
        cut = plain.agg(*(F.expr(f"percentile_approx(f[{i}], array({steps}), 20000)") for i in many)).first()
        for i, own in zip(many, cut):
            held[i] = own
    bounds = []
    for own in held:
        points = np.unique(np.array([v for v in own if v is not None], float))
        if len(points) > BINS:
            points = points[np.unique(np.linspace(0, len(points) - 1, BINS).astype(int))]
        bounds.append((points[1:] + points[:-1]) / 2)
    return bounds


def binned(df: DataFrame, features: list[Column], bounds: list[np.ndarray], keys: list[str], targets: list[Column], weights: list[Column]) -> DataFrame:
    """rid, x (a byte a feature), y and w (arrays), staged. Without keys, no rows can be drawn."""
    plain = df.select(
        (F.xxhash64(*keys) if keys else F.lit(0).cast("long")).alias("rid"), F.array(*(c.cast("double") for c in features)).alias("f"),
        F.array(*(c.cast("double") for c in targets)).alias("y"), F.array(*(c.cast("double") for c in weights)).alias("w"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = _matrix(b.column(1))
            x = codes(f, bounds) if len(f) else np.zeros((0, len(bounds)), np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), b.column(2), b.column(3)], names=["rid", "x", "y", "w"])

    return stage(plain.mapInArrow(cut, "rid long, x binary, y array<double>, w array<double>"), "binned")


def codes(raw: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """Bins of raw features: a value lies in bin b or below if it is at most the b-th bound."""
    out = np.empty(raw.shape, np.uint8)
    for i, p in enumerate(bounds):
        out[:, i] = np.searchsorted(p, raw[:, i], "left")
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows; nulls as nan."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


# Draws


def _uniform(rid: np.ndarray, seed: int) -> np.ndarray:
    """Evenly spread numbers in [0, 1) from row hashes and a seed (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        return _spread(rid.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))


def _spread(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / 2.0**53


def drawn(rid: np.ndarray, member: Member) -> np.ndarray:
    """How often the member takes each row."""
    if member.draw is None:
        return np.ones(len(rid))
    kind, rate = member.draw
    u = _uniform(rid, member.seed)
    if kind == "part":
        return (u < rate).astype(float)
    steps, p = [np.exp(-rate)], np.exp(-rate)
    while p > 1e-18 or len(steps) < rate:
        p *= rate / len(steps)
        steps.append(steps[-1] + p)
    return np.searchsorted(np.array(steps), u, "right").astype(float)


def _looked_at(seed: int, place: int, n: int, share: float) -> np.ndarray | None:
    """Features a node may split by: a draw that depends on the tree and the node's place only."""
    if share >= 1:
        return None
    u = _uniform(np.arange(n), hash((seed, place)) % 2**31)
    mask = np.zeros(n, bool)
    mask[np.argsort(u)[: max(1, int(share * n))]] = True
    return mask


# Splits


def histogram(x: np.ndarray, stats: np.ndarray, n_bins: int) -> np.ndarray:
    """Sums of each statistic over (feature, bin): stats x features x bins."""
    n, width = x.shape
    at = (x + np.arange(width) * n_bins).ravel()
    rows = np.bincount(at, minlength=width * n_bins).astype(float)  # the first statistic is 1 a row
    sums = [rows if i < 2 and (s == 1).all() else np.bincount(at, np.repeat(s, width), width * n_bins) for i, s in enumerate(stats.T)]
    return np.stack(sums).reshape(-1, width, n_bins)


def best_split(hist: np.ndarray, caps: Caps, mask: np.ndarray | None = None, first: int = 0) -> tuple | None:
    """(gain, feature, bin, left sums, right sums) of the best allowed split; ties go to the first feature and bin.

    The statistics are rows, weight and weighted targets.
    """
    left = hist.cumsum(axis=2)
    total = left[:, :1, -1:]
    left, right = left[:, :, :-1], total - left[:, :, :-1]
    if not left.size or total[0, 0, 0] < caps.split:
        return None
    # Sums of halves may be off by rounding; rows are whole numbers and exact.
    ok = (left[0] >= max(1, caps.leaf)) & (right[0] >= max(1, caps.leaf)) & (left[1] > 0) & (right[1] > 0)
    if mask is not None:
        ok &= mask[first : first + len(ok), None]
    gain = np.where(ok, _gain(left, right, total), -np.inf)
    f, b = divmod(int(gain.argmax()), gain.shape[1])
    if not gain[f, b] > _grain(total[:, 0, 0]):
        return None
    return float(gain[f, b]), first + f, b, left[:, f, b], right[:, f, b]


def _gain(left: np.ndarray, right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What a split takes off the squared error, summed over targets; statistics come first."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return (left[2:] ** 2 / left[1] + right[2:] ** 2 / right[1] - total[2:] ** 2 / total[1]).sum(axis=0)


def _grain(total: np.ndarray) -> float:
    """Gains up to this are rounding."""
    return max(1e-12 * float((total[2:] ** 2 / total[1]).sum()), 1e-15)


def best_split_of_rows(x: np.ndarray, stats: np.ndarray, caps: Caps, mask: np.ndarray | None = None) -> tuple | None:
    """The same from a few rows, sorted by every feature."""
    n, total = len(x), stats.sum(axis=0)
    order = x.argsort(axis=0, kind="stable")
    values = np.take_along_axis(x, order, axis=0)
    left = stats[order].cumsum(axis=0)[:-1].transpose(2, 1, 0)  # stats x features x places
    right = total[:, None, None] - left
    ok = (values[1:] != values[:-1]).T & (left[0] >= max(1, caps.leaf)) & (right[0] >= max(1, caps.leaf)) & (left[1] > 0) & (right[1] > 0)
    if mask is not None:
        ok &= mask[:, None]
    if n < caps.split or not ok.any():
        return None
    gain = np.where(ok, _gain(left, right, total[:, None, None]), -np.inf)
    f, i = divmod(int(gain.argmax()), gain.shape[1])
    if not gain[f, i] > _grain(total):
        return None
    return float(gain[f, i]), f, int(values[i, f]), left[:, f, i], right[:, f, i]


@dataclass
class _Node:
    sums: np.ndarray
    depth: int
    place: int  # path from the root, for the draws of features
    split: tuple | None = None
    children: tuple[int, int] | None = None
    known: bool = False


def _split_nodes(nodes: list[_Node], at: int, found: tuple | None) -> None:
    """Notes a node's best split and makes its children."""
    node = nodes[at]
    node.known = True
    if found is not None:
        node.split, node.children = found[:3], (len(nodes), len(nodes) + 1)
        nodes += [_Node(found[3], node.depth + 1, 2 * node.place + 1), _Node(found[4], node.depth + 1, 2 * node.place + 2)]


def _may_split(node: _Node, caps: Caps) -> bool:
    return node.sums[0] >= max(2, caps.split, 2 * caps.leaf) and (caps.depth is None or node.depth < caps.depth)


def _chosen(nodes: list[_Node], caps: Caps) -> tuple[list[int], list[int]]:
    """Nodes split best first up to the cap, and open leaves that must be looked at before more is known."""
    heap, split, open_ = [], [], []

    def offer(at: int) -> None:
        node = nodes[at]
        if node.known and node.split:
            heapq.heappush(heap, (-node.split[0], at))
        elif not node.known and (at == 0 or _may_split(node, caps)):  # the root gives at least the mean
            open_.append(at)

    offer(0)
    while heap and (caps.leaves is None or len(split) + 1 < caps.leaves):
        at = heapq.heappop(heap)[1]
        split.append(at)
        for c in nodes[at].children:
            offer(c)
    return split, open_


def grow_branch(x: np.ndarray, stats: np.ndarray, root: _Node, n_bins: int, caps: Caps, seed: int) -> list[_Node]:
    """All nodes below ``root`` that best-first growth could need, root first."""
    nodes, rows, heap, splits = [root], {0: np.arange(len(x))}, [], 0

    def look(at: int) -> None:
        found = None
        if _may_split(nodes[at], caps):
            mask = _looked_at(seed, nodes[at].place, x.shape[1], caps.share)
            inside = rows[at]
            if len(inside) <= FEW_ROWS:
                found = best_split_of_rows(x[inside], stats[inside], caps, mask)
            else:
                found = best_split(histogram(x[inside], stats[inside], n_bins), caps, mask)
        _split_nodes(nodes, at, found)
        if found is not None:
            heapq.heappush(heap, (-found[0], at))

    look(0)
    while heap and (caps.leaves is None or splits + 1 < caps.leaves):
        at = heapq.heappop(heap)[1]
        splits += 1
        (_, f, b), (low, high), inside = nodes[at].split, nodes[at].children, rows.pop(at)
        goes = x[inside, f] <= b
        rows[low], rows[high] = inside[goes], inside[~goes]
        look(low)
        look(high)
    return nodes


def _looked_at_many(seed: int, places: np.ndarray, n: int, share: float) -> np.ndarray:
    """``_looked_at`` of many nodes: the features' numbers in ascending order, a row a node."""
    if max(places) >= 2**60:  # beyond it, hashes of numbers are not the numbers
        return np.stack([np.flatnonzero(_looked_at(seed, int(p), n, share)) for p in places])
    with np.errstate(over="ignore"):
        seeds = np.full(len(places), 2870177450012600261, np.uint64)  # Python's hash of a pair (xxHash)
        for lane in (np.uint64(seed), places.astype(np.uint64)):
            seeds += lane * np.uint64(14029467366897019727)
            seeds = (seeds << np.uint64(31)) | (seeds >> np.uint64(33))
            seeds *= np.uint64(11400714785074694791)
        seeds += np.uint64(2 ^ 2870177450012600261 ^ 3527539)
        start = (seeds % np.uint64(2**31)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    u = _spread(np.arange(n).astype(np.uint64) + start[:, None])
    return np.sort(np.argsort(u, axis=1)[:, : max(1, int(share * n))], axis=1)


LENGTHS = np.array([2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 64, 80, 100, 128, 160, 200])  # small nodes are laid out in rows of these


def _best_of_few_rows(x: np.ndarray, stats: np.ndarray, rows: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int, caps: Caps, looked: np.ndarray | None) -> tuple:
    """``best_split_of_rows`` of many nodes of at most ``length`` rows, which lie one after the other in ``rows``.

    Gains (-inf: no split), features, bins, left and right sums.
    """
    width, place, node = x.shape[1], np.arange(length), np.arange(len(begin))
    real = place < size[:, None]
    inside = rows.take(np.where(real, begin[:, None] + place, 0))
    own = stats[inside]
    own[~real] = 0.0
    total = own.sum(axis=1)
    features = np.arange(width)[None] if looked is None else looked
    key = x.ravel().take(inside[:, None, :] * width + features[:, :, None]).astype(np.uint16)
    key = np.where(real[:, None, :], key << np.uint16(8), np.uint16(255 << 8)) + place.astype(np.uint16)
    key.sort(axis=2)  # by bin, rows in their order, what fills up last
    values, order = key >> 8, (key & 255) + (node * length)[:, None, None]
    left = np.empty((stats.shape[1], *key.shape[:2], length - 1))
    left[0] = place[1:]
    for i in range(1, len(left)):
        left[i] = np.ascontiguousarray(own[:, :, i]).ravel().take(order).cumsum(axis=2)[:, :, :-1]
    whole = total.T[:, :, None, None]
    right = whole - left
    ok = (values[:, :, 1:] != values[:, :, :-1]) & (left[0] >= max(1, caps.leaf)) & (right[0] >= max(1, caps.leaf)) & (left[1] > 0) & (right[1] > 0)
    gain = np.where(ok, _gain(left, right, whole), -np.inf).reshape(len(begin), -1)
    at = gain.argmax(axis=1)
    f, i = np.divmod(at, length - 1)
    best = gain[node, at]
    grain = np.maximum(1e-12 * (total[:, 2:] ** 2 / total[:, 1:2]).sum(axis=1), 1e-15)
    feature = f if looked is None else looked[node, f]
    return np.where(best > grain, best, -np.inf), feature, values[node, f, i].astype(np.int64), left[:, node, f, i].T, right[:, node, f, i].T


def grow_whole(x: np.ndarray, stats: np.ndarray, depth: int, place: int, n_bins: int, caps: Caps, seed: int) -> dict[str, np.ndarray]:
    """The branch that ``grow_branch`` grows without a leaf cap, as arrays, level by level."""
    width, k = x.shape[1], stats.shape[1]
    sums, split = [stats.sum(axis=0)[None]], []  # by level: sums; gain, feature, bin, first child
    rows, begin, places, made = np.arange(len(x)), np.array([0, len(x)]), np.array([place], np.uint64 if depth < 60 else object), 1
    while True:
        n = len(places)
        size = np.diff(begin)
        gain, feature, cut, low = np.full(n, -np.inf), np.full(n, -1), np.zeros(n, np.int64), np.full(n, -1)
        lefts, rights = np.zeros((n, k)), np.zeros((n, k))
        if caps.depth is None or depth < caps.depth:
            may = np.flatnonzero(sums[-1][:, 0] >= max(2, caps.split, 2 * caps.leaf))
            for node in may[size[may] > FEW_ROWS]:
                inside = rows[begin[node] : begin[node + 1]]
                found = _best_of_looked_at(x, stats, inside, n_bins, caps, _looked_at(seed, int(places[node]), width, caps.share))
                if found is not None:
                    gain[node], feature[node], cut[node], lefts[node], rights[node] = found
            few = may[size[may] <= FEW_ROWS]
            looked = None if caps.share >= 1 or not len(few) else _looked_at_many(seed, places[few], width, caps.share)
            lengths = LENGTHS if len(rows) > 5000 else LENGTHS[[0, 2, 5, 8, 11, 14, 17, 19]]  # fewer kinds where calls outweigh what fills up
            which = np.searchsorted(lengths, size[few])
            for kind in np.unique(which):
                length = int(lengths[kind])
                alike = np.flatnonzero(which == kind)
                step = max(1, 250_000 // (length * (width if looked is None else looked.shape[1]) * k))
                for lo in range(0, len(alike), step):
                    part = alike[lo : lo + step]
                    some = few[part]
                    found = _best_of_few_rows(x, stats, rows, begin[some], size[some], length, caps, None if looked is None else looked[part])
                    gain[some], feature[some], cut[some], lefts[some], rights[some] = found
        inner = np.flatnonzero(gain > -np.inf)
        feature[gain == -np.inf] = -1
        low[inner] = made + 2 * np.arange(len(inner))
        split.append((gain, feature, cut, low))
        if not len(inner):
            break
        owner = np.repeat(np.arange(n), size)
        kept = gain[owner] > -np.inf
        owner, rows = owner[kept], rows[kept]
        child = low[owner] - made + (x.ravel().take(rows * width + feature[owner]) > cut[owner])
        begin = np.append(0, np.bincount(child, minlength=2 * len(inner)).cumsum())
        rows = rows[np.argsort(child.astype(np.uint16) if len(inner) < 2**15 else child, kind="stable")]
        places = np.stack((2 * places[inner] + 1, 2 * places[inner] + 2), axis=1).ravel() if depth < 59 else np.array([2 * int(places[i]) + side for i in inner for side in (1, 2)], object)
        sums.append(np.stack((lefts[inner], rights[inner]), axis=1).reshape(-1, k))
        made += 2 * len(inner)
        depth += 1
    gain, feature, cut, low = (np.concatenate(c) for c in zip(*split))
    return {"sums": np.concatenate(sums), "gain": gain, "feature": feature, "bin": cut, "low": low, "high": np.where(low >= 0, low + 1, -1)}


def _best_of_looked_at(x: np.ndarray, stats: np.ndarray, inside: np.ndarray, n_bins: int, caps: Caps, mask: np.ndarray | None) -> tuple | None:
    """``best_split`` by the histograms of the features looked at; the first feature's tells the whole."""
    if mask is None:
        return best_split(histogram(x[inside], stats[inside], n_bins), caps)
    columns = np.flatnonzero(mask)
    if not mask[0]:
        columns = np.append(0, columns)
    found = best_split(histogram(x[inside[:, None], columns], stats[inside], n_bins), caps, mask[columns])
    return found and (found[0], int(columns[found[1]]), *found[2:])


def _arrays(nodes: list[_Node]) -> dict[str, np.ndarray]:
    """Nodes as arrays; without a split the feature and the children are -1."""
    splits = [n.split or (-np.inf, -1, 0) for n in nodes]
    children = [n.children or (-1, -1) for n in nodes]
    out = {"sums": np.array([n.sums for n in nodes])}
    out |= {name: np.array(column) for name, column in zip(("gain", "feature", "bin"), zip(*splits))}
    return out | {name: np.array(column) for name, column in zip(("low", "high"), zip(*children))}


def _joined(top: dict[str, np.ndarray], branches: list[tuple[int, dict[str, np.ndarray]]]) -> dict[str, np.ndarray]:
    """The upper part of a tree with its branches in the place of their roots."""
    parts, made = [{k: v.copy() for k, v in top.items()}], len(top["gain"])
    for at, branch in branches:
        shift = made - 1
        own = branch | {c: np.where(branch[c] >= 0, branch[c] + shift, -1) for c in ("low", "high")}
        for name, column in own.items():
            parts[0][name][at] = column[0]
        parts.append({name: column[1:] for name, column in own.items()})
        made += len(own["gain"]) - 1
    return {name: np.concatenate([p[name] for p in parts]) for name in top}


def _cut(nodes: dict[str, np.ndarray], caps: Caps) -> Tree:
    """The tree of the best splits up to the cap, nodes numbered in the order in which they came."""
    heap, order, splits = [], [0], []
    gain, low, high = nodes["gain"].tolist(), nodes["low"].tolist(), nodes["high"].tolist()
    if low[0] >= 0:
        heap.append((-gain[0], 0))
    while heap and (caps.leaves is None or len(splits) + 1 < caps.leaves):
        at = heapq.heappop(heap)[1]
        splits.append(at)
        for c in (low[at], high[at]):
            order.append(c)
            if low[c] >= 0:
                heapq.heappush(heap, (-gain[c], c))
    kept, number = np.array(order), np.full(len(gain), -1)
    number[kept] = np.arange(len(kept))
    cut = np.zeros(len(gain), bool)
    cut[splits] = True
    return _compact({name: column[kept] for name, column in nodes.items()}, cut[kept], number)


def _compact(nodes: dict[str, np.ndarray], cut: np.ndarray, number: np.ndarray | None = None) -> Tree:
    own = np.arange(len(cut))
    child = lambda c: np.where(cut, nodes[c] if number is None else number[nodes[c]], own).astype(np.int32)
    weight = nodes["sums"][:, 1:2]
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(weight > 0, nodes["sums"][:, 2:] / weight, 0.0)
    return Tree(
        np.where(cut, nodes["feature"], -1).astype(np.int16), np.where(cut, nodes["bin"], 0).astype(np.int16), child("low"), child("high"),
        value, np.where(cut, nodes["gain"], 0.0), nodes["sums"][:, 0].astype(np.int64),
    )


# Jobs


def _tree(nodes: list[_Node], split: list[int]) -> Tree:
    """The tree of the chosen splits, nodes numbered in the order in which they came."""
    chosen, order = set(split), [0]
    for at in split:
        order += nodes[at].children
    number = {at: i for i, at in enumerate(order)}
    kept = [(at, nodes[at], at in chosen) for at in order]
    pair = lambda at, n, cut, side: number[n.children[side]] if cut else number[at]
    return Tree(
        np.array([n.split[1] if cut else -1 for _, n, cut in kept]), np.array([n.split[2] if cut else 0 for _, n, cut in kept]),
        np.array([pair(*k, 0) for k in kept]), np.array([pair(*k, 1) for k in kept]),
        np.array([n.sums[2:] / n.sums[1] if n.sums[1] > 0 else n.sums[2:] * 0 for _, n, _ in kept]),
        np.array([n.split[0] if cut else 0.0 for _, n, cut in kept]), np.array([n.sums[0] for _, n, _ in kept]),
    )


def _statistics(rid: np.ndarray, y: np.ndarray, w: np.ndarray, member: Member) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and per such row: one, weight, weighted targets."""
    weight = w[:, member.weight] * drawn(rid, member)
    own = y[:, list(member.targets)]
    part = np.flatnonzero((weight > 0) & ~np.isnan(own).any(axis=1))
    weight, own = weight[part], own[part]
    return part, np.column_stack((np.ones(len(part)), weight, own * weight[:, None]))


def _sender(sent, n_bins: int):
    """Histograms of large open nodes (a row a feature) and rows of small ones, per task."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, opened, _, trees, offset, rate = pickle.loads(sent.value)
        part, sums, size = TaskContext.get().partitionId() << 20, {}, 0

        def rows_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["member", "node", "feature", "part", "payload"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rid, x = batch.column(0).to_numpy(), _bytes(batch.column(1))
            y, w = _matrix(batch.column(2)).copy(), _matrix(batch.column(3))
            for target, tree in offset:
                y[:, target] -= rate * tree.predict(x)[:, 0]
            out = []
            for m, member in members:
                inside, stats = _statistics(rid, y, w, member)
                tree = trees[m]
                at = np.zeros(len(inside), np.int64) if tree is None else tree.leaf_of(x[inside])
                for leaf, (node, large) in opened[m].items():
                    here = np.flatnonzero(at == leaf)
                    if large and len(here):
                        found = histogram(x[inside[here]], stats[here], n_bins)
                        if (m, node) not in sums:
                            size += found.nbytes
                        sums[m, node] = sums[m, node] + found if (m, node) in sums else found
                    elif len(here):
                        out.append((m, node, -1, part, _pack(x[inside[here]], stats[here])))
                if sum(len(o[4]) for o in out) > SENT_AT_ONCE:
                    yield rows_of(out)
                    out = []
                if size > 8 * SENT_AT_ONCE:
                    yield from (rows_of(x) for x in _by_feature(sums, part))
                    part, sums, size = part + 1, {}, 0
            if out:
                yield rows_of(out)
        yield from (rows_of(x) for x in _by_feature(sums, part))

    return send


def _by_feature(sums: dict, part: int) -> Iterator[list[tuple]]:
    for (m, node), hist in sums.items():
        yield [(m, node, f, part, hist[:, f].tobytes()) for f in range(hist.shape[1])]


def _pack(x: np.ndarray, stats: np.ndarray) -> bytes:
    return np.array([*x.shape, stats.shape[1]], "<i8").tobytes() + x.tobytes() + stats.tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, k = np.frombuffer(data, "<i8", 3)
    return np.frombuffer(data, np.uint8, n * width, 24).reshape(n, width), np.frombuffer(data, float, n * k, 24 + n * width).reshape(n, k)


def _receiver(sent, n_bins: int, width: int, caps: Caps):
    """Best splits of large nodes and whole branches of small ones, from rows ordered by (member, node, feature, part).

    Of a small root: the whole tree.
    """

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, _, places, *_ = pickle.loads(sent.value)
        seeds = {m: member.seed for m, member in members}
        state: dict = {"key": None}

        def found(nodes: list[_Node]) -> str:
            flat = [(n.sums.tolist(), n.depth, n.place, n.split, n.children, n.known) for n in nodes]
            return json.dumps(flat, default=lambda v: v.item())

        def feature_done() -> None:
            if state.get("hist") is not None:
                m, node = state["key"]
                root = state["root"]
                mask = _looked_at(seeds[m], root.place, width, caps.share)
                s = best_split(state["hist"][:, None, :], caps, mask, state["feature"])
                if s is not None and (state["best"] is None or s[0] > state["best"][0]):
                    state["best"] = s
                state["hist"] = None

        def node_done() -> list[tuple]:
            if state["key"] is None:
                return []
            feature_done()
            m, node = state["key"]
            root = state["root"]
            if state["blocks"]:
                x, stats = (np.concatenate(v) for v in zip(*state["blocks"]))
                state["blocks"] = []
                if caps.leaves is None:
                    branch = grow_whole(x, stats, root.depth, root.place, n_bins, caps, seeds[m])
                else:
                    root.sums = stats.sum(axis=0)
                    branch = _arrays(grow_branch(x, stats, root, n_bins, caps, seeds[m]))
                return [(m, node, None, pickle.dumps(vars(_cut(branch, caps)) if node == 0 else branch))]
            nodes = [root]
            root.sums = state["sums"]
            _split_nodes(nodes, 0, state["best"] if _may_split(root, caps) else None)
            return [(m, node, found(nodes), None)]

        def rows_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.binary()))], names=["member", "node", "found", "tree"])

        for batch in batches:
            out = []
            for m, node, feature, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if (m, node) != state["key"]:
                    out += node_done()
                    depth, place = places[m][node]
                    state = {"key": (m, node), "root": _Node(np.zeros(0), depth, place), "blocks": [], "best": None, "hist": None, "feature": -1, "sums": None}
                if feature < 0:
                    state["blocks"].append(_unpack(payload))
                    continue
                if feature != state["feature"]:
                    feature_done()
                    state["feature"] = feature
                hist = np.frombuffer(payload, float).reshape(-1, n_bins)
                state["hist"] = hist if state["hist"] is None else state["hist"] + hist
                if feature == 0:
                    add = hist.sum(axis=1)
                    state["sums"] = add if state["sums"] is None else state["sums"] + add
            if out:
                yield rows_of(out)
        last = node_done()
        if last:
            yield rows_of(last)

    return receive


def _assembler(sent, caps: Caps):
    """Trees from their branches, ordered by (member, node)."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, member, held = pickle.loads(sent.value), None, []

        def done() -> list[bytes]:
            return [] if member is None else [pickle.dumps(vars(_cut(_joined(tops[member], held), caps)))]

        def rows_of(member: int, trees: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([member] * len(trees), pa.int32()), pa.array(trees, pa.binary())], names=["member", "tree"])

        for batch in batches:
            for m, node, branch in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                if m != member:
                    yield rows_of(member, done())
                    member, held = m, []
                held.append((node, pickle.loads(branch)))
        yield rows_of(member, done())

    return assemble


def grow(table: DataFrame, members: list[Member], caps: Caps, width: int, n_bins: int, n_rows: int, offset: list[tuple[int, Tree]] | None = None, rate: float = 0.0) -> list[Tree]:
    """One tree for each member, over a ``binned`` table of at most ``n_rows`` rows.

    ``offset`` names trees whose predictions, times ``rate``, are taken off a target first.
    """
    trees: list[Tree] = []
    for start in range(0, len(members), MEMBERS_AT_ONCE):
        trees += _Growth(table, members[start : start + MEMBERS_AT_ONCE], caps, width, n_bins, n_rows, offset or [], rate).trees()
    return trees


@dataclass
class Top:
    """The upper part of a stored tree: each leaf's branch, by its number in the branch table."""

    tree: Tree
    branch: dict[int, int]


def grow_stored(table: DataFrame, members: list[Member], caps: Caps, width: int, n_bins: int, n_rows: int) -> tuple[list[Top], DataFrame]:
    """Trees without a leaf cap, which grow with the rows: their upper parts, and a staged table (member, node, tree) of what hangs below."""
    if caps.leaves is not None:
        raise ValueError("a leaf cap needs whole trees")
    tops, branches = [], []
    for start in range(0, len(members), MEMBERS_AT_ONCE):
        own, below = _Growth(table, members[start : start + MEMBERS_AT_ONCE], caps, width, n_bins, n_rows, [], 0.0).stored(start)
        tops += own
        branches.append(below)
    return tops, reduce(DataFrame.unionByName, branches)


class _Growth:
    """The jobs that grow some trees. ``nodes`` holds each tree's large nodes and what hangs directly below them."""

    def __init__(self, table, members, caps, width, n_bins, n_rows, offset, rate):
        self.table, self.members, self.caps, self.width, self.n_bins = table, members, caps, width, n_bins
        self.offset, self.rate = offset, rate
        self.spark = table.sparkSession
        self.nodes = [[_Node(np.array([float(n_rows), 1.0, *(0.0 for _ in m.targets)]), 0, 0)] for m in members]
        while opened := self._open(True):
            seen = set()
            moved, sent = self._job(opened, True)
            for r in moved.select("member", "node", "found").collect():
                seen.add((r.member, r.node))
                _take(self.nodes[r.member], r.node, json.loads(r.found))
            self._empty(opened, seen)
            sent.destroy()

    def _open(self, large: bool) -> dict[int, list[int]]:
        opened = {m: [at for at in _chosen(nodes, self.caps)[1] if (nodes[at].sums[0] > IN_MEMORY) == large] for m, nodes in enumerate(self.nodes)}
        return {m: own for m, own in opened.items() if own}

    def _empty(self, opened: dict[int, list[int]], seen: set[tuple[int, int]]) -> None:
        """Notes nodes for which no row came."""
        for m, own in opened.items():
            for at in own:
                if (m, at) not in seen:
                    self.nodes[m][at].known = True
                    self.nodes[m][at].sums = self.nodes[m][at].sums * 0

    def _parts(self, groups: int) -> int:
        return max(1, min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 2 * groups))

    def _shape(self, m: int) -> tuple[Tree, dict[int, int]]:
        """The tree as far as it is known, and the numbers its nodes have there."""
        nodes = self.nodes[m]
        split = _chosen(nodes, self.caps)[0]
        return _tree(nodes, split), {at: i for i, at in enumerate([0, *(c for s in split for c in nodes[s].children)])}

    def _job(self, opened: dict[int, list[int]], large: bool):
        asked, leaves, places, shapes = [], {}, {}, {}
        for m, own in opened.items():
            shape, number = self._shape(m)
            asked.append((m, self.members[m]))
            shapes[m] = shape if len(number) > 1 else None
            leaves[m] = {number[at]: (at, large) for at in own}
            places[m] = {at: (self.nodes[m][at].depth, self.nodes[m][at].place) for at in own}
        sent = self.spark.sparkContext.broadcast(cloudpickle.dumps((asked, leaves, places, shapes, self.offset, self.rate)))
        parts = self._parts(sum(map(len, opened.values())))
        moved = self.table.mapInArrow(_sender(sent, self.n_bins), PARTS).repartition(parts, "member", "node").sortWithinPartitions("member", "node", "feature", "part")
        return moved.mapInArrow(_receiver(sent, self.n_bins, self.width, self.caps), "member int, node int, found string, tree binary"), sent

    def trees(self) -> list[Tree]:
        """Whole trees, which come back to the driver."""
        opened, whole = self._open(False), {}
        if opened:
            moved, sent = self._job(opened, False)
            found, tops = moved.select("member", "node", "tree"), None
            if any(len(self.nodes[m]) > 1 for m in opened):
                tops = self.spark.sparkContext.broadcast(pickle.dumps({m: _arrays(self.nodes[m]) for m in opened}))
                found = found.repartition(self._parts(len(opened)), "member").sortWithinPartitions("member", "node")
                found = found.mapInArrow(_assembler(tops, self.caps), "member int, tree binary")
            whole = {r.member: Tree(**pickle.loads(r.tree)) for r in found.select("member", "tree").collect()}
            self._empty({m: own for m, own in opened.items() if m not in whole}, set())
            sent.destroy()
            if tops is not None:
                tops.destroy()
        return [whole[m] if m in whole else _tree(nodes, _chosen(nodes, self.caps)[0]) for m, nodes in enumerate(self.nodes)]

    def stored(self, first: int) -> tuple[list[Top], DataFrame]:
        """Upper parts, and a staged table of what hangs below; members are numbered from ``first`` on."""
        opened, kept = self._open(False), "member int, node int, tree binary"
        below = None
        if opened:
            moved, sent = self._job(opened, False)
            below = stage(moved.select((F.col("member") + first).cast("int").alias("member"), "node", "tree").mapInArrow(_as_trees, kept), "branches")
            sent.destroy()
        tops, rest = [], []
        for m, nodes in enumerate(self.nodes):
            shape, number = self._shape(m)
            tops.append(Top(shape, {i: at for at, i in number.items() if shape.feature[i] < 0}))
            for i, at in tops[-1].branch.items():
                if at not in opened.get(m, ()):
                    alone = _compact({k: v[[at]] for k, v in _arrays(nodes).items()}, np.zeros(1, bool))
                    rest.append((first + m, at, pickle.dumps(vars(alone))))
        alone = self.spark.createDataFrame(rest, kept)
        return tops, alone if below is None else below.unionByName(alone)


def _as_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Branches as trees; whole trees are such already."""
    for batch in batches:
        for i in range(batch.num_rows):
            own = pickle.loads(batch.column(2)[i].as_py())
            if "low" in own:
                own = vars(_compact(own, own["low"] >= 0))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([pickle.dumps(own)], pa.binary())], names=["member", "node", "tree"])


def _take(nodes: list[_Node], at: int, found: list) -> None:
    """Hangs what a task found below a node in its place."""
    shift = len(nodes) - 1
    for i, (sums, depth, place, split, children, known) in enumerate(found):
        node = _Node(np.array(sums), depth, place, split and tuple(split), children and tuple(c + shift for c in children), known)
        if i == 0:
            nodes[at] = node
        else:
            nodes.append(node)
