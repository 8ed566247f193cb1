"""Near-duplicate join on word shingles: MinHash bands, then exact Jaccard.

Documents with the same set of shingles form a class; classes are joined. A
class's signature (one permutation, empty bins filled from others) is cut into
trees of ``DEPTH`` values each, of which a prefix is matched: the longest whose
recall, ``RECALL`` by formula, is reached at the asked similarity. The length is the same for
all classes, so this is banding, not an LSH forest: the join asks for one
similarity, at which a forest shortened level by level would stop at that length,
too. Where no prefix of these trees reaches it, each value is a tree of its own;
lower similarities are refused. Equal prefixes give candidate groups (connected, so a class's shingles travel once). Inside a group
all pairs are verified exactly, block of classes against block of classes, each
pair of blocks a unit of its own; a unit returns one count per class and a
spanning forest of its links, so no task or result grows with the pairs, and no
link is lost between classes that any tree brought together.

Defined cases: null and empty texts have no shingles, form one class and link to
nothing else; texts shorter than a shingle are one shingle; repeated rows are
copies in one class; null ids are kept and count as smallest only where a class
has no other; a very long text is shingled whole; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import text_of
from seriesloom.llm.components import components
from seriesloom.session import stage

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.998
TREES, DEPTH = 16, 8
BINS = TREES * DEPTH
BLOCK = 256


def prefix_depth(similarity: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Longest prefix that brings pairs of that similarity together in some tree with that probability; 0 if none does."""
    for d in range(depth, 0, -1):
        if 1 - (1 - similarity**d) ** trees >= recall:
            return d
    return 0


def shape(similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """Number of trees and length of the matched prefix."""
    for trees in (TREES, BINS):
        if d := prefix_depth(similarity, recall, trees, BINS // trees):
            return trees, d
    raise ValueError(f"{BINS} values don't reach a recall of {recall} at similarity {similarity}")


class Words(dict):
    """64-bit hashes of words; forgets all when it holds ``limit``."""

    limit = 300_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


def shingles(text: str, hashes: Words, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of so many words; words are what white space parts, in lower case."""
    h = np.array([hashes[w] for w in text.lower().split()], np.uint64)
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(words, len(h))):
            out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return np.unique(out)


_FILL = np.array([np.random.default_rng(1000 + a).permutation(BINS) for a in range(4 * BINS)])


def signature(s: np.ndarray) -> np.ndarray:
    """One value per bin: the smallest hash that falls into it; empty bins take another bin's, by a fixed order of trials."""
    width = np.uint64(64 - (BINS - 1).bit_length())
    bins, first = np.unique((s >> width).astype(np.int64), return_index=True)
    out, full = np.zeros(BINS, np.uint32), np.zeros(BINS, bool)
    out[bins], full[bins] = s[first].astype(np.uint32), True
    open_, have = np.flatnonzero(~full), full.copy()
    for trial in _FILL:
        if not len(open_):
            break
        source = trial[open_]
        ok = have[source]
        out[open_[ok]] = out[source[ok]]
        open_ = open_[~ok]
    if len(open_):
        out[open_] = out[bins[0]]
    return out


def signed(df: DataFrame, id_col: str, text_col: str, words: int, similarity: float = SIMILARITY) -> DataFrame:
    """id, digest of the shingle set, prefixes (a 64-bit key per tree; null for the empty set)."""
    trees, depth = shape(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        mix = np.random.default_rng(5).integers(1, 2**63, (trees, depth), dtype=np.uint64) | np.uint64(1)
        for batch in batches:
            digests, keys = [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), hashes, words)
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if len(s):
                    head = signature(s).reshape(trees, -1)[:, :depth].astype(np.uint64) + np.uint64(1)
                    with np.errstate(over="ignore"):
                        k = np.zeros(trees, np.uint64)
                        for d in range(depth):
                            k = (k ^ head[:, d] * mix[:, d]) * np.uint64(0x9E3779B97F4A7C15)
                            k ^= k >> np.uint64(31)
                    keys.append(k.view(np.int64))
                else:
                    keys.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "digest", "prefixes"])

    texts = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(run, "id long, digest binary, prefixes array<long>")


def _sets(df: DataFrame, chosen: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """digest and shingles (bytes) of the chosen classes (rep, digest), from a text of each."""
    least = F.lit(-(2**63))
    texts = df.select(F.coalesce(F.col(id_col).cast("long"), least).alias("__id"), text_of(text_col).alias("text"))
    asked = chosen.select(F.coalesce("rep", least).alias("__rep"), "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found: dict[bytes, bytes] = {}
                for digest, text in zip(part.column("digest").to_pylist(), part.column("text")):
                    s = shingles(text.as_py(), hashes, words).tobytes()
                    if hashlib.blake2b(s, digest_size=16).digest() == digest:  # rows may share an id
                        found[digest] = s
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["digest", "shingles"])

    # The same plan at every size: a small list of classes must not turn into a broadcast.
    return texts.join(asked.hint("merge"), F.col("__id") == F.col("__rep")).select("digest", "text").mapInArrow(run, "digest binary, shingles binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sorted sets."""
    if len(left) * len(right) <= 32:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left]).reshape(len(left), len(right))
    sizes = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    flat = [np.concatenate(side) for side in (left, right)]
    shared = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)), np.float32)
    spots = []
    for values, owner in zip(flat, sizes):
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        hit = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        order = np.argsort(at[hit], kind="stable")
        spots.append((at[hit][order], owner[hit][order]))
    for lo in range(0, len(shared), 8192):
        sides = []
        for (at, owner), side in zip(spots, (left, right)):
            i, j = np.searchsorted(at, (lo, lo + 8192))
            m = np.zeros((len(side), min(8192, len(shared) - lo)), np.float32)
            m[owner[i:j], at[i:j] - lo] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def links(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs reach the similarity, in whole numbers: 1000 common >= 1000 s * union."""
    common = overlaps(left, right)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - common
    return 1000 * common >= round(1000 * similarity) * union


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the given edges."""
    root, out = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            out.append((a, b))
    return out


def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows of one unit come together, by side; out come (a, null, count) per class and (a, b, 0) per forest edge."""

    def unit(members: list[dict]) -> pa.RecordBatch:
        sides = [sorted({m["digest"]: m["shingles"] for m in members if m["side"] == side}.items()) for side in (0, 1)]
        sets = [[np.frombuffer(s, np.uint64) for _, s in side] for side in sides]
        own = members[0]["i"] == members[0]["j"]
        linked = links(sets[0], sets[0] if own else sets[1], similarity)
        names = [d for d, _ in sides[0]] + [d for d, _ in sides[1]]
        if own:
            np.fill_diagonal(linked, False)
            counts = linked.sum(axis=1)
            pairs = np.argwhere(np.triu(linked))
        else:
            counts = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
            pairs = np.argwhere(linked) + [0, len(sides[0])]
        edges = _forest(pairs, len(names))
        a = [d for d, c in zip(names, counts) if c] + [names[i] for i, _ in edges]
        b = [None for c in counts if c] + [names[j] for _, j in edges]
        n = [int(c) for c in counts if c] + [0] * len(edges)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(held[0][k] != row[k] for k in ("label", "i", "j")):
                yield unit(held)
                held = []
            held.append(row)
    if held:
        yield unit(held)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Per row: id, class_id (smallest id that is linked, over any number of links), copy_of (smallest id with the
    same shingles) and n_links (other classes at that similarity)."""
    rows = stage(signed(df, id_col, text_col, words, similarity), "signed")
    classes = rows.groupBy("digest").agg(F.min("id").alias("rep"), F.first("prefixes").alias("prefixes"))
    keyed = stage(classes.select("digest", "rep", F.posexplode_outer("prefixes").alias("tree", "prefix")), "prefixes")
    bucket = ["tree", "prefix"]
    met = keyed.where("prefix IS NOT NULL").groupBy(*bucket).agg(F.min("digest").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    grouped = components(keyed.join(met, bucket).select(F.col("digest").alias("a"), "b").where("a <> b"))
    grouped = stage(grouped.join(keyed.where("tree = 0").select(F.col("digest").alias("id"), "rep"), "id").withColumnRenamed("id", "digest"), "groups")
    count = grouped.groupBy("label").agg(F.count("*").alias("m"))
    sets = _sets(df, grouped.select("rep", "digest"), id_col, text_col, words)
    blocks = F.expr(f"cast(ceil(m / {BLOCK}) as int)")
    placed = grouped.join(count, "label").withColumn("nb", blocks).withColumn("own", F.pmod(F.xxhash64("digest"), F.col("nb")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    unit = other.join(sets, "digest").select(
        "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "digest", "shingles",
    )
    dealt = unit.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "side", "digest")
    found = stage(dealt.mapInArrow(lambda it: _verify(it, similarity), "a binary, b binary, n long"), "links")
    total = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n_links"))
    class_of = components(found.where("b IS NOT NULL").select("a", "b"))
    reps = keyed.where("tree = 0 OR tree IS NULL").select("digest", "rep")
    named = reps.join(total.withColumnRenamed("a", "digest"), "digest", "left").join(class_of.withColumnRenamed("id", "digest"), "digest", "left")
    named = named.withColumn("label", F.coalesce("label", "digest"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("class_id"))
    final = named.join(smallest, "label").select("digest", "class_id", F.col("rep").alias("copy_of"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    return rows.select("id", "digest").join(final, "digest").select(F.col("id").alias(id_col), "class_id", "copy_of", "n_links")
