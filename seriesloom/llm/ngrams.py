"""N-gram language model in an Elias-Fano trie, built and queried by Spark tasks.

Level 1 holds the words, by their 64-bit hash, with counts. An entry of level k
is an n-gram, stored under its parent, the entry of its first k - 1 words: Elias-Fano pointers
give each parent's range, and inside it the last words are kept
relative to the context, as steps above the end of the range before, so the
whole level is one monotone sequence searched by successor. Entries carry an
8-bit code of their discounted probability, parents the rest of the mass:

    p_k(w | context) = a(context, w) + rest(context) * p_{k-1}(w | shorter context)
    p_1(w) = (count + 1) / (N + V + 1)

Codes round down and the rest is what they leave, so the probabilities of all words, unseen ones as one,
sum to at most 1 (less only by the rounding of the rest). N-grams of
order k are kept from ``keep[k]`` occurrences on, a setting of the model; counts
are taken over all training rows, rarer ones add to the rest.

Levels are cut into shards of near equal mass over (parent, word), so a very
common context is spread over several; each shard is one file in the shared
folder, written by one task and memory-mapped by those that read (read whole
where the folder is no file system path). Only sizes and shard edges cross the driver.

Defined cases: null and empty texts are one end token; null ids count as the
empty text in the split; repeated rows count each; without training rows N and V
are 0; texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import text_of
from seriesloom.llm.eliasfano import EliasFano
from seriesloom.llm.repeats import Hashes
from seriesloom.session import scratch_path

ORDER, KEEP, DISCOUNT = 3, (1, 2, 2), 0.75
END = 1  # hash of the end of a text
STEPS, LEAST = 255, 9.0  # codes spread evenly over so many decades below 1
CHUNK, GROUP = 1 << 20, 1 << 23

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts end to end, an end token after each, and the number of tokens of each."""
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    gap = np.append(True, _SPACE[data])
    edge = np.diff(gap.astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    h = Hashes(data)
    value = (h.sums[end] - h.sums[start]) * Hashes.down[start]
    value = (value ^ (end - start).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    value = np.where(value <= 1, np.uint64(2), value)
    sizes = np.array([len(t) + 1 for t in texts])
    n = np.bincount(np.searchsorted(np.cumsum(sizes), start, "right"), minlength=len(texts))
    return np.insert(value, np.cumsum(n), np.uint64(END)), n + 1


def _batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and token counts of runs of rows of about ``GROUP`` bytes, hashed ``CHUNK`` bytes at a time."""
    held, group = [], 0
    texts, size = [], 0

    def hashed() -> None:
        nonlocal size
        if texts:
            held.append(tokens(texts))
            texts.clear()
            size = 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        nonlocal group
        out = tuple(np.concatenate(x) for x in zip(*held))
        held.clear()
        group = 0
        return out

    for value in batch.column(column):
        text = (value.as_py() or "").encode("utf-8", "surrogatepass")
        texts.append(text)
        size, group = size + len(text) + 1, group + len(text) + 1
        if size >= CHUNK:
            hashed()
        if group >= GROUP:
            hashed()
            yield joined()
    hashed()
    if held:
        yield joined()


def _save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """All arrays in one file, each starting at a multiple of 64 bytes, behind a table of names, kinds and places."""
    from pyarrow import fs

    names, body, at = [], [], 0
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        names.append(f"{name} {a.dtype.str} {len(a)} {at}")
        body.append(a.tobytes() + bytes(-a.nbytes % 64))
        at += len(body[-1])
    head = "\n".join(names).encode()
    store, place = fs.FileSystem.from_uri(path)
    with store.open_output_stream(place) as out:
        out.write(len(head).to_bytes(8, "little") + head + bytes(-(8 + len(head)) % 64) + b"".join(body))


def _load(path: str) -> dict[str, np.ndarray]:
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    if store.type_name == "local":
        data = np.memmap(place, np.uint8, "r")
    else:
        with store.open_input_file(place) as f:
            data = np.frombuffer(f.read(), np.uint8)
    size = int.from_bytes(data[:8].tobytes(), "little")
    begin, out = -(-(8 + size) // 64) * 64, {}
    for line in io.BytesIO(data[8 : 8 + size].tobytes()).read().decode().splitlines():
        name, kind, n, at = line.rsplit(" ", 3)
        width = np.dtype(kind).itemsize
        out[name] = data[begin + int(at) : begin + int(at) + int(n) * width].view(kind)
    return out


class Level:
    """Shards of one level. ``edges``: per shard (number, rows, mass, first parent, first word, last parent)."""

    def __init__(self, folder: str, edges: list[tuple], split: dict[int, float] | None = None):
        self.folder, self.split = folder, split or {}
        self.files = [e[0] for e in edges]
        self.rows = np.array([0, *(e[1] for e in edges)]).cumsum()
        self.mass = np.array([0, *(e[2] for e in edges)]).cumsum()
        self.first = [tuple(e[3:5]) for e in edges]
        self.first_parent = np.array([e[3] for e in edges], np.int64)
        self.last_parent = np.array([e[5] for e in edges], np.int64)
        self.open: dict[int, dict] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": {}}

    def shard(self, i: int) -> dict:
        if i not in self.open:
            arrays = _load(f"{self.folder}/{self.files[i]}")
            for name in {n.split(".")[0] for n in arrays if "." in n}:
                arrays[name] = EliasFano.of(arrays, name)
            self.open[i] = arrays
        return self.open[i]

    def each(self, shard: np.ndarray) -> Iterator[tuple[dict, np.ndarray, int]]:
        """Each shard that is asked, and where; one pass over the rows, whatever the number of shards."""
        order = np.argsort(shard.astype(np.int16) if len(self.files) < 1 << 15 else shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(len(self.files) + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            yield self.shard(int(i)), order[cuts[i] : cuts[i + 1]], int(i)


class Vocabulary(Level):
    def ids(self, h: np.ndarray) -> np.ndarray:
        """Word numbers (-1: unknown): hashes are sorted inside shards of equal hash ranges."""
        words, back = np.unique(h, return_inverse=True)
        out = np.full(len(words), -1, np.int64)
        shard = np.searchsorted(self.first_parent.view(np.uint64), words, "right") - 1 if self.files else np.full(len(words), -1)
        for arrays, at, i in self.each(shard):
            spot = np.minimum(np.searchsorted(arrays["hash"], words[at]), len(arrays["hash"]) - 1)
            out[at] = np.where(arrays["hash"][spot] == words[at], self.rows[i] + spot, -1)
        return out[back]

    def column(self, ids: np.ndarray, name: str) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        for arrays, at, i in self.each(np.where(ids < 0, -1, np.searchsorted(self.rows, ids, "right") - 1)):
            out[at] = arrays[name][ids[at] - self.rows[i]] + (self.mass[i] if name == "mass" else 0)
        return out


class Trie(Level):
    column = Vocabulary.column

    def find(self, parent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entry number (-1: none), discounted probability and the parent's rest, for each pair."""
        out = np.full(len(parent), -1, np.int64), np.zeros(len(parent)), np.ones(len(parent))
        known = np.flatnonzero(parent >= 0)
        if not self.files or not len(known):
            return out
        key, back = _distinct(parent[known], word[known])
        parent, word = parent[known][key], word[known][key]
        index, share, rest = np.full(len(parent), -1, np.int64), np.zeros(len(parent)), np.ones(len(parent))
        shard = np.searchsorted(self.first_parent, parent, "right") - 1
        for arrays, at, i in self.each(np.where((parent < 0) | (shard < 0), -1, shard)):
            inside = at[parent[at] <= self.last_parent[i]]
            rest[inside] = arrays["rest"][parent[inside] - self.first_parent[i]] / 65535.0
        for p, r in self.split.items():  # a few contexts at shard edges
            at = np.flatnonzero(parent == p)
            if len(at):  # a context in several shards: the one where the word lies
                rest[at] = r
                own = np.flatnonzero(self.first_parent == p)
                shard[at] = own[0] - 1 + np.searchsorted([self.first[j][1] for j in own], word[at], "right")
        for arrays, at, i in self.each(np.where((parent < 0) | (word < 0), -1, shard)):
            at = at[parent[at] <= self.last_parent[i]]
            if not len(at):
                continue
            local = parent[at] - self.first_parent[i]
            begin, end = arrays["pointers"].get(local), arrays["pointers"].get(local + 1)
            full = begin < end
            at, begin, end = at[full], begin[full], end[full]
            words = arrays["words"]
            ahead = np.where(begin > 0, words.get(np.maximum(begin - 1, 0)) + 1, 0)
            spot = words.find(ahead + word[at])
            hit = spot < end
            hit[hit] = words.get(spot[hit]) == (ahead + word[at])[hit]
            index[at[hit]] = self.rows[i] + spot[hit]
            share[at[hit]] = decoded(arrays["code"][spot[hit]])
        for column, values in zip(out, (index, share, rest)):
            column[known] = values[back]
        return out


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct pairs, sorted, and each pair's number among them."""
    wide = int(b.max(initial=0)) + 2
    joined = a * wide + b if int(a.max(initial=0)) < 2**62 // wide else None
    order = np.lexsort((b, a)) if joined is None else np.argsort(joined)
    new = np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0))[: len(a)]
    back = np.empty(len(a), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back


def coded(share: np.ndarray) -> np.ndarray:
    """Codes of probabilities, rounded down; 0 stands for none."""
    level = np.ceil(-np.log10(np.maximum(share, 1e-300)) * (STEPS - 1) / LEAST - 1e-9)
    return np.where((share <= 0) | (level > STEPS - 1), 0, STEPS - np.clip(level, 0, STEPS - 1)).astype(np.uint8)


def decoded(code: np.ndarray) -> np.ndarray:
    return np.where(code == 0, 0.0, 10.0 ** (-(STEPS - code.astype(float)) * LEAST / (STEPS - 1)))


class Model:
    def __init__(self, words: Vocabulary, levels: list[Trie]):
        self.words, self.levels = words, levels
        self.total, self.size = int(words.mass[-1]), int(words.rows[-1])

    def walk(self, ids: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
        """Per level from 2 on: each token's parent entry, then its discounted probability and its parent's rest.

        The entry of a token and those in front of it is the parent of the next token one level down; a text's first
        context is an end token alone. The last step has parents only.
        """
        end = int(self.words.ids(np.array([END], np.uint64))[0])
        first = np.zeros(len(ids), bool)
        first[np.cumsum(sizes) - sizes] = True
        parent = np.where(first, end, np.append(end, ids[:-1]))
        for level in self.levels:
            index, share, rest = level.find(parent, ids)
            yield parent, share, rest
            parent = np.where(first, -1, np.append(-1, index[:-1]))
        yield parent, None, None

    def probabilities(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and probabilities of all tokens."""
        count = self.words.column(ids, "count")
        p = (count + 1) / (self.total + self.size + 1)
        for _, share, rest in self.walk(ids, sizes):
            p = p if share is None else share + rest * p
        return count, p


def _counted(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(t, return_counts=True) for t, _ in _batches(batch, "text")]
            if found:
                h, c = (np.concatenate(x) for x in zip(*found))
                h, back = np.unique(h, return_inverse=True)
                c = np.bincount(back, c).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    return df.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


_EDGE = "shard int, rows long, mass long, parent long, word long, last long, left double, right double"


def _vocabulary(df: DataFrame, folder: str, shards: int) -> Vocabulary:
    """Words by ranges of their hash, which spread evenly."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        shard, h, c = (np.concatenate([p.column(n).to_numpy() for p in parts] or [np.zeros(0, np.int64)]) for n in ("shard", "h", "c"))
        rows = []
        for s in np.unique(shard):
            own = np.flatnonzero(shard == s)
            order = own[np.argsort(h[own].view(np.uint64))]
            mass = np.cumsum(c[order])
            _save(f"{folder}/{s}", {"hash": h[order].view(np.uint64), "count": c[order], "mass": mass - c[order]})
            rows.append((int(s), len(order), int(mass[-1]), int(h[order][0]), 0, int(h[order][-1]), 0.0, 0.0))
        yield _edge_rows(rows)

    dealt = _counted(df).withColumn("shard", F.expr(f"cast((shiftrightunsigned(h, 40) * {shards}) div {1 << 24} as int)")).repartition(shards, "shard")
    edges = sorted(map(tuple, dealt.mapInArrow(write, _EDGE).collect()))  # a row per shard
    return Vocabulary(folder, edges)


def _edge_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.float64(), pa.float64()]
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in _EDGE.split(", ")])


def _level(df: DataFrame, model: Model, folder: str, shards: int, keep: int, last: bool) -> Trie:
    lower = model.levels[-1] if model.levels else model.words
    total = max(int(model.words.mass[-1]), 1)
    span = max(int(lower.mass[-1]), 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        codec = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            parents, words = [], []
            for h, sizes in _batches(batch, "text"):
                ids = model.words.ids(h)
                *_, (parent, _, _) = model.walk(ids, sizes)
                parents.append(parent[parent >= 0])
                words.append(ids[parent >= 0])
            p, w = np.concatenate(parents or [np.zeros(0, np.int64)]), np.concatenate(words or [np.zeros(0, np.int64)])
            at, back = _distinct(p, w)
            n = np.bincount(back, minlength=len(at))
            p, w = p[at], w[at]
            # Mass ahead of (parent, word) if words followed each parent as they occur at large: grows with the pair.
            ahead = (lower.column(p, "mass") + lower.column(p, "count") * (model.words.column(w, "mass") / total)) / span
            shard = np.minimum((ahead * shards).astype(np.int64), shards - 1)
            cut = np.append(np.flatnonzero(np.append(True, np.diff(shard) > 0)), len(p)) if len(p) else np.zeros(1, np.int64)
            rows = [(int(shard[a]), codec.compress(_bytes(p[a:b], w[a:b], n[a:b]))) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "packed"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        codec, held = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for s, packed in zip(batch.column("shard").to_pylist(), batch.column("packed")):
                held.setdefault(s, []).append(packed.as_py())
        rows = []
        for s in sorted(held):
            p, w, n = (np.concatenate(x) for x in zip(*(_numbers(codec.decompress(b)) for b in held.pop(s))))
            at, back = _distinct(p, w)
            n = np.bincount(back, n).astype(np.int64)
            p, w = p[at], w[at]
            first, past = int(p[0]), int(p[-1])
            whole = lower.column(p, "count")
            kept = n >= keep
            if not kept.any():
                continue
            p, w, n = p[kept], w[kept], n[kept]
            code = coded(np.maximum(n - DISCOUNT, 0) / np.maximum(whole[kept], 1))
            given = np.bincount(p - first, decoded(code), minlength=past - first + 1)
            begin = np.append(0, np.cumsum(np.bincount(p - first, minlength=past - first + 1)))
            top = np.where(np.diff(begin) > 0, w[np.maximum(begin[1:] - 1, 0)] + 1, 0)
            steps = w + (np.cumsum(top) - top)[p - first]
            arrays = {f"pointers.{k}": v for k, v in EliasFano.build(begin).arrays().items()}
            arrays |= {f"words.{k}": v for k, v in EliasFano.build(steps).arrays().items()}
            arrays |= {"code": code, "rest": (np.clip(1 - given, 0, 1) * 65535).astype(np.uint16)}
            if not last:
                arrays |= {"count": n, "mass": np.cumsum(n) - n}
            _save(f"{folder}/{s}", arrays)
            rows.append((int(s), len(p), int(n.sum()), first, int(w[0]) if p[0] == first else 0, past, float(given[0]), float(given[-1])))
        yield _edge_rows(rows)

    packed = df.mapInArrow(count, "shard int, packed binary")
    edges = sorted(map(tuple, packed.repartition(shards, "shard").mapInArrow(write, _EDGE).collect()))  # a row per shard
    given: dict[int, list[float]] = {}
    for e in edges:
        given.setdefault(e[3], []).append(e[6])
        if e[5] != e[3]:
            given.setdefault(e[5], []).append(e[7])
    return Trie(folder, edges, {p: max(0.0, 1 - sum(g)) for p, g in given.items() if len(g) > 1})


def _bytes(p: np.ndarray, w: np.ndarray, n: np.ndarray) -> bytes:
    """Three columns as differences, byte planes apart, which compress well."""
    cols = [np.diff(p, prepend=0), w, n]
    return b"".join(np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in cols)


def _numbers(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(3, 8, -1)
    p, w, n = (np.ascontiguousarray(c.T).view("<i8").ravel() for c in planes)
    return np.cumsum(p), w, n


def fit(df: DataFrame, text_col: str = "text", order: int = ORDER, keep: tuple[int, ...] = KEEP) -> Model:
    """A model of all rows."""
    spark = df.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts, root = df.select(text_of(text_col).alias("text")), scratch_path(spark, "ngrams")
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    _folder(spark, f"{root}/1")
    model = Model(_vocabulary(texts, f"{root}/1", shards), [])
    for k in range(2, order + 1):
        _folder(spark, f"{root}/{k}")
        model.levels.append(_level(texts, model, f"{root}/{k}", shards, keep[k - 1], k == order))
    return model


def _folder(spark, path: str) -> None:
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place, recursive=True)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, base_score and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for h, sizes in _batches(batch, "text"):
                count, p = model.probabilities(model.words.ids(h), sizes)
                base = np.log10((count + 1) / (model.total + model.size + 1))
                begin = np.cumsum(sizes) - sizes
                for col, v in zip(out, (sizes, np.add.reduceat((count > 0).astype(np.int64), begin), np.add.reduceat(base, begin), np.add.reduceat(np.log10(p), begin))):
                    col.append(v)
            kinds = (np.int64, np.int64, float, float)
            cols = [pa.array(np.concatenate(c or [np.zeros(0)]).astype(k)) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["id", "n_tokens", "n_known", "base_score", "score"])

    slim = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return slim.mapInArrow(run, "id long, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)

