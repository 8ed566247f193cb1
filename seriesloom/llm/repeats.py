"""Removal of byte strings that start more than once, by range-partitioned suffix sorting.

A string of ``length`` bytes at a start is repeated if it also starts anywhere
else. All starts of a corpus are too many to move, so two things go before the
sort, neither of which loses a repeat:

* every start belongs to an anchor, the smallest hashed ``GRAM`` bytes inside
  its string (the leftmost of equal ones). Equal strings have equal anchors at
  equal places, so starts whose anchor's bytes occur once are unique;
* texts that are equal as a whole are kept once, with the number of copies.

The suffixes that are left travel by anchor: the anchor's hash is their leading
token, and splitters sampled from all of them deal them to tasks by ranges of
(leading token, text, start), so that one very common token is spread over many.
Neighbouring anchors with the same bytes, as in texts of a short period, travel
as one, ``PER_ROW`` starts at most a row. A task takes about ``PER_BUCKET`` starts of its
range at a time, which bounds its memory; such a bucket expands its suffixes to starts, sorts them by multikey
quicksort over two tokens (hashes of the halves of the string) and compares
neighbours. Suffixes of a bucket's first and last leading token may go on in the
bucket before or after it: of those, each different string is passed on once, and equal ones
meet in a second comparison across boundaries.

Strings are compared by 128 bits of their tokens. Defined cases: null texts are
empty; texts shorter than ``length`` keep all bytes and repeat nothing; equal
rows are copies of each other, so long enough ones lose all bytes; null ids are
kept; matches never cross texts; a text is one row in a task, and worked on ``CHUNK``
bytes at a time, also if all its bytes are equal; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import text_of
from seriesloom.session import stage

LENGTH, GRAM = 400, 48
#: Starts a bucket and a task hold, about; starts a row holds at most; bytes hashed and sent at once.
PER_BUCKET, PER_TASK, PER_ROW, CHUNK = 200_000, 2_000_000, 50_000, 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


class Hashes:
    """Hashes of all substrings of some bytes from one running sum; powers of the base are kept between calls."""

    up = down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Hashes.up) < n:
            size = max(n, 2 * len(Hashes.up))
            Hashes.up = np.cumprod(np.append(np.uint64(1), np.full(size, BASE)))
            Hashes.down = np.cumprod(np.append(np.uint64(1), np.full(size, INVERSE)))
        self.sums = np.append(np.uint64(0), np.cumsum(BYTES[data] * Hashes.up[: n - 1], dtype=np.uint64))

    def of(self, start: np.ndarray, size: int) -> np.ndarray:
        h = (self.sums[start + size] - self.sums[start]) * Hashes.down[start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(29)


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: hash, place, first start that belongs to it and the number of such starts."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    gram = min(GRAM, length)
    h = Hashes(data).of(np.arange(len(data) - gram + 1), gram)
    width = length - gram + 1
    rows = -(-len(h) // width)
    key = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    key[: len(h)] = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    table = key.reshape(rows, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(after[:n], before[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, np.diff(place) != 0))
    at = place[first]
    return h[at], at, first, np.diff(np.append(first, n))


def groups(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring anchors with one hash: hash, first place, first start, starts, anchors.

    Every start of a text of equal bytes, or of a short period, has an anchor of its
    own; they have the same bytes and are one run. A piece of the text is taken at a time.
    """
    parts = []
    for lo in range(0, max(len(data) - length + 1, 0), CHUNK):
        token, at, first, count = anchors(data[lo : lo + CHUNK + length - 1], length)
        parts.append((token, at + lo, first + lo, count))
    if not parts:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4))
    token, at, first, count = (np.concatenate(c) for c in zip(*parts))
    head = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    fresh = np.append(True, at[1:] != at[:-1]).astype(np.int64)  # an anchor may go on in the next piece
    return token[head], at[head], first[head], np.add.reduceat(count, head), np.add.reduceat(fresh, head)


def multikey_order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by several tokens, and for each place in it whether it equals the one before in all.

    Sorts by the first token; only runs that are still tied are sorted by the next.
    """
    order = np.argsort(keys[0], kind="stable")
    tied = np.append(False, keys[0][order][1:] == keys[0][order][:-1])[: len(order)]
    for key in keys[1:]:
        spots = np.flatnonzero(tied | np.append(tied[1:], False))
        if not len(spots):
            break
        group = np.cumsum(~tied)[spots]
        order[spots] = order[spots][np.lexsort((key[order[spots]], group))]
        sorted_ = key[order]
        tied &= np.append(False, sorted_[1:] == sorted_[:-1])[: len(order)]
    return order, tied


_TEXT = "id long, t1 long, t2 long, n_bytes long, sha string, tokens array<long>, places array<long>, starts array<long>, anchors array<long>"


def _described(df: DataFrame, length: int) -> DataFrame:
    """Per row: identity of the text (128 bits of its SHA-256), size, and anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for text in batch.column(1):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                sha = hashlib.sha256(data).digest()
                token, place, _, count, many = groups(np.frombuffer(data, np.uint8), length)
                t1, t2 = np.frombuffer(sha[:16], np.int64).tolist()
                for col, v in zip(out, (t1, t2, len(data), sha.hex(), token.view(np.int64), place, count, many)):
                    col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 4)
            names = ["id", "t1", "t2", "n_bytes", "sha", "tokens", "places", "starts", "anchors"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=names)

    return df.mapInArrow(run, _TEXT)


def _packed(df: DataFrame) -> DataFrame:
    """Texts compressed, for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        codec = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [codec.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "packed"])

    return df.mapInArrow(run, "id long, packed binary")


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    import zstandard

    codec = zstandard.ZstdDecompressor()
    return (codec.decompress(b.as_py()) for b in column)


_SUFFIX = "token long, t1 long, t2 long, start long, count long, bytes binary"


def _suffixes(texts: DataFrame, length: int) -> DataFrame:
    """Anchors that may repeat, with the starts that belong to them (``PER_ROW`` at most) and their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "t1", "t2", "start", "count", "bytes"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        size, out = 0, [[] for _ in names]
        for batch in batches:
            rest = zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), batch.column("places"))
            for data, (t1, t2, places) in zip(_unpacked(batch.column("packed")), rest):
                token, place, first, count, _ = groups(np.frombuffer(data, np.uint8), length)
                for i in np.flatnonzero(np.isin(place, places.values.to_numpy())).tolist():
                    end = int(first[i] + count[i])
                    for s in range(int(first[i]), end, PER_ROW):
                        n = min(PER_ROW, end - s)
                        for col, v in zip(out, (int(token[i].view(np.int64)), t1, t2, s, n, data[s : s + n + length - 1])):
                            col.append(v)
                        size += n + length
                        if size > 8 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                            size, out = 0, [[] for _ in names]
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return texts.mapInArrow(run, _SUFFIX)


_FOUND = "kind int, a long, b long, t1 long, t2 long, start long, count long"


def _sorted_bucket(t1: np.ndarray, t2: np.ndarray, first: np.ndarray, n: np.ndarray, token: np.ndarray, texts: list[pa.Scalar], length: int, before: bool, after: bool) -> pa.RecordBatch:
    """Kind 0: repeated runs of starts. Kind 1: strings of the bucket's first and last token, if these may occur in
    the bucket before or after it, once each (count > 1: repeated here)."""
    half, tokens, lo = length // 2, ([], []), 0
    while lo < len(n):
        hi, size = lo, 0
        while hi < len(n) and (hi == lo or size + n[hi] + length - 1 <= CHUNK):
            size += int(n[hi]) + length - 1
            hi += 1
        hashes = Hashes(np.frombuffer(b"".join(t.as_buffer() for t in texts[lo:hi]), np.uint8))
        sizes = n[lo:hi] + length - 1
        own, begin = n[lo:hi], np.cumsum(sizes) - sizes
        start = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own - begin, own)
        tokens[0].append(hashes.of(start, half))
        tokens[1].append(hashes.of(start + half, length - half))
        lo = hi
    a, b = (np.concatenate(t) for t in tokens)
    owner = np.repeat(np.arange(len(n)), n)
    order, tied = multikey_order([a, b])
    repeated = np.zeros(len(a), bool)
    repeated[order[tied | np.append(tied[1:], False)]] = True
    start = np.arange(len(a)) - np.repeat(np.cumsum(n) - n - first, n)
    edge = np.flatnonzero(np.append(True, (repeated[1:] != repeated[:-1]) | (owner[1:] != owner[:-1])))
    run = edge[repeated[edge]]
    run_size = np.diff(np.append(edge, len(a)))[repeated[edge]]
    outer = (before & (token == token[0])) | (after & (token == token[-1]))
    heads = order[~tied]
    heads = heads[outer[owner[heads]]]
    zero = np.zeros(len(run), np.int64)
    cols = [np.append(np.zeros(len(run), np.int32), np.ones(len(heads), np.int32))]
    cols += [np.append(zero, a[heads].view(np.int64)), np.append(zero, b[heads].view(np.int64))]
    cols += [np.append(c[owner[run]], c[owner[heads]]) for c in (t1, t2)]
    cols += [np.append(start[run], start[heads]), np.append(run_size, 1 + repeated[heads])]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "a", "b", "t1", "t2", "start", "count"])


def _sort_buckets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of token, text and start; a bucket ends where it holds enough starts."""
    held, size, last, ended = [], 0, None, None

    def bucket(following: int | None) -> pa.RecordBatch:
        """The held rows; what lies beyond a task's rows is unknown, so its first and last token may go on there."""
        columns = [np.concatenate([part[i] for part in held]) for i in range(5)]
        before, after = (t is None or t == own for t, own in ((ended, columns[4][0]), (following, columns[4][-1])))
        return _sorted_bucket(*columns, [t for part in held for t in part[5]], length, before, after)

    for batch in batches:
        t1, t2, start, count, token = (batch.column(c).to_numpy() for c in ("t1", "t2", "start", "count", "token"))
        key = np.column_stack((token, t1, t2, start))
        # Rows may share an id, so a text may have come twice.
        own = np.append(last is None or (key[:1] != last).any(), (key[1:] != key[:-1]).any(axis=1)) if len(key) else np.zeros(0, bool)
        last, rows, at = key[-1:] if len(key) else last, np.flatnonzero(own), 0
        while at < len(rows):
            room = np.cumsum(count[rows[at:]])
            take = rows[at : at + max(1, int(np.searchsorted(room, PER_BUCKET - size, "right")))]
            held.append((t1[take], t2[take], start[take], count[take], token[take], [batch.column("bytes")[int(i)] for i in take]))
            size, at = size + int(count[take].sum()), at + len(take)
            if size >= PER_BUCKET or at < len(rows):
                yield bucket(token[rows[at]] if at < len(rows) else None)
                held, size, ended = [], 0, token[take[-1]]
    if held:
        yield bucket(None)


def _spans(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal removed ranges from runs of repeated starts."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((r["start"], r["start"] + r["count"] - 1 + length) for r in runs):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _cut(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["t1", "t2", "spans", "kept"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found, kept = [], []
            for data, runs in zip(_unpacked(batch.column("packed")), batch.column("runs").to_pylist()):
                spans, parts, at = _spans(runs, length), [], 0
                for s, e in spans:
                    parts.append(data[at:s])
                    at = e
                found.append([{"start": s, "end": e} for s, e in spans])
                kept.append(b"".join([*parts, data[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("t1"), batch.column("t2"), pa.array(found, span), pa.array(kept, pa.binary())], names=names)

    return texts.mapInArrow(run, "t1 long, t2 long, spans array<struct<start:long,end:long>>, kept binary")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: id, n_bytes, spans (removed ranges of bytes), sha (of the whole text) and kept (bytes; null: all are)."""
    spark = df.sparkSession
    key, least = ["t1", "t2"], F.lit(-(2**63))
    texts = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = stage(_described(texts, length), "described")
    copies = rows.groupBy(*key).agg(F.count("*").alias("copies"), F.min(F.coalesce("id", least)).alias("rep"))
    once = stage(
        rows.where(F.size("tokens") > 0).groupBy(*key).agg(F.first(F.arrays_zip("tokens", "places", "starts", "anchors")).alias("runs"))
        .select(*key, F.explode("runs").alias("x")).select(*key, "x.*").toDF(*key, "token", "place", "starts", "n"), "anchors",
    )
    repeated = once.groupBy("token").agg(F.sum("n").alias("n")).where("n > 1").select("token")
    kept = stage(once.join(repeated.hint("merge"), "token"), "repeated")
    total = kept.agg(F.coalesce(F.sum("starts"), F.lit(0))).first()[0]
    per_text = kept.groupBy(*key).agg(F.collect_list("place").alias("places")).join(copies, key)
    packed = _packed(texts).withColumn("id", F.coalesce("id", least))
    # The same plan at every size: a small list of texts must not turn into a broadcast.
    joined = packed.join(per_text.hint("merge"), packed["id"] == per_text["rep"]).select(*key, "copies", "places", "packed")
    candidates = stage(_matching(joined), "candidates")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PER_TASK + 1)
    order = ["token", *key, "start"]
    # Ranges by splitters that Spark samples from the written suffixes.
    dealt = stage(_suffixes(candidates, length), "suffixes").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = stage(dealt.mapInArrow(lambda it: _sort_buckets(it, length), _FOUND), "found")
    inner = found.where("kind = 0").select(*key, "start", "count")
    across = (
        found.where("kind = 1").groupBy("a", "b").agg(F.collect_list(F.struct("t1", "t2", "start", "count")).alias("same"))  # one from a bucket at most
        .where(F.size("same") > 1).select(F.explode("same").alias("x")).select("x.t1", "x.t2", "x.start", F.lit(1).cast("long").alias("count"))
    )
    runs = inner.unionAll(across).groupBy(*key).agg(F.collect_list(F.struct("start", "count")).alias("runs"))
    cut = _cut(candidates.where("copies = 1").join(runs.hint("merge"), key), length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return (
        rows.select("id", *key, "n_bytes", "sha").join(copies.select(*key, "copies"), key).join(cut, key, "left")
        .select(
            F.col("id").alias(id_col), "n_bytes", "sha",
            F.when(copied, whole).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))).alias("spans"),
            F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        )
    )


def _matching(joined: DataFrame) -> DataFrame:
    """Rows whose text is the one asked for (several rows may share an id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist())
            same = [np.frombuffer(hashlib.sha256(d).digest()[:16], np.int64).tolist() == list(t) for d, t in zip(_unpacked(batch.column("packed")), ids)]
            yield batch.filter(pa.array(same, pa.bool_()))

    return joined.mapInArrow(run, joined.schema)
