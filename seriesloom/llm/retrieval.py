"""Ranked lexical search: whole-number BM25 of all documents for every item, term- and document-at-a-time mixed.

The index is a table. Every task cuts its documents into shards of about
``SHARD_BYTES`` and writes, per shard, one row of document ids and lengths and
one posting list a term (document number by ascending id, occurrences). Texts
are read once, whole, and are not shuffled; the index serves any items.

A search takes the lists of the items' terms, brings each shard's together and
ranks every item in it:

- lists of at most a ``SHORT``-th of the shard's documents are summed term at a
  time into accumulators; their k-th best is a first cutoff, because no further
  term lowers a score;
- the accumulators are then one iterator among the long lists, bounded by its
  own maxima, and documents are visited in ascending order, ``WINDOW`` of them
  a step. A window whose lists' maxima together stay below the cutoff is
  skipped, as are lists that cannot lift a document over it: they are looked up
  for the remaining candidates only. Each window may raise the cutoff.

A shard gives its k best of each item, exact and with ties to the smaller id,
so the k best of those are the k best of all. Items are taken ``ITEM_BYTES`` of
terms at a time, which bounds what is broadcast; each such slice reads only the
lists of its terms.

Defined cases: null and empty texts hold no term and are neither counted nor
found; null ids come before others among ties; repeated documents are documents
of their own; items without a term that some document holds have no rows;
repeated items are ranked once a row; a text larger than a shard makes one of
its own; an empty table on either side gives no rows. Further columns of the
inputs are not read, and none of their names clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import running_totals, text_of
from seriesloom.session import stage

SHARD_BYTES, ITEM_BYTES, PIECE = 32 << 20, 32 << 20, 1 << 20
WINDOW, SHORT = 512, 64
#: Bytes outside terms become blanks, A to Z lower case; all bytes above 127 belong to terms.
TERM_BYTES = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()
INDEX = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary())])
INDEX_DDL = "shard long, term binary, n_docs long, n_terms long, docs binary, counts binary"
FOUND = pa.schema([("qid", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Shard:
    """Documents gathered in a task until they are written as one shard."""

    def __init__(self) -> None:
        self.words, self.ids, self.lengths, self.codes, self.size = Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        n = 0
        for piece in terms_of(text):
            self.codes.append(np.fromiter(map(self.words.__getitem__, piece), np.int32, len(piece)))
            n += len(piece)
        if n:
            self.ids.append(doc_id)
            self.lengths.append(n)
            self.size += len(text)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array(self.lengths, np.int64)
        ids = np.array([i or 0 for i in self.ids], np.int64)
        known = np.array([i is not None for i in self.ids], bool)
        order = np.lexsort((ids, known))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        head = [np.concatenate((ids[order], known[order].astype(np.int64))).tobytes(), lengths[order].tobytes()]
        yield pa.RecordBatch.from_pydict(
            {"shard": [number], "term": [None], "n_docs": [len(ids)], "n_terms": [int(lengths.sum())], "docs": head[:1], "counts": head[1:]}, INDEX
        )
        key = np.concatenate(self.codes).astype(np.int64) * len(ids) + np.repeat(place, lengths)
        key, tf = np.unique(key, return_counts=True)
        code, doc = np.divmod(key, len(ids))
        doc, tf = doc.astype("<u4"), tf.astype("<u4")
        cuts = np.searchsorted(code, np.arange(len(self.words) + 1))
        words = list(self.words)
        for at in range(0, len(words), 20000):
            some = range(at, min(at + 20000, len(words)))
            sizes = np.diff(cuts[at : some.stop + 1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), number)), pa.array([words[i] for i in some], pa.binary()), pa.array(sizes.astype(np.int64)),
                    pa.nulls(len(some), pa.int64()), pa.array([doc[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
                    pa.array([tf[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
                ],
                schema=INDEX,
            )


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, shard = TaskContext.get().partitionId() << 32, Shard()
    for batch in batches:
        ids, texts = batch.columns
        for i in range(batch.num_rows):
            shard.add(ids[i].as_py(), texts[i].as_py())
            if shard.size >= SHARD_BYTES:
                yield from shard.rows(number)
                number, shard = number + 1, Shard()
    if shard.ids:
        yield from shard.rows(number)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Posting lists of all terms, shard by shard; the row with a null term holds a shard's ids and lengths."""
    return stage(docs.select(F.col(id_col).cast("long"), text_of(text_col)).mapInArrow(_index_rows, INDEX_DDL), "postings")


class Lists:
    """Documents in ascending order with their part of the score, and its maximum in each window."""

    def __init__(self, docs: np.ndarray, parts: np.ndarray, windows: int) -> None:
        self.docs, self.parts = docs, parts
        self.cuts = np.searchsorted(docs, np.arange(windows + 1) * WINDOW)
        self.tops = np.zeros(windows, np.int64)
        filled = np.flatnonzero(np.diff(self.cuts))
        if len(filled):
            self.tops[filled] = np.maximum.reduceat(parts, self.cuts[filled])


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Documents of all lists, ascending, each with the sum of its parts."""
    docs, parts = (np.concatenate(x) for x in zip(*lists))
    order = np.argsort(docs, kind="stable")
    docs, parts = docs[order], parts[order]
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    return docs[first], np.add.reduceat(parts, first)


def best(lists: list[tuple[int, Lists]], k: int, cutoff: int, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents (score descending, number ascending) of weighted lists; none scored below ``cutoff``."""
    tops = np.array([w * x.tops for w, x in lists])
    total = tops.sum(axis=0)
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    sums = np.zeros(WINDOW, np.int64)
    for win in np.flatnonzero(total >= cutoff):
        if total[win] < cutoff:  # it rose on the way here
            continue
        order = np.argsort(tops[:, win], kind="stable")
        reach = np.cumsum(tops[order, win])
        first = int(np.searchsorted(reach, cutoff))  # lists before it cannot make a result by themselves
        base = win * WINDOW
        for at in order[first:]:
            w, x = lists[at]
            inside = slice(x.cuts[win], x.cuts[win + 1])
            sums[x.docs[inside] - base] += w * x.parts[inside]
        found = np.flatnonzero(sums)
        for j in range(first - 1, -1, -1):
            found = found[sums[found] + reach[j] >= cutoff]
            w, x = lists[order[j]]
            inside = x.docs[x.cuts[win] : x.cuts[win + 1]] - base
            if not len(found):
                break
            if len(inside):
                at = np.minimum(np.searchsorted(inside, found), len(inside) - 1)
                hit = inside[at] == found
                sums[found[hit]] += w * x.parts[x.cuts[win] + at[hit]]
        found = found[sums[found] >= cutoff]
        docs, scores = np.concatenate((docs, found + base)), np.concatenate((scores, sums[found]))
        sums[:] = 0
        if len(docs) >= k:
            keep = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[keep], scores[keep]
            cutoff = max(cutoff, int(scores[-1]))
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def rank_item(terms: list[tuple[int, Lists]], n_docs: int, k: int, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Short lists summed first, then one pass over the documents of the sums and the long lists."""
    limit = max(k, n_docs // SHORT)
    short = [(x.docs, w * x.parts) for w, x in terms if len(x.docs) <= limit]
    merged, cutoff = [x for x in terms if len(x[1].docs) > limit], 1
    if short:
        docs, sums = accumulate(short)
        if len(sums) >= k:
            cutoff = max(cutoff, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        merged.append((1, Lists(docs, sums, windows)))
    return best(merged, k, cutoff, windows) if merged else (np.empty(0, np.int64), np.empty(0, np.int64))


def _parts(docs: bytes, counts: bytes, norm: np.ndarray, windows: int) -> Lists:
    doc, tf = np.frombuffer(docs, "<u4").astype(np.int64), np.frombuffer(counts, "<u4").astype(np.int64)
    return Lists(doc, 1000000000 * tf // (1000 * tf + 20 * norm[doc]), windows)


def _searcher(sent, n_all: int, l_all: int, k: int):
    """Ranks the broadcast items in each shard of a partition ordered by (shard, term)."""

    def ranked(head: dict, lists: dict[bytes, Lists], windows: int) -> pa.RecordBatch:
        words, weights, starts, members, qids = sent.value
        ids = np.frombuffer(head["docs"], np.int64)
        ids, known = ids[: len(ids) // 2], ids[len(ids) // 2 :].astype(bool)
        held = [lists.get(w) for w in words]
        q, d, s = [], [], []
        for i, qid in enumerate(qids):
            terms = [(int(weights[t]), held[t]) for t in members[starts[i] : starts[i + 1]] if held[t] is not None and weights[t] > 0]
            docs, scores = rank_item(terms, len(ids), k, windows)
            q.append(np.full(len(docs), qid))
            d.append(docs)
            s.append(scores)
        docs = np.concatenate(d) if d else np.empty(0, np.int64)
        both = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (q, s)]
        return pa.RecordBatch.from_arrays([pa.array(both[0], pa.int64()), pa.array(ids[docs], pa.int64(), mask=~known[docs]), pa.array(both[1], pa.int64())], schema=FOUND)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, lists, norm, windows = None, {}, None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                shard, term, docs, counts = (batch.column(c)[i].as_py() for c in ("shard", "term", "docs", "counts"))
                if term is None:
                    if head:
                        yield ranked(head, lists, windows)
                    head, lists, n = {"shard": shard, "docs": docs}, {}, np.frombuffer(counts, np.int64)
                    norm = 50 + 50 * n * n_all // l_all
                    windows = -(-len(n) // WINDOW)
                else:
                    lists[term] = _parts(docs, counts, norm, windows)
        if head:
            yield ranked(head, lists, windows)

    return search


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [sorted({t for piece in terms_of(x.as_py()) for t in piece}) for x in batch.column(1)]
        sizes = [sum(len(t) + 8 for t in x) for x in held]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.list_(pa.binary())), pa.array(sizes, pa.int64())], names=["item_id", "terms", "size"])


def search(index: DataFrame, items: DataFrame, k: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's k best documents."""
    spark = index.sparkSession
    read = items.select(F.col(id_col).alias("item_id"), text_of(text_col)).mapInArrow(_distinct_terms, f"item_id {items.schema[id_col].dataType.simpleString()}, terms array<binary>, size long")
    numbered = running_totals(stage(read.where("size > 0"), "items"), ["item_id", "terms"], "size", "items")
    asked = stage(numbered.select(F.col("__row").alias("qid"), "item_id", "terms", F.expr(f"__before div {ITEM_BYTES}").alias("slice")), "asked")
    heads = index.where("term IS NULL")
    n_all, l_all, shards = heads.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0)), F.count("*")).first()
    slices = asked.agg(F.max("slice")).first()[0] if n_all else None
    terms = asked.select("slice", F.explode("terms").alias("term")).distinct()
    df = index.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weigh = F.floor(1000 * F.ln((2 * n_all + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = stage(terms.join(df.select("term", weigh.alias("w")), "term"), "weights")
    parts = []
    for number in range(-1 if slices is None else slices, -1, -1):
        held = sorted((bytes(r.term), r.w) for r in weights.where(F.col("slice") == number).collect())
        place = {t: i for i, (t, _) in enumerate(held)}
        rows = [(r.qid, [place[bytes(t)] for t in r.terms if bytes(t) in place]) for r in asked.where(F.col("slice") == number).collect()]
        starts = np.cumsum([0, *(len(t) for _, t in rows)])
        members = np.array([x for _, t in rows for x in t], np.int64)
        sent = spark.sparkContext.broadcast(([t for t, _ in held], np.array([w for _, w in held], np.int64), starts, members, np.array([q for q, _ in rows], np.int64)))
        lists = index.where("term IS NOT NULL").join(weights.where(F.col("slice") == number).select("term"), "term", "left_semi")
        near = heads.select("shard", "term", "docs", "counts").unionAll(lists.select("shard", "term", "docs", "counts"))
        near = near.repartition(max(1, shards), "shard").sortWithinPartitions("shard", F.asc_nulls_first("term"))
        parts.append(stage(near.mapInArrow(_searcher(sent, n_all, l_all, k), "qid long, doc_id long, score long"), "found"))
    if not parts:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    # In two steps, so that no task gets all shards' results of an item.
    some = Window.partitionBy("qid", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    top = few.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(*order))).where(F.col("rank") <= k)
    return top.join(asked.select("qid", "item_id"), "qid").select("item_id", "rank", "doc_id", "score")
