"""Benchmark decontamination: a BM25 index of test items queried by every training passage.

Texts are cut into overlapping passages of ``PASSAGE`` words. A passage queries
the inverted index of the items with its distinct words; an item's score is
relative to what the item scores on itself, so one threshold fits all. Items of
more than ``STRIDE`` words are indexed whole and in parts of at most so many, each
relative to its own score, and any part found brings the whole item: some passage
holds a copied part whole, wherever it lies, so an item's length hides nothing. Retrieval
is block-max WAND, a batch of passages at a time: a passage whose words' largest
scores together stay below the threshold is passed over; of the others, a block
of items is opened only where the sum of its words' block maxima reaches the
threshold, and scored exactly. Everything above it is verified:
half of the five-word runs of the question and of the answer must occur in the
document. The answer is the item's last sentence, the question what stands
before it (of one sentence: both are all of it).

Defined cases: null and empty texts have no passages; null and empty items, and
items without words, are never found; null ids are kept, repeated documents give
rows of their own and repeated items one row each; texts are read whole; the score
is that of the best part; an empty table gives no rows. Items are indexed ``SLICE`` at a time, so the broadcast
index is bounded, with word statistics of all items.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import running_totals, text_of

PASSAGE, STRIDE = 128, 64
THRESHOLD, OVERLAP, RUN = 0.6, 0.5, 5
K1, B, BLOCK, SLICE = 1.2, 0.75, 8, 2000
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def runs(words: list[str], n: int = RUN) -> set[tuple[str, ...]]:
    """Runs of n words; all words if there are fewer."""
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words before the last sentence, and of it; a last sentence too short for a run takes in the one before."""
    parts = [w for w in map(words_of, re.split(r"[.?!\n]+", text)) if w]
    if not parts:
        return [], []
    cut = len(parts) - 1
    while cut > 0 and sum(map(len, parts[cut:])) < RUN:
        cut -= 1
    answer = [w for p in parts[cut:] for w in p]
    return [w for p in parts[:cut] for w in p] or answer, answer


def parts_of(words: list[str], size: int = STRIDE) -> list[list[str]]:
    """The words, and if they are more than ``size``, their parts of at most so many, as even as possible."""
    n = -(-len(words) // size)
    cuts = [len(words) * i // n for i in range(n + 1)] if n > 1 else []
    return [words, *(words[a:b] for a, b in zip(cuts[:-1], cuts[1:]))]


class Index:
    """Postings (part of an item, share of the part's own score) by word, with maxima by word and by word and block."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], count: int, mean_size: float):
        self.ids = [i for i, _ in items]
        self.sides = [question_and_answer(t) for _, t in items]
        self.terms: dict[str, int] = {}
        rows: list[tuple[int, int, float]] = []
        parts = [(i, part) for i, (_, text) in enumerate(items) for part in parts_of(words_of(text))]
        self.owner = np.array([i for i, _ in parts], np.int64)
        for n, (_, part_words) in enumerate(parts):
            tf = Counter(part_words)
            norm = K1 * (1 - B + B * sum(tf.values()) / mean_size)
            part = {w: math.log(1 + (count - df[w] + 0.5) / (df[w] + 0.5)) * f * (K1 + 1) / (f + norm) for w, f in tf.items()}
            own = sum(part.values())
            rows += [(self.terms.setdefault(w, len(self.terms)), n, s / own) for w, s in part.items()]
        rows.sort()
        term, self.item, self.weight = (np.array(c) for c in zip(*rows)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.per = max(BLOCK, -(-len(parts) * BLOCK // SLICE))  # so that block maxima stay few when items are long
        self.blocks = len(parts) // self.per + 1
        self.starts = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.top = np.maximum.reduceat(self.weight, self.starts[:-1]) if rows else np.zeros(0)
        self.block_top = np.zeros((len(self.terms), self.blocks), np.float32)
        np.maximum.at(self.block_top, (term, self.item // self.per), self.weight)
        self.pair = term * len(parts) + self.item  # sorted, to look up single postings

    def search(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, part, score) at or above the threshold, for distinct (passage, term) pairs."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        total = np.bincount(passage, self.top[term]) if len(term) else np.zeros(0)
        live = total[passage] >= threshold if len(term) else np.zeros(0, bool)
        passage, term = passage[live], term[live]
        if not len(term):
            return none
        begin = np.flatnonzero(np.append(True, np.diff(passage) > 0))
        size = np.diff(np.append(begin, len(passage)))
        out = []
        # Some thousand pairs at a time: a row of block bounds for each.
        cuts = np.unique(np.append(np.searchsorted(np.cumsum(size), np.arange(0, len(term), 20_000)), len(begin)))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            first, last = begin[lo], begin[hi - 1] + size[hi - 1]
            bound = np.add.reduceat(self.block_top[term[first:last]], begin[lo:hi] - first)
            r, block = np.nonzero(bound >= threshold * (1 - 1e-5))  # single precision
            r += lo
            n, item = _expand(np.arange(len(r)), block * self.per, np.minimum((block + 1) * self.per, len(self.owner)))
            c, at = _expand(np.arange(len(n)), begin[r[n]], begin[r[n]] + size[r[n]])
            score = np.bincount(c, _look_up(self.pair, self.weight, term[at] * len(self.owner) + item[c]), minlength=len(n))
            hit = score >= threshold - 1e-9
            out.append((passage[begin[r[n[hit]]]], item[hit], score[hit]))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else none


def _expand(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of every range, with its range's owner."""
    n = end - start
    return np.repeat(owner, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - start, n)


def _look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0.0)


def search_texts(index: Index, texts: list[str], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
    """(text, item, best score of a passage and a part, question's and answer's overlap) of all verified finds."""
    get = index.terms.get
    term_of, owner, passages = [], [], 0
    for n, text in enumerate(texts):
        t = np.array([get(w, -1) for w in words_of(text)], np.int64)
        for at in range(0, max(1, len(t) - (PASSAGE - STRIDE)), STRIDE) if len(t) else ():
            inside = t[at : at + PASSAGE]
            term_of.append(inside[inside >= 0])
            owner.append(n)
            passages += 1
    if not passages or not index.terms:
        return []
    which = np.repeat(np.arange(passages), [len(t) for t in term_of])
    pairs = np.unique(which * len(index.terms) + np.concatenate(term_of))
    p, parts, scores = index.search(pairs // len(index.terms), pairs % len(index.terms), threshold)
    best: dict[tuple[int, int], float] = {}
    for n, item, s in zip(p.tolist(), index.owner[parts].tolist(), scores.tolist()):
        key = owner[n], item
        best[key] = max(s, best.get(key, 0.0))
    out, last, seen = [], -1, set()
    for (n, item), s in sorted(best.items()):
        if n != last:
            words = words_of(texts[n])
            last, seen, flat = n, runs(words), f" {' '.join(words)} "
        share = []
        for side in index.sides[item]:
            mine = runs(side)
            share.append(sum((r in seen) if len(r) == RUN else f" {' '.join(r)} " in flat for r in mine) / len(mine))
        if min(share) >= overlap:
            out.append((n, item, s, *share))
    return out


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, word) of every word, by the rule that passages are cut by."""
    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held = words_of(text)
            yield pa.RecordBatch.from_arrays([pa.array([row] * len(held), pa.int64()), pa.array(held, pa.string())], names=["__row", "w"])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """id, item_id, score, question_overlap and answer_overlap of every document that holds a test item."""
    spark = docs.sparkSession
    bench = items.select(F.col(item_col).cast("long").alias("item"), text_of(item_text).alias("text"))
    schema = f"{id_col} long, item_id long, score double, question_overlap double, answer_overlap double"
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    laid = running_totals(bench.withColumn("one", F.lit(1)), ["item", "text"], "one", "items")
    found = spark.createDataFrame([], schema)
    count = laid.count()
    if not count:
        return found
    words = laid.select("__row", "text").mapInArrow(_words, "__row long, w string")
    mean_size = (words.count() or 1) / count
    for lo in range(0, count, SLICE):
        part = laid.where(F.col("__row").between(lo, lo + SLICE - 1)).select("item", "text").orderBy("item", "text").collect()
        vocabulary = sorted({w for _, t in part for w in words_of(t)})
        asked = F.broadcast(spark.createDataFrame([(w,) for w in vocabulary], "w string"))
        df = dict(words.join(asked, "w").groupBy("w").agg(F.countDistinct("__row")).collect())
        # Plain arrays and lists, so that workers need no module to read them; bounded by SLICE items.
        sent = spark.sparkContext.broadcast(vars(Index([tuple(r) for r in part], df, count, mean_size)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index.__new__(Index)
            vars(index).update(sent.value)
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    some = batch.slice(at, 500)
                    hits = search_texts(index, some.column(1).to_pylist())
                    ids = some.column(0).to_pylist()
                    cols = [[ids[h[0]] for h in hits], [index.ids[h[1]] for h in hits], *([h[i] for h in hits] for i in (2, 3, 4))]
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[id_col, "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.unionAll(texts.mapInArrow(run, schema))
    return found
