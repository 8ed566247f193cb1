"""Bounded-space online best-fit packing of tokenised documents.

Documents are tokenised where they lie; only piece lengths move on. A task packs
the pieces it gets one by one: at most ``open_bins`` sequences are open, a bitset
holds which free spaces occur among them, and a piece goes to the open sequence
with the least sufficient space. When a new sequence is needed and all places are
taken, the fullest open one closes first. Pieces of a whole sequence are
sequences of their own.

Defined cases: a null text counts as empty and gives one piece with the closing
id alone; null ids are kept; repeated rows are packed as rows of their own; an
empty table gives no rows. The string of a token that the tokenizer adds to its
vocabulary is that token's id, as in the tokenizer's own default. Only the named
columns are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import text_of
from seriesloom.session import stage

#: The split pattern of the public vocabulary, and Unicode white space.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The public vocabulary's name, and its added tokens, which ranks don't list. Fixed values.
RANKS, ADDED = "byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256}
#: Pieces a task packs, about; words kept with their ids in a task.
PER_TASK, WORDS = 200_000, 400_000


class WordIds(dict):
    """Little-endian 32-bit ids of each run between white space, encoded once; forgets all when full.

    The split pattern never joins what white space parts, so texts can be
    encoded run by run.
    """

    def __init__(self, ranks_path: str | None = None):
        import tiktoken

        if ranks_path is None:
            import public_tokenizers

            ranks_path = public_tokenizers.path(RANKS)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = re.compile("(" + "|".join(map(re.escape, ADDED)) + ")").split
        self.runs = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        ids = self[word] = np.array(self.encoding.encode_ordinary(word), "<u4").tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if any(token in text for token in ADDED):
            return b"".join(np.array([ADDED[p]], "<u4").tobytes() if p in ADDED else self.encode(p) for p in self.added(text) if p)
        return b"".join(map(self.__getitem__, self.runs(text)))


def token_pieces(df: DataFrame, id_col: str, text_col: str, limit: int = 1024, end_id: int = 2, ranks_path: str | None = None) -> DataFrame:
    """id, piece, start, length, ids_crc32: whole documents, longer ones cut so that all but the first piece are full."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds(ranks_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.encode(text.as_py()) + end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - at) % limit or limit
                    for col, v in zip(out, (key, piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)]))):
                        col.append(v)
                    at, piece = at + size, piece + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["id", "piece", "start", "length", "ids_crc32"])

    texts = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Open sequences by free space; ``put`` gives the (sequence, offset) of a piece."""

    def __init__(self, limit: int, open_bins: int):
        self.limit, self.open_bins = limit, open_bins
        self.spaces, self.held, self.count, self.made = 0, [[] for _ in range(limit + 1)], 0, 0

    def _take(self, space: int) -> int:
        seq = self.held[space].pop()
        if not self.held[space]:
            self.spaces &= ~(1 << space)
        self.count -= 1
        return seq

    def put(self, size: int) -> tuple[int, int]:
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            seq = self._take(space)
        else:
            if self.count >= self.open_bins:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
            space, seq = self.limit, self.made
            self.made += 1
        left = space - size
        if left:
            self.held[left].append(seq)
            self.spaces |= 1 << left
            self.count += 1
        return seq, self.limit - space


def pack(pieces: DataFrame, limit: int = 1024, open_bins: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to the rows of ``token_pieces``."""
    laid = stage(pieces, "pieces")
    tasks = max(1, -(-laid.where(F.col("length") < limit).count() // PER_TASK))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins, base = BestFit(limit, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            seq, at = zip(*map(bins.put, batch.column("length").to_pylist())) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + s for s in seq], pa.int64()), pa.array(at, pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    schema = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    order = ["ids_crc32", "id", "piece"]
    dealt = laid.repartition(tasks, F.xxhash64(*order)).sortWithinPartitions(F.xxhash64(*order), *order)
    return dealt.mapInArrow(place, schema)
