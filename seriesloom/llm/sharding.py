"""Contiguous shards of near equal size from global prefix sums of bytes.

Rows are ordered by content (checksum, then id), so equal texts are neighbours;
every partition's total gives the prefix sum its rows start from, and the line
from 0 to the total is cut at equal targets. A row goes where its middle byte
falls: no shard is off its target by more than the largest text.

Defined cases: a null text counts as empty (size 1); null ids keep their row;
repeated rows are rows of their own; a text larger than a shard's target fills
a shard and may leave its neighbour empty; an empty table gives no rows. Other
columns of the input are not read by ``shard_by_bytes``; ``write_shards`` keeps
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import running_totals, text_of


def shard_by_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """id, size, text_crc32, shard and slot (the row's place in its shard, from 0)."""
    if shards < 1:
        raise ValueError("shards must be positive")
    sized = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text_of(text_col)) + 1).cast("long").alias("size"),
        F.crc32(text_of(text_col).cast("binary")).alias("text_crc32"),
    )
    laid = running_totals(sized, ["text_crc32", "id", "size"], "size", "shards")
    middle = F.expr(f"((2 * __before + size) * {shards}) div (2 * __all)")
    cut = laid.withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))
    first = cut.groupBy("shard").agg(F.min("__row").alias("__first"))  # one row a shard
    return cut.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("__row") - F.col("__first")).alias("slot")
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> None:
    """Writes whole rows under ``path/shard=N``. Ids must be unique and not null."""
    cut = shard_by_bytes(df, id_col, text_col, shards).select(id_col, "shard")
    df.drop("shard").join(cut, id_col).write.partitionBy("shard").parquet(path)
