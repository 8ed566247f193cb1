"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(columns: list[str], name: str) -> str:
    """The name, with underscores ahead until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def learns_from(name: str, modulus: int, held: int) -> Column:
    """True on rows whose crc32 of the id, as text, leaves another remainder than ``held``.

    A null id counts as the empty text (crc32 0).
    """
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus != held


def running_totals(df: DataFrame, order: list[str], weight: str, name: str) -> DataFrame:
    """Adds the global row number ``__row`` and the sum ``__before`` of ``weight`` ahead of each row.

    Rows are dealt to partitions by ranges of ``order`` (sampled splitters, so
    equal leading values may lie in several partitions) and written once with
    their partition's number; one total per partition is all that crosses the
    driver, and the sums inside a partition start from the totals ahead of it.
    Rows equal in all of ``order`` may change places: give columns that tell
    different rows apart.
    """
    dealt = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    laid = stage(dealt, name)
    totals = sorted(laid.groupBy("__part").agg(F.count("*"), F.sum(weight)).collect(), key=lambda r: r[0])
    ahead, rows, total = [], 0, 0
    for part, n, size in totals:
        ahead.append((part, rows, total))
        rows, total = rows + n, total + size
    spark = df.sparkSession
    starts = F.broadcast(spark.createDataFrame(ahead, "__part int, __rows0 long, __total0 long"))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        laid.join(starts, "__part")
        .withColumn("__row", F.col("__rows0") + F.count("*").over(inside) - 1)
        .withColumn("__before", F.col("__total0") + F.sum(weight).over(inside) - F.col(weight))
        .withColumn("__all", F.lit(total))
        .drop("__rows0", "__total0")
    )
