"""Weighted medians: the smallest value whose cumulative weight reaches half."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.session import stage

SALTS = 16


def weighted_median_of(entries: str | Column, value: str = "value", weight: str = "weight") -> Column:
    """Row-local form, over an array of structs (one per ensemble member)."""
    arr = F.col(entries) if isinstance(entries, str) else entries
    ordered = F.array_sort(
        F.transform(arr, lambda e: F.struct(e[value].alias("v"), e[weight].alias("w")))
    )
    total = F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + e[weight])
    start = F.struct(F.lit(0.0).alias("run"), F.lit(None).cast("double").alias("hit"))

    def step(acc, e):
        run = acc["run"] + e["w"]
        hit = F.when(acc["hit"].isNull() & (run >= F.lit(0.5) * total), e["v"]).otherwise(acc["hit"])
        return F.struct(run.alias("run"), hit.alias("hit"))

    return F.aggregate(ordered, start, step, lambda acc: acc["hit"])


def weighted_median(
    df: DataFrame, keys: list[str], value: str, weight: str, out: str = "median", detail: int = 256, few: int = 1024
) -> DataFrame:
    """Weighted median per group, exact, for groups of any size and values of any spread.

    Equal values are summed first. Then the range that holds the median is
    narrowed: it is split into ``detail`` steps, logarithmic ones at first and
    equal ones from then on, the weights of the steps are summed map-side and
    walked per group, and the least and greatest value of the step where half
    the weight is reached are the next range. Ranges are written each round,
    one row a group. A group whose range holds at most ``few`` values is ordered;
    no task orders more of it.
    """
    v = F.col(value).cast("double")
    summed = df.where(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(*keys, v.alias("__v")).agg(F.sum(weight).alias("__w"))
    # Ranges are looked up by group and a salt, so that a group's values stay spread.
    summed = stage(summed.withColumn("__salt", F.pmod(F.xxhash64("__v"), F.lit(SALTS))), "values")
    log_step = F.floor(F.signum("__v") * F.log1p(F.abs("__v")) * F.lit(float(detail)))
    low = F.col("__low") / 2  # halves, because the width may exceed a double
    even_step = F.least(F.lit(detail - 1.0), F.floor((F.col("__v") / 2 - low) / (F.col("__high") / 2 - low) * detail))
    ends = [F.sum("__w").alias("__w"), F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.count("*").alias("__n")]
    half = Window.partitionBy(*keys)
    steps = summed.groupBy(*keys, log_step.alias("__step")).agg(*ends).withColumn("__half", F.sum("__w").over(half) * 0.5)
    ranges, done = stage(_crossing(steps.withColumn("__from", F.lit(0.0)), keys), "ranges"), []
    while True:
        done.append(ranges.where((F.col("__n") <= few) | (F.col("__low") >= F.col("__high"))))
        open_ = ranges.where((F.col("__n") > few) & (F.col("__low") < F.col("__high")))
        if open_.isEmpty():
            break
        inside = _inside(summed, open_, keys).withColumn("__step", even_step)
        steps = inside.groupBy(*keys, "__step", F.col("__before").alias("__from"), "__half").agg(*ends)
        ranges = stage(_crossing(steps, keys), "ranges")
    last = _inside(summed, reduce(DataFrame.unionByName, done), keys)
    fine = Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.col("__before") + F.sum("__w").over(fine) >= F.col("__half")
    # Rounding of the sums may leave the range's last value a hair short of half.
    return (
        last.select(*keys, "__v", reached.alias("__reached"))
        .groupBy(*keys)
        .agg(F.coalesce(F.min(F.when(F.col("__reached"), F.col("__v"))), F.max("__v")).alias(out))
    )


def _crossing(steps: DataFrame, keys: list[str]) -> DataFrame:
    """The step of each group where half its weight is reached, with the weight ahead of it."""
    walk = Window.partitionBy(*keys).orderBy("__step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    through = F.col("__from") + F.sum("__w").over(walk)
    row = F.struct("__step", (through - F.col("__w")).alias("__before"), "__half", "__low", "__high", "__n")
    walked = steps.select(*keys, row.alias("__row"), (through >= F.col("__half")).alias("__reached"))
    pick = F.coalesce(F.min(F.when(F.col("__reached"), F.col("__row"))), F.max("__row")).alias("__row")
    return walked.groupBy(*keys).agg(pick).select(*keys, "__row.*").drop("__step")


def _inside(summed: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Values within their group's range; null keys are groups, too."""
    salted = ranges.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    at = salted.withColumnsRenamed({c: f"__at_{c}" for c in [*keys, "__salt"]})
    same = [F.col(c).eqNullSafe(F.col(f"__at_{c}")) for c in keys] + [F.col("__salt") == F.col("__at___salt")]
    met = summed.join(at, same).where(F.col("__v").between(F.col("__low"), F.col("__high")))
    return met.drop(*[f"__at_{c}" for c in [*keys, "__salt"]])
