"""Connected components by hooking to smaller neighbours, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.session import stage


def components(edges: DataFrame) -> DataFrame:
    """id and label (the component's smallest id) of every end of the edges (a, b), which may repeat.

    A round points every node at its smallest neighbour, if that is smaller, and
    follows pointers to their ends; then edges connect these ends, and those
    inside one tree go. At least half of the nodes leave each round, so an
    edge is joined once or twice in all. Minima are combined before rows move; a
    node with very many edges is the join's affair, which splits it. Tables
    are written as they change, so a lost executor costs a task.
    """
    live = _between(edges.toDF("a", "b"))
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        up = stage(live.groupBy("a").agg(F.min("b").alias("p")), "pointers")
        while True:
            above = up.select(F.col("a").alias("__a"), F.col("p").alias("__p"))
            new = stage(up.join(above, F.col("p") == F.col("__a"), "left").select("a", F.coalesce("__p", "p").alias("p"), F.col("__p").isNotNull().alias("moved")), "pointers")
            up = new.select("a", "p")
            if new.where("moved").isEmpty():
                break
        rounds.append(up)
        ends = up.select(F.col("a").alias("__b"), F.col("p").alias("__p"))
        first = live.join(up, "a").select(F.col("p").alias("a"), "b").where("a <> b").distinct()
        live = _between(first.join(ends, F.col("b") == F.col("__b"), "left").select("a", F.coalesce("__p", "b").alias("b")))
    if not rounds:
        return live.toDF("id", "label")
    labels = rounds[-1].toDF("id", "label")
    for up in rounds[-2::-1]:
        later = labels.toDF("__id", "__label")
        labels = stage(up.join(later, F.col("p") == F.col("__id"), "left").select(F.col("a").alias("id"), F.coalesce("__label", "p").alias("label")).unionAll(labels), "labels")
    return labels.unionAll(labels.select("label", "label").distinct())


def _between(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller end, loops left out."""
    return stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
