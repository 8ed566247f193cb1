"""Parameter search over predefined folds."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target


def fold_search(
    df: DataFrame,
    fold: str,
    label: str,
    candidates: dict[str, Estimator],
    parallelism: int = 4,
    keep: list[str] | None = None,
) -> DataFrame:
    """``(params, fold, mse, n)`` for every candidate and fold.

    Rows with a negative fold always train and are never scored. Each fit and
    each score runs on Spark; only the scores come back. ``parallelism`` of
    them are in flight at once, over one persisted table. ``keep`` names further
    columns that the candidates need, such as the row keys of bags.
    """
    rows = df.select("features", label, fold, *(keep or [])).persist(StorageLevel.MEMORY_AND_DISK)
    folds = [r[0] for r in rows.where(F.col(fold) >= 0).select(fold).distinct().collect()]

    @inheritable_thread_target(df.sparkSession)
    def score(task):
        name, k = task
        model = candidates[name].fit(rows.where(F.col(fold) != k))
        gap = F.col(label) - F.col("prediction")
        held_out = model.transform(rows.where(F.col(fold) == k))
        mse, n = held_out.agg(F.avg(gap * gap), F.count(F.lit(1))).first()
        return name, int(k), mse, n

    tasks = [(name, k) for name in candidates for k in sorted(folds)]
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(score, tasks))
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame(scores, "params string, fold int, mse double, n bigint")
