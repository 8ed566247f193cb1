"""Merkle fixity audit of replicated WARC archives.

A replica is a table of records with their byte offset. Records are hashed, and
ordered ranges of offsets are hashed into trees: a node of level 1 is a range of
``RANGE`` bytes, a node of level n+1 is ``FAN`` neighbouring nodes of level n.
Two replicas are compared at the root, and only children of mismatching nodes
are compared further down, until single records are left.

Defined cases: null url, html or id count as empty in the record; repeated rows
are records of their own; a record longer than a range belongs to the range its
first byte falls in; several records at one offset are hashed in the order of
their digests; an empty replica has an empty tree, so every record of the other
is missing or extra; two empty replicas have no differences. Only the named
columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import running_totals
from seriesloom.session import stage

RANGE = 64 * 1024
FAN = 16


def records(pages: DataFrame) -> DataFrame:
    """page_id and the bytes of one WARC response record per page."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    body = part("html")
    return pages.select(
        "page_id",
        F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), part("page_id"),
            F.lit(">\r\nWARC-Target-URI: "), part("url"),
            F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
        ).cast("binary").alias("record"),
    )


def lay_out(recs: DataFrame) -> DataFrame:
    """page_id, offset, length and digest of the records of one archive, ordered by page_id, then digest."""
    hashed = recs.select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    laid = running_totals(hashed, ["page_id", "digest"], "length", "warc")
    return laid.select("page_id", F.col("__before").alias("offset"), "length", "digest")


def _level(nodes: DataFrame, span: int, fan_in: str) -> DataFrame:
    """Nodes of ``span`` bytes from the (offset, digest) rows below, ``fan_in`` naming the order."""
    inside = F.array_sort(F.collect_list(F.struct(fan_in, "digest")))
    joined = F.concat_ws(",", F.transform(inside, lambda x: F.concat_ws(":", x[fan_in].cast("string"), x["digest"])))
    return nodes.groupBy(F.expr(f"{fan_in} div {span}").alias("node")).agg(F.sha2(joined, 256).alias("digest"))


def tree(replica: DataFrame, height: int) -> list[DataFrame]:
    """Levels from the ranges of ``RANGE`` bytes up to the root; a node holds few digests (bounded by its span)."""
    levels = [stage(_level(replica, RANGE, "offset"), "tree")]
    for _ in range(height):
        levels.append(stage(_level(levels[-1], FAN, "node"), "tree"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.withColumnRenamed("digest", "__a").join(b.withColumnRenamed("digest", "__b"), "node", "full_outer")
    return both.where(~F.col("__a").eqNullSafe(F.col("__b"))).select("node")


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Records that differ between two replicas (page_id, offset, length, digest each).

    Returns page_id, offset, length, fault (changed, missing, extra: seen from
    ``ours``), digest and other_digest.
    """
    ours, theirs = stage(ours, "replica"), stage(theirs, "replica")
    end = ours.agg(F.max("offset")).unionAll(theirs.agg(F.max("offset"))).agg(F.max("max(offset)")).first()[0] or 0
    height = 0
    while end // (RANGE * FAN**height):
        height += 1
    mine, other = tree(ours, height), tree(theirs, height)
    bad = _differing(mine[-1], other[-1])
    for a, b in zip(mine[-2::-1], other[-2::-1]):
        parents = bad.select(F.col("node").alias("__parent"))
        inside = lambda level: level.join(parents, F.expr(f"node div {FAN}") == F.col("__parent"), "left_semi")  # noqa: B023, E731
        bad = _differing(inside(a), inside(b))
    ranges = bad.select(F.col("node").alias("__range"))
    leaves = lambda r: r.join(ranges, F.expr(f"offset div {RANGE}") == F.col("__range"), "left_semi")
    # Equal records at one offset are numbered, so a lost repeat shows up as missing.
    numbered = F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))

    def keyed(replica: DataFrame, side: str) -> DataFrame:
        counted = leaves(replica).groupBy("page_id", "offset", "length", "digest").agg(F.count("*").alias("__n"))
        return counted.withColumn("__k", numbered).drop("__n").toDF(*(f"{side}_{c}" for c in ("page_id", "offset", "length", "digest", "k")))

    left, right = keyed(ours, "a"), keyed(theirs, "b")
    on = [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in ("page_id", "offset", "k")]
    both = left.join(right, on, "full_outer").where(~F.col("a_digest").eqNullSafe(F.col("b_digest")))
    fault = F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra").otherwise("changed")
    either = [F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in ("page_id", "offset", "length")]
    return both.select(*either, fault.alias("fault"), F.col("a_digest").alias("digest"), F.col("b_digest").alias("other_digest"))
