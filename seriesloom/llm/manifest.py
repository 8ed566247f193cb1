"""Merkle manifest of a table: content-addressed records, and proofs by descent from the root.

Every row is a leaf; the leaves of a group, ranked by id, are hashed ``FAN`` at a
time until one digest is left, and so are the groups' digests, ranked by name. A
store keeps one record of each inner node: digest, and the digests of its
children in order. A proof is found from the root digest alone: a request is a
leaf's rank, its digits to base ``FAN`` say which child to follow, the children
not followed are noted as one path segment, and at the leaf the segments are
reversed, so that they run from leaf to root. Requests that share leading digits
descend as one, so the upper nodes, which all requests pass, are one row each.

The tree is built ``STEP`` levels at a time: one shuffle brings the at most
``FAN ** STEP`` nodes below a node together. Ranks are global row numbers from
partition totals less those of the group's first row, so no group, however
large, is in one task.

Defined cases: a null value is hashed as ``-``, unlike an empty text; null groups
come first and null ids first in their group; rows of one group and id are
ranked by their digests, so repeated rows are leaves of their own with equal
digests (one record serves equal nodes, each has its own proof); a lone leaf is
its group's digest, with no segments; an empty table has no rows and no root.
Further columns of the input are not read, and none of their names clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import running_totals
from seriesloom.session import stage

FAN, STEP = 3, 5


@dataclass
class Manifest:
    """``leaves`` (with __key, __pos, leaf, subroot and what was carried), ``groups`` (group, __key, subroot, __height), the store and the root."""

    leaves: DataFrame
    groups: DataFrame
    store: DataFrame
    root: str | None
    height: int  # of the tree over the groups


def joined_hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes ahead, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def height_of(count: Column) -> Column:
    """Levels above ``count`` leaves: the smallest h with FAN ** h >= count."""
    powers = [F.when(count > FAN**k, 1).otherwise(0) for k in range(40) if FAN**k < 2**62]
    return sum(powers[1:], powers[0]).cast("int")


def _runs(digests: Column) -> Column:
    """Every ``FAN`` consecutive ones."""
    last = F.ceil(F.size(digests) / FAN).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(digests, i * FAN + 1, FAN))


def _nodes(level: int, first: Column, children: Column, digests: Column) -> Column:
    return F.transform(children, lambda c, i: F.struct(F.lit(level).alias("l"), (first + i).alias("p"), F.get(digests, i).alias("d"), c.alias("c")))


def _trees(nodes: DataFrame, name: str) -> DataFrame:
    """All nodes over leaves (__key, __pos, __digest, __height), with __level and __children; each group's last is its root."""
    built = stage(nodes.select("__key", F.lit(0).alias("__level"), "__pos", "__digest", F.lit(None).cast("array<string>").alias("__children"), "__height"), name)
    tallest = built.agg(F.coalesce(F.max("__height"), F.lit(0))).first()[0]
    parts, level = [built], 0
    while level < tallest:
        below = parts[-1].where((F.col("__level") == level) & (F.col("__height") > level))
        inside = F.array_sort(F.collect_list(F.struct("__pos", "__digest")))
        grouped = below.groupBy("__key", "__height", F.expr(f"__pos div {FAN**STEP}").alias("__top")).agg(inside["__digest"].alias("d0"))
        records = []
        for k in range(1, STEP + 1):
            grouped = grouped.withColumn(f"c{k}", _runs(F.col(f"d{k - 1}")))
            grouped = grouped.withColumn(f"d{k}", F.transform(f"c{k}", lambda c: joined_hash(F.concat_ws("", c))))
            made = _nodes(level + k, F.col("__top") * FAN ** (STEP - k), F.col(f"c{k}"), F.col(f"d{k}"))
            records.append(F.when(F.col("__height") >= level + k, made).otherwise(F.array()))
        rows = grouped.select("__key", "__height", F.explode(F.concat(*records)).alias("n"))
        parts.append(stage(rows.select("__key", "n.l", "n.p", "n.d", "n.c", "__height").toDF("__key", "__level", "__pos", "__digest", "__children", "__height"), name))
        level += STEP
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def build(rows: DataFrame, group: str, order: str, leaf: Column, carry: dict[str, Column]) -> Manifest:
    """The manifest of all rows; ``carry`` names columns that stay with the leaves."""
    leaves = rows.select(F.col(group).cast("string").cast("binary").alias("__group"), F.col(order).alias("__id"), leaf.alias("leaf"), *(c.alias(n) for n, c in carry.items()))
    leaves = stage(leaves.withColumn("__one", F.lit(1)), "leaves")
    ranked = stage(running_totals(leaves, ["__group", "__id", "leaf"], "__one", "ranks").drop("__part", "__before", "__all", "__one"), "ranked")
    sizes = ranked.groupBy("__group").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    sizes = sizes.withColumn("__one", F.lit(1))
    named = stage(running_totals(sizes, ["__group"], "__one", "groups").select("__group", F.col("__row").cast("int").alias("__key"), "__first", height_of(F.col("__n")).alias("__height")), "groups")
    # The groups are a small side as long as Spark measures them so; a sorted join otherwise, its hot group split at run time.
    keyed = ranked.join(named, ranked["__group"].eqNullSafe(named["__group"])).drop(named["__group"])
    keyed = stage(keyed.select("__key", (F.col("__row") - F.col("__first")).alias("__pos"), "__height", "__id", "leaf", *carry), "keyed")
    nodes = _trees(keyed.withColumnRenamed("leaf", "__digest"), "nodes")
    tops = nodes.where("__level = __height").select("__key", F.col("__digest").alias("subroot"))
    groups = stage(named.join(tops, "__key"), "subroots")
    count = groups.count()
    top = _trees(groups.select(F.lit(-1).alias("__key"), F.col("__key").cast("long").alias("__pos"), F.col("subroot").alias("__digest"), height_of(F.lit(count).cast("long")).alias("__height")), "top")
    last = top.where("__level = __height").select("__digest", "__height").first()
    records = nodes.unionAll(top).where("__level > 0").groupBy(F.col("__key") < 0, "__level", "__digest").agg(F.first("__children").alias("__children"))
    store = stage(records.toDF("__upper", "__level", "__digest", "__children"), "store", partition_by=["__upper", "__level"])
    return Manifest(keyed, groups, store, last and last[0], last[1] if last else 0)


def _down(asked: DataFrame, store: DataFrame, upper: bool, level: int) -> DataFrame:
    """One step: each (__key, __pos, __digest, __path) becomes its children, each with the others noted."""
    here = store.where((F.col("__upper") == upper) & (F.col("__level") == level)).select(F.col("__digest").alias("__d"), "__children")
    size = F.size("__children")
    opened = asked.join(here, F.col("__digest") == F.col("__d")).select("__key", "__pos", "__path", "__children", F.explode(F.sequence(F.lit(0), size - 1)).alias("__i"))
    left, right = F.concat_ws("", F.slice("__children", 1, F.col("__i"))), F.concat_ws("", F.slice("__children", F.col("__i") + 2, FAN))
    segment = F.struct(left.alias("left"), right.alias("right"))
    return opened.select("__key", (F.col("__pos") * FAN + F.col("__i")).alias("__pos"), F.get("__children", F.col("__i")).alias("__digest"), F.concat("__path", F.array(segment)).alias("__path"))


def descend(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """__key, __pos, __digest and __path (segments, leaf first) of the wanted leaves (__key, __pos), from the root down.

    A step follows only children with a wanted leaf below them: ranks are cut to
    their leading digits. Without ``wanted`` all leaves are asked for.
    """
    spark = made.store.sparkSession
    path = "array<struct<left: string, right: string>>"
    now = spark.createDataFrame([(-1, 0, made.root, [])] if made.root else [], f"__key int, __pos long, __digest string, __path {path}")
    keys = wanted and wanted.select(F.lit(-1).alias("__key"), F.col("__key").cast("long").alias("__pos")).distinct()
    for level in range(made.height, 0, -1):
        now = _asked(_down(now, made.store, True, level), keys, level - 1)
    at_group = now.select(F.col("__pos").cast("int").alias("__key"), F.lit(0).cast("long").alias("__pos"), "__digest", "__path")
    at_group = stage(at_group.join(made.groups.select("__key", "__height"), "__key"), "paths")
    tallest = at_group.agg(F.coalesce(F.max("__height"), F.lit(0))).first()[0]
    start = lambda h: at_group.where(F.col("__height") == h).drop("__height")
    now = start(tallest)
    for level in range(tallest, 0, -1):
        now = _asked(_down(now, made.store, False, level), wanted, level - 1).unionByName(start(level - 1))
    return now.withColumn("__path", F.reverse("__path"))


def _asked(nodes: DataFrame, wanted: DataFrame | None, level: int) -> DataFrame:
    if wanted is None:
        return nodes
    leading = wanted.select("__key", F.expr(f"__pos div {FAN**level}").alias("__pos")).distinct()
    return nodes.join(leading, ["__key", "__pos"], "left_semi")


def proof_of(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf up, left to right."""
    return joined_hash(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda a, s: joined_hash(s["left"], a, s["right"]))
