"""Merkle manifest against a plain recursion, with asked subsets and groups of every small size."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from seriesloom.llm import manifest, queries

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, leaf string, __pos int, `__group` string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def climb(digests, at):
    """The root of a run of digests, and (left, right) siblings of one of them, leaf first."""
    path = []
    while len(digests) > 1:
        run = digests[at - at % 3 : at - at % 3 + 3]
        path.append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        digests, at = [h(*digests[i : i + 3]) for i in range(0, len(digests), 3)], at // 3
    return digests[0], path


def expected(rows):
    import zlib

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r, r[4]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(groups[s], key=lambda x: x[:3]) for s in names}
    subroots = [climb([x[2] for x in ordered[s]], 0)[0] for s in names]
    out = []
    for g, s in enumerate(names):
        root, above = climb(subroots, g)
        for i, (_, _, leaf, row) in enumerate(ordered[s]):
            path = climb([x[2] for x in ordered[s]], i)[1] + above
            now, tampered = leaf, zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0
            if tampered and row[4] is not None:
                now = leaf_of(row, row[4].replace("\n", ""))
            for left, right in path:
                now = h(left, now, right)
            out.append((row[0], leaf, subroots[g], root, h(*(a + b for a, b in path)), now, now == root))
    return out


def key(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def check(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", 7, "g") for r in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op11_manifest(spark, str(tmp_path)).collect()]
    assert key(got) == key(expected(rows))


def test_manifest_equals_recursion(spark, tmp_path):
    rng = random.Random(3)
    text = lambda: rng.choice([None, "", "a\nb\n", "line", "é\n\n中", "\n"])
    rows = [(i, rng.choice(["a", "b", "é", "", None, "-"]), rng.choice([None, "en"]), rng.choice([None, 3]), text()) for i in range(300)]
    rows += [(i, "hot", "en", 1, text()) for i in range(1000, 1250)]  # more than FAN ** STEP leaves
    rows += [(5, "twice", "en", 1, "x\n")] * 4 + [(None, "hot", None, None, None), (None, "null id", "", 0, "\n"), (9, "lone", "en", 2, "q")]
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, "a\n")], [(i, "s", "en", 1, "t") for i in range(4)]])
def test_small_tables(spark, tmp_path, rows):
    check(spark, tmp_path, rows)


def test_asked_leaves_alone_descend(spark):
    rows = [(i, "s" if i < 100 else "t", "en", 1, f"text {i}") for i in range(130)]
    docs = spark.createDataFrame([(*r, "x", 7, "g") for r in rows], SCHEMA)
    made = manifest.build(docs, "source", "doc_id", F.sha2(F.col("text"), 256), {})
    wanted = made.leaves.where("__id IN (0, 57, 99, 129)")
    found = manifest.descend(made, wanted.select("__key", "__pos"))
    rows = wanted.join(found, ["__key", "__pos"]).select("__id", "leaf", "__digest", manifest.fold(F.col("leaf"), F.col("__path")).alias("root")).collect()
    assert sorted(r[0] for r in rows) == [0, 57, 99, 129]
    assert all(r.leaf == r["__digest"] and r.root == made.root for r in rows)
