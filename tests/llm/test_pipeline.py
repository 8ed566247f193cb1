"""The pipeline on a small corpus with planted cases; queries against their SQL."""

import os
import sys
from pathlib import Path

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from seriesloom.llm import queries
from seriesloom.session import stage

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


def test_planted_cases_go_and_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    near = " ".join(f"n{i}" for i in range(100))
    rows = [
        (9001, near, "en", "p", 1), (9002, near + " end", "en", "p", 1), (9003, near, "en", "p", 1),
        (9004, f"before {item} after", "en", "p", 1), (9005, "clean words password = hunter2222 here", "en", "p", 1), (None, None, None, None, None),
    ]
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    columns = docs.columns
    unique = corpus_pipeline.keep_one_of_each(spark, docs, str(SF))
    ids = [r.doc_id for r in unique.collect()]
    assert unique.columns == columns and {9001, 9004, 9005, None} <= set(ids) and not {9002, 9003} & set(ids)
    free = corpus_pipeline.decontaminated(spark, unique, str(SF))
    left = {r.doc_id: r.text for r in free.collect()}
    assert free.columns == columns and 9004 not in left and {9001, 9005, None} <= set(left)
    hidden = {r.doc_id: r.text for r in corpus_pipeline.without_secrets(spark, free, str(SF)).collect()}
    assert set(hidden) == set(left) and hidden[9005] == "clean words [assign] here"
    pieces = corpus_pipeline.packed(spark, free, str(SF)).collect()
    assert {p.doc_id for p in pieces} == set(left)


def test_toxicity_stage_keeps_what_the_network_keeps(spark):
    """Decisions equal those of the same network run over all texts in this process, under column names that might clash."""
    from seriesloom.llm import toxicity
    from seriesloom.llm.common import learns_from

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(learns_from("doc_id", 4, 2))
    net = toxicity.fit(docs, labels)
    rows = docs.select("doc_id", "text").collect()
    stays = {r.doc_id for r, s in zip(rows, toxicity.score_texts(net, [r.text or "" for r in rows])) if s < corpus_pipeline.REJECT}
    clashing = docs.select("*", *(F.lit(1).alias(c) for c in ("__text", "__id", "__y", "__toxicity", "__doc", "score")))
    out = corpus_pipeline.drop_toxic(spark, clashing, str(SF))
    assert out.columns == clashing.columns and {r.doc_id for r in out.collect()} == stays
    assert 0 < len(stays) < len(rows)


def test_stages_take_empty_tables_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ("__text", "id", "item", "qid", "piece", "digest", "w", "label", "__row")
    for some in (docs.limit(0), docs.limit(12).select("*", *(F.lit(1).alias(c) for c in names))):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, some, str(SF))
            assert name == "packing" or out.columns == some.columns
            assert (out.count() > 0) == (some.count() > 0), name


def test_run_is_its_stages_in_turn(spark):
    kept = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = stage(step(spark, kept, str(SF)), "by-hand")
    ids = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.packed(spark, kept, str(SF)).collect()}
    got = corpus_pipeline.run(spark, str(SF)).collect()
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in got} == ids
    for seq in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == seq), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_stages_are_the_registered_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    sys.path.insert(0, os.fspath(Path(__file__).resolve().parent.parent.parent / "tools"))
    import check

    got = queries.QUERIES[name](spark, str(SF))
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert check.canonical([tuple(r) for r in got.collect()], got.columns) == check.canonical(cursor.fetchall(), names)
