"""One query per operator over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import decontaminate, jaccard, manifest, ngrams, packing, repeats, retrieval, rules, secrets, sharding, topk, toxicity, warc
from seriesloom.llm.common import learns_from, table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every whole document, as counts and spans."""
    found = F.col("findings")
    return secrets.findings(table(spark, sf_dir, "documents")).select(
        "doc_id", *(secrets.count(found, k).alias(f"n_{k}") for k in secrets.BASE),
        F.sha2(secrets.spans(found, secrets.BASE).cast("binary"), 256).alias("base_sha256"), secrets.spans(found).alias("spans"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of near equal bytes."""
    cut = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document under a trigram model, with all n-grams, of the documents that are not held out."""
    docs, learns = table(spark, sf_dir, "documents"), learns_from("doc_id", 7, 2)
    model = ngrams.fit(docs.where(learns), keep=(1, 1, 1))
    scored = ngrams.score(docs, model)
    return scored.select("doc_id", (~learns).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds an item of the benchmark, and which."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all others."""
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.exact_top_k(vectors, F.col("id") % 20 == 0, k=20)


OP5_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score FROM scored)
SELECT * FROM ranked WHERE "rank" <= 20
"""


def damaged(recs: DataFrame) -> DataFrame:
    """A second replica of a laid-out archive with known damage: some records flipped, some lost."""
    flipped = F.when(F.col("page_id") % 101 == 7, F.sha2(F.concat(F.lit("flipped "), "digest"), 256)).otherwise(F.col("digest"))
    return recs.where(F.coalesce(F.col("page_id") % 211 != 5, F.lit(True))).withColumn("digest", flipped)


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records against a replica damaged by a rule: every damaged record, found from the roots down."""
    ours = warc.lay_out(warc.records(table(spark, sf_dir, "pages")))
    return warc.audit(ours, damaged(ours))


OP6_SQL = """
WITH rec AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Length: ' || CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
hashed AS (SELECT page_id, CAST(octet_length(encode(record)) AS BIGINT) AS length, sha256(record) AS digest FROM rec),
laid AS (
  SELECT page_id, CAST(sum(length) OVER (ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS "offset", length, digest
  FROM hashed)
SELECT page_id, "offset", length, CASE WHEN page_id % 211 = 5 THEN 'missing' ELSE 'changed' END AS fault, digest,
  CASE WHEN page_id % 211 = 5 THEN NULL ELSE sha256('flipped ' || digest) END AS other_digest
FROM laid WHERE page_id % 211 = 5 OR page_id % 101 = 7
"""

def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document, learned from the labelled rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learns = learns_from("doc_id", 4, 2)
    scored = toxicity.score(docs, toxicity.fit(docs, labels.where(learns)))
    return scored.select("doc_id", (~learns).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), "doc_id", "text", limit=1024, end_id=2)
    return packing.pack(pieces, limit=1024).withColumnRenamed("id", "doc_id")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: five-word shingles, similarity of 0.8 or more."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by a 400-byte string that starts elsewhere, too."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text", length=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), "sha").alias("kept_sha256"),
    )


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaves and proofs of all documents by source; half of the ids are checked with their line breaks gone.

    A null id counts as the empty text in the choice of those (crc32 0: tampered).
    """
    head = [manifest.field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = manifest.joined_hash(*head, manifest.field(F.col("text")))
    stripped = manifest.joined_hash(*head, manifest.field(F.replace("text", F.lit("\n"), F.lit(""))))
    shown = F.when(learns_from("doc_id", 2, 0), F.lit(None)).when(F.contains("text", F.lit("\n")), stripped)
    made = manifest.build(table(spark, sf_dir, "documents"), "source", "doc_id", leaf, {"shown": shown})
    proved = made.leaves.join(manifest.descend(made), ["__key", "__pos"]).join(made.groups.select("__key", "subroot"), "__key")
    root = F.lit(made.root)
    folded = manifest.fold(F.coalesce("shown", "leaf"), F.col("__path"))
    out = proved.select(F.col("__id").alias("doc_id"), "leaf", "subroot", root.alias("root"), manifest.proof_of(F.col("__path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


OP11_SQL = """
WITH RECURSIVE
bits AS (SELECT i AS n, i::BIGINT AS c, 0 AS k FROM range(0, 256) t(i)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
d AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS name FROM documents),
marked AS (
  SELECT d.*, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(name[i])::BIGINT for i in range(1, length(name) + 1)]),
    lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295::BIGINT) % 2 = 0 AS tampered,
    list_reduce([CASE WHEN x IS NULL THEN '-' ELSE octet_length(encode(x)) || ':' || x END
      for x in [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)]], lambda a, b: a || b) AS head
  FROM d, crc),
leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) END AS shown
  FROM marked),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n FROM leaves),
levels AS (
  SELECT source, 0 AS level, p AS pos, leaf AS digest, n FROM ranked
  UNION ALL SELECT source, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
  FROM levels WHERE n > 1 GROUP BY source, level, n, pos // 3),
subroots AS MATERIALIZED (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS q, count(*) OVER () AS n FROM levels WHERE n = 1),
tops AS (
  SELECT 0 AS level, q AS pos, subroot AS digest, n FROM subroots
  UNION ALL SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, n, pos // 3),
kept AS MATERIALIZED (SELECT * FROM levels), top AS MATERIALIZED (SELECT * FROM tops),
steps AS (
  SELECT r.r, x.level, string_agg(k.digest, '' ORDER BY k.pos) FILTER (k.pos < x.pos) AS lft, string_agg(k.digest, '' ORDER BY k.pos) FILTER (k.pos > x.pos) AS rgt
  FROM ranked r, LATERAL (SELECT i AS level, r.p // CAST(3 ** i AS BIGINT) AS pos FROM range(0, 40) t(i)) x
  JOIN kept k ON k.source IS NOT DISTINCT FROM r.source AND k.level = x.level AND k.pos // 3 = x.pos // 3 AND k.n > 1
  GROUP BY r.r, x.level
  UNION ALL
  SELECT r.r, 100 + x.level, string_agg(k.digest, '' ORDER BY k.pos) FILTER (k.pos < x.pos), string_agg(k.digest, '' ORDER BY k.pos) FILTER (k.pos > x.pos)
  FROM ranked r JOIN subroots s ON r.source IS NOT DISTINCT FROM s.source,
    LATERAL (SELECT i AS level, s.q // CAST(3 ** i AS BIGINT) AS pos FROM range(0, 40) t(i)) x
  JOIN top k ON k.level = x.level AND k.pos // 3 = x.pos // 3 AND k.n > 1
  GROUP BY r.r, x.level),
paths AS (SELECT r, string_agg(coalesce(lft, '') || coalesce(rgt, ''), '' ORDER BY level) AS siblings, list({'l': coalesce(lft, ''), 'r': coalesce(rgt, '')} ORDER BY level) AS path
  FROM steps GROUP BY r),
folds AS (
  SELECT r, coalesce(shown, leaf) AS h, 1 AS i FROM ranked
  UNION ALL SELECT folds.r, sha256(path[i].l || h || path[i].r), i + 1 FROM folds JOIN paths USING (r) WHERE i <= len(path)),
ends AS (SELECT r, arg_max(h, i) AS folded_root FROM folds GROUP BY r)
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = t.digest AS verified
FROM ranked JOIN subroots s ON ranked.source IS NOT DISTINCT FROM s.source JOIN ends USING (r) LEFT JOIN paths USING (r), (SELECT digest FROM top WHERE n = 1) t
"""


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return retrieval.search(retrieval.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=50)


OP12_SQL = r"""
WITH lower_case AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents, lower_case WHERE text IS NOT NULL),
size AS (SELECT count(*)::BIGINT AS big_n, sum(len(ts))::BIGINT AS big_l FROM d WHERE len(ts) > 0),
tf AS MATERIALIZED (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
q AS (SELECT row_number() OVER () AS qid, item_id,
  list_distinct(regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts FROM benchmark, lower_case WHERE text IS NOT NULL),
qt AS (SELECT qid, item_id, unnest(ts) AS term FROM q),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, size),
norm AS (SELECT r, doc_id, 50 + (50 * len(ts)::BIGINT * big_n) // big_l AS m FROM d, size WHERE len(ts) > 0),
scored AS (
  SELECT qid, item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM qt JOIN tf USING (term) JOIN w USING (term) JOIN norm USING (r) GROUP BY qid, item_id, doc_id, r)
SELECT item_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS "rank", doc_id, score
FROM scored WHERE score > 0 QUALIFY "rank" <= 50
"""


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every whole document, against references from all documents of its language."""
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_JS = """sqrt(greatest(0, list_sum([CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END
    + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END
    for z in [[{p}[i], {q}[i]] for i in range(1, len({p}) + 1)]]) / 2))"""
OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
s0 AS (SELECT *, regexp_replace(t, '[a-z]+', '', 'g') AS t1 FROM d),
s1 AS (SELECT *, regexp_replace(t1, '[\x20\x09-\x0D]+', '', 'g') AS t2 FROM s0),
s2 AS (SELECT *, regexp_replace(t2, '[A-Z]+', '', 'g') AS t3 FROM s1),
s3 AS (SELECT *, regexp_replace(t3, '[0-9]+', '', 'g') AS t4 FROM s2),
s4 AS (SELECT *, regexp_replace(t4, '[.,;:!?''"()\-]+', '', 'g') AS t5 FROM s3),
s5 AS (SELECT *, regexp_replace(t5, '[\x00-\x7F]+', '', 'g') AS t6 FROM s4),
feat AS MATERIALIZED (
  SELECT r, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, regexp_extract_all(lower(t), '\p{{L}}+') AS lw,
    length(t1) - length(t2) AS white, length(t5) - length(translate(t5, '#*$%&|<>', '')) AS n_symbols,
    [length(t) - length(t1), length(t1) - length(t2), length(t2) - length(t3), length(t3) - length(t4), length(t4) - length(t5),
     length(t5) - length(t6), length(t6)] AS k,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM s5),
counted AS MATERIALIZED (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(lw) AS word FROM feat) GROUP BY lang, word),
sizes AS (SELECT lang, sum(n) AS words FROM counted GROUP BY lang),
own AS (SELECT lang FROM sizes WHERE lang IS NOT NULL AND words >= 0.001 * (SELECT sum(words) FROM sizes)),
pool AS (SELECT lang, word, n FROM counted WHERE lang IN (SELECT lang FROM own)
         UNION ALL SELECT NULL, word, sum(n) FROM counted GROUP BY word),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS i FROM pool QUALIFY i <= 32),
tops AS (SELECT lang, list(word ORDER BY i) AS common, list(n ORDER BY i) AS ns FROM best GROUP BY lang),
total AS (SELECT lang, words FROM sizes WHERE lang IS NOT NULL UNION ALL SELECT NULL, sum(words) FROM sizes),
ksum AS (SELECT lang, list(s ORDER BY i) AS ks FROM (
  SELECT lang, i, sum(k[i]) AS s FROM feat, range(1, 8) g(i) WHERE lang IS NOT NULL GROUP BY lang, i
  UNION ALL SELECT NULL, i, sum(k[i]) FROM feat, range(1, 8) g(i) GROUP BY i) GROUP BY lang),
refs AS (
  SELECT tops.lang, common, [n::DOUBLE / words for n in list_append(ns, words - list_sum(ns))] AS wq,
    [x::DOUBLE / list_sum(ks) for x in ks] AS kq
  FROM tops JOIN total ON tops.lang IS NOT DISTINCT FROM total.lang JOIN ksum ON tops.lang IS NOT DISTINCT FROM ksum.lang),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM feat WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, sum(least(5, i - coalesce(before, -5))) AS n FROM (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM twice) GROUP BY r),
hist AS (
  SELECT feat.r, common, wq, kq, len(lw) AS m, [x::DOUBLE / nullif(length(t), 0) for x in k] AS kp,
    lw
  FROM feat JOIN refs ON refs.lang IS NOT DISTINCT FROM (CASE WHEN feat.lang IN (SELECT lang FROM own) THEN feat.lang END) WHERE len(lw) >= 30),
hits AS (SELECT r, i, count(*) AS n FROM (SELECT r, list_position(common, unnest(lw)) AS i FROM hist) WHERE i > 0 GROUP BY r, i),
hitsum AS (SELECT hist.r, list(coalesce(n, 0)::DOUBLE ORDER BY g.i) AS found
  FROM hist JOIN range(1, 33) g(i) ON g.i <= len(common) LEFT JOIN hits ON hits.r = hist.r AND hits.i = g.i GROUP BY hist.r),
shares AS (SELECT hist.*, [x / m for x in list_append(found, m - list_sum(found))] AS wp FROM hist JOIN hitsum USING (r)),
verdict AS (SELECT r, {_JS.format(p="kp", q="kq")} > 0.15 + 1.0 / sqrt(m) OR {_JS.format(p="wp", q="wq")} > 0.22 + 1.9 / sqrt(m) AS departs FROM shares),
base AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_words, (length(t) - white)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM feat LEFT JOIN covered USING (r)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(departs, false) AS kept
FROM failed LEFT JOIN verdict USING (r)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_sharding": op2_sharding,
    "op3_ngram_scores": op3_ngram_scores,
    "op4_decontamination": op4_decontamination,
    "op5_top_k": op5_top_k,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_repeats": op10_repeats,
    "op11_manifest": op11_manifest,
    "op12_search": op12_search,
    "op13_quality_rules": op13_quality_rules,
}
ORACLES: dict[str, str] = {"op5_top_k": OP5_SQL, "op6_warc_fixity": OP6_SQL, "op11_manifest": OP11_SQL, "op12_search": OP12_SQL, "op13_quality_rules": OP13_SQL}
