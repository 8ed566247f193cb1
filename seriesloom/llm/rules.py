"""Quality rules in SQL functions: counts of a text, and how far its histograms lie from its language's.

Two histograms are taken of each text: characters by class (``CLASSES`` and the
rest) and the ``COMMON`` most frequent words of its language, other words
together. The references are the same histograms over all documents of that
language. A text departs if the Jensen-Shannon distance (square root of the
divergence in bits, 0 to 1) to either reference exceeds a base value plus an
allowance for sampling noise that shrinks with the square root of the text's
length; texts of fewer than ``MIN_WORDS`` letter words are not judged by it.

Counts follow white space (space and ``\\x09`` to ``\\x0D``); histogram words are
runs of letters, in lower case. Repeated five-word windows are looked for by
hash first, and only texts with equal hashes compare the words themselves.

Texts never leave their row and are not shuffled: one pass sums the references,
one judges. Languages that hold at least ``MIN_SHARE`` of all words have their
own reference, all others, and the null language, the one of all documents, so
at most 1 / ``MIN_SHARE`` + 1 references are broadcast.

Defined cases: a null text counts as empty; an empty text has zero counts and fails
the base rules; null ids and repeated rows keep their rows; equally frequent
words come in code point order; an empty table gives no rows; further columns
of the input are not read, and none of its names clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesloom.llm.common import text_of
from seriesloom.session import stage

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Taken off one after the other; what is left at last is the class of all other characters.
CLASSES = {"lower": r"[a-z]+", "white": SPACE + "+", "upper": r"[A-Z]+", "digit": r"[0-9]+", "mark": r"[.,;:!?'\"()\-]+", "ascii": r"[\x00-\x7F]+"}
COMMON, MIN_SHARE, MIN_WORDS = 32, 0.001, 30
CLASS_LIMIT, WORD_LIMIT = (0.15, 1.0), (0.22, 1.9)
RUN = 5
#: A letter for every place among the common words; none for place 0.
MARKS = ["", *string.ascii_letters[:COMMON]]


def _letters(text: Column) -> Column:
    """Lower-case words of letters, two spaces apart."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", "  "))


def _class_counts(df: DataFrame) -> DataFrame:
    """Adds ``classes``: characters of each class; and what is left once letters, digits and marks are gone."""
    left = "text"
    for name, pattern in CLASSES.items():
        df = df.withColumn(f"no_{name}", F.regexp_replace(left, pattern, ""))
        left = f"no_{name}"
    steps = ["text", *(f"no_{name}" for name in CLASSES)]
    counts = [F.length(a) - F.length(b) for a, b in zip(steps, steps[1:])] + [F.length(steps[-1])]
    return df.withColumn("classes", F.array(*(c.cast("long") for c in counts)))


def references(texts: DataFrame) -> DataFrame:
    """lang, common (words), word_share and class_share, from (lang, text); lang null is the reference of all."""
    words = texts.select("lang", F.explode(F.split(_letters(F.col("text")), "  ")).alias("word")).where("word <> ''")
    counted = stage(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    chars = _class_counts(texts).groupBy("lang").agg(F.array(*(F.sum(F.col("classes")[i]) for i in range(len(CLASSES) + 1))).alias("classes"))
    chars = stage(chars, "class-counts")
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("words"))
    total = sizes.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    own = sizes.where(F.col("lang").isNotNull() & (F.col("words") >= MIN_SHARE * total)).select("lang")

    everything = F.lit(None).cast("string").alias("lang")
    ranked = counted.join(F.broadcast(own), "lang", "left_semi").unionAll(counted.groupBy("word").agg(F.sum("n").alias("n")).select(everything, "word", "n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    best = ranked.withColumn("r", F.row_number().over(order)).where(F.col("r") <= COMMON)
    listed = best.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("r", "word", "n"))).alias("top"))
    totals = sizes.where("lang IS NOT NULL").unionAll(sizes.groupBy().agg(F.sum("words").alias("words")).select(everything, "words"))
    sums = F.array(*(F.sum(F.col("classes")[i]) for i in range(len(CLASSES) + 1))).alias("classes")
    chars = chars.where("lang IS NOT NULL").unionAll(chars.groupBy().agg(sums).select(everything, "classes"))
    joined = listed.join(totals.withColumnRenamed("lang", "l2"), F.col("lang").eqNullSafe(F.col("l2"))).join(chars.withColumnRenamed("lang", "l3"), F.col("lang").eqNullSafe(F.col("l3")))
    return joined.select("lang", F.col("top.word").alias("common"), _shares(F.col("top.n"), F.col("words")).alias("word_share"), _of_total(F.col("classes")).alias("class_share"))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def _of_total(counts: Column) -> Column:
    return F.transform(counts, lambda x: x.cast("double") / _total(counts))


def _shares(counts: Column, total: Column) -> Column:
    """Shares of the listed words and, at the end, of all others."""
    return F.transform(F.concat(counts, F.array(total - _total(counts))), lambda x: x.cast("double") / total)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def _hash_both(a: Column, b: Column) -> Column:
    """Hashes of pairs, as far as both arrays go (``zip_with`` fills the shorter with nulls)."""
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def _window_hashes(single: Column, pair: Column, windows: Column) -> Column:
    """Of every five words: the first two and next two by their pairs, then the fifth."""
    four = _hash_both(F.slice(pair, 1, windows), F.slice(pair, 3, windows))
    return _hash_both(four, F.slice(single, RUN, windows))


def _sorted_windows(words: Column, hashes: Column) -> Column:
    """Five-word windows with their place, in order; null where their hashes already differ."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - RUN), lambda i: F.struct(F.concat_ws(" ", F.slice(words, i + 1, RUN)).alias("w"), i.alias("at")))
    return F.when((F.size(words) > RUN) & (F.size(F.array_distinct(hashes)) < F.size(hashes)), F.array_sort(windows))


def _covered_words(order: Column) -> Column:
    """Words inside windows that equal a neighbour of theirs in ``order`` (a column of its own: lambdas look into it)."""
    near = lambda i: F.get(order, i)["w"]
    twice = F.filter(order, lambda x, i: ((i > 0) & (near(F.greatest(i - 1, F.lit(0))) == x["w"])) | near(i + 1).eqNullSafe(x["w"]))
    starts = F.array_sort(F.transform(twice, lambda x: x["at"]))
    zero = F.struct(F.lit(-RUN).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda a, s: F.struct(s.alias("last"), (a["n"] + F.least(F.lit(RUN), s - a["last"])).alias("n"))
    return F.coalesce(F.aggregate(starts, zero, step, lambda a: a["n"]), F.lit(0).cast("long"))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, the counts, base_failed, both distances (null below the length guard), their limits and kept."""
    texts = df.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
    refs = stage(references(texts.select("lang", "text")), "references")
    known = F.broadcast(refs.where("lang IS NOT NULL").withColumnRenamed("lang", "ref_lang"))
    pooled = F.broadcast(refs.where("lang IS NULL").select(F.col("common").alias("c0"), F.col("word_share").alias("w0"), F.col("class_share").alias("k0"), F.lit(1).alias("one")))
    with_ref = texts.join(known, F.col("lang") == F.col("ref_lang"), "left").withColumn("one0", F.lit(1)).join(pooled, F.col("one0") == F.col("one"), "left")
    with_ref = with_ref.select("id", "text", *(F.coalesce(a, b).alias(a) for a, b in (("common", "c0"), ("word_share", "w0"), ("class_share", "k0"))))

    words = F.col("words")
    line_with_word = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    counted = (
        _class_counts(with_ref)
        .withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
        .withColumn("lines", line_with_word)
        .withColumn("single", F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn("pair", _hash_both(F.col("single"), F.slice("single", 2, F.size(words))))
        .withColumn("hashes", F.when(F.size(words) > RUN, _window_hashes(F.col("single"), F.col("pair"), F.size(words) - RUN + 1)))
        .withColumn("order", _sorted_windows(words, F.col("hashes")))
        .withColumn("spaced", _letters(F.col("text")))
        .withColumn("letter_words", F.when(F.col("spaced") == "", F.array().cast("array<string>")).otherwise(F.split("spaced", "  ")))
        .withColumn("longest", F.array_max(F.transform("common", lambda w: F.length(w))))
        .withColumn("marks", F.array_join(F.transform("letter_words", lambda w: F.when(F.length(w) <= F.col("longest"), F.get(F.array(*map(F.lit, MARKS)), F.array_position("common", w).cast("int"))).otherwise(F.lit(""))), ""))
    )
    measured = counted.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.col("classes")[1]).cast("long").alias("word_chars"),
        (F.length("no_mark") - F.length(F.translate("no_mark", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered_words(F.col("order")).alias("n_repeat_words"),
        "classes", "word_share", "class_share", F.size("letter_words").cast("long").alias("n_letter_words"),
        F.transform("common", lambda w, i: (F.length("marks") - F.length(F.replace(F.col("marks"), F.get(F.array(*map(F.lit, MARKS)), i + 1), F.lit("")))).cast("long")).alias("found"),
    )
    long_enough = F.col("n_letter_words") >= MIN_WORDS
    limit = lambda base: F.lit(base[0]) + F.lit(base[1]) / F.sqrt("n_letter_words")
    out = measured.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.when(long_enough, distance(_of_total(F.col("classes")), F.col("class_share"))).alias("class_distance"),
        F.when(long_enough, distance(_shares(F.col("found"), F.col("n_letter_words")), F.col("word_share"))).alias("word_distance"),
        F.when(long_enough, limit(CLASS_LIMIT)).alias("class_limit"), F.when(long_enough, limit(WORD_LIMIT)).alias("word_limit"),
    )
    departs = F.coalesce((F.col("class_distance") > F.col("class_limit")) | (F.col("word_distance") > F.col("word_limit")), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~departs).withColumnRenamed("id", id_col)
