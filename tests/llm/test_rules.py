"""Quality rules against plain Python, and the cases where a text departs from its language."""

import collections
import math
import random
import re

import pytest

from seriesloom.llm import rules

SCHEMA = "doc_id long, text string, lang string, id string, words string, common string, ref_lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed, the plain way."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def of_language(rng, common, n):
    rare = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(40)]
    return " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(n))


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, lang, "x", None, "", "en") for i, t, lang in texts], SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_counts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    pieces = ["a", "b", "é", "中", "#", "a&b", "\n", "\n", "\t", "  ", "\r\n", "\x0b", " ", "a b c d e ", "one two\n", "\U0001f600"]
    texts = [None, "", " \n\t", "one", "a b c d e a b c d e", "w " * 9, "w " * 10, " ".join(map(str, range(3000))) + " " + " ".join(map(str, range(1000)))]
    texts += ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    rows = [(None if i == 3 else i // 2, t, rng.choice([None, "en", "xx"])) for i, t in enumerate(texts)]
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = collections.Counter((r.doc_id, *(r[c] for c in columns)) for r in rules.judge(rows_of(spark, rows)).collect())
    expected = collections.Counter((i, *counts(t)) for i, t, _ in rows)
    assert (got - expected, expected - got) == ({}, {})


def test_departing_texts_go_and_others_stay(spark):
    rng = random.Random(1)
    common = {"en": ["the", "of", "and", "to"], "de": ["der", "und", "die", "von"]}
    texts = [(i, of_language(rng, common[lang], 150), lang) for i, lang in enumerate(["en", "de"] * 60)]
    symbols = " ".join(w + "$$$" for w in of_language(rng, common["en"], 200).split())
    odd = [(1000, symbols, "en"), (1001, of_language(rng, common["de"], 200), "en"), (1002, of_language(rng, ["zu"], 14), "en"), (1003, symbols[:60], "en")]
    out = {r.doc_id: r for r in rules.judge(rows_of(spark, texts + odd)).collect()}
    assert all(out[i].kept for i, _, _ in texts)
    assert not out[1000].kept and out[1000].class_distance > out[1000].class_limit
    assert not out[1001].kept and out[1001].word_distance > out[1001].word_limit
    assert out[1002].class_distance is None and out[1002].kept  # too short to be judged
    assert not out[1003].kept and out[1003].base_failed


def test_distance_of_a_text_equals_the_formula(spark):
    rng = random.Random(2)
    rows = [(i, of_language(rng, ["the", "of", "and"], 40 + i), "en") for i in range(12)] + [(99, "Of the, the (AND) of: 12 the " * 12, None)]
    out = {r.doc_id: r for r in rules.judge(rows_of(spark, rows)).collect()}
    patterns = list(rules.CLASSES.values())

    def classes(text):
        found = []
        for p in patterns:
            shorter = re.sub(p, "", text)
            found.append(len(text) - len(shorter))
            text = shorter
        return found + [len(text)]

    def js(p, q):
        kl = sum(a * math.log2(2 * a / (a + b)) for a, b in zip(p, q) if a) + sum(b * math.log2(2 * b / (a + b)) for a, b in zip(p, q) if b)
        return math.sqrt(max(0, kl / 2))

    def shares(xs):
        return [x / sum(xs) for x in xs]

    for i, text, lang in rows:
        same = [t for _, t, other in rows if lang is None or other == lang]
        whole = [sum(c) for c in zip(*map(classes, same))]
        assert out[i].class_distance == pytest.approx(js(shares(classes(text)), shares(whole)), abs=1e-9)
        words = collections.Counter(w for t in same for w in re.findall(r"[a-z]+", t.lower()))
        top = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[: rules.COMMON]]
        own = collections.Counter(re.findall(r"[a-z]+", text.lower()))
        hist = lambda c: shares([c[w] for w in top] + [sum(c.values()) - sum(c[w] for w in top)])
        assert out[i].word_distance == pytest.approx(js(hist(own), hist(words)), abs=1e-9)


def test_empty_table_and_texts_without_words(spark):
    assert rules.judge(rows_of(spark, [])).collect() == []
    out = rules.judge(rows_of(spark, [(1, "", "en"), (1, None, None), (2, "12 34 !!", "en")])).collect()
    assert len(out) == 3 and not any(r.kept for r in out)
