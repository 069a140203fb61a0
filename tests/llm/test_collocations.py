"""Phrase mining against counting every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from cellpulse.llm import collocations

SCHEMA = "doc_id long, text string, lang string"


def expected(rows: list[tuple], least: int = 30, top: int = 2000) -> set[tuple]:
    grams: Counter = Counter()
    for _, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                grams.update(("und" if lang is None else lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    total, kept = Counter(), {}
    for (lang, *p), n in grams.items():
        total[lang] += n * (len(p) == 1)
    frequent = {g: n for g, n in grams.items() if n >= least and len(g) > 2}
    for (lang, *p), a in frequent.items():
        around = [n for (k, *q), n in frequent.items() if k == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * n >= 80 * a for n in around):
            continue
        cuts = [(grams[(lang, *p[:k])], grams[(lang, *p[k:])], k) for k in range(1, len(p))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for l, r, k in cuts)
        kept.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {
        (lang, rank, p.decode(), -a, l, r, total[lang], -score)
        for lang, some in kept.items() for rank, (score, a, p, l, r) in enumerate(sorted(some)[:top], 1)
    }


def texts(seed: int, n: int) -> list[tuple]:
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["Über", "été", "x-y", "\x00", "a\x85b", "　"]
    fixed = ["new york city hall", "strong tea", "w1 w2 w3"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(chance.randint(0, 60)):
            parts.append(chance.choice(fixed) if chance.random() < 0.2 else chance.choice(vocabulary))
            parts.append(chance.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "; A"]))
        rows.append((i, "".join(parts), chance.choice(["en", "EN", "", None, "und"])))
    return rows


@pytest.mark.parametrize("seed, least, hot", [(1, 30, 1 << 17), (2, 8, 40), (3, 4, 5)])
def test_phrases_equal_counting(table, seed, least, hot):
    rows = texts(seed, 220)
    made = collocations.ranked(table(rows, SCHEMA, files=5), least=least, hot=hot)
    assert made.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in made.collect()]
    assert len(found) == len(set(found)) and set(found) == expected(rows, least)
    assert found


def test_small_blocks_and_few_phrases(table, monkeypatch):
    """Counts of many blocks add up; ties with the last phrase are cut by spelling."""
    rows = [(i, f"tie{i % 40:02d} two. {i} {i} one two three", "en") for i in range(400)]
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
    made = {tuple(r) for r in collocations.ranked(table(rows, SCHEMA, files=4), top=7, least=9).collect()}
    assert made == expected(rows, 9, 7)


def test_quicksort_equals_counting():
    chance = np.random.default_rng(4)
    rows = chance.integers(0, 4, (4, 3000)) * (1 << 33) + 0
    rows[2:, chance.random(3000) < 0.2] = 0
    rows[3, rows[2] == 0] = 0
    rows = rows[:, (rows[0] > 0) & (rows[1] > 0)]
    weights = chance.integers(1, 5, rows.shape[1])
    counts: Counter = Counter()
    for row, n in zip(rows.T.tolist(), weights.tolist()):
        for k in range(2, 5):
            if not row[k - 1]:
                break
            counts[tuple(row[:k])] += n
    made = list(collocations.frequent(rows, weights, 60))
    assert dict(made) == {p: n for p, n in counts.items() if n >= 60} and len(dict(made)) == len(made)


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**13

    class Found:
        words = spark.createDataFrame([(1, "en", "a", big + 1), (2, "en", "b", big)], "id long, lang string, word string, n long")
        phrases = spark.createDataFrame([(1, 2, 0, 0, big)], "w1 long, w2 long, w3 long, w4 long, a long")

    assert [r.score for r in collocations.scored(Found).collect()] == [2_000_000 * big // (2 * big + 1)]


def test_hard_rows_and_an_empty_table(table, hard):
    from pyspark.sql import functions as F

    rows = [(r.doc_id, r.text, None) for r in hard.collect()]
    made = {tuple(r) for r in collocations.ranked(hard.withColumn("lang", F.lit(None).cast("string")).withColumn("a", F.lit(1))).collect()}
    assert made == expected(rows)
    assert collocations.ranked(table([], SCHEMA)).count() == 0
    assert collocations.ranked(table([(1, None, None), (2, " . ", "en")], SCHEMA)).count() == 0
