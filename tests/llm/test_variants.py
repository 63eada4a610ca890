"""Near words by the bit-sliced index against plain comparison of all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from gapwright.llm import variants
from gapwright.llm.queries import op13_variants
from tests.llm.helpers import SF, documents, frame, odd_rows, small_letters


def counted(rows, every=199, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = small_letters(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute(counts):
    by_length: dict = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    form, number = {}, {}
    for w in counts:
        found = [v for m in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(m, []) if v != w and near(w, v)]
        number[w] = len(found)
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], number[w], counts[form[w]] if form[w] else None))
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def vocabulary(seed, n=600, letters="abé"):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randrange(6, 12))): rng.choice([5, 6, 30, 200, 7000, 10**6]) for _ in range(n)}


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abé"), (3, "abcdefghÿ")])
def test_all_pairs(spark, seed, letters):
    counts = vocabulary(seed, letters=letters)
    df = spark.createDataFrame([*counts.items()], "word string, n long")
    assert found(variants.forms(df)) == brute(counts)


@pytest.mark.parametrize("part,block", [(8, 4), (1, 3), (100_000, 2), (100_000, 100_000)])
def test_parts_and_blocks_change_nothing(spark, part, block):
    counts = vocabulary(4, n=300, letters="ab")
    df = spark.createDataFrame([*counts.items()], "word string, n long")
    assert found(variants.forms(df, part=part, block=block)) == brute(counts)


def test_blocks_are_used_and_bounded(spark):
    counts = {f"samefront{a}{b}": 5 for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"}
    df = spark.createDataFrame([*counts.items()], "word string, n long")
    dealt = variants.parts(df, 16, 25)
    sizes = dealt.where("split").groupBy("k", "back", "part", "one", "two").count().collect()
    assert len(sizes) > 50 and max(r["count"] for r in sizes) <= 3 * 25
    assert found(variants.forms(df, part=16, block=25)) == brute(counts)


def test_long_chains(spark):
    counts = {"aaaaaa" + "b" * i: 5 ** (i + 1) for i in range(12)}
    df = spark.createDataFrame([*counts.items()], "word string, n long")
    assert found(variants.forms(df)) == brute(counts)
    assert {r.root for r in variants.forms(df).collect()} == {"aaaaaa" + "b" * 11}


def test_index_of_long_words():
    words = ["x" * 3000, "x" * 2999, "x" * 1500 + "y" + "x" * 1499, "y" * 3000]
    lengths = np.array([len(w) for w in words])
    letters = np.array([[ord(c) - 120 for c in w.ljust(3000, "w")] for w in words])
    index = variants.Index(letters, lengths)
    hits = sorted((int(a), int(b)) for m in (2999, 3000) for a, b in zip(*index.near(np.flatnonzero(lengths == m))))
    assert hits == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    rows = odd_rows() + [(50 + i, "Straße naïvely Naïvely naively ÀÉÎÕÜ×÷ÿ x" * 3, None, None, None) for i in range(9)] + [(None, "naively " * 80, None, None, None)]
    expected = brute(counted([r[:2] for r in rows]))
    assert expected and found(variants.forms(variants.word_counts(frame(spark, rows, clash)))) == expected


def test_deletions(spark):
    """With a small divisor most runs lose a letter; a deletion may make another word's run."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abc", k=rng.randrange(5, 9))) for _ in range(80)]
    rows = [(i, " ".join(rng.choices(words, k=60)), None, None, None) for i in range(60)]
    expected = counted([r[:2] for r in rows], every=3)
    assert {r.word: r.n for r in variants.word_counts(frame(spark, rows), every=3).collect()} == expected


def test_no_rows(spark):
    assert variants.forms(variants.word_counts(frame(spark, []))).collect() == []


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert found(op13_variants(spark, SF)) == brute(counted(rows))
