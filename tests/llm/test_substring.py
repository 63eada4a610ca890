"""Substring dedup against brute force over all windows."""

from __future__ import annotations

import random

from gapwright.llm import substring
from tests.llm.helpers import documents, frame, odd_rows, words


def brute(rows, k):
    texts = {i: words(t) for i, t in rows}
    first = {}
    for i in sorted(texts):
        w = texts[i]
        for p in range(len(w) - k + 1):
            first.setdefault(tuple(w[p : p + k]), i)
    out = {}
    for i, w in texts.items():
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < i:
                gone[p : p + k] = [True] * k
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def check(docs, k):
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], k)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs, k).collect()} == expected


def test_documents_equal_brute_force(spark):
    check(documents(spark), 13)


def test_overlapping_passages_equal_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("ab") for _ in range(60)) for _ in range(10)]
    base += [" ".join(rng.choice([f"w{i}" for i in range(300)]) for _ in range(150)) for _ in range(10)]
    rows = []
    for i in range(120):
        a, b = rng.choice(base).split(), rng.choice(base).split()
        rows.append((i * 7 % 1000, " ".join(a[rng.randrange(len(a)) :] + b[: rng.randrange(len(b))])))
    # runs of one word that are longer than a segment can be
    rows += [(5002, "x " * 2500), (5003, "x " * 3100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k in (3, 13):
        check(docs, k)


def test_a_passage_in_many_documents_stays_in_the_first(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"begin{i} {passage} end{i}") for i in range(300)]
    found = {r.doc_id: r for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0].n_removed == 0
    assert all(found[i].kept == f"begin{i} end{i}" for i in range(1, 300))


def test_odd_rows_and_empty_table(spark):
    text = " ".join(map(str, range(40)))
    rows = [*odd_rows(), (30, text, None, None, None), (31, text, None, None, None), (31, text, None, None, None), (None, text, None, None, None), (31, "other " + text, None, None, None)]
    found = substring.remove_repeats(frame(spark, rows, clash=True)).collect()
    assert len(found) == len(rows)
    assert sorted(r.n_removed for r in found if r.doc_id == 31) == [40, 40, 40]
    assert [r.n_removed for r in found if r.doc_id in (None, 30)] == [0, 0, 0, 0]
    assert substring.remove_repeats(frame(spark, [])).collect() == []
    rewritten = substring.rewrite(frame(spark, rows, clash=True))
    assert rewritten.columns == frame(spark, [], clash=True).columns
    texts = sorted((str(r.doc_id), r.text or "") for r in rewritten.collect())
    assert texts == sorted((str(r[0]), {(31, text): "", (31, "other " + text): "other"}.get((r[0], r[1]), r[1]) or "") for r in rows)
