"""Borders against all choices; batches hold every word once."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np

from gapwright.llm import packing
from gapwright.llm.queries import op3_packing
from tests.llm.helpers import SF, documents, frame, odd_rows, words


def padding(borders, lengths, counts):
    return sum(c * (min(b for b in borders if b >= n) - n) for n, c in zip(lengths, counts))


def test_borders_are_the_best_of_all():
    rng = random.Random(1)
    for _ in range(150):
        m = rng.randint(1, 8)
        lengths, counts, k = rng.sample(range(1, 40), m), [rng.randint(1, 9) for _ in range(m)], rng.randint(1, 5)
        found = packing.optimal_borders(np.array(lengths), np.array(counts), k)
        every = [s for n in range(1, min(k, m) + 1) for s in itertools.combinations(sorted(lengths), n) if max(lengths) in s]
        assert len(found) <= k and padding(found, lengths, counts) == min(padding(s, lengths, counts) for s in every)
    assert packing.optimal_borders(np.zeros(0), np.zeros(0), 4) == []


def check(rows, texts, longest, budget):
    batches, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        covered[r.doc_id].append((r.start, r.n_tokens))
        if r.n_tokens:
            batches[r.batch].append(r)
            assert r.n_tokens <= r.pad_to
    for i, text in texts.items():
        at = 0
        for start, n in sorted(covered[i]):
            assert start == at and n <= longest
            at += n
        assert at == len(words(text))
    short = defaultdict(int)
    for members in batches.values():
        (pad,) = {r.pad_to for r in members}
        holds = max(1, budget // pad)
        assert sorted(r.slot for r in members) == [*range(len(members))] and len(members) <= holds
        short[pad] += len(members) < holds
    assert sorted(batches) == [*range(len(batches))] and max(short.values(), default=0) <= 1


def test_query_packs_every_word_once(spark, monkeypatch):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    check(op3_packing(spark, SF).collect(), texts, 2048, 65_536)
    monkeypatch.setattr(packing, "ROWS_A_SHARD", 20)
    check(packing.pack(documents(spark), longest=100, buckets=5, budget=512).collect(), texts, 100, 512)


def test_the_query_pads_least(spark):
    rows = [r for r in op3_packing(spark, SF).collect() if r.n_tokens]
    lengths, counts = np.unique([r.n_tokens for r in rows], return_counts=True)
    assert sum(r.pad_to - r.n_tokens for r in rows) == padding(packing.optimal_borders(lengths, counts, 16), lengths, counts)


def test_pieces_carry_their_text(spark):
    rows = [(1, " a b  c\nd e ", None, None, None), (2, "x", None, None, None)]
    found = packing.pack(frame(spark, rows), longest=2, with_text=True).collect()
    assert sorted((r.doc_id, r.piece, r.text) for r in found) == [(1, 0, "a b"), (1, 1, "c d"), (1, 2, "e"), (2, 0, "x")]


def test_many_equal_rows_fill_batches_like_others(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_A_SHARD", 20)
    monkeypatch.setattr(packing, "COPIES_AT_ONCE", 7)
    rows = [(None, "a b c d e", None, None, None)] * 90 + [(5, "x y", None, None, None)] * 3 + [(i, "z " * (i % 9), None, None, None) for i in range(90)] + [(None, " ", None, None, None)] * 40
    found = packing.pack(frame(spark, rows), longest=4, buckets=3, budget=16, with_text=True).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((i, " ".join(words(t)[at : at + 4])) for i, t, *_ in rows for at in range(0, max(1, len(words(t))), 4))
    batches = defaultdict(list)
    for r in found:
        if r.n_tokens:
            batches[r.batch, r.pad_to].append(r.slot)
            assert r.n_tokens == len(words(r.text)) <= r.pad_to
    short = Counter(pad for (_, pad), slots in batches.items() if len(slots) < 16 // pad)
    assert all(sorted(slots) == [*range(len(slots))] for slots in batches.values()) and max(short.values(), default=0) <= 1
    assert sorted(b for b, _ in batches) == [*range(len(batches))]


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows(300)
    found = packing.pack(frame(spark, rows, clash=True), longest=128).collect()
    assert sum(r.n_tokens for r in found) == sum(len(words(r[1])) for r in rows)
    blank = [r for r in found if r.n_tokens == 0]
    assert {r.doc_id for r in blank} == {0, 1, 2, None} and all(r.bucket is None and r.batch is None for r in blank)
    assert len({(r.batch, r.slot) for r in found if r.n_tokens}) == len(found) - len(blank)
    assert packing.pack(frame(spark, [])).collect() == []
    assert all(r.batch is None for r in packing.pack(frame(spark, rows[:3])).collect())
