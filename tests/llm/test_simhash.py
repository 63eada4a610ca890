"""SimHash near-duplicates against all pairs."""

from __future__ import annotations

import numpy as np
import xxhash

from gapwright.llm import simhash
from gapwright.llm.components import components
from gapwright.llm.queries import op7_simhash
from tests.llm.helpers import SF, documents, frame, odd_rows, small_letters, words


def fingerprint(text):
    w = words(small_letters(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints, ids, radius=3):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    labels = np.asarray(ids)
    while True:
        after = np.array([labels[row].min() for row in near])
        if (after == labels).all():
            return labels
        labels = after


def test_query_equals_brute_force(spark):
    found = {r.doc_id: r for r in op7_simhash(spark, SF).collect()}
    rows = documents(spark).orderBy("doc_id").collect()
    prints = np.array([fingerprint(r.text) for r in rows], np.uint64)
    labels = smallest_reachable(prints, [r.doc_id for r in rows])
    for r, value, label in zip(rows, prints.tolist(), labels.tolist()):
        assert (found[r.doc_id].fingerprint, found[r.doc_id].component_id) == (f"{value:016x}", label)


def chains(seed=1, n=250):
    rng = np.random.default_rng(seed)
    points = []
    for x in rng.integers(0, 2**64, n, dtype=np.uint64).tolist():
        for _ in range(rng.integers(1, 8)):
            points.append(x)
            for _ in range(rng.integers(0, 5)):
                x ^= 1 << int(rng.integers(64))
    return np.unique(np.array(points, np.uint64))


def test_links_join_what_all_pairs_join(spark):
    points = chains()
    signed = points.view(np.int64)
    table = spark.createDataFrame([(int(v),) for v in signed], "fingerprint long")
    roots = {r.node: r.root for r in components(simhash.close_links(table, 3)).collect()}
    assert [roots.get(int(v), int(v)) for v in signed] == smallest_reachable(points, signed).tolist()


def test_second_vantage_point_loses_no_pair(monkeypatch):
    points = chains(2)
    near = {*map(tuple, np.argwhere(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3).tolist())}
    monkeypatch.setattr(simhash, "LARGE", 10)
    monkeypatch.setattr(simhash, "PAIRS", 50)
    found = set()
    for i, j in simhash.close_pairs(points, points, 3, int(points[5])):
        found |= {*zip(i.tolist(), j.tolist())}
    assert found == near


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows()
    found = simhash.near_duplicates(frame(spark, rows, clash=True)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[0].fingerprint == by_id[1].fingerprint == by_id[2].fingerprint == 0
    assert by_id[20].component_id == 5 and by_id[5].component_id == 5
    assert {r.component_id for r in found if r.doc_id is None} == {0, 5}
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    kept = simhash.drop_near_duplicates(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({r.component_id for r in found})
    assert 20 not in ids and ids.count(5) == 1 and ids.count(None) == 0 and 1 not in ids and 0 in ids


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    a, b = "the end of the story is near the end of the story", "quite another tale that no other row of this table tells"
    rows = [(3, a, None, None, None), (5, a, None, None, None), (5, b, None, None, None), (5, None, None, None, None), (None, b, None, None, None)]
    for df in (frame(spark, rows), frame(spark, rows, clash=True)):
        kept = simhash.drop_near_duplicates(df)
        assert kept.columns == df.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, a), (5, b), (5, None)], key=str)


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    a, b = "the end of the story is near the end of the story", "quite another tale that no other row of this table tells"
    rows = [(i, a, "en", "s", n) for n, i in enumerate([1, 1, None, None, 7])] + [(None, b, None, None, n) for n in range(3)]
    for df in (frame(spark, rows), frame(spark, rows, clash=True)):
        kept = simhash.drop_near_duplicates(df).collect()
        assert sorted(((r.doc_id, r.text, r.lang) for r in kept), key=str) == sorted([(1, a, "en"), (None, b, None)], key=str)
        assert {(r.doc_id, r.n_chars) for r in kept} <= {(i, n) for i, _, _, _, n in rows}
