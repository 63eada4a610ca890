"""SpotSigs against SQL, all pairs, and by hand."""

from __future__ import annotations

import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from gapwright.llm import spots
from gapwright.llm.oracle import ORACLE
from gapwright.llm.queries import op6_spots
from tests.llm.helpers import SF, documents, frame, odd_rows


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.execute(ORACLE["op6_spots"])
    names = [d[0] for d in cursor.description]
    expected = {r[0]: dict(zip(names, r)) for r in cursor.fetchall()}
    assert {r.doc_id: r.asDict() for r in op6_spots(spark, SF).collect()} == expected


def short(*strings):
    return sorted({hashlib.md5(s.encode()).hexdigest()[:8] for s in strings})


def test_signatures_by_hand(spark):
    texts = {
        "Start words, the old house of my friend is red.": short("start", "words", "the old house", "of my friend", "is red"),
        "the one two three four five": short("the one two three", "four", "five"),
        "THE of AND": short("the", "of", "and"),
        "": [],
    }
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    found = {r.doc_id: list(r.signatures) for r in spots.fingerprints(frame(spark, rows)).collect()}
    assert [found[i] for i in range(len(texts))] == [*texts.values()]


def test_the_next_document_over_range_borders(spark, monkeypatch):
    monkeypatch.setattr(spots, "ROWS_A_RANGE", 3)
    ids = [5, 6, 7, 8, 9, 10, 500, 501, 9000, -40]
    rows = [(i, f"text of {i}", None, None, None) for i in ids]
    found = {r.doc_id: r.next_text for r in spots.with_next(frame(spark, rows)).collect()}
    order = sorted(ids)
    assert found == {a: f"text of {b}" for a, b in zip(order, [*order[1:], order[0]])}
    (alone,) = spots.with_next(frame(spark, rows[:1])).collect()
    assert alone.next_text == alone.text


def test_edited_texts(spark):
    pairs = [("abcdef", "xyz123"), ("abcde", "x"), ("", "xyz"), ("a", "xyz"), ("é😀ß", "12")]
    table = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in table.select(spots.edited(F.col("a"), F.col("b"))).collect()]
    assert got == [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in pairs]


def test_near_duplicates_equal_all_pairs(spark):
    docs = documents(spark)
    members, links = spots.near_duplicates(docs)
    of = {r.doc_id: r.class_id for r in members.collect()}
    sets = {r.doc_id: {*r.signatures} for r in spots.fingerprints(docs).collect()}
    names = sorted({*of.values()})
    expected = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {(r.class_a, r.class_b) for r in links.collect()} == expected
    assert all(sets[d] == sets[c] for d, c in of.items())


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows()
    found = spots.with_next(frame(spark, rows, clash=True)).collect()
    assert len(found) == len(rows)
    assert len({tuple(r.signatures) for r in found if r.doc_id == 5}) == 1
    assert spots.with_next(frame(spark, [])).collect() == []
    members, links = spots.near_duplicates(frame(spark, []))
    assert members.collect() == [] and links.collect() == []


def test_main_path_has_no_python(spark):
    assert not re.search("Python|Pandas|Arrow", op6_spots(spark, SF)._jdf.queryExecution().executedPlan().toString())
