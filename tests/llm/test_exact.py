"""Golomb codes, and exact dedup against a dictionary of normal texts."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from gapwright.llm import exact
from gapwright.llm.oracle import ORACLE
from gapwright.llm.queries import op11_exact
from tests.llm.helpers import SF, frame, odd_rows


def normal(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def brute(rows):
    """(doc_id, keep_id, group_size, digest) and how many rows of a digest stay."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(normal(row[1]), []).append(row)
    out = []
    for text, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], keep[0], len(members), hashlib.sha256(text.encode()).hexdigest()) for r in members]
    return sorted(out, key=repr)


def found(df):
    got = df.collect()
    digests = [r.digest.hex() for r in got if r.kept]
    assert len(digests) == len(set(digests)) == len({r.digest for r in got})  # one row of each group stays
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in got], key=repr)


@pytest.mark.parametrize("n,span", [(0, 1 << 42), (1, 1 << 42), (1, 1), (300, 300), (5000, 1 << 42), (5000, 1 << 14), (200, 1 << 60)])
def test_codes_go_round(n, span):
    values = np.array(sorted(random.Random(n).sample(range(span), n)), np.uint64)
    code = exact.golomb(values, span)
    assert (exact.ungolomb(code, n) == values).all()
    if n >= 200:
        # near the entropy of a random set: log2(span / n) + 1.5 bits a number
        assert 8 * (len(code) - 9) <= n * (max(0, np.log2(span / n)) + 2.1) + 16


def test_owners():
    bits = [exact.owners_for(n) for n in (0, 1, 1000, 64 << 22, (64 << 22) + 1, 10**10)]
    assert bits == [6, 6, 6, 6, 7, 12]
    for n, b in zip((64 << 22, (64 << 22) + 1, 10**10), bits[3:]):
        assert n / 2**b <= exact.PER_OWNER


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    rows = odd_rows() + [(31, "one  two", "en", "s", 1), (30, " one two", "en", "s", 1), (29, "onetwo", "en", "s", 1)]
    assert found(exact.duplicates(frame(spark, rows, clash))) == brute(rows)


def test_no_rows(spark):
    assert exact.duplicates(frame(spark, [])).collect() == []


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", None)], "doc_id string, text string")
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in exact.duplicates(df).collect()) == [("a", "b", False), ("b", "b", True), ("c", "c", True)]


def test_rounds_of_files_change_nothing(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot text", f"text {rng.randrange(400)}", f"lone {i}", None]), None, None, None) for i in range(3000)]
    frame(spark, rows).repartition(7).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    expected = brute(rows)
    assert found(exact.duplicates(docs)) == expected
    assert found(exact.duplicates(docs, mark_bytes=3 * exact.MARK_SIZE)) == expected
    assert found(exact.duplicates(docs, mark_bytes=1)) == expected  # too large for any broadcast


def test_chance_meetings_are_told_apart(spark):
    """With fingerprints of 8 bits nearly all rows are suspects; the result is the same."""
    rows = [(i, f"text {i % 700}", None, None, None) for i in range(1000)]
    assert found(exact.duplicates(frame(spark, rows), size=8)) == brute(rows)


def test_only_suspects_are_verified(spark):
    rows = [(i, f"lone {i}", None, None, None) for i in range(500)] + [(900 + i, "twin", None, None, None) for i in range(5)]
    table, _ = exact.placed(frame(spark, rows), "doc_id", "text")
    thin = exact.cut_table(exact.thin_rows(table))
    messages = exact.cut_table(exact.send(thin, 6))
    bits = exact.marks(messages, exact.answers(messages))
    assert sorted(r.doc_id for r in exact.with_marks(thin, bits).where("suspect").collect()) == [900, 901, 902, 903, 904]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.execute(ORACLE["op11_exact"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(tuple, op11_exact(spark, SF).select(*names).collect())) == sorted(cursor.fetchall())
