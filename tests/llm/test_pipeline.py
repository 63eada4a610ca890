"""Every stage of the pipeline on its own input, and the whole."""

from __future__ import annotations

import pytest

import corpus_pipeline
from gapwright.llm import crf, simhash
from gapwright.llm.common import cut_table
from tests.llm.helpers import SF, STRANGE, documents, frame, odd_rows, words
from tests.llm.test_secrets import plain
from tests.llm.test_substring import brute


@pytest.fixture(scope="module")
def steps(spark):
    """The input and the result of each stage."""
    docs, out = documents(spark), {"": documents(spark)}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = cut_table(stage(spark, docs, SF))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_are_named_and_keep_the_columns(spark, steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "secret_marks", "packing"]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name].dtypes == documents(spark).dtypes


def test_language_keeps_clean_documents(spark, steps):
    before, after = by_id(steps[""]), by_id(steps["language"])
    assert after.items() <= before.items()
    assert all(any(c.isalpha() for c in r.text) for r in after.values())
    assert len(after) >= 0.98 * len(before)
    texts = ["123 456 --", None, *STRANGE]
    strange = spark.createDataFrame([(10_000 + i, t, None, "s", 1) for i, t in enumerate(texts)], documents(spark).schema)
    kept = corpus_pipeline.language(spark, documents(spark).union(strange), SF)
    assert {r.doc_id for r in kept.collect()} == {*after}


def test_one_document_of_each_group_stays(steps):
    found = simhash.near_duplicates(steps["language"]).collect()
    assert {*by_id(steps["near_duplicates"])} == {r.component_id for r in found}


def test_repeated_passages_go(steps):
    before = by_id(steps["near_duplicates"])
    expected = brute([(i, r.text) for i, r in before.items()], 13)
    for i, r in by_id(steps["repeated_passages"]).items():
        _, removed, kept = expected[i]
        assert r.text == (kept if removed else before[i].text) and r.n_chars == len(r.text)


def test_secrets_are_marked(steps):
    for i, r in by_id(steps["secret_marks"]).items():
        before = steps_text(steps, i)
        assert not plain(r.text)
        assert (r.text == before) or "[SECRET]" in r.text


def steps_text(steps, i, cache={}):
    if not cache:
        cache.update({k: r.text for k, r in by_id(steps["repeated_passages"]).items()})
    return cache[i]


def test_packing_holds_every_word(steps):
    pieces = sorted(steps["packing"].collect(), key=lambda r: (r.doc_id, r.start))
    held: dict[int, list[str]] = {}
    for r in pieces:
        held.setdefault(r.doc_id, []).extend(words(r.text))
    assert held == {i: words(r.text) for i, r in by_id(steps["secret_marks"]).items()}


def test_the_whole_is_its_stages(spark, steps):
    columns = ["doc_id", "piece", "start", "n_tokens", "batch", "slot", "text"]
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()))
    assert rows(corpus_pipeline.run(spark, SF)) == rows(steps["packing"])


def test_odd_rows_and_empty_table(spark):
    for rows in (odd_rows(200), []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = cut_table(stage(spark, docs, SF))
        # blank texts, texts without a letter and one of a single letter go, and all copies but the first
        assert sorted(r.doc_id for r in docs.collect()) == ([3, 4, 5, 6, 7] if rows else [])
    assert crf.UNKNOWN == "und"
