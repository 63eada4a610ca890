"""The random field against enumeration, and language on held-out rows."""

from __future__ import annotations

import itertools
import math
import re

import numpy as np

from gapwright.llm import crf
from gapwright.llm.queries import op10_language
from tests.llm.helpers import SF, STRANGE, documents, frame, odd_rows


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    model = crf.Crf(crf.Settings(slots=64), ["a", "b", "c"], np.zeros((320, 3)), rng.normal(size=(3, 3)), rng.normal(size=3), np.zeros(64, bool))
    lengths = np.array([3, 0, 5, 1])
    scores, pairs = rng.normal(size=(9, 3)), np.zeros((3, 3))
    found = model.marginals(scores, lengths, pairs)
    at, expected = 0, np.zeros((3, 3))
    for n in lengths[lengths > 0].tolist():
        words, all_ = np.zeros((n, 3)), 0.0
        steps = np.zeros((3, 3))
        for labels in itertools.product(range(3), repeat=n):
            value = np.exp(model.first[labels[0]] + sum(scores[at + i, y] for i, y in enumerate(labels)) + sum(model.transitions[a, b] for a, b in zip(labels, labels[1:])))
            all_ += value
            for i, y in enumerate(labels):
                words[i, y] += value
            for a, b in zip(labels, labels[1:]):
                steps[a, b] += value
        assert np.allclose(words / all_, found[at : at + n])
        expected += steps / all_
        at += n
    assert np.allclose(pairs, expected)


def test_features_are_those_of_each_word_alone():
    settings = crf.Settings()
    words = ["a", "the", "schön", "the", "x" * 300]
    slots, owners = crf.feature_slots(words, settings)
    for i, w in enumerate(words):
        alone, _ = crf.feature_slots([w], settings)
        assert sorted(slots[owners == i].tolist()) == sorted(alone.tolist())


def plain_slots(word: str, settings: crf.Settings) -> list[int]:
    """The features of a word, one n-gram after the other."""
    whole, mix = 2**64, 0x9E3779B97F4A7C15
    points = [2, *map(ord, word), 3]
    out = []
    for n in range(1, settings.longest_ngram + 1):
        for at in range(len(points) - n + 1):
            value = 0
            for i in range(n):
                value = (value + points[at + i] + i + 1) * mix % whole
                value ^= value >> 29
            out.append((value >> 20) % settings.slots + (n - 1) * settings.slots)
    value = sum(p * pow(mix, i, whole) for i, p in enumerate(points, 1)) % whole
    value ^= value >> 31
    return [*out, (value >> 13) % settings.slots + settings.longest_ngram * settings.slots]


def plain_prediction(text: str, model: crf.Crf) -> tuple[str, float, float]:
    """Language, score and familiar share of a text by forward and backward sums, word by word."""
    k = range(len(model.languages))
    words = [w for w in re.split(r"[\W\d_]+", text.lower()) if w]
    slots = [plain_slots(w, model.settings) for w in words]
    emit = [[math.exp(sum(model.weights[s, y] for s in found)) for y in k] for found in slots]
    step = [[math.exp(model.transitions[a, b]) for b in k] for a in k]
    scaled = lambda values: [v / sum(values) for v in values]
    ahead = [scaled([math.exp(model.first[y]) * emit[0][y] for y in k])]
    for e in emit[1:]:
        ahead.append(scaled([sum(ahead[-1][x] * step[x][y] for x in k) * e[y] for y in k]))
    back = [[1.0 for _ in k]]
    for e in emit[:0:-1]:
        back.append(scaled([sum(step[x][y] * e[y] * back[-1][y] for y in k) for x in k]))
    marginals = [scaled([a * b for a, b in zip(*both)]) for both in zip(ahead, back[::-1])]
    means = [sum(m[y] for m in marginals) / len(words) for y in k]
    grams = [s - 2 * model.settings.slots for found in slots for s in found if s // model.settings.slots == 2]
    best = max(k, key=means.__getitem__)
    return model.languages[best], means[best], sum(bool(model.seen[s]) for s in grams) / len(grams)


def test_whole_documents_equal_a_plain_second_version(spark):
    docs = documents(spark)
    model = crf.train(docs, docs["lang"].isNotNull(), crf.Settings(passes=4, rows_per_language=20))
    some = docs.where("n_chars < 1500 and text rlike '[A-Za-z]'").orderBy("doc_id").limit(25)
    found = {r.doc_id: r for r in crf.predict(some, model).collect()}
    assert len({r.lang_pred for r in found.values()}) > 1
    for r in some.collect():
        lang, score, familiar = plain_prediction(r.text, model)
        assert found[r.doc_id].lang_pred == lang
        assert abs(found[r.doc_id].score - score) < 1e-6 and abs(found[r.doc_id].familiar - familiar) < 1e-9


def test_unlearnt_languages_and_junk_go(spark):
    docs = documents(spark)
    model = crf.train(docs, docs["lang"].isNotNull())
    assert not crf.keep_known(frame(spark, [(i, t, None, None, None) for i, t in enumerate(STRANGE)]), model, 0.0, familiar=0.75).collect()
    assert crf.keep_known(docs, model, 0.0, familiar=0.75).count() >= 0.99 * docs.count()


def test_languages_of_many_labels_are_bounded(spark):
    docs = documents(spark).select("doc_id", "text", "lang")
    labels = spark.range(300).selectExpr("id", "'a few words'", "concat('x', id)")
    more = docs.union(labels)
    model = crf.train(more, more["lang"].isNotNull(), crf.Settings(most_languages=4, passes=1))
    assert model.languages == ["de", "en", "es", "fr"]


def test_languages_of_held_out_rows(spark):
    found = {r.doc_id: r for r in op10_language(spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in documents(spark).collect()}
    aside = [r for r in found.values() if r.held_out]
    assert len(found) == len(truth) and aside
    assert sum(r.lang_pred == truth[r.doc_id] for r in aside) >= 0.97 * len(aside)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_code_switching_is_seen(spark):
    docs = documents(spark)
    model = crf.train(docs, docs["lang"].isNotNull())
    by = {lang: [r.text for r in docs.where(docs["lang"] == lang).limit(2).collect()] for lang in ("en", "de")}
    mixed = " ".join(by["en"][0].split()[:40] + by["de"][0].split()[:40] + by["en"][1].split()[:40])
    (row,) = crf.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).collect()
    assert row.lang_pred == "en" and 1 <= row.n_switches <= 8


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows()
    docs = frame(spark, rows, clash=True)
    model = crf.train(docs, docs["lang"].isNotNull())
    assert model.languages == ["en"]
    found = crf.predict(docs, model).collect()
    assert len(found) == len(rows)
    unknown = {r.doc_id for r in found if r.lang_pred == crf.UNKNOWN}
    assert {0, 1, 2, 9} <= unknown and {r.score for r in found if r.lang_pred == crf.UNKNOWN} == {0.0}
    untaught = crf.train(docs, docs["lang"] == "xx")
    assert {r.lang_pred for r in crf.predict(docs, untaught).collect()} == {crf.UNKNOWN}
    assert crf.predict(frame(spark, []), model).collect() == []
    kept = crf.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.lang_pred != crf.UNKNOWN for r in found)


def test_every_language_has_its_rows_where_ids_are_missing_or_repeat(spark):
    docs = documents(spark).select("doc_id", "text", "lang")
    crowd = spark.range(2000).selectExpr("cast(null as long)", "concat('these are plain words number ', id)", "'en'")
    copies = spark.range(2000).selectExpr("cast(null as long)", "'one and the same text'", "'en'")
    settings = crf.Settings(rows_per_language=30)
    alone = crf.sample(docs, docs["lang"].isNotNull(), settings, "doc_id", "text", "lang")
    for extra in (crowd, copies, crowd.union(copies)):
        more = docs.union(extra)
        found = crf.sample(more, more["lang"].isNotNull(), settings, "doc_id", "text", "lang")
        assert {lang for lang, _ in found} == {lang for lang, _ in alone} > {"en"}
        assert [x for x in found if x[0] != "en"] == [x for x in alone if x[0] != "en"]
        assert sum(lang == "en" for lang, _ in found) == 30
        assert sum(t == "one and the same text" for _, t in found) <= 1
