"""BPE against the tokenizers library, and pair checks against merging."""

from __future__ import annotations

import random

import numpy as np
import pytest

from gapwright.llm import bpe
from gapwright.llm.queries import tokenizer_path
from tests.llm.helpers import documents, frame, odd_rows

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def random_texts():
    rng = random.Random(1)
    text = lambda letters, most: "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))
    out = [text("abcdefghijklmnopqrstuvwxyz'ABCéßΣİſ0123 .,!<|/w>\n\t\x00\x1c\x85　😀中文", 60) for _ in range(1500)]
    out += [text("abehinostr", 40) for _ in range(1500)] + [text("ab", 40) for _ in range(300)]
    return out + ["a<|endoftext|>B", "</w>", "<|startoftext|><|endoftext|>", "", "a" * 1200, "I'LL don't ΑΣ Σ", "é é"]


def test_ids_and_text_equal_the_library(library):
    own = bpe.load(tokenizer_path())
    texts = random_texts()
    ids, bounds = own.encode(texts)
    for i, text in enumerate(texts):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == expected, text
        assert " ".join(own.names[expected]) == library.decode(expected, skip_special_tokens=False)


def test_pairs_are_compatible_just_if_merging_keeps_them():
    own = bpe.load(tokenizer_path())
    rng = np.random.default_rng(3)
    inner = {i: text for text, i in own.lookup.items()}
    open_ = [i for i, text in inner.items() if not text.endswith("\n")]
    a = rng.choice(open_, 4000)
    b = rng.choice([*inner], 4000)
    merged = [own.merged(inner[x] + inner[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert own.compatible(a, b).tolist() == merged


def test_documents_round_trip(spark, library):
    path = tokenizer_path()
    docs = documents(spark)
    found = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    for r in docs.collect():
        expected = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(found[r.doc_id].ids) == expected
        assert found[r.doc_id].text == library.decode(expected, skip_special_tokens=False)


def test_odd_rows_and_empty_table(spark, library):
    path = tokenizer_path()
    rows = odd_rows()
    found = bpe.decode(bpe.encode(frame(spark, rows, clash=True), path), path)
    assert found.columns == ["doc_id", "ids", "text"]
    expected = sorted((str(r[0]), library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in found.collect()) == expected
    assert bpe.decode(bpe.encode(frame(spark, []), path), path).collect() == []


def test_ids_outside_the_vocabulary_add_nothing(spark):
    tokens = spark.createDataFrame([(1, [518, 10**6, -1]), (2, None)], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in bpe.decode(tokens, tokenizer_path()).collect()) == [(1, "the</w>"), (2, "")]
