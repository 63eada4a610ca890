"""BPE encoding and decoding, speculated and verified.

A word's tokens are proposed by greedy longest match. A sequence of tokens is the one that merging yields
exactly if every adjacent pair is: no merge across the border of the two could come before both are whole.
That test runs over the arrays of all adjacent pairs of a chunk at once; only words in which a pair fails
are merged step by step. Words recur, so a task keeps a bounded table of the words it has encoded.

Missing texts count as empty, an empty text has no tokens and decodes to the empty text. Rows are treated
one by one: repeated rows, ties in the id and missing ids stay as they are. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gapwright.llm.common import field_of, id_and_text, map_chunks

#: Words a task keeps encoded; a full table is begun anew, which changes no result.
TABLE_WORDS = 300_000

_END = "\n"  # marks the end of a word; no byte is written as this character
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PLAIN}))}


class WordBpe:
    """Vocabulary and merges of a tokenizer file: BPE with word ends on lower-cased, byte-written words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *added.values()]) + 1
        self.names = np.full(self.size, "", dtype=object)
        for name, i in [*vocab.items(), *added.items()]:
            self.names[i] = name
        self.added = added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find_words = regex.compile(pattern.replace("\\s", "\\p{White_Space}")).findall

        self.rank = np.full(self.size, -1, np.int64)  # when a token is merged; -1: a single character
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        keys, ranks = [], []
        inner = {}
        for name, i in vocab.items():
            if len(name) == 1:
                inner[i] = name
            elif len(name) == 1 + len(suffix) and name.endswith(suffix):
                inner[i] = name[0] + _END
        for at, (a, b) in enumerate(merges):
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.pairs[i, j] = (at, k)
            keys.append(i * self.size + j)
            ranks.append(at)
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = at, i, j
                inner[k] = inner[i] + inner[j]
        order = np.argsort(keys)
        self.pair_keys = np.asarray(keys, np.int64)[order]
        self.pair_ranks = np.asarray(ranks, np.int64)[order]
        #: The test below needs parts that are merged before the whole; else all words are merged step by step.
        self.ordered = all(max(self.rank[vocab[a]], self.rank[vocab[b]]) < at for at, (a, b) in enumerate(merges))
        self.single = {name: i for i, name in inner.items() if self.rank[i] < 0}
        whole = [i for i in inner if self.rank[i] < 0 or self.merged(inner[i]) == [i]]
        self.lookup = {inner[i]: i for i in whole}  # tokens that their own characters merge to
        self.longest = max(map(len, self.lookup), default=1)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def merged(self, text: str) -> list[int]:
        """Exact merging of byte-written text: the earliest merge first, leftmost among equals."""
        if text.endswith(_END):
            ids = [self.single[c] for c in text[:-2]] + [self.single[text[-2:]]]
        else:
            ids = [self.single[c] for c in text]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        pairs = self.pairs
        heap = [(*found, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (found := pairs.get((ids[i], ids[i + 1])))]
        heap = [(rank, i, new, a, b) for rank, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (found := pairs.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (found[0], x, found[1], ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def greedy(self, text: str) -> list[int]:
        """Longest match from the left; the mark of the word's end stays with the last character."""
        out, at, end, get, longest = [], 0, len(text), self.lookup.get, self.longest
        while at < end:
            for stop in range(min(end, at + longest), at, -1):
                if stop != end - 1 and (token := get(text[at:stop])) is not None:
                    out.append(token)
                    at = stop
                    break
        return out

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """When each pair merges; -1: never."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each adjacent pair, whether its characters merge to just these two tokens.

        Time runs backwards: of the two tokens that touch the border, the one merged last is taken apart. A
        merge across the border that comes before the parents of both its parts spoils the pair.
        """
        fine = np.ones(len(a), bool)
        if not len(self.pair_keys):
            return fine
        where = np.arange(len(a))
        never = np.iinfo(np.int64).max
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_until, y_until = np.full(len(a), never), np.full(len(a), never)
        while len(where):
            rank = self.pair_rank(x, y)
            bad = (rank >= 0) & (rank < x_until) & (rank <= y_until)
            fine[where[bad]] = False
            x_at, y_at = self.rank[x], self.rank[y]
            go = ~bad & ((x_at >= 0) | (y_at >= 0))
            where, x, y, x_until, y_until, x_at, y_at = (v[go] for v in (where, x, y, x_until, y_until, x_at, y_at))
            first = x_at > y_at
            x_until, y_until = np.where(first, x_at, x_until), np.where(first, y_until, y_at)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
        return fine

    def written(self, word: str) -> str:
        if not (word.isascii() and word.isprintable()):
            word = "".join(map(_BYTES.__getitem__, word.encode("utf-8")))
        return word + _END

    def learn(self, words: list[str]) -> None:
        """Encode words that the table lacks and add them."""
        texts = [self.written(w) for w in words]
        guesses = [self.greedy(t) for t in texts] if self.ordered else [[] for _ in texts]
        lengths = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter((i for g in guesses for i in g), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(guesses)), lengths)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        wrong = {*owner[inside[~self.compatible(flat[inside], flat[inside + 1])]].tolist()}
        if not self.ordered:
            wrong = set(range(len(texts)))
        if wrong:
            for i in wrong:
                guesses[i] = self.merged(texts[i])
            lengths = np.fromiter(map(len, guesses), np.int64, len(guesses))
            flat = np.fromiter((i for g in guesses for i in g), np.int64, int(lengths.sum()))
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])

    def words(self, text: str | None) -> list[str]:
        """The words of a text; strings of added tokens come as they are."""
        if not text:
            return []
        if self.split_added is not None and any(a in text for a in self.added):
            out = []
            for part in self.split_added.split(text):
                out += [part] if part in self.added else self.words(part)
            return out
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.find_words(text.lower())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin and end."""
        split = [self.words(t) for t in texts]
        if len(self.index) > TABLE_WORDS:
            self.forget()
        if not self.index and self.added:
            self.index = {a: i for i, a in enumerate(self.added)}
            self.flat = np.asarray([*self.added.values()], np.int32)
            self.starts, self.lengths = np.arange(len(self.added)), np.ones(len(self.added), np.int64)
        if missing := sorted({w for words in split for w in words} - self.index.keys()):
            self.learn(missing)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        get = self.index.__getitem__
        which = np.fromiter((i for words in split for i in map(get, words)), np.int64, int(counts.sum()))
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[which] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, bounds


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each whole text under the tokenizer file at `path` on every node."""
    rows = id_and_text(docs, id_col, text_col)
    schema = T.StructType([field_of(rows, "doc_id"), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def make():
        bpe = load(path)

        def work(part, texts):
            ids, bounds = bpe.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

        return work

    return map_chunks(rows, make, schema)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text): the tokens' strings joined by blanks, as a tokenizer file without a decoder says.

    Ids outside the vocabulary add nothing. A missing list decodes to the empty text.
    """
    rows = tokens.select(tokens[id_col].alias("doc_id"), tokens[ids_col].cast("array<int>").alias("ids"))
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType(), False)])

    def run(batches):
        names = load(path).names
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column("ids")
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and not (flat.min() >= 0 and flat.max() < len(names)):
                    texts = [" ".join(names[i] for i in x or [] if i is not None and 0 <= i < len(names) and names[i]) for x in lists.to_pylist()]
                else:
                    words = names[flat.astype(np.int64)].tolist()
                    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                    ends = np.cumsum(sizes).tolist()
                    texts = [" ".join(words[a:b]) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return rows.mapInArrow(run, schema)
