"""Spelling variants: words one code point apart, by a bit-sliced position index.

The vocabulary is sliced into bitsets, one for each (position, letter): bit i is set if word i has the letter
there. A word's letters are consumed one after the other, with four sets of vocabulary words as state, 64 words
to a machine word:

    Z   no error so far, S   one letter replaced, I   one more letter in the vocabulary word, D   one letter less.

Consuming letter c at position j, with B(p, c) the slice and H(p) the words that have a position p,

    S' = S & B(j, c)  |  Z & H(j) & ~B(j, c)
    D' = D & B(j - 1, c)  |  Z
    Z' = Z & B(j, c)
    I' = I & B(j + 1, c)  |  Z' & H(j + 1)

so the sets without and with an error move along together. Words of the right length in S, I or D at the end are
near. All words of a part of the vocabulary are looked up at once.

Parts: of two near words, the shorter of length k, either the first or the last k div 2 letters are equal. So a
word goes to four parts of the index (two lengths k, front and back), by a hash of those letters, and meets there
all words that could be near. A part that many words share is split into blocks, and each pair of blocks is a
part of its own: no word is left out and no task holds more than two blocks. Each near pair is reported once.

Runs, their deletions and their counts are worked out document by document; counts are combined in tasks before
they are shuffled. Chains of forms at least multiply the count by `factor` a step, which bounds the rounds of
pointer doubling that find the last one.

Missing texts have no words. A missing id counts as the empty text in the hash. Repeated rows count as often as
they occur. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwright.llm.common import LOWER, chunks, cut_table, id_and_text

#: Words with a letter deleted: those whose hash this number divides.
EVERY = 199

#: Code points of the shortest word, and its least count.
SHORTEST, LEAST = 6, 5

#: Words of a part of the index on average, and of a block of a part that is split.
PART, BLOCK = 256, 2048

#: Words a task counts before it hands rows on.
TABLE_WORDS = 1_000_000

#: Words that are looked up at a time.
LOOKUPS = 1024

#: Only the longest runs matter: a shorter one can't become a word.
RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY, least: int = LEAST) -> DataFrame:
    """(word, n): runs of letters after the deletions, of SHORTEST code points and `least` occurrences at least."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def count(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], names=["word", "n"])

        for batch in batches:
            for part, texts in chunks(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                    found = Counter(RUN.findall(text.translate(LOWER).decode())) if text else {}
                    begun = crc32(f"{doc_id}:".encode())
                    changed = [(run, h) for run in found if (h := crc32(run.encode(), begun)) % every == 0]
                    for run, h in changed:
                        at, n = h % len(run), found.pop(run)
                        if len(run) > SHORTEST:
                            # not into `found`: it might be a run of its own, which may be changed as well
                            counts[run[:at] + run[at + 1 :]] += n
                    counts.update(found)
                if len(counts) > TABLE_WORDS:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def parts(words: DataFrame, part: int, block: int) -> DataFrame:
    """(k, back, part, one, two, block, word, n): each word in all the parts where it may meet a near one."""
    length = F.length("word")
    keyed = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("k")).where(F.col("k") >= SHORTEST)
    half = F.floor(F.col("k") / 2).cast("int")
    front, back = F.substring("word", F.lit(1), half), F.substring("word", length - half + 1, half)
    keyed = keyed.select("k", F.inline(F.array(*[F.struct(F.lit(b).alias("back"), F.xxhash64("k", h).alias("key")) for b, h in ((False, front), (True, back))])), "word", "n")
    # how many parts a length has, and which keys need blocks
    lengths = words.groupBy(length.alias("k")).agg(F.count(F.lit(1)).alias("n_words"))
    lengths = lengths.unionByName(lengths.select((F.col("k") - 1).alias("k"), "n_words")).groupBy("k").agg(F.sum("n_words").alias("n_words"))
    keys = keyed.groupBy("k", "back", "key").agg(F.count(F.lit(1)).alias("n_key"))
    hot = keys.where(F.col("n_key") > block).select("k", "back", "key", F.ceil(F.col("n_key") / block).cast("int").alias("blocks"))
    met = keyed.join(lengths, "k").join(hot, ["k", "back", "key"], "left")
    own = F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    met = met.withColumn("block", F.coalesce(own, F.lit(0)))
    others = F.when(F.col("blocks").isNotNull(), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))
    met = met.withColumn("other", F.explode(others))
    plain = F.pmod(F.col("key"), F.ceil(F.col("n_words") / part).cast("long"))
    return met.select(
        "k", "back", F.when(F.col("blocks").isNull(), plain).otherwise(F.col("key")).alias("part"), F.col("blocks").isNotNull().alias("split"),
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "word", "n",
    )


class Index:
    """Bit-sliced positions of words, given as a matrix of letter numbers (-1 behind the end)."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        self.letters, self.lengths = letters, lengths
        n, longest = letters.shape
        alphabet = int(letters.max()) + 1
        self.width = -(-n // 64)
        self.slices = np.zeros((longest + 2, alphabet, self.width), np.uint64)  # two positions that no word has
        bit = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        for p in range(longest):
            has = np.flatnonzero(letters[:, p] >= 0)
            np.bitwise_or.at(self.slices[p], (letters[has, p], has // 64), bit[has])
        self.has = np.bitwise_or.reduce(self.slices, axis=1)
        self.of_length = {int(m): self._set(lengths == m) for m in np.unique(lengths)}

    def _set(self, chosen: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.width * 64, np.uint8)
        padded[: len(chosen)] = chosen
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def near(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, row) of the looked-up words, all of one length, and the words near them."""
        m = int(self.lengths[rows[0]])
        B, H = self.slices, self.has
        zero = np.zeros((len(rows), self.width), np.uint64)
        Z, S, D = ~zero, zero, zero
        more = zero | H[0]
        for j in range(m):
            c = self.letters[rows, j]
            here = B[j][c]
            S = (S & here) | (Z & H[j] & ~here)
            D = (D & B[j - 1][c] if j else zero) | Z
            Z = Z & here
            more = (more & B[j + 1][c]) | (Z & H[j + 1])
        none = np.zeros(self.width, np.uint64)
        hits = S & self.of_length.get(m, none) | more & self.of_length.get(m + 1, none) | D & self.of_length.get(m - 1, none)
        at, word = np.nonzero(hits)
        bits = np.unpackbits(hits[at, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return rows[at[which]], word[which] * 64 + bit


def near_words(words: DataFrame, part: int = PART, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, best): number of near words, and the one of largest count, if there are any."""

    def work(table: pa.Table) -> pa.Table:
        texts, n, blocks = (table.column(c).to_pylist() for c in ("word", "n", "block"))
        k, back, one, two = (table.column(c)[0].as_py() for c in ("k", "back", "one", "two"))
        lengths = np.array([len(w) for w in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        known, numbers = np.unique(codes, return_inverse=True)
        letters = np.full((len(texts), int(lengths.max())), -1, np.int64)
        letters[np.arange(letters.shape[1]) < lengths[:, None]] = numbers
        index = Index(letters, lengths)
        half, best, count = k // 2, {}, Counter()
        for m in np.unique(lengths):
            rows = np.flatnonzero(lengths == m)
            for start in range(0, len(rows), LOOKUPS):
                for a, b in zip(*map(np.ndarray.tolist, index.near(rows[start : start + LOOKUPS]))):
                    u, v = texts[a], texts[b]
                    same = u[:half] == v[:half]
                    # the part of this length and of these letters; equal fronts count there, not at the back
                    if min(len(u), len(v)) != k or (same if back else not same) or (back and u[-half:] != v[-half:]):
                        continue
                    if one != two and blocks[a] == blocks[b]:
                        continue
                    count[a] += 1
                    rank = (-n[b], v)
                    if a not in best or rank < best[a]:
                        best[a] = rank
        rows = list(count)
        columns = [[texts[a] for a in rows], [count[a] for a in rows], [best[a][0] for a in rows], [best[a][1] for a in rows]]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "n_near", "below", "near"])

    dealt = parts(words, part, block)
    found = dealt.groupBy("k", "back", "split", "part", "one", "two").applyInArrow(work, "word string, n_near long, below long, near string")
    each = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("below", "near")).alias("best"))
    return words.join(each, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.below")).alias("near_n"))


def forms(counted: DataFrame, factor: int = 5, part: int = PART, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a word's form is its commonest near word, if `factor` times as common."""
    words = cut_table(counted)
    near = near_words(words, part, block)
    is_form = F.col("near_n") >= factor * F.col("n")
    judged = cut_table(near.select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")))
    bounds = words.agg(F.min("n").alias("low"), F.max("n").alias("high")).first()
    steps = math.floor(math.log(bounds.high / bounds.low, factor) + 1e-9) if bounds.high else 0
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
