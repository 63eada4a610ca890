"""Packing into optimal length buckets.

Texts are cut into pieces of at most `longest` words, so the histogram of lengths is bounded. Dynamic
programming over the whole histogram chooses the bucket borders that pad least; a bucket pads its pieces to
its border, and its batches hold as many pieces as the token budget allows (one at least). Pieces are
numbered within their bucket over hashed shards, each numbered on its own from the count of those before,
so that a bucket of any size is dealt to many tasks and only its last batch may be short.

The texts are split into words once for their lengths, which are kept in a table with equal rows (of one id and
text) counted together. So equal rows take one place in the numbering, however many they are, and are dealt to
their batches afterwards, some at a time.

Missing texts are empty. A text without a word is one piece of no words, in no bucket and no batch. Repeated
rows are packed each; missing ids are packed like others. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gapwright.llm.common import ascii_words, cut_table, id_and_text

#: Pieces that one task numbers, on average.
ROWS_A_SHARD = 20_000

#: Equal pieces that are dealt to their batches at a time.
COPIES_AT_ONCE = 10_000


def optimal_borders(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Borders (lengths that occur, the greatest last) of at most `buckets` buckets that pad least.

    Among equally good choices the one with the smaller borders counts.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(lengths)
    if not n:
        return []
    before = np.concatenate([[0], np.cumsum(counts)])
    words = np.concatenate([[0], np.cumsum(counts * lengths)])
    # cost[i, j]: padding if lengths i..j share the border lengths[j]
    cost = lengths[None, :] * (before[None, 1:] - before[:-1, None]) - (words[None, 1:] - words[:-1, None])
    never = np.iinfo(np.int64).max // 4
    cost[np.tril_indices(n, -1)] = never
    best, back = cost[0].copy(), [np.zeros(n, np.int64)]
    tables = [best]
    for _ in range(1, min(buckets, n)):
        # best[j]: lengths up to j in one bucket more; the last begins at i
        total = np.concatenate([[never], tables[-1][:-1]])[:, None] + cost
        back.append(total.argmin(0))
        tables.append(total.min(0))
    k = int(np.argmin([t[-1] for t in tables]))
    borders, j = [], n - 1
    while j >= 0:
        borders.append(int(lengths[j]))
        j = int(back[k][j]) - 1
        k -= 1
    return borders[::-1]


def lengths_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tag, n, copies): the words of each text; rows of one id and text are counted together."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select("doc_id", text_tag(), F.size(ascii_words(F.col("text"))).cast("long").alias("n"))
    return rows.groupBy("doc_id", "tag", "n").agg(F.count("*").alias("copies"))


def text_tag() -> Column:
    return F.coalesce(F.md5("text"), F.lit("")).alias("tag")


def pieces(lengths: DataFrame, longest: int) -> DataFrame:
    """Texts of `n` words cut into (piece, start, n_tokens); other columns stay."""
    last = F.greatest(F.ceil(F.col("n") / longest).cast("int") - 1, F.lit(0))
    rows = lengths.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    rows = rows.withColumn("start", F.col("piece").cast("long") * longest)
    return rows.withColumn("n_tokens", F.least(F.col("n") - F.col("start"), F.lit(longest).cast("long"))).drop("n")


def piece_texts(docs: DataFrame, longest: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tag, piece, text) of texts with a word."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select("doc_id", text_tag(), ascii_words(F.col("text")).alias("words"))
    cut = pieces(rows.withColumn("n", F.size("words").cast("long")).where("n > 0"), longest)
    text = F.array_join(F.slice("words", F.col("start").cast("int") + 1, F.col("n_tokens").cast("int")), " ")
    return cut.select("doc_id", "tag", "piece", text.alias("text"))


def copies_of(rows: DataFrame) -> DataFrame:
    """A row for each of a row's `copies`, with its number `copy`; many equal rows are dealt to several tasks."""
    runs = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_AT_ONCE).cast("long"))).alias("from_copy"))
    dealt = runs.repartition("doc_id", "tag", "piece", "from_copy")
    last = F.least(F.col("copies"), F.col("from_copy") + COPIES_AT_ONCE) - 1
    return dealt.select("*", F.explode(F.sequence("from_copy", last)).alias("copy")).drop("from_copy")


def pack(docs: DataFrame, longest: int = 2048, buckets: int = 16, budget: int = 65_536, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bucket, pad_to, batch, slot[, text]) of every piece."""
    every = cut_table(lengths_of(docs, id_col, text_col))
    rows = pieces(every, longest)
    # at most `longest` + 1 rows
    found = sorted((r["n_tokens"], r["count"]) for r in rows.groupBy("n_tokens").agg(F.sum("copies").alias("count")).collect() if r["n_tokens"])
    lengths, counts = (np.asarray(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    borders = optimal_borders(lengths, counts, buckets)
    none = lambda kind: F.lit(None).cast(kind)
    columns = ["doc_id", "piece", "start", "n_tokens", "bucket", "pad_to", "batch", "slot", *(["text"] if with_text else [])]
    wordless = copies_of(rows.where("n_tokens = 0")).select("*", none("int").alias("bucket"), *[none("long").alias(c) for c in ("pad_to", "batch", "slot")], F.lit("").alias("text"))
    if not borders:
        return wordless.select(columns)
    which = np.searchsorted(borders, lengths)
    sizes = np.bincount(which, counts, len(borders)).astype(np.int64)
    holds = np.maximum(1, budget // np.asarray(borders))
    first = np.concatenate([[0], np.cumsum(-(-sizes // holds))])
    shards = int(-(-sizes.sum() // ROWS_A_SHARD))
    of_bucket = lambda values: F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("bucket"))
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b < F.col("n_tokens")))
    rows = rows.where("n_tokens > 0").select("*", bucket.alias("bucket"), F.pmod(F.xxhash64("doc_id", "piece", "tag"), F.lit(shards)).alias("shard"))
    before = F.sum("copies").over(W.partitionBy("bucket", "shard").orderBy("doc_id", "piece", "tag").rowsBetween(W.unboundedPreceding, -1))
    numbered = rows.withColumn("number", F.coalesce(before, F.lit(0)))
    # one row for each bucket and shard
    in_shard = rows.groupBy("bucket", "shard").agg(F.sum("copies").alias("count"))
    earlier = F.sum("count").over(W.partitionBy("bucket").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    offsets = in_shard.select("bucket", "shard", F.coalesce(earlier, F.lit(0)).alias("offset"))
    placed = copies_of(numbered.join(offsets, ["bucket", "shard"])).withColumn("place", F.col("number") + F.col("copy") + F.col("offset"))
    placed = placed.select(
        "*",
        of_bucket(borders).alias("pad_to"),
        (of_bucket(first[:-1]) + F.floor(F.col("place") / of_bucket(holds)).cast("long")).alias("batch"),
        (F.col("place") % of_bucket(holds)).alias("slot"),
    )
    if with_text:
        texts = piece_texts(docs, longest, id_col, text_col)
        texts = texts.select(F.col("doc_id").alias("of_id"), F.col("tag").alias("of_tag"), F.col("piece").alias("of_piece"), "text")
        own = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("tag") == F.col("of_tag")) & (F.col("piece") == F.col("of_piece"))
        met = placed.where("copies = 1").join(texts, own)
        again = every.where("n > 0 and copies > 1").select(F.col("doc_id").alias("again_id"), F.col("tag").alias("again_tag"))
        if not again.isEmpty():
            # a text of equal rows is reduced to one before it meets their places
            some = texts.join(again, F.col("of_id").eqNullSafe(F.col("again_id")) & (F.col("of_tag") == F.col("again_tag")), "left_semi")
            met = met.unionByName(placed.where("copies > 1").join(some.dropDuplicates(["of_id", "of_tag", "of_piece"]), own))
        placed = met
    return placed.select(columns).unionByName(wordless.select(columns))
