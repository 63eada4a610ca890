"""Source divergence audit by count-level bitmaps.

A group is a source within a language. With the kept terms of the language numbered, a group keeps one bitset of
term numbers for each count that occurs in it. ANDing the bitsets of two groups and counting bits gives the cells
of their joint table: how many terms have count a here and count b there. The divergence of a pair is the sum
over cells, each multiplied by f(a, b). Zeros have no bitsets: cells with a zero follow by complement,

    n(a, 0) = |A_a| - sum_b n(a, b),    n(0, b) = |B_b| - sum_a n(a, b),    n(0, 0) = V - the rest,

so that a pair's sum is  sum n(a, b) (f(a, b) - f(a, 0) - f(0, b) + f(0, 0))  over joint cells, plus terms in the
sizes of single levels, plus V f(0, 0).

Terms are dealt to buckets by hash. Within a bucket they are numbered by falling frequency, 64 to a word, so that
terms of like counts share words; a level holds only words that aren't empty, and two groups meet word by word.
A bucket hands on one sum a pair, never a pair of terms.

Counts are combined in tasks, then by (language, source, term): a hot source or term is one row a task. Terms in
at least `least` documents of their language are kept. All numbers are exact: shares are whole, worked out in
decimals, and a sum over all terms of f stays below 2 ** 62, as the shares of a group add up to about `SCALE`.

Missing texts, languages and sources count as ''. Groups without a kept term still have their pairs. Repeated
rows count as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwright.llm.common import chunks, cut_table

#: Whole shares are of this many parts.
SCALE = 1_000_000_000

#: Terms a task counts before it hands rows on.
TABLE_TERMS = 1_000_000

#: Rows (source, term) of a bucket on average; a term has one for each source that has it.
BUCKET_ROWS = 200_000

#: Pairs of bitset words that are ANDed at a time.
PAIRS = 1 << 20

#: Small letters for A-Z; everything else in ASCII that is no letter parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""
    text_of = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    rows = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).cast("binary").alias("text"))

    def run(batches):
        counts: dict = defaultdict(Counter)
        documents: dict = defaultdict(Counter)
        held = 0

        def out():
            for (lang, source), found in counts.items():
                within = documents[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array([source] * len(found), pa.string()), pa.array([*found], pa.binary()).cast(pa.string()), pa.array([*found.values()], pa.int64()), pa.array([within[t] for t in found], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            for part, texts in chunks(batch):
                for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts):
                    terms = text.translate(LETTERS).split()
                    found = counts[lang, source]
                    held -= len(found)
                    found.update(terms)
                    documents[lang, source].update(set(terms))
                    held += len(found)
                if held > TABLE_TERMS:
                    yield from out()
                    counts.clear()
                    documents.clear()
                    held = 0
        yield from out()

    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), in decimals."""
    whole = F.floor_div if hasattr(F, "floor_div") else None
    parts = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", parts, (total + terms).cast("decimal(20,0)"))


def gain(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def joint(rows: DataFrame, buckets: int) -> DataFrame:
    """(lang, source, item, value): over the joint cells of each ordered pair, what they add beyond single levels.

    `rows` are (lang, source, term, n, total, p, zero): count and share of a term in a group, its count in the
    language, and the group's share of an absent term.
    """

    def f(x, y):
        return (x - y) * (x - y) // y

    def summed(keys, values):
        order = np.argsort(keys, kind="stable")
        keys, starts = np.unique(keys[order], return_index=True)
        return keys, np.add.reduceat(values[order], starts) if len(starts) else values

    def work(table: pa.Table) -> pa.Table:
        coded = table.column("source").combine_chunks().dictionary_encode()
        names, source = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        terms = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        n, total, p, zero = (table.column(c).to_numpy() for c in ("n", "total", "p", "zero"))
        # numbers by falling frequency
        count = int(terms.max()) + 1
        weight = np.zeros(count, np.int64)
        weight[terms] = total
        number = np.empty(count, np.int64)
        number[np.argsort(-weight, kind="stable")] = np.arange(count)
        place = number[terms]
        # a level is a (source, count); its words are the ones with a bit
        _, first, level = np.unique(np.stack([source, n]), axis=1, return_index=True, return_inverse=True)
        level = level.ravel()
        of, share_of, zero_of = source[first], p[first], zero[first]
        key = (place // 64) * len(first) + level
        order = np.argsort(key, kind="stable")
        keys, starts = np.unique(key[order], return_index=True)
        bits = np.bitwise_or.reduceat(np.uint64(1) << (place[order] % 64).astype(np.uint64), starts)
        word, level = keys // len(first), keys % len(first)
        # every entry meets the entries of its word
        begin = np.searchsorted(word, word, "left")
        sizes = np.searchsorted(word, word, "right") - begin
        found, values = [], []
        edges = np.cumsum(sizes)
        at = 0
        while at < len(word):
            end = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + PAIRS, "right")))
            left = np.repeat(np.arange(at, end), sizes[at:end])
            right = np.arange(len(left)) - np.repeat(edges[at:end] - sizes[at:end] - (edges[at - 1] if at else 0), sizes[at:end]) + begin[left]
            cells = np.bitwise_count(bits[left] & bits[right]).astype(np.int64)
            a, b = level[left], level[right]
            hit = (cells > 0) & (of[a] != of[b])
            cells, a, b = cells[hit], a[hit], b[hit]
            here, there, none, other = share_of[a], share_of[b], zero_of[a], zero_of[b]
            beyond = f(here, there) - f(here, other) - f(none, there) + f(none, other)
            pair, value = summed(of[a] * len(names) + of[b], cells * beyond)
            found.append(pair)
            values.append(value)
            at = end
        pair, value = summed(np.concatenate(found), np.concatenate(values))
        lang = table.column("lang")[0].as_py()
        items = [names.take(pa.array(i)) for i in (pair // len(names), pair % len(names))]
        return pa.table([pa.array([lang] * len(pair), pa.string()), *items, pa.array(value)], names=["lang", "source", "item", "value"])

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    sums = dealt.groupBy("lang", "bucket").applyInArrow(work, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = 3, top: int = 200, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of a language's sources, and each source's `top` terms."""
    text_of = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    groups = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source")).distinct()
    term = Window.partitionBy("lang", "term")
    counted = term_counts(docs, lang_col, source_col, text_col)
    kept = counted.select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("total"), F.sum("docs").over(term).alias("within"), (F.row_number().over(term.orderBy("source")) == 1).alias("once")
    )
    kept = cut_table(kept.where(F.col("within") >= least).drop("within"))
    langs = kept.groupBy("lang").agg(F.count_if("once").alias("terms"), F.sum("n").alias("lang_n"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = groups.join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *[whole(c) for c in ("terms", "lang_n", "group_n")])
    # a language without kept terms has no shares
    groups = cut_table(groups.withColumn("zero", F.when(F.col("terms") > 0, share(F.lit(0), F.col("group_n"), F.col("terms")))))
    rows = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("group_n"), F.col("terms")))

    q = share(F.col("total"), F.col("lang_n"), F.col("terms"))
    terms = rows.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gain(F.col("p"), F.col("q")).alias("value"))

    n_rows = kept.count()
    cells = joint(rows.select("lang", "source", "term", "n", "total", "p", "zero"), max(1, -(-n_rows // bucket_rows)))
    levels = rows.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("size"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    apart = F.col("source") != F.col("item")
    met = levels.join(others, "lang").where(apart)
    own, none, other = F.col("p"), F.col("zero"), F.col("other_zero")
    # levels of the group against absent terms of the other, and the other way round
    here = met.select("lang", "source", "item", (F.col("size") * (gain(own, other) - gain(none, other))).alias("value"))
    there = met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("size") * (gain(other, own) - gain(other, none))).alias("value"))
    base = groups.join(others, "lang").where(apart).select("lang", "source", "item", F.coalesce(F.col("terms") * gain(none, other), F.lit(0)).alias("value"))
    pairs = cells.unionByName(here).unionByName(there).unionByName(base).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(ranked)
