"""Substring dedup over a compacted de Bruijn graph of word k-mers.

Edges are the windows of k consecutive words. Windows that follow each other and share their minimizer (the
smallest hash of the m-word pieces inside) form a segment, so an edge occurs only in segments of its own
minimizer. Segments of one minimizer with the same words are one variant. A minimizer with a single variant
is a nonbranching path, compacted into one row whose source is its first place. Where a minimizer has several
variants the path branches: each variant, once, is taken apart into edges, and each edge gets its first place
over all variants. Edges that go on in step with their source are joined into runs, runs are joined to all
occurrences of the variant, and those into long spans. Last, the words of every span are compared, by 128-bit
digests of the words at both coordinates, before anything is removed.

The corpus is shuffled as segments (about one row for five words) and as text, never as windows. Counts are
combined before shuffles, a passage that many documents share is one variant and is taken apart once, and its
occurrences are a key whose rows the joins may split. Nothing is collected, and no group is held by one task
but the spans of one document and the edges of one segment. Each step is cut from its lineage as a table of
its own, deleted when the next ones have read it.

Missing texts have no words. A document without an id is never a source and loses nothing. Rows that share
an id don't count as smaller than each other; a repeated row gets the same result as the first.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwright.llm.common import chunks, cut_table, drop_table

#: Words in a piece that a minimizer is taken from.
PIECE = 4

#: Words whose hashes a task keeps; a full table is begun anew.
TABLE_WORDS = 500_000

#: A place in a document: its text's tag, the number of a word, and the number of windows that begin there on.
TAG_BITS, START_BITS, SIZE_BITS = 23, 30, 10
PLACE_BITS = START_BITS + SIZE_BITS
LONGEST = (1 << SIZE_BITS) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (wraps around)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hashes(dict):
    """Word to 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def rolled(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` values; empty if there are too few."""
    n = len(values) - length + 1
    if n <= 0:
        return values[:0]
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = out * _ODD + values[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    """The minimum of each run of `length` values, by doubling."""
    out, have = values, 1
    while have < length:
        step = min(have, length - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Windows:
    """Hashes of the windows of several documents at once."""

    def __init__(self, texts: list[bytes | None], k: int, hashes: Hashes):
        split = [t.split() if t else [] for t in texts]
        self.counts = np.fromiter(map(len, split), np.int64, len(split))
        total = int(self.counts.sum())
        get = hashes.__getitem__
        self.words = np.fromiter(map(get, chain.from_iterable(split)), np.uint64, total)
        self.first = np.cumsum(self.counts) - self.counts
        self.edges = rolled(self.words, k)
        n = len(self.edges)
        self.owner = np.repeat(np.arange(len(split)), self.counts)[:n]
        #: Windows that end in the document they begin in.
        self.real = (np.arange(n) + k <= (self.first + self.counts)[self.owner]) if n else np.zeros(0, bool)

    def segments(self, k: int, piece: int) -> tuple[np.ndarray, ...]:
        """Owner, number of the first word, number of windows, minimizer and content hash of each segment."""
        low = sliding_min(rolled(self.words, piece), k - piece + 1)[: len(self.edges)]
        at = np.flatnonzero(self.real)
        if not len(at):
            nothing = np.zeros(0, np.int64)
            return nothing, nothing, nothing, nothing, nothing
        owner, low, edges = self.owner[at], low[at], self.edges[at]
        begins = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])]))
        # a very long run is split at fixed distances from its begin
        offset = np.arange(len(at)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(at)]])))
        begins = np.flatnonzero(offset % LONGEST == 0)
        sizes = np.diff(np.concatenate([begins, [len(at)]]))
        powers = np.cumprod(np.full(int(sizes.max()), _ODD), dtype=np.uint64)
        offset = np.arange(len(at)) - np.repeat(begins, sizes)
        content = mix(np.add.reduceat(edges * powers[offset], begins) + sizes.astype(np.uint64))
        return owner[begins], (at - self.first[owner])[begins], sizes, low[begins].view(np.int64), content.view(np.int64)


def _rows(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """(doc_id, tag, body[, row]): the text as bytes, a tag that tells texts of one id apart, the row but for its text."""
    rest = [F.struct(F.lit(True).alias("r"), *[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]).alias("row")] if carry else []
    body = docs[text_col].cast("string").cast("binary")
    tag = F.shiftrightunsigned(F.xxhash64(body), 64 - TAG_BITS)
    return docs.select(docs[id_col].alias("doc_id"), tag.alias("tag"), body.alias("body"), *rest)


def _batch(names: list[str], *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in arrays], names=names)


def _with_spans(named: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """Texts with the lists that concern them; the lists, small beside the texts, are hashed."""
    return named.join(lists.hint("shuffle_hash"), ["doc_id", "tag"], how)


def _list(sizes: np.ndarray, **columns) -> pa.Array:
    """Runs of rows as lists of structs."""
    fields = [x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.StructArray.from_arrays(fields, names=[*columns]))


def _tag(place: str) -> Column:
    return F.shiftright(place, PLACE_BITS)


def _start(place: str) -> Column:
    return F.shiftright(place, SIZE_BITS).bitwiseAND((1 << START_BITS) - 1)


def _size(place: str) -> Column:
    return F.col(place).bitwiseAND(LONGEST)



def segments(named: DataFrame, k: int) -> DataFrame:
    """(doc_id, place, low, content): the segments of all texts."""
    names = ["doc_id", "place", "low", "content"]
    piece = min(PIECE, k)

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            for part, texts in chunks(batch, "body"):
                owner, start, n, low, content = Windows(texts, k, hashes).segments(k, piece)
                place = (part.column("tag").to_numpy()[owner] << PLACE_BITS) | (start << SIZE_BITS) | n
                yield _batch(names, part.column("doc_id").take(pa.array(owner)), place, low, content)

    return named.mapInArrow(run, T.StructType([named.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names[1:]]]))


def edges_of(named: DataFrame, variants: DataFrame, k: int) -> DataFrame:
    """(doc_id, place, edge, at): the windows of the first occurrence of each variant, `at` from its begin."""
    parts = F.struct(_start("rep.place").alias("start"), _size("rep.place").alias("n"))
    lists = variants.groupBy(F.col("rep.doc_id").alias("doc_id"), _tag("rep.place").alias("tag")).agg(F.collect_list(parts).alias("parts"))
    names = ["doc_id", "place", "edge", "at"]

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            for part, texts in chunks(batch, "body"):
                lists = part.column("parts")
                flat = lists.flatten()
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
                first, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
                split = [t.split() for t in texts]
                words = np.fromiter(map(hashes.__getitem__, chain.from_iterable(split[d][a : a + m + k - 1] for d, a, m in zip(doc.tolist(), first.tolist(), n.tolist()))), np.uint64)
                edges = rolled(words, k)
                which = np.repeat(np.arange(len(n)), n)
                at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                owner = doc[which]
                place = (part.column("tag").to_numpy()[owner] << PLACE_BITS) | ((first[which] + at) << SIZE_BITS)
                # the words of segment i begin (k - 1) * i after its windows
                found = edges[np.arange(len(which)) + (k - 1) * which].view(np.int64)
                yield _batch(names, part.column("doc_id").take(pa.array(owner)), place, found, at)

    schema = T.StructType([named.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names[1:]]])
    return _with_spans(named, lists).select("doc_id", "tag", "body", "parts").mapInArrow(run, schema)


def runs_of(edges: DataFrame) -> DataFrame:
    """(doc_id, begin, runs): for each variant, by its first occurrence, its windows with their first places.

    Windows that go on in step with their places are joined.
    """
    # cut, so that the join shuffles plain tables and can split an edge that many variants share
    firsts = cut_table(edges.groupBy("edge").agg(F.min(F.struct("doc_id", "place")).alias("source")))
    traced = edges.join(firsts, "edge").select("doc_id", (F.col("place") - F.shiftleft("at", SIZE_BITS)).alias("begin"), "at", "source")
    grouped = traced.groupBy("doc_id", "begin").agg(F.collect_list(F.struct("at", F.col("source.doc_id").alias("source_id"), F.col("source.place").alias("source_place"))).alias("runs"))
    run_type = T.StructType([T.StructField("at", T.LongType()), T.StructField("n", T.LongType()), T.StructField("source_id", edges.schema["doc_id"].dataType), T.StructField("source_place", T.LongType())])
    schema = T.StructType([grouped.schema["doc_id"], grouped.schema["begin"], T.StructField("runs", T.ArrayType(run_type))])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                flat = part.column("runs").flatten()
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("runs")).to_numpy())
                owner, at, n, order = in_step(owner, flat.field("at").to_numpy(), np.ones(len(owner), np.int64), flat.field("source_id"), flat.field("source_place").to_numpy() >> SIZE_BITS)
                runs = _list(np.bincount(owner, minlength=part.num_rows), at=at, n=n, source_id=flat.field("source_id").take(pa.array(order)), source_place=flat.field("source_place").take(pa.array(order)))
                yield _batch(schema.names, part.column("doc_id"), part.column("begin"), runs)

    runs = cut_table(grouped.mapInArrow(run, schema))
    drop_table(firsts)
    return runs


def in_step(owner: np.ndarray, start: np.ndarray, n: np.ndarray, source: pa.Array, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, start, size and first row of pieces that follow on each other here and in their source."""
    of = pc.dictionary_encode(source).indices.to_numpy()
    order = np.lexsort([start, place - start, of, owner])
    owner, start, n, of, step = owner[order], start[order], n[order], of[order], (place - start)[order]
    same = (owner[1:] == owner[:-1]) & (of[1:] == of[:-1]) & (step[1:] == step[:-1]) & (start[1:] <= start[:-1] + n[:-1])
    new = np.flatnonzero(np.concatenate([[True], ~same])) if len(owner) else np.zeros(0, np.int64)
    ends = np.maximum.reduceat(start + n, new) if len(new) else start
    return owner[new], start[new], ends - start[new], order[new]


def repeated_spans(named: DataFrame, k: int) -> DataFrame:
    """(doc_id, tag, start, n_words, source_id, source_place): unverified spans that begin in a smaller document."""
    all_segments = cut_table(segments(named, k))
    # cut, so that the join shuffles plain tables and can split a minimizer that many documents share
    repeated = cut_table(
        all_segments.groupBy("low")
        .agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min("content").alias("c0"), F.max("content").alias("c1"))
        .where("d0 < d1")
        .select("low", (F.col("c0") == F.col("c1")).alias("single"))
    )
    met = cut_table(all_segments.join(repeated, "low"))
    drop_table(all_segments)
    drop_table(repeated)
    variants = cut_table(met.groupBy("low", "content", "single").agg(F.min(F.struct("doc_id", "place")).alias("rep")))
    edges = cut_table(edges_of(named, variants.where("not single"), k))
    traced = runs_of(edges)
    drop_table(edges)
    begin = (F.col("rep.place") - _size("rep.place")).alias("begin")
    branching = variants.where("not single").select("low", "content", F.col("rep.doc_id").alias("doc_id"), begin).join(traced, ["doc_id", "begin"]).select("low", "content", "runs")
    whole = F.struct(F.lit(0).cast("long").alias("at"), _size("rep.place").alias("n"), F.col("rep.doc_id").alias("source_id"), F.col("rep.place").alias("source_place"))
    runs = cut_table(branching.union(variants.where("single").select("low", "content", F.array(whole).alias("runs"))))
    drop_table(variants)
    drop_table(traced)
    pieces = met.join(runs, ["low", "content"]).select("doc_id", "place", F.explode("runs").alias("run")).where("run.source_id < doc_id")
    pieces = pieces.select("doc_id", _tag("place").alias("tag"), F.struct((_start("place") + F.col("run.at")).alias("start"), "run.n", "run.source_id", "run.source_place").alias("piece"))
    grouped = pieces.groupBy("doc_id", "tag").agg(F.collect_list("piece").alias("pieces"))
    fields = [("tag", T.LongType()), ("start", T.LongType()), ("n_words", T.LongType()), ("source_id", named.schema["doc_id"].dataType), ("source_place", T.LongType())]
    schema = T.StructType([named.schema["doc_id"], *[T.StructField(n, t) for n, t in fields]])

    def join_up(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                flat = part.column("pieces").flatten()
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("pieces")).to_numpy())
                ids, place = flat.field("source_id"), flat.field("source_place")
                doc, start, n, order = in_step(doc, flat.field("start").to_numpy(), flat.field("n").to_numpy(), ids, place.to_numpy() >> SIZE_BITS)
                tags = part.column("tag").to_numpy()[doc]
                yield _batch(schema.names, part.column("doc_id").take(pa.array(doc)), tags, start, n + (k - 1), ids.take(pa.array(order)), place.take(pa.array(order)))

    spans = cut_table(grouped.mapInArrow(join_up, schema))
    drop_table(met)
    drop_table(runs)
    return spans


def _digest(words: list[bytes], start: int, n: int) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words[start : start + n]))


def verified(named: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans with the digest of the words at their source coordinates."""
    asked = spans.select(
        F.col("source_id").alias("doc_id"), _tag("source_place").alias("tag"), F.struct("source_place", "n_words").alias("ask")
    ).distinct()
    lists = asked.groupBy("doc_id", "tag").agg(F.collect_list("ask").alias("asked"))
    id_field = T.StructField("source_id", named.schema["doc_id"].dataType, True)
    schema = T.StructType([id_field, T.StructField("source_place", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("digest", T.BinaryType())])

    def read(batches):
        for batch in batches:
            for part, texts in chunks(batch, "body"):
                out = []
                for i, (text, asked) in enumerate(zip(texts, part.column("asked").to_pylist())):
                    words = (text or b"").split()
                    for x in asked:
                        place, n = x["source_place"], x["n_words"]
                        out.append((i, place, n, _digest(words, (place >> SIZE_BITS) & ((1 << START_BITS) - 1), n)))
                rows, places, sizes, digests = zip(*out)
                yield _batch(schema.names, part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(places, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()))

    digests = _with_spans(named, lists).select("doc_id", "tag", "body", "asked").mapInArrow(read, schema)
    return spans.join(digests, ["source_id", "source_place", "n_words"])


def _apply(rows: DataFrame, carry: bool) -> DataFrame:
    """Remove the verified words of each text; with `carry`, texts that lose none stay as they are."""
    fields = [rows.schema["doc_id"], *([rows.schema["row"]] if carry else [])]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, "body"):
                out = []
                for text, spans in zip(texts, part.column("spans").to_pylist()):
                    words = (text or b"").split()
                    gone = np.zeros(len(words) + 1, np.int32)
                    for x in spans or ():
                        if _digest(words, x["start"], x["n_words"]) == x["digest"]:
                            gone[x["start"]] += 1
                            gone[x["start"] + x["n_words"]] -= 1
                    if spans:
                        stay = (np.cumsum(gone)[:-1] == 0).tolist()
                        kept = [w for w, s in zip(words, stay) if s]
                    else:
                        kept = words
                    whole = carry and len(kept) == len(words)
                    out.append((len(words), len(words) - len(kept), text if whole else b" ".join(kept)))
                counts, removed, kept = zip(*out)
                rest = [part.column("row")] if carry else []
                text = pa.array(kept, pa.binary()).cast(pa.string())
                yield _batch(schema.names, part.column("doc_id"), *rest, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), text)

    return rows.mapInArrow(run, schema)


def _deduplicated(docs: DataFrame, k: int, id_col: str, text_col: str, carry: bool) -> DataFrame:
    rows = _rows(docs, id_col, text_col, carry)
    named, nameless = rows.where("doc_id is not null"), rows.where("doc_id is null")
    plain = named.drop("row")
    spans = verified(plain, repeated_spans(plain, k))
    lists = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n_words", "digest")).alias("spans"))
    none = F.lit(None).cast(lists.schema["spans"].dataType).alias("spans")
    order = ["doc_id", "tag", "body", *(["row"] if carry else []), "spans"]
    return _apply(_with_spans(named, lists, "left").select(order), carry).union(_apply(nameless.select("*", none).select(order), carry))


def remove_repeats(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without the words of windows that a smaller document has."""
    return _deduplicated(docs, k, id_col, text_col, carry=False)


def rewrite(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns; texts that lose words are their kept words joined by blanks, others stay as they are."""
    done = _deduplicated(docs, k, id_col, text_col, carry=True)
    return done.select(*[(F.col("kept") if c == text_col else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(docs.columns)])
