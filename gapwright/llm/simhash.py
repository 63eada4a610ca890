"""SimHash near-duplicates, found by vantage points.

Vantage points are a few fingerprints of the table. The distance of a fingerprint to a vantage point is taken
over blocks of bits; its cell is the vector of these block distances, the node of the tree it lies in. By the
triangle inequality, block by block, two fingerprints within r bits lie in cells whose vectors differ by at
most r in sum, so every fingerprint visits just the cells within r of its own, and all others are pruned. In
a large cell a second vantage point prunes again. Cells are keys of a shuffle: owners of a cell are held,
visitors stream past them, and large tables deal the visitors of a cell to several tasks.

Copies count once: the search runs over distinct fingerprints. What a cell finds leaves it as one link a
member (to the smallest member it hangs together with there), never as all pairs.

Missing and blank texts have fingerprint zero and are linked like others. A missing id never names a
component unless all its members' ids are missing. Repeated rows stay. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwright.llm.common import LOWER, cut_table, field_of, id_and_text, map_chunks
from gapwright.llm.components import components

#: Blocks of bits a distance is taken over, and the base that packs block distances into a key.
BLOCKS, BASE = 3, 32

#: Distinct fingerprints for each task that the visitors of a cell are dealt to.
ROWS_A_DEAL = 4_000_000

#: Pairs that are compared at a time, and owners from which the second vantage point is used.
PAIRS, LARGE = 2_000_000, 4_096


def masks(level: int) -> list[int]:
    """The blocks of bits of a level: each level cuts another order of the 64 bits."""
    order = np.random.default_rng(level).permutation(64) if level else np.arange(64)
    return [sum(1 << int(i) for i in part) for part in np.array_split(order, BLOCKS)]


def steps(radius: int) -> list[int]:
    """Key differences of the cells within the radius, the own one (0) included."""
    near = range(-radius, radius + 1)
    found = [d for d in product(near, repeat=BLOCKS) if sum(map(abs, d)) <= radius]
    return sorted(sum(x * BASE**i for i, x in enumerate(reversed(d))) for d in found)


def fingerprint_of(words: list[bytes], size: int) -> list[int]:
    """Hashes of a document's shingles; a shorter one is a single shingle."""
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(text[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist())]


def majority(hashes: list[int], sizes: list[int]) -> np.ndarray:
    """For runs of hashes, the bits that are set in over half of each run."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        counts = np.asarray(sizes, np.int64)[some]
        bits = np.unpackbits(np.asarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, np.cumsum(counts) - counts, axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", tagged: bool = False) -> DataFrame:
    """(doc_id, fingerprint): 64 bits as a long, from XXH64 of the lower-cased word shingles; `tagged`: with the text's tag."""
    rows = id_and_text(docs, id_col, text_col)
    if tagged:
        rows = rows.withColumn("tag", text_tag(F.col("text")))
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    carried = [c for c in rows.columns if c != "text"]
    schema = T.StructType([*[field_of(rows, c) for c in carried], T.StructField("fingerprint", T.LongType(), False)])

    def make():
        def work(part, texts):
            hashes: list[int] = []
            sizes = []
            for text in texts:
                found = fingerprint_of(text.translate(LOWER).split(), shingle) if text else []
                hashes += found
                sizes.append(len(found))
            prints = pa.array(majority(hashes, sizes).view(np.int64))
            yield pa.RecordBatch.from_arrays([*map(part.column, carried), prints], names=schema.names)

        return work

    return map_chunks(rows, make, schema)


def keys_of(prints: np.ndarray, vantage: int, level: int) -> np.ndarray:
    """The cell of each fingerprint: block distances to the vantage point, packed."""
    apart = prints ^ np.uint64(vantage)
    key = np.zeros(len(prints), np.int64)
    for mask in masks(level):
        key = key * BASE + np.bitwise_count(apart & np.uint64(mask))
    return key


def close_pairs(visitors: np.ndarray, owners: np.ndarray, radius: int, second: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the radius, some at a time."""
    if len(owners) < LARGE:
        rows = max(1, PAIRS // max(1, len(owners)))
        for at in range(0, len(visitors), rows):
            i, j = np.nonzero(np.bitwise_count(visitors[at : at + rows, None] ^ owners[None, :]) <= radius)
            yield i + at, j
        return
    inner = keys_of(owners, second, 1)
    order = np.argsort(inner, kind="stable")
    inner = inner[order]
    own = keys_of(visitors, second, 1)
    for step in steps(radius):
        low, high = np.searchsorted(inner, own + step, "left"), np.searchsorted(inner, own + step, "right")
        some = np.flatnonzero(high > low)
        while len(some):
            counts = high[some] - low[some]
            take = max(1, int(np.searchsorted(np.cumsum(counts), PAIRS)))
            now, some, counts = some[:take], some[take:], counts[:take]
            i = np.repeat(now, counts)
            j = order[np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[now], counts)]
            near = np.bitwise_count(visitors[i] ^ owners[j]) <= radius
            yield i[near], j[near]


def hook(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (indices of smaller members) after the links i-j."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(labels, up := labels[labels]):
            labels = up


class Cell:
    """Owners of one cell and how they hang together so far."""

    def __init__(self, radius: int, second: int):
        self.radius, self.second = radius, second
        self.parts: list[np.ndarray] = []
        self.owners: np.ndarray | None = None

    def close(self) -> None:
        if self.owners is None:
            self.owners = np.sort(np.concatenate(self.parts)) if self.parts else np.zeros(0, np.uint64)
            self.labels = np.arange(len(self.owners))
            self.link(self.owners, 0)

    def link(self, visitors: np.ndarray, first: int) -> None:
        for i, j in close_pairs(visitors, self.owners, self.radius, self.second):
            self.labels = hook(self.labels, i + first, j)

    def visit(self, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of visitors that are near an owner, as (visitor, owner)."""
        self.close()
        n = len(self.owners)
        if not n:
            return visitors[:0], visitors[:0]
        self.labels = np.concatenate([self.labels, np.arange(n, n + len(visitors))])
        self.link(visitors, n)
        roots, self.labels = self.labels[n:], self.labels[:n]
        found = roots < n
        return visitors[found], self.owners[roots[found]]

    def end(self) -> tuple[np.ndarray, np.ndarray]:
        self.close()
        found = self.labels != np.arange(len(self.labels))
        return self.owners[found], self.owners[self.labels[found]]


def close_links(prints: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between distinct fingerprints that hang together exactly as all pairs within the radius do."""
    points = [r[0] % 2**64 for r in prints.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(2).collect()] or [0]
    first, second = points[0], points[-1]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    key = F.lit(0)
    for mask in masks(0):
        key = key * BASE + F.bit_count(F.col("fingerprint").bitwiseXOR(F.lit(signed(first))).bitwiseAND(F.lit(signed(mask))))
    # the margin keeps a visitor's digits apart when it steps below zero
    key = key + sum(radius * BASE**i for i in range(BLOCKS))
    deals = -(-prints.count() // ROWS_A_DEAL) or 1
    cells = prints.select("fingerprint", key.alias("own"))
    onward = F.array(*[F.lit(d) for d in steps(radius) if d > 0])
    visits = cells.select(F.explode(F.transform(onward, lambda step: F.col("own") + step)).alias("cell"), F.pmod(F.xxhash64("fingerprint"), F.lit(deals)).cast("int").alias("deal"), F.lit(True).alias("visitor"), "fingerprint")
    owns = cells.select(F.col("own").alias("cell"), F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"), F.lit(False).alias("visitor"), "fingerprint")

    def run(batches):
        at, cell = None, Cell(radius, second)

        def out(*links):
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*links))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            place = batch.column("cell").to_numpy() * np.int64(deals) + batch.column("deal").to_numpy()
            visitor = batch.column("visitor").to_numpy(zero_copy_only=False)
            values = batch.column("fingerprint").to_numpy().view(np.uint64)
            borders = np.flatnonzero((place[1:] != place[:-1]) | (visitor[1:] != visitor[:-1])) + 1
            links = []
            for a, b in zip([0, *borders.tolist()], [*borders.tolist(), len(place)]):
                if a == b:
                    continue
                if place[a] != at:
                    links.append(cell.end())
                    at, cell = place[a], Cell(radius, second)
                if visitor[a]:
                    links.append(cell.visit(values[a:b]))
                else:
                    cell.parts.append(values[a:b].copy())
            if links:
                yield out(*links)
        yield out(cell.end())

    dealt = visits.union(owns).repartition("cell", "deal").sortWithinPartitions("cell", "deal", "visitor")
    return dealt.mapInArrow(run, "a long, b long")


def component_ids(prints: DataFrame, radius: int, name: Column) -> DataFrame:
    """`prints` (doc_id, fingerprint, ...) with component_id: the smallest `name` that links of at most `radius` bits reach."""
    classes = cut_table(prints.groupBy("fingerprint").agg(F.min(name).alias("first_id")))
    roots = components(close_links(classes, radius)).select(F.col("node").alias("fingerprint"), "root")
    grouped = classes.join(roots, "fingerprint")
    firsts = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = grouped.join(firsts, "root").select("fingerprint", F.col("component_id").alias("linked_id"))
    # cut, so that the join below shuffles plain tables and can split the rows of a fingerprint with many copies
    named = cut_table(classes.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("linked_id", "first_id").alias("component_id")))
    return prints.join(named, "fingerprint")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest id that links of at most `radius` bits reach."""
    prints = cut_table(fingerprints(docs, shingle, id_col, text_col))
    return component_ids(prints, radius, F.col("doc_id")).select("doc_id", "fingerprint", "component_id")


def text_tag(text: Column) -> Column:
    """What tells texts of one id apart: a missing text has a tag of its own."""
    return F.coalesce(F.sha2(text.cast("string"), 256), F.lit(""))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns as they came: that of the smallest id, rows without an id last.

    A row is known by its id and its own text; of texts with one id that of the smallest SHA-256 stays, a missing
    text first. Of rows that are equal in both any one stays.
    """
    prints = cut_table(fingerprints(docs, shingle, id_col, text_col, tagged=True))
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "tag")
    found = component_ids(prints, radius, row)
    kinds = found.groupBy("doc_id", "tag", row.eqNullSafe(F.col("component_id")).alias("first")).agg(F.count("*").alias("rows"))
    # what goes (all rows of an id and text), and what stays once although it comes several times
    kinds = cut_table(kinds.where("not first or rows > 1").select(F.col("doc_id").alias("_key_id"), F.col("tag").alias("_key_tag"), "first"))
    repeated = kinds.where("first").drop("first")
    # by place, so that no column of the input can clash
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    same = own_id.eqNullSafe(F.col("_key_id")) & (text_tag(own_text) == F.col("_key_tag"))
    kept = plain.join(kinds.drop("first"), same, "left_anti")
    if not repeated.isEmpty():
        # rows of a key are reduced to one before they are shuffled
        again = plain.join(repeated, same).dropDuplicates(["_key_id", "_key_tag"]).select(plain.columns)
        kept = kept.unionByName(again)
    return kept.toDF(*docs.columns)
