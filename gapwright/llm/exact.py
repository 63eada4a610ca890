"""Exact dedup by a Golomb-coded exchange of fingerprints.

Texts are equal if they are the same bytes once white space is deleted. A row's fingerprint is the front of
the SHA-256 of those bytes.

1. The documents are read once: a thin table keeps each row's place, id, length and digest.
2. Each sender (the rows of one file that a task reads) sorts its distinct fingerprints, deals them by their
   top bits to owners and codes each owner's list as gaps, Golomb-coded with a parameter that is a power of two.
3. An owner decodes the lists it gets, finds the fingerprints that several senders hold, and answers each list
   with a bitmap. A sender marks the rows of those fingerprints, and of fingerprints it holds twice itself.
4. The marks are bitmaps over places. The documents are read again, and only marked rows (suspects) are
   shuffled by their whole normal text: grouping by that text compares bytes. A fingerprint shared by chance
   leaves a group of one text, which is no duplicate.
5. Digests of verified texts stand for them in the joins back to the thin rows. Two different texts of one
   digest, which nobody has ever seen, raise an error.

No list of a group is gathered: groups are counts and minima, combined in tasks before they are shuffled, and a
group of a third of all rows sends each owner one fingerprint a sender. Marks are broadcast only up to
`MARK_BYTES`; beyond, the documents are read in rounds of files whose marks stay below it.

Missing texts count as empty; rows without an id are like others (an id comes before none among equals). Of rows
that are equal in length and id, the first by place stays. Rows that repeat are rows of one group. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwright.llm.common import SPACE, chunks, cut_table, drop_table, field_of, id_and_text

#: Bits of a fingerprint. Chance meetings of N rows are about N * N / 2 ** (BITS + 1), and cost a comparison each.
BITS = 48

#: Fingerprints that an owner is given on average at most, and the least number of owners (powers of two).
PER_OWNER, LEAST_OWNERS = 1 << 22, 64

#: Rows of one sender at most.
SENDER_ROWS = 1 << 20

#: Bytes of marks that are broadcast at once.
MARK_BYTES = 64 << 20

#: Places that one bitmap of Spark's bitmap functions covers, and its bytes.
MARK_ROWS, MARK_SIZE = 32_768, 4_096


def golomb(values: np.ndarray, span: int) -> bytes:
    """Sorted distinct numbers below `span` as gaps: quotients in unary, then remainders of `k` bits."""
    if len(values) == 0:
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    k = max(0, int(0.69 * span / len(values)).bit_length() - 1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return bytes([k]) + len(unary).to_bytes(8, "little") + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def ungolomb(code: bytes, n: int) -> np.ndarray:
    """The numbers of `golomb`."""
    if n == 0:
        return np.zeros(0, np.uint64)
    k, bits = code[0], int.from_bytes(code[1:9], "little")
    middle = 9 + (bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, middle - 9, 9), count=bits))
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        rest = np.unpackbits(np.frombuffer(code, np.uint8, -1, middle), count=n * k).reshape(n, k)
        gaps += (rest.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def placed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(file, at, doc_id, text): rows with the place in their file. Input that is no file scan becomes a table first."""
    names = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    columns = [docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")]
    try:
        return docs.select(*names, *columns), False
    except AnalysisException:
        table = cut_table(id_and_text(docs, id_col, text_col))
        return table.select(*names, "doc_id", "text"), True


def thin_rows(rows: DataFrame) -> DataFrame:
    """Place, id, code points and digest of the normal text, of every row."""
    strip = bytes(SPACE, "ascii")

    def run(batches):
        for batch in batches:
            for part, _ in chunks(batch):
                texts = pc.fill_null(part.column("text"), "")
                digests = [hashlib.sha256(t.translate(None, strip)).digest() for t in texts.cast(pa.binary()).to_pylist()]
                columns = [part.column(c) for c in ("file", "at", "doc_id")]
                yield pa.RecordBatch.from_arrays([*columns, pc.utf8_length(texts).cast(pa.int64()), pa.array(digests, pa.binary())], names=["file", "at", "doc_id", "chars", "digest"])

    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("at", T.LongType()), field_of(rows, "doc_id"), T.StructField("chars", T.LongType()), T.StructField("digest", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def fingerprints(digests: list[bytes], size: int) -> np.ndarray:
    """The first bits of each digest."""
    joined = np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)
    return joined >> np.uint64(64 - size)


def owners_for(rows: int) -> int:
    """Bits of the number of owners."""
    return (max(LEAST_OWNERS, -(-rows // PER_OWNER)) - 1).bit_length()


MESSAGES = "file string, start long, owner int, n int, code binary, places binary, counts binary"


def send(thin: DataFrame, owner_bits: int, size: int = BITS) -> DataFrame:
    """A row for each sender and owner: the coded fingerprints, and for the sender's own use the places behind each."""
    low = np.uint64(size - owner_bits)

    def messages(file: str, places: np.ndarray, prints: np.ndarray):
        order = np.argsort(prints, kind="stable")
        values, first, counts = np.unique(prints[order], return_index=True, return_counts=True)
        start = int(places[0])
        offsets = (places[order] - start).astype(np.uint32)
        owners = (values >> low).astype(np.int64)
        edges = np.flatnonzero(np.diff(owners, prepend=-1, append=1 << 40))
        rows = []
        for a, b in zip(edges[:-1], edges[1:]):
            own = values[a:b] & ((np.uint64(1) << low) - np.uint64(1))
            end = first[b] if b < len(first) else len(offsets)
            rows.append((file, start, int(owners[a]), int(b - a), golomb(own, 1 << int(low)), offsets[first[a] : end].tobytes(), counts[a:b].astype(np.uint32).tobytes()))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "start", "owner", "n", "code", "places", "counts"])

    def run(batches):
        file, held, n = None, [], 0
        for batch in batches:
            names = batch.column("file").to_pylist()
            at, prints = batch.column("at").to_numpy(), fingerprints(batch.column("digest").to_pylist(), size)
            edges = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and (names[a] != file or n >= SENDER_ROWS):
                    yield messages(file, *map(np.concatenate, zip(*held)))
                    held, n = [], 0
                file = names[a]
                held.append((at[a:b], prints[a:b]))
                n += b - a
        if held:
            yield messages(file, *map(np.concatenate, zip(*held)))

    return thin.select("file", "at", "digest").mapInArrow(run, MESSAGES)


def answers(messages: DataFrame) -> DataFrame:
    """Each owner's bitmap for each list: which of its fingerprints another list holds, too."""

    def judge(table: pa.Table) -> pa.Table:
        lists = [ungolomb(code, n) for code, n in zip(table.column("code").to_pylist(), table.column("n").to_pylist())]
        every = np.sort(np.concatenate(lists))
        again = np.unique(every[1:][every[1:] == every[:-1]])
        maps = [np.packbits(np.isin(values, again, assume_unique=True)).tobytes() for values in lists]
        return pa.table([table.column("file"), table.column("start"), table.column("owner"), pa.array(maps, pa.binary())], names=["file", "start", "owner", "map"])

    sent = messages.select("file", "start", "owner", "n", "code")
    return sent.groupBy("owner").applyInArrow(judge, "file string, start long, owner int, map binary")


def marks(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """(file, part, bits): a bitmap of the suspects among each MARK_ROWS places of a file."""

    def run(batches):
        for batch in batches:
            files, places = [], []
            columns = [batch.column(c).to_pylist() for c in ("file", "start", "n", "map", "places", "counts")]
            for file, start, n, bits, offsets, counts in zip(*columns):
                counts = np.frombuffer(counts, np.uint32)
                hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) | (counts > 1)
                rows = np.frombuffer(offsets, np.uint32)[np.repeat(hit, counts)].astype(np.int64) + start
                files += [file] * len(rows)
                places.append(rows)
            if files:
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(np.concatenate(places))], names=["file", "at"])

    met = messages.join(replies, ["file", "start", "owner"]).select("file", "start", "n", "map", "places", "counts")
    found = met.mapInArrow(run, "file string, at long")
    return found.groupBy("file", F.floor(F.col("at") / MARK_ROWS).alias("part")).agg(F.bitmap_construct_agg(F.col("at") % MARK_ROWS).alias("bits"))


def marked(at: Column, bits: Column) -> Column:
    """Whether a place is set in its bitmap; false without one."""
    place = (at % MARK_ROWS).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), place % 8 + 1)
    return F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))


def with_marks(rows: DataFrame, bits: DataFrame, limit: int = MARK_BYTES) -> DataFrame:
    """`rows` with `suspect`. The marks are broadcast; in rounds of files if together they are over `limit` bytes."""
    sizes = [(r.file, r.n * MARK_SIZE) for r in bits.groupBy("file").agg(F.count(F.lit(1)).alias("n")).orderBy("file").collect()]
    rounds, room = [[]], limit
    for file, size in sizes:
        if size > room and rounds[-1]:
            rounds.append([])
            room = limit
        rounds[-1].append(file)
        room -= size
    rows = rows.withColumn("part", F.floor(F.col("at") / MARK_ROWS))

    def met(some: DataFrame, marks: DataFrame, hint: bool) -> DataFrame:
        marks = F.broadcast(marks) if hint else marks
        return some.join(marks, ["file", "part"], "left").withColumn("suspect", marked(F.col("at"), F.col("bits"))).drop("part", "bits")

    total, by_file = sum(s for _, s in sizes), dict(sizes)
    if total <= limit:
        return met(rows, bits, True)
    done = rows.where(~F.col("file").isin([*by_file])).withColumn("suspect", F.lit(False)).drop("part")
    for files in rounds:
        own = F.col("file").isin(files)
        done = done.unionByName(met(rows.where(own), bits.where(own), sum(by_file[f] for f in files) <= limit))
    return done


def verified(suspects: DataFrame) -> DataFrame:
    """(digest, group_size) of texts that several rows have, byte for byte."""
    normal = F.translate(F.coalesce("text", F.lit("")), SPACE, "")
    texts = suspects.groupBy(normal.alias("normal")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = texts.groupBy(F.unhex(F.sha2("normal", 256)).alias("digest")).agg(F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    size = F.when(F.col("texts") > 1, F.raise_error(F.lit("two different texts have one digest")).cast("long")).otherwise(F.col("group_size"))
    return groups.select("digest", size.alias("group_size"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark_bytes: int = MARK_BYTES, size: int = BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row. The result reads tables in the shared folder."""
    rows, own = placed(docs, id_col, text_col)
    thin = cut_table(thin_rows(rows))
    messages = cut_table(send(thin, owners_for(thin.count()), size))
    bits = cut_table(marks(messages, answers(messages)))
    drop_table(messages)
    groups = cut_table(verified(with_marks(rows, bits, mark_bytes).where("suspect").select("text")))
    told = with_marks(thin, bits, mark_bytes)
    suspects = told.where("suspect").drop("suspect")
    # most code points, then the smallest id, then the first place
    rank = F.struct((-F.col("chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("doc_id"), F.col("file").alias("file"), F.col("at").alias("at"))
    best = suspects.join(groups, "digest").groupBy("digest", "group_size").agg(F.min(rank).alias("best"))
    met = suspects.join(cut_table(best), "digest", "left")
    lone = F.col("best").isNull()
    first = F.coalesce((F.col("best.file") == F.col("file")) & (F.col("best.at") == F.col("at")), F.lit(False))
    grouped = met.select("doc_id", F.when(lone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (lone | first).alias("kept"), "digest")
    single = told.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    if own:
        drop_table(rows)
    return grouped.unionByName(single)
