"""What several operators share: inputs, words, chunks of Arrow batches, cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
SPACES = "[\\x20\\x09-\\x0D]+"

#: Characters of text that a Python task holds in unpacked form at a time (one document may exceed it).
CHUNK_CHARS = 2_000_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that count, under plain names; whatever else the input carries can't clash."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def field_of(df: DataFrame, name: str) -> T.StructField:
    return T.StructField(name, df.schema[name].dataType, True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a folder of our own only where none is named on a local master (tests)."""
    context = spark.sparkContext
    where = context.getCheckpointDir()
    if where is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        where = where or tempfile.mkdtemp(prefix="gapwright-")
        context.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """The same rows read from the shared checkpoint folder: a lost executor costs no recomputation before here."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_table(df: DataFrame) -> DataFrame:
    """The same rows as a Parquet table in the shared checkpoint folder, for tables that later steps read by column.

    The shuffles that made it have done their work and their files are given back at once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(table: DataFrame) -> None:
    """Delete a table of `cut_table` that nothing will read again."""
    spark = table.sparkSession
    root = checkpoint_dir(spark)
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("table-") and path.getParent().getName() == root.rstrip("/").rpartition("/")[2]:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def ascii_words(text: Column) -> Column:
    """Words between white space, unchanged; none for a missing or blank text."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES, -1))


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch with their texts (missing: None), each of about `limit` bytes of text or one document."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            part = batch.slice(start, i - start)
            yield part, part.column(column).to_pylist()
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        part = batch.slice(start)
        yield part, part.column(column).to_pylist()


def map_chunks(df: DataFrame, make: Callable[[], Callable], schema: T.StructType, column: str = "text") -> DataFrame:
    """`make()` is called once a task; its result turns (slice, texts) into record batches of `schema`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, texts in chunks(batch, column):
                yield from work(part, texts)

    return df.mapInArrow(run, schema)
