"""Tab-separated tables: scan with types by position or as text, missing spellings, row order, sink."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapwright.functions import scalars as S
from gapwright.operators.shape import normalize_missing, quoted, render_all

# Row order of a scan: which file, and the row's number in it, from 0 and without gaps.
SCAN_ORDER = ["_file", "_line"]

# Casts are lenient: text that is no number is missing.
TYPE_CODES = {"c": None, "i": S.lenient_int, "d": S.lenient_double}


def read_text_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scan with every column as text, names from the header, blanks trimmed, empty cells missing.

    Only the first header line is read ahead; a file with another header is an error, not a shift.
    """
    return (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(paths)
    )


def number_rows(df: DataFrame, pieces: bool = False) -> DataFrame:
    """`df` with `_file` and `_line`, the row's number in its file. Call it right on a file scan.

    With `pieces` the files of a folder are pieces of one file, in order of their names, as Spark's sorted writes
    leave them: `_file` is the folder, and numbers go on from piece to piece.

    A task numbers its rows upwards, so that a split's rows have consecutive numbers from some start. The rows of
    each split are counted in a scan without columns; prefix sums over a file's splits turn the task's numbers
    into the file's. The two scans deal out splits alike, as both list the same files under one setting. The
    table of splits has as many rows as the scan has splits and is joined to them by Spark's measured size.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_piece"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    of = F.regexp_replace("_piece", "/[^/]*$", "") if pieces else F.col("_piece")
    splits = placed.groupBy("_piece", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(of).orderBy("_piece", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    numbered = placed.join(splits.select("_piece", "_block", shift), ["_piece", "_block"])
    return numbered.select(*map(quoted, df.columns), of.alias("_file"), (F.col("_row") + F.col("_shift")).alias("_line"))


def with_row_order(df: DataFrame, order_by: Sequence[str] | None = None, pieces: bool = False) -> tuple[DataFrame, list[str]]:
    """(table, row order columns). Call it right on a file scan, before anything that shuffles.

    `order_by` names columns that give the order already; the last must be a whole number that counts
    rows (see `chunk_value`). Without it every row gets a place of its own, see `number_rows`.
    """
    if order_by:
        return df, list(order_by)
    return number_rows(df, pieces), list(SCAN_ORDER)


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    missing: Sequence[str] = (),
    codes: str | None = None,
    order_by: Sequence[str] | None = None,
    pieces: bool = False,
) -> tuple[DataFrame, list[str]]:
    """(table, row order columns): text scan with the missing spellings as NULL.

    `codes` gives types by position, one letter per column: c text, i whole number, d number. `pieces`: see
    `number_rows`.
    """
    raw = read_text_table(spark, paths)
    names = raw.columns
    placed, order = with_row_order(raw, order_by, pieces)
    values = normalize_missing(placed, missing) if missing else placed
    if codes is not None:
        if len(codes) != len(names) or set(codes) - set(TYPE_CODES):
            raise ValueError(f"type codes {codes!r} do not fit {len(names)} columns")
        casts = {name: TYPE_CODES[code] for name, code in zip(names, codes, strict=True)}
        values = values.select(
            *[(casts[n](quoted(n)).alias(n) if casts.get(n) else quoted(n)) for n in values.columns]
        )
    return values, order


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and from its root, spelled one way."""
    raw = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = raw.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(raw).toUri().normalize()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}".rstrip("/")


def write_records(
    df: DataFrame,
    path: str,
    read_from: Sequence[str | Sequence[str]] = (),
    missing: str = "n/a",
    overwrite: bool = False,
    by: Sequence[str] = (),
) -> None:
    """All columns as text, missing spelled out, tab separated with a header, one file per task.

    An output that exists is an error unless `overwrite` is set. The output must not be, hold or lie in a
    path that is being read, however it is spelled: Spark would delete its own input. `by` columns become folders.

    The rows are written beside the target, under a name that scans skip, and moved there when all of them are
    written: a job that fails leaves an existing output as it was, and no part of a new one.
    """
    spark = df.sparkSession
    out = qualified(spark, path)
    for source in [p for paths in read_from for p in ([paths] if isinstance(paths, str) else paths)]:
        given = qualified(spark, source)
        if f"{given}/".startswith(f"{out}/") or f"{out}/".startswith(f"{given}/"):
            raise ValueError(f"output path {path!r} overlaps the input path {source!r}")
    target = spark._jvm.org.apache.hadoop.fs.Path(out)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target) and not overwrite:
        raise ValueError(f"output path {path!r} exists")
    beside = lambda what: spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{what}-{target.getName()}-{uuid.uuid4().hex}")
    staged, former = beside("staged"), beside("former")
    rendered = render_all(df, missing)
    try:
        writer = rendered.write.option("sep", "\t").option("header", True).option("escape", '"')
        (writer.partitionBy(*by) if by else writer).csv(staged.toString())
        if system.exists(target):
            _move(system, target, former)
        try:
            _move(system, staged, target)
        except Exception:
            if system.exists(former):
                _move(system, former, target)
            raise
        system.delete(former, True)
    finally:
        system.delete(staged, True)


def _move(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")
