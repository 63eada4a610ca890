"""Projection, typing and row-order operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwright.functions import scalars as S

# Rows per chunk of an ordered list, and so the most rows that one task sorts for one list part.
CHUNK_ROWS = 1 << 16


def quoted(name: str) -> Column:
    """A column whose name may hold dots, spaces or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_missing(df: DataFrame, spellings: Iterable[str] = (), nan: bool = True) -> DataFrame:
    """Every spelling of the missing value, in text columns, and NaN in number columns become NULL."""
    spellings = list(spellings)
    out = []
    for name, dtype in df.dtypes:
        col = quoted(name)
        if dtype == "string" and spellings:
            col = F.when(~col.isin(spellings), col)
        elif dtype in ("double", "float") and nan:
            col = S.nan_to_null(col)
        out.append(col.alias(name))
    return df.select(*out)


def try_numeric(df: DataFrame, ints: Iterable[str] = (), doubles: Iterable[str] = ()) -> DataFrame:
    """Lenient casts of those columns that are present; text that is no number becomes NULL."""
    casts = {name: S.lenient_int for name in ints} | {name: S.lenient_double for name in doubles}
    return df.select(*[casts[n](quoted(n)).alias(n) if n in casts else quoted(n) for n in df.columns])


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Strict select and rename, {new name: source name}."""
    require_columns(df, columns.values())
    return df.select(*[quoted(src).alias(new) for new, src in columns.items()])


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    lacking = [n for n in names if n not in df.columns]
    if lacking:
        raise ValueError(f"columns not found: {', '.join(lacking)}")


def with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    """Names that start with one of the prefixes; may be none."""
    return [n for n in df.columns if n.startswith(prefixes)]


def one_matching(df: DataFrame, pattern: str) -> str:
    """The one column whose name matches, whatever its case."""
    hits = [n for n in df.columns if re.fullmatch(pattern, n, flags=re.IGNORECASE)]
    if len(hits) != 1:
        raise ValueError(f"{len(hits)} columns match {pattern!r}, need exactly one")
    return hits[0]


def first_present(df: DataFrame, *names: str) -> str:
    """The first of the names that the table has (a choice by schema, not by row)."""
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"none of the columns found: {', '.join(names)}")


def add_if_absent(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Typed all-missing columns, {name: type}, where the table lacks them."""
    lacking = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(lacking) if lacking else df


def layout(df: DataFrame, names: Sequence[str], prefixes_after: Mapping[str, str] | None = None) -> DataFrame:
    """Whitelist in a fixed column order; absent names are skipped, unlisted columns dropped.

    `prefixes_after` {name: prefix} puts all columns with the prefix behind that name.
    """
    order: list[str] = []
    for name in names:
        if name in df.columns:
            order.append(name)
        prefix = (prefixes_after or {}).get(name)
        if prefix:
            order += [n for n in with_prefix(df, prefix) if n not in names]
    return df.select(*[quoted(n) for n in order])


def upgrade_schema(
    df: DataFrame, old_key: str, new_key: str, renames: Mapping[str, str], add: Mapping[str, str]
) -> DataFrame:
    """Old table version (has `old_key`) to the new one: rename columns and add missing ones.

    All columns to rename are required. A table with both keys, or neither, is an error.
    """
    old, new = old_key in df.columns, new_key in df.columns
    if old == new:
        state = "both" if old else "neither"
        raise ValueError(f"need one of the columns {old_key!r} and {new_key!r}, found {state}")
    if new:
        return df
    require_columns(df, renames)
    return add_if_absent(df.withColumnsRenamed({old_key: new_key, **renames}), add)


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({n: n[len(prefix) :] for n in with_prefix(df, prefix)})


def render_all(df: DataFrame, missing: str = "n/a") -> DataFrame:
    """All columns as text, missing spelled out."""
    return df.select(*[S.render(quoted(n), t, missing).alias(n) for n, t in df.dtypes])


def distinct_with_order(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Distinct rows, apart from the order columns, each with the place of its first occurrence.

    Duplicates are removed on the map side, then on a hash of the whole row: no key can become hot.
    """
    values = [n for n in df.columns if n not in order_by]
    if len(order_by) == 1:
        return df.groupBy(*map(quoted, values)).agg(F.min(quoted(order_by[0])).alias(order_by[0]))
    first = df.groupBy(*map(quoted, values)).agg(F.min(F.struct(*map(quoted, order_by))).alias("_first"))
    return first.select(*map(quoted, values), *[F.col("_first").getField(n).alias(n) for n in order_by])


def order_value(order_by: Sequence[str]) -> Column:
    """One orderable value of the row order columns (the number itself if there is one)."""
    return quoted(order_by[0]) if len(order_by) == 1 else F.struct(*map(quoted, order_by))


def chunk_value(order_by: Sequence[str]) -> Column:
    """Chunk of a row: coarser than the row order but sorted like it.

    The last order column counts rows, so a chunk never holds more than CHUNK_ROWS distinct places.
    """
    coarse = F.floor(quoted(order_by[-1]) / CHUNK_ROWS).alias(order_by[-1])
    return F.struct(*map(quoted, order_by[:-1]), coarse)


def without_nan(df: DataFrame) -> DataFrame:
    """One missing value: NaN counts as NULL in every number column."""
    return df.select(
        # each column is named once, so that its expression may move into the step below
        *[F.nanvl(quoted(n), F.lit(None)).alias(n) if kind in ("double", "float") else quoted(n) for n, kind in df.dtypes]
    )


def must_have_rows(df: DataFrame, message: str) -> DataFrame:
    """`df`, which fails with `message` when it turns out to be empty, in the job that reads it.

    A count of the rows is attached as a branch that gives no row itself.
    """
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    failing = counted.where(F.assert_true(F.col("n") > 0, message).isNotNull())
    return df.unionByName(failing.select(*[F.lit(None).cast(kind).alias(name) for name, kind in df.dtypes]))
