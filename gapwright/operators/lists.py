"""Lists in a cell, in row order.

A list cell is as long as its group, whatever built it. What can be spread is the work on the rows:
rows are first joined to text in bounded chunks, and only the finished chunk texts meet in the group.
The caller says what it knows of the groups:

* `small`: every group fits a task many times over; one shuffle on the key builds the lists;
* `placed`: nearly every row has a place of its own, as rows of a scan have; a chunk is a range of places, so
  that the first of two shuffles needs no order;
* `any`: rows may lack a place or share one, in any number. Equal rows are counted, the rest is range-partitioned
  and sorted by key, place and item, and a chunk is a run of consecutive rows: never more than `CHUNK_ROWS` rows,
  and no task gets more than its range, whatever the groups are like.

`list_chunks` stops before the last step, for groups whose cell would pass Spark's 2 GB limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwright.functions import scalars as S
from gapwright.functions.aggregates import Staged, row_parts
from gapwright.operators.shape import CHUNK_ROWS, chunk_value, distinct_with_order, order_value, quoted

CHUNK = "_chunk"
GROUPS = ("small", "placed", "any")


def joined_in_order(item: Column, order: Column, sep: str = ";", where: Column | None = None) -> Column:
    """Aggregate: the items of one bounded chunk, joined in order. Equal places are ordered by item."""
    entry = F.struct(order.alias("at"), S.or_na(item).alias("item"))
    if where is not None:
        entry = F.when(where, entry)
    entries = F.array_sort(F.collect_list(entry))
    text = F.array_join(F.transform(entries, lambda e: e["item"]), sep)
    return F.when(F.size(entries) > 0, text)


def joined_chunks(text: Column, sep: str = ";", chunk: Column | None = None) -> Column:
    """Aggregate: chunk texts to the whole list, in chunk order."""
    entry = F.struct((F.col(CHUNK) if chunk is None else chunk).alias("at"), text.alias("item"))
    chunks = F.array_sort(F.collect_list(F.when(text.isNotNull(), entry)))
    return F.when(F.size(chunks) > 0, F.array_join(F.transform(chunks, lambda e: e["item"]), sep))


def list_chunks(
    df: DataFrame, keys: Sequence[str], items: Mapping[str, Column], order_by: Sequence[str], sep: str = ";"
) -> DataFrame:
    """One row per key and chunk with the chunk's list text; sorted by `_chunk` they make the list."""
    return df.groupBy(*map(quoted, keys), chunk_value(order_by).alias(CHUNK)).agg(
        *[joined_in_order(item, order_value(order_by), sep).alias(name) for name, item in items.items()]
    )


def consecutive_chunks(df: DataFrame, by: Sequence[str], rows: int = CHUNK_ROWS) -> DataFrame:
    """`df` sorted by `by` over all partitions, with `_chunk`: numbers of runs of at most `rows` rows, rising like the rows.

    A partition's rows are numbered upwards from a start that rises from partition to partition, so that dividing
    the number gives chunks in order. `rows` is a power of two, as the starts are.
    """
    if rows & (rows - 1):
        raise ValueError(f"rows must be a power of two, not {rows}")
    dealt = df.repartitionByRange(*map(quoted, by)).sortWithinPartitions(*map(quoted, by))
    return dealt.withColumn(CHUNK, F.shiftright(F.monotonically_increasing_id(), rows.bit_length() - 1))


def _lists_of_any_groups(
    df: DataFrame,
    keys: Sequence[str],
    items: Mapping[str, Column],
    order_by: Sequence[str],
    also: Mapping[str, Staged],
    sep: str,
    where: Mapping[str, Column],
    chunk_rows: int,
) -> DataFrame:
    """Each list is sorted on its own, as equal places are ordered by item; the other aggregates go with the first."""
    stages = list(also.values())
    parts = [name for staged in stages for name in staged.merge]
    entries = [
        F.struct(
            F.lit(i).alias("_list"),
            F.coalesce(where.get(name, F.lit(True)), F.lit(False)).alias("_in"),
            S.or_na(item).cast("string").alias("_item"),
        )
        for i, (name, item) in enumerate(items.items())
    ]
    rows = df.withColumns(row_parts(stages))
    rows = rows.select(*map(quoted, [*keys, *order_by, *parts]), F.inline(F.array(*entries)))
    first = F.col("_list") == 0
    # where a row is in no list but the first, only its parts count
    rows = rows.where(F.col("_in") | first).withColumns({p: F.when(first, quoted(p)) for p in parts})
    rows = rows.withColumn("_item", F.when(F.col("_in"), F.col("_item")))
    same = [*keys, "_list", *order_by, "_in", "_item"]
    counted = rows.groupBy(*map(quoted, same)).agg(F.count(F.lit(1)).alias("_times"), *[part for s in stages for part in s.combine()])
    run = F.array_join(F.array_repeat("_item", F.col("_times").cast("int")), sep)
    entry = F.when(F.col("_in"), F.struct(order_value(order_by).alias("at"), F.col("_item").alias("item"), run.alias("run")))
    chunks = (
        consecutive_chunks(counted, same, chunk_rows)
        .groupBy(*map(quoted, keys), "_list", CHUNK)
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"), *[part for s in stages for part in s.combine()])
    )
    text = F.when(F.size("_entries") > 0, F.array_join(F.transform("_entries", lambda e: e["run"]), sep))
    chunks = chunks.withColumn("_text", text)
    return chunks.groupBy(*map(quoted, keys)).agg(
        *[joined_chunks(F.when(F.col("_list") == i, F.col("_text")), sep).alias(name) for i, name in enumerate(items)],
        *[staged.finish().alias(name) for name, staged in also.items()],
    )


def ordered_lists(
    df: DataFrame,
    keys: Sequence[str],
    items: Mapping[str, Column],
    order_by: Sequence[str],
    also: Mapping[str, Staged] | None = None,
    sep: str = ";",
    where: Mapping[str, Column] | None = None,
    groups: str = "placed",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Per key: each item column joined in row order, duplicates kept, missing spelled `NA`.

    `also` takes further aggregates along in the same steps; `where` leaves rows out of one list; `groups` is what
    is known of the groups, see above.
    """
    also, where = also or {}, where or {}
    if groups not in GROUPS:
        raise ValueError(f"groups must be one of {', '.join(GROUPS)}, not {groups!r}")
    if groups == "any":
        return _lists_of_any_groups(df, keys, items, order_by, also, sep, where, chunk_rows)
    rows = df.withColumns(row_parts(also.values()))
    lists = [joined_in_order(item, order_value(order_by), sep, where.get(name)).alias(name) for name, item in items.items()]
    if groups == "small":
        return rows.groupBy(*map(quoted, keys)).agg(*lists, *[staged.finish().alias(name) for name, staged in also.items()])
    chunks = rows.groupBy(*map(quoted, keys), chunk_value(order_by).alias(CHUNK)).agg(
        *lists, *[part for staged in also.values() for part in staged.combine()]
    )
    return chunks.groupBy(*map(quoted, keys)).agg(
        *[joined_chunks(F.col(name), sep).alias(name) for name in items],
        *[staged.finish().alias(name) for name, staged in also.items()],
    )


def ordered_distinct_lists(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    values: Sequence[str],
    order_by: Sequence[str],
    item: Column | None = None,
    sep: str = ";",
    groups: str = "placed",
) -> DataFrame:
    """Per key: the distinct values (or value tuples) in order of first occurrence.

    `item` is the text of a tuple, by default its first column.
    """
    first = distinct_with_order(df.select(*map(quoted, [*keys, *values, *order_by])), order_by)
    return ordered_lists(first, keys, {name: quoted(values[0]) if item is None else item}, order_by, sep=sep, groups=groups)
