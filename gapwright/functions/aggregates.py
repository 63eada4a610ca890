"""Aggregate builders (Columns for `groupBy(...).agg(...)`).

Every builder here is a sum, count, min, max or min_by, so Spark combines it on the map side and a
group of any size costs each task one buffer. Lists are the exception; they are built chunk by chunk
in `gapwright.operators.lists`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def _ratio(weighted: Column, weight: Column) -> Column:
    """One division of exact sums; zero or missing total weight gives missing."""
    return F.try_divide(weighted.cast("double"), F.nullif(weight.cast("double"), F.lit(0.0)))


def weighted_mean(x: Column, w: Column) -> Column:
    """Weighted mean without missing measures.

    Missing if no measure is left, the weights sum to zero, or a kept measure has no weight.
    """
    unweighted = F.count_if(x.isNotNull() & w.isNull())
    return F.when(unweighted == 0, _ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w))))


def weighted_mean_pairwise(x: Column, w: Column) -> Column:
    """Weighted mean over the rows that have both a measure and a weight."""
    return _ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def collapse_or_mixed(col: Column, mixed: str = "mixed") -> Column:
    """The group's one value, `mixed` if there are several (a missing one counts as a value)."""
    single = F.min(col).eqNullSafe(F.max(col)) & (F.count(col) == F.count(F.lit(1)))
    return F.when(F.count(col) == 0, F.lit(None).cast("string")).when(single, F.min(col)).otherwise(F.lit(mixed))


def collapse_list(col: Column, sep: str = ";", mixed: str = "mixed") -> Column:
    """`a;a;a` -> `a`, anything with two different parts -> `mixed`. One separator at the end is no part."""
    literal = "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    parts = F.array_distinct(F.split(F.regexp_replace(col, literal + "$", ""), literal))
    return F.when(F.size(parts) > 1, F.lit(mixed)).otherwise(F.get(parts, F.lit(0)))


def first_valid(col: Column, ord_: Column) -> Column:
    """First non-missing value in row order; missing if there is none."""
    return F.min_by(col, F.when(col.isNotNull(), ord_))


def max_strict(col: Column) -> Column:
    """Maximum, missing as soon as one value is."""
    return F.when(F.count(col) == F.count(F.lit(1)), F.max(col))


def max_valid(col: Column) -> Column:
    """Maximum of the non-missing values; missing if there is none."""
    return F.max(col)


def count_distinct_with_null(col: Column) -> Column:
    """Distinct values, the missing one counted as a value.

    Spark removes duplicates on (key, value) before it shuffles on the key, so a hot key is spread.
    """
    return F.count_distinct(F.struct(col))


def repeat_label(label: str | None, n: Column, sep: str = ";") -> Column:
    """`label` written n times with separators; missing for a missing label."""
    if label is None:
        return F.lit(None).cast("string")
    return F.concat(F.lit(label), F.repeat(F.lit(sep + label), (n - 1).cast("int")))


@dataclass(frozen=True)
class Staged:
    """An aggregate taken in any number of steps, such as per join key, per chunk, per group.

    `rows` are its parts for a single row, `merge` combines parts of one kind, `result` is the value
    over the last combination. Because parts combine again, a hot join key or chunk can be reduced
    before the next shuffle without changing the result.
    """

    rows: dict[str, Column]
    merge: dict[str, Callable[[Column], Column]]
    result: Callable[[dict[str, Column]], Column]

    def combine(self) -> list[Column]:
        """Aggregates that combine the parts, under the same names."""
        return [merge(F.col(name)).alias(name) for name, merge in self.merge.items()]

    def finish(self) -> Column:
        """The value, as an aggregate over parts."""
        return self.finish_where(None)

    def finish_where(self, where: Column | None) -> Column:
        """The value over those parts only that satisfy `where`."""
        return self.result(
            {
                name: merge(F.col(name) if where is None else F.when(where, F.col(name)))
                for name, merge in self.merge.items()
            }
        )

    def combine_over(self, window: WindowSpec, where: Column | None = None) -> list[Column]:
        """The parts of a window, of those rows only that satisfy `where`, under the same names."""
        cols = {name: F.col(name) if where is None else F.when(where, F.col(name)) for name in self.merge}
        return [merge(cols[name]).over(window).alias(name) for name, merge in self.merge.items()]

    def of_parts(self) -> Column:
        """The value of parts that are combined already."""
        return self.result({name: F.col(name) for name in self.merge})


def row_parts(stages: Iterable[Staged]) -> dict[str, Column]:
    return {name: col for staged in stages for name, col in staged.rows.items()}


def staged_count(name: str) -> Staged:
    n = f"{name}_n"
    return Staged({n: F.lit(1).cast("bigint")}, {n: F.sum}, lambda m: F.coalesce(m[n], F.lit(0)))


def staged_max(name: str, col: Column) -> Staged:
    top = f"{name}_max"
    return Staged({top: col}, {top: F.max}, lambda m: m[top])


def staged_max_strict(name: str, col: Column) -> Staged:
    """`max_strict` in steps. A row that has no parts at all must enter with `<name>_gap` true."""
    top, gap = f"{name}_max", f"{name}_gap"
    return Staged({top: col, gap: col.isNull()}, {top: F.max, gap: F.max}, lambda m: F.when(~m[gap], m[top]))


def mean_of(weighted: Column, weight: Column, low: Column, high: Column) -> Column:
    """The mean from its sums; that of equal measures is the measure, which no rounding of sums may change."""
    ratio = _ratio(weighted, weight)
    return F.when(ratio.isNotNull() & (low == high), low.cast("double")).otherwise(ratio)


def staged_weighted_mean(name: str, x: Column, w: Column, pairwise: bool = False, exact: bool = False) -> Staged:
    """`weighted_mean`, or its pairwise form, in steps. With `exact`, equal measures have themselves as mean."""
    xw, ww, bad, low, high = (f"{name}_{part}" for part in ("xw", "w", "bad", "low", "high"))
    rows = {xw: x * w, ww: F.when(x.isNotNull(), w)}
    merge: dict[str, Callable[[Column], Column]] = {xw: F.sum, ww: F.sum}
    if exact:
        rows |= {low: F.when(w.isNotNull(), x), high: F.when(w.isNotNull(), x)}
        merge |= {low: F.min, high: F.max}

    def mean(m: dict[str, Column]) -> Column:
        return mean_of(m[xw], m[ww], m[low], m[high]) if exact else _ratio(m[xw], m[ww])

    if pairwise:
        return Staged(rows, merge, mean)
    rows[bad] = x.isNotNull() & w.isNull()
    merge[bad] = F.max
    return Staged(rows, merge, lambda m: F.when(~m[bad], mean(m)))


def staged_first_valid(name: str, col: Column, ord_: Column) -> Staged:
    """`first_valid` in steps: the best value of each part, then the best of the parts."""
    val, at = f"{name}_first", f"{name}_first_at"
    return Staged(
        {val: col, at: F.when(col.isNotNull(), ord_)},
        {val: lambda c: F.min_by(c, F.col(at)), at: F.min},
        lambda m: m[val],
    )


def staged_collapse(name: str, col: Column, mixed: str = "mixed") -> Staged:
    """`collapse_or_mixed` in steps."""
    lo, hi, gap = f"{name}_lo", f"{name}_hi", f"{name}_gap"
    return Staged(
        {lo: col, hi: col, gap: col.isNull()},
        {lo: F.min, hi: F.max, gap: F.max},
        lambda m: F.when(m[lo].isNull(), F.lit(None).cast("string"))
        .when((m[lo] == m[hi]) & ~m[gap], m[lo])
        .otherwise(F.lit(mixed)),
    )
