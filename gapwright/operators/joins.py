"""Joins. Where a key may be hot, the side that holds it is the streamed side of a left, semi or anti
join, which adaptive execution can split; the other side is reduced to few rows per key first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwright.functions.aggregates import weighted_mean
from gapwright.functions.scalars import nan_to_null
from gapwright.operators.shape import quoted


def attach(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], null_safe: bool = False, how: str = "left"
) -> DataFrame:
    """Left join on (left column, right column) pairs; the right key columns are dropped.

    `null_safe` lets a missing key meet a missing key.
    """
    renamed = {r: f"_right_{i}" for i, (_, r) in enumerate(on)}
    right = right.select(*[quoted(n).alias(renamed.get(n, n)) for n in right.columns])
    pairs = [(quoted(l), F.col(renamed[r])) for l, r in on]
    condition = reduce(lambda a, b: a & b, [l.eqNullSafe(r) if null_safe else l == r for l, r in pairs])
    return left.join(right, condition, how).drop(*renamed.values())


def keep_members(df: DataFrame, key: str, ids: DataFrame, id_key: str | None = None) -> DataFrame:
    """Rows whose key is one of the ids (semi join; the ids are never collected)."""
    return attach(df, ids.select(quoted(id_key or key)), [(key, id_key or key)], how="left_semi")


def drop_members(df: DataFrame, keys: Sequence[str], ids: DataFrame, null_safe: bool = False) -> DataFrame:
    """Rows whose keys are none of the ids."""
    return attach(df, ids.select(*map(quoted, keys)), [(k, k) for k in keys], null_safe, how="left_anti")


def member_ids(df: DataFrame, *columns: str, out: str = "id") -> DataFrame:
    """Distinct ids out of several columns of one table, missing ones left out."""
    ids = df.select(F.explode(F.array(*map(quoted, columns))).alias(out))
    return ids.filter(F.col(out).isNotNull()).distinct()


def resolve_grain(
    facts: DataFrame,
    units: DataFrame,
    fact_key: str,
    unit_key: str,
    group_key: str,
    is_unit: str = "is_unit",
    unit_keys: DataFrame | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Facts keyed by unit or by group, brought to the group.

    Every unit appears with the facts of its key, or with none. Facts whose key is no unit appear with
    their key as the group. Facts without a key belong nowhere. This is a full join, written as a left
    join plus the facts that matched nothing, so that a unit shared by very many rows can be split.
    `unit_keys` may give the unit keys from a cheaper source than `units`; `scope` columns are part of
    every key.
    """
    facts = facts.filter(quoted(fact_key).isNotNull())
    keys = (units if unit_keys is None else unit_keys).select(*map(quoted, [*scope, unit_key]))
    same_scope = [(s, s) for s in scope]
    on_units = attach(units, facts, [*same_scope, (unit_key, fact_key)]).withColumn(is_unit, F.lit(True))
    loose = (
        attach(facts, keys, [*same_scope, (fact_key, unit_key)], how="left_anti")
        .withColumnRenamed(fact_key, group_key)
        .withColumn(is_unit, F.lit(False))
    )
    return on_units.unionByName(loose, allowMissingColumns=True)


def merge_facets(facets: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer merge of tables that share no column but the keys.

    Written as left joins that start from all keys: each facet is moved once however many there are, and a
    key that is hot in one of them can be split. A missing key meets a missing key. Rows of a key that a
    facet repeats each meet the other facets' rows.
    """
    named = [f.select(*map(quoted, keys)) for f in facets]
    every = reduce(lambda a, b: a.union(b), named).distinct()
    same = [(k, k) for k in keys]
    return reduce(lambda left, facet: attach(left, facet, same, null_safe=True), facets, every)


def merge_two(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`merge_facets` of two tables that have few rows per key: one full join, so that neither is worked out twice."""
    met = {k: f"_right_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(met)
    same = reduce(lambda a, b: a & b, [quoted(k).eqNullSafe(F.col(r)) for k, r in met.items()])
    both = left.join(right, same, "full")
    given = [n for n in [*left.columns, *right.columns] if n not in met and n not in met.values()]
    return both.select(*[F.coalesce(quoted(k), F.col(r)).alias(k) for k, r in met.items()], *map(quoted, given))


def chain_join(base: DataFrame, steps: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Follow a relational chain from `base`: left joins (table, column so far, column of the table).

    Start from the smallest set (the requested rows). Tables of which nothing is selected later are
    dropped from the plan by Catalyst if a distinct follows. Small parents are broadcast by their
    measured size only.
    """
    return reduce(lambda df, step: attach_keeping(df, *step), steps, base)


def attach_keeping(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join that keeps the right key column."""
    return left.join(right, quoted(left_key) == quoted(right_key), "left")


def replace_columns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which the right side's columns replace left columns of the same name."""
    overlap = [n for n in right.columns if n in left.columns and n not in keys]
    return attach(left.drop(*overlap), right, [(k, k) for k in keys], null_safe=True)


def distinct_weighted_mean(
    df: DataFrame, keys: Sequence[str], unit: str, measures: dict[str, tuple[str, str]]
) -> DataFrame:
    """Weighted means {name: (measure, weight)} over the distinct (unit, measure, weight) of each key.

    All measures share one shuffle: rows are unfolded to (measure name, unit, measure, weight), made
    distinct on a hash of all of that, and summed per key. No group is collected.
    """
    types = dict(df.dtypes)

    def value(name: str):
        return nan_to_null(quoted(name)) if types[name] in ("double", "float") else quoted(name)

    # One pair of columns per measure keeps each measure's own number type (exact decimals stay exact).
    def entry(at: int):
        fields = [F.lit(at).alias("_m"), quoted(unit).alias("_unit")]
        for i, (x, w) in enumerate(measures.values()):
            fields += [
                (value(x) if i == at else F.lit(None).cast(types[x])).alias(f"_x{i}"),
                (value(w) if i == at else F.lit(None).cast(types[w])).alias(f"_w{i}"),
            ]
        return F.struct(*fields)

    unfolded = df.select(*map(quoted, keys), F.inline(F.array(*[entry(i) for i in range(len(measures))])))
    return (
        unfolded.distinct()
        .groupBy(*map(quoted, keys))
        .agg(*[weighted_mean(F.col(f"_x{i}"), F.col(f"_w{i}")).alias(name) for i, name in enumerate(measures)])
    )
