"""Comparison helpers shared by the tests."""

from __future__ import annotations

import re


def rows(df, *columns):
    """Rows as plain tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one_value(df, column):
    """The value of the only row, for an expression over literals."""
    return df.select(column.alias("v")).collect()[0]["v"]


def final_plan(df) -> str:
    """The executed plan after all adaptive changes, without the initial plan."""
    df.collect()
    return static_plan(df)


def static_plan(df) -> str:
    return re.split("== Initial Plan ==", df._jdf.queryExecution().executedPlan().toString())[0]
