"""Library sheet: one clean row per library, and the summary per sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwright.functions import scalars as S
from gapwright.functions.aggregates import Staged, staged_collapse, staged_count
from gapwright.operators.lists import ordered_lists
from gapwright.operators.shape import distinct_with_order, quoted, require_columns
from gapwright.plans import presets as P
from gapwright.sources.delimited import scan


def read_sheet(spark: SparkSession, paths, codes: str | None = P.SHEET_TYPES) -> tuple[DataFrame, list[str]]:
    """Sheet files with their row order."""
    return scan(spark, paths, P.SHEET_MISSING, codes)


def keep_strandedness(sheet: DataFrame, keep_only: str, build: str = "Strandedness") -> DataFrame:
    """Rows of the wanted raw strandedness; "none" keeps all, otherwise a missing value goes too."""
    if keep_only not in P.KEEP_ONLY_CHOICES:
        raise ValueError(f"keep_only must be one of {', '.join(P.KEEP_ONLY_CHOICES)}, not {keep_only!r}")
    return sheet if keep_only == "none" else sheet.filter(quoted(build) == keep_only)


def clean_sheet(
    sheet: DataFrame,
    order_by: Sequence[str],
    keep_only: str = "none",
    scope: Sequence[str] = (),
    sample: str = "Sample_Name",
    unit: str = "Library_ID",
    build: str = "Strandedness",
    treatment: str = "UDG_Treatment",
    files: Sequence[str] = ("R1", "BAM"),
    by_unit: bool = False,
) -> DataFrame:
    """Recode the sheet and collapse lanes: distinct libraries with the place of their first row.

    `Seq_Type` comes from the library id, else from a file name. `scope` columns (such as a package id)
    go along as part of the key. With `by_unit` the caller states that a library has few rows: they move by library
    and are made distinct there, so that a join by library needs no other move of them.
    """
    require_columns(sheet, [*scope, sample, unit, build, treatment, *files, *order_by])
    rows = keep_strandedness(sheet, keep_only, build)
    arms = [F.nullif(S.code_before_last(quoted(unit)), F.lit("")), *[S.code_from_file(quoted(f)) for f in files]]
    code = F.col("_code")
    libraries = rows.withColumn("_code", F.coalesce(*arms)).select(
        *map(quoted, scope),
        quoted(sample),
        quoted(unit),
        S.recode(quoted(build), P.LIBRARY_BUILDS, P.LIBRARY_BUILD_OTHER).alias(build),
        S.recode(quoted(treatment), P.UDG_TREATMENTS, P.UDG_OTHER).alias(treatment),
        S.code_from_id([code], P.CAPTURE_TYPES, P.CAPTURE_OTHER).alias("Seq_Type"),
        *map(quoted, order_by),
    )
    if by_unit:
        libraries = libraries.repartition(*map(quoted, [*scope, unit]))
    # The library name follows from the id, so it need not be grouped on.
    return distinct_with_order(libraries, order_by).select(
        *map(quoted, [*scope, sample, unit, build, treatment]),
        S.drop_last(quoted(unit), 4).alias("Library"),
        "Seq_Type",
        *map(quoted, order_by),
    )


def summary_stages(build: str = "Strandedness", treatment: str = "UDG_Treatment") -> dict[str, Staged]:
    return {
        "Nr_Libraries": staged_count("libraries"),
        "UDG": staged_collapse("udg", quoted(treatment)),
        "Library_Built": staged_collapse("built", quoted(build)),
    }


def summarise_sheet(
    libraries: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = ("Sample_Name",),
    build: str = "Strandedness",
    treatment: str = "UDG_Treatment",
    groups: str = "placed",
) -> DataFrame:
    """Per sample: number of libraries, their capture types in row order, UDG and build or `mixed`.

    `groups` says what is known of the samples' sizes, see `ordered_lists`.
    """
    stages = summary_stages(build, treatment)
    return ordered_lists(libraries, keys, {"Capture_Type": F.col("Seq_Type")}, order_by, stages, groups=groups)
