"""Row-local expressions (Column -> Column). No UDF, no action, safe on any DataFrame."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "NA"


def recode(col: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Closed-vocabulary recode. Anything unlisted, a missing value too, takes `default`."""
    out = None
    for raw, label in mapping.items():
        out = F.when(col == raw, label) if out is None else out.when(col == raw, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def code_before_last(col: Column, width: int = 2) -> Column:
    """The `width` characters in front of the last one; fewer if the text is short, '' if it has one."""
    n = F.length(col)
    start = F.greatest(n - width, F.lit(1))
    return F.substring(col, start, n - start)


def base_name(path: Column) -> Column:
    """Last path component, trailing slashes ignored."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def code_from_file(path: Column, start: int = 14, width: int = 2) -> Column:
    """Fixed slice of the file name; missing only where the path is missing."""
    return F.substring(base_name(path), start, width)


def code_from_id(arms: Sequence[Column], mapping: Mapping[str, str], default: str) -> Column:
    """Recode the first arm that is present; missing if every arm is.

    An id of two or more characters always answers the first arm, so an id without the usual
    ending falls to `default` and never reaches the file names (kept on purpose).
    """
    code = F.coalesce(*arms)
    return F.when(code.isNotNull(), recode(code, mapping, default))


def drop_last(col: Column, n: int) -> Column:
    """The text without its last n characters."""
    return F.substring(col, F.lit(1), F.greatest(F.length(col) - n, F.lit(0)))


def split_key(col: Column, sep: str = ".") -> tuple[Column, Column]:
    """(head, rest) at the first separator; rest is missing if there is none."""
    at = F.instr(col, sep)
    head = F.when(at > 0, F.substring(col, F.lit(1), at - 1)).otherwise(col)
    rest = F.when(at > 0, F.substring(col, at + len(sep), F.length(col)))
    return head, rest


def has_part(col: Column, sep: str = ".") -> Column:
    """Whether the id has a part behind the first separator (false for a missing id)."""
    return F.coalesce(F.instr(col, sep) > 0, F.lit(False))


def strip_suffix(col: Column, suffix: str, regex: bool = False) -> Column:
    """Cut a trailing suffix once. An empty suffix changes nothing.

    The suffix is literal; `regex=True` reads it as a regular expression.
    """
    if not suffix:
        return col
    pattern = suffix if regex else re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", suffix)
    return F.regexp_replace(col, f"(?:{pattern})$", "")


def classify_boxes(
    x: Column, y: Column, boxes: Sequence[tuple[str, tuple[float, float, float, float]]], default: str
) -> Column:
    """First box (label, (x_lo, x_hi, y_lo, y_hi)), bounds inclusive, that holds the point.

    A missing coordinate is in no box, so it takes `default`.
    """
    out = None
    for label, (x_lo, x_hi, y_lo, y_hi) in boxes:
        inside = x.between(x_lo, x_hi) & y.between(y_lo, y_hi)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def choose_by_sign(value: Column, at_or_above: str, below: str, strict: bool = True, what: str = "value") -> Column:
    """One label for values >= 0, another below; a missing value raises, or is missing if not strict.

    Text is read as a number; text that is no number counts as missing.
    """
    number = lenient_double(value)
    out = F.when(number >= 0, at_or_above).when(number < 0, below)
    if strict:
        out = out.otherwise(F.raise_error(F.lit(f"{what} must be a number and not missing")).cast("string"))
    return out


def fixed3(col: Column) -> Column:
    """Three decimals as text, rounded from the exact binary value; missing stays missing.

    `format_string` would round the shortest decimal half up (1.0005 -> 1.001, although the double is
    below that). `format_number` rounds the exact value, except that it takes 0.0005 to zero.
    """
    number = nan_to_null(col.cast("double"))
    return F.coalesce(
        F.when(number == 0.0005, F.lit("0.001")).when(number == -0.0005, F.lit("-0.001")),
        F.call_function("format_number", number, F.lit("0.000")),
    )


def sig3(col: Column) -> Column:
    """At least one significant digit and three decimals: `fixed3`, but one-digit scientific where shorter."""
    number = nan_to_null(col.cast("double"))
    size = F.abs(number)
    plain = (size == 0) | ((size >= 0.00095) & (size < 95000))
    return F.when(plain, fixed3(number)).when(number.isNotNull(), F.format_string("%.0e", number))


def or_na(col: Column) -> Column:
    """Text with the missing value spelled out."""
    return F.coalesce(col.cast("string"), F.lit(NOT_AVAILABLE))


def count_text(col: Column) -> Column:
    """A whole number as text, without a decimal point, missing spelled out."""
    return or_na(col.cast("bigint"))


def rate_note(x: Column, x_err: Column, y: Column, y_err: Column) -> Column:
    """`x-rate: a +- b, y-rate: c +- d` from number texts."""
    return F.concat(
        F.lit("x-rate: "), or_na(x), F.lit(" +- "), or_na(x_err), F.lit(", y-rate: "), or_na(y), F.lit(" +- "), or_na(y_err)
    )


def counts_note(counts: Column, cutoff: int) -> Column:
    """Note that lists all counts, those below the cutoff too."""
    return F.concat(
        F.lit("Nr Snps (per library): "),
        counts,
        F.lit(
            ". Estimate and error are weighted means of values per library."
            f" Libraries with fewer than {cutoff} were excluded."
        ),
    )


def no_result_note(cutoff: int) -> str:
    return f"No results found, or no libraries exceeded cutoff of {cutoff} SNPs after depth filtering."


def sentinel_null(col: Column, sentinel) -> Column:
    """The sentinel counts as missing."""
    return F.nullif(col, F.lit(sentinel))


def is_blank(col: Column) -> Column:
    """Missing or empty text; never missing itself."""
    return col.isNull() | (col == "")


def gate(value: Column, trust: Column) -> Column:
    """The value where `trust` is present and not blank, else missing."""
    return F.when(~is_blank(trust), value)


def label_if_present(col: Column, label: str) -> Column:
    return gate(F.lit(label), col)


def mask_below(value: Column, by: Column, cutoff, missing_by: str) -> Column:
    """Missing where `by` < cutoff. `missing_by` says what a missing `by` does: "keep" or "mask"."""
    if missing_by == "keep":
        return F.when(by.isNull() | (by >= cutoff), value)
    if missing_by == "mask":
        return F.when(by >= cutoff, value)
    raise ValueError(f"missing_by must be 'keep' or 'mask', not {missing_by!r}")


#: Text that is a number: digits with at most one point and an exponent, or infinity.
NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity))$"


def lenient_double(col: Column) -> Column:
    """A decimal number or infinity, or missing for any other text (`12d`, `0x1A`) and for NaN."""
    text = F.trim(col.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def lenient_int(col: Column) -> Column:
    """A whole number, fraction cut off; missing for any other text and beyond 32 bits."""
    return lenient_double(col).try_cast("int")


def swap_char(col: Column, old: str, new: str) -> Column:
    return F.translate(col, old, new)


def nan_to_null(col: Column) -> Column:
    """One missing value: NaN counts as NULL."""
    return F.when(~F.isnan(col), col)


def as_text(col: Column, dtype: str) -> Column:
    """Text of any column. Whole doubles have no fraction, the others no exponent from 1e-4 to 1e15."""
    text = col.cast("string")
    if dtype not in ("double", "float"):
        return text
    size = F.abs(col)
    whole = (col == F.floor(col)) & (size < 1e15)
    small, large = (size >= 1e-4) & (size < 1e-3), (size >= 1e7) & (size < 1e15)
    lower = F.regexp_replace(F.regexp_replace(text, r"(\.0)?E", "e"), r"e-(\d)$", "e-0$1")
    return (
        F.when(whole, col.try_cast("bigint").cast("string"))
        .when(small, F.rtrim(col.try_cast("decimal(38,24)").cast("string"), F.lit("0")))
        .when(large, F.rtrim(col.try_cast("decimal(38,10)").cast("string"), F.lit("0")))
        .otherwise(lower)
    )


def render(col: Column, dtype: str, missing: str = "n/a") -> Column:
    """Output text of a cell, missing spelled out."""
    return F.coalesce(as_text(col, dtype), F.lit(missing))
