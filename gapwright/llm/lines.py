"""Line-first cleaning: rules judge each line, failing lines go, and documents that lose too much are rejected.

A line fails if it is navigation (separators among its words), symbol-ridden, shouted (no small letter),
the same few words over and over, boilerplate (licence, copyright, cookies, scripts, filler), or short
without the punctuation that ends a sentence. Lines without a word are neither kept nor counted as lost.
A document is kept if it passes the base rules and its failing lines hold no more than `most_lost` of the
characters of its words.

All of it is array expressions on one row: nothing is shuffled, and work grows with the length of a text
times its logarithm. Missing texts are empty; they have no words and fail the base rules. Rows are judged
one by one, so repeated rows and missing ids make no difference. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwright.llm.common import SPACE, ascii_words, id_and_text

SYMBOLS = "#*$%&|<>"

#: Fixed patterns of boilerplate, in small letters.
BOILERPLATE = (
    r"licensed under|released under the|all rights reserved|copyright|©|cookie|privacy policy|terms of (use|service)"
    r"|enable javascript|javascript is|lorem ipsum|subscribe to our|sign up for|click here|share this|powered by"
)

#: A line ends a sentence with one of these, closing quotes and brackets aside.
ENDING = r"""[.!?…:;。！？]["'”’»)\]]*$"""


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_fails(line: Column, words: Column, shortest: int) -> Column:
    """Whether a trimmed line with these words fails a rule; `shortest`: words from which an open end is no fault."""
    n = F.size(words)
    bars = F.size(F.filter(words, lambda w: w.isin("|", "»", "›", "·", "•", ">")))
    shouted = (n >= 5) & ~line.rlike("\\p{Ll}") & line.rlike("\\p{Lu}.*\\p{Lu}")
    return (
        ((bars >= 2) & (bars * 6 >= n))
        | (_without(line, SYMBOLS) * 12 >= F.length(line))
        | shouted
        | ((n >= 8) & (F.size(F.array_distinct(words)) * 4 < n))
        | F.lower(line).rlike(BOILERPLATE)
        | ((n < shortest) & ~line.rlike(ENDING))
    )


def repeat_words(words: Column) -> tuple[Column, Column, Column]:
    """Steps to count the words in 3-word windows that a text holds twice or more: hashes, sorted places, count."""
    n = F.size(words)
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    windows = F.col("windows")
    # most texts repeat no window, so only the others are sorted by hash and place
    places = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    sorted_ = F.col("places")
    twice = F.filter(sorted_, lambda s, k: (s["h"] == F.get(sorted_, k - 1)["h"]) | (s["h"] == F.get(sorted_, k + 1)["h"]))
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda s: s["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda state, place: F.struct(place.alias("last"), (state["n"] + F.least(F.lit(3), place - state["last"])).alias("n")),
        lambda state: state["n"],
    )
    return hashes, places, F.coalesce(covered, F.lit(0))


def clean(docs: DataFrame, most_lost: float = 0.5, fewest_words: int = 50, shortest_open: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts of the base rules, base_failed, n_lines, n_bad_lines, lost, kept, cleaned)."""
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    hashes, places, covered = repeat_words(F.col("words"))
    trimmed = lambda line: F.trim(line, F.lit(SPACE))
    in_words = lambda text: F.length(F.translate(text, SPACE, ""))
    rows = rows.select(
        "doc_id",
        "text",
        ascii_words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: trimmed(line) != "").alias("lines"),
    )
    parts = F.transform("lines", lambda line: F.struct(trimmed(line).alias("line"), ascii_words(line).alias("words")))
    rows = rows.select("*", hashes.alias("windows"), parts.alias("parts"))
    fails = F.transform("parts", lambda part: line_fails(part["line"], part["words"], shortest_open))
    rows = rows.select("doc_id", "text", "words", "lines", places.alias("places"), fails.alias("fails"))
    lines, fails = F.col("lines"), F.col("fails")
    bad = F.filter(lines, lambda line, i: F.get(fails, i))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        in_words(F.col("text")).cast("long").alias("word_chars"),
        _without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(fails, lambda f: f)).cast("long").alias("n_bad_lines"),
        F.aggregate(F.transform(bad, in_words), F.lit(0).cast("long"), lambda a, x: a + x).alias("lost_chars"),
        F.array_join(F.filter(lines, lambda line, i: ~F.get(fails, i)), "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < fewest_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = F.when(F.col("word_chars") > 0, F.col("lost_chars") / F.col("word_chars")).otherwise(0.0)
    return rows.select(
        *["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        failed.alias("base_failed"),
        "n_lines",
        "n_bad_lines",
        lost.alias("lost"),
        (~failed & (lost <= most_lost)).alias("kept"),
        "cleaned",
    )
