"""Inputs and brute-force pieces that the tests of the operators share."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.001"

#: Column names that operators use inside; inputs that carry them must make no difference.
CLASHES = ["tag", "body", "row", "words", "key", "place", "range", "n", "hits", "count", "fingerprint", "component_id", "ids", "spans", "other_id", "other_tag", "root", "other", "c0", "_key_id"]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


#: Texts in no language of the test tables, and letter junk.
STRANGE = [
    "Het was een koude avond in de stad en de mensen liepen snel naar huis, want niemand wilde lang buiten blijven terwijl de wind door de straten joeg en de regen tegen de ramen sloeg",
    "Suomen kieli on yksi maailman kielistä, jota puhutaan pääasiassa Suomessa ja jonka sanat taipuvat monin tavoin, joten niiden oppiminen vaatii aikaa ja kärsivällisyyttä kaikilta",
    "Вчера вечером мы пошли в театр и смотрели новую пьесу, которая всем очень понравилась, потому что актёры играли великолепно и музыка была прекрасна",
    "Wczoraj wieczorem poszliśmy do teatru i oglądaliśmy nową sztukę, która wszystkim bardzo się podobała, ponieważ aktorzy grali wspaniale, a muzyka była przepiękna",
    "xqzv wkjh pqrx zzkt vbnq wxcv qjkz hgfd sdfg lkjh qwrt zxcv bnmk plkj hgfq wsxc rfvt gbyh nujm ikol qazx swed cvfr tgbn hyuj mkiq",
]


def odd_rows(long_words: int = 3000) -> list[tuple]:
    """Nulls everywhere, blanks, ties, repeated rows and a long text."""
    texts = [None, "", " \t\n", "one", "one two", "the end of the story is near the end of the story", "é ß Σ İ 😀 中文 Привет", "word " * long_words, "a" * 5000, "12 34 !! --"]
    rows = [(i, t, "en" if i % 2 else None, "s", None) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, "the end of the story is near the end of the story", None, None, None), (None, None, None, None, None), (20, texts[5], "en", None, 1)]


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def small_letters(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
