"""SpotSigs: chains of content words that follow common-word anchors are a document's signatures.

An anchor is a common word that a content word follows; its signature is the anchor with the content words
after it up to the next common word, `chain` at most; content words outside any chain stand for themselves.
The fingerprint is the set of the signatures' hashes. A text of nothing but common words takes the hashes of
its words instead, so only texts without a word have no signature.

Two sets are alike by their Jaccard measure. Near-duplicates are found over distinct sets: sets are
partitioned by length, so that only a set's own and the next partition can hold a partner; there, partners
share one of the rarest signatures of either (prefix pruning), and the measure is taken only of those whose
lengths allow it. Copies stand behind one representative and are never expanded.

Missing texts are empty. Rows are fingerprinted one by one; repeated rows get equal fingerprints. For the
next document, missing ids come first and rows of one id are in order of text. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gapwright.llm.common import id_and_text

#: Fixed list of anchors: very common words of the languages at hand.
ANCHORS = (
    "a an and are as at be but by for from had has have he his i in is it not of on or she that the their they this to was were which with you "
    "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas pour que qui sa se ses son sur un une vous "
    "als auch auf aus bei das dem den der die ein eine einer er es für ich im ist mit nach nicht oder sich sie sind und von war wie zu zum "
    "al como con del el ella ellos las los lo más no o para pero por si sin su sus también una uno y ya"
).split()

#: Content words of a chain.
CHAIN = 3

#: Documents whose neighbours are found in one task, unless that made more than the most ranges.
ROWS_A_RANGE = 2_000
MOST_RANGES = 50_000

_MARK = "\x02"


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted distinct signature hashes of a text, each 8 hexadecimal digits."""
    words = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+", -1), lambda w: w != "")
    marked = F.array_join(F.transform(words, lambda w: F.when(w.isin(*sorted(set(ANCHORS))), F.concat(F.lit(_MARK), w)).otherwise(w)), " ")
    tokens = F.transform(F.split(marked, _MARK, -1), lambda part: F.split(F.rtrim(part), " ", -1))
    # the part before the first anchor has no chain; an anchor that no content word follows is no spot
    chained = lambda part: F.concat(F.array(F.array_join(F.slice(part, 1, chain + 1), " ")), F.slice(part, chain + 2, F.size(part)))
    spots = F.flatten(F.transform(tokens, lambda part, i: F.when(i == 0, F.filter(part, lambda w: w != "")).when(F.size(part) > 1, chained(part)).otherwise(F.array())))
    short = lambda strings: F.sort_array(F.array_distinct(F.transform(strings, lambda s: F.substring(F.md5(s), 1, 8))))
    return F.when(F.size(spots) > 0, short(spots)).otherwise(short(words))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard measure of two sets; sets without a member are alike."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union > 0, shared / union).otherwise(1.0)


def fingerprints(docs: DataFrame, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, signatures) of each whole text."""
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select("doc_id", "text", signatures(F.col("text"), chain).alias("signatures"))


def with_next(docs: DataFrame, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints with the text and signatures of the next document by whole-number id; the first follows the last.

    Documents are dealt into ranges of ids. Each range also gets the first document of the next range, so
    neighbours are found range by range, in one shuffle of the texts.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    n, low, high = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    low, high = low or 0, high or 0
    width = max(1.0, (float(high) - float(low) + 1) / min(MOST_RANGES, max(1, n // ROWS_A_RANGE)))
    rows = rows.withColumn("range", F.coalesce(F.floor((F.col("doc_id").cast("double") - float(low)) / width).cast("long"), F.lit(-1).cast("long")))
    # one row for each range, so no more than MOST_RANGES and one: small enough to be handed to all tasks
    by_range = W.orderBy("range")
    firsts = rows.groupBy("range").agg(F.min("doc_id").alias("first_id"))
    firsts = firsts.select("range", "first_id", F.lag("range").over(by_range).alias("before"), F.max("range").over(by_range.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("last"))
    firsts = firsts.select("range", "first_id", F.coalesce("before", "last").alias("before"))
    lent = rows.join(F.broadcast(firsts), "range").where(F.col("doc_id").eqNullSafe(F.col("first_id"))).select("doc_id", "text", F.col("before").alias("range"), F.lit(True).alias("lent"))
    both = rows.withColumn("lent", F.lit(False)).unionByName(lent).withColumn("text", F.coalesce("text", F.lit("")))
    order = W.partitionBy("range").orderBy("lent", "doc_id", "text")
    ahead = both.select("*", F.lead("text").over(order).alias("next_text"))
    # signatures are taken where the texts now lie, in the order they now have
    ahead = ahead.select("*", signatures(F.col("text"), chain).alias("signatures"))
    ahead = ahead.select("*", F.lead("signatures").over(order).alias("next_signatures"))
    return ahead.where("not lent").drop("range", "lent")


def edited(text: Column, other: Column) -> Column:
    """A text whose last half (rounded down) is replaced by as much of another's begin, or all of that."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def near_duplicates(docs: DataFrame, least: float = 0.8, chain: int = CHAIN, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, class_id) and links (class_a, class_b, likeness) between classes of at least `least`.

    A class is a set of signatures, named by the smallest id that has it. Texts without a word are left out.
    """
    prints = fingerprints(docs, chain, id_col, text_col).where(F.size("signatures") > 0)
    prints = prints.select("doc_id", "signatures", F.sha2(F.array_join("signatures", ""), 256).alias("set"))
    names = prints.groupBy("set").agg(F.min("doc_id").alias("class_id"), F.first("signatures").alias("signatures"))
    members = prints.select("doc_id", "set").join(names.select("set", "class_id"), "set").select("doc_id", "class_id")
    each = names.select("class_id", F.size("signatures").alias("n"), F.explode("signatures").alias("signature"))
    counts = each.groupBy("signature").agg(F.count("*").alias("df"))
    # rarest first; the list is bounded by the document
    rarest = each.join(counts, "signature").groupBy("class_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "signature"))).alias("ranked"))
    keep = F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1
    part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / least) + 1e-9).cast("int")
    heads = rarest.select("class_id", "n", part.alias("part"), F.explode(F.transform(F.slice("ranked", F.lit(1), keep), lambda r: r["signature"])).alias("signature"))
    longer = heads.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), "part", "signature")
    shorter = heads.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), F.explode(F.array("part", F.col("part") + 1)).alias("part"), "signature")
    fits = ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))) & (F.col("n_a") >= F.col("n_b") * least - 1e-9)
    pairs = shorter.join(longer, ["signature", "part"]).where(fits).select("a", "b").distinct()
    sets = names.select("class_id", "signatures")
    met = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    links = met.select(F.least("a", "b").alias("class_a"), F.greatest("a", "b").alias("class_b"), likeness(F.col("set_a"), F.col("set_b")).alias("likeness"))
    return members, links.where(F.col("likeness") >= least)
