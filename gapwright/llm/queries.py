"""The registered queries of the operators, with their production parameters, and the SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwright.llm import bpe, brown, crf, divergence, exact, lines, packing, secrets, simhash, spots, substring, surrogates, variants
from gapwright.llm.common import documents, held_out
from gapwright.llm.oracle import ORACLE  # noqa: F401


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded; digests of both."""
    path = tokenizer_path()
    done = bpe.decode(bpe.encode(documents(spark, sf_dir), path), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op2_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a class model learnt from those not held out."""
    docs = documents(spark, sf_dir)
    aside = held_out(docs["doc_id"], 7, 2)
    found = brown.perplexity(docs, ~aside)
    return found.select("doc_id", held_out(found["doc_id"], 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in pieces of up to 2,048 words, in 16 optimal length buckets and batches of 65,536 tokens."""
    return packing.pack(documents(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: fixed formats and what the Markov models add."""
    found = secrets.scan(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secrets.PATTERNS],
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text without the 13-word windows that a smaller document has."""
    done = substring.remove_repeats(documents(spark, sf_dir), k=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they and the next document's are."""
    rows = spots.with_next(documents(spark, sf_dir))
    rows = rows.withColumn("edited", spots.edited(F.col("text"), F.col("next_text"))).drop("next_text")
    rows = rows.withColumn("edited_signatures", spots.signatures(F.col("edited")))
    own = F.col("signatures")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join(own, "").alias("fingerprint"),
        F.array_join("edited_signatures", "").alias("edited_fingerprint"),
        spots.likeness(own, F.col("edited_signatures")).alias("near_edited"),
        spots.likeness(own, F.col("next_signatures")).alias("near_next"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, 3 bits."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text judged line by line."""
    return lines.clean(documents(spark, sf_dir)).drop("cleaned")


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text with its personal data replaced by keyed surrogates."""
    return surrogates.pseudonymise(documents(spark, sf_dir), key="documents")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learnt from the labelled rows that aren't held out."""
    docs = documents(spark, sf_dir)
    model = crf.train(docs, ~held_out(docs["doc_id"], 3, 1))
    found = crf.predict(docs, model)
    return found.select("doc_id", held_out(found["doc_id"], 3, 1).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the row of an equal text that stays, white space apart."""
    found = exact.duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language differ from one another, and the terms by which they differ from it."""
    return divergence.audit(documents(spark, sf_dir))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with the commoner word that they are a variant of."""
    return variants.forms(variants.word_counts(documents(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_brown, op3_packing, op4_secrets, op5_substring, op6_spots, op7_simhash, op8_lines, op9_surrogates, op10_language, op11_exact, op12_divergence, op13_variants)}
