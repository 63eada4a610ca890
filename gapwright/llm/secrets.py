"""Secret scans: fixed formats, and character Markov models of random strings against ordinary identifiers.

Every long run of key characters is scored by its log-likelihood ratio under two first-order Markov models
of characters. They are trained from labelled samples out of a bounded number of rows: random strings are
what the fixed formats find there, and digests of the rows written in the usual alphabets; ordinary
identifiers are the rows' words, also joined in the ways names are. A run is a secret if its ratio exceeds
the prior odds against. Spans of the fixed formats always stay; others are added where none is.

Only expressions on one row and two small aggregates are used. Missing texts are empty and have no spans;
rows are scanned one by one, so repeated rows and missing ids make no difference. Other columns are ignored.
Without rows to train on, nothing is added to the fixed formats.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwright.llm.common import ascii_words, id_and_text

#: The formats of secrets. Each pattern's group 1 is the value that `LEAST` measures.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]{16,})",
    "hex": r"((?<![0-9a-f])[0-9a-f]{24,})",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: A run that the Markov models judge: no letter, digit or key character before or after it. A '=' may stand
#: before it (NAME=value); after it only as padding, so a name before its '=' is no candidate.
CANDIDATE = r"((?<![\p{L}\p{N}+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}(?![\p{L}\p{N}=]))"
KINDS = [*PATTERNS, "markov"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

#: Rows that the models are trained on, at most, and their longest text.
SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 50_000

#: Natural log of the odds that a run is ordinary.
PRIOR = 12.0

#: Ratio a pair of characters that a secret has on average: what long names, paths and compounds gather in sum,
#: random strings gather pair by pair.
A_PAIR = 1.7

#: Formats of public identifiers that are random or numeric by nature, UUIDs and times.
PUBLIC = r"^(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[12][0-9]{3}-[01][0-9]-[0-3][0-9][T_-][0-9-]+Z?(?:[_-][a-z]+)*)$"


def cuts(text: Column, pattern: str) -> Column:
    """Where a pattern matches: lengths of the pieces between matches, of the matches and of their group 1."""
    lengths = lambda strings: F.transform(strings, F.length)
    return F.when(
        text.rlike(pattern),
        F.struct(
            lengths(F.split(text, pattern, -1)).alias("gaps"),
            lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("sizes"),
            lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("values"),
        ),
    )


def spans_of(cut: Column, kind: int, least: int) -> Column:
    """(start, kind, end) of the matches whose value is long enough."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(state, i):
        start = state["at"] + F.get(cut["gaps"], i)
        end = start + F.get(cut["sizes"], i)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        out = F.when(F.get(cut["values"], i) >= least, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    each = F.sequence(F.lit(0), F.size(cut["sizes"]) - 1)
    walked = F.aggregate(each, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda state: state["out"])
    return F.when(F.size(cut["sizes"]) > 0, walked).otherwise(empty)


def base_spans(rows: DataFrame) -> DataFrame:
    """Adds `base`, the spans of the fixed formats in order of start and kind, to rows with `text`."""
    kept = rows.columns
    rows = rows.select("*", *[cuts(F.col("text"), p).alias(f"cut_{k}") for k, p in PATTERNS.items()])
    spans = [F.coalesce(spans_of(F.col(f"cut_{k}"), i, LEAST[k]), F.array()) for i, k in enumerate(PATTERNS)]
    return rows.select(*kept, F.sort_array(F.concat(*spans)).alias("base"))


def _codes(strings: Column) -> Column:
    """Characters of a string as numbers in the alphabet."""
    return F.transform(F.split(strings, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def samples(docs: DataFrame) -> DataFrame:
    """(label, string): labelled strings of a bounded number of rows."""
    # equal rows count once; rows without an id are told apart by their texts
    place = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    n = docs.agg(F.approx_count_distinct(place)).first()[0]
    span = F.pmod("place", F.lit(1 << 40)) / float(1 << 40)
    low = docs.withColumn("place", place).where((span <= 2 * SAMPLE_ROWS / max(n, 1)) & (F.length("text") <= SAMPLE_CHARS))
    chosen = low.groupBy("place").agg(F.min("text").alias("text")).orderBy(span, "place").limit(SAMPLE_ROWS)
    words = F.filter(ascii_words(F.col("text")), lambda w: w.rlike("^[A-Za-z]{2,}$"))
    chosen = base_spans(chosen).select("place", "text", "base", words.alias("words"))
    values = F.transform("base", lambda s: F.regexp_extract(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]), r"([A-Za-z0-9+/_=-]{6,})[^A-Za-z0-9+/_=-]*$", 1))
    digest = lambda salt: F.sha2(F.concat_ws(":", F.lit(salt), F.col("place").cast("string")), 256)
    coded = F.base64(F.unhex(digest("b")))
    made = [digest("a"), coded, F.translate(coded, "+/=", ""), F.translate(F.base64(F.unhex(digest("c"))), "+/=", "-_"), F.upper(F.translate(coded, "+/=", "")), F.lower(F.translate(coded, "+/=", ""))]
    joined = lambda how: F.transform("words", lambda w, i: F.concat(w, how(F.coalesce(F.get("words", i + 1), w))))
    marked = lambda mark: joined(lambda w: F.concat(F.lit(mark), w))
    # each way of joining takes some of the words, so that plain words prevail
    some = lambda strings, k: F.filter(strings, lambda _, i: i % 8 == k)
    shares = [some(strings, k) for k, strings in enumerate([marked("_"), marked("-"), marked("/"), joined(F.initcap)])]
    shares += [F.transform(some(strings, k), F.upper) for k, strings in ((4, "words"), (5, marked("_")))]
    numbered = F.transform(F.filter("words", lambda _, i: i % 16 == 5), lambda w: F.concat(w, F.pmod(F.xxhash64(w), F.lit(100)).cast("string")))
    random = chosen.select(F.lit("random").alias("label"), F.explode(F.concat(F.array(*made), values)).alias("string"))
    ordinary = chosen.select(F.lit("ordinary").alias("label"), F.explode(F.concat("words", *shares, numbered)).alias("string"))
    return random.union(ordinary).where("string <> ''")


def train(docs: DataFrame) -> np.ndarray | None:
    """Log-likelihood ratio of each pair of characters: what random strings say less what ordinary ones say."""
    codes = samples(docs).select("label", _codes(F.col("string")).alias("codes")).where(F.size("codes") >= 2)
    codes = codes.select("label", "codes", F.size("codes").alias("n"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 2), lambda i: F.get("codes", i) * len(ALPHABET) + F.get("codes", i + 1))
    # bounded by the square of the alphabet for each label
    found = codes.select("label", F.explode(pairs).alias("pair")).where("pair >= 0").groupBy("label", "pair").count().collect()
    if not found:
        return None
    size = len(ALPHABET)
    tables = {"random": np.full((size, size), 0.5), "ordinary": np.full((size, size), 0.5)}
    for r in found:
        tables[r["label"]][divmod(r["pair"], size)] += r["count"]
    log = {k: np.log(t / t.sum(1, keepdims=True)) for k, t in tables.items()}
    return log["random"] - log["ordinary"]


def scan(docs: DataFrame, prior: float = PRIOR, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, text, base, spans): spans as (start, kind, end) in code points; kinds count in `KINDS`.

    With `carry`, `row` holds the input's columns as they came.
    """
    rows = id_and_text(docs, id_col, text_col)
    ratios = train(rows)
    if carry:
        rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"))
    rows = base_spans(rows.withColumn("text", F.coalesce("text", F.lit(""))))
    kept = rows.columns
    if ratios is None:
        return rows.select(*kept, F.col("base").alias("spans"))
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(f"{x:.4f}" for x in ratios.ravel())), ",").cast("array<double>")
    rows = rows.select("*", cuts(F.col("text"), CANDIDATE).alias("cut"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(1)).alias("runs"))

    def secret(run):
        codes = _codes(run)
        gain = lambda state, code: F.struct(code.alias("last"), (state["sum"] + F.when(state["last"] >= 0, F.get(table, state["last"] * size + code)).otherwise(0.0)).alias("sum"))
        ratio = F.aggregate(codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), gain, lambda state: state["sum"])
        return run.rlike("[A-Za-z]") & ~run.rlike(PUBLIC) & (ratio > F.greatest(F.lit(prior), A_PAIR * (F.length(run) - 1)))

    rows = rows.select(*kept, "cut", F.transform("runs", secret).alias("judged"))
    rows = rows.select(*kept, "judged", spans_of(F.col("cut"), len(PATTERNS), 0).alias("runs"))
    free = lambda run: ~F.exists("base", lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    added = F.filter("runs", lambda run, i: F.get("judged", i) & free(run))
    return rows.select(*kept, F.sort_array(F.concat("base", F.coalesce(added, F.array()))).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", prior: float = PRIOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns, with every span of the text (overlapping ones as one) replaced by the mark."""
    found = scan(docs, prior, id_col, text_col, carry=True)
    text = F.col("text")

    def step(state, s):
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return found.select(*[(F.when(F.size("spans") > 0, done).otherwise(F.col(f"row.c{i}")) if c == text_col else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(docs.columns)])
