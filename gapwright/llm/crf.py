"""Language identification of code-switched text by a linear-chain conditional random field.

Each word is labelled with a language. Features of a word are its affixes and character n-grams (n-grams of
the word between its borders) and its entry in the lexicon of training words, hashed into fixed tables; a
matrix of transitions is learned with them. Forward-backward gives every word's language probabilities; a
document's language is the one with the highest mean, and that mean is its score.

The model is fitted on a bounded sample: at most `rows_per_language` labelled rows of each language of up to
`longest` characters, the smallest by hash of id and text, so on the same rows at every run; equal rows count
once. Their words are dealt into code-switched training lines, so that staying and switching are both learned. Everything else
covers all rows and whole texts. Prediction sees the text only.

A conditional model spreads its probability over the languages it knows, so a text in none of them has one too.
Against that stands a background: the share of a text's letter 3-grams that occur in the training words.

Missing texts and texts without a letter are `und` with score 0, and so is everything if no row is labelled.
Repeated rows and missing ids are treated like others. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from gapwright.llm.common import chunks, field_of, id_and_text

UNKNOWN = "und"

#: Words whose scores a task keeps, and characters of text it labels at a time (or one document).
TABLE_WORDS = 250_000
LABEL_CHARS = 3_000_000

#: Where the slots of 3-grams begin, in parts of a table.
BACKGROUND = 2

#: A text of fewer 3-grams is not held against the background.
LEAST_GRAMS = 60

_WORDS = re.compile(r"[^\W\d_]+").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    rows_per_language: int = 150
    #: Languages that are learnt, at most: those of most rows, ties by name. Rows of others teach nothing.
    most_languages: int = 100
    longest: int = 50_000
    #: Training words of a line, mean length of a run in one language, passes over all lines.
    line: int = 64
    run: int = 20
    passes: int = 30
    rate: float = 0.2
    decay: float = 1e-3
    #: Slots for each n-gram length and for the lexicon.
    slots: int = 1 << 15
    longest_ngram: int = 4


def words_of(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def feature_slots(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the features of all words in one array, and each slot's word."""
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    slots, owners = [], []
    rolled = np.zeros(len(points), np.uint64)
    for n in range(1, settings.longest_ngram + 1):
        rolled = (rolled[: len(points) - n + 1] + points[n - 1 :] + np.uint64(n)) * _MIX
        rolled ^= rolled >> np.uint64(29)
        inside = owner[n - 1 :] == owner[: len(rolled)]
        slots.append((rolled[inside] >> np.uint64(20)).astype(np.int64) % settings.slots + (n - 1) * settings.slots)
        owners.append(owner[: len(rolled)][inside])
    weights = np.cumprod(np.full(int(sizes.max(initial=1)), _MIX), dtype=np.uint64)
    begins = np.cumsum(sizes) - sizes
    if len(words):
        whole = np.add.reduceat(points * weights[np.arange(len(points)) - np.repeat(begins, sizes)], begins)
        whole ^= whole >> np.uint64(31)
        slots.append((whole >> np.uint64(13)).astype(np.int64) % settings.slots + settings.longest_ngram * settings.slots)
        owners.append(np.arange(len(words)))
    return np.concatenate(slots), np.concatenate(owners)


@dataclass
class Crf:
    settings: Settings
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    first: np.ndarray
    #: Which slots of 3-grams the training words have.
    seen: np.ndarray

    def background(self, slots: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of 3-grams of each of n words, and of those that training words have."""
        slots = slots - BACKGROUND * self.settings.slots
        inside = (slots >= 0) & (slots < self.settings.slots)
        return np.bincount(owners[inside], minlength=n), np.bincount(owners[inside], self.seen[slots[inside]], n)

    def scores(self, slots: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
        """Score of each language for each of n words."""
        return np.stack([np.bincount(owners, self.weights[slots, j], n) for j in range(len(self.languages))], axis=1)

    def marginals(self, scores: np.ndarray, lengths: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
        """Language probabilities of every word; lines of words one after the other, all walked together.

        Expected counts of neighbouring languages are added to `pairs`.
        """
        order = np.argsort(-lengths, kind="stable")
        begins = (np.cumsum(lengths) - lengths)[order]
        alive = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")
        emit = np.exp(scores - scores.max(1, keepdims=True))
        step = np.exp(self.transitions - self.transitions.max())
        out = np.empty_like(emit)
        state = np.exp(self.first - self.first.max())[None, :].repeat(len(lengths), 0)
        for t, k in enumerate(alive.tolist()):
            at = begins[:k] + t
            state = (state[:k] @ step if t else state[:k]) * emit[at]
            state /= state.sum(1, keepdims=True)
            out[at] = state
        state = np.ones((0, len(self.languages)))
        for t in range(len(alive) - 1, -1, -1):
            k = int(alive[t])
            at = begins[:k] + t
            if k > len(state):
                state = np.concatenate([state, np.ones((k - len(state), state.shape[1]))])
            out[at] *= state
            out[at] /= out[at].sum(1, keepdims=True)
            onward = state * emit[at]
            if pairs is not None and t:
                both = out[at - 1][:, :, None] * step * onward[:, None, :]
                pairs += (both / both.sum((1, 2), keepdims=True)).sum(0)
            state = onward @ step.T
            state /= state.sum(1, keepdims=True)
        return out


def fit(samples: list[tuple[str, str]], settings: Settings = Settings()) -> Crf:
    """Learn from (language, text) rows."""
    languages = sorted({lang for lang, _ in samples})
    k = len(languages)
    model = Crf(settings, languages, np.zeros(((settings.longest_ngram + 1) * settings.slots, k)), np.zeros((k, k)), np.zeros(k), np.zeros(settings.slots, bool))
    rng = np.random.default_rng(7)
    index: dict[str, int] = {}
    runs = []
    for lang, text in samples:
        ids = [index.setdefault(w, len(index)) for w in words_of(text)]
        at = 0
        while at < len(ids):
            size = int(rng.geometric(1 / settings.run))
            runs.append((languages.index(lang), ids[at : at + size]))
            at += size
    if not runs:
        return model
    rng.shuffle(runs)
    line = np.asarray([i for _, ids in runs for i in ids])
    truth = np.asarray([lang for lang, ids in runs for _ in ids])
    lengths = np.full(-(-len(line) // settings.line), settings.line)
    lengths[-1] = len(line) - settings.line * (len(lengths) - 1)
    starts = np.cumsum(lengths) - lengths
    slots, owners = feature_slots([*index], settings)
    of_grams = slots[slots // settings.slots == BACKGROUND] % settings.slots
    model.seen[of_grams] = True
    inside = np.ones(len(line), bool)
    inside[starts] = False
    inner = np.flatnonzero(inside)
    observed = np.zeros((k, k))
    np.add.at(observed, (truth[inner - 1], truth[inner]), 1)
    begun = np.bincount(truth[starts], minlength=k).astype(float)
    # a word's observed labels don't change between passes
    hits = np.zeros((len(index), k))
    np.add.at(hits, (line, truth), 1)
    values = [model.weights, model.transitions, model.first]
    slopes = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for turn in range(1, settings.passes + 1):
        word_scores = model.scores(slots, owners, len(index))
        emit = word_scores[line]
        expected_pairs = np.zeros((k, k))
        found = model.marginals(emit, lengths, expected_pairs)
        expected = np.stack([np.bincount(line, found[:, j], len(index)) for j in range(k)], axis=1)
        per_word = hits - expected
        gradients = [
            np.stack([np.bincount(slots, per_word[owners, j], len(model.weights)) for j in range(k)], axis=1),
            observed - expected_pairs,
            begun - found[starts].sum(0),
        ]
        for value, (mean, spread), gradient in zip(values, slopes, gradients):
            gradient = gradient / len(line) * 100 - settings.decay * value
            mean += 0.1 * (gradient - mean)
            spread += 0.01 * (gradient**2 - spread)
            value += settings.rate * (mean / (1 - 0.9**turn)) / (np.sqrt(spread / (1 - 0.99**turn)) + 1e-4)
    return model


def sample(docs: DataFrame, learn: Column, settings: Settings, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """Training rows: of each language those with the smallest hashes of id and text, a number bounded by the settings.

    Equal rows count once, and no language takes another's places, whatever ids are missing or repeat.
    """
    rows = docs.where(learn & docs[lang_col].isNotNull() & docs[text_col].isNotNull() & (F.length(docs[text_col]) <= settings.longest))
    rows = rows.select(docs[lang_col].cast("string").alias("lang"), F.xxhash64(docs[id_col].cast("string"), docs[text_col].cast("string")).alias("place"), docs[text_col].cast("string").alias("text"))
    common = rows.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).orderBy(F.desc("n"), "lang").limit(settings.most_languages)
    n = {r["lang"]: r["n"] for r in common.collect()}
    if not n:
        return []
    # twice the distinct rows wanted lie below a language's border, on average; the smallest of them are taken
    span = F.pmod("place", F.lit(1 << 40)) / float(1 << 40)
    border = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(2 * settings.rows_per_language / max(count, 1) + 1e-9)) for lang, count in n.items()])
    low = rows.withColumn("span", span).where(F.col("span") <= border).groupBy("lang", "span", "place").agg(F.min("text").alias("text"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("span", "place"))
    chosen = low.withColumn("rank", rank).where(F.col("rank") <= settings.rows_per_language)
    return [(r["lang"], r["text"]) for r in chosen.orderBy("span", "place", "lang").collect()]


def train(docs: DataFrame, learn: Column, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Crf:
    return fit(sample(docs, learn, settings, id_col, text_col, lang_col), settings)


class Labeller:
    """Labels texts in one task; keeps the scores of words it has met."""

    def __init__(self, model: Crf):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.table: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))
        self.letters = np.zeros(0, bool)
        self.grams = np.zeros((2, 0))

    def label(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, words, switches, 3-grams and the share of these that is familiar, of each text."""
        model = self.model
        split = [words_of(t) for t in texts] if model.languages else [[] for _ in texts]
        if len(self.table) > TABLE_WORDS:
            self.forget()
        if new := [*{w for words in split for w in words} - self.table.keys()]:
            self.table.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            features = *feature_slots(new, model.settings), len(new)
            self.scores = np.concatenate([self.scores, model.scores(*features)])
            self.grams = np.concatenate([self.grams, np.stack(model.background(*features))], axis=1)
            self.letters = np.concatenate([self.letters, np.fromiter((any(map(str.isalpha, w)) for w in new), bool, len(new))])
        n = np.fromiter(map(len, split), np.int64, len(split))
        line = np.fromiter(map(self.table.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
        langs, means, switches = [UNKNOWN] * len(n), np.zeros(len(n)), np.zeros(len(n), np.int64)
        grams, familiar = np.zeros(len(n), np.int64), np.zeros(len(n))
        some = np.flatnonzero(n)
        if len(some):
            begins = (np.cumsum(n) - n)[some]
            found = model.marginals(self.scores[line], n[some])
            mean = np.add.reduceat(found, begins, axis=0) / n[some, None]
            likely = found.argmax(1)
            change = np.concatenate([[0], likely[1:] != likely[:-1]]).astype(np.int64)
            change[begins] = 0
            switches[some] = np.add.reduceat(change, begins)
            both = np.add.reduceat(self.grams[:, line], begins, axis=1)
            grams[some], familiar[some] = both[0], both[1] / np.maximum(both[0], 1)
            lettered = np.add.reduceat(self.letters[line].astype(np.int64), begins) > 0
            for i, best, value, ok in zip(some.tolist(), mean.argmax(1).tolist(), mean.max(1).tolist(), lettered.tolist()):
                if ok:
                    langs[i], means[i] = model.languages[best], min(value, 1.0)
        return langs, means, n, switches, grams, familiar


def predict(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches, n_grams, familiar) of each whole text.

    Switches: changes of the likeliest language. Familiar: the share of its 3-grams that training words have.
    """
    rows = id_and_text(docs, id_col, text_col)
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("n_words", T.LongType()), ("n_switches", T.LongType()), ("n_grams", T.LongType()), ("familiar", T.DoubleType())]
    schema = T.StructType([field_of(rows, "doc_id"), *[T.StructField(n, t, False) for n, t in fields]])
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        labeller = Labeller(shared.value)
        for batch in batches:
            for part, texts in chunks(batch, limit=LABEL_CHARS):
                langs, *numbers = labeller.label(texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), *map(pa.array, numbers)], names=schema.names)

    return rows.mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Crf, least: float = 0.5, familiar: float = 0.0, text_col: str = "text") -> DataFrame:
    """The rows, as they came, whose text has a language with a score of at least `least`.

    Of a text of `LEAST_GRAMS` 3-grams or more, at least the share `familiar` must occur in the training words, so that
    letter junk and languages that were not learnt go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        labeller = Labeller(shared.value)
        for batch in batches:
            for part, texts in chunks(batch, text_col, LABEL_CHARS):
                langs, scores, _, _, grams, shares = labeller.label(texts)
                strange = (grams >= LEAST_GRAMS) & (shares < familiar)
                yield part.filter(pa.array([lang != UNKNOWN and ok for lang, ok in zip(langs, ((scores >= least) & ~strange).tolist())]))

    return docs.mapInArrow(run, docs.schema)
