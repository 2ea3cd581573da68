"""Language identification by words, with a penalty for switching languages inside a text.

Learning: on a bounded sample of labelled texts, character trigrams and short words are counted per
language, and the scripts that a language's words are written in.

Prediction: a word's script leaves only the languages that use it; each of these scores the word by the
log likelihood of its trigrams; Viterbi over the words finds the labelling with the best total, where
every change of language costs `SWITCH`. So a text falls into spans of one language each, and a single
odd word does not break a span. The text's language is the one with most letters.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType,
)

from .common import split_words, written

SWITCH = 10.0
# One word speaks against a language of its script by no more than this: less than two switches, so a
# single odd word inside a span does not break it.
WORD_LIMIT = 15.0
OTHER_SCRIPT = 50.0
# Bounds of the sample and of the model that is learned from it.
TEXTS_PER_LANGUAGE = 2000
FEATURES_PER_LANGUAGE = 30_000
SCRIPT_SHARE = 0.02
CACHED_WORDS = 400_000
STEP_WORDS = 400_000
# Letters by category: other number characters (½, ②, Ⅷ) are word characters to `re`, but no letters.
LETTERS = regex.compile(r"\p{L}+")

# First code point of a range and its script; ranges run to the next entry.
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFE0, "other"), (0x20000, "han"), (0x323B0, "other"),
)
_STARTS = [start for start, _ in SCRIPT_STARTS]


def script(word: str) -> str:
    """The script of most of a word's letters, the first one on a tie.

    Han and kana are written together, so against other scripts they count as one.
    """
    if word.isascii():
        return "latin"
    found = Counter(SCRIPT_STARTS[bisect_right(_STARTS, ord(c)) - 1][1] for c in word)
    top, n = found.most_common(1)[0]
    east = max(("han", "kana"), key=found.__getitem__)
    return east if found["han"] + found["kana"] > n else top


def letters_of(word: bytes) -> str:
    """The letters of a word in lower case; empty if it has none."""
    return "".join(LETTERS.findall(word.decode())).lower()


def features(word: str) -> list[str]:
    """Trigrams of a word with its ends marked, and the word itself if short."""
    padded = f"^{word}$"
    grams = [padded[i : i + 3] for i in range(len(padded) - 2)]
    return grams + [f"={word}"] if len(word) <= 5 else grams


@dataclass(frozen=True)
class Model:
    """Languages in order, log likelihoods of features per language, unseen features, and scripts."""

    languages: tuple[str, ...]
    likelihood: dict[str, tuple[float, ...]]
    unseen: tuple[float, ...]
    scripts: dict[str, tuple[bool, ...]]
    usual: int

    def word_scores(self, word: str) -> tuple[float, ...]:
        """Log likelihood per language, relative to the best; all 0 if the script is nobody's."""
        allowed = self.scripts.get(script(word))
        if not allowed or not any(allowed):
            return (0.0,) * len(self.languages)
        total = [0.0] * len(self.languages)
        for f in features(word):
            for i, x in enumerate(self.likelihood.get(f, self.unseen)):
                total[i] += x
        best = max(x for x, a in zip(total, allowed) if a)
        return tuple(max(x - best, -WORD_LIMIT) if a else -OTHER_SCRIPT for x, a in zip(total, allowed))


def held_out(id_col: str) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
    texts: int = TEXTS_PER_LANGUAGE, kept: int = FEATURES_PER_LANGUAGE,
) -> Model:
    """A model from rows (text, language); nulls are skipped.

    Of each language the `texts` different texts with the least hash are used, each once, and the `kept`
    most frequent features, so what reaches the driver is bounded by the number of languages.
    """
    schema = StructType(
        [StructField("lang", StringType()), StructField("feature", StringType()),
         StructField("n", LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                for raw, n in Counter(split_words(text)).items():
                    word = letters_of(raw)
                    if word:
                        counts[lang][f"#{script(word)}"] += n
                        for f in features(word):
                            counts[lang][f] += n
        rows = [(lang, f, n) for lang, found in counts.items() for f, n in found.items()]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.int64())],
            names=schema.names,
        )

    picked = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    picked = picked.withColumn("hash", F.xxhash64("text"))

    def first(rows: DataFrame, *order: str) -> DataFrame:
        least = Window.partitionBy("lang").orderBy(*order)
        return rows.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= texts).drop("nth")

    # The hashes are chosen first, so that only the texts of the sample are moved to drop copies; the
    # second choice matters only where different texts share a hash.
    chosen = written(first(picked.select("lang", "hash").distinct(), "hash"), "sample_hashes")
    sample = first(picked.join(chosen, ["lang", "hash"]).dropDuplicates(["lang", "text"]), "hash", "text")
    counted = sample.select("text", "lang").mapInArrow(count, schema)
    totals = written(counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")), "features")
    common = Window.partitionBy("lang").orderBy(F.desc("n"), "feature")
    rows = totals.withColumn("nth", F.row_number().over(common)).where(F.col("nth") <= kept).collect()
    return _model([(r["lang"], r["feature"], r["n"]) for r in rows])


def _model(rows: list[tuple[str, str, int]]) -> Model:
    languages = tuple(sorted({lang for lang, _, _ in rows}))
    at = {lang: i for i, lang in enumerate(languages)}
    counts: dict[str, list[int]] = {}
    scripts: dict[str, list[int]] = {}
    for lang, feature, n in rows:
        of = scripts if feature[0] == "#" else counts
        of.setdefault(feature, [0] * len(languages))[at[lang]] += n
    totals = [sum(c[i] for c in counts.values()) for i in range(len(languages))]
    bottom = [math.log(t + 0.5 * (len(counts) + 1)) for t in totals]
    words = [sum(c[i] for c in scripts.values()) for i in range(len(languages))]
    return Model(
        languages,
        {f: tuple(math.log(n + 0.5) - b for n, b in zip(c, bottom)) for f, c in counts.items()},
        tuple(math.log(0.5) - b for b in bottom),
        {s[1:]: tuple(n >= SCRIPT_SHARE * w and n > 0 for n, w in zip(c, words))
         for s, c in scripts.items()},
        int(np.argmax(words)) if words else 0,
    )


class Labeller:
    """Viterbi over the words of many texts at a time."""

    def __init__(self, model: Model, switch: float):
        self.model, self.switch = model, switch
        self.forget()

    def forget(self) -> None:
        # Row 0 stands for words without letters: no scores, no weight.
        self.known: dict[bytes, int] = {}
        self.scores: list[tuple[float, ...]] = [(0.0,) * len(self.model.languages)]
        self.weights: list[int] = [0]
        self.rows: dict[str, int] = {"": 0}

    def number(self, text: str | None) -> np.ndarray:
        """A text's words as rows of the score table."""
        words, known = split_words(text), self.known
        for w in words:
            if w not in known:
                word = letters_of(w)
                if word not in self.rows:
                    self.rows[word] = len(self.scores)
                    self.scores.append(self.model.word_scores(word))
                    self.weights.append(len(word))
                known[w] = self.rows[word]
        return np.fromiter((known[w] for w in words), np.int32, len(words))

    def label(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """The language of each word; texts go through side by side, sorted by length."""
        table = np.array(self.scores, np.float32)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        result: list[np.ndarray] = [np.empty(0, np.int8)] * len(texts)
        at = 0
        while at < len(order):
            width = max(1, STEP_WORDS // max(1, len(texts[order[at]])))
            group = order[at : at + width]
            at += width
            for i, labels in zip(group, self._side_by_side([texts[i] for i in group], table)):
                result[i] = labels
        return result

    def _side_by_side(self, texts: list[np.ndarray], table: np.ndarray) -> list[np.ndarray]:
        lengths = np.array([len(t) for t in texts])
        longest = int(lengths[0])
        if not longest:
            return [np.empty(0, np.int8)] * len(texts)
        words = np.zeros((longest, len(texts)), np.int32)
        for j, t in enumerate(texts):
            words[: len(t), j] = t
        # Texts are in order of length, so those that still run at a step are the first ones.
        running = np.searchsorted(-lengths, -np.arange(longest), "left")
        best = table[words[0]]
        came = np.zeros((longest, len(texts), table.shape[1]), np.int8)
        stay = np.arange(table.shape[1], dtype=np.int8)
        for t in range(1, longest):
            n = running[t]
            now = best[:n]
            top = now.argmax(axis=1).astype(np.int8)
            over = now.max(axis=1)[:, None] - self.switch
            change = now < over
            came[t, :n] = np.where(change, top[:, None], stay)
            best[:n] = np.where(change, over, now) + table[words[t, :n]]
        labels = np.zeros((longest, len(texts)), np.int8)
        state = best.argmax(axis=1).astype(np.int8)
        every = np.arange(len(texts))
        for t in range(longest - 1, -1, -1):
            n = running[t]
            labels[t, :n] = state[:n]
            if t:
                state[:n] = came[t, every[:n], state[:n]]
        return [labels[: len(t), j] for j, t in enumerate(texts)]


def identify(
    docs: DataFrame, model: Model, switch: float = SWITCH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, spans.

    `spans` holds (lang, first_word, n_words), which together cover the text's words. `score` is the
    share of the text's letters in spans of `lang_pred`, between 0 and 1; of several languages with
    most letters the first by name is taken. Null texts and texts without letters are `und` with score
    0 and no spans, as are all texts if nothing was learned; a text with letters of unknown scripts
    only gets the language with most words in the sample, with score 0. Rows are taken one by one, so
    repeated rows need no care; other columns are ignored; an empty table gives no rows.
    """
    span = StructType(
        [StructField("lang", StringType()), StructField("first_word", LongType()),
         StructField("n_words", LongType())]
    )
    schema = StructType(
        [StructField("doc_id", docs.schema[id_col].dataType), StructField("lang_pred", StringType()),
         StructField("score", DoubleType()), StructField("spans", ArrayType(span))]
    )
    arrow_span = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
    languages = model.languages

    def verdict(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, informed: np.ndarray):
        letters = weights[rows]
        if not languages or not letters.any():
            return "und", 0.0, []
        cuts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
        sizes = np.diff(np.r_[cuts, len(labels)])
        spans = [{"lang": languages[k], "first_word": int(a), "n_words": int(n)}
                 for k, a, n in zip(labels[cuts], cuts, sizes)]
        if not informed[rows].any():
            return languages[model.usual], 0.0, spans
        share = np.bincount(labels, letters, len(languages))
        top = int(share.argmax())
        return languages[top], float(share[top] / share.sum()), spans

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, switch)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                piece = batch.slice(at, 2000)
                if len(labeller.known) > CACHED_WORDS:
                    labeller.forget()
                numbered = [labeller.number(t) for t in piece.column(1).to_pylist()]
                labels = labeller.label(numbered) if languages else numbered
                weights = np.array(labeller.weights)
                informed = np.array([any(s) for s in labeller.scores])
                found = [verdict(n, k, weights, informed) for n, k in zip(numbered, labels)]
                lang, score, spans = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(spans, pa.list_(arrow_span))],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(scan, schema)
