"""Quality rules combined by weak supervision, with DataFrame operations only.

Each rule looks at a document and votes good (1), bad (-1) or abstains (0). Instead of asking that
all rules pass, a generative model is fitted: a document is good or bad in one of a few ways (its letter case, its
marks, its repetitions, its length), and each rule votes with accuracies of its own on each of these classes.
Expectation-maximisation estimates the accuracies and the shares of the classes from how the rules agree, without any
label, and a document is kept if the posterior probability of good is at least a half. One class for everything bad would
not do: rules that object to the same kind of junk agree with each other, and a single class could explain only
one such agreement.

EM does not need the documents, only how often each combination of votes occurs; with k rules that is
at most 3^k rows, however large the corpus. One pass counts them, the iterations run on the counts, and
the posterior is then plain arithmetic on a document's own votes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, words, written

WINDOW = 8
SYMBOLS = "#*$%&|<>"


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` plus the column `m`, a struct of counts over the whole text (null text: no words).

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal
    an earlier line), n_repeat_words (words inside windows of eight that occur twice or more in the
    text), n_lines (with a word), n_upper, n_letters, n_signs (combining marks, such as vowel signs),
    n_exclaim (words ending in two exclamation marks), n_marks (words of one symbol), n_distinct
    (different words).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    # Each step is a column of its own, so that an array is built once and used several times.
    staged = docs.withColumns({"_text": text, "_words": words(F.col(text_col)), "_lines": lines})
    n = F.size("_words")
    staged = staged.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    staged = staged.withColumn("_windows", windows)
    # Most texts repeat no window. In the others the hashes are sorted with the place in their low bits,
    # and neighbours alike in the high bits are compared in full: equal windows end up side by side.
    low = F.expr("shiftleft(1L, cast(ceil(log2(size(_words) + 1)) as int)) - 1L")
    staged = staged.withColumn("_low", low)
    placed = F.sort_array(
        F.transform("_windows", lambda h, i: h.bitwiseAND(F.bitwise_not("_low")).bitwiseOR(i.cast("bigint")))
    )
    none = F.array().cast("array<bigint>")
    staged = staged.withColumn(
        "_placed",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed).otherwise(none),
    )

    def window_at(i: Column) -> Column:
        return F.get("_windows", F.get("_placed", i).bitwiseAND(F.col("_low")).cast("int"))

    alike = F.transform("_placed", lambda x, i: window_at(i) == window_at(i + 1))
    staged = staged.withColumn("_alike", alike)
    places = F.transform(
        "_placed",
        lambda x, i: F.when(
            F.coalesce(F.get("_alike", i), F.lit(False)) | F.coalesce(F.get("_alike", i - 1), F.lit(False)),
            x.bitwiseAND(F.col("_low")),
        ),
    )
    staged = staged.withColumn("_again", F.sort_array(F.filter(places, lambda x: x.isNotNull())))
    # A window at i covers eight words, but only up to where the next repeated window begins.
    covered = F.aggregate(
        F.transform(
            "_again",
            lambda x, k: F.least(
                F.lit(WINDOW).cast("bigint"), F.coalesce(F.get("_again", k + 1) - x, F.lit(WINDOW))
            ),
        ),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    size = F.length("_text")
    letters = F.length(F.regexp_replace("_text", r"\P{L}", ""))
    measures = {
        "n_words": n,
        "word_chars": F.length(F.translate("_text", SPACES, "")),
        "n_symbols": size - F.length(F.translate("_text", SYMBOLS, "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("_lines"),
        "n_upper": F.length(F.regexp_replace("_text", r"\P{Lu}", "")),
        "n_letters": letters,
        "n_signs": size - F.length(F.regexp_replace("_text", r"\p{M}+", "")),
        "n_exclaim": F.size(F.filter("_words", lambda w: F.endswith(w, F.lit("!!")))),
        "n_marks": F.size(F.filter("_words", lambda w: (F.length(w) == 1) & w.rlike(r"[^\p{L}\p{N}]"))),
        "n_distinct": F.size(F.array_distinct("_hashes")),
    }
    # explode() of one struct keeps the optimizer from copying these expressions to each of their uses.
    counted = F.struct(*[v.cast("bigint").alias(k) for k, v in measures.items()])
    return staged.withColumn("m", F.explode(F.array(counted))).drop("_text", "_words", "_lines", "_hashes", "_windows", "_low", "_placed", "_alike", "_again")


def base_failed() -> Column:
    """Fixed rule: too few words, or too many of them in repeated windows."""
    m = F.col("m")
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def votes() -> dict[str, Column]:
    """The rules as votes on the struct `m`; shares are compared without division.

    Every rule knows one kind of bad text and what is normal for a clean one of any length, and abstains in
    between. A text without words has nothing normal.
    """
    m = {k: F.col("m")[k] for k in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
        "n_letters", "n_signs", "n_exclaim", "n_marks", "n_distinct")}
    n, chars, letters, distinct = m["n_words"], m["word_chars"], m["n_letters"] + m["n_signs"], m["n_distinct"]
    rules = {
        "length": (n < 20, n >= 40),
        "word_length": ((chars < 2 * n) | (chars > 12 * n), (chars >= 3 * n) & (chars <= 9 * n)),
        "symbols": (5 * m["n_symbols"] > n, 50 * m["n_symbols"] <= n),
        "repeated_lines": (2 * m["n_dup_lines"] > m["n_lines"], m["n_dup_lines"] == 0),
        "repeated_words": (10 * m["n_repeat_words"] > 3 * n, 20 * m["n_repeat_words"] <= n),
        "capitals": (2 * m["n_upper"] > m["n_letters"], 5 * m["n_upper"] <= m["n_letters"]),
        "shouting": (10 * m["n_exclaim"] > n, m["n_exclaim"] == 0),
        "tables": (5 * m["n_marks"] > n, 20 * m["n_marks"] <= n),
        "letters": (10 * letters < 7 * chars, 20 * letters >= 17 * chars),
        # The number of different words grows slower than the text, but faster than its root.
        "variety": (distinct * distinct < n, distinct * distinct > 4 * n),
    }
    return {k: _vote(bad, good & (n > 0)) for k, (bad, good) in rules.items()}


# The kinds of bad text, each with the rules that are written to find it.
KINDS = {
    "case": ("capitals", "shouting"),
    "marks": ("symbols", "tables", "letters", "word_length"),
    "repeats": ("repeated_lines", "repeated_words", "variety"),
    "short": ("length",),
}
# What is believed before anything is seen, and as so many documents' worth: P(vote | class) for the votes
# 1, 0, -1 of a rule on good documents, on those it is written to find and on other bad ones, and the share of
# good documents. This ties the classes to their meaning; the data outweigh it as soon as there are more of them.
ON_GOOD, ON_ITS_KIND, ON_OTHERS = (0.83, 0.15, 0.02), (0.3, 0.2, 0.5), (0.7, 0.2, 0.1)
GOOD_SHARE = 0.8
PRIOR_DOCS = 10
VALUES = (1, 0, -1)
Table = tuple[float, ...]


@dataclass(frozen=True)
class Model:
    """For each class, good first, its share and for each rule P(vote | class) in the order of VALUES."""

    shares: Table
    rules: dict[str, tuple[Table, ...]]

    def numbers(self) -> list[float]:
        return [*self.shares, *(x for tables in self.rules.values() for table in tables for x in table)]

    def odds(self) -> list[Column]:
        """P(class | votes) / P(good | votes) of each bad class: what the shares and each vote say, in logarithms."""

        def says(rule, bad, good):
            said = [math.log(b / g) for b, g in zip(bad, good)]
            return F.when(F.col(rule) == 1, said[0]).when(F.col(rule) == -1, said[2]).otherwise(said[1])

        return [
            F.exp(reduce(
                add, [says(rule, tables[c], tables[0]) for rule, tables in self.rules.items()],
                F.lit(math.log(self.shares[c] / self.shares[0])),
            ))
            for c in range(1, len(self.shares))
        ]

    def posterior(self) -> Column:
        """P(good | votes)."""
        return 1 / (1 + reduce(add, self.odds(), F.lit(0.0)))


def start(kinds: dict[str, tuple[str, ...]], names: list[str]) -> Model:
    """The model before any document; `kinds` maps each kind of bad text to the rules that find it."""
    share = (1 - GOOD_SHARE) / len(kinds)
    return Model(
        (GOOD_SHARE, *[share] * len(kinds)),
        {r: (ON_GOOD, *[ON_ITS_KIND if r in found else ON_OTHERS for found in kinds.values()]) for r in names},
    )


def fit(
    patterns: DataFrame, names: list[str], kinds: dict[str, tuple[str, ...]], rounds: int = 60
) -> Model:
    """EM over (votes, n), n being how often a combination of votes occurs.

    A rule's accuracy is a table of its own for every class, so a rule that is silent on most bad
    documents still counts fully where it speaks, and one that objects to many good documents is learned to
    err. Tables and shares begin at `start` and keep it as PRIOR_DOCS documents' worth of evidence a class, which
    settles rules that never vote, classes without documents and an empty corpus; nothing else binds them.
    One row of sums is fetched a round.
    """
    prior = model = start(kinds, names)
    classes = range(len(prior.shares))
    weights = [F.col(f"w{c}") for c in classes]
    sums = [F.sum(w).alias(f"{c}") for c, w in zip(classes, weights)]
    for k in names:
        for value in (1, -1):
            sums += [F.sum(F.when(F.col(k) == value, w).otherwise(0.0)).alias(f"{k}_{value}_{c}") for c, w in zip(classes, weights)]
    for _ in range(rounds):
        odds = model.odds()
        shared = patterns.withColumns({f"o{c}": o for c, o in zip(classes[1:], odds)}).withColumn(
            "w0", F.col("n") / (1 + reduce(add, [F.col(f"o{c}") for c in classes[1:]]))
        )
        found = shared.withColumns({f"w{c}": F.col("w0") * F.col(f"o{c}") for c in classes[1:]}).agg(*sums).first()
        if found["0"] is None:
            break
        total = [found[str(c)] for c in classes]
        rules = {}
        for k in names:
            tables = []
            for c in classes:
                yes, no = found[f"{k}_1_{c}"], found[f"{k}_-1_{c}"]
                counts = (yes, max(total[c] - yes - no, 0.0), no)
                tables.append(tuple(
                    (x + PRIOR_DOCS * p) / (total[c] + PRIOR_DOCS) for x, p in zip(counts, prior.rules[k][c])
                ))
            rules[k] = tuple(tables)
        shares = tuple((t + PRIOR_DOCS * p) / (sum(total) + PRIOR_DOCS) for t, p in zip(total, prior.shares))
        before, model = model, Model(shares, rules)
        if max(abs(a - b) for a, b in zip(before.numbers(), model.numbers())) < 1e-3:
            break
    return model


def _voted(measured: DataFrame, names: list[str]) -> DataFrame:
    return measured.withColumns(dict(zip(names, votes().values())))


def _fitted(voted: DataFrame, names: list[str]) -> Model:
    counted = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    kinds = {kind: tuple(f"_vote_{r}" for r in found) for kind, found in KINDS.items()}
    return fit(written(counted.coalesce(1), "votes"), names, kinds)


def _verdict(voted: DataFrame, names: list[str], model: Model, least: float) -> DataFrame:
    return (
        voted.withColumn("base_failed", base_failed())
        .withColumn("posterior", model.posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))
        .drop(*names)
    )


def _vote_names() -> list[str]:
    return [f"_vote_{k}" for k in votes()]


def verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """One row per document: doc_id, `m` (the measures), `base_failed`, `posterior`, `kept`.

    The texts are read once. Null and empty texts have no words, fail the base rule and are not kept.
    Where all rules abstain the prior decides; a posterior of exactly `least` keeps. Repeated rows are judged
    alike, each in its own row; other columns are ignored; an empty table gives no rows.
    """
    names = _vote_names()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    measured = written(with_measures(picked, "text").drop("text"), "measures")
    voted = _voted(measured, names)
    return _verdict(voted, names, _fitted(voted, names), least)


def kept_rows(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs` that the verdict keeps, with their columns.

    The texts are measured once: rows are written with their votes, and never shuffled. As in `verdicts` for
    nulls, ties and repeated rows; columns may have any names.
    """
    names = _vote_names()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    measured = with_measures(docs.select(F.col(f"`{text_col}`").alias("_t"), row), "_t")
    voted = written(_voted(measured, names).select("_row", base_failed().alias("base_failed"), *names), "voted_rows")
    model = _fitted(voted, names)
    return voted.where(~F.col("base_failed") & (model.posterior() >= least)).select("_row.*")
