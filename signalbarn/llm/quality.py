"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation says how far to trust each.

Everything on the rows is column expressions. Each document's measures are taken
in one pass over its text and written once; every rule turns them into a vote
for (1) or against (-1) the document, or abstains (0). Votes are counted by
pattern, of which there are at most 3 ** rules, and from these counts the
rules' accuracies in good and in bad documents and the share of good ones are
estimated without labels. A document's posterior probability of being good is
then a sum over its votes; it is kept at THRESHOLD or more, so that no single
rule rejects it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import bound, written

#: What separates words, and what counts as a symbol.
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Documents that fail whatever the rules say: fewer words, or a greater share (in percent) in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
THRESHOLD = 0.5
#: Rounds of the estimation end at this change or after so many.
CHANGE, MOST_ROUNDS = 1e-9, 500
#: Votes that each rule is taken to have given before any is seen: right and wrong ones. No rule is held worse than
#: chance on either class, so that the classes cannot change places or turn into two kinds of good documents.
RIGHT, WRONG = 8.0, 2.0
LEAST_ACCURACY, MOST_ACCURACY = 0.5, 0.999

_CLOSED = "[.!?…:;\"'»”’)\\]。！？]$"


def _pick(text: Column, pattern: str) -> Column:
    """How many characters of the text are left without those of the pattern."""
    return F.length(F.regexp_replace(text, pattern, ""))


def words_in(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SEPARATORS, " " * len(SEPARATORS)), " ", -1), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that occur twice or more in the same array. Words are compared by 64-bit hashes."""

    def windows(h: Column) -> Column:
        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (window - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, window)]))

    def places(entries: Column) -> Column:
        twice = F.filter(
            entries, lambda e, k: F.coalesce(F.get(entries, k - 1)["x"] == e["x"], F.lit(False)) | F.coalesce(F.get(entries, k + 1)["x"] == e["x"], F.lit(False))
        )
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    def covered(all_windows: Column) -> Column:
        entries = F.sort_array(F.transform(all_windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

        def add(done, i):
            return F.struct((i + window).alias("end"), (done["n"] + i + window - F.greatest(done["end"], i)).alias("n"))

        return F.aggregate(bound(entries, places), start, add, lambda done: done["n"])

    def count(all_windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(all_windows)) == F.size(all_windows), F.lit(0)).otherwise(covered(all_windows))

    return bound(bound(F.transform(words, lambda w: F.xxhash64(w)), windows), count)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without the text, with its measures; a null text has no words."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda line: F.length(F.translate(line, SEPARATORS, "")) > 0)

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n"), repeated_words(words).cast("long").alias("repeated"))

    def of_lines(each: Column) -> Column:
        closed = F.size(F.filter(each, lambda line: F.rtrim(line, F.lit(SEPARATORS)).rlike(_CLOSED)))
        return F.struct(F.size(each).alias("n"), F.size(F.array_distinct(each)).alias("kinds"), closed.alias("closed"))

    out = docs.withColumn("of_words", bound(words_in(t), of_words)).withColumn("of_lines", bound(lines, of_lines))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != text],
        F.col("of_words.n").alias("n_words"),
        F.length(F.translate(t, SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.col("of_lines.n") - F.col("of_lines.kinds")).cast("long").alias("n_dup_lines"),
        F.col("of_words.repeated").alias("n_repeat_words"),
        F.col("of_lines.n").alias("n_lines"),
        F.col("of_lines.closed").alias("n_closed_lines"),
        _pick(t, r"\P{L}+").alias("n_letters"),
        _pick(t, r"\P{Lu}+").alias("n_capitals"),
    )


@dataclass(frozen=True)
class Rule:
    """Votes for a document whose measure lies in `good`, against one whose lies beyond `bad`, and abstains in between."""

    name: str
    measure: str
    good: tuple[float, float]
    bad: tuple[float, float]
    #: Where the rule has nothing to go by, it abstains.
    unless: str = "false"

    def vote(self) -> Column:
        m = F.expr(self.measure)
        voted = F.when(m.between(*self.good), 1).when((m <= self.bad[0]) | (m >= self.bad[1]), -1).otherwise(0)
        return F.when(F.expr(self.unless), 0).otherwise(F.coalesce(voted, F.lit(0))).cast("int").alias(self.name)


_FAR = 1e300
RULES = (
    Rule("length", "n_words", (50, _FAR), (LEAST_WORDS - 1, _FAR)),
    Rule("word_length", "word_chars / n_words", (3, 6.5), (2, 8), "n_words = 0"),
    Rule("symbols", "n_symbols / n_words", (0, 0.02), (-1, 0.1), "n_words = 0"),
    Rule("repeated_lines", "n_dup_lines / n_lines", (0, 0.1), (-1, 0.3), "n_lines < 2"),
    Rule("repeated_words", "n_repeat_words / n_words", (0, 0.05), (-1, 0.15), f"n_words < {WINDOW}"),
    Rule("letters", "n_letters / word_chars", (0.85, 1), (0.7, 2), "word_chars = 0"),
    Rule("capitals", "n_capitals / n_letters", (0, 0.2), (-1, 0.5), "n_letters = 0"),
    Rule("closed_lines", "n_closed_lines / n_lines", (0.7, 1), (0.3, 2), "n_lines = 0"),
)


@dataclass
class VoteModel:
    """The share of good documents, and each rule's share of right votes on good and on bad ones."""

    good: float
    right_on_good: list[float]
    right_on_bad: list[float]

    def weights(self) -> list[tuple[float, float]]:
        """What a vote for and a vote against adds to the log odds of a good document."""
        return [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(self.right_on_good, self.right_on_bad)]

    def log_odds(self, votes) -> float:
        own = sum(w[0] if v > 0 else w[1] if v < 0 else 0.0 for v, w in zip(votes, self.weights()))
        return math.log(self.good / (1 - self.good)) + own


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int) -> VoteModel:
    """Expectation-maximisation over (votes, count), from the majority's view on. Abstaining says nothing."""
    start = RIGHT / (RIGHT + WRONG)
    model = VoteModel(start, [start] * rules, [start] * rules)
    between = lambda x: min(MOST_ACCURACY, max(LEAST_ACCURACY, x))
    for _ in range(MOST_ROUNDS):
        good = bad = 0.0
        for_good, for_bad = [[0.0, 0.0] for _ in range(rules)], [[0.0, 0.0] for _ in range(rules)]
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.log_odds(votes)))))
            good, bad = good + n * p, bad + n * (1 - p)
            for r, v in enumerate(votes):
                if v:
                    for_good[r][v > 0] += n * p
                    for_bad[r][v < 0] += n * (1 - p)
        share = (good + RIGHT) / (good + bad + RIGHT + WRONG)
        new = VoteModel(share, *[[between((yes + RIGHT) / (yes + no + RIGHT + WRONG)) for no, yes in x] for x in (for_good, for_bad)])
        change = max(abs(a - b) for a, b in zip([new.good, *new.right_on_good, *new.right_on_bad], [model.good, *model.right_on_good, *model.right_on_bad]))
        model = new
        if change < CHANGE:
            break
    return model


def fit_votes(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """The model of all rows of measured documents; at most 3 ** rules counts go to the driver."""
    names = [r.name for r in rules]
    counts = measured.select(*[r.vote() for r in rules]).groupBy(*names).agg(F.count("*").alias("rows"))
    return estimate(sorted((tuple(r[n] for n in names), r["rows"]) for r in counts.collect()), len(rules))


def quality(measured: DataFrame, model: VoteModel, rules: tuple[Rule, ...] = RULES) -> Column:
    """The posterior probability that a document is good."""
    odds = F.lit(math.log(model.good / (1 - model.good)))
    for rule, (yes, no) in zip(rules, model.weights()):
        vote = rule.vote()
        odds = odds + F.when(vote > 0, yes).when(vote < 0, no).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge_quality(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs(doc_id, text): its measures, base_failed, kept and the posterior `quality`.

    Null and empty texts have no words and fail; repeated rows count and give
    results as often as they occur; null ids are kept. An empty table gives no
    rows. Other columns are not read. A document's words are held by one task.
    """
    measured = written(measures(docs.select("doc_id", "text")), "measures")
    model = fit_votes(measured)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scored = measured.withColumn("quality", quality(measured, model)).withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("quality") >= threshold)
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "quality"
    )
