"""Toxicity by class-conditional Kneser-Ney models of the letters in words.

A word is spelled letter by letter; each letter's context is the word so far, at
most its last five letters. For a class c (toxic, ordinary)

    P_c(x | context) = max(n_c - D, 0) / N_c + G_c / N_c * P(x | context)

with n_c and N_c the class's count and total and G_c what the discount D took.
P is the backoff both classes share: an interpolated Kneser-Ney model of all
documents, labelled or not, that knows the last two letters and counts the
contexts a letter follows, not its occurrences. Tasks count the n-grams of their
texts' words, Spark aggregates add them up; n-grams and contexts are told apart
by their letters, in tables that grow with the corpus.

A text's score compares the two log-likelihoods per word: the mean of the words'
log ratios and the mean of what they exceed `STRONG` by, brought to 0..1 by a
logistic curve that is fitted on labelled rows the counts of the classes do not
hold. Scoring needs the n-grams that labelled rows hold more often than the
discount and the contexts they hold at all. While these are at most HELD_ENTRIES,
counted first, every worker gets them and a text is scored where it is read.
Beyond that, texts are read in batches and the tables are joined, with the same
results: a batch asks once for each of its distinct words, and a batch of words
once for each of its n-grams, so that frequent ones are no hot keys and only
lists of places are shuffled.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import fold, tidy, written

CONTEXT, LOW_CONTEXT = 5, 2
#: Log ratios of n-grams are summed in whole parts of this size, whose sum is the same in any order.
PARTS = 1 << 32
DISCOUNT = 0.75
#: Discount of the class's own counts. Most words of toxic texts are ordinary: what was seen a few times proves nothing.
CLASS_DISCOUNT = 3.0
#: Log ratio of a word above which it counts as a strong sign.
STRONG = 2.0
#: About so many labelled rows, chosen by the hash of their ids, are used for the class counts and the curve.
LABELLED_ROWS = 400_000
#: Different words a worker counts before it passes their n-grams on, and those whose ratios it remembers.
WORDS_HELD, RATIOS_HELD = 200_000, 150_000
#: N-grams and contexts, some 150 bytes each, that a worker may hold to score by. Larger models are joined.
HELD_ENTRIES = 2_000_000
#: A batch of texts ends at so many pairs of a text and a word, or so many texts; a batch of words at so many words.
PAIRS_HELD, TEXTS_HELD, SPELLED = 200_000, 65_535, 100_000
HELD_OUT_FOLD, CURVE_FOLD = 2, 3
THRESHOLD = 0.3
#: Letters of a word that are read as one; longer runs of letters are cut into such words.
LONGEST_WORD = 64

_WORD = re.compile(rf"[^\W_]{{1,{LONGEST_WORD}}}")
#: Texts of ASCII signs alone are cut at the same places by turning all else into blanks.
_BLANKS = {i: " " for i in range(128) if not chr(i).isalnum()}


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    if text.isascii():
        words = text.translate(_BLANKS).split()
        if max(map(len, words), default=0) <= LONGEST_WORD:
            return words
    return _WORD.findall(text)


def grams_of(word: str) -> list[str]:
    """For each letter of a word, and its end: its context with the letter."""
    w = f"\x01{word}\x02"
    return [w[max(0, i - CONTEXT) : i + 1] for i in range(1, len(w))]


def spellings(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The n-grams of each word, and the word's position."""
    grams = [g for w in words for g in grams_of(w)]
    return grams, np.repeat(np.arange(len(words)), [len(w) + 1 for w in words])


@dataclass
class ToxicityModel:
    """Log ratios, in parts, of n-grams (gram, ratio) and, for n-grams never counted, of contexts (context, ratio); the curve's weights."""

    grams: DataFrame
    contexts: DataFrame
    curve: tuple[float, float, float] = (0.0, 0.0, -20.0)

    @cached_property
    def held(self):
        """Both tables as dictionaries for every worker, or None where they are too large."""
        if self.grams.count() + self.contexts.count() > HELD_ENTRIES:
            return None
        tables = [df.toArrow().to_pydict() for df in (self.grams, self.contexts)]  # at most HELD_ENTRIES rows
        both = tuple(dict(zip(t[key], t["ratio"])) for t, key in zip(tables, ("gram", "context")))
        return self.grams.sparkSession.sparkContext.broadcast(both)


def gram_counts(docs: DataFrame) -> DataFrame:
    """Rows (gram, in_toxic, in_ordinary) of each n-gram of docs(text, class); class 1 is toxic, 0 ordinary, null neither."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # of unlabelled texts only which words they hold is asked
        held: dict = {1: Counter(), 0: Counter(), -1: set()}

        def frame() -> pd.DataFrame:
            times = {1: Counter(), 0: Counter()}
            seen: set[str] = set()
            for w in held[-1]:
                seen.update(grams_of(w))
            for c, own in times.items():
                for w, n in held[c].items():
                    for g in grams_of(w):
                        own[g] += n
                seen.update(own)
            for words in held.values():
                words.clear()
            grams = list(seen)
            counts = {name: np.array([times[c][g] for g in grams], np.int64) for name, c in (("in_toxic", 1), ("in_ordinary", 0))}
            return pd.DataFrame({"gram": pd.Series(grams, dtype=object), **counts})

        for batch in batches:
            for text, c in zip(batch["text"], batch["class"].fillna(-1)):
                held[int(c)].update(words_of(text))
                if sum(map(len, held.values())) > WORDS_HELD:
                    yield frame()
        yield frame()
        tidy()

    counted = docs.select("text", "class").mapInPandas(count, "gram string, in_toxic long, in_ordinary long")
    return counted.groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("in_toxic", "in_ordinary")))


def _context(gram: Column) -> Column:
    return F.substring(gram, F.lit(1), F.length(gram) - 1)


def low_orders(grams: DataFrame) -> DataFrame:
    """Rows (low_gram, shared): the backoff's probability of a letter after the last two."""
    low_gram = F.substring("gram", -(LOW_CONTEXT + 1), LOW_CONTEXT + 1)
    low = grams.groupBy(low_gram.alias("low_gram")).agg(F.count("*").alias("n"))
    low = low.withColumn("low_context", _context(F.col("low_gram"))).withColumn("letter", F.substring("low_gram", -1, 1))
    low = written(low, "low_grams")
    contexts = low.groupBy("low_context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    types = max(1, low.count())
    letter = F.greatest(F.count("*") - DISCOUNT, F.lit(0.0)) / types + DISCOUNT / types
    letters = F.broadcast(low.groupBy("letter").agg(letter.alias("alone")))  # as many rows as there are letters
    shared = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total") + DISCOUNT * F.col("kinds") / F.col("total") * F.col("alone")
    return low.join(contexts, "low_context").join(letters, "letter").select("low_gram", shared.alias("shared"))


def log_ratios(grams: DataFrame) -> ToxicityModel:
    """The model of the counted n-grams.

    An n-gram that no class has counted beyond the discount is judged by its
    context alone, one whose context no class has seen tells nothing.
    """
    both = ["in_toxic", "in_ordinary"]
    keyed = grams.withColumn("context", _context(F.col("gram")))
    contexts = (
        keyed.where("in_toxic + in_ordinary > 0")
        .groupBy("context")
        .agg(
            *[F.sum(c).cast("double").alias(f"total_{c}") for c in both],
            *[F.sum(F.least(F.col(c).cast("double"), F.lit(CLASS_DISCOUNT))).alias(f"given_{c}") for c in both],
        )
    )
    left = {c: F.when(F.col(f"total_{c}") > 0, F.col(f"given_{c}") / F.col(f"total_{c}")).otherwise(1.0) for c in both}
    contexts = written(contexts.select("context", *[f"total_{c}" for c in both], *[left[c].alias(f"left_{c}") for c in both]), "contexts")

    def ratio(each) -> Column:
        return F.round((F.log(each(both[0])) - F.log(each(both[1]))) * PARTS).cast("long").alias("ratio")

    def likelihood(c: str) -> Column:
        own = F.greatest(F.col(c) - CLASS_DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"total_{c}"), F.lit(1.0))
        return F.greatest(own + F.col(f"left_{c}") * F.col("shared"), F.lit(1e-12))

    seen = keyed.where(" or ".join(f"{c} > {CLASS_DISCOUNT}" for c in both))
    seen = seen.withColumn("low_gram", F.substring("gram", -(LOW_CONTEXT + 1), LOW_CONTEXT + 1))
    seen = seen.join(low_orders(grams), "low_gram").join(contexts, "context").select("gram", ratio(likelihood))
    return ToxicityModel(written(seen, "gram_ratios"), contexts.select("context", ratio(lambda c: F.col(f"left_{c}"))))


def word_ratios(words: DataFrame, model: ToxicityModel) -> DataFrame:
    """Rows (word, ratio) of words(word), which are distinct: the sum of the log ratios of a word's n-grams."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, n, held = TaskContext.get().partitionId(), 0, []

        def frame() -> pd.DataFrame:
            nonlocal n
            batch, n = part << 32 | n, n + 1
            grams, word = spellings(held)
            code, each = pd.factorize(np.array(grams, object))
            order = np.argsort(code, kind="stable")
            ends = np.cumsum(np.bincount(code, minlength=len(each)))
            places = word[order].astype("<u4")
            out = pd.DataFrame({"batch": batch, "gram": each, "places": [p.tobytes() for p in np.split(places, ends[:-1])]})
            # the words themselves, under a key of their own that is no n-gram
            own = pd.DataFrame({"batch": [batch], "gram": [f" {batch}"], "places": ["\n".join(held).encode()]})
            held.clear()
            return pd.concat([out, own])

        for batch in batches:
            held += batch["word"].tolist()
            if len(held) >= SPELLED:
                yield frame()
        if held:
            yield frame()

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["gram"].str.startswith(" ")
        words = rows["places"][own].iloc[0].decode().split("\n")
        sums = np.zeros(len(words), np.int64)
        rows = rows[~own]
        places = np.frombuffer(b"".join(rows["places"]), "<u4")
        np.add.at(sums, places, np.repeat(rows["ratio"].to_numpy(np.int64), rows["places"].str.len().to_numpy() // 4))
        return pd.DataFrame({"word": words, "ratio": sums / PARTS})

    asked = words.select("word").mapInPandas(ask, "batch long, gram string, places binary").withColumn("context", _context(F.col("gram")))
    grams = model.grams.withColumnRenamed("ratio", "of_gram")
    contexts = model.contexts.withColumnRenamed("ratio", "of_context")
    told = asked.join(grams, "gram", "left").join(contexts, "context", "left")
    told = told.select("batch", "gram", "places", F.coalesce("of_gram", "of_context", F.lit(0)).alias("ratio"))
    return told.groupBy("batch").applyInPandas(add, "word string, ratio double")


_PAIR = np.dtype([("text", "<u2"), ("n", "<u4")])


class _Ratios(dict):
    """Log ratios of words, those of late remembered."""

    def __init__(self, grams: dict[str, int], contexts: dict[str, int]):
        super().__init__()
        self.grams, self.contexts = grams, contexts

    def __missing__(self, word: str) -> float:
        if len(self) >= RATIOS_HELD:
            self.clear()
        total = 0
        for gram in grams_of(word):
            ratio = self.grams.get(gram)
            total += self.contexts.get(gram[:-1], 0) if ratio is None else ratio
        self[word] = ratio = total / PARTS
        return ratio


def text_signs(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """A row for each row of docs(doc_id, text): doc_id, the hash of the text, and the two signs; 0 for texts without words."""
    tables = model.held
    if tables is None:
        return joined_signs(docs, model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ratios = _Ratios(*tables.value)
        for batch in batches:
            signs = np.zeros((len(batch), 2))
            for i, text in enumerate(batch["text"]):
                if words := words_of(text):
                    each = np.fromiter(map(ratios.__getitem__, words), float, len(words))
                    signs[i] = each.mean(), np.maximum(each - STRONG, 0).mean()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "key": batch["key"], "mean": signs[:, 0], "strong": signs[:, 1]})
        ratios.clear()
        tidy()

    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    return keyed.mapInPandas(score, "doc_id long, key long, mean double, strong double")


def joined_signs(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The same by joins, for models of any size."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        codes: dict[str, int] = {}
        word, text, times, own = array("L"), array("L"), array("L"), []

        def frame() -> pd.DataFrame:
            nonlocal n
            batch, n = part << 32 | n, n + 1
            code = np.array(word, np.int64)
            order = np.argsort(code, kind="stable")
            pairs = np.empty(len(code), _PAIR)
            pairs["text"], pairs["n"] = np.array(text, np.int64)[order], np.array(times, np.int64)[order]
            ends = np.cumsum(np.bincount(code, minlength=len(codes)))
            found = [pairs[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends)] if codes else []
            out = pd.DataFrame({"batch": batch, "number": np.arange(len(codes)), "word": list(codes), "pairs": found})
            # the rows themselves, under a key of their own that is no word
            rows = np.array(own, np.int64).tobytes()
            rows = pd.DataFrame({"batch": [batch], "number": [-1], "word": [f" {batch}"], "pairs": [rows]})
            codes.clear()
            own.clear()
            del word[:], text[:], times[:]
            return pd.concat([out, rows])

        for batch in batches:
            for doc_id, key, t in zip(batch["doc_id"].astype(object), batch["key"], batch["text"]):
                counts = Counter(words_of(t))
                word.extend([codes.setdefault(w, len(codes)) for w in counts])
                text.extend([len(own)] * len(counts))
                times.extend(counts.values())
                known = not pd.isna(doc_id)
                own.append((known, int(doc_id) if known else 0, key))
                if len(word) >= PAIRS_HELD or len(own) >= TEXTS_HELD:
                    yield frame()
        if own:
            yield frame()

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        own = np.frombuffer(rows["pairs"].iloc[0], np.int64).reshape(-1, 3)
        pairs = np.frombuffer(b"".join(rows["pairs"].iloc[1:]), _PAIR)
        ratio = np.repeat(rows["ratio"].to_numpy(float)[1:], rows["pairs"].str.len().to_numpy()[1:] // _PAIR.itemsize)
        n = np.maximum(np.bincount(pairs["text"], pairs["n"], len(own)), 1)
        out = pd.DataFrame({"doc_id": pd.array(own[:, 1], "Int64"), "key": own[:, 2]})
        out.loc[own[:, 0] == 0, "doc_id"] = pd.NA
        out["mean"] = np.bincount(pairs["text"], pairs["n"] * ratio, len(own)) / n
        out["strong"] = np.bincount(pairs["text"], pairs["n"] * np.maximum(ratio - STRONG, 0), len(own)) / n
        return out

    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    asked = written(keyed.mapInPandas(index, "batch long, number long, word string, pairs binary"), "asked")
    ratios = word_ratios(asked.where("number >= 0").select("word").distinct(), model)
    told = asked.join(written(ratios, "word_ratios"), "word", "left").select("batch", "number", "pairs", "ratio")
    return told.groupBy("batch").applyInPandas(add, "doc_id long, key long, mean double, strong double")


def fit_curve(signs: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic weights of the two signs and the constant, by Newton's method with a small ridge."""
    if not len(toxic) or toxic.min() == toxic.max():
        share = (toxic.sum() + 0.5) / (len(toxic) + 10)
        return 0.0, 0.0, float(np.log(share / (1 - share)))
    scale = np.maximum(signs.std(axis=0), 1e-9)
    x = np.column_stack([signs / scale, np.ones(len(signs))])
    w = np.zeros(3)
    ridge = np.diag([1e-2, 1e-2, 1e-4])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (toxic - p) - ridge @ w)
        w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / scale[0]), float(w[1] / scale[1]), float(w[2])


def fit_toxicity(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Counts n-grams over all of docs(doc_id, text) and classes over labels(doc_id, toxic).

    Labels of the held-out fold are never read, those of the curve's fold fit
    only the curve. Null labels teach nothing; an id labelled more than once is
    toxic if any label says so. Without labels every text has the same low score.
    """
    spark = docs.sparkSession
    taught = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold() != HELD_OUT_FOLD))
    n = max(1, taught.count())
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, labelled_rows / n)))
    taught = taught.where(part).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("class"), F.first(fold()).alias("fold"))
    taught = F.broadcast(taught)  # about labelled_rows rows of 16 bytes at most
    known = docs.select("doc_id", "text").join(taught, "doc_id", "left")
    counted = known.withColumn("class", F.when(F.col("fold") != CURVE_FOLD, F.col("class")))
    model = log_ratios(written(gram_counts(counted), "grams"))
    held = known.where(F.col("fold") == CURVE_FOLD)
    curve = text_signs(held, model).join(taught, "doc_id")
    # an id counts once, however many rows it has: part of about labelled_rows rows, two numbers each
    curve = curve.groupBy("doc_id").agg(F.first("class").alias("class"), F.avg("mean").alias("mean"), F.avg("strong").alias("strong"))
    rows = curve.collect()
    model.curve = fit_curve(np.array([(r.mean, r.strong) for r in rows]).reshape(-1, 2), np.array([r["class"] for r in rows], float))
    return model


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """A row for each row of docs(doc_id, text): doc_id, the hash of the text, and a score between 0 and 1.

    Null and empty texts count as texts without words, which have the score of two equal likelihoods.
    """
    a, b, c = model.curve
    power = F.greatest(F.lit(-60.0), F.least(F.lit(60.0), a * F.col("mean") + b * F.col("strong") + c))
    return text_signs(docs, model).select("doc_id", "key", (1 / (1 + F.exp(-power))).alias("score"))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score and predicted.

    Repeated rows give repeated results; a null id is in fold 0. Columns other
    than doc_id and text are not read.
    """
    scored = toxicity_scores(docs, model).select("doc_id", (fold() == HELD_OUT_FOLD).alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
