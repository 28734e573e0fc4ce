"""URL filters: rules first, then the ratio of two variable-order Markov models of characters.

The models are trained on the urls that rules accept or reject. A character's
probability mixes the counts after its last three, two, one and no characters: a
context that was never met leaves the shorter one as it is, a rare one weighs
little against it (Witten and Bell's weights). Symbols are few, so all counts
fit one table of SYMBOLS ** 4 cells, whatever the input. Part of the labelled
urls is kept out of the counts and sets the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import UPPER

#: Rules (verdict, host, path prefix).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
_SHOWN = "abcdefghijklmnopqrstuvwxyz0123456789./-_?=&%"
#: Symbol 0 stands before the first character, the last one for all other characters.
SYMBOLS = len(_SHOWN) + 2
ORDER = 3
#: One url in so many, by the hash of its id, sets the threshold.
KEPT_OUT = 4
#: Scores are counted in steps of this size to set the threshold.
STEP = 0.01

_CODES = np.full(256, SYMBOLS - 1, np.int64)
for _i, _c in enumerate(_SHOWN):
    _CODES[ord(_c)] = _CODES[ord(_c.upper())] = _i + 1


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url and without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does. Of equally long ones the first listed wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    chosen = None
    for verdict, own, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        value = F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return found if chosen is None else chosen.otherwise(found)


def cells(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For each character of each url: its cell (the three symbols before it, and itself), and the url's position."""
    texts = [(u or "").partition("://")[2] or (u or "") for u in urls]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    codes = np.zeros(lengths.sum() + ORDER * len(raw), np.int64)
    owner = np.repeat(np.arange(len(raw)), lengths)
    at = np.arange(lengths.sum()) + ORDER * (owner + 1)
    codes[at] = _CODES[np.frombuffer(b"".join(raw), np.uint8)]
    cell = np.zeros(len(at), np.int64)
    for back in range(ORDER, -1, -1):
        cell = cell * SYMBOLS + codes[at - back]
    return cell, owner


@dataclass
class UrlModel:
    ratios: np.ndarray
    threshold: float = 0.0

    def scores(self, urls: list[str | None]) -> np.ndarray:
        """Mean log ratio accepted : rejected per character; 0 for a url without characters."""
        cell, owner = cells(urls)
        n = np.bincount(owner, minlength=len(urls))
        return np.bincount(owner, self.ratios[cell], len(urls)) / np.maximum(n, 1)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Of each cell, from the counts of one class."""
    counts = counts.reshape(-1, SYMBOLS).astype(np.float64)
    below = np.full((1, SYMBOLS), 1 / SYMBOLS)
    for order in range(ORDER + 1):
        own = counts.reshape(-1, SYMBOLS**order, SYMBOLS).sum(axis=0)
        types = (own > 0).sum(axis=1, keepdims=True)
        shorter = np.tile(below, (max(1, SYMBOLS**order // len(below)), 1))
        below = (own + types * shorter) / np.maximum(own.sum(axis=1, keepdims=True) + types, 1)
        below = np.where(types > 0, below, shorter)
    return np.log(below).reshape(-1)


def fit_urls(labelled: DataFrame) -> UrlModel:
    """From labelled(page_id, url, verdict). Without rows the models are alike and the threshold is 0."""
    spark = labelled.sparkSession
    kept_out = F.pmod(F.xxhash64("page_id", "url"), F.lit(KEPT_OUT)) == 0

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int32)
        for batch in batches:
            for accepted in (0, 1):
                cell, _ = cells(batch["url"][(batch["verdict"] == "allow") == accepted].tolist())
                total[accepted] += np.bincount(cell, minlength=total.shape[1]).astype(np.int32)
        at = np.flatnonzero(total.any(axis=0))
        yield pd.DataFrame({"cell": at, "rejected": total[0, at], "accepted": total[1, at]})

    parts = labelled.where(~kept_out).select("url", "verdict").mapInPandas(count, "cell long, rejected long, accepted long")
    found = parts.groupBy("cell").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")).toPandas()
    tables = np.zeros((2, SYMBOLS ** (ORDER + 1)))
    for i, c in enumerate(("rejected", "accepted")):
        tables[i, found["cell"].to_numpy(np.int64)] = found[c]
    model = UrlModel((log_probabilities(tables[1]) - log_probabilities(tables[0])).astype(np.float32))
    scored = labelled.where(kept_out).select("verdict", F.round(score_column(spark, model, "url") / STEP).cast("int").alias("step"))
    steps = scored.groupBy("step").agg(
        F.count_if(F.col("verdict") == "allow").alias("accepted"), F.count_if(F.col("verdict") != "allow").alias("rejected")
    )
    model.threshold = best_threshold([tuple(r) for r in steps.collect()])  # a row per STEP of the scores
    return model


def best_threshold(steps: list[tuple[int, int, int]]) -> float:
    """The middle of the scores that divide (step, accepted, rejected) with the best mean of both classes' shares."""
    steps = sorted(steps)
    accepted, rejected = sum(s[1] for s in steps), sum(s[2] for s in steps)
    if not accepted or not rejected:
        return 0.0
    best, low, high = -1.0, 0.0, 0.0
    above, below = accepted, 0
    for i, (step, a, r) in enumerate(steps):
        quality = above / accepted + below / rejected
        if quality > best:
            best, low, high = quality, (steps[i - 1][0] if i else step) * STEP, step * STEP
        above, below = above - a, below + r
    return (low + high) / 2


def score_column(spark, model: UrlModel, url: str) -> Column:
    shared = spark.sparkContext.broadcast(model)  # a table of fixed size

    @F.pandas_udf("double")
    def score(urls: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(urls.tolist()))

    return score(F.col(url))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of pages(page_id, url): host, path, rule, verdict and the models' score.

    Null and empty urls have empty host and path and score 0. Repeated rows give
    repeated results, null ids are kept, other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    own = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    own = own.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    labelled = own.where("found is not null and url is not null").select("page_id", "url", F.col("found.verdict").alias("verdict"))
    model = fit_urls(labelled)
    scored = own.withColumn("score", score_column(pages.sparkSession, model, "url"))
    by_model = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", by_model).alias("verdict"), "score"
    )
