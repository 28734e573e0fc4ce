import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbarn.llm import toxicity
from signalbarn.llm.toxicity import fit_curve, fit_toxicity, score_toxicity, words_of

DATA = "/root/testdata/sf0.01"


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    extra = spark.createDataFrame([(None, "no id"), (10**7, None), (10**7 + 1, ""), (10**7 + 2, "?" * 9), (10**7 + 3, "x" * 200000)], "doc_id long, text string")
    # held-out labels are turned around: they must teach nothing
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model = fit_toxicity(docs, turned.unionByName(turned.limit(5)))
    rows = score_toxicity(docs.select("doc_id", "text", F.lit(1).alias("score")).unionByName(extra.withColumn("score", F.lit(2))), model).collect()
    assert len(rows) == docs.count() + 5
    scores = {r.doc_id: r.score for r in rows}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (fold(r.doc_id) == 2) for r in rows if r.doc_id is not None)
    assert scores[10**7] == scores[10**7 + 1] == scores[10**7 + 2]
    truth = [(scores[r.doc_id], r.toxic) for r in labels.collect() if fold(r.doc_id) == 2]
    toxic, clean = (np.array([s for s, t in truth if t == k]) for k in (1, 0))
    assert np.mean([np.mean(s > clean) + 0.5 * np.mean(s == clean) for s in toxic]) > 0.85
    assert (clean >= 0.3).mean() < 0.1


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert [r.predicted for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()] == [0, 0]
    assert score_toxicity(docs.limit(0), fit_toxicity(docs.limit(0), labels)).count() == 0


def test_curve_and_words():
    x = np.column_stack([np.zeros(200), np.repeat([0.0, 1.0], 100)])
    a, b, c = fit_curve(x, np.repeat([0.0, 1.0], 100))
    assert b + c > 0 > c
    assert words_of("Äb_c D'e") == ["äb", "c", "d", "e"] and words_of(None) == []
    for text in ("", " _ ", "A1_b-C\x1cd\n\tE.f", "x" * 200 + " y", "\u212a9 k", "".join(map(chr, range(128)))):
        assert words_of(text) == toxicity._WORD.findall(text.lower())


def plain_signs(docs, classes):
    """The two signs of each text by dictionaries of exact n-grams; classes: doc_id to (toxic, fold)."""
    grams = {}
    spell = lambda w: [("\1" + w + "\2")[max(0, i - 5) : i + 1] for i in range(1, len(w) + 2)]
    for i, text in docs:
        toxic, of = classes.get(i, (None, None))
        for w in words_of(text):
            for g in spell(w):
                n = grams.setdefault(g, [0, 0])
                if toxic is not None and of != 3:
                    n[1 - toxic] += 1
    low, low_total, kinds, letters, total, given = {}, {}, {}, {}, {}, {}
    for g, n in grams.items():
        low[g[-3:]] = low.get(g[-3:], 0) + 1
        for c in (0, 1):
            total[g[:-1], c] = total.get((g[:-1], c), 0) + n[c]
            given[g[:-1], c] = given.get((g[:-1], c), 0) + min(n[c], 3)
    for g, n in low.items():
        low_total[g[:-1]] = low_total.get(g[:-1], 0) + n
        kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
        letters[g[-1]] = letters.get(g[-1], 0) + 1

    def shared(g):
        alone = (max(letters[g[-1]] - 0.75, 0) + 0.75) / len(low)
        return (max(low[g] - 0.75, 0) + 0.75 * kinds[g[:-1]] * alone) / low_total[g[:-1]]

    def ratio(g):
        n, c = grams[g], g[:-1]
        left = [given[c, k] / total[c, k] if total[c, k] else 1 for k in (0, 1)]
        if max(n) <= 3:
            return np.log(left[0] / left[1])
        p = [max(max(n[k] - 3, 0) / max(total[c, k], 1) + left[k] * shared(g[-3:]), 1e-12) for k in (0, 1)]
        return np.log(p[0] / p[1])

    known = {g: ratio(g) for g in grams}
    out = []
    for _, text in docs:
        r = np.array([sum(known[g] for g in spell(w)) for w in words_of(text)] or [0.0])
        out.append((r.mean(), np.maximum(r - 2, 0).mean()))
    return np.array(out)


@pytest.mark.parametrize("entries", [10**6, 0])
def test_against_exact_ngrams(spark, monkeypatch, entries):
    """Models that workers hold and models that are joined, both against exact n-grams."""
    monkeypatch.setattr(toxicity, "HELD_ENTRIES", entries)
    monkeypatch.setattr(toxicity, "WORDS_HELD", 3000)
    monkeypatch.setattr(toxicity, "PAIRS_HELD", 5000)
    monkeypatch.setattr(toxicity, "SPELLED", 1000)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("n_chars < 2000").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = [tuple(r) for r in docs.collect()]
    classes = {r.doc_id: (r.toxic, fold(r.doc_id)) for r in labels.collect() if fold(r.doc_id) != 2}
    signs = plain_signs(rows, classes)
    curve = [(s, classes[i][0]) for (i, _), s in zip(rows, signs) if classes.get(i, (0, 0))[1] == 3]
    a, b, c = fit_curve(np.array([s for s, _ in curve]), np.array([t for _, t in curve], float))
    want = {i: 1 / (1 + np.exp(-(a * s[0] + b * s[1] + c))) for (i, _), s in zip(rows, signs)}
    got = {r.doc_id: r.score for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}
    assert set(got) == set(want)
    assert max(abs(got[i] - want[i]) for i in want) < 1e-5
