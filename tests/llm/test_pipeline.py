import shutil

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from signalbarn.llm.secrets import fit_markov, spans_text, with_spans
from signalbarn.llm.toxicity import THRESHOLD, fit_toxicity, score_toxicity
from tests.llm.test_decontaminate import brute
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_tokens import plain

DATA = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13


def test_against_brute_force(spark, out):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = [(10**6, None, "en", "s", 0), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "", None, None, None), (None, "no id at all", "en", "s", 12)]
    for name in ("labels", "benchmark"):
        shutil.copy(f"{DATA}/{name}.parquet", f"{out}/{name}.parquet")
    docs = docs.where("n_chars < 4000").unionByName(spark.createDataFrame(odd, docs.schema))
    docs.write.parquet(f"{out}/documents.parquet")
    docs = spark.read.parquet(f"{out}/documents.parquet")
    pieces = {}
    for r in corpus_pipeline.run(spark, out).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    got = {i: [x for _, p in sorted(parts) for x in p] for i, parts in pieces.items()}

    model = fit_toxicity(docs, spark.read.parquet(f"{out}/labels.parquet"))
    fine = {r.doc_id for r in score_toxicity(docs, model).collect() if r.score < THRESHOLD}
    kept = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in fine]
    assert 0 < len(kept) < docs.count()
    roots = plain_components([plain_fingerprint(t) for _, t in kept], 2)
    least = {}
    for (i, _), root in zip(kept, roots):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    kept = [(i, t) for (i, t), root in zip(kept, roots) if i is None or least[root] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{out}/benchmark.parquet").collect()]
    clean = {row[0] for row in brute(kept, items) if not row[5]}
    frame = spark.createDataFrame([(i, t) for i, t in kept if i in clean], "doc_id long, text string")
    found = with_spans(frame, fit_markov(frame)).select("doc_id", "text", spans_text(F.col("spans")).alias("s")).collect()
    encode, want = plain(public_tokenizers.path("word_bpe_49k.json")), {}
    for r in found:
        text, at, parts = r.text or "", 0, []
        for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in r.s.split(",") if s):
            if start > at or not parts:
                parts += [text[at:start], "[secret]"]
            at = max(at, end)
        want[r.doc_id] = [*encode("".join(parts) + text[at:]), 2]
    assert got == want


def test_empty(spark, out):
    for name in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{out}/{name}.parquet")
    assert corpus_pipeline.run(spark, out).count() == 0
