import base64
import hashlib
import io
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbarn.llm import queries
from signalbarn.llm.urls import RULES, STEP, best_threshold, judge_urls
from signalbarn.llm.warc import MAGIC, _Source, read_warc, record, records_in, write_warc


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls(spark):
    rng = random.Random(1)
    urls = [None, "", "x", "http://", "HTTP://A.NET", "http://a.net/", "http://example.net/en/x", "http://www.Example.net/EN/", "https://notexample.com/de/", "a://b.org/fr/?q", "a://b.org/fr#x", "a://net/", "http://É.org/fr/", "http://a.org?x://b.net/"]
    for i in range(600):
        host = rng.choice(["spam%d.net", "m.good%d.org", "www.e%d.example.com", "q%d.example.net"]) % rng.randrange(30)
        urls.append(f"http{rng.choice(['', 's'])}://{host}/{rng.choice(['en', 'de', 'fr', 'es'])}/{i}{rng.choice(['', '?a=b', '#t'])}")
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(3, "x", "h"), (None, "a://b.net/", "h")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        url = urls[r.page_id] if r.page_id is not None else "a://b.net/"
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    free = [(r.host, r.verdict) for r in got if r.rule is None and ".org" in r.host]
    assert sum(v == "allow" for _, v in free) > 0.9 * len(free)
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def plain_scores(train, urls):
    """Mean log ratios by dictionaries of contexts: Witten and Bell's mixing of the last three to no characters."""
    shown = "abcdefghijklmnopqrstuvwxyz0123456789./-_?=&%"
    text = lambda u: (u or "").partition("://")[2] or (u or "")
    symbols = lambda u: [0, 0, 0] + [shown.find(chr(b).lower()) + 1 or len(shown) + 1 for b in text(u).encode()]
    follow = {v: {} for v in ("allow", "block")}
    for u, v in train:
        s = symbols(u)
        for i in range(3, len(s)):
            for k in range(4):
                own = follow[v].setdefault(tuple(s[i - k : i]), {})
                own[s[i]] = own.get(s[i], 0) + 1

    def p(v, context, x):
        shorter = p(v, context[1:], x) if context else 1 / (len(shown) + 2)
        own = follow[v].get(context)
        return (own.get(x, 0) + len(own) * shorter) / (sum(own.values()) + len(own)) if own else shorter

    out = []
    for u in urls:
        s = symbols(u)
        each = [math.log(p("allow", tuple(s[i - 3 : i]), s[i]) / p("block", tuple(s[i - 3 : i]), s[i])) for i in range(3, len(s))]
        out.append(sum(each) / max(1, len(each)))
    return out


def test_the_models_verdict_against_plain_counts(spark):
    rng = random.Random(3)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['Shop', 'blog', 'x%d' % rng.randrange(9)])}.{rng.choice(['spam.net', 'example.com', 'good.org', 'example.net', 'else.io'])}/{rng.choice(['en', 'de', 'fr'])}/{rng.choice(['é', 'a-b', 'C_d', '%20'])}{rng.randrange(99)}" for _ in range(500)]
    urls += [None, "", "no scheme", "a://"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = judge_urls(pages).collect()
    out = pages.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(4)) == 0).select("page_id").collect()
    kept_out = {r.page_id for r in out}
    labelled = {r.page_id: r.verdict for r in rows if r.rule is not None}
    scores = plain_scores([(urls[i], v) for i, v in labelled.items() if i not in kept_out], urls)
    steps = {}
    for i, v in labelled.items():
        if i in kept_out:
            step = steps.setdefault(round(scores[i] / STEP), [0, 0])
            step[v != "allow"] += 1
    threshold = best_threshold([(k, a, b) for k, (a, b) in steps.items()])
    judged = 0
    for r in rows:
        assert r.score == pytest.approx(scores[r.page_id], abs=1e-4)
        if r.rule is None and abs(r.score - threshold) > 2 * STEP:
            judged += 1
            assert r.verdict == ("allow" if scores[r.page_id] >= threshold else "block")
    assert judged > 80


def test_threshold():
    assert best_threshold([]) == 0.0
    assert 0.0 < best_threshold([(-50, 0, 9), (0, 0, 1), (40, 5, 0)]) <= 0.4


def page_rows():
    rng = random.Random(2)
    bodies = ["", "a", "ü" * 50, MAGIC.decode("latin-1") * 30, "".join(chr(rng.randrange(32, 3000)) for _ in range(5000))]
    rows = [(i, f"http://x.org/{i}", rng.choice(bodies)) for i in range(1, 150)]
    rows += [(i, None, "".join(chr(rng.randrange(32, 127)) for _ in range(rng.randrange(3000)))) for i in range(200, 260)]
    rows += [(300, "a b\nc", None), (1, "http://again", rows[0][2]), (1, "http://again", "once more"), (None, "n", "a"), (None, "n", "alone")]
    return rows


def test_warc(spark, out):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, refers_to string")
    write_warc(pages, f"{out}/warc", file_bytes=20_000)
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        first = least.get(h or "")
        again = first is not None and i != first
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first if again else None))
    for size in (500, 1 << 20):
        assert sorted(map(tuple, read_warc(spark, f"{out}/warc", size).collect()), key=str) == sorted(want, key=str)
    write_warc(pages, f"{out}/least", least=51)
    kinds = {(r.page_id, r.record_type) for r in read_warc(spark, f"{out}/least").collect() if r.payload_bytes < 51}
    assert kinds and all(k == "response" for _, k in kinds)
    write_warc(pages.limit(0), f"{out}/none")
    assert read_warc(spark, f"{out}/none").count() == 0


def test_every_range_owns_its_records():
    data = b"".join(record(i, "u", bytes([31, 139, 8]) * i * 7, None, False) for i in range(40))
    for step in (1, 7, 100, 5000, len(data)):
        ids = [h["x-page-id"] for s in range(0, len(data), step) for h, _ in records_in(_Source(io.BytesIO(data), len(data)), s, min(s + step, len(data)))]
        assert ids == [str(i) for i in range(40)]


def test_warc_headers_of_any_length(spark, out):
    """A record whose headers are longer than 64 KiB is the first of its file."""
    rng = np.random.default_rng(1)
    long = "http://a.b/" + bytes(rng.integers(33, 127, 3_000_000, np.uint8)).decode()
    pages = spark.createDataFrame([(1, "http://a.b/" + " " * 40_000, "x"), (2, long, "y"), (3, "c", "z")], "page_id long, url string, html string")
    n = write_warc(pages, f"{out}/long", file_bytes=1)
    for size in (1 << 20, 50_000):
        assert sorted(r.page_id for r in read_warc(spark, f"{out}/long", size).collect()) == [1, 2, 3]
    assert n == 3


def test_records_lost_on_reading_fail_the_query(spark, out, monkeypatch):
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "page_id long, url string, html string").write.parquet(f"{out}/pages.parquet")
    assert queries.op6_warc(spark, out).count() == 2
    monkeypatch.setattr(queries, "read_warc", lambda *a: read_warc(*a).where("page_id = 1"))
    with pytest.raises(ValueError, match="2 records were written and 1 read"):
        queries.op6_warc(spark, out)
