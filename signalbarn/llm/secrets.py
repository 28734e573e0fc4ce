"""Secret scans: fixed patterns, and strings that look drawn at random to two character Markov models.

Everything is column expressions; a text never leaves its row. The models are
tables of character pairs: how random strings and ordinary identifiers go on
after each character. Their labelled samples come from the documents themselves:
what the fixed patterns find is random, other long strings that are spelled as
words or numbers are ordinary. Each string counts as often as it occurs.

A run of letters, digits and joining signs is judged by the sum of its
characters' log likelihood ratios. Those of random characters are positive, so
the best stretch of a run is the one whose sum is greatest: it starts where the
sum has come up from zero and ends at its height. A stretch is a secret if its
sum reaches NEED, so short ones must look more random than long ones; a few
characters up to the next joining sign or the run's end belong to it. What fixed
patterns have found within a run counts for nothing and does not part it, so a
key is found around it. All work on a text grows with its length, or its length
times the logarithm of the number of matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import bound

#: The patterns by kind, in the order in which spans of one start are listed.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs of these characters are matched whole, so asking for the least length within the pattern drops what a filter would.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "markov"]
LEAST_ASSIGNED = 12

STRING = r"[A-Za-z0-9+/_-]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: Row and column of the table: 1.. for the alphabet's characters, then the end; row 0 is the start.
SIZE = len(ALPHABET) + 2
LEAST_LABELLED, LEAST_JUDGED = 12, 12
#: What labels a string as ordinary: words of letters, or numbers, joined by single signs.
WORDLIKE = r"^([A-Z]?[a-z]+([_/-][A-Z]?[a-z]+)*|[0-9]+([_/+-][0-9]+)*)$"
#: Share of the models that is spread evenly over all characters.
SPREAD = 0.5
#: Weight, in characters, of single characters' frequencies after each context.
LEAN = 5.0
#: The sum that makes a stretch a secret: ordinary strings reach it about once in e ** NEED.
NEED = 20.0
#: A stretch ends for good when its sum has fallen by so much; less than NEED, so none is passed over.
DROP = 10.0
#: So many characters between a stretch and the next sign or end belong to it.
EDGE = 4
SIGNS = "+/_-"
#: Stands for each character that a fixed pattern has found.
BLANK = "\x01"

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def running_sums(values: Column) -> Column:
    """Sums up to and including each entry of an array of numbers, by doubling steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(31)])

    def summed(v: Column) -> Column:
        needed = F.filter(steps, lambda step: step < F.size(v))
        return F.aggregate(
            needed, v, lambda done, step: F.transform(done, lambda x, i: x + F.coalesce(F.get(done, i - step), F.lit(0)))
        )

    return bound(values, summed)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """A struct of what lies before each match (and after the last), the matches and their group."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.array().cast("array<string>")
    return F.struct(F.split(text, pattern, -1).alias("gaps"), matches.alias("matches"), values.alias("values"))


def _is_long(found: Column, i: Column, group: int) -> Column:
    """Whether a match counts: one with a group only if that is long enough."""
    return F.length(F.get(found["values"], i)) >= LEAST_ASSIGNED if group else F.lit(True)


def _ends(found: Column) -> Column:
    """Where each match ends, in code points."""
    steps = F.transform(found["matches"], lambda m, i: F.length(F.get(found["gaps"], i)) + F.length(m))
    return running_sums(steps)


def _pattern_spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Spans of the pattern's matches in code points, from left to right; those whose group is too short are left out."""
    none = F.array().cast(_SPANS)

    def spans(found: Column) -> Column:
        def span(end: Column, i: Column) -> Column:
            start = end - F.length(F.get(found["matches"], i))
            return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), _is_long(found, i, group).alias("long"))

        long = F.filter(F.transform(_ends(found), span), lambda s: s["long"])
        return F.transform(long, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(_SPANS)

    return F.when(text.rlike(pattern), bound(_matches(text, pattern, group), spans)).otherwise(none)


def _blanked(text: Column, pattern: str, group: int = 0) -> Column:
    """The text with the pattern's matches blanked out, sign by sign; those whose group is too short stay."""

    def join(found: Column) -> Column:
        def piece(gap: Column, i: Column) -> Column:
            match = F.get(found["matches"], i)
            kept = F.when(_is_long(found, i, group), F.repeat(F.lit(BLANK), F.length(match))).otherwise(match)
            return F.concat(gap, F.coalesce(kept, F.lit("")))

        return F.array_join(F.transform(found["gaps"], piece), "")

    return F.when(text.rlike(pattern), bound(_matches(text, pattern, group), join)).otherwise(text)


def has_match(text: Column) -> Column:
    """Whether a fixed pattern may match at all: most texts are looked through once."""
    return F.coalesce(text.rlike(f"{ASSIGN}|{ACCESS}|{HEX}"), F.lit(False))


def base_spans(text: Column) -> Column:
    """All spans of the fixed patterns, by start, then kind. A null text has none."""
    found = F.concat(_pattern_spans(text, ASSIGN, 0, 2), _pattern_spans(text, ACCESS, 1), _pattern_spans(text, HEX, 2))
    return F.when(has_match(text), F.array_sort(found)).otherwise(F.array().cast(_SPANS))


def letters(string: Column) -> Column:
    """The characters of a string, which is walked once."""
    return F.split(string, "", -1)


def _index(char: Column) -> Column:
    """The place of a character in the table, from 1 on; 0, like the start of a string, for a blank."""
    codes = F.array(*[F.lit(ALPHABET.find(chr(i)) + 1) for i in range(128)])  # folded to one constant
    return F.coalesce(F.get(codes, F.ascii(char)), F.lit(0))


def pair_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (random, a, b, n): how often b follows a in the labelled strings of each class."""
    t = F.col(text)
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, ASSIGN, " "), ACCESS, " "), HEX, " ")
    values = F.concat(
        F.filter(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= LEAST_ASSIGNED),
        F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(t, F.lit(HEX), F.lit(0)),
    )
    hit = has_match(t)
    ordinary = F.regexp_extract_all(F.when(hit, rest).otherwise(t), F.lit(f"{STRING}{{{LEAST_LABELLED},}}"), F.lit(0))
    samples = F.concat(
        F.transform(F.when(hit, values).otherwise(F.array().cast("array<string>")), lambda v: F.struct(F.lit(True).alias("random"), v.alias("word"))),
        F.transform(ordinary, lambda v: F.struct(F.lit(False).alias("random"), v.alias("word"))),
    )
    words = docs.select(F.explode(samples).alias("s")).groupBy("s.random", "s.word").agg(F.count("*").alias("n"))
    words = words.where(F.col("random") | F.col("word").rlike(WORDLIKE))
    # identifiers are spelled in capitals as well
    spelled = F.when(F.col("random"), F.array("word")).otherwise(F.array_distinct(F.array("word", F.upper("word"))))
    words = words.select("random", F.explode(spelled).alias("word"), "n")

    def pairs(places: Column) -> Column:
        return F.transform(places, lambda b, i: F.struct(F.coalesce(F.get(places, i - 1), F.lit(0)).alias("a"), b.alias("b")))

    places = F.concat(F.transform(letters(F.col("word")), _index), F.array(F.lit(SIZE - 1)))
    each = words.select("random", F.explode(bound(places, pairs)).alias("p"), "n")
    return each.groupBy("random", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("n").alias("n"))


def fit_markov(docs: DataFrame, text: str = "text") -> list[float]:
    """Log ratios random : ordinary of each pair of characters, SIZE * SIZE numbers.

    Without samples of a class, its model is the even one.
    """
    table = {True: [[0.0] * SIZE for _ in range(SIZE)], False: [[0.0] * SIZE for _ in range(SIZE)]}
    for r in pair_counts(docs, text).collect():  # at most 2 * SIZE * SIZE rows
        table[r.random][r.a][r.b] += r.n

    def logs(rows: list[list[float]], spread: float) -> list[float]:
        """Rare contexts lean on how often characters occur at all, and all on the even distribution."""
        each = [sum(r[b] for r in rows) + 1 for b in range(SIZE)]
        total = sum(each)
        out = []
        for r in rows:
            n = sum(r) + LEAN
            out += [math.log((1 - spread) * (r[b] + LEAN * each[b] / total) / n + spread / SIZE) for b in range(SIZE)]
        return out

    return [x - y for x, y in zip(logs(table[True], SPREAD), logs(table[False], 0.01))]


def _ratio(ratios: Column, before: Column, place: Column) -> Column:
    return F.when(place == 0, F.lit(0.0)).otherwise(F.element_at(ratios, before * SIZE + place + 1))


def greatest_sum(string: Column, ratios: Column) -> Column:
    """What the positive log ratios of a string add up to: no stretch has more. Ordinary strings are passed over by it."""
    first = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def add(done: Column, char: Column) -> Column:
        place = _index(char)
        return F.struct(place.alias("before"), (done["sum"] + F.greatest(_ratio(ratios, done["before"], place), F.lit(0.0))).alias("sum"))

    return F.aggregate(letters(string), first, add, lambda done: done["sum"])


def best_stretches(string: Column, at: Column, ratios: Column) -> Column:
    """Spans of the stretches of a string, which starts at `at`, whose log ratios sum up to NEED or more."""

    def each(places: Column) -> Column:
        return F.transform(places, lambda b, i: _ratio(ratios, F.coalesce(F.get(places, i - 1), F.lit(0)), b))

    def state(**fields: Column) -> Column:
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    start, none = at.cast("int"), F.array().cast(_SPANS)
    zero, no = F.lit(0.0), F.lit(False)
    # word: where the signs before the present place end; open: no sign has come since the best end
    first = state(at=start, word=start, sum=zero, start=start, best=zero, end=start, open=no, spans=none)

    def with_best(done: Column, place: Column | None = None) -> Column:
        """The spans with the best stretch, if it is one; `place` is where the string ends."""
        end = done["end"] if place is None else F.when(place - done["end"] <= EDGE, place).otherwise(done["end"])
        span = state(start=done["start"], kind=F.lit(KINDS.index("markov")), end=end)
        return F.when(done["best"] >= NEED, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).cast(_SPANS)

    def add(done: Column, letter: Column) -> Column:
        place, total, next_at = done["at"], done["sum"] + letter["ratio"], done["at"] + 1
        sign = letter["sign"]
        word = F.when(sign, next_at).otherwise(done["word"])
        over = (total <= 0) | (total < done["best"] - DROP)
        higher = total > done["best"]
        closes = sign & done["open"] & (place - done["end"] <= EDGE)
        head = F.when((done["sum"] == 0) & (place - done["word"] <= EDGE), done["word"]).otherwise(done["start"])
        ended = F.when(closes, place).otherwise(done["end"])
        anew = state(
            at=next_at, word=word, sum=zero, start=next_at, best=zero, end=next_at, open=no,
            spans=with_best(state(**{c: done[c] for c in ("start", "best", "spans")}, end=ended)),
        )
        on = state(
            at=next_at, word=word, sum=total, start=head, best=F.when(higher, total).otherwise(done["best"]),
            end=F.when(higher, next_at).otherwise(ended), open=F.when(sign, no).otherwise(higher | done["open"]), spans=done["spans"],
        )
        return F.when(over, anew).otherwise(on)

    def scored(places: Column) -> Column:
        signs = [ALPHABET.index(c) + 1 for c in SIGNS]
        ratio = each(places)
        return bound(ratio, lambda r: F.transform(places, lambda b, i: state(ratio=F.get(r, i), sign=(b == 0) | b.isin(signs))))

    return F.aggregate(bound(F.transform(letters(string), _index), scored), first, add, lambda done: with_best(done, done["at"]))


def all_spans(text: Column, base: Column, ratios: Column) -> Column:
    """`base` and the model's spans; the model judges whole long strings around what the fixed patterns have found."""
    pattern = f"[A-Za-z0-9+/_{BLANK}-]{{{LEAST_JUDGED},}}"
    none = F.array().cast(_SPANS)
    plain = F.when(F.contains(text, F.lit(BLANK)), F.translate(text, BLANK, " ")).otherwise(text)
    left = F.when(F.size(base) > 0, _blanked(_blanked(_blanked(plain, ASSIGN, 2), ACCESS), HEX)).otherwise(plain)

    def judged(found: Column) -> Column:
        def of_run(end: Column, i: Column) -> Column:
            run = F.get(found["matches"], i)
            stretches = best_stretches(run, end - F.length(run), ratios)
            return F.when(greatest_sum(run, ratios) >= NEED, stretches).otherwise(none)

        return F.flatten(F.transform(_ends(found), of_run))

    def of_left(t: Column) -> Column:
        runs = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        # places are counted only in texts with a run that may be a secret
        may_be = F.exists(runs, lambda run: greatest_sum(run, ratios) >= NEED)
        return F.when(may_be, bound(_matches(t, pattern), judged)).otherwise(none)

    return F.when(text.isNull(), base).otherwise(F.array_sort(F.concat(base, bound(left, of_left))))


def with_spans(docs: DataFrame, ratios: list[float], text: str = "text", prefix: str = "") -> DataFrame:
    """Adds the columns `<prefix>base` and `<prefix>spans`: arrays of (start, kind, end) in code points, end exclusive."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded to one constant
    out = docs.withColumn(f"{prefix}base", base_spans(F.col(text)))
    return out.withColumn(f"{prefix}spans", all_spans(F.col(text), F.col(f"{prefix}base"), table))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def scan_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """One row per row of docs(doc_id, text): counts of base spans, their digest, and all spans as text.

    Null and empty texts have no spans. Repeated rows give repeated results and
    null ids are kept. Other columns are not read.
    """
    own = docs.select("doc_id", "text")
    found = with_spans(own, fit_markov(own) if ratios is None else ratios)

    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each run of touching or overlapping spans replaced by `mark`."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done, s):
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        apart = (s["start"] > done["at"]) | (done["at"] == 0)
        out = F.when(apart, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    rest = F.aggregate(spans, first, add, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
