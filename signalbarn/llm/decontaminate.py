"""Benchmark decontamination by winnowing, in column expressions only.

A window is `window` consecutive words of a benchmark item, or all of a shorter
item. Both sides hash every `gram` words and keep, of each run of
window - gram + 1 hashes, the least one. A shared window holds the same run on
both sides and so the same kept hash at the same place: none is missed.

Documents carry each kept hash with the words around it. Those whose hash occurs
among the benchmark's are extended: every window that holds the kept words is
compared, as text, with the distinct windows of the benchmark. Windows of all
sizes are looked for in one pass: a document's words are split and hashed once.
A window that many items share is one row with a group of items, a hash that
occurs in many windows still only asks whether it occurs, and items are listed
once for each different set of groups that documents hold, so nothing multiplies.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import bound, document_key, lower_ascii, small_or_shuffled, written

WINDOW = 13
GRAM = 5
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Fixed value: everything that is not part of a word, once A-Z are lower-cased; words hold no other A-Z.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for a null.

    Only words that lower() changes are looked at letter by letter.
    """
    lowered = F.transform(split_words(text), lambda w: F.when(F.lower(w) == w, w).otherwise(lower_ascii(w)))
    return F.coalesce(lowered, F.array().cast("array<string>"))


def split_words(text: Column) -> Column:
    """The words of a text as they are spelled; null for a null."""
    return F.array_remove(F.split(text, NOT_WORD), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(split_words(text)), F.lit(0)).cast("long")


def _each(n: Column, run: int, at) -> Column:
    """at(i) for i = 0 up to the number of runs of `run` among n; none if there are fewer.

    Elements are taken one by one with get(), whose cost does not depend on the
    array's length; slice() copies the whole array each time.
    """
    last = n - run
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), at)).otherwise(F.array().cast("array<bigint>"))


def _hashes(words: Column, gram: int) -> Column:
    """A hash of each `gram` consecutive words of a bound array."""
    return _each(F.size(words), gram, lambda i: F.xxhash64(*[F.get(words, i + o) for o in range(gram)]))


def _least(hashes: Column, run: int) -> Column:
    """The least of each `run` consecutive hashes of a bound array."""
    if run == 1:
        return hashes
    return _each(F.size(hashes), run, lambda i: F.least(*[F.get(hashes, i + o) for o in range(run)]))


def _anchors(words: Column, sizes: list[int], gram: int) -> Column:
    """The kept hashes of a text for windows of each size, with the words that windows around them can hold.

    `first` is the place of the first of these words, of which `skip` stand
    before the hashed ones.
    """

    def of_size(words: Column, hashes: Column, size: int) -> Column:
        k = min(gram, size)
        run = size - k + 1

        def kept(least: Column) -> Column:
            """A run's least hash is looked up where it is a new one, or where the place of the last one may
            just have left; so each run, of which run j has the hashes from j on, holds a place looked up."""
            runs = F.filter(
                F.sequence(F.lit(0), F.size(least) - 1),
                lambda j: (
                    (j == 0) | (F.get(least, j) != F.get(least, j - 1)) | (F.get(hashes, j - 1) == F.get(least, j))
                ),
            )

            def around(j: Column) -> Column:
                own = F.get(least, j)
                # the last place of the run with this hash
                place = F.coalesce(*[F.when(F.get(hashes, j + o) == own, j + o) for o in range(run - 1, -1, -1)])
                return F.struct(own.alias("hash"), place.alias("place"))

            def with_words(p: Column) -> Column:
                first = F.greatest(p["place"] - (run - 1), F.lit(0))
                context = F.array_compact(F.array(*[F.get(words, first + o) for o in range(k + 2 * run - 2)]))
                return F.struct(
                    F.lit(size).alias("size"), p["hash"].alias("hash"), first.alias("first"),
                    (p["place"] - first).alias("skip"), context.alias("words"),
                )

            return F.transform(F.transform(runs, around), with_words)

        return F.when(F.size(words) >= size, bound(_least(hashes, run), kept))

    def all_sizes(w: Column) -> Column:
        """Sizes with grams of one length share their hashes."""
        by_gram: dict[int, list[int]] = {}
        for size in sizes:
            by_gram.setdefault(min(gram, size), []).append(size)

        def of_gram(k: int) -> Column:
            hashed = F.struct(w.alias("words"), _hashes(w, k).alias("hashes"))
            return bound(hashed, lambda s: _joined([of_size(s["words"], s["hashes"], size) for size in by_gram[k]]))

        return _joined([of_gram(k) for k in by_gram])

    return bound(words, all_sizes)


def _joined(parts: list[Column]) -> Column:
    """Arrays one after another; null ones are empty."""
    return parts[0] if len(parts) == 1 else F.flatten(F.array_compact(F.array(*parts)))


def _windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (size, words, text, group) and the groups (group, items) of items that share windows."""
    own = items.select(F.col("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - size + 1))
    own = own.select("item_id", "words", size.alias("size"), at.alias("at"))
    own = own.select("item_id", "size", F.slice("words", F.col("at"), F.col("size")).alias("words"))
    shared = own.groupBy("size", "words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    shared = written(shared.withColumn("text", F.array_join("words", " ")), "windows")
    groups = shared.select("items").distinct().withColumn("group", F.monotonically_increasing_id())
    groups = written(groups, "items")
    return written(shared.join(groups, "items").drop("items"), "windows"), groups


def _sizes(windows: DataFrame) -> list[int]:
    return sorted(r[0] for r in windows.select("size").distinct().collect())  # at most WINDOW numbers


def window_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Where documents hold windows of the benchmark, and the groups of items.

    Rows (key, start, size, group), written once; start counts words from 0.
    Rows (group, items) with the items whose windows these are.
    """
    windows, groups = _windows(items, window)
    docs = docs.select(document_key().alias("key"), words_of(F.col("text")).alias("words"))
    sizes = _sizes(windows)
    if not sizes:
        number = F.lit(0).cast("long")
        found = docs.select("key", F.lit(0).alias("start"), F.lit(0).alias("size"), number.alias("group")).limit(0)
        return written(found, "hits"), groups
    # all words of a window are one run, whose least hash is the only one kept
    def least_hash(k: int) -> Column:
        return F.when(F.least(F.lit(gram), F.col("size")) == k, F.array_min(bound(F.col("words"), lambda w: _hashes(w, k))))

    of_window = F.coalesce(*[least_hash(k) for k in sorted({min(gram, size) for size in sizes})])
    kept = written(windows.select("size", of_window.alias("hash")).distinct(), "hashes")
    at = docs.select("key", F.explode(_anchors(F.col("words"), sizes, gram)).alias("a")).select("key", "a.*")
    at = at.join(small_or_shuffled(kept), ["size", "hash"], "left_semi")
    # windows that start at most as many words before the hashed words as are at hand, and end within them
    starts = F.sequence(F.lit(0), F.least(F.col("skip"), F.size("words") - F.col("size")))
    each = at.where(F.size("words") >= F.col("size")).select("key", "size", "first", "words", F.explode(starts).alias("s"))
    text = F.array_join(F.slice("words", F.col("s") + 1, F.col("size")), " ")
    each = each.select("key", "size", (F.col("first") + F.col("s")).alias("start"), text.alias("text")).distinct()
    hits = each.join(small_or_shuffled(windows.select("size", "text", "group")), ["size", "text"])
    return written(hits.select("key", "start", "size", "group"), "hits"), groups


def _covered(spans: Column) -> Column:
    """Words that lie in at least one of the sorted spans (start, end)."""
    first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(done, s):
        new = F.greatest(s["end"] - F.greatest(s["start"], done["end"]), F.lit(0))
        return F.struct(F.greatest(done["end"], s["end"]).alias("end"), (done["n"] + new).cast("long").alias("n"))

    return F.aggregate(spans, first, add, lambda done: done["n"])


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, one_in: int = ONE_IN) -> DataFrame:
    """One row per row of docs(doc_id, text): n_words, n_hit, n_items, items_sha256 and contaminated.

    Null and empty texts have no words and are clean; items without words have
    no windows; without items all documents are clean. Rows that repeat an id
    with another text are judged each by its own text. Null item ids are not
    counted as items, but their words are hit. Other columns are not read.
    """
    hits, groups = window_hits(docs, items, window, gram)
    spans = hits.select("key", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    covered = spans.groupBy("key").agg(_covered(F.array_sort(F.collect_list(F.struct("start", "end")))).alias("n_hit"))
    held = hits.select("key", "group").distinct().groupBy("key").agg(F.array_sort(F.collect_list("group")).alias("set"))
    held = written(held, "sets")
    # documents that hold the same groups hold the same items: these are listed once per set
    sets = held.select("set").distinct().select("set", F.explode("set").alias("group")).join(small_or_shuffled(groups), "group")
    listed = sets.select("set", F.explode(F.col("items").cast("array<string>")).alias("item")).distinct().groupBy("set")
    listed = listed.agg(F.array_sort(F.collect_list("item")).alias("items")).select(
        "set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    )
    whose = held.join(small_or_shuffled(written(listed, "listed")), "set", "left").drop("set")
    judged = covered.join(whose, "key", "left")
    own = docs.select(F.col("doc_id"), document_key().alias("key"), n_words(F.col("text")).alias("n_words"))
    same = own["key"].eqNullSafe(judged["key"])
    nothing = hashlib.sha256(b"").hexdigest()
    out = own.join(judged, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.lit(nothing)).alias("items_sha256"),
        own["key"].alias("key"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))
