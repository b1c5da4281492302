"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio of trusted and raw text.

Words and pairs of neighbouring words are hashed into buckets. Their counts in trusted documents and
in the whole corpus are two multinomials; a document's score is the mean over its n-grams of
log(trusted / raw). Bucket weights are rounded to millionths, so scores are sums of integers and no
order of additions changes a decision.

The more n-grams share a bucket, the closer to zero all scores are, so no fixed score can part good
from bad at every size of the corpus. A fifth of the trusted documents is therefore kept out of the
trusted counts, and the threshold is the score that all but a hundredth of them reach: whatever the
corpus, about that share of good documents that the counts have not seen is rejected.

Only DataFrame functions are used. A document's n-grams are exploded where they are read and added up
per row before the shuffle; the weights, one per bucket whatever the corpus, are broadcast. One row of
numbers per document is written and read again, so that the threshold does not score them twice.

A null text has no words, fails the base rules and scores 0. Repeated rows are counted and judged one
by one. Without trusted documents in the counts all weights are 0; then, and without any that are kept
out and pass the base rules, only the base rules decide. A null key is never trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwright.storage import stored

# Fixed values of the base rules.
WORD_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5

# Two rows of weights, for words and pairs: 16 bytes a bucket, a broadcast of at most a few MB.
BUCKETS = 1 << 16
MICRO = 1_000_000
# One fold of trusted documents sets the threshold, which this share of them may miss. Their scores
# are counted in steps of a thousandth: some tens of thousands of counts, whatever the corpus.
FOLDS = 5
MISSED_PERCENT = 1
STEP = 1000
SMOOTHING = 1.0


def _words(text: Column) -> Column:
    spaces = F.translate(text, WORD_SPACE[1:], " " * (len(WORD_SPACE) - 1))
    return F.array_remove(F.split(spaces, " "), "")


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, although it occurs several times."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """The words in windows of ``window`` words that are found twice or more in the array."""
    last = F.size(words) - (window - 1)
    hashes = F.when(
        last > 1,
        F.transform(
            F.slice(words, 1, F.greatest(last, F.lit(0))),
            lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, window))),
        ),
    )
    return _let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), _covered(h, window)
    ).otherwise(F.lit(0)))


def _covered(hashes: Column, window: int) -> Column:
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(rows: Column) -> Column:
        def twin(row: Column, at: Column) -> Column:
            before = F.get(rows, at - 1)["h"].eqNullSafe(row["h"]) & (at > 0)
            return before | F.get(rows, at + 1)["h"].eqNullSafe(row["h"])

        return F.array_sort(F.transform(F.filter(rows, twin), lambda row: row["i"]))

    def length(starts: Column) -> Column:
        def own(start: Column, at: Column) -> Column:
            return F.least(F.coalesce(F.get(starts, at + 1) - start, F.lit(window)), F.lit(window))

        return F.aggregate(F.transform(starts, own), F.lit(0), lambda a, b: a + b)

    return _let(_let(placed, again), length)


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, WORD_SPACE) > 0)
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_rules(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(row, key, words, ...)``: the words of each row and its base measures."""
    whole = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    cut = whole.select("row", "key", "text", _words(F.col("text")).alias("words"))
    return cut.select(
        "row", "key", "words",
        F.size("words").cast("long").alias("n_words"),
        _without(F.col("text"), WORD_SPACE).cast("long").alias("word_chars"),
        (F.char_length("text") - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        _repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def _pairs(words: str = "words") -> Column:
    """Each word with the word after it; the last one has none."""
    return F.arrays_zip(
        F.col(words).alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b")
    )


def _bucket(value: Column, buckets: int) -> Column:
    return (F.crc32(value.cast("binary")) % buckets).cast("int")


def _grams(pair: Column, buckets: int) -> list[Column]:
    """The buckets of a word and of its pair; pairs have buckets of their own."""
    both = F.concat(pair["a"], F.lit(" "), pair["b"])
    return [_bucket(pair["a"], buckets), _bucket(both, buckets) + buckets]


def gram_weights(
    docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``(bucket, weight)``: log(trusted / raw) of each bucket in millionths, smoothed.

    ``trusted`` holds the keys of the trusted documents.
    """
    good = trusted.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
    marked = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        good.withColumn("good", F.lit(1)).hint("shuffle_hash"), "key", "left"
    )
    words = marked.select("good", _words(F.coalesce("text", F.lit(""))).alias("words"))
    pairs = words.select("good", F.explode(_pairs()).alias("pair"))
    grams = pairs.select("good", F.explode(F.array(*_grams(F.col("pair"), buckets))).alias("bucket"))
    counts = grams.filter("bucket IS NOT NULL").groupBy("bucket").agg(
        F.count("good").alias("t"), F.count("*").alias("r")
    )
    order = F.col("bucket") >= buckets
    sums = counts.groupBy(order.alias("order")).agg(
        F.sum("t").alias("all_t"), F.sum("r").alias("all_r")
    )
    t = (F.col("t") + SMOOTHING) / (F.col("all_t") + SMOOTHING * buckets)
    r = (F.col("r") + SMOOTHING) / (F.col("all_r") + SMOOTHING * buckets)
    weight = F.when(F.col("all_t") > 0, F.round(F.log(t / r) * MICRO).cast("long"))
    return counts.withColumn("order", order).join(F.broadcast(sums), "order").select(
        "bucket", F.coalesce(weight, F.lit(0)).alias("weight")
    )


def scored(
    docs: DataFrame, weights: DataFrame, text: str = "text", key: str = "doc_id",
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``docs``: key, base measures, ``base_failed``, ``n_grams``, and ``llr_sum``
    in millionths."""
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # A row without words has no pairs; its one pair of nulls has no buckets and no weight.
    pairs = base_rules(docs, text, key).select(
        "row", "key", *measures, F.explode_outer(_pairs()).alias("pair")
    )
    word, both = _grams(F.col("pair"), buckets)
    grams = pairs.select("row", "key", *measures, F.explode(F.array(word, both)).alias("bucket"))
    weighed = grams.join(F.broadcast(weights), "bucket", "left")
    same = [F.first(c).alias(c) for c in ("key", *measures)]
    rows = weighed.groupBy("row").agg(
        *same,
        F.count("bucket").alias("n_grams"),
        F.coalesce(F.sum("weight"), F.lit(0)).alias("llr_sum"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    return rows.select(
        F.col("key").alias(key), *measures, failed.alias("base_failed"), "n_grams", "llr_sum"
    )


def _step() -> Column:
    """The mean ratio of a row in whole steps, rounded down; null without n-grams."""
    return F.floor(F.try_divide("llr_sum", F.col("n_grams") * STEP))


def held_out(key: str) -> Column:
    """Whether a trusted document sets the threshold and is not counted."""
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 7)
    return F.conv(digest, 16, 10).cast("long") % FOLDS == 1


def lowest_step(rows: DataFrame, trusted: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(step)``, one row: the step that all but ``MISSED_PERCENT`` of the trusted rows reach that
    are held out and pass the base rules; null without such rows."""
    keys = trusted.select(key).filter(F.col(key).isNotNull() & held_out(key)).distinct()
    found = rows.filter(~F.col("base_failed")).join(keys, key, "left_semi")
    counts = found.groupBy(_step().alias("step")).agg(F.count("*").alias("n"))
    up_to = F.sum("n").over(Window.orderBy("step"))
    total = F.sum("n").over(Window.orderBy("step").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    reached = counts.select("step", (up_to * 100 > total * MISSED_PERCENT).alias("reached"))
    return reached.filter("reached").agg(F.min("step").alias("step"))


def quality_rules(
    docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id",
    buckets: int = BUCKETS, threshold: int | None = None,
) -> DataFrame:
    """``scored`` by the weights of ``gram_weights`` over the same documents, and ``kept``.

    A ``threshold`` for the mean ratio, in millionths, takes the place of the one that trusted
    documents set; all of them are counted then.
    """
    if threshold is not None:
        rows = scored(docs, gram_weights(docs, trusted, text, key, buckets), text, key, buckets)
        passed = F.col("llr_sum") >= F.col("n_grams") * F.lit(threshold)
        return rows.withColumn("kept", ~F.col("base_failed") & passed)
    counted = trusted.filter(~held_out(key))
    weights = gram_weights(docs, counted, text, key, buckets)
    rows = stored(scored(docs, weights, text, key, buckets), "quality-rules")
    lowest = lowest_step(rows, trusted, key).scalar()
    passed = F.coalesce(_step() >= lowest, F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & passed)
