"""Quality rules with DataFrame functions only: base counts, and a likelihood ratio of hashed n-grams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from partledger.llm.common import table

BLANK = r"[\x20\x09-\x0D]+"
BUCKETS = 1 << 14
SMOOTHING = 1.0
THRESHOLD = -0.15  # mean log ratio of an n-gram below which a text is too unlike the trusted ones
MAX_TRUSTED = 20_000  # labelled documents that the trusted model is fitted on
MIN_WORDS = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def bucketed(words: Column) -> Column:
    """Bucket of every word and of every pair of neighbours."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    two = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
    return F.concat(one, F.slice(two, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, although lambdas inside ``use`` refer to it."""
    return F.get(F.transform(F.array(value), use), 0)


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text. ``words`` should be a plain column."""
    last = F.size(words) - 3
    window = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(window, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(starts: Column) -> Column:
        shifted = [starts, F.transform(starts, lambda i: i + 1), F.transform(starts, lambda i: i + 2)]
        return F.size(F.array_distinct(F.flatten(F.array(*shifted))))

    def twice(placed: Column) -> Column:
        def same(k: Column, x: Column) -> Column:
            return F.coalesce(F.get(placed, k)["h"] == x["h"], F.lit(False))

        both = F.filter(placed, lambda x, k: same(k - 1, x) | same(k + 1, x))
        return _bound(F.transform(both, lambda x: x["i"]), covered)

    def count(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_bound(placed, twice))

    return _bound(hashes, count)


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("words"), lines.alias("lines"))
    return split.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def gram_ratios(docs: DataFrame, trusted_ids: DataFrame) -> list[float]:
    """Log of the share of each bucket in trusted text over its share in all text; a list of ``BUCKETS`` numbers.

    ``trusted_ids`` has at most ``MAX_TRUSTED`` rows, so it may be broadcast; all of ``docs`` is counted.
    """
    known = docs.join(F.broadcast(trusted_ids.select("doc_id", F.lit(1).alias("trusted"))), "doc_id", "left")
    grams = known.select(F.col("trusted"), F.explode(bucketed(words_of(F.col("text")))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("good")).toPandas()
    raw, good = [SMOOTHING] * BUCKETS, [0.0] * BUCKETS
    for bucket, r, g in counts.itertuples(index=False):
        raw[bucket] += r
        good[bucket] += g
    # the trusted shares lean on the raw ones with the weight of one n-gram a bucket
    every, best = sum(raw), sum(good) + BUCKETS
    return [math.log((g + BUCKETS * r / every) / best) - math.log(r / every) for r, g in zip(raw, good)]


def trusted_documents(labels: DataFrame, most: int = MAX_TRUSTED) -> DataFrame:
    """Ids of labelled documents of high quality that are not toxic: all, or the first ``most`` by hash of the id."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def judge_quality(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, ``base_failed``, ``llr`` and ``kept`` for every row of ``docs`` (``doc_id, text``).

    ``llr`` is the mean over a text's words and pairs of neighbours of their log ratio, trusted over raw; 0 without any.
    ``kept`` is false if the base rules fail (under 50 words, or more than half of the words repeated), else ``llr >=
    threshold``. Empty and null texts have no words and fail. Repeated rows are judged alike.
    """
    ratios = gram_ratios(docs, trusted_ids)
    model = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    counted = base_counts(docs)
    total = F.aggregate(bucketed(F.col("words")), F.lit(0.0), lambda s, b: s + F.get(model, b))
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (total / grams).alias("llr"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, trusted_documents(table(spark, sf_dir, "labels")))
