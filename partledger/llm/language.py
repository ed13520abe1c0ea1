"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from partledger.llm.common import start, table

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)  # characters in an n-gram
MAX_LANGUAGES = 512  # bound of the model: BUCKETS x MAX_LANGUAGES x 4 bytes
SLICE_CHARS = 1 << 19
TOTAL = -1  # bucket under which the number of documents of a language is kept
UNKNOWN = "und"


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") + 2
        if size > SLICE_CHARS:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def gram_buckets(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram length the bucket at every character (``BUCKETS``: no n-gram begins here), and text offsets."""
    lowered = [(t or "").lower() for t in texts]
    offsets = np.cumsum([0, *(len(t) for t in lowered)])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.repeat(offsets[1:], np.diff(offsets))  # of the text at each character
    here = np.arange(len(codes))
    value, found = np.zeros(len(codes), np.uint64), []
    for n in range(1, max(ORDERS) + 1):
        value = value * np.uint64(0x9E3779B97F4A7C15)
        value[: len(codes) - n + 1] += codes[n - 1 :] + np.uint64(1)
        if n in ORDERS:
            bucket = ((value * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 15)).astype(np.int32)
            bucket[here + n > ends] = BUCKETS
            found.append(bucket)
    return found, offsets


def gram_counts(learned: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all rows of ``learned`` (``lang, text``); each task adds up before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in sums.items():
                at = np.flatnonzero(counts[:BUCKETS])
                buckets, n = np.append(at, TOTAL), np.append(counts[at], docs[lang])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), pa.array(buckets.astype(np.int32)), pa.array(n)], ["lang", "bucket", "n"]
                )
            sums.clear()
            docs.clear()

        for batch in batches:
            langs, texts = batch["lang"].to_pylist(), batch["text"].to_pylist()
            for lang in set(langs):
                own = [t for x, t in zip(langs, texts) if x == lang]
                docs[lang] = docs.get(lang, 0) + len(own)
                total = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                for a, b in _runs(own):
                    for bucket in gram_buckets(own[a:b])[0]:
                        total += np.bincount(bucket, minlength=BUCKETS + 1)
                if len(sums) > 64:
                    yield from flush()
        yield from flush()

    parts = learned.select("lang", "text").mapInArrow(run, "lang string, bucket int, n bigint")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Log-probabilities by bucket and language; the last row, of no n-gram, is zero."""

    def __init__(self, langs: list[str], prior: np.ndarray, grams: np.ndarray):
        self.langs, self.prior, self.grams = langs, prior, grams

    @staticmethod
    def fit(learned: DataFrame, smoothing: float = 0.5) -> LanguageModel:
        counts = gram_counts(learned)
        totals = {r["lang"]: r["n"] for r in counts.where(F.col("bucket") == TOTAL).limit(MAX_LANGUAGES + 1).collect()}
        if len(totals) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        langs = sorted(totals)
        grams = np.zeros((BUCKETS + 1, len(langs)), np.float64)
        place = {lang: k for k, lang in enumerate(langs)}
        rows = counts.where(F.col("bucket") != TOTAL).toPandas()
        grams[rows["bucket"].to_numpy(), rows["lang"].map(place).to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
        smooth = grams[:BUCKETS] + smoothing
        grams[:BUCKETS] = np.log(smooth / smooth.sum(axis=0)) if langs else 0.0
        grams[BUCKETS] = 0.0
        prior = np.log(np.array([totals[x] for x in langs], np.float64) / max(1, sum(totals.values())))
        return LanguageModel(langs, prior, grams.astype(np.float32))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Posterior log-odds of each text and language, up to a constant."""
        out = np.zeros((len(texts), len(self.langs)))
        for a, b in _runs(texts):
            buckets, offsets = gram_buckets(texts[a:b])
            full = np.flatnonzero(np.diff(offsets))
            if len(full):
                for bucket in buckets:
                    for k in range(len(self.langs)):
                        column = self.grams[:, k]
                        out[a + full, k] += np.add.reduceat(column[bucket], offsets[:-1][full], dtype=np.float64)
        return out + self.prior

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        scores = self.scores(texts)
        best = scores.argmax(axis=1)
        sure = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
        lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
        return [self.langs[k] if ok else UNKNOWN for k, ok in zip(best, lettered)], np.where(lettered, sure, 0.0)


def identify(docs: DataFrame, learned: DataFrame) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, from a model of ``learned`` (``lang, text``; null lang is left out).

    ``score`` is the posterior of the predicted language. Null text and text without a letter give ``und`` and 0; so does
    everything if nothing was learned. Equal posteriors go to the smaller language name. Repeated rows count again.
    """
    spark = docs.sparkSession
    start(spark)
    model = LanguageModel.fit(learned.where(F.col("lang").isNotNull()))
    shared = spark.sparkContext.broadcast((model.langs, model.prior, np.asfortranarray(model.grams)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = LanguageModel(*shared.value)
        for batch in batches:
            langs, score = here.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; a null id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, docs.where(~held_out(5, 0)))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")
