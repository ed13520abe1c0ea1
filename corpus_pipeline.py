"""A training corpus from raw documents: toxic texts go, near copies go, repeated passages go, sources are mixed, texts encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from partledger.llm import bpe, jaccard, mixing, suffixes, toxicity
from partledger.llm.common import table
from partledger.session import checkpointed

#: The stages train, hash and draw, which SQL cannot express; tests hold them against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones, scores below its cut.

    Null, empty and wordless texts score 0 and stay; repeated rows share their fate; other columns pass as they are.
    """
    net = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, net).where(F.col("toxicity") < toxicity.CUT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id.

    Null and wordless texts link with nothing and stay. Of rows equal in id and text one stays, the first by the other columns.
    """
    return jaccard.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere too.

    Null stays null, a text that is all repeats becomes empty, ``n_chars`` is counted again; no row goes.
    """
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null is a source of its own. Texts without words are only taken as often as all of their source are; equal rows share their copies.
    """
    return mixing.mixture(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each text's token ids, and the digest of what they decode to; null and empty texts have no ids."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "source", "lang"))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again. An empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs
