"""Answering requests with stored models: part names, claim ids, quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from partledger.operators import iforest
from partledger.operators.features import quote_features
from partledger.operators.matching import match_batch
from partledger.operators.recommend import recommend_batch
from partledger.sources.models import Matcher, Recommender


def find_parts(names: DataFrame, matcher: Matcher, clean: bool = False) -> DataFrame:
    return match_batch(names, matcher.garage, matcher.model, clean=clean)


def find_claims(ids: DataFrame, recommender: Recommender, n: int = 5) -> DataFrame:
    return recommend_batch(ids, recommender.edges, n)


def score_quotes(quotes: DataFrame, model: iforest.IForestModel) -> DataFrame:
    """``total_amount, part_count`` rows with features, anomaly score and SUSPICIOUS / NORMAL."""
    return iforest.quote_status(iforest.score(quote_features(quotes), model))
