"""The same lookups over streams of requests; every request is answered by itself, so no state is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from partledger.operators import iforest
from partledger.plans.lookups import find_claims, find_parts, score_quotes
from partledger.sources.models import Matcher, Recommender


def quote_scores(quotes: DataFrame, model: iforest.IForestModel) -> DataFrame:
    """A stream of quotes to a stream of scores: a projection, fit for any sink."""
    return score_quotes(quotes, model)


def part_answers(names: DataFrame, matcher: Matcher, out: str, checkpoint: str) -> StreamingQuery:
    """Match each micro-batch of names; one folder per batch, so a repeated batch replaces itself."""

    def answer(batch: DataFrame, number: int) -> None:
        find_parts(batch, matcher).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return names.writeStream.option("checkpointLocation", checkpoint).foreachBatch(answer).start()


def claim_answers(ids: DataFrame, recommender: Recommender, out: str, checkpoint: str) -> StreamingQuery:
    """Neighbours of each micro-batch of claim ids."""

    def answer(batch: DataFrame, number: int) -> None:
        find_claims(batch, recommender).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return ids.writeStream.option("checkpointLocation", checkpoint).foreachBatch(answer).start()
