"""Claim tables and fitted models over one data folder, each built once per session and reused."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from partledger.config import DEFAULTS, FEATURES
from partledger.operators import features, forest, iforest, matching, merge, recommend, sampling
from partledger.session import checkpointed, shared_folder, ship_package
from partledger.sources import views

# The published job, as in ``Settings``: 300 trees of depth 12, 36 grid points, 5 x 3 folds.
QUERY_FOREST = forest.ForestParams()
QUERY_GRID = DEFAULTS.grid
QUERY_REPEATS = DEFAULTS.cv_repeats
QUERY_SPLITS = DEFAULTS.cv_splits


class Workspace:
    _open: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Workspace":
        ship_package(spark)
        return cls._open.setdefault((spark.sparkContext.applicationId, folder), cls(spark, folder))

    @classmethod
    def forget(cls) -> None:
        cls._open.clear()

    def table(self, name: str) -> DataFrame:
        return views.table(self.spark, self.folder, name)

    def scratch(self) -> str:
        """A new folder for files."""
        return f"{shared_folder(self.spark)}/files-{uuid.uuid4().hex}"

    @property
    def surveyor_raw(self) -> DataFrame:
        return views.surveyor(self.spark, self.folder)

    @property
    def garage_raw(self) -> DataFrame:
        return views.garage(self.spark, self.folder)

    @property
    def primary_parts(self) -> DataFrame:
        return views.primary_parts(self.spark, self.folder)

    @property
    def surveyor(self) -> DataFrame:
        return merge.clean_claims(self.surveyor_raw, DEFAULTS.survey_part)

    @property
    def garage(self) -> DataFrame:
        return merge.clean_claims(self.garage_raw, DEFAULTS.garage_part)

    @property
    def merged(self) -> DataFrame:
        return merge.merge_claims(self.surveyor, self.garage)

    @cached_property
    def _stored_rows(self) -> dict[frozenset[str], DataFrame]:
        return {}

    def rows(self, *columns: str) -> DataFrame:
        """Matched, capped survey rows: claim, amount, fan-out and ``columns``, from a stored table that has them if there is one."""
        for stored, rows in self._stored_rows.items():
            if stored.issuperset(columns):
                return rows
        rows = merge.claim_rows(self.surveyor, self.garage, keep=[DEFAULTS.claim_id, *columns])
        self._stored_rows[frozenset(columns)] = rows
        return rows

    def merged_within_cap(self) -> DataFrame:
        """Merged rows up to the amount cap; the cap comes from the survey rows and their fan-out, which stand for the same amounts."""
        survey = self.surveyor.select(*DEFAULTS.merge_keys, DEFAULTS.amount)
        counted = merge.matched_survey(survey, self.garage).select(DEFAULTS.amount, merge.FANOUT)
        return merge.filter_amount_cap(self.merged, DEFAULTS.amount, merge.FANOUT, checkpointed(counted))

    @cached_property
    def features(self) -> DataFrame:
        return checkpointed(features.claim_features(self.rows(DEFAULTS.label), merge.FANOUT, label=DEFAULTS.label))

    @cached_property
    def survey_names(self) -> DataFrame:
        return checkpointed(self._names(self.surveyor_raw, DEFAULTS.survey_part))

    @cached_property
    def garage_names(self) -> DataFrame:
        return checkpointed(self._names(self.garage_raw, DEFAULTS.garage_part))

    @staticmethod
    def _names(raw: DataFrame, part: str) -> DataFrame:
        """Distinct cleaned names; each spelling is cleaned once."""
        return matching.distinct_parts(merge.clean_claims(raw.select(part).distinct(), part), part)

    @cached_property
    def tfidf(self) -> matching.TfidfModel:
        return matching.tfidf_fit(self.survey_names, self.garage_names)

    @cached_property
    def fuzzy(self) -> DataFrame:
        return checkpointed(matching.match_fuzzy(self.survey_names, self.garage_names))

    @cached_property
    def cosine(self) -> DataFrame:
        return checkpointed(matching.match_cosine(self.survey_names, self.garage_names, self.tfidf))

    @property
    def combined(self) -> DataFrame:
        return matching.combine_matches(self.fuzzy, self.cosine)

    @cached_property
    def interactions(self) -> DataFrame:
        return checkpointed(recommend.interaction_table(self.rows(DEFAULTS.survey_part), DEFAULTS.survey_part, weight=merge.FANOUT))

    @cached_property
    def svd(self) -> recommend.SvdModel:
        return recommend.svd_fit(self.interactions)

    @cached_property
    def latent(self) -> DataFrame:
        return checkpointed(recommend.svd_project(self.interactions, self.svd))

    @cached_property
    def edges(self) -> DataFrame:
        return recommend.top_similar(self.latent)  # stored

    @cached_property
    def split(self) -> DataFrame:
        return checkpointed(sampling.stratified_split(self.features, DEFAULTS.claim_id))

    @property
    def train(self) -> DataFrame:
        return self.split.where("split = 'train'").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.split.where("split = 'test'").drop("split")

    @cached_property
    def anomaly(self) -> iforest.IForestModel:
        return iforest.fit(self.train)

    @cached_property
    def anomaly_scored(self) -> DataFrame:
        return checkpointed(iforest.score(self.test, self.anomaly))

    @cached_property
    def forest(self) -> forest.ForestModel:
        return forest.fit(self.train, params=QUERY_FOREST)

    @cached_property
    def forest_scored(self) -> DataFrame:
        return checkpointed(forest.score(self.test, self.forest))

    @cached_property
    def folds(self) -> DataFrame:
        return checkpointed(
            sampling.repeated_folds(self.train, DEFAULTS.claim_id, splits=QUERY_SPLITS, repeats=QUERY_REPEATS)
        )

    @cached_property
    def cv_results(self) -> list[dict]:
        return forest.cross_validate(self.folds, DEFAULTS.label, FEATURES, QUERY_FOREST)

    @property
    def cv_table(self) -> DataFrame:
        return forest.fold_table(self.spark, self.cv_results)

    @property
    def scored_orders(self) -> DataFrame:
        """Orders as scored claims: a label, a score with many ties, and two predictions."""
        return self.spark.sql(SCORED_ORDERS_SQL.format(orders="{orders}"), orders=self.table("orders"))

    @property
    def quotes(self) -> DataFrame:
        """Orders as quotes."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("quote_id"),
            F.col("o_totalprice").alias("total_amount"),
            (F.col("o_custkey") % 5).cast("int").alias("part_count"),
        )


SCORED_ORDERS_SQL = """
SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred, CASE WHEN score >= 0.2 THEN 1 ELSE 0 END AS pred_low
FROM (SELECT CAST(o_orderkey AS STRING) AS claim_id,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS truth,
             CAST((o_custkey * 7 + CASE WHEN o_orderpriority = '1-URGENT' THEN 300 ELSE 0 END) % 1000 AS DOUBLE) / 1000
             AS score FROM {orders}) q
"""
