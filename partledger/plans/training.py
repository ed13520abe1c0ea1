"""The batch job: load, merge, match, mine, recommend, score, report.

Every stage after the merge is on its own: a failing stage leaves ``error`` in the metrics, the others go on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from partledger.config import DEFAULTS, FEATURES, TRUTH, Settings
from partledger.functions.columns import resolve_column
from partledger.operators import baskets, evaluate, features, forest, iforest, matching, merge, profile, recommend, sampling
from partledger.session import checkpointed, ship_package
from partledger.sources import files, models


@dataclass
class Run:
    """Metrics as ``section -> {metric: value}`` and the tables a caller may want next."""

    metrics: dict[str, dict] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(s, m, None if v is None else str(v)) for s, ms in self.metrics.items() for m, v in ms.items()]
        return spark.createDataFrame(rows, "section string, metric string, value string")


def _row(df: DataFrame) -> dict:
    return df.first().asDict()


def _rounded(values: dict, places: int = 4) -> dict:
    return {k: round(v, places) if isinstance(v, float) else v for k, v in values.items()}


def run(
    spark: SparkSession,
    survey: DataFrame,
    garage: DataFrame,
    out: str,
    settings: Settings = DEFAULTS,
    grid: dict[str, list] | None = None,
    params: forest.ForestParams | None = None,
    label: str = DEFAULTS.label,
) -> Run:
    """Run all stages and write their tables and models under ``out``.

    The forest's parameters are searched in ``grid`` (none: that of the settings) unless ``params`` gives them.
    """
    ship_package(spark)
    result = Run()
    survey, garage = _resolved(survey, garage, settings, label)
    merged = merge.merge_claims(survey, garage, settings.merge_keys, settings.amount)
    if settings.amount in survey.columns:
        rows, weight = checkpointed(merge.matched_survey(survey, garage, settings.merge_keys)), merge.FANOUT
    else:  # amounts differ between the garage rows of a survey row, so its fan-out cannot stand for them
        rows, weight = checkpointed(merged), None
    if rows.isEmpty():
        raise ValueError("the merge is empty: the two tables share no claim")
    amount = F.col(settings.amount) <= merge.amount_cap(rows, settings.amount, weight)
    merged, rows = merged.where(amount), rows.where(amount)  # later stages read each survey row once, with its fan-out
    if settings.sample_size:
        merged = checkpointed(merge.sample_n(merged, settings.sample_size, settings.seed))
        rows, weight = merged, None
    merged.write.mode("overwrite").parquet(f"{out}/merged")
    counts = profile.row_counts({"surveyor": survey, "garage": garage, "merged": spark.read.parquet(f"{out}/merged")})
    result.metrics["data"] = {f"{r['table_name']}_rows": r["row_count"] for r in counts.collect()}

    def stage(name: str, work: Callable[[], dict]) -> None:
        try:
            result.metrics[name] = work()
        except Exception as error:  # reported, and the next stage starts
            result.metrics[name] = {"error": str(error)}

    stage("part_matching", lambda: _match(result, survey, garage, out, settings))
    stage("association_mining", lambda: _mine(result, rows, out, settings))
    stage("recommender", lambda: _recommend(result, rows, weight, out, settings))
    stage("fraud_detection", lambda: _fraud(result, spark, rows, weight, out, settings, grid, params, label))
    stage("common_parts", lambda: _parts(survey, out, settings))
    files.write_metrics(result.table(spark), f"{out}/metrics")
    return result


def _named(df: DataFrame, name: str, *keywords: str) -> DataFrame:
    """``df`` with the first column that fits a keyword called ``name``; unchanged if there is one of that name, or none."""
    if name in df.columns:
        return df
    for keyword in keywords:
        try:
            return df.withColumnRenamed(resolve_column(df, keyword), name)
        except ValueError:
            continue
    return df


def _resolved(survey: DataFrame, garage: DataFrame, settings: Settings, label: str) -> tuple[DataFrame, DataFrame]:
    """Claim, label and amount under their usual names; the amount may be on the garage side only."""
    survey, garage = (_named(df, settings.claim_id, "CLAIMNO", "CLAIM_NO", "CLAIM_ID") for df in (survey, garage))
    survey = _named(_named(survey, label, "FRAUD"), settings.amount, "TOTAL_AMOUNT", "AMOUNT")
    if settings.amount not in survey.columns:
        garage = _named(garage, settings.amount, "TOTAL_AMOUNT", "AMOUNT")
        if settings.amount not in garage.columns:
            raise ValueError(f"no amount column among {survey.columns} and {garage.columns}")
    return survey, garage


def _match(result: Run, survey: DataFrame, garage: DataFrame, out: str, settings: Settings) -> dict:
    left = checkpointed(matching.distinct_parts(survey, settings.survey_part, settings.synonyms))
    right = checkpointed(matching.distinct_parts(garage, settings.garage_part, settings.synonyms))
    if left.isEmpty() or right.isEmpty():
        raise ValueError("cannot match empty part lists")
    model = matching.tfidf_fit(left, right, settings.ngram_range, settings.max_terms)
    combined = checkpointed(
        matching.combine_matches(
            matching.match_fuzzy(left, right, settings.fuzzy_threshold),
            matching.match_cosine(left, right, model, settings.cosine_threshold),
        )
    )
    files.write_csv(combined, f"{out}/part_matching_results")
    models.save_matcher(models.Matcher(model, right), f"{out}/models")
    result.tables["matches"] = combined
    return {**_rounded(_row(matching.match_rates(combined)), 2), "garage_parts": right.count()}


def _mine(result: Run, rows: DataFrame, out: str, settings: Settings) -> dict:
    part = _part_column(rows, settings)
    pairs = baskets.multi_item(baskets.basket_items(rows, part, settings.claim_id))
    found = baskets.frequent_itemsets(pairs, settings.min_support)
    rules = checkpointed(baskets.association_rules(found.table, settings.min_confidence, settings.min_lift))
    files.write_csv(baskets.export_itemsets(found.table), f"{out}/frequent_itemsets")
    files.write_csv(baskets.export_rules(baskets.sort_rules(rules)), f"{out}/association_rules")
    result.tables.update(itemsets=found.table, rules=rules)
    return _row(baskets.rules_summary(found.table, rules))


def _part_column(rows: DataFrame, settings: Settings) -> str:
    return resolve_column(rows, "PART", exclude="CODE", preferred=[settings.survey_part])


def _recommend(result: Run, rows: DataFrame, weight: str | None, out: str, settings: Settings) -> dict:
    part = _part_column(rows, settings)
    inter = checkpointed(recommend.interaction_table(rows, part, settings.claim_id, settings.amount, weight))
    model = recommend.svd_fit(inter, settings.components)
    edges = recommend.top_similar(recommend.svd_project(inter, model), settings.top_n)  # stored
    models.save_recommender(models.Recommender(model, edges), f"{out}/models")
    result.tables["recommendations"] = edges
    return _row(recommend.evaluate_recommender(edges, model, settings.top_n))


def isolation_metrics(scored: DataFrame, scaler: sampling.Scaler, key: str) -> dict:
    """Counts, amounts by group, score spread and cluster quality of a scored table."""
    amount = F.col("total_amount")
    fraud, normal = F.col("is_fraud") == 1, F.col("is_fraud") == 0
    numbers = scored.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(fraud).alias("flagged_fraud"),
        (F.avg("is_fraud") * 100).alias("fraud_rate_pct"),
        F.avg(F.when(fraud, amount)).alias("avg_fraud_amount"),
        F.avg(F.when(normal, amount)).alias("avg_normal_amount"),
        F.stddev_samp(F.when(fraud, amount)).alias("fraud_amount_std"),
        F.stddev_samp(F.when(normal, amount)).alias("normal_amount_std"),
        F.avg("anomaly_score").alias("avg_anomaly_score"),
        F.stddev_samp("anomaly_score").alias("anomaly_score_std"),
    )
    scaled = sampling.apply_scaler(scored, scaler)
    points = scaled.select(key, F.array(*scaler.columns).alias("x"), "anomaly_label")
    quality = {
        **_row(evaluate.silhouette(points, key, "x", "anomaly_label").select("silhouette")),
        **_row(
            evaluate.calinski_harabasz(scaled, [F.col(c) for c in scaler.columns], "anomaly_label").select(
                "calinski_harabasz"
            )
        ),
    }
    return _rounded({**_row(numbers), **{k: v for k, v in quality.items() if v is not None}})


def _supervised(scored: DataFrame) -> dict:
    """Metrics against the known labels; the area under the curve where there are probabilities."""
    values = _row(evaluate.binary_metrics(scored, TRUTH, "is_fraud"))
    if "fraud_probability" in scored.columns:
        values["roc_auc"] = evaluate.roc_auc(scored, TRUTH, "fraud_probability").first()["roc_auc"]
    return _rounded(values)


def _fraud(result, spark, rows, weight, out, settings, grid, params, label) -> dict:
    key = settings.claim_id
    known = label in rows.columns
    table = checkpointed(features.claim_features(rows, weight, key, label=label if known else None))
    result.tables["features"] = table
    split = checkpointed(sampling.stratified_split(table, key, label if known else None, settings.test_ratio, settings.seed))
    train, test = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    anomaly = iforest.fit(
        train, key, FEATURES, settings.iso_trees, settings.iso_samples, settings.contamination, settings.seed
    )
    models.save_anomaly(anomaly, spark, f"{out}/models")
    scored = checkpointed(iforest.score(test, anomaly))
    report = {f"iforest_{k}": v for k, v in isolation_metrics(scored, anomaly.scaler, key).items()}
    winner = checkpointed(iforest.score(table, anomaly))
    report.update({f"iforest_all_{k}": v for k, v in isolation_metrics(winner, anomaly.scaler, key).items()})
    sizes = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    report.update(features_used=", ".join(FEATURES), train_size=sizes.get("train", 0), test_size=sizes.get("test", 0))
    if known:
        report.update({f"iforest_all_{k}": v for k, v in _supervised(winner).items()})
        flat = _rounded(_row(evaluate.binary_metrics(scored, TRUTH, "is_fraud")))
        report.update({f"iforest_{k}": v for k, v in flat.items()})
        folds = checkpointed(sampling.repeated_folds(train, key, label, settings.cv_splits, settings.cv_repeats))
        chosen = params or forest.ForestParams(settings.rf_trees, settings.rf_depth, settings.rf_min_split, settings.seed)
        ranking = None
        if params is None:
            points = forest.grid_search(folds, grid or settings.grid, label)
            chosen, ranking = points[0][0], forest.grid_table(spark, points)
            report.update(forest_best_params=str(chosen), forest_best_cv_f1=round(points[0][1], 4))
        model = forest.fit(train, label, FEATURES, chosen)
        tested = checkpointed(forest.score(test, model))
        best = _supervised(tested)
        report.update({f"forest_{k}": v for k, v in best.items()}, forest_threshold=model.threshold)
        cv = forest.fold_table(spark, forest.cross_validate(folds, label, FEATURES, chosen))
        result.tables["folds"] = cv
        for r in forest.cv_summary(cv).collect():
            report[f"forest_cv_{r['metric']}"] = f"{r['mean']:.4f} +/- {r['std']:.4f}"
        parts = forest.evaluation(model, tested, cv, ranking)
        models.save_forest(model, spark, f"{out}/models", parts)
        result.tables.update(importances=parts["importances"], report=parts["report"])
        report.update({f"forest_importance_{r['feature']}": r["importance"] for r in parts["importances"].collect()})
        for r in cv.collect():
            report[f"forest_cv_{r['repeat']}_{r['fold']}_{r['metric']}"] = None if r["value"] is None else round(r["value"], 4)
        report["best_model"] = select_best_model(best["f1_score"], flat["f1_score"])
        everything = forest.score(table, model)
        report.update({f"forest_all_{k}": v for k, v in _supervised(everything).items()})
        if report["best_model"] == "forest":
            winner = everything
    winner.write.mode("overwrite").parquet(f"{out}/fraud_predictions")
    result.tables["predictions"] = spark.read.parquet(f"{out}/fraud_predictions")
    return report


def select_best_model(forest_f1: float | None, iforest_f1: float | None) -> str:
    """The forest when it is at least as good on held-out F1; the isolation forest when there is no forest."""
    if forest_f1 is None:
        return "iforest"
    return "forest" if iforest_f1 is None or forest_f1 >= iforest_f1 else "iforest"


def _parts(survey: DataFrame, out: str, settings: Settings) -> dict:
    common = profile.common_parts(survey, settings.survey_part)
    files.write_csv(common, f"{out}/common_parts")
    report = {"distinct_parts": common.count()}
    if settings.part_code in survey.columns:
        files.write_csv(profile.primary_part_distribution(survey, settings.part_code), f"{out}/primary_parts_distribution")
    return report
