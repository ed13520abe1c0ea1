"""Matching the assessor's part names to the repairer's: edit similarity and TF-IDF cosine.

Both find, for every survey name, the best garage name. Names that agree exactly are settled by an equality
join. The rest is an exact best-match search: garage names are grouped into cells, every survey name first
searches its home cell, and then only those other cells whose upper bound can reach the score found so far.
Ties go to the smaller garage name (a table has no order of appearance).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from partledger.config import DEFAULTS
from partledger.functions.numbers import rounded
from partledger.functions.similarity import StringBlock, pair_ratios, score
from partledger.functions.text import canonical_parts, clean_text, ngrams, strip_space, token_sort_key, tokens
from partledger.operators.blocks import block_join
from partledger.session import checkpointed

CELL_ROWS = 2048
MAX_CELLS = 4096
BOUND_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "
SLACK = 1e-9


def distinct_parts(df: DataFrame, part: str, synonyms: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct non-blank names as one column ``name``; words with a synonym in their canonical form, if any are given."""
    name = canonical_parts(F.col(part), synonyms) if synonyms else F.col(part)
    return df.select(name.alias("name")).where(F.trim("name") != "").distinct()


def _cell_count(rows: int, cell_rows: int) -> int:
    return max(1, min(MAX_CELLS, rows // cell_rows))


# --- edit similarity -------------------------------------------------------------------------------------


def token_sort_ratio(a: Column, b: Column) -> Column:
    """0 to 100 for two columns of text."""

    @F.pandas_udf("int")
    def pair_score(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(score(pair_ratios(left.tolist(), right.tolist())))

    return pair_score(token_sort_key(a), token_sort_key(b))


def _best_edit(left: pa.Table, right: pa.Table) -> pd.DataFrame:
    a, b = left.to_pandas(), right.to_pandas()
    b = b.sort_values("name", ignore_index=True)
    block = StringBlock(b["sort_key"].tolist())
    found = []
    for text in a["sort_key"]:
        ratios = block.ratios(text)
        found.append((ratios.max(), int(ratios.argmax())))
    best = pd.DataFrame(found, columns=["ratio", "at"])
    return pd.DataFrame(
        {"sort_key": a["sort_key"].to_numpy(), "name": b["name"].to_numpy()[best["at"]], "ratio": best["ratio"]}
    )


def _letter_counts(text: Column) -> list[Column]:
    known = [F.length(text) - F.length(F.replace(text, F.lit(ch))) for ch in BOUND_LETTERS]
    rest = F.length(F.regexp_replace(text, "[a-z0-9 ]", ""))
    return [*known, rest]


def _edit_cells(cells: DataFrame, queries: DataFrame) -> DataFrame:
    """Other cells whose letter counts and lengths allow a ratio of at least ``queries.ratio``."""
    key = F.col("sort_key")
    limits = cells.groupBy("cell").agg(
        F.min(F.length(key)).alias("shortest"),
        F.max(F.length(key)).alias("longest"),
        *[F.max(c).alias(f"n{i}") for i, c in enumerate(_letter_counts(key))],
    ).toPandas()  # one row per cell, at most MAX_CELLS
    ids = limits["cell"].to_numpy()
    shortest, longest = limits["shortest"].to_numpy(), limits["longest"].to_numpy()
    most = limits[[f"n{i}" for i in range(len(BOUND_LETTERS) + 1)]].to_numpy()

    @F.pandas_udf("array<int>")
    def reachable(home: pd.Series, length: pd.Series, counts: pd.Series, ratio: pd.Series) -> pd.Series:
        out = []
        for h, n, c, r in zip(home, length, counts, ratio):
            common = np.minimum(np.minimum(most, np.asarray(c)).sum(axis=1), longest)
            bound = 2.0 * common / np.maximum(n + np.maximum(shortest, common), 1)
            out.append(ids[(bound >= r - SLACK) & (ids != h)])
        return pd.Series(out)

    counts = F.array(*[c.cast("int") for c in _letter_counts(key)])
    return queries.withColumn("cell", F.explode(reachable("home", F.length(key), counts, "ratio")))


def _best_of(candidates: DataFrame, key: str, value: str) -> DataFrame:
    """Highest ``value``, then smallest ``name``, per ``key``."""
    best = F.min(F.struct((-F.col(value)).alias("lost"), F.col("name"))).alias("b")
    return candidates.groupBy(key).agg(best).select(key, "b.name", (-F.col("b.lost")).alias(value))


def nearest_by_edit(queries: DataFrame, garage: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``sort_key, name, ratio``: the most similar garage name for every distinct key of ``queries``.

    ``queries`` has a ``sort_key`` column, ``garage`` a ``name`` column.
    """
    keyed = garage.withColumn("sort_key", token_sort_key(F.col("name")))
    target = checkpointed(keyed.groupBy("sort_key").agg(F.min("name").alias("name")))
    wanted = queries.select("sort_key").distinct()
    equal = wanted.join(target, "sort_key").withColumn("ratio", F.lit(1.0))
    open_keys = wanted.join(target, "sort_key", "left_anti")
    cells = _cell_count(target.count(), cell_rows)
    cell_of = F.pmod(F.xxhash64(F.element_at(F.split("sort_key", " "), 1)), F.lit(cells)).cast("int")
    data = target.withColumn("cell", cell_of)
    schema = "sort_key string, name string, ratio double"
    if cells == 1:
        found = block_join(open_keys.withColumn("cell", cell_of), data, "sort_key", "name", _best_edit, schema)
        return equal.unionByName(_best_of(found, "sort_key", "ratio"))
    homed = open_keys.withColumn("cell", cell_of)
    near = _best_of(
        block_join(homed, data, "sort_key", "name", _best_edit, schema), "sort_key", "ratio"
    )
    first = checkpointed(
        homed.withColumnRenamed("cell", "home")
        .join(near, "sort_key", "left")
        .withColumn("ratio", F.coalesce("ratio", F.lit(0.0)))
    )
    probes = _edit_cells(data, first).select("sort_key", "cell")
    more = block_join(probes, data, "sort_key", "name", _best_edit, schema)
    known = first.where(F.col("name").isNotNull()).select("sort_key", "name", "ratio")
    return equal.unionByName(_best_of(known.unionByName(more), "sort_key", "ratio"))


def match_fuzzy(
    survey: DataFrame, garage: DataFrame, threshold: int = DEFAULTS.fuzzy_threshold, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``survey_part, garage_part, fuzzy_score, matched`` for every name of ``survey.name``.

    The score is reported even below the threshold; the garage part is null there.
    """
    names = survey.withColumn("sort_key", token_sort_key(F.col("name")))
    near = nearest_by_edit(names, garage, cell_rows).withColumnRenamed("name", "garage_part")
    points = F.bround(F.col("ratio") * 100, 0).cast("int")
    return (
        names.join(near, "sort_key")
        .withColumn("fuzzy_score", points)
        .withColumn("matched", F.col("fuzzy_score") >= threshold)
        .select(
            F.col("name").alias("survey_part"),
            F.when(F.col("matched"), F.col("garage_part")).alias("garage_part"),
            "fuzzy_score",
            "matched",
        )
    )


# --- TF-IDF cosine ---------------------------------------------------------------------------------------


@dataclass
class TfidfModel:
    """``terms``: term, idf; at most ``max_terms`` rows."""

    terms: DataFrame
    ngram_range: tuple[int, int] = DEFAULTS.ngram_range


def _term_rows(docs: DataFrame, ngram_range: tuple[int, int]) -> DataFrame:
    """``name, term, tf`` for every n-gram of every name."""
    grams = ngrams(tokens(F.col("name")), *ngram_range)
    exploded = docs.select("name", F.explode(grams).alias("term"))
    return exploded.groupBy("name", "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_fit(
    survey: DataFrame,
    garage: DataFrame,
    ngram_range: tuple[int, int] = DEFAULTS.ngram_range,
    max_terms: int = DEFAULTS.max_terms,
) -> TfidfModel:
    """Vocabulary and smoothed IDF over both name lists; a name on both sides is two documents.

    Keeps the ``max_terms`` most frequent terms, ties by term.
    """
    documents = survey.select("name", F.lit(0).alias("side")).unionByName(garage.select("name", F.lit(1).alias("side")))
    copies = documents.groupBy("name").agg(F.count(F.lit(1)).alias("copies"))
    total = copies.select(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
    terms = (
        _term_rows(copies, ngram_range)
        .join(copies, "name")
        .groupBy("term")
        .agg(F.sum(F.col("tf") * F.col("copies")).alias("frequency"), F.sum("copies").alias("df"))
        .orderBy(F.desc("frequency"), "term")
        .limit(max_terms)
    )
    idf = F.log((1.0 + total) / (1.0 + F.col("df"))) + 1.0
    return TfidfModel(checkpointed(terms.select("term", "df", idf.alias("idf"))), ngram_range)


def tfidf_transform(docs: DataFrame, model: TfidfModel) -> DataFrame:
    """``name, term, weight``: sublinear term frequency times IDF, unit length per name."""
    raw = (
        _term_rows(docs, model.ngram_range)
        .join(F.broadcast(model.terms), "term")
        .withColumn("raw", (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    )
    norms = raw.groupBy("name").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norms, "name").select("name", "term", (F.col("raw") / F.col("norm")).alias("weight"))


def tfidf_vectors(docs: DataFrame, model: TfidfModel) -> DataFrame:
    """``name, terms, weights``: one sparse vector per name, terms sorted; names without a term are left out."""
    raw = (
        _term_rows(docs, model.ngram_range)
        .join(F.broadcast(model.terms), "term")
        .withColumn("raw", (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    )
    packed = raw.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("term", "raw"))).alias("v"))
    norm = F.sqrt(F.aggregate("v.raw", F.lit(0.0), lambda s, w: s + w * w))
    weights = F.transform("v.raw", lambda w: w / norm)
    return packed.select("name", F.col("v.term").alias("terms"), weights.alias("weights"))


def _dense(df: pd.DataFrame, column: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(df), len(column)))
    for row, (terms, weights) in enumerate(zip(df["terms"], df["weights"])):
        for term, weight in zip(terms, weights):
            at = column.get(term)
            if at is not None:
                out[row, at] = weight
    return out


def _best_cosine(left: pa.Table, right: pa.Table) -> pd.DataFrame:
    a, b = left.to_pandas(), right.to_pandas()
    b = b.sort_values("name", ignore_index=True)
    column = {t: n for n, t in enumerate(sorted({t for terms in b["terms"] for t in terms}))}
    sims = np.round(_dense(a, column) @ _dense(b, column).T, 9)
    at = sims.argmax(axis=1)
    return pd.DataFrame(
        {"query": a["query"].to_numpy(), "name": b["name"].to_numpy()[at], "cosine": sims.max(axis=1)}
    )


def _cosine_cells(data: DataFrame, queries: DataFrame) -> DataFrame:
    """Other cells that can reach ``queries.cosine``: sum of query weight times the cell's largest weight."""
    pairs = F.explode(F.arrays_zip("terms", "weights")).alias("p")
    peaks = (
        data.select("cell", pairs)
        .groupBy("cell", F.col("p.terms").alias("term"))
        .agg(F.max("p.weights").alias("peak"))
    )
    wanted = queries.select("query", "home", "cosine", pairs).select(
        "query", "home", "cosine", F.col("p.terms").alias("term"), F.col("p.weights").alias("weight")
    )
    return (
        wanted.join(peaks, "term")
        .groupBy("query", "home", "cosine", "cell")
        .agg(F.sum(F.col("weight") * F.col("peak")).alias("bound"))
        .where((F.col("cell") != F.col("home")) & (F.col("bound") >= F.col("cosine") - 1e-8))
        .select("query", "cell")
    )


def nearest_by_cosine(
    queries: DataFrame, garage: DataFrame, model: TfidfModel, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``query, name, cosine`` for every query that shares a term with a garage name."""
    packed = tfidf_vectors(garage, model).groupBy("terms", "weights").agg(F.min("name").alias("name"))
    target = checkpointed(packed)
    wanted = checkpointed(tfidf_vectors(queries, model).withColumnRenamed("name", "query"))
    equal = wanted.join(target, ["terms", "weights"]).select("query", "name", F.lit(1.0).alias("cosine"))
    open_queries = wanted.join(equal.select("query"), "query", "left_anti")
    cells = _cell_count(target.count(), cell_rows)
    heaviest = F.element_at("terms", F.array_position("weights", F.array_max("weights")).cast("int"))
    cell_of = F.pmod(F.xxhash64(heaviest), F.lit(cells)).cast("int")
    data = target.withColumn("cell", cell_of)
    schema = "query string, name string, cosine double"
    near = _best_of(
        block_join(
            open_queries.withColumn("cell", cell_of), data, "query", "name", _best_cosine, schema, block_rows=1024
        ),
        "query",
        "cosine",
    )
    if cells > 1:
        first = checkpointed(
            open_queries.withColumn("home", cell_of)
            .join(near, "query", "left")
            .withColumn("cosine", F.coalesce("cosine", F.lit(0.0)))
        )
        probes = _cosine_cells(data, first).join(first.select("query", "terms", "weights"), "query")
        more = block_join(probes, data, "query", "name", _best_cosine, schema, block_rows=1024)
        known = first.where(F.col("name").isNotNull()).select("query", "name", "cosine")
        near = _best_of(known.unionByName(more), "query", "cosine")
    return equal.unionByName(near).where(F.col("cosine") > 0)


def match_cosine(
    survey: DataFrame,
    garage: DataFrame,
    model: TfidfModel,
    threshold: float = DEFAULTS.cosine_threshold,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``survey_part, garage_part, cosine_score, matched``; no shared term gives score 0 and no part."""
    near = nearest_by_cosine(survey, garage, model, cell_rows)
    joined = survey.select("name").join(
        near.select(F.col("query").alias("name"), F.col("name").alias("garage_part"), "cosine"), "name", "left"
    )
    cosine = F.coalesce(F.col("cosine"), F.lit(0.0))
    return joined.withColumn("matched", cosine >= threshold).select(
        F.col("name").alias("survey_part"),
        F.when(F.col("matched"), F.col("garage_part")).alias("garage_part"),
        rounded(cosine, 4).alias("cosine_score"),
        "matched",
    )


# --- both together ---------------------------------------------------------------------------------------


def combine_best(fuzzy: Column, cosine: Column, fuzzy_score: Column, cosine_score: Column) -> Column:
    """The one match that exists, or the one with the higher score when they differ."""
    preferred = F.when((fuzzy == cosine) | (fuzzy_score >= cosine_score * 100), fuzzy).otherwise(cosine)
    return F.when(fuzzy.isNotNull() & cosine.isNotNull(), preferred).otherwise(F.coalesce(fuzzy, cosine))


def match_agreement(fuzzy: Column, cosine: Column) -> Column:
    return F.coalesce(fuzzy == cosine, F.lit(False))


def combine_matches(fuzzy: DataFrame, cosine: DataFrame) -> DataFrame:
    """Both results side by side, with the best match and whether the methods agree."""
    left = fuzzy.select("survey_part", F.col("garage_part").alias("garage_part_fuzzy"), "fuzzy_score")
    right = cosine.select("survey_part", F.col("garage_part").alias("garage_part_cosine"), "cosine_score")
    a, b = F.col("garage_part_fuzzy"), F.col("garage_part_cosine")
    return (
        left.join(right, "survey_part")
        .withColumn("best_match", combine_best(a, b, F.col("fuzzy_score"), F.col("cosine_score")))
        .withColumn("match_agreement", match_agreement(a, b))
    )


def match_rates(combined: DataFrame) -> DataFrame:
    """Share of names matched by each method and share of agreement, in percent."""

    def percent(condition: Column) -> Column:
        return F.avg(condition.cast("int")) * 100

    return combined.agg(
        F.count(F.lit(1)).alias("survey_parts"),
        percent(F.col("garage_part_fuzzy").isNotNull()).alias("fuzzy_match_rate"),
        percent(F.col("garage_part_cosine").isNotNull()).alias("cosine_match_rate"),
        percent(F.col("match_agreement")).alias("agreement_rate"),
    )


def match_batch(
    requests: DataFrame,
    garage: DataFrame,
    model: TfidfModel,
    name: str = "name",
    clean: bool = False,
    cell_rows: int = CELL_ROWS,
    synonyms: Mapping[str, str] | None = None,
) -> DataFrame:
    """Look up free part names: ``input, fuzzy_match, fuzzy_score, cosine_match, cosine_score``.

    The input is stripped and lower-cased only; ``clean=True`` cleans it as the garage names were. ``synonyms`` replaces words,
    as it did in the garage names.
    """
    text = clean_text(F.col(name)) if clean else F.lower(strip_space(F.col(name)))
    text = canonical_parts(text, synonyms) if synonyms else text
    names = requests.select(F.coalesce(text, F.lit("")).alias("name")).distinct()
    fuzzy = match_fuzzy(names, garage, cell_rows=cell_rows)
    cosine = match_cosine(names, garage, model, cell_rows=cell_rows)
    answers = fuzzy.select(
        F.col("survey_part").alias("input"), F.col("garage_part").alias("fuzzy_match"), "fuzzy_score"
    ).join(
        cosine.select(
            F.col("survey_part").alias("input"), F.col("garage_part").alias("cosine_match"), "cosine_score"
        ),
        "input",
    )
    return requests.select(F.coalesce(text, F.lit("")).alias("input")).join(answers, "input")
