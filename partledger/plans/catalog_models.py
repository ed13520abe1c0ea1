"""Queries over matching, mining, similarity, sampling, fraud models and their evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from partledger.config import FEATURES, TRUTH
from partledger.functions import text
from partledger.operators import baskets, chartdata, evaluate, forest, iforest, matching, merge, profile, recommend, sampling
from partledger.plans import lookups, oracle, training
from partledger.plans.catalog_tables import CODE, CLAIM, CODES, LABEL, PART, codes_of, settled
from partledger.plans.oracle import MASKS, claims, matches, rnd
from partledger.plans.registry import query
from partledger.plans.workspace import QUERY_GRID, SCORED_ORDERS_SQL, Workspace
from partledger.session import checkpointed
from partledger.sources import files, models

SCORED = SCORED_ORDERS_SQL.format(orders="orders")
KEY_SQL = r"array_to_string(list_sort(string_split(trim(regexp_replace(lower(x), '\W+', ' ', 'g')), ' ')), ' ')"


# --- part matching ---------------------------------------------------------------------------------------


@query(
    "token_sort_ratio",
    matches(
        f"""SELECT c.survey_part, c.garage_part, CAST(round_even(200.0 * (len(e.gk) - bit_count(e.v)) /
            (len(e.gk) + len(e.qk)), 0) AS INT) AS score FROM cos_best c JOIN qk q ON q.name = c.survey_part
            JOIN (SELECT x AS name, {KEY_SQL} AS k FROM (SELECT name AS x FROM garage_names)) n ON n.name = c.garage_part
            JOIN edit_pairs e ON e.qk = q.k AND e.gk = n.k WHERE c.matched"""
    ),
)
def token_sort_ratio(w: Workspace) -> DataFrame:
    """Edit score of every survey name and its cosine match."""
    pairs = w.cosine.where("matched").select("survey_part", "garage_part")
    return pairs.withColumn("score", matching.token_sort_ratio(F.col("survey_part"), F.col("garage_part")))


@query("fuzzy_cross_match", matches("SELECT qk AS sort_key, name, " + rnd("ratio", 6) + " AS ratio FROM edit_best"))
def fuzzy_cross_match(w: Workspace) -> DataFrame:
    names = w.survey_names.select(text.token_sort_key(F.col("name")).alias("sort_key"))
    return settled(matching.nearest_by_edit(names, w.garage_names), {"ratio": 6})


@query("match_fuzzy", matches("SELECT * FROM fuz_best"))
def match_fuzzy(w: Workspace) -> DataFrame:
    return matching.match_fuzzy(w.survey_names, w.garage_names)


@query("tfidf_fit", matches("SELECT term, df, " + rnd("idf", 6) + " AS idf FROM terms"))
def tfidf_fit(w: Workspace) -> DataFrame:
    model = matching.tfidf_fit(w.survey_names, w.garage_names)
    return settled(model.terms, {"idf": 6})


@query("tfidf_transform", matches("SELECT name, term, " + rnd("weight", 6) + " AS weight FROM qw"))
def tfidf_transform(w: Workspace) -> DataFrame:
    return settled(matching.tfidf_transform(w.survey_names, w.tfidf), {"weight": 6})


@query(
    "cosine_cross_match",
    matches(
        f"""SELECT survey_part AS query, garage_part AS name, {rnd('c', 6)} AS cosine FROM (SELECT *, row_number() OVER
            (PARTITION BY survey_part ORDER BY c DESC, garage_part) AS r FROM cos_pairs) WHERE r = 1 AND c > 0"""
    ),
)
def cosine_cross_match(w: Workspace) -> DataFrame:
    return settled(matching.nearest_by_cosine(w.survey_names, w.garage_names, w.tfidf), {"cosine": 6})


@query("match_cosine", matches("SELECT * FROM cos_best"))
def match_cosine(w: Workspace) -> DataFrame:
    return matching.match_cosine(w.survey_names, w.garage_names, w.tfidf)


@query("combine_matches", matches("SELECT * FROM sides"))
def combine_matches(w: Workspace) -> DataFrame:
    return w.combined.drop("best_match", "match_agreement")


@query("combine_best", matches("SELECT survey_part, best_match FROM combined"))
def combine_best(w: Workspace) -> DataFrame:
    return w.combined.select("survey_part", "best_match")


@query("match_agreement", matches("SELECT survey_part, match_agreement FROM combined"))
def match_agreement(w: Workspace) -> DataFrame:
    return w.combined.select("survey_part", "match_agreement")


@query(
    "match_rates",
    matches(
        f"""SELECT count(*) AS survey_parts, {rnd('100 * avg(CAST(garage_part_fuzzy IS NOT NULL AS INT))', 4)} AS fuzzy_match_rate,
            {rnd('100 * avg(CAST(garage_part_cosine IS NOT NULL AS INT))', 4)} AS cosine_match_rate,
            {rnd('100 * avg(CAST(match_agreement AS INT))', 4)} AS agreement_rate FROM combined"""
    ),
)
def match_rates(w: Workspace) -> DataFrame:
    rates = matching.match_rates(w.combined)
    return settled(rates, {c: 4 for c in ("fuzzy_match_rate", "cosine_match_rate", "agreement_rate")})


@query(
    "match_batch",
    matches(
        """SELECT f.survey_part AS input, f.garage_part AS fuzzy_match, f.fuzzy_score, c.garage_part AS cosine_match,
           c.cosine_score FROM fuz_best f JOIN cos_best c USING (survey_part)""",
        "request_names",
    ),
)
def match_batch(w: Workspace) -> DataFrame:
    requests = w.surveyor_raw.select(F.lower(text.strip_space(F.col(PART))).alias("name")).distinct()
    return lookups.find_parts(requests, models.Matcher(w.tfidf, w.garage_names))


@query(
    "chart_match_scatter",
    matches(
        """SELECT survey_part, fuzzy_score, cosine_score, CAST(match_agreement AS INT) AS agree, 80 AS fuzzy_threshold,
           CAST(0.15 AS DOUBLE) AS cosine_threshold FROM combined WHERE fuzzy_score IS NOT NULL AND cosine_score IS NOT NULL"""
    ),
)
def chart_match_scatter(w: Workspace) -> DataFrame:
    return chartdata.match_scatter(w.combined)


_SCORE_HIST = """SELECT '{c}' AS column_name, b AS bin, {low} AS low, coalesce(n, 0) AS n FROM (
    SELECT *, unnest(range(0, 50)) AS b, (hi - lo) / 50 AS wd FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM combined))
    LEFT JOIN (SELECT least(floor(({c} - lo) / ((hi - lo) / 50)), 49) AS b, count(*) AS n FROM combined,
      (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM combined) GROUP BY 1) USING (b)"""


@query(
    "chart_score_hist",
    matches(
        " UNION ALL ".join(
            _SCORE_HIST.format(c=c, low=rnd("CAST(lo AS DOUBLE) + b * wd", 4)) for c in ("fuzzy_score", "cosine_score")
        )
    ),
)
def chart_score_hist(w: Workspace) -> DataFrame:
    """Distribution of both match scores, 50 bins."""
    scores = profile.long_form(w.combined, ["fuzzy_score", "cosine_score"])
    bars = chartdata.histogram(scores, "value", 50, ["column_name"])
    return settled(bars, {"low": 4}).select("column_name", "bin", "low", "n")


# --- baskets and rules -----------------------------------------------------------------------------------


def _pairs(w: Workspace, item: str = CODE) -> DataFrame:
    return baskets.multi_item(baskets.basket_items(w.rows(item), item))


def _baskets_text(pairs: DataFrame) -> DataFrame:
    return baskets.collect_baskets(pairs).withColumn("items", F.array_join("items", ", "))


@query(
    "collect_basket",
    oracle.baskets(PART, "SELECT claim, string_agg(item, ', ' ORDER BY item) AS items FROM all_pairs GROUP BY claim"),
)
def collect_basket(w: Workspace) -> DataFrame:
    return _baskets_text(baskets.basket_items(w.rows(PART), PART))


@query(
    "filter_multi_item",
    oracle.baskets(PART, "SELECT claim, count(*) AS n FROM pairs GROUP BY claim"),
)
def filter_multi_item(w: Workspace) -> DataFrame:
    return _pairs(w, PART).groupBy("claim").agg(F.count(F.lit(1)).alias("n"))


@query(
    "baskets",
    oracle.baskets(PART, "SELECT claim, string_agg(item, ', ' ORDER BY item) AS items FROM pairs GROUP BY claim"),
)
def basket_table(w: Workspace) -> DataFrame:
    return _baskets_text(_pairs(w, PART))


@query(
    "one_hot",
    oracle.baskets(
        CODE, "SELECT claim, " + ", ".join(f"coalesce(max(1) FILTER (item = '{c}'), 0) AS {c}" for c in CODES) + " FROM pairs GROUP BY claim"
    ),
)
def one_hot(w: Workspace) -> DataFrame:
    pairs = _pairs(w)
    return pairs.groupBy("claim").pivot("item", codes_of(pairs, "item")).agg(F.max(F.lit(1))).fillna(0)


def _itemsets(w: Workspace) -> baskets.Itemsets:
    if "_itemsets" not in w.__dict__:
        w.__dict__["_itemsets"] = baskets.frequent_itemsets(_pairs(w))
    return w.__dict__["_itemsets"]


@query("frequent_itemsets", oracle.baskets(CODE, f"SELECT items, freq, {rnd('support', 6)} AS support FROM named", **MASKS))
def frequent_itemsets(w: Workspace) -> DataFrame:
    found = baskets.frequent_itemsets(_pairs(w)).table
    return settled(found, {"support": 6}).withColumn("items", F.array_join("items", ", "))


@query(
    "frequent_itemsets_parts",
    oracle.baskets(
        PART,
        f"""SELECT items, freq, {rnd('freq / (SELECT n FROM total)', 6)} AS support FROM (
            SELECT item AS items, count(*) AS freq FROM pairs GROUP BY 1
            UNION ALL SELECT a.item || ', ' || b.item, count(*) FROM pairs a JOIN pairs b ON a.claim = b.claim AND a.item < b.item GROUP BY 1
            UNION ALL SELECT a.item || ', ' || b.item || ', ' || c.item, count(*) FROM pairs a JOIN pairs b ON a.claim = b.claim
              AND a.item < b.item JOIN pairs c ON c.claim = b.claim AND b.item < c.item GROUP BY 1)
            WHERE freq / (SELECT n FROM total) >= 0.001""",
    ),
)
def frequent_itemsets_parts(w: Workspace) -> DataFrame:
    """Itemsets of full part names, at support 0.001; no three names reach it together."""
    found = baskets.frequent_itemsets(_pairs(w, PART), 0.001).table
    return settled(found, {"support": 6}).withColumn("items", F.array_join("items", ", "))


@query("association_rules", oracle.baskets(CODE, f"SELECT antecedents, consequents, {rnd('support', 6)} AS support, {rnd('confidence', 6)} AS confidence FROM splits", **MASKS))
def association_rules(w: Workspace) -> DataFrame:
    rules = baskets.export_rules(baskets.association_rules(_itemsets(w).table, min_lift=None))
    return settled(rules, {"support": 6, "confidence": 6}).select("antecedents", "consequents", "support", "confidence")


_RULE_COLUMNS = f"""antecedents, consequents, {rnd('antecedent_support', 6)} AS antecedent_support,
    {rnd('consequent_support', 6)} AS consequent_support, {rnd('support', 6)} AS support, {rnd('confidence', 6)} AS confidence,
    {rnd('lift', 6)} AS lift, {rnd('leverage', 6)} AS leverage, {rnd('conviction', 6)} AS conviction,
    {rnd('CASE WHEN worst = 0 THEN 0 ELSE leverage / worst END', 6)} AS zhangs_metric"""
_RULE_PLACES = {m: 6 for m in baskets.METRICS}


@query("rule_metrics", oracle.baskets(CODE, f"SELECT {_RULE_COLUMNS} FROM rules", **MASKS))
def rule_metrics(w: Workspace) -> DataFrame:
    rules = baskets.association_rules(_itemsets(w).table, min_lift=None)
    return settled(baskets.export_rules(rules), _RULE_PLACES)


@query("rule_filter_sort", oracle.baskets(CODE, f"SELECT {_RULE_COLUMNS} FROM rules WHERE lift >= 1 ORDER BY lift DESC", **MASKS))
def rule_filter_sort(w: Workspace) -> DataFrame:
    rules = baskets.sort_rules(baskets.association_rules(_itemsets(w).table))
    return settled(baskets.export_rules(rules), _RULE_PLACES)


@query(
    "rules_summary",
    oracle.baskets(
        CODE,
        f"""SELECT count(*) AS num_rules, {rnd('avg(confidence)', 4)} AS avg_confidence, {rnd('avg(lift)', 4)} AS avg_lift,
            {rnd('avg(support)', 4)} AS avg_support, {rnd('max(lift)', 4)} AS max_lift,
            (SELECT count(*) FROM sets) AS num_frequent_itemsets FROM rules WHERE lift >= 1""",
        **MASKS,
    ),
)
def rules_summary(w: Workspace) -> DataFrame:
    found = _itemsets(w).table
    return baskets.rules_summary(found, baskets.association_rules(found))


@query(
    "itemset_topn",
    oracle.baskets(CODE, "SELECT items, freq FROM named ORDER BY freq DESC, items LIMIT 10", **MASKS),
)
def itemset_topn(w: Workspace) -> DataFrame:
    named = baskets.export_itemsets(_itemsets(w).table).select(F.col("itemsets").alias("items"), "freq")
    return named.orderBy(F.desc("freq"), "items").limit(10)


@query(
    "export_itemsets",
    oracle.baskets(CODE, f"SELECT items AS itemsets, freq, {rnd('support', 6)} AS support FROM named", **MASKS),
)
def export_itemsets(w: Workspace) -> DataFrame:
    path = f"{w.scratch()}/itemsets"
    files.write_csv(settled(baskets.export_itemsets(_itemsets(w).table), {"support": 6}), path)
    return w.spark.read.schema("itemsets string, freq long, support double").csv(path, header=True, escape='"')


# --- similar claims --------------------------------------------------------------------------------------


@query(
    "interaction_table",
    claims(
        f"""SELECT CLAIMNO AS claim_id, NUM_PART_CODE AS part, {rnd('sum(TOTAL_AMOUNT)', 2)} AS amount
            FROM capped GROUP BY ALL"""
    ),
)
def interaction_table(w: Workspace) -> DataFrame:
    return settled(recommend.interaction_table(w.rows(CODE), CODE, weight=merge.FANOUT), {"amount": 2})


@query(
    "standardise_parts",
    claims(
        f"""SELECT claim_id, part, {rnd('(amount - m) / s', 6)} AS z FROM cells JOIN (SELECT part, sum(amount) / any_value(n) AS m,
            sqrt(sum(amount * amount) / any_value(n) - (sum(amount) / any_value(n)) ** 2) AS s
            FROM cells, (SELECT count(DISTINCT claim_id) AS n FROM cells) GROUP BY part) USING (part)""",
        cells="SELECT CLAIMNO AS claim_id, NUM_PART_CODE AS part, sum(TOTAL_AMOUNT) AS amount FROM capped GROUP BY ALL",
    ),
)
def standardise_parts(w: Workspace) -> DataFrame:
    inter = recommend.interaction_table(w.rows(CODE, LABEL), CODE, weight=merge.FANOUT)  # with what the features read
    return settled(recommend.standardise_parts(inter, w.features.count()), {"z": 6})


@query("svd_fit", "SELECT CAST(unnest(range(0, 10)) AS INT) AS component, TRUE AS unit, TRUE AS orthogonal")
def svd_fit(w: Workspace) -> DataFrame:
    """Inner products of the directions that come out: each of length one, at right angles to the others."""
    rank = w.svd.rank
    products = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), (F.col(f"v{i}") * F.col(f"v{j}")).alias("x")) for i in range(rank) for j in range(rank)])
    sums = w.svd.components.select(F.explode(products).alias("p")).groupBy("p.i", "p.j").agg(F.sum("p.x").alias("x"))
    far = F.max(F.when(F.col("i") != F.col("j"), F.abs("x")).otherwise(F.lit(0.0))) < 1e-9
    near = F.max(F.when(F.col("i") == F.col("j"), F.abs(F.col("x") - 1)).otherwise(F.lit(0.0))) < 1e-9
    return sums.groupBy(F.col("i").alias("component")).agg(near.alias("unit"), far.alias("orthogonal"))


@query("svd_project", claims("SELECT CLAIMNO AS claim_id, CAST(10 AS INT) AS dimensions, TRUE AS finite FROM capped GROUP BY CLAIMNO"))
def svd_project(w: Workspace) -> DataFrame:
    vec = F.col("vec")
    finite = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x))
    return recommend.svd_project(w.interactions, w.svd).select("claim_id", F.size(vec).alias("dimensions"), finite.alias("finite"))


@query("explained_variance", "SELECT CAST(unnest(range(0, 10)) AS INT) AS component, TRUE AS falling")
def explained_variance(w: Workspace) -> DataFrame:
    """Shares of the directions: none below the next, all of them at most the whole."""
    shares = [*w.svd.explained, 0.0]
    whole = sum(shares) <= 1 + 1e-9
    rows = [(i, whole and shares[i] >= shares[i + 1] >= 0) for i in range(len(shares) - 1)]
    return w.spark.createDataFrame(rows, "component int, falling boolean")


@query("claim_similarity", claims("SELECT CLAIMNO AS claim_id, CAST(5 AS BIGINT) AS pairs, TRUE AS agrees FROM capped GROUP BY CLAIMNO"))
def claim_similarity(w: Workspace) -> DataFrame:
    """Cosine of every claim and its neighbours, computed from the coordinates, against the scores of the search."""
    both = recommend.pair_similarity(w.latent, w.edges.select("claim_id", "other_id", F.col("similarity_score").alias("found")))
    close = F.max(F.abs(F.col("found") - F.col("similarity_score"))) < 2e-4
    return both.groupBy("claim_id").agg(F.count(F.lit(1)).alias("pairs"), close.alias("agrees"))


@query("recommend_topn", claims("SELECT CLAIMNO AS claim_id, CAST(5 AS BIGINT) AS neighbours, TRUE AS ranked FROM capped GROUP BY CLAIMNO"))
def recommend_topn(w: Workspace) -> DataFrame:
    """Every claim has five other claims as neighbours, nearest first."""
    rows = w.edges.groupBy("claim_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "similarity_score", "other_id"))).alias("top"), F.count_distinct("other_id").alias("neighbours")
    )
    falling = F.aggregate("top", F.struct(F.lit(2.0).alias("last"), F.lit(True).alias("ok")), lambda s, x: F.struct(x["similarity_score"].alias("last"), (s["ok"] & (x["similarity_score"] <= s["last"])).alias("ok")))["ok"]
    own = F.exists("top", lambda x: x["other_id"] == F.col("claim_id"))
    return rows.select("claim_id", "neighbours", (falling & ~own).alias("ranked"))


@query("recommend_batch", claims(
    """SELECT CAST(o_orderkey AS VARCHAR) AS claim_id, CASE WHEN c.CLAIMNO IS NULL THEN 'unknown claim' ELSE 'ok' END AS status,
       CAST(CASE WHEN c.CLAIMNO IS NULL THEN 0 ELSE 5 END AS BIGINT) AS neighbours
       FROM orders LEFT JOIN (SELECT DISTINCT CLAIMNO FROM capped) c ON c.CLAIMNO = CAST(o_orderkey AS VARCHAR)"""
))
def recommend_batch(w: Workspace) -> DataFrame:
    """Requests for every order; orders without claim rows are unknown."""
    requests = w.table("orders").select(F.col("o_orderkey").cast("string").alias("claim_id"))
    found = recommend.recommend_batch(requests, w.edges)
    return found.groupBy("claim_id", "status").agg(F.count("other_id").alias("neighbours"))


@query("recommender_eval", claims(
    """SELECT count(DISTINCT CLAIMNO) AS num_claims, count(DISTINCT TXT_PARTS_NAME) AS num_parts, TRUE AS sound FROM capped"""
))
def recommender_eval(w: Workspace) -> DataFrame:
    sound = F.col("svd_explained_variance_pct").between(0, 100) & F.col("coverage_pct").between(0, 100) & F.col("avg_top_n_similarity").between(-1, 1)
    return recommend.evaluate_recommender(w.edges, w.svd).select("num_claims", "num_parts", sound.alias("sound"))


@query(
    "claim_pair_similarity",
    claims("SELECT CLAIMNO AS claim_id, CAST(5 AS BIGINT) AS neighbours, TRUE AS agrees FROM capped GROUP BY CLAIMNO"),
)
def claim_pair_similarity(w: Workspace) -> DataFrame:
    """Nearest claims by the plain amounts per part code, without projection."""
    inter = recommend.interaction_table(w.rows(CODE), CODE, weight=merge.FANOUT)
    names = codes_of(inter, "part")
    wide = inter.groupBy("claim_id").pivot("part", names).agg(F.sum("amount"))
    codes = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in names])
    vectors = checkpointed(wide.select("claim_id", codes.alias("vec")))
    edges = recommend.top_similar(vectors)
    both = recommend.pair_similarity(vectors, edges.select("claim_id", "other_id", F.col("similarity_score").alias("found")))
    close = F.max(F.abs(F.col("found") - F.col("similarity_score"))) < 2e-4
    return both.groupBy("claim_id").agg(F.count(F.lit(1)).alias("neighbours"), close.alias("agrees"))


@query(
    "embedding_topk",
    f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), p AS (
          SELECT a.vec_id AS claim_id, b.vec_id AS other_id, round(list_cosine_similarity(a.v, b.v), 9) AS c
          FROM e a JOIN e b ON a.vec_id <> b.vec_id)
        SELECT claim_id, other_id, {rnd('c', 4)} AS similarity_score, r AS rank FROM (SELECT *, row_number() OVER
          (PARTITION BY claim_id ORDER BY c DESC, other_id) AS r FROM p) WHERE r <= 5""",
)
def embedding_topk(w: Workspace) -> DataFrame:
    vectors = w.table("embeddings").select(
        F.col("vec_id").alias("claim_id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    edges = recommend.top_similar(vectors).drop("score")
    return edges.withColumn("rank", F.col("rank").cast("long"))


@query("chart_similarity_heatmap", "SELECT CAST(225 AS BIGINT) AS tiles, TRUE AS diagonal, TRUE AS bounded")
def chart_similarity_heatmap(w: Workspace) -> DataFrame:
    tiles = chartdata.similarity_heatmap(w.latent)
    one = F.col("row_label") != F.col("column_label")
    return tiles.agg(
        F.count(F.lit(1)).alias("tiles"),
        (F.min(F.when(one, F.lit(1.0)).otherwise(F.col("similarity_score"))) > 1 - 1e-9).alias("diagonal"),
        (F.max(F.abs("similarity_score")) <= 1 + 1e-9).alias("bounded"),
    )


# --- splits, folds, scaling ------------------------------------------------------------------------------


@query("sample_n", claims("SELECT 1000 AS n, 1000 AS found"))
def sample_n(w: Workspace) -> DataFrame:
    """A sample of 1,000 survey rows, all of them rows of the table."""
    sample = merge.sample_n(w.surveyor, 1000)
    found = sample.join(w.surveyor.distinct(), w.surveyor.columns, "left_semi")
    return found.agg(F.lit(1000).alias("n"), F.count(F.lit(1)).cast("int").alias("found"))


_SPLIT = """SELECT CLAIMNO, IS_FRAUD, CASE WHEN row_number() OVER (PARTITION BY IS_FRAUD ORDER BY md5(CLAIMNO)) <=
            round(0.2 * count(*) OVER (PARTITION BY IS_FRAUD)) THEN 'test' ELSE 'train' END AS split FROM base"""


@query("stratified_split", claims(_SPLIT))
def stratified_split(w: Workspace) -> DataFrame:
    return sampling.stratified_split(w.features.select(CLAIM, LABEL), CLAIM)


@query(
    "repeated_stratified_folds",
    claims(
        """SELECT CLAIMNO, IS_FRAUD, repeat, CAST((row_number() OVER (PARTITION BY IS_FRAUD, repeat
           ORDER BY md5(repeat || '|' || CLAIMNO)) - 1) % 5 AS INT) AS fold
           FROM base, (SELECT CAST(unnest(range(0, 3)) AS INT) AS repeat)"""
    ),
)
def repeated_stratified_folds(w: Workspace) -> DataFrame:
    return sampling.repeated_folds(w.features.select(CLAIM, LABEL), CLAIM)


@query(
    "standard_scaler",
    claims(
        "SELECT CLAIMNO, "
        + ", ".join(
            rnd(f"({c} - (SELECT avg({c}) FROM features)) / (SELECT stddev_pop({c}) FROM features)", 6) + f" AS {c}"
            for c in FEATURES
        )
        + " FROM features"
    ),
)
def standard_scaler(w: Workspace) -> DataFrame:
    scaled = sampling.apply_scaler(w.features, sampling.fit_scaler(w.features, FEATURES))
    return settled(scaled.select(CLAIM, *FEATURES), {c: 6 for c in FEATURES})


@query("shuffle_rows", claims("SELECT CLAIMNO, IS_FRAUD FROM base ORDER BY md5('42|' || CLAIMNO)"))
def shuffle_rows(w: Workspace) -> DataFrame:
    return sampling.shuffle_rows(w.features.select(CLAIM, LABEL), CLAIM)


@query(
    "class_weights",
    claims(f"SELECT IS_FRAUD, count(*) AS n, {rnd('(SELECT count(*) FROM base) / (2.0 * count(*))', 6)} AS weight FROM base GROUP BY 1"),
)
def class_weights(w: Workspace) -> DataFrame:
    return settled(sampling.class_weights(w.features), {"weight": 6})


# --- evaluation ------------------------------------------------------------------------------------------


def scored_sql(select: str, **parts: str) -> str:
    named = {"q": SCORED, **parts}
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in named.items()) + " " + select


CONFUSION = """SELECT count(*) FILTER (truth = 0 AND pred = 0) AS tn, count(*) FILTER (truth = 0 AND pred = 1) AS fp,
               count(*) FILTER (truth = 1 AND pred = 0) AS fn, count(*) FILTER (truth = 1 AND pred = 1) AS tp FROM q"""
_DIV = "coalesce({0} / nullif(CAST({1} AS DOUBLE), 0), 0)"
CURVE = """SELECT score AS threshold, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS p,
           sum(neg) OVER () AS n FROM (SELECT score, sum(truth) AS pos, sum(1 - truth) AS neg FROM q GROUP BY 1)
           WINDOW w AS (ORDER BY score DESC)"""


@query("confusion_matrix", scored_sql(CONFUSION))
def confusion_matrix(w: Workspace) -> DataFrame:
    return evaluate.confusion(w.scored_orders, "truth", "pred")


_BINARY = f"""{_DIV.format('(tp + tn)', '(tn + fp + fn + tp)')} AS accuracy, {_DIV.format('tp', '(tp + fp)')} AS "precision",
    {_DIV.format('tp', '(tp + fn)')} AS recall, {_DIV.format('2 * tp', '(2 * tp + fp + fn)')} AS f1_score"""


@query("binary_metrics", scored_sql(f"SELECT {_BINARY} FROM c", c=CONFUSION))
def binary_metrics(w: Workspace) -> DataFrame:
    return evaluate.binary_metrics(w.scored_orders, "truth", "pred")


_REPORT = {
    "Normal": (_DIV.format("tn", "(tn + fn)"), _DIV.format("tn", "(tn + fp)"), _DIV.format("2 * tn", "(2 * tn + fp + fn)"), "tn + fp"),
    "Fraud": (_DIV.format("tp", "(tp + fp)"), _DIV.format("tp", "(tp + fn)"), _DIV.format("2 * tp", "(2 * tp + fp + fn)"), "tp + fn"),
}
_CLASS_ROWS = " UNION ALL ".join(
    f"""SELECT '{name}' AS label, {p} AS "precision", {r} AS recall, {f} AS f1_score, {s} AS support FROM c"""
    for name, (p, r, f, s) in _REPORT.items()
)
_ALL = ("precision", "recall", "f1_score")


@query(
    "classification_report",
    scored_sql(
        f"""SELECT label, {", ".join(f'{rnd(f"{chr(34)}{m}{chr(34)}", 8)} AS "{m}"' for m in _ALL)}, support FROM (
            SELECT * FROM k UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT (tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE) AS a,
              tn + fp + fn + tp AS n FROM c)
            UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM k
            UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
              sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM k)""",
        c=CONFUSION,
        k=_CLASS_ROWS,
    ),
)
def classification_report(w: Workspace) -> DataFrame:
    return settled(evaluate.classification_report(w.scored_orders, "truth", "pred"), {m: 8 for m in _ALL})


@query(
    "roc_auc",
    scored_sql(f"SELECT {rnd('sum(neg * (cp - pos / 2.0)) / (max(p) * max(n))', 8)} AS roc_auc FROM c", c=CURVE),
)
def roc_auc(w: Workspace) -> DataFrame:
    return settled(evaluate.roc_auc(w.scored_orders, "truth", "score"), {"roc_auc": 8})


@query("roc_curve", scored_sql(f"SELECT threshold, {rnd('cn / n', 8)} AS fpr, {rnd('cp / p', 8)} AS tpr FROM c", c=CURVE))
def roc_curve(w: Workspace) -> DataFrame:
    return settled(evaluate.roc_curve(w.scored_orders, "truth", "score"), {"fpr": 8, "tpr": 8})


@query(
    "pr_curve",
    scored_sql(
        f"""SELECT threshold, {rnd('cp / (cp + cn)', 8)} AS "precision", {rnd('cp / p', 8)} AS recall,
            {rnd('p / (p + n)', 8)} AS baseline FROM c""",
        c=CURVE,
    ),
)
def pr_curve(w: Workspace) -> DataFrame:
    curve = evaluate.pr_curve(w.scored_orders, "truth", "score")
    return settled(curve, {"precision": 8, "recall": 8, "baseline": 8})


@query(
    "average_precision",
    scored_sql(f"SELECT {rnd('sum(pos / p * (cp / (cp + cn)))', 8)} AS average_precision FROM c", c=CURVE),
)
def average_precision(w: Workspace) -> DataFrame:
    return settled(evaluate.average_precision(w.scored_orders, "truth", "score"), {"average_precision": 8})


_STEPS = ", ".join(f"{t!r}::DOUBLE" for t in evaluate.THRESHOLDS)


@query(
    "threshold_sweep",
    scored_sql(
        f"""SELECT threshold, tp, fp, fn, {_DIV.format('2 * tp', '(2 * tp + fp + fn)')} AS f1_score FROM (
            SELECT t AS threshold, count(*) FILTER (score >= t AND truth = 1) AS tp, count(*) FILTER (score >= t AND truth = 0) AS fp,
            count(*) FILTER (score < t AND truth = 1) AS fn FROM q, (SELECT unnest([{_STEPS}]) AS t) GROUP BY t)"""
    ),
)
def threshold_sweep(w: Workspace) -> DataFrame:
    return evaluate.threshold_sweep(w.scored_orders, "truth", "score")


def _embedding_points(w: Workspace) -> DataFrame:
    return w.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")


@query(
    "silhouette",
    f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS s, count(*) AS n
              FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY ALL),
        m AS (SELECT vec_id, max(s / n) FILTER (label = other) AS a, min(s / n) FILTER (label <> other) AS b FROM d GROUP BY 1)
        SELECT {rnd('avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)', 6)} AS silhouette,
        (SELECT count(DISTINCT label) FROM e) AS labels FROM m""",
)
def silhouette(w: Workspace) -> DataFrame:
    return settled(evaluate.silhouette(_embedding_points(w), "vec_id", "x", "label"), {"silhouette": 6})


@query(
    "calinski_harabasz",
    f"""WITH x AS (SELECT label, unnest(range(1, 65)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
        c AS (SELECT label, i, count(*) AS n, avg(v) AS m, sum(v) AS s, var_pop(v) * count(*) AS w FROM x GROUP BY ALL),
        g AS (SELECT i, avg(v) AS m FROM x GROUP BY i)
        SELECT {rnd('b / (k - 1) / (w / (n - k))', 4)} AS calinski_harabasz, k AS labels FROM (
          SELECT sum(c.n * (c.m - g.m) ** 2) AS b, sum(w) AS w, count(DISTINCT label) AS k,
          (SELECT count(*) FROM embeddings) AS n FROM c JOIN g USING (i))""",
)
def calinski_harabasz(w: Workspace) -> DataFrame:
    points = _embedding_points(w)
    result = evaluate.calinski_harabasz(points, [F.col("x")[i] for i in range(64)], "label")
    return settled(result, {"calinski_harabasz": 4})


_LOW = CONFUSION.replace("pred", "pred_low")
_METRICS = ("accuracy", "precision", "recall", "f1_score")
_PCT = """SELECT '{m}' AS metric, printf('%.2f', a."{m}" * 100) || '%' AS strict, printf('%.2f', b."{m}" * 100) || '%' AS loose
          FROM a, b"""


@query(
    "model_comparison",
    scored_sql(
        " UNION ALL ".join(_PCT.format(m=m) for m in _METRICS),
        c=CONFUSION,
        d=_LOW,
        a=f"SELECT {_BINARY} FROM c",
        b=f"SELECT {_BINARY} FROM d",
    ),
)
def model_comparison(w: Workspace) -> DataFrame:
    def one(name: str, pred: str) -> DataFrame:
        row = evaluate.binary_metrics(w.scored_orders, "truth", pred)
        return row.unpivot([], list(_METRICS), "metric", "value").withColumn("section", F.lit(name))

    table = evaluate.model_comparison(one("strict", "pred").unionByName(one("loose", "pred_low")), ["strict", "loose"])
    return table.select("metric", *[text.percent_text(F.col(c)).alias(c) for c in ("strict", "loose")])


# --- fraud models ----------------------------------------------------------------------------------------


@query("iforest_fit", "SELECT CAST(unnest(range(0, 200)) AS INT) AS tree, TRUE AS binary, TRUE AS bounded")
def iforest_fit(w: Workspace) -> DataFrame:
    """Every tree: two children to each split, and no more leaves than rows drawn for it."""
    nodes = w.spark.createDataFrame(w.anomaly.nodes, iforest.NODES)
    leaves = F.count_if(F.col("feature") < 0)
    return nodes.groupBy("tree").agg((F.count(F.lit(1)) == 2 * leaves - 1).alias("binary"), (leaves <= w.anomaly.sample).alias("bounded"))


@query("iforest_score", claims("SELECT CLAIMNO, IS_FRAUD AS truth, TRUE AS sound FROM base"))
def iforest_score(w: Workspace) -> DataFrame:
    scored = iforest.score(w.features, w.anomaly)
    low = F.col("anomaly_score") < 0
    sound = (low == (F.col("anomaly_label") == -1)) & (low == (F.col("is_fraud") == 1)) & F.col("anomaly_score").between(-1, 1)
    return scored.select(CLAIM, TRUTH, sound.alias("sound"))


def _as_metrics(w: Workspace, section: str, values: dict) -> DataFrame:
    return training.Run({section: values}).table(w.spark)


@query("iforest_evaluate", claims(
    f"""SELECT (SELECT count(*) FROM ({_SPLIT}) WHERE split = 'test') AS test_claims, (SELECT count(*) FROM base) AS all_claims,
        TRUE AS flagged_near_share, TRUE AS complete"""
))
def iforest_evaluate(w: Workspace) -> DataFrame:
    """Unsupervised measures of the test claims and of all claims."""
    test = training.isolation_metrics(w.anomaly_scored, w.anomaly.scaler, CLAIM)
    whole = training.isolation_metrics(checkpointed(iforest.score(w.features, w.anomaly)), w.anomaly.scaler, CLAIM)
    near = all(5 <= m["fraud_rate_pct"] <= 16 for m in (test, whole))
    complete = all(m.get(c) is not None for m in (test, whole) for c in ("silhouette", "calinski_harabasz", "avg_anomaly_score", "avg_fraud_amount"))
    schema = "test_claims long, all_claims long, flagged_near_share boolean, complete boolean"
    return w.spark.createDataFrame([(test["total_claims"], whole["total_claims"], near, complete)], schema)


@query("rf_fit", "SELECT CAST(300 AS BIGINT) AS trees, TRUE AS binary, TRUE AS depth_kept, TRUE AS splits_kept, TRUE AS threshold_found")
def rf_fit(w: Workspace) -> DataFrame:
    """Shape of the published forest: two children to a split, no node below depth 12, no split of fewer than five rows."""
    leaf, params = F.col("feature") < 0, w.forest.params
    trees = F.count_distinct("tree")
    return w.forest.nodes.agg(
        trees.alias("trees"),
        (F.count(F.lit(1)) == 2 * F.count_if(leaf) - trees).alias("binary"),
        (F.max("depth") <= params.depth).alias("depth_kept"),
        (F.min(F.when(~leaf, F.col("n"))) >= params.min_split).alias("splits_kept"),
    ).withColumn("threshold_found", F.lit(0.1 <= w.forest.threshold <= 0.9))


@query("grid_search", """SELECT CAST(t AS INT) AS trees, CAST(d AS INT) AS depth, CAST(m AS INT) AS min_split, TRUE AS useful
    FROM (VALUES (200), (300), (500)) a(t), (VALUES (8), (12), (16), (NULL)) b(d), (VALUES (2), (5), (10)) c(m)""")
def grid_search(w: Workspace) -> DataFrame:
    """All points of the published grid, each over 15 folds; useful: a mean F1 above one half."""
    found = forest.grid_table(w.spark, forest.grid_search(w.folds, QUERY_GRID))
    return found.select("trees", "depth", "min_split", F.col("mean_f1").between(0.5, 1).alias("useful"))


@query("cross_validate", """SELECT unnest(['accuracy', 'precision', 'recall', 'f1_score', 'roc_auc']) AS metric, CAST(15 AS BIGINT) AS folds, TRUE AS useful""")
def cross_validate(w: Workspace) -> DataFrame:
    found = forest.cv_summary(w.cv_table)
    return found.select("metric", "folds", (F.col("mean").between(0.5, 1) & F.col("std").between(0, 0.2)).alias("useful"))


@query("rf_predict", claims("SELECT CLAIMNO, IS_FRAUD AS truth, TRUE AS sound FROM base"))
def rf_predict(w: Workspace) -> DataFrame:
    scored, p = forest.score(w.features, w.forest), F.col("fraud_probability")
    sound = p.between(0, 1) & ((F.col("is_fraud") == 1) == (p >= w.forest.threshold))
    return scored.select(CLAIM, TRUTH, sound.alias("sound"))


_PARTS = "section, metric, value IS NOT NULL AS known"


@query(
    "rf_evaluate",
    """SELECT section, metric, TRUE AS known FROM (VALUES ('forest'), ('forest_all'), ('iforest'), ('iforest_all')) s(section),
       (VALUES ('accuracy'), ('precision'), ('recall'), ('f1_score')) m(metric) UNION ALL
       SELECT unnest(['forest_auc', 'forest_all_auc']), 'roc_auc', TRUE UNION ALL
       SELECT 'folds', unnest(['accuracy', 'precision', 'recall', 'f1_score', 'roc_auc']), TRUE UNION ALL
       SELECT 'importances', """
    + f"unnest([{', '.join(repr(f) for f in FEATURES)}]), TRUE UNION ALL "
    + """SELECT 'report', unnest(['Normal', 'Fraud', 'accuracy', 'macro avg', 'weighted avg']), TRUE""",
)
def rf_evaluate(w: Workspace) -> DataFrame:
    """Both models on the test claims and on all claims, fold means, importances and the classification report."""
    everything = checkpointed(forest.score(w.features, w.forest))
    flat = checkpointed(iforest.score(w.features, w.anomaly))
    table = files.metrics_table(
        {
            "forest": evaluate.binary_metrics(w.forest_scored, TRUTH, "is_fraud"),
            "forest_auc": evaluate.roc_auc(w.forest_scored, TRUTH, "fraud_probability"),
            "forest_all": evaluate.binary_metrics(everything, TRUTH, "is_fraud"),
            "forest_all_auc": evaluate.roc_auc(everything, TRUTH, "fraud_probability"),
            "iforest": evaluate.binary_metrics(w.anomaly_scored, TRUTH, "is_fraud"),
            "iforest_all": evaluate.binary_metrics(flat, TRUTH, "is_fraud"),
        }
    )
    parts = forest.evaluation(w.forest, w.forest_scored)
    more = {
        "folds": forest.cv_summary(w.cv_table).select("metric", F.col("mean").cast("string").alias("value")),
        "importances": parts["importances"].select(F.col("feature").alias("metric"), F.col("importance").cast("string").alias("value")),
        "report": parts["report"].select(F.col("label").alias("metric"), F.col("f1_score").cast("string").alias("value")),
    }
    for section, rows in more.items():
        table = table.unionByName(rows.withColumn("section", F.lit(section)))
    return table.selectExpr(*_PARTS.split(", "))


@query("feature_importances", f"SELECT unnest([{', '.join(repr(f) for f in FEATURES)}]) AS feature, TRUE AS share")
def feature_importances(w: Workspace) -> DataFrame:
    """Shares: none negative, together one."""
    found = forest.importances(w.spark, w.forest)
    whole = found.agg(F.abs(F.sum("importance") - 1) < 0.001).first()[0]
    return found.select("feature", (F.lit(whole) & F.col("importance").between(0, 1)).alias("share"))


@query("chart_importance_bar", f"SELECT unnest([{', '.join(repr(f) for f in FEATURES)}]) AS feature, unnest([{', '.join(repr(f.replace('_', ' ').title()) for f in FEATURES)}]) AS label, TRUE AS bar")
def chart_importance_bar(w: Workspace) -> DataFrame:
    bars = chartdata.importance_bars(forest.importances(w.spark, w.forest))
    return bars.select("feature", "label", F.col("importance").between(0, 1).alias("bar"))


@query("chart_fold_lines", """SELECT CAST(n AS INT) AS fold_number, m AS metric, TRUE AS point FROM range(1, 16) a(n),
    (VALUES ('Accuracy'), ('Precision'), ('Recall'), ('F1 Score'), ('Roc Auc')) b(m)""")
def chart_fold_lines(w: Workspace) -> DataFrame:
    return chartdata.fold_lines(w.cv_table).select("fold_number", "metric", F.col("value").between(0, 1).alias("point"))


@query("fold_summary", """SELECT unnest(['accuracy', 'precision', 'recall', 'f1_score', 'roc_auc']) AS metric, CAST(15 AS BIGINT) AS n, TRUE AS ordered""")
def fold_summary(w: Workspace) -> DataFrame:
    table = profile.describe_table(w.cv_table, ["value"], ["metric"])
    quartiles = list(profile.QUARTILES)
    steps = ["min", *quartiles, "max"]
    rising = reduce(lambda x, y: x & y, [F.col(a) <= F.col(b) for a, b in zip(steps, steps[1:])])
    return table.select("metric", "n", (rising & F.col("mean").between(F.col("min"), F.col("max"))).alias("ordered"))


def _f1(df: DataFrame) -> float:
    return evaluate.binary_metrics(df, TRUTH, "is_fraud").first()["f1_score"]


@query("select_best_model", "SELECT TRUE AS consistent, TRUE AS useful")
def select_best_model(w: Workspace) -> DataFrame:
    a, b = _f1(w.forest_scored), _f1(w.anomaly_scored)
    consistent = training.select_best_model(a, b) == ("forest" if a >= b else "iforest")
    return w.spark.createDataFrame([(consistent, max(a, b) > 0.5)], "consistent boolean, useful boolean")


@query("fraud_predictions", claims("SELECT CLAIMNO, IS_FRAUD AS truth, TRUE AS decided FROM base"))
def fraud_predictions(w: Workspace) -> DataFrame:
    best = training.select_best_model(_f1(w.forest_scored), _f1(w.anomaly_scored))
    found = forest.score(w.features, w.forest) if best == "forest" else iforest.score(w.features, w.anomaly)
    return found.select(CLAIM, TRUTH, F.col("is_fraud").isin(0, 1).alias("decided"))


@query("score_quotes", f"""SELECT o_orderkey AS quote_id, {rnd('o_totalprice', 2)} AS total_amount, CAST(o_custkey % 5 AS BIGINT) AS part_count,
    {rnd('o_totalprice / greatest(o_custkey % 5, 1)', 4)} AS avg_part_amount, {rnd('ln(1 + o_totalprice)', 6)} AS log_total_amount, TRUE AS decided
    FROM orders""")
def score_quotes(w: Workspace) -> DataFrame:
    scored = lookups.score_quotes(w.quotes, w.anomaly)
    decided = F.col("status") == F.when(F.col("anomaly_score") < 0, "SUSPICIOUS").otherwise("NORMAL")
    kept = scored.select("quote_id", "total_amount", "part_count", "avg_part_amount", "log_total_amount", decided.alias("decided"))
    return settled(kept, {"total_amount": 2, "avg_part_amount": 4, "log_total_amount": 6})


@query("save_model", claims(f"SELECT CLAIMNO, CAST(0 AS DOUBLE) AS difference FROM ({_SPLIT}) WHERE split = 'test'"))
def save_model(w: Workspace) -> DataFrame:
    """Scores of a saved and reloaded isolation forest against the original's."""
    folder = w.scratch()
    models.save_anomaly(w.anomaly, w.spark, folder)
    again = models.load_available(w.spark, folder)[models.ANOMALY]
    first = w.anomaly_scored.select(CLAIM, F.col("anomaly_score").alias("before"))
    second = iforest.score(w.test, again).select(CLAIM, F.col("anomaly_score").alias("after"))
    return first.join(second, CLAIM).select(CLAIM, F.abs(F.col("before") - F.col("after")).alias("difference"))


@query("load_model", matches("SELECT * FROM cos_best"))
def load_model(w: Workspace) -> DataFrame:
    """Cosine matches of a saved and reloaded matcher."""
    folder = w.scratch()
    models.save_matcher(models.Matcher(w.tfidf, w.garage_names), folder)
    again = models.load_matcher(w.spark, folder)
    return matching.match_cosine(w.survey_names, again.garage, again.model)


@query("load_available", "SELECT * FROM (VALUES ('part_matcher', FALSE), ('recommender', TRUE), ('fraud_iforest', FALSE), ('fraud_forest', TRUE)) t(model, available)")
def load_available(w: Workspace) -> DataFrame:
    """Which models are there after saving two of four; the forest comes back with all its parts."""
    w.rows(PART, LABEL)  # one table for the features and the similar claims
    folder = w.scratch()
    models.save_forest(w.forest, w.spark, folder, forest.evaluation(w.forest, w.forest_scored, w.cv_table))
    models.save_recommender(models.Recommender(w.svd, w.edges), folder)
    found = models.load_available(w.spark, folder)
    whole = {models.FOREST: lambda m: set(m.parts) == {"importances", "report", "folds"} and m.nodes.count() == w.forest.nodes.count()}
    names = (models.MATCHER, models.RECOMMENDER, models.ANOMALY, models.FOREST)
    return w.spark.createDataFrame([(n, n in found and whole.get(n, bool)(found[n])) for n in names], "model string, available boolean")


@query(
    "report_summary",
    """SELECT section, metric, TRUE AS known FROM (VALUES ('dataset', 'total_claims'), ('dataset', 'fraud_rate_pct'),
         ('matching', 'survey_parts'), ('matching', 'fuzzy_match_rate'), ('matching', 'cosine_match_rate'), ('matching', 'agreement_rate'),
         ('recommender', 'num_claims'), ('recommender', 'num_parts'), ('recommender', 'svd_explained_variance_pct'),
         ('recommender', 'coverage_pct'), ('recommender', 'avg_top_n_similarity')) a(section, metric)
       UNION ALL SELECT section, metric, TRUE FROM (VALUES ('iforest'), ('forest')) b(section),
         (VALUES ('accuracy'), ('precision'), ('recall'), ('f1_score')) c(metric)
       UNION ALL SELECT 'cross_validation', unnest(['accuracy', 'precision', 'recall', 'f1_score', 'roc_auc']), TRUE""",
)
def report_summary(w: Workspace) -> DataFrame:
    """The closing report: table sizes, matching, similar claims, both fraud models and the folds."""
    w.rows(PART, LABEL)  # one table for the features and the similar claims
    claims_row = w.features.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.round(F.avg(LABEL) * 100, 1).alias("fraud_rate_pct"),
    )
    table = files.metrics_table(
        {
            "dataset": claims_row,
            "matching": matching.match_rates(w.combined),
            "recommender": recommend.evaluate_recommender(w.edges, w.svd),
            "iforest": evaluate.binary_metrics(w.anomaly_scored, TRUTH, "is_fraud"),
            "forest": evaluate.binary_metrics(w.forest_scored, TRUTH, "is_fraud"),
        }
    )
    folds = forest.cv_summary(w.cv_table).select(F.lit("cross_validation").alias("section"), "metric", F.col("mean").cast("string").alias("value"))
    return table.unionByName(folds).selectExpr(*_PARTS.split(", "))
