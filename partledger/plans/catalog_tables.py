"""Queries over the claim tables: files, projections, joins, aggregates, features, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from partledger import schemas
from partledger.config import DEFAULTS, FEATURES
from partledger.functions import numbers, text
from partledger.functions.columns import resolve_column
from partledger.operators import chartdata, features, merge, profile
from partledger.plans.oracle import KEYS, PARTS, claims, clean, rnd
from partledger.plans.registry import query
from partledger.plans.workspace import Workspace
from partledger.sources import files

PART, GARAGE_PART, CLAIM, AMOUNT, CODE, LABEL = (
    DEFAULTS.survey_part,
    DEFAULTS.garage_part,
    DEFAULTS.claim_id,
    DEFAULTS.amount,
    DEFAULTS.part_code,
    DEFAULTS.label,
)
CODES = [f"P{i:03d}" for i in range(1, 9)]  # only for the SQL texts: a code beyond these shows up as a difference
SYNONYMS = {"wdgt": "widget", "gr": "gear", **text.PART_SYNONYMS}

FEATURE_PLACES = {
    "total_amount": 2,
    "avg_part_amount": 4,
    "max_part_amount": 4,
    "min_part_amount": 4,
    "std_part_amount": 2,
    "amount_range": 4,
    "coeff_variation": 6,
    "log_total_amount": 6,
}
FEATURE_SQL = ", ".join(
    ["CLAIMNO", "part_count", *[f"{rnd(c, p)} AS {c}" for c, p in FEATURE_PLACES.items()], "IS_FRAUD"]
)


def settled(df: DataFrame, places: dict[str, int]) -> DataFrame:
    """Float columns rounded for comparison across engines."""
    return df.withColumns({c: numbers.rounded(F.col(c), p) for c, p in places.items()})


# --- files -----------------------------------------------------------------------------------------------


@query("read_csv", claims("SELECT * FROM garage_raw"))
def read_csv(w: Workspace) -> DataFrame:
    path = f"{w.scratch()}/garage"
    files.write_csv(w.garage_raw, path)
    return files.read_csv(w.spark, path, schemas.GARAGE, "Garage").withColumn("PARTNO", F.col("PARTNO").cast("long"))


@query(
    "read_claims",
    claims(
        """SELECT 'surveyor' AS table_name, count(*) AS row_count, count(DISTINCT TXT_PARTS_NAME) AS names FROM s
           UNION ALL SELECT 'garage', count(*), count(DISTINCT PARTDESCRIPTION) FROM g
           UNION ALL SELECT 'primary', count(*), count(DISTINCT PART_CATEGORY) FROM primary_parts"""
    ),
)
def read_claims(w: Workspace) -> DataFrame:
    folder = w.scratch()
    files.write_csv(w.surveyor_raw, f"{folder}/{files.SURVEYOR_FILE}")
    files.write_csv(w.garage_raw, f"{folder}/{files.GARAGE_FILE}")
    files.write_csv(w.primary_parts, f"{folder}/{files.PRIMARY_PARTS_FILE}")
    survey, garage, primary = files.read_claims(w.spark, folder)

    def line(name: str, df: DataFrame, column: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(column).alias("names")).select(
            F.lit(name).alias("table_name"), "row_count", "names"
        )

    return (
        line("surveyor", survey, PART)
        .unionByName(line("garage", garage, GARAGE_PART))
        .unionByName(line("primary", primary, "PART_CATEGORY"))
    )


@query("write_csv", claims("SELECT name FROM survey_names"))
def write_csv(w: Workspace) -> DataFrame:
    path = f"{w.scratch()}/names"
    files.write_csv(w.survey_names, path)
    return w.spark.read.csv(path, header=True, escape='"')


@query(
    "write_metrics_json",
    claims(
        """SELECT 'data' AS section, 'surveyor_rows' AS metric, CAST((SELECT count(*) FROM s) AS VARCHAR) AS value
           UNION ALL SELECT 'data', 'garage_rows', CAST((SELECT count(*) FROM g) AS VARCHAR)
           UNION ALL SELECT 'features', 'claims', CAST((SELECT count(*) FROM features) AS VARCHAR)
           UNION ALL SELECT 'features', 'fraud', CAST((SELECT sum(IS_FRAUD) FROM features) AS VARCHAR)"""
    ),
)
def write_metrics_json(w: Workspace) -> DataFrame:
    data = w.surveyor.agg(F.count(F.lit(1)).alias("surveyor_rows")).withColumn(
        "garage_rows", w.garage.select(F.count(F.lit(1))).scalar()
    )
    claim = w.features.agg(F.count(F.lit(1)).alias("claims"), F.sum(LABEL).alias("fraud"))
    path = f"{w.scratch()}/metrics"
    files.write_metrics(files.metrics_table({"data": data, "features": claim}), path)
    return w.spark.read.schema("section string, metric string, value string").json(path)


# --- projections, filters, scalar functions --------------------------------------------------------------


@query("clean_text", f"SELECT doc_id, {clean('text')} AS cleaned FROM documents")
def clean_text(w: Workspace) -> DataFrame:
    return w.table("documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(
    "normalise_keys",
    r"SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS stripped, CAST(doc_id AS VARCHAR) AS key FROM documents",
)
def normalise_keys(w: Workspace) -> DataFrame:
    return w.table("documents").select(
        "doc_id", text.normalise_key(F.col("text")).alias("stripped"), text.normalise_key(F.col("doc_id")).alias("key")
    )


@query(
    "project_rename",
    claims("SELECT CLAIMNO AS claim, PARTDESCRIPTION AS garage_part, TOTAL_AMOUNT AS amount FROM garage_raw"),
)
def project_rename(w: Workspace) -> DataFrame:
    return w.garage_raw.select(CLAIM, GARAGE_PART, AMOUNT).withColumnsRenamed(
        {CLAIM: "claim", GARAGE_PART: "garage_part", AMOUNT: "amount"}
    )


@query("drop_columns", claims("SELECT * EXCLUDE (IS_FRAUD) FROM surveyor_raw"))
def drop_columns(w: Workspace) -> DataFrame:
    return w.surveyor_raw.drop(LABEL, "NOT_A_COLUMN")


@query(
    "resolve_column",
    claims("SELECT CLAIMNO, TXT_PARTS_NAME AS part, TOTAL_AMOUNT AS amount FROM surveyor_raw"),
)
def resolve(w: Workspace) -> DataFrame:
    renamed = w.surveyor_raw.withColumnsRenamed({PART: "PART_X", AMOUNT: "CLAIM_AMOUNT"})
    part = resolve_column(renamed, "PART", exclude="CODE", preferred=[PART])
    amount = resolve_column(renamed, "AMOUNT", preferred=[AMOUNT])
    return renamed.select(CLAIM, F.col(part).alias("part"), F.col(amount).alias("amount"))


@query("filter_amount_cap", claims(f"SELECT {KEYS}, TXT_PARTS_NAME, TOTAL_AMOUNT, PARTNO FROM capped"))
def filter_amount_cap(w: Workspace) -> DataFrame:
    capped = w.merged_within_cap()
    return capped.select(*DEFAULTS.merge_keys, PART, AMOUNT, "PARTNO")


@query(
    "filter_value_cap",
    """SELECT event_id, event_type, value FROM events WHERE value <=
       (SELECT 0.5 * quantile_cont(value, 0.99) FROM events)""",
)
def filter_value_cap(w: Workspace) -> DataFrame:
    from partledger.operators.ordering import exact_quantile

    events = w.table("events")
    return events.where(F.col("value") <= 0.5 * exact_quantile(events, "value", 0.99)).select(
        "event_id", "event_type", "value"
    )


@query("filter_nonblank", "SELECT page_id, url FROM pages WHERE trim(split_part(url, '?', 2)) <> ''")
def filter_nonblank(w: Workspace) -> DataFrame:
    return w.table("pages").select("page_id", "url").where(F.trim(F.split_part("url", F.lit("?"), F.lit(2))) != "")


@query(
    "filter_in_set",
    claims("SELECT * FROM garage_raw WHERE CLAIMNO IN (SELECT CLAIMNO FROM surveyor_raw WHERE IS_FRAUD = 1)"),
)
def filter_in_set(w: Workspace) -> DataFrame:
    wanted = w.surveyor_raw.where(F.col(LABEL) == 1).select(CLAIM).distinct()
    return w.garage_raw.join(wanted, CLAIM, "left_semi")


@query(
    "filter_not_in_set",
    claims("SELECT DISTINCT CLAIMNO FROM garage_raw WHERE CLAIMNO NOT IN (SELECT CLAIMNO FROM surveyor_raw WHERE IS_FRAUD = 1)"),
)
def filter_not_in_set(w: Workspace) -> DataFrame:
    fraud = w.surveyor_raw.where(F.col(LABEL) == 1).select(CLAIM).distinct()
    return w.garage_raw.select(CLAIM).distinct().join(fraud, CLAIM, "left_anti")


@query(
    "flag_membership",
    """SELECT d.doc_id, CASE WHEN d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END AS flagged
       FROM documents d""",
)
def flag_membership(w: Workspace) -> DataFrame:
    hits = w.table("labels").where("toxic = 1").select("doc_id").distinct().withColumn("hit", F.lit(1))
    return w.table("documents").select("doc_id").join(hits, "doc_id", "left").select(
        "doc_id", F.when(F.col("hit").isNotNull(), 1).otherwise(0).alias("flagged")
    )


@query(
    "null_fill",
    """SELECT doc_id, CAST(coalesce(quality, 0) AS INT) AS quality FROM documents LEFT JOIN labels USING (doc_id)""",
)
def null_fill(w: Workspace) -> DataFrame:
    joined = w.table("documents").select("doc_id").join(w.table("labels"), "doc_id", "left")
    return joined.select("doc_id", F.coalesce("quality", F.lit(0)).cast("int").alias("quality"))


@query(
    "drop_null_rows",
    "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
)
def drop_null_rows(w: Workspace) -> DataFrame:
    joined = w.table("documents").select("doc_id").join(w.table("labels"), "doc_id", "left")
    return joined.dropna(subset=["quality"]).select("doc_id", "quality")


@query(
    "conditional_value",
    """SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'Fraud' ELSE 'Normal' END AS label, o_orderkey,
       CASE WHEN o_totalprice > 0 THEN o_custkey / o_totalprice ELSE 0 END AS share FROM orders""",
)
def conditional_value(w: Workspace) -> DataFrame:
    return w.table("orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "Fraud").otherwise("Normal").alias("label"),
        "o_orderkey",
        F.when(F.col("o_totalprice") > 0, F.col("o_custkey") / F.col("o_totalprice")).otherwise(0.0).alias("share"),
    )


@query(
    "derived_math",
    f"""SELECT event_id, {rnd('ln(1 + value)', 6)} AS log_value, {rnd('value / (value + 1)', 6)} AS ratio,
        {rnd('(SELECT max(value) FROM events) - value', 4)} AS below_max FROM events WHERE value > -1""",
)
def derived_math(w: Workspace) -> DataFrame:
    events = w.table("events")
    top = events.select(F.max("value")).scalar()
    value = F.col("value")
    return events.where(value > -1).select(
        "event_id",
        numbers.rounded(F.log1p(value), 6).alias("log_value"),
        numbers.rounded(value / (value + 1), 6).alias("ratio"),
        numbers.rounded(top - value, 4).alias("below_max"),
    )


@query("clip", "SELECT event_id, least(greatest(value, 5.0), 60.0) AS clipped FROM events")
def clip(w: Workspace) -> DataFrame:
    return w.table("events").select("event_id", numbers.clip(F.col("value"), 5.0, 60.0).alias("clipped"))


@query(
    "round_n",
    f"SELECT o_orderkey, {rnd('o_totalprice / 7', 2)} AS two, {rnd('o_totalprice / 7', 4)} AS four FROM orders",
)
def round_n(w: Workspace) -> DataFrame:
    part = F.col("o_totalprice") / 7
    return w.table("orders").select(
        "o_orderkey", numbers.rounded(part, 2).alias("two"), numbers.rounded(part, 4).alias("four")
    )


@query("string_trim_label", "SELECT page_id, substr(url, 1, 12) AS label FROM pages")
def string_trim_label(w: Workspace) -> DataFrame:
    return w.table("pages").select("page_id", text.short_label(F.col("url")).alias("label"))


@query(
    "title_case",
    """SELECT p_partkey, array_to_string(list_transform(string_split(replace(lower(p_name), '_', ' '), ' '),
       lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), ' ') AS title FROM part""",
)
def title_case(w: Workspace) -> DataFrame:
    return w.table("part").select("p_partkey", text.title_case(F.col("p_name")).alias("title"))


@query("head_n", claims("SELECT CLAIMNO, PARTNO, TOTAL_AMOUNT FROM garage_raw ORDER BY CLAIMNO, PARTNO, TOTAL_AMOUNT LIMIT 5"))
def head_n(w: Workspace) -> DataFrame:
    return w.garage_raw.select(CLAIM, "PARTNO", AMOUNT).orderBy(CLAIM, "PARTNO", AMOUNT).limit(5)


@query("percent_format", "SELECT event_id, printf('%.2f', CAST(event_id % 977 AS DOUBLE) / 1000 * 100) || '%' AS share FROM events")
def percent_format(w: Workspace) -> DataFrame:
    share = (F.col("event_id") % 977).cast("double") / 1000
    return w.table("events").select("event_id", text.percent_text(share).alias("share"))


@query(
    "first_word_category",
    claims(
        r"""SELECT name, CASE WHEN trim(name) = '' THEN 'OTHER' ELSE upper(regexp_extract(trim(name), '^\S+')) END AS category
            FROM (SELECT DISTINCT PARTDESCRIPTION AS name FROM garage_raw UNION ALL SELECT '   ')"""
    ),
)
def first_word_category(w: Workspace) -> DataFrame:
    names = w.garage_raw.select(F.col(GARAGE_PART).alias("name")).distinct()
    blank = w.spark.range(1).select(F.lit("   ").alias("name"))
    return names.unionByName(blank).withColumn("category", text.first_word_category(F.col("name")))


@query(
    "abbreviation_swap",
    claims(
        f"""SELECT name, array_to_string(list_transform(string_split(name, ' '), lambda t: coalesce(
            MAP {{{", ".join(f"'{a}': '{b}'" for a, b in SYNONYMS.items())}}}[t], t)), ' ') AS canonical FROM survey_names"""
    ),
)
def abbreviation_swap(w: Workspace) -> DataFrame:
    return w.survey_names.withColumn("canonical", text.canonical_parts(F.col("name"), SYNONYMS))


@query(
    "union_rows",
    claims("SELECT name, 'survey' AS side FROM survey_names UNION ALL SELECT name, 'garage' FROM garage_names"),
)
def union_rows(w: Workspace) -> DataFrame:
    return w.survey_names.withColumn("side", F.lit("survey")).unionByName(
        w.garage_names.withColumn("side", F.lit("garage"))
    )


# --- joins -----------------------------------------------------------------------------------------------


@query("merge_claims", claims("SELECT * FROM merged"))
def merge_claims(w: Workspace) -> DataFrame:
    return w.merged


@query(
    "merge_null_keys",
    f"""SELECT coalesce(CAST(quality AS VARCHAR), 'nan') AS quality_key, lang, count(*) AS n
        FROM documents LEFT JOIN labels USING (doc_id) JOIN (SELECT '1' AS k, 'one' AS grade UNION ALL SELECT NULL, 'none') x
        ON coalesce(x.k, 'nan') = coalesce(CAST(quality AS VARCHAR), 'nan') GROUP BY ALL""",
)
def merge_null_keys(w: Workspace) -> DataFrame:
    graded = w.table("documents").join(w.table("labels"), "doc_id", "left").select(
        "lang", F.col("quality").cast("string").alias("quality_key")
    )
    grades = w.spark.createDataFrame([("1", "one"), (None, "none")], "quality_key string, grade string")
    merged = merge.merge_claims(graded, grades, ["quality_key"], null_keys_match=True)
    return merged.groupBy("quality_key", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("attach_labels", claims("SELECT CLAIMNO, part_count, IS_FRAUD FROM features"))
def attach_labels(w: Workspace) -> DataFrame:
    plain = features.claim_features(w.rows(LABEL), merge.FANOUT)
    return features.attach_labels(plain, w.rows(LABEL)).select(CLAIM, "part_count", LABEL)


@query(
    "lookup_code",
    claims(
        """SELECT name, coalesce(NUM_PART_CODE, 'P999') AS code FROM survey_names
           LEFT JOIN primary_parts ON PART_CATEGORY = upper(split_part(name, ' ', 1))"""
    ),
)
def lookup_code(w: Workspace) -> DataFrame:
    words = w.survey_names.withColumn("PART_CATEGORY", text.first_word_category(F.col("name")))
    found = words.join(w.primary_parts, "PART_CATEGORY", "left")
    return found.select("name", F.coalesce(CODE, F.lit("P999")).alias("code"))


# --- aggregates ------------------------------------------------------------------------------------------


@query(
    "claim_agg",
    claims(
        f"""SELECT CLAIMNO, {rnd('total_amount', 2)} AS total_amount, part_count, {rnd('avg_part_amount', 4)} AS
            avg_part_amount, max_part_amount, min_part_amount, {rnd('std_part_amount', 2)} AS std_part_amount
            FROM base"""
    ),
)
def claim_agg(w: Workspace) -> DataFrame:
    merged = features.claim_features(w.merged_within_cap())
    wanted = merged.select(CLAIM, *FEATURES[:6])
    return settled(wanted, {"total_amount": 2, "avg_part_amount": 4, "std_part_amount": 2})


@query("label_agg", claims("SELECT CLAIMNO, max(IS_FRAUD) AS IS_FRAUD FROM surveyor_raw GROUP BY CLAIMNO"))
def label_agg(w: Workspace) -> DataFrame:
    return w.surveyor_raw.groupBy(CLAIM).agg(F.max(LABEL).alias(LABEL))


@query(
    "part_amount_agg",
    claims(
        f"""SELECT CLAIMNO AS claim_id, TXT_PARTS_NAME AS part, {rnd('sum(TOTAL_AMOUNT)', 2)} AS amount
            FROM capped GROUP BY ALL"""
    ),
)
def part_amount_agg(w: Workspace) -> DataFrame:
    return settled(w.interactions, {"amount": 2})


def codes_of(df: DataFrame, column: str) -> list[str]:
    """Every part code that occurs; a table with a column for each needs a bounded number of them."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values, too many for columns")
    return sorted(found)


@query(
    "pivot_claim_part",
    claims(
        "SELECT CLAIMNO, "
        + ", ".join(
            f"{rnd(f'coalesce(sum(TOTAL_AMOUNT) FILTER (NUM_PART_CODE = {chr(39)}{c}{chr(39)}), 0)', 2)} AS {c}" for c in CODES
        )
        + " FROM capped GROUP BY CLAIMNO"
    ),
)
def pivot_claim_part(w: Workspace) -> DataFrame:
    cells = w.rows(CODE).withColumn("x", F.col(AMOUNT) * F.col(merge.FANOUT))
    codes = codes_of(cells, CODE)
    return settled(cells.groupBy(CLAIM).pivot(CODE, codes).agg(F.sum("x")).fillna(0.0), {c: 2 for c in codes})


@query("distinct_parts", claims("SELECT name FROM survey_names"))
def distinct_parts(w: Workspace) -> DataFrame:
    from partledger.operators.matching import distinct_parts as names

    return names(w.surveyor, PART)


@query("count_distinct", claims("SELECT count(DISTINCT CLAIMNO) AS claims FROM garage_raw"))
def count_distinct(w: Workspace) -> DataFrame:
    return w.garage_raw.agg(F.countDistinct(CLAIM).alias("claims"))


@query(
    "common_parts",
    claims(
        """SELECT TXT_PARTS_NAME AS part_name, count(*) AS count, CAST(round(CAST(count(*) * 1.0::DOUBLE /
           (SELECT count(*) FROM s) * 100 AS DECIMAL(20,8)), 2) AS DOUBLE) AS percentage FROM s GROUP BY 1"""
    ),
)
def common_parts(w: Workspace) -> DataFrame:
    return profile.common_parts(w.surveyor, PART)


@query(
    "primary_part_distribution",
    claims("SELECT NUM_PART_CODE AS primary_part_code, count(*) AS claim_count FROM s WHERE NUM_PART_CODE IS NOT NULL GROUP BY 1"),
)
def primary_part_distribution(w: Workspace) -> DataFrame:
    return profile.primary_part_distribution(w.surveyor, CODE)


@query(
    "row_counts",
    claims(
        """SELECT 'surveyor' AS table_name, count(*) AS row_count FROM s UNION ALL SELECT 'garage', count(*) FROM g
           UNION ALL SELECT 'merged', count(*) FROM capped"""
    ),
)
def row_counts(w: Workspace) -> DataFrame:
    counts = profile.row_counts({"surveyor": w.surveyor, "garage": w.garage})
    merged = w.rows().agg(F.sum(merge.FANOUT).alias("row_count")).select(F.lit("merged").alias("table_name"), "row_count")
    return counts.unionByName(merged)


@query(
    "missing_values",
    """SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS column_name, unnest([
       count(*) - count(doc_id), count(*) - count(lang), count(*) - count(quality), count(*) - count(toxic)]) AS missing
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def missing_values(w: Workspace) -> DataFrame:
    joined = w.table("documents").join(w.table("labels"), "doc_id", "left")
    return profile.missing_values(joined.select("doc_id", "lang", "quality", "toxic"))


@query(
    "duplicate_rows",
    claims(
        "SELECT (SELECT count(*) FROM s) - (SELECT count(*) FROM (SELECT DISTINCT * FROM s)) AS duplicates"
    ),
)
def duplicate_rows(w: Workspace) -> DataFrame:
    return profile.duplicate_rows(w.surveyor)


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, {rnd(f'avg({c})', p)} AS mean, {rnd(f'stddev_samp({c})', p)} AS std,
        {rnd(f'min({c})', p)} AS min, {rnd(f'quantile_cont({c}, 0.25)', p)} AS q25, {rnd(f'quantile_cont({c}, 0.5)', p)} AS q50,
        {rnd(f'quantile_cont({c}, 0.75)', p)} AS q75, {rnd(f'max({c})', p)} AS max FROM features"""
    for c, p in ((c, 2) for c in FEATURES)
)


@query("describe_table", claims(_DESCRIBE))
def describe_table(w: Workspace) -> DataFrame:
    table = profile.describe_table(w.features, FEATURES)
    return settled(table, {c: 2 for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})


@query(
    "class_balance",
    claims(
        """SELECT split, IS_FRAUD, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY split) AS share FROM sp
           GROUP BY split, IS_FRAUD""",
        sp="""SELECT CLAIMNO, IS_FRAUD, CASE WHEN row_number() OVER (PARTITION BY IS_FRAUD ORDER BY md5(CLAIMNO)) <=
              round(0.2 * count(*) OVER (PARTITION BY IS_FRAUD)) THEN 'test' ELSE 'train' END AS split FROM base""",
    ),
)
def class_balance(w: Workspace) -> DataFrame:
    return profile.class_balance(w.split, LABEL)


_PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[:i]]


@query(
    "correlation_matrix",
    claims(
        " UNION ALL ".join(
            f"SELECT '{a}' AS row_name, '{b}' AS column_name, {rnd(f'corr({a}, {b})', 6)} AS correlation FROM features"
            for a, b in _PAIRS
        )
    ),
)
def correlation_matrix(w: Workspace) -> DataFrame:
    return settled(profile.correlation_matrix(w.features, FEATURES), {"correlation": 6})


@query(
    "rate_by_group",
    claims(
        f"""SELECT IS_FRAUD, count(*) AS n, {rnd('avg(total_amount)', 2)} AS mean, {rnd('stddev_samp(total_amount)', 2)} AS std
            FROM features GROUP BY 1"""
    ),
)
def rate_by_group(w: Workspace) -> DataFrame:
    return settled(profile.rate_by_group(w.features, LABEL, "total_amount"), {"mean": 2, "std": 2})


# --- features --------------------------------------------------------------------------------------------


@query("claim_features", claims(f"SELECT {FEATURE_SQL} FROM features"))
def claim_features(w: Workspace) -> DataFrame:
    rows = merge.claim_rows(w.surveyor, w.garage, keep=[CLAIM, LABEL])
    return settled(features.claim_features(rows, merge.FANOUT, label=LABEL), FEATURE_PLACES)


_SURVEY_BASE = PARTS["base"].replace("FROM capped", "FROM lines").replace("max(IS_FRAUD) AS IS_FRAUD", "max(IS_FRAUD) AS IS_FRAUD")


@query(
    "claim_features_dedupe",
    claims(
        f"SELECT {FEATURE_SQL} FROM flat_features",
        lines=f"""SELECT * FROM s WHERE ({KEYS}) IN (SELECT ({KEYS}) FROM g) AND TOTAL_AMOUNT <=
                 (SELECT greatest(10 * quantile_cont(TOTAL_AMOUNT, 0.99), 100000) FROM merged)""",
        flat=_SURVEY_BASE,
        flat_features=PARTS["features"].replace("FROM base", "FROM flat"),
    ),
)
def claim_features_dedupe(w: Workspace) -> DataFrame:
    """Survey rows only, each counted once."""
    return settled(features.claim_features(w.rows(LABEL), label=LABEL), FEATURE_PLACES)


_QUOTE = """SELECT o_orderkey AS quote_id, o_totalprice AS total_amount, o_custkey % 5 AS part_count,
            o_totalprice / greatest(o_custkey % 5, 1) AS mean FROM orders"""


@query(
    "quote_features",
    f"""SELECT quote_id, total_amount, part_count, {rnd('mean', 4)} AS avg_part_amount, total_amount AS max_part_amount,
        {rnd('mean', 4)} AS min_part_amount, CAST(0 AS DOUBLE) AS std_part_amount,
        {rnd('CASE WHEN part_count > 1 THEN total_amount - mean ELSE 0 END', 4)} AS amount_range,
        CAST(0 AS DOUBLE) AS coeff_variation, {rnd('ln(1 + total_amount)', 6)} AS log_total_amount FROM ({_QUOTE})""",
)
def quote_features(w: Workspace) -> DataFrame:
    places = {"avg_part_amount": 4, "min_part_amount": 4, "amount_range": 4, "log_total_amount": 6}
    return settled(features.quote_features(w.quotes), places)


# --- chart tables ----------------------------------------------------------------------------------------


@query(
    "chart_top_parts",
    claims("SELECT TXT_PARTS_NAME AS part_name, count(*) AS count FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"),
)
def chart_top_parts(w: Workspace) -> DataFrame:
    return chartdata.top_parts(w.surveyor, PART)


@query(
    "chart_claim_share",
    claims(
        f"""SELECT part_name, count, {rnd('count / sum(count) OVER () * 100', 6)} AS share FROM (
            SELECT TXT_PARTS_NAME AS part_name, count(*) AS count FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"""
    ),
)
def chart_claim_share(w: Workspace) -> DataFrame:
    counts = profile.value_counts(w.surveyor, PART, "part_name")
    return settled(chartdata.top_share(counts, "part_name", "count"), {"share": 6})


_HIST = """SELECT {by}, b AS bin, lo + b * wd AS low, lo + b * wd + wd AS high, coalesce(n, 0) AS n,
           coalesce(n, 0) / (tot * wd) AS density FROM (
             SELECT *, (hi - lo) / bins AS wd, unnest(range(0, bins)) AS b FROM (
               SELECT {by}, min(v) AS lo, max(v) AS hi, count(v) AS tot, {bins} AS bins FROM src GROUP BY {by})) r
           LEFT JOIN (SELECT {by}, least(floor((v - lo) / ((hi - lo) / bins)), bins - 1) AS b, count(*) AS n FROM src JOIN (
               SELECT {by}, min(v) AS lo, max(v) AS hi, {bins} AS bins FROM src GROUP BY {by}) USING ({by}) GROUP BY {by}, b) c
           USING ({by}, b)"""


@query(
    "chart_amount_hist",
    f"""WITH src AS (SELECT is_fraud, o_totalprice AS v FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 1
            ELSE 0 END AS is_fraud FROM orders)), h AS ({_HIST.format(by='is_fraud', bins='CASE WHEN is_fraud = 1 THEN 20 ELSE 40 END')})
        SELECT h.is_fraud, bin, {rnd('low', 4)} AS low, {rnd('high', 4)} AS high, n, {rnd('density * 1000000', 6)} AS density,
        {rnd('m', 2)} AS group_mean FROM h JOIN (SELECT is_fraud, avg(v) AS m FROM src GROUP BY 1) USING (is_fraud)""",
)
def chart_amount_hist(w: Workspace) -> DataFrame:
    flag = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    orders = w.table("orders").select(flag.alias("is_fraud"), F.col("o_totalprice").alias("total_amount"))
    bars = chartdata.amount_histogram(orders).withColumn("density", F.col("density") * 1_000_000)
    return settled(bars, {"low": 4, "high": 4, "density": 6, "group_mean": 2})


_SIX = FEATURES[:6]
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS column_name, IS_FRAUD, {rnd(c, 4)} AS v FROM features" for c in _SIX)


def _six_features(w: Workspace) -> DataFrame:
    return settled(w.features.select(LABEL, *_SIX), {c: 4 for c in _SIX})


@query(
    "chart_density_hist",
    claims(
        f"""SELECT column_name, IS_FRAUD, bin, {rnd('low', 4)} AS low, {rnd('high', 4)} AS high, n, {rnd('density * 1000000', 4)} AS density FROM h""",
        src=_LONG,
        h=_HIST.format(by="column_name, IS_FRAUD", bins="40"),
    ),
)
def chart_density_hist(w: Workspace) -> DataFrame:
    """Bars of the first six claim features by class; densities in millionths."""
    bars = chartdata.density_histograms(_six_features(w), _SIX, LABEL)
    return settled(bars.withColumn("density", F.col("density") * 1_000_000), {"low": 4, "high": 4, "density": 4})


_FENCED = {
    "src": _LONG,
    "fenced": """SELECT e.*, q25, q50, q75, v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside FROM src e JOIN (
                 SELECT column_name, IS_FRAUD, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50,
                 quantile_cont(v, 0.75) AS q75 FROM src GROUP BY ALL) q USING (column_name, IS_FRAUD)""",
}


@query(
    "chart_boxplots",
    claims(
        f"""SELECT column_name, IS_FRAUD, {rnd('any_value(q25)', 4)} AS q25, {rnd('any_value(q50)', 4)} AS q50,
            {rnd('any_value(q75)', 4)} AS q75, min(v) FILTER (inside) AS whisker_low, max(v) FILTER (inside) AS whisker_high,
            count(*) FILTER (NOT inside) AS outliers FROM fenced GROUP BY column_name, IS_FRAUD""",
        **_FENCED,
    ),
)
def chart_boxplots(w: Workspace) -> DataFrame:
    """Boxes of the first six claim features by class."""
    return settled(chartdata.boxplots(_six_features(w), _SIX, LABEL), {"q25": 4, "q50": 4, "q75": 4})


@query(
    "chart_boxplot_outliers",
    claims("SELECT column_name, IS_FRAUD, v AS value FROM fenced WHERE NOT inside", **_FENCED),
)
def chart_boxplot_outliers(w: Workspace) -> DataFrame:
    return chartdata.boxplot_outliers(_six_features(w), _SIX, LABEL)
