"""SQL building blocks for the reference answers, run by another engine on the same tables."""

from __future__ import annotations

from partledger.sources.views import GARAGE_SQL, PRIMARY_PARTS_SQL, SURVEYOR_SQL

_NAMES = {n: n for n in ("lineitem", "orders", "part", "primary_parts")}
KEYS = "REFERENCE_NUM, VEHICLE_MODEL_CODE, CLAIMNO"


def clean(text: str) -> str:
    kept = rf"regexp_replace(lower({text}), '[^a-z0-9\s]', ' ', 'g')"
    return rf"coalesce(trim(regexp_replace({kept}, '\s+', ' ', 'g')), '')"


def rnd(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(30,{places + 4})), {places}) AS DOUBLE)"


PARTS = {
    "garage_raw": GARAGE_SQL.format(**_NAMES),
    "primary_parts": PRIMARY_PARTS_SQL.format(**_NAMES),
    "surveyor_raw": SURVEYOR_SQL.format(**_NAMES),
    "s": f"SELECT * REPLACE ({clean('TXT_PARTS_NAME')} AS TXT_PARTS_NAME) FROM surveyor_raw",
    "g": f"SELECT * REPLACE ({clean('PARTDESCRIPTION')} AS PARTDESCRIPTION) FROM garage_raw",
    "merged": f"""SELECT {KEYS}, TXT_PARTS_NAME, NUM_PART_CODE, s.TOTAL_AMOUNT AS TOTAL_AMOUNT, IS_FRAUD,
                  PARTNO, PARTDESCRIPTION, g.TOTAL_AMOUNT AS TOTAL_AMOUNT_garage FROM s JOIN g USING ({KEYS})""",
    "capped": """SELECT * FROM merged WHERE TOTAL_AMOUNT <=
                 (SELECT greatest(10 * quantile_cont(TOTAL_AMOUNT, 0.99), 100000) FROM merged)""",
    "base": """SELECT CLAIMNO, sum(TOTAL_AMOUNT) AS total_amount, count(TOTAL_AMOUNT) AS part_count,
               avg(TOTAL_AMOUNT) AS avg_part_amount, max(TOTAL_AMOUNT) AS max_part_amount,
               min(TOTAL_AMOUNT) AS min_part_amount, coalesce(stddev_samp(TOTAL_AMOUNT), 0) AS std_part_amount,
               max(IS_FRAUD) AS IS_FRAUD FROM capped GROUP BY CLAIMNO""",
    "features": """SELECT *, max_part_amount - min_part_amount AS amount_range,
                   CASE WHEN avg_part_amount > 0 THEN std_part_amount / avg_part_amount ELSE 0 END AS coeff_variation,
                   ln(1 + total_amount) AS log_total_amount FROM base""",
    "survey_names": "SELECT DISTINCT TXT_PARTS_NAME AS name FROM s WHERE trim(TXT_PARTS_NAME) <> ''",
    "garage_names": "SELECT DISTINCT PARTDESCRIPTION AS name FROM g WHERE trim(PARTDESCRIPTION) <> ''",
    # requests: raw survey names, only stripped and lower-cased
    "request_names": r"SELECT DISTINCT lower(trim(TXT_PARTS_NAME)) AS name FROM surveyor_raw",
    "documents_tf": r"""SELECT name, side, term, count(*) AS tf FROM (
                SELECT name, side, unnest(list_concat(w, list_transform(range(1, len(w)),
                       lambda i: w[i] || ' ' || w[i + 1]))) AS term
                FROM (SELECT name, side, regexp_extract_all(lower(name), '\w\w+') AS w FROM (
                        SELECT name, 0 AS side FROM survey_names UNION ALL SELECT name, 1 FROM garage_names)))
                GROUP BY ALL""",
    "terms": """SELECT term, count(*) AS df,
                ln((1.0 + (SELECT count(*) FROM survey_names) + (SELECT count(*) FROM garage_names)) / (1.0 + count(*))) + 1
                AS idf FROM documents_tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5000""",
}


def _vector_parts(queries: str) -> dict[str, str]:
    def weights(source: str) -> str:
        return rf"""SELECT name, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY name)) AS weight FROM (
                SELECT name, term, (1 + ln(count(*))) * any_value(idf) AS raw FROM (
                  SELECT name, unnest(list_concat(w, list_transform(range(1, len(w)),
                         lambda i: w[i] || ' ' || w[i + 1]))) AS term
                  FROM (SELECT name, regexp_extract_all(lower(name), '\w\w+') AS w FROM {source}))
                JOIN terms USING (term) GROUP BY name, term)"""

    key = r"""array_to_string(list_sort(string_split(trim(regexp_replace(lower(name), '\W+', ' ', 'g')), ' ')), ' ')"""
    return {
        "qw": weights(queries),
        "gw": weights("garage_names"),
        "cos_pairs": """SELECT q.name AS survey_part, g.name AS garage_part, round(sum(q.weight * g.weight), 9) AS c
                        FROM qw q JOIN gw g USING (term) GROUP BY ALL""",
        "cos_best": f"""SELECT n.name AS survey_part, CASE WHEN c >= 0.15 THEN garage_part END AS garage_part,
                       {rnd('coalesce(c, 0)', 4)} AS cosine_score, coalesce(c, 0) >= 0.15 AS matched
                       FROM {queries} n LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY survey_part
                         ORDER BY c DESC, garage_part) AS r FROM cos_pairs) b ON b.survey_part = n.name AND r = 1""",
        "qk": f"SELECT name, {key} AS k FROM {queries}",
        "gk": f"SELECT min(name) AS name, {key} AS k FROM garage_names GROUP BY 2",
        # bit i of a letter's mask: the letter stands at place i of the garage key
        "masks": """SELECT k, map(list(ch), list(m)) AS masks FROM (
                    SELECT k, ch, CAST(sum(1::BIGINT << CAST(i - 1 AS INT)) AS BIGINT) AS m FROM (
                      SELECT k, i, substr(k, i, 1) AS ch FROM (SELECT k, unnest(range(1, len(k) + 1)) AS i FROM gk))
                    GROUP BY k, ch) GROUP BY k""",
        "edit_pairs": """SELECT q.k AS qk, g.k AS gk, g.name,
                    list_reduce(list_transform(string_split(q.k, ''), lambda ch: coalesce(m.masks[ch], 0::BIGINT)),
                      lambda v, u: ((v + (v & u)) | (v - (v & u))) & ((1::BIGINT << CAST(len(g.k) AS INT)) - 1),
                      (1::BIGINT << CAST(len(g.k) AS INT)) - 1) AS v
                    FROM (SELECT DISTINCT k FROM qk) q, gk g JOIN masks m ON m.k = g.k""",
        "edit_best": """SELECT qk, name, ratio FROM (SELECT qk, name, ratio, row_number() OVER (PARTITION BY qk
                        ORDER BY ratio DESC, name) AS r FROM (SELECT qk, name,
                        2.0 * (len(gk) - bit_count(v)) / (len(gk) + len(qk)) AS ratio FROM edit_pairs)) WHERE r = 1""",
        "fuz_best": """SELECT q.name AS survey_part,
                    CASE WHEN round_even(100 * ratio, 0) >= 80 THEN e.name END AS garage_part,
                    CAST(round_even(100 * ratio, 0) AS INT) AS fuzzy_score, round_even(100 * ratio, 0) >= 80 AS matched
                    FROM qk q JOIN edit_best e ON e.qk = q.k""",
    }


COMBINED = {
    "sides": """SELECT f.survey_part, f.garage_part AS garage_part_fuzzy, f.fuzzy_score,
                c.garage_part AS garage_part_cosine, c.cosine_score
                FROM fuz_best f JOIN cos_best c USING (survey_part)""",
    "combined": """SELECT *, CASE WHEN garage_part_fuzzy IS NOT NULL AND garage_part_cosine IS NOT NULL
                THEN CASE WHEN garage_part_fuzzy = garage_part_cosine OR fuzzy_score >= cosine_score * 100
                          THEN garage_part_fuzzy ELSE garage_part_cosine END
                ELSE coalesce(garage_part_fuzzy, garage_part_cosine) END AS best_match,
                coalesce(garage_part_fuzzy = garage_part_cosine, false) AS match_agreement FROM sides""",
}


def _with(parts: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + select


def claims(select: str, **extra: str) -> str:
    """``select`` over the claim tables, plus further named parts."""
    return _with({**PARTS, **extra}, select)


def matches(select: str, queries: str = "survey_names") -> str:
    """``select`` over the part-matching tables."""
    return _with({**PARTS, **_vector_parts(queries), **COMBINED}, select)


def baskets(item: str, select: str, **extra: str) -> str:
    """``select`` over ``pairs`` (multi-item claims), ``n`` and named parts."""
    parts = {
        "all_pairs": f"SELECT DISTINCT CLAIMNO AS claim, {item} AS item FROM capped",
        "pairs": """SELECT claim, item FROM all_pairs WHERE claim IN
                    (SELECT claim FROM all_pairs GROUP BY claim HAVING count(*) > 1)""",
        "total": "SELECT count(DISTINCT claim) AS n FROM pairs",
    }
    return _with({**PARTS, **parts, **extra}, select)


# Itemsets of a small item alphabet as bit masks: every mask is counted against every distinct basket mask.
MASKS = {
    "letters": "SELECT item, row_number() OVER (ORDER BY item) - 1 AS b FROM (SELECT DISTINCT item FROM pairs)",
    "basket_masks": """SELECT m, count(*) AS c FROM (SELECT claim, CAST(sum(1::BIGINT << CAST(b AS INT)) AS BIGINT) AS m
                       FROM pairs JOIN letters USING (item) GROUP BY claim) GROUP BY m""",
    "sets": """SELECT i AS mask, CAST(sum(c) AS BIGINT) AS freq, sum(c) / (SELECT n FROM total) AS support
               FROM range(1, 1::BIGINT << CAST((SELECT count(*) FROM letters) AS INT)) t(i)
               JOIN basket_masks ON m & i = i GROUP BY i HAVING sum(c) / (SELECT n FROM total) >= 0.01""",
    "named": """SELECT mask, any_value(freq) AS freq, any_value(support) AS support,
                string_agg(item, ', ' ORDER BY item) AS items
                FROM sets JOIN letters ON (mask >> CAST(b AS INT)) & 1 = 1 GROUP BY mask""",
    "splits": """SELECT a.items AS antecedents, c.items AS consequents, a.support AS antecedent_support,
                 c.support AS consequent_support, s.support AS support, s.support / a.support AS confidence
                 FROM named s JOIN named a ON a.mask & s.mask = a.mask AND a.mask <> s.mask
                 JOIN named c ON c.mask = s.mask - a.mask WHERE s.support / a.support >= 0.1""",
    "rules": """SELECT *, confidence / consequent_support AS lift,
                support - antecedent_support * consequent_support AS leverage,
                CASE WHEN confidence < 1 THEN (1 - consequent_support) / (1 - confidence)
                     ELSE 'infinity'::DOUBLE END AS conviction,
                greatest(support * (1 - antecedent_support), antecedent_support * (consequent_support - support)) AS worst
                FROM splits""",
}
