import numpy as np
import pytest
from pyspark.sql import functions as F

from partledger.functions.similarity import StringBlock, lcs_length, score
from partledger.operators import matching


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], (last + 1 if x == y else max(row[j + 1], row[j]))
    return row[-1]


def test_lcs_kernels_agree():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcd "), rng.integers(0, 90))) for _ in range(60)] + ["", "a" * 64, "ab" * 40]
    block = StringBlock(words)
    for a in words:
        ratios = block.ratios(a)
        for b, ratio in zip(words, ratios):
            common = slow_lcs(a, b)
            assert lcs_length(a, b) == common
            assert ratio == (1.0 if not a and not b else 2.0 * common / (len(a) + len(b)))


def test_scores_round_half_to_even():
    # 2 * 5 / 16 = 0.625 -> 62.5 -> 62; 2 * 7 / 16 = 0.875 -> 87.5 -> 88
    assert list(score(np.array([0.625, 0.875, 0.8, 0.79]))) == [62, 88, 80, 79]
    # a substitution costs two edits
    assert score(StringBlock(["abcd"]).ratios("abxd"))[0] == 75


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


SURVEY = ["front door", "door front", "frnt door", "lamp", "zzz", "a b", "rear bumper assy", "bumper"]
GARAGE = ["front door", "rear door", "rear bumper assembly", "lamp lh", "lamp rh", "wing"]


def test_fuzzy_best_match(spark):
    found = matching.match_fuzzy(names(spark, SURVEY), names(spark, GARAGE)).toPandas().set_index("survey_part")
    for part in SURVEY:
        key = " ".join(sorted(part.split()))
        ratios = {g: 2 * slow_lcs(key, " ".join(sorted(g.split()))) / (len(key) + len(g)) for g in GARAGE}
        best = max(ratios.values())
        row = found.loc[part]
        assert row.fuzzy_score == round(100 * best)
        wanted = min(g for g, r in ratios.items() if r == best) if round(100 * best) >= 80 else None
        assert (row.garage_part or None) == wanted


def test_pair_score_column(spark):
    df = spark.createDataFrame([("Door, FRONT", "front door"), ("", "x"), ("", "")], "a string, b string")
    scores = [r[0] for r in df.select(matching.token_sort_ratio(F.col("a"), F.col("b"))).collect()]
    assert scores == [100, 0, 100]


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(5)
    syllables = ["ba", "ko", "ri", "tu", "ze", "mo", "la", "ne"]

    def word():
        return "".join(rng.choice(syllables, rng.integers(1, 4)))

    def phrase():
        return " ".join(word() for _ in range(rng.integers(1, 4)))

    garage = sorted({phrase() for _ in range(300)})
    survey = sorted({phrase() for _ in range(150)} | set(garage[:20]))
    return names(spark, survey), names(spark, garage)


def test_cells_give_the_same_answer(many):
    survey, garage = many
    whole = matching.match_fuzzy(survey, garage).toPandas().set_index("survey_part").sort_index()
    cells = matching.match_fuzzy(survey, garage, cell_rows=20).toPandas().set_index("survey_part").sort_index()
    assert whole.equals(cells)
    model = matching.tfidf_fit(survey, garage)
    whole = matching.match_cosine(survey, garage, model).toPandas().set_index("survey_part").sort_index()
    cells = matching.match_cosine(survey, garage, model, cell_rows=20).toPandas().set_index("survey_part").sort_index()
    assert whole.equals(cells)


def test_tfidf(spark):
    model = matching.tfidf_fit(names(spark, ["door", "door lamp"]), names(spark, ["door", "a b"]))
    idf = {r.term: (r.df, r.idf) for r in model.terms.collect()}
    assert set(idf) == {"door", "lamp", "door lamp"}
    assert idf["door"][0] == 3 and np.isclose(idf["door"][1], np.log(5 / 4) + 1)
    limited = matching.tfidf_fit(names(spark, ["door", "door lamp"]), names(spark, ["door"]), max_terms=2).terms
    assert [r.term for r in limited.orderBy("term").collect()] == ["door", "door lamp"]
    weights = matching.tfidf_transform(names(spark, ["door lamp", "a b"]), model).toPandas()
    assert np.isclose((weights["weight"] ** 2).sum(), 1) and set(weights["name"]) == {"door lamp"}


def test_cosine_and_combination(spark):
    survey, garage = names(spark, SURVEY), names(spark, GARAGE)
    model = matching.tfidf_fit(survey, garage)
    cosine = matching.match_cosine(survey, garage, model).toPandas().set_index("survey_part")
    assert cosine.loc["front door", "cosine_score"] == 1.0
    assert cosine.loc["zzz", "cosine_score"] == 0.0 and cosine.loc["zzz", "garage_part"] is None
    assert cosine.loc["a b", "cosine_score"] == 0.0
    assert cosine.loc["lamp", "garage_part"] == "lamp lh"  # tie: smaller name
    cases = spark.createDataFrame(
        [("a", "a", 90, 0.1, "a", True), ("a", "b", 50, 0.5, "a", False), ("a", "b", 49, 0.5, "b", False),
         (None, "b", 10, 0.5, "b", False), ("a", None, 10, 0.0, "a", False), (None, None, 0, 0.0, None, False)],
        "f string, c string, fs int, cs double, best string, agree boolean",
    )
    row = matching.combine_best(F.col("f"), F.col("c"), F.col("fs"), F.col("cs"))
    out = cases.select("best", "agree", row.alias("b"), matching.match_agreement(F.col("f"), F.col("c")).alias("a")).collect()
    assert all(r.best == r.b and r.agree == r.a for r in out)


def test_batch_lookup(spark):
    garage = names(spark, GARAGE)
    model = matching.tfidf_fit(names(spark, SURVEY), garage)
    requests = names(spark, [" Front-DOOR ", "zzz", "", None])
    found = matching.match_batch(requests, garage, model).toPandas().set_index("input")
    assert found.loc["front-door", "fuzzy_match"] == "front door" and found.loc["front-door", "fuzzy_score"] == 100
    assert found.loc["zzz", "cosine_match"] is None
    assert len(found) == 4 and set(found.loc[""]["fuzzy_score"]) == {0}
    clean = matching.match_batch(requests, garage, model, clean=True).toPandas()
    assert "front door" in set(clean["input"])
