"""Near copies and repeated passages against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from partledger.llm import jaccard, suffixes
from partledger.llm.common import components

LONG = 200


def brute_groups(rows, words=5, percent=75):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({" ".join(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {" ".join(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)}


def brute_removed(rows):
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    seen = {}
    for _, b in raw:
        for p in range(len(b) - LONG + 1):
            seen[b[p : p + LONG]] = seen.get(b[p : p + LONG], 0) + 1
    out = []
    for doc, b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - LONG + 1):
            if seen[b[p : p + LONG]] > 1:
                gone[p : p + LONG] = [True] * LONG
        runs = sum(g and not (q and gone[q - 1]) for q, g in enumerate(gone))
        out.append((doc, bytes(x for x, g in zip(b, gone) if not g), sum(gone), runs))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies of growing distance, a hot passage, short and odd texts."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 6))) for _ in range(3000)]
    say = lambda n: [draw.choice(words) for _ in range(n)]
    passage, base, rows = say(60), say(160), []
    add = lambda t: rows.append((len(rows) * 3 + 1, t))
    for k in range(60):
        near = list(base)
        for _ in range(k // 6):
            near[draw.randrange(len(near))] = draw.choice(words)
        add(" ".join(near))
    for _ in range(40):
        add(" ".join(say(draw.randint(0, 25)) + passage + say(draw.randint(0, 25))))
    for _ in range(12):
        pair = say(90)
        add(" ".join(pair))
        add(" ".join([*pair[:draw.randint(60, 90)], *say(draw.randint(0, 12))]).upper())
    for t in (None, "", "  \n", "one", "one", "two words", "Two  words", "a b c d e", "é" * 300, "é" * 300, "x" * 5000, " ".join(base), "ab" * 400 + "Z" + "ab" * 130):
        add(t)
    return rows


@pytest.mark.parametrize("block_rows", [1000, 15])
def test_groups_equal_brute_force(documents, texts, block_rows):
    docs = documents([(*r, "s", "en") for r in texts])
    found = jaccard.smallest_ids(jaccard.jaccard_groups(docs, block_rows=block_rows)).collect()
    assert {tuple(r) for r in found} == brute_groups(texts)
    assert len(found) == len(texts)


def test_one_of_each_group_stays(documents, texts):
    docs = documents([(*r, "s", "en") for r in [*texts, texts[0], texts[0]]])
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    wanted = sorted({c for _, n, c in brute_groups(texts) if n} | {d for d, n, _ in brute_groups(texts) if not n})
    assert sorted(r["doc_id"] for r in kept.collect()) == wanted


def test_groups_of_nothing(documents):
    assert jaccard.smallest_ids(jaccard.jaccard_groups(documents([]))).collect() == []
    docs = documents([(None, None, None, None), (None, "a b c d e f", None, None), (2, "a b c d e f", None, None)])
    found = sorted(map(tuple, jaccard.smallest_ids(jaccard.jaccard_groups(docs)).collect()), key=repr)
    assert found == sorted([(None, 0, None), (None, 2, 2), (2, 2, 2)], key=repr)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, 100 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in chain + star], "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 300)}


@pytest.mark.parametrize("range_rows", [10_000, 25])
def test_removed_bytes_equal_brute_force(documents, texts, range_rows):
    docs = documents([(*r, "s", "en") for r in texts])
    found = suffixes.remove_repeats(docs, range_rows=range_rows).select("doc_id", "kept", "n_removed", "n_spans").collect()
    assert sorted((r[0], bytes(r[1]), r[2], r[3]) for r in found) == brute_removed(texts)


def test_cut_texts_keep_rows_and_columns(documents):
    draw = random.Random(9)
    passage = "".join(draw.choice("abcdefgh ü") for _ in range(260))
    rows = [(1, "1" + passage + "é", "s", None), (2, "2" + passage, "s", None), (3, None, None, None), (3, None, None, None), (4, "", "s", "x")]
    docs = documents(rows)
    cut = suffixes.without_repeats(docs)
    assert cut.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in cut.where("text IS NOT NULL").collect()) == [(1, "1é"), (2, "2"), (4, "")]
    assert cut.where("text IS NULL").count() == 2
    assert cut.where(F.col("n_chars") != F.length("text")).count() == 0
    assert suffixes.remove_repeats(documents([])).count() == 0


def test_lcp_intervals():
    assert sorted(suffixes.lcp_intervals([0, 5, 9, 9, 0, 7], 5)) == [(0, 3, 5), (1, 3, 9), (4, 5, 7)]
    assert suffixes.lcp_intervals([], 5) == []


@pytest.mark.parametrize("whole", [1, 10])
def test_names_that_fill_more_than_a_range(documents, monkeypatch, whole):
    monkeypatch.setattr(suffixes, "WHOLE", whole)
    draw = random.Random(12)
    say = lambda n: "".join(draw.choices("abcdef ", k=n))
    shared = say(260)
    rows = [(k, say(draw.randint(0, 150)) + shared[: draw.randint(150, 260)] + say(draw.randint(0, 150))) for k in range(60)] + [(99, "a" * 700), (98, "\0" * 230)]
    frame = documents([(d, t, None, None) for d, t in rows])
    for size in (7, 10_000):
        done = suffixes.remove_repeats(frame, range_rows=size)
        assert sorted((r["doc_id"], bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in done.collect()) == brute_removed(rows)


def test_clashing_columns(documents):
    """Callers' columns may have any name, and a type that cannot be ordered."""
    rows = [(1, "a b c d e f " * 30, None, None), (1, "a b c d e f " * 30, None, None), (2, None, None, None), (3, "", None, None)]
    own = ("_row", "_null", "_text", "_spans", "key", "spans", "_id", "_text_key", "_total", "_rows", "_copy", "doc", "times", "chunk", "component")
    frame = documents(rows).withColumns({c: F.lit(f"own {c}") for c in own}).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    from partledger.llm import mixing

    for stage, count in ((jaccard.one_of_each, 3), (suffixes.without_repeats, 4), (mixing.mixture, None)):
        found = stage(frame)
        assert found.columns == frame.columns
        got = found.collect()
        assert count is None or len(got) == count
        assert all(r[c] == f"own {c}" for r in got for c in own) and all(r["m"] == {"k": 1} for r in got)
        assert stage(frame.limit(0)).collect() == []
