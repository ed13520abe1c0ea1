"""Repeated windows of words against brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from partledger.llm import substrings


def brute(rows, words):
    split = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in rows]
    first = {}
    for doc, w in split:
        for k in range(len(w) - words + 1):
            key = tuple(w[k : k + words])
            first[key] = min(first.get(key, 2**63), 2**63 - 1 if doc is None else doc)
    out = []
    for doc, w in split:
        gone = set()
        for k in range(len(w) - words + 1):
            if first[tuple(w[k : k + words])] < (2**63 - 1 if doc is None else doc):
                gone.update(range(k, k + words))
        out.append((doc, " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return out


def order(rows):
    return sorted(rows, key=repr)


def run(frame, words):
    done = substrings.remove_repeated_windows(frame, words)
    return order([(r["doc_id"], r["kept"], r["n_words"], r["n_removed"]) for r in done.collect()])


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdéç中", k=rng.randint(1, 5))) for _ in range(60)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    shared = [prose(n) for n in (9, 10, 11, 30, 90, 400)]
    rows = []
    for doc in range(120):
        parts = [prose(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), prose(rng.randint(0, 12))]
        rows.append((doc * 3 - 50, rng.choice(["\n", "  ", "\t"]).join(parts)))
    rows += [(900 + i, rows[7][1]) for i in range(5)]  # copies
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, shared[5]), (None, shared[5]), (None, "alone " * 9)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "x " * 500), (1004, "x " * 30), (1005, "x y " * 30)]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force_at_small_windows(documents):
    rows = corpus()
    frame = documents([(d, t, None, None) for d, t in rows]).repartition(5)
    for words in (2, 10):
        assert run(frame, words) == order(brute(rows, words))


def test_window_of_production(documents):
    rng = random.Random(8)
    passage = [" ".join(f"w{rng.randint(0, 900)}" for _ in range(n)) for n in (49, 50, 51, 230)]
    rows = [(k, " ".join([f"a{k} b{k}", passage[k % 4], f"c{k}", passage[(k // 4) % 4]])) for k in range(24)]
    assert run(documents([(d, t, None, None) for d, t in rows]), 50) == order(brute(rows, 50))


def test_longest_level(documents):
    rng = random.Random(9)
    text = " ".join(f"w{rng.randint(0, 900)}" for _ in range(1000))
    rows = [(1, text, None, None), (2, text + " more", None, None), (3, text[:900], None, None), (4, "none " * 3, None, None)]
    got = {r["doc_id"]: r["longest"] for r in substrings.remove_repeated_windows(documents(rows), 10).collect()}
    assert got[1] == got[2] >= 160 and 10 <= got[3] <= 160 and got[4] == 0


def test_longest_is_exact(documents):
    """Every doubled length at which some window is in a text of another id, wherever the window begins."""
    rng = random.Random(12)
    shared = [[f"s{k}w{i}" for i in range(n)] for k, n in enumerate((4, 5, 8, 9, 16, 17, 31, 32, 40, 64, 64, 64))]
    rows = []
    for doc in range(60):
        words = [f"d{doc}a{i}" for i in range(rng.randint(0, 9))]
        for k in rng.sample(range(len(shared)), 2):
            words += shared[k] + [f"d{doc}b{k}"]
        rows.append((doc, " ".join(words)))
    rows += [(100, rows[0][1]), (None, rows[5][1] + " tail"), (101, "lonely " * 50)]
    first = {}
    for doc, text in rows:
        first[text] = min(first.get(text, 2**63), 2**63 - 1 if doc is None else doc)
    split, want, length = {t: t.split() for t in first}, dict.fromkeys(first, 0), 4
    while length <= 128:
        holders = {}
        for t, w in split.items():
            for i in range(len(w) - length + 1):
                holders.setdefault(tuple(w[i : i + length]), set()).add(first[t])
        for t, w in split.items():
            if any(len(holders[tuple(w[i : i + length])]) > 1 for i in range(len(w) - length + 1)):
                want[t] = length
        length *= 2
    frame = documents([(d, t, None, None) for d, t in rows]).repartition(3)
    got = [(r["doc_id"], r["text"], r["longest"]) for r in substrings.remove_repeated_windows(frame, 4).collect()]
    assert order(got) == order([(d, t, want[t]) for d, t in rows])


def test_extra_columns_and_empty_table(documents):
    frame = documents([(1, "a b c d", "s", "en"), (2, "z a b c d", None, None)])
    frame = frame.withColumns({c: F.lit(f"own {c}") for c in ("id", "key", "places", "longest", "kept", "a", "b")}).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    done = substrings.remove_repeated_windows(frame, 4)
    rows = {r["doc_id"]: r for r in done.collect()}
    assert rows[2]["kept"] == "z" and rows[2]["key"] == "own key" and rows[2]["places"] == "own places" and rows[2]["m"] == {"k": 1}
    assert set(done.columns) == {*frame.columns, "n_words", "n_removed"}
    assert substrings.remove_repeated_windows(frame.limit(0)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = order([(d, n, m, hashlib.sha256(k.encode()).hexdigest()) for d, k, n, m in brute(rows, 50)])
    got = substrings.op12_substring_dedup(spark, folder).drop("longest").collect()
    assert order([tuple(r) for r in got]) == want
