"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from partledger.llm import periods


def brute_runs(w, least=6):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 4 * q):
                found.setdefault((i, j + q - i), q)  # smaller periods come first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def plant(doc, w):
    h, n = zlib.crc32(str(doc).encode()), len(w)
    if doc is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]


def texts(seed, count):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        letters = "abcdefgh"[: rng.randint(1, 6)]
        parts = []
        for _ in range(rng.randint(0, 4)):
            root = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            inner = root * rng.randint(1, 8)
            outer = (inner[: rng.randint(1, len(inner))] + [rng.choice(letters)]) * rng.randint(1, 6)
            parts += outer + [rng.choice(letters) for _ in range(rng.randint(0, 5))]
        out.append(parts)
    return out


def test_runs_equal_brute_force():
    for seed in range(40):
        docs = texts(seed, 30)
        cuts = np.cumsum([0, *map(len, docs)])
        numbers = np.array([ord(x) for d in docs for x in d], np.int64)
        begin, end, period = periods.runs_of(numbers, cuts)
        got = [[] for _ in docs]
        for k, b, e, q in zip((np.searchsorted(cuts, begin, "right") - 1).tolist(), begin.tolist(), end.tolist(), period.tolist()):
            got[k].append((b - cuts[k], e - b, q))
        assert got == [brute_runs(d) for d in docs]


def test_all_binary_words():
    docs = [[int(b) for b in f"{k:014b}"] for k in range(1 << 14)]
    cuts = np.arange(len(docs) + 1) * 14
    begin, end, period = periods.runs_of(np.array(docs).ravel(), cuts)
    got = list(zip(begin.tolist(), end.tolist(), period.tolist()))
    assert got == [(14 * k + s, 14 * k + s + n, q) for k, d in enumerate(docs) for s, n, q in brute_runs(d)]


def test_range_successor():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 64, 300):
        values = rng.permutation(size)
        tree = periods.WaveletTree(values)
        low = rng.integers(0, size, 500)
        high = low + 1 + rng.integers(0, size, 500) % (size - low)
        bound = rng.integers(0, size + 2, 500)
        want = [min((v for v in values[a:b] if v >= x), default=size) for a, b, x in zip(low, high, bound)]
        assert tree.successor(low, high, bound).tolist() == want


def test_long_texts_and_odd_rows(documents):
    root = " ".join(f"w{k}" for k in range(300))
    rows = [(1, "a " * 30_000), (2, (root + " ") * 40), (3, None), (4, ""), (5, " \n "), (6, "a b " * 2), (7, "x y z " * 4), (7, "x y z " * 4), (None, "é é é é é é")]
    rows = [(d, t, None, None) for d, t in rows]
    frame = documents(rows).withColumns({c: F.lit(f"own {c}") for c in ("runs", "collapsed", "text_", "start")}).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    got = {(r["doc_id"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in periods.find_runs(frame).collect()}
    want = set()
    for doc, text, *_ in rows:
        w = (text or "").split()
        runs = {1: [(0, 30_000, 1)], 2: [(0, 12_000, 300)]}.get(doc) or brute_runs(w)
        want.add((doc, tuple(runs), collapse(w, runs)))
    assert got == want
    done = periods.find_runs(frame)
    assert done.count() == len(rows) and done.select("start", "m").first()["start"] == "own start"
    assert periods.find_runs(frame.limit(0)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    want = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        w = plant(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        runs = brute_runs(w) if len(w) < 1500 else None
        if runs is None:
            continue
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        kept = hashlib.sha256(collapse(w, runs).encode()).hexdigest()
        want.add((r["doc_id"], len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], digest, kept))
    got = {tuple(r) for r in periods.op13_periodic_runs(spark, folder).collect()}
    assert want <= got and len(want) > 150
