"""The other training-data operators: exact round trips, brute force, held-out accuracy, edge cases."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partledger.llm import bpe, chat, hilbert, language, mixing, quality, toxicity, url_filter

ODD = [None, "", " \n\t", "a", "é" * 400, "日本 語", "x" * 3000, "word " * 2000]


@pytest.fixture(scope="module")
def tokens():
    return pytest.importorskip("public_tokenizers")


def test_tokens_equal_tiktoken_and_come_back(documents, tokens):
    tiktoken = pytest.importorskip("tiktoken")
    path = tokens.path("byte_bpe_50k.tiktoken")
    coder = bpe.Coder(open(path, "rb").read(), tokens.PATTERN)
    known = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    draw = random.Random(3)
    mixed = ["".join(draw.choice("abAB 12.,'\n\r#éß<>😀\x00") for _ in range(draw.randint(1, 400))) for _ in range(40)]
    texts = [*ODD, *mixed, "ab" * 700, "aaab" * 300, " " * 500 + "x", "<|endoftext|>"]
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)])
    coded = bpe.encode(docs, path, tokens.PATTERN)
    assert coded.columns == [*docs.columns, "ids"]
    assert [r["ids"] for r in coded.orderBy("doc_id").collect()] == [known.encode_ordinary(t or "") for t in texts]
    back = bpe.decode(coded, path, tokens.PATTERN).orderBy("doc_id").collect()
    assert [bytes(r["decoded"]).decode() for r in back] == [t or "" for t in texts]
    assert bpe.digests(documents([]), path, tokens.PATTERN).count() == 0


def test_very_long_words_equal_tiktoken(tokens):
    tiktoken = pytest.importorskip("tiktoken")
    coder = bpe.Coder(open(tokens.path("byte_bpe_50k.tiktoken"), "rb").read(), tokens.PATTERN)
    known = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    draw = random.Random(6)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=50_000)), "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(20_000))]
    texts += ["ACGT" * 3000, "ab" * 9000 + "a" * 333, " " * 3000 + "\n" * 500 + "-" * 777, "".join(draw.choices("ACGT", k=5000))]
    for _ in range(200):
        piece = "".join(draw.choices(draw.choice(["ab", "abc", "aeiournst", "=-", "é中ü", "thein"]), k=draw.randint(33, 150)))
        texts.append(piece + piece[-draw.randint(1, 9) :] * draw.randint(0, 30))
    ids, offsets = coder.encode(texts)
    assert [ids[i:j].tolist() for i, j in zip(offsets, offsets[1:])] == [known.encode_ordinary(t) for t in texts]
    assert coder.decode(ids, offsets) == [t.encode() for t in texts]


def test_short_pieces_take_less_time_than_windows_for_each_piece(tokens):
    tiktoken = pytest.importorskip("tiktoken")
    coder = bpe.Coder(open(tokens.path("byte_bpe_50k.tiktoken"), "rb").read(), tokens.PATTERN)
    known = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    draw = random.Random(8)
    pieces = sorted({"".join(draw.choices(["e", "t", "on", "in", "th", "re", "é", "中", "q"], k=draw.randint(2, 8))) for _ in range(12_000)})
    coder._learn(pieces)
    for piece in pieces[::40]:
        k = coder.known[piece]
        assert coder.tokens[coder.at[k] : coder.at[k + 1]].tolist() == known.encode_ordinary(piece)
    by_piece = """
WITH RECURSIVE work(round, piece, pos, token) AS (
  SELECT 0, piece, pos, token FROM symbols
  UNION ALL
  SELECT round + 1, piece, pos, token FROM (
    WITH pairs AS (
      SELECT w.*, m.merged FROM (
        SELECT *, lead(token) OVER seq AS follower, lead(pos) OVER seq AS eaten FROM work WINDOW seq AS (PARTITION BY piece ORDER BY pos)) w
      LEFT JOIN merges m ON m.a = w.token AND m.b = w.follower),
    lowest AS (
      SELECT piece, min(merged::BIGINT << 32 | pos) AS pair, arg_min(eaten, merged::BIGINT << 32 | pos) AS eaten
      FROM pairs WHERE merged IS NOT NULL GROUP BY piece)
    SELECT round, piece, p.pos, CASE WHEN p.pos = pair & 4294967295 THEN merged ELSE token END AS token
    FROM pairs p JOIN lowest USING (piece) WHERE p.pos <> lowest.eaten))
SELECT piece, list(token ORDER BY pos) AS tokens
FROM work JOIN (SELECT piece, max(round) AS round FROM work GROUP BY piece) USING (piece, round) GROUP BY piece"""
    found, seconds = [], []
    for query in (by_piece, bpe.ENCODE):  # both over the pieces that came last
        took = []
        for _ in range(5):
            began = time.process_time()
            rows = coder.db.sql(query).to_arrow_table()
            took.append(time.process_time() - began)
        found.append(dict(zip(rows["piece"].to_pylist(), rows["tokens"].to_pylist())))
        seconds.append(min(took))
    assert found[0] == found[1] and len(found[0])
    assert seconds[1] < 0.9 * seconds[0]


def test_decoded_bytes_of_every_token(tokens):
    coder = bpe.Coder(open(tokens.path("byte_bpe_50k.tiktoken"), "rb").read(), tokens.PATTERN)
    ids = np.array(list(coder.ranks.values()), np.int32)
    assert coder.decode(ids, np.arange(len(ids) + 1)) == list(coder.ranks)


def test_digests_of_repeated_rows(documents, tokens):
    texts = [None, "", "same text", "same text", "more of it\n" * 40]
    found = bpe.digests(documents([(7, t, None, None) for t in texts]), tokens.path("byte_bpe_50k.tiktoken"), tokens.PATTERN).collect()
    coder = bpe.Coder(open(tokens.path("byte_bpe_50k.tiktoken"), "rb").read(), tokens.PATTERN)
    want = []
    for t in texts:
        ids = coder.encode([t])[0]
        want.append((7, len(ids), hashlib.sha256(coder.written_ids(ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_one_sample_row_for_a_repeated_id(spark, documents, monkeypatch):
    docs = documents([(1, f"text {k}", None, None) for k in range(3000)] + [(2, "x" * 500, None, None), (3, None, None, None)])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.labelled_sample(docs, labels).collect()
    assert sorted((r["doc_id"], r["toxic"]) for r in rows) == [(1, 1), (2, 0), (3, 0)]
    monkeypatch.setattr(toxicity, "MAX_SAMPLE_BYTES", 100)
    assert sum(len(r["text"] or "") for r in toxicity.labelled_sample(docs, labels).collect()) <= 100


def test_mix_meets_targets(documents):
    draw = random.Random(4)
    rows = [(i, "w " * draw.randint(1, 60), draw.choice([None, "a", "b", "c", "a", "a"]), None) for i in range(3000)]
    rows += [(5000, None, "d", None), (5001, "", None, None), (7, rows[7][1], rows[7][2], None)]
    docs = documents(rows)
    found = mixing.copies(docs).toPandas()
    assert len(found) == len(rows)
    assert ((found["n_copies"] >= 0) & (found["n_copies"] <= 2)).all()
    size = {s: sum(len((t or "").split()) for _, t, x, _ in rows if x == s) for s in ("a", "b", "c", "d", None)}
    weight = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    target, capped = {}, {s for s in size if not size[s]}
    while True:  # brute force of the resharing
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in size if s not in capped)
        target = {s: 2 * size[s] if s in capped else level * weight[s] for s in size}
        over = {s for s in size if target[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    for s, t in target.items():
        mine = found[found["source"].isna()] if s is None else found[found["source"] == s]
        assert abs(mine["target"].iloc[0] - t) < 1e-6
        assert abs((mine["n_copies"] * mine["size"]).sum() - t) <= 60
    again = mixing.copies(docs.repartition(7)).toPandas()
    assert sorted(found[["doc_id", "n_copies"]].itertuples(index=False)) == sorted(again[["doc_id", "n_copies"]].itertuples(index=False))
    mix = mixing.mixture(docs)
    assert mix.columns == docs.columns
    assert mix.count() == found["n_copies"].sum()
    assert mixing.copies(documents([])).count() == 0


def test_rounding_keeps_expectation_and_words():
    draw, hits = random.Random(1), np.zeros(6)
    for _ in range(4000):
        size, p = [9, 7, 5, 3, 2, 1], [0.3] * 6
        left = mixing.round_pairs(size, p, [draw.random() for _ in p])
        assert abs(sum(s * x for s, x in zip(size, p)) - 0.3 * sum(size)) < 1e-9
        assert all(x in (0.0, 1.0) for i, x in enumerate(p) if i != left)
        hits += p
    assert np.abs(hits / 4000 - 0.3).max() < 0.03


def test_urls(spark):
    urls = [
        "http://a.NET/x", "http://Example.net/en/1", "http://w.example.net/en", "https://example.com/de/?q", "http://w.org/fr/#x",
        "http://net", "no scheme", None, "", "http://u:1/p?x", "x://notexample.com/de/", "http://org.x/fr/", "http://a.net?/en/",
    ]
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, n int")
    labels = spark.createDataFrame([(0, None, None), (0, 0, 1), (99, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judge_urls(pages, labels).collect()}
    assert len(found) == len(urls)
    assert found[0] == ("a.net", "/x", "net/", "block")
    assert found[1] == ("example.net", "/en/1", "example.net/en/", "allow")
    assert found[2][2:] == ("net/", "block") and found[3][2:] == ("example.com/de/", "block") and found[4][2:] == ("org/fr/", "allow")
    assert found[5][:3] == ("net", "", None) and found[6][:3] == ("", "", None) == found[7][:3] == found[8][:3]
    assert found[9][:3] == ("u:1", "/p", None) and found[10][2] is None and found[11][2] is None and found[12][:3] == ("a.net", "", None)
    assert url_filter.judge_urls(pages.limit(0), labels.limit(0)).count() == 0


def test_bad_hosts_are_shrunk_towards_their_domain(spark):
    rows = [("a.x.com", 50.0, 48.0), ("b.x.com", 1.0, 1.0), ("c.y.com", 60.0, 1.0), ("d.x.com", None, None), ("e.y.com", None, None)]
    found = {r["host"]: r for r in url_filter.host_reputation(spark.createDataFrame(rows, "host string, n double, bad double")).collect()}
    assert found["d.x.com"]["bad_rate"] > found["e.y.com"]["bad_rate"]
    assert found["a.x.com"]["bad_rate_low"] > 0.8 > found["c.y.com"]["bad_rate"]
    assert abs(found["b.x.com"]["bad_rate"] - found["d.x.com"]["bad_rate"]) < 0.05


def test_languages(documents):
    draw = random.Random(2)
    kinds = {"aa": "abcd", "bb": "efgh", "cc": "ijkl"}
    say = lambda k: " ".join("".join(draw.choice(kinds[k]) for _ in range(4)) for _ in range(30))
    learned = documents([(i, say(k), None, k) for i, k in enumerate(list(kinds) * 20)] + [(900, "abcd", None, None), (901, None, None, "aa")])
    asked = documents([(i, say(k), None, None) for i, k in enumerate(kinds)] + [(10, None, None, None), (11, "123 ?", None, None), (12, "", None, None)])
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(asked, learned).collect()}
    assert [found[i][0] for i in (0, 1, 2, 10, 11, 12)] == ["aa", "bb", "cc", "und", "und", "und"]
    assert all(0 <= s <= 1 for _, s in found.values())
    nothing = language.identify(asked, learned.limit(0)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert language.identify(asked.limit(0), learned).count() == 0


def brute_quality(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    held = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    marks = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), marks, len(lines) - len(set(lines)), len(held)


def test_quality_counts(documents):
    draw = random.Random(6)
    texts = [*ODD[:-1], "a b c a b c d", "a a a", "a a a a", "x\ny\nx\n \n \nx", "# < > é\u00a0b", *(" ".join(draw.choice("abcd") for _ in range(120)) for _ in range(5))]
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)])
    found = quality.judge_quality(docs, docs.select("doc_id").limit(3)).orderBy("doc_id").collect()
    for text, r in zip(texts, found):
        n, chars, marks, lines, held = brute_quality(text)
        assert tuple(r)[1:6] == (n, chars, marks, lines, held), text
        assert r["base_failed"] == (n < 50 or 100 * held > 50 * n)
        assert not (r["kept"] and r["base_failed"])
    assert quality.judge_quality(docs.limit(0), docs.select("doc_id").limit(0)).count() == 0


def test_unlike_texts_are_dropped(documents):
    draw = random.Random(8)
    good = lambda: " ".join(draw.choice(["sun", "moon", "star", "sky", "sea"]) + draw.choice("ab") for _ in range(80))
    bad = lambda: " ".join(draw.choice(["buy", "now", "win"]) + draw.choice("stuvwxyz") for _ in range(80))
    docs = documents([(i, good() if i % 4 else bad(), None, None) for i in range(200)])
    found = quality.judge_quality(docs, docs.where("doc_id < 100 AND doc_id % 4 > 0").select("doc_id")).collect()
    assert all(r["kept"] == bool(r["doc_id"] % 4) for r in found if not r["base_failed"])


def test_chats_come_back(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "a \\ </turn> # <x"), (2, 0, "user", "hi"), (2, 1, "assistant", "b"), (2, 2, "user", ""),
        (3, 0, "user", "hi"), (3, 1, "assistant", "b"), (4, None, None, None), (4, 2, "as:s#", "\\s\\l\n\n"), (None, 0, "assistant", "é😀"),
        (5, 0, "user", "hi"), (5, 0, "user", "hi"), (6, 0, "assistant", "long " * 3000), (7, 0, "user", "hi"), (7, 1, "assistant", "b"),
    ]
    said = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, start int")
    tree, leaves = chat.prefix_tree(said)
    back = {r["conv_id"]: r for r in chat.read_back(tree, leaves).collect()}
    order = sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
    for conv in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in order if r[0] == conv]
        assert [tuple(t) for t in back[conv]["turns"]] == mine
        assert back[conv]["loss"] == "".join(t for role, t in mine if role == "assistant")
    nodes = tree.orderBy("start").collect()
    assert sum(n["segment"] == "### user: hi</turn>\n" for n in nodes) == 2  # the shared first turn, and conversation 5's second
    assert [n["start"] for n in nodes] == list(np.cumsum([0, *(n["n_tokens"] for n in nodes)])[:-1])
    for n in nodes:
        assert sum(b - a for a, b in n["ancestors"]) == n["position"]
    whole = "".join(n["segment"] for n in nodes)
    for leaf in leaves.collect():  # attention sees just the conversation
        node = next(n for n in nodes if n["node"] == leaf["node"])
        seen = "".join(whole[a:b] for a, b in node["ancestors"]) + node["segment"]
        assert len(seen) == back[leaf["conv_id"]]["formatted_chars"]
    assert chat.read_back(*chat.prefix_tree(said.limit(0))).count() == 0


def test_neighbours_of_few_vectors_are_exact(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(400)] + [(i, [1.0] * 6) for i in range(400, 460)]
    rows += [(1000, None), (1100, [0.0] * 6), (1200, [1.0, None] * 3), (1300, [float("nan")] * 6), (1400, [1.0, 2.0]), (1500, [1.0, 3.0]), (None, [1.0] * 6), (400, [1.0] * 6)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    found = hilbert.neighbours(table, F.col("vec_id") % 100 == 0, curves=3).toPandas()
    points = {i: np.array(v) for i, v in rows[:460]}
    for q in range(0, 460, 100):
        far = sorted((float(np.sqrt(((v - points[q]) ** 2).sum())), i) for i, v in points.items() if i != q)[:10]
        mine = found[found["query_id"] == q].sort_values("rank")
        assert mine["vec_id"].tolist() == [i for _, i in far]
        assert np.allclose(mine["score"], [d for d, _ in far], rtol=1e-12)
    assert found[found["query_id"] == 1400]["vec_id"].tolist() == [1500]
    assert set(found["query_id"]) == {0, 100, 200, 300, 400, 1400, 1500}
    assert hilbert.neighbours(table.limit(0), F.lit(True)).count() == 0


def test_hilbert_curve_visits_neighbouring_cells():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = cells[np.argsort(hilbert.hilbert_keys(cells, 3))]
    assert sorted(hilbert.hilbert_keys(cells, 3).tolist()) == list(range(512))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_recall_against_brute_force(spark):
    draw = np.random.default_rng(5)
    points = draw.normal(size=(6000, 16)) + draw.normal(size=(10, 16)).repeat(600, axis=0) * 2
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    found = hilbert.neighbours(table, F.col("vec_id") % 100 == 0, window=600).toPandas()
    hits = 0
    for q in range(0, 6000, 100):
        far = ((points - points[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(set(np.argsort(far)[:10]) & set(found[found["query_id"] == q]["vec_id"]))
    assert hits >= 0.9 * 600


@pytest.mark.parametrize("size", [2000, 9000])
def test_neighbours_beyond_the_windows(spark, size):
    draw = np.random.default_rng(size)
    points = draw.normal(size=(size, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    found = hilbert.neighbours(table, F.col("vec_id") % 100 == 0, curves=2, window=30).toPandas().sort_values("rank")
    mine = found.groupby("query_id")["vec_id"].agg(list)
    for q in range(0, size, 100):
        far = ((points - points[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        assert mine[q] == np.argsort(far, kind="stable")[:10].tolist()


def toxic_texts(draw, n):
    words = ["".join(draw.choice("abcdefghijk") for _ in range(draw.randint(2, 7))) for _ in range(500)]
    rows = []
    for i in range(n):
        text, bad = [draw.choice(words) for _ in range(draw.randint(5, 150))], i % 3 == 0
        if bad:
            for _ in range(1 + len(text) // 40):
                text[draw.randrange(len(text))] = draw.choice(["zwimon", "zwiper", "quxlo"])
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_network_finds_toxic_texts(documents):
    rows = toxic_texts(random.Random(12), 900)
    net = toxicity.fit([t for _, t, _ in rows[:600]], np.array([y for _, _, y in rows[:600]]))
    docs = documents([(i, t, None, None) for i, t, _ in rows[600:]] + [(9000 + k, t, None, None) for k, t in enumerate(ODD)])
    found = {r["doc_id"]: r["toxicity"] for r in toxicity.score_texts(docs, net).collect()}
    right = sum((found[i] >= toxicity.CUT) == bool(y) for i, _, y in rows[600:])
    assert right >= 0.95 * 300
    assert found[9000] == found[9001] == found[9002] == 0 and all(0 <= x <= 1 for x in found.values())
    assert toxicity.score_texts(docs.limit(0), net).count() == 0


def test_gradients():
    net = toxicity.Network.fresh()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    w = toxicity.windows_of(*toxicity.flat(pa.array(["one two three " * 12, "four", "", None])))
    part, label = toxicity._some(w, np.arange(len(w.at))), np.array([1.0] * (len(w.at) - 1) + [0.0])
    loss = lambda: np.mean(np.logaddexp(0, net.forward(*part)) - label * net.forward(*part))
    for name, g in net.gradients(*part, label).items():
        value, at = net.p[name].reshape(-1), np.abs(g).argmax()
        value[at] += 1e-2
        up = loss()
        value[at] -= 2e-2
        assert abs((up - loss()) / 2e-2 - g.reshape(-1)[at]) < 1e-4, name
        value[at] += 1e-2


def test_every_window_is_scored():
    w = toxicity.windows_of(*toxicity.flat(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 23, 24, 25, 36, 37, 100)])))
    assert np.bincount(w.doc, minlength=8).tolist() == [0, 1, 1, 1, 2, 2, 3, 8]
    assert (w.at >= 0).any(axis=1).all()


def test_one_class_or_no_labels():
    for texts, labels in (([], []), (["a b"], [1]), (["a b", "c"], [0, 0])):
        assert (toxicity.fit(texts, np.array(labels, np.int64)).scores(*toxicity.flat(pa.array(["a b", "", None]))) >= 0).all()


def test_digest_of_ids(documents, tokens):
    path = tokens.path("byte_bpe_50k.tiktoken")
    row = bpe.digests(documents([(1, "Hello world", None, None)]), path, tokens.PATTERN).first()
    coder = bpe.Coder(open(path, "rb").read(), tokens.PATTERN)
    ids = coder.encode(["Hello world"])[0].tolist()
    assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(b"Hello world").hexdigest() and row["n_tokens"] == len(ids)


def test_training_from_windows_alone():
    texts, marks = [f"good w{k} day" if k % 2 else f"bad w{k} words" for k in range(30)], np.array([k % 2 for k in range(30)])
    w = toxicity._all_windows(*toxicity.flat(pa.array(texts)))
    assert w.word.itemsize == w.gram.itemsize == 2
    one, other = toxicity.learn(w, marks, rounds=2), toxicity.fit(texts, marks, rounds=2)
    assert all(np.array_equal(one.p[k], other.p[k]) for k in one.p)
    assert not len(toxicity._all_windows(*toxicity.flat(pa.array([], pa.string()))).at)
