"""The corpus pipeline keeps its promises at the smallest scale, and each registered query with SQL agrees with it."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from partledger.llm import toxicity
from partledger.llm.common import flat

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    corpus = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, docs
    for k, (_, stage) in enumerate(corpus.STAGES):
        before, seen = seen, corpus.checkpointed(stage(spark, seen, FOLDER))
        if k < len(corpus.STAGES) - 1:
            assert seen.columns == columns
        if k in (0, 1):
            assert seen.count() < before.count()
    assert seen.count() == before.count()


@pytest.mark.parametrize("name", ["op4_url_filters", "op8_chat_formatting"])
def test_sql(spark, name):
    from partledger.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    found = QUERIES[name](spark, FOLDER)
    wanted = con.execute(ORACLES[name])
    order = sorted(d[0] for d in wanted.description)
    place = [[d[0] for d in wanted.description].index(c) for c in order]
    rows = sorted((tuple(r[i] for i in place) for r in wanted.fetchall()), key=repr)
    assert sorted((tuple(r) for r in found.select(*order).collect()), key=repr) == rows


def test_whole_run_equals_plain_python(spark, tmp_path):
    """Stage by stage on a small corpus; only the network itself is taken from the library."""
    corpus, tokens = pytest.importorskip("corpus_pipeline"), pytest.importorskip("public_tokenizers")
    from tests.llm.test_dedup import brute_groups, brute_removed

    draw = random.Random(21)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 6))) for _ in range(900)]
    say = lambda n: " ".join(draw.choices(words, k=n))
    passage, texts = say(60), []
    for k in range(160):
        text = say(draw.randint(5, 60))
        if k % 6 == 0:
            text += " zzbad zzworse " + say(5) + " zzbad"
        if k % 5 == 0:
            text += " " + passage
        texts.append(text)
    texts += [texts[3], texts[4] + " more", None, "", texts[8]]
    rows = [(k, t, "en", draw.choice(["a", "b", None]), len(t or "")) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, 1, int(k % 6 == 0 and k < 160)) for k in range(len(rows)) if k % 2 == 0], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus.run(spark, str(tmp_path)).collect()

    net = toxicity.train(docs, labels)
    score = np.asarray(net.scores(*flat(pa.array(texts, pa.string()))))
    left = [(k, t) for (k, t, *_), x in zip(rows, score) if x < toxicity.CUT]
    assert 100 < len(left) < len(rows)
    groups = brute_groups(left)
    left = [(k, t) for k, t in left if (k, k) in {(d, c) for d, _, c in groups}]
    kept = {d: raw.decode("utf-8", "ignore") for d, raw, *_ in brute_removed(left)}
    sources, size = {k: s for k, _, _, s, _ in rows}, {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in kept.items()}
    weights = dict(zip(sorted({sources[d] for d in kept}, key=lambda s: (s is None, s or "")), (5, 2, 1)))
    total = Counter()
    for d in kept:
        total[sources[d]] += size[d]
    targets, free, rest = {}, dict(weights), 1.5 * sum(total.values())
    while free:
        share = {s: rest * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > 2 * total[s]]
        if not over:
            targets |= share
            break
        for s in over:
            targets[s] = 2.0 * total[s]
            rest -= targets[s]
            del free[s]
    import tiktoken

    ranks = dict(__import__("partledger.llm.bpe", fromlist=["Coder"]).Coder(open(tokens.path("byte_bpe_50k.tiktoken"), "rb").read(), tokens.PATTERN).ranks)
    coder = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    times, taken = Counter(r["doc_id"] for r in found), Counter()
    for r in found:
        text = kept[r["doc_id"]]
        ids = coder.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["source"] == sources[r["doc_id"]]
        taken[r["source"]] += size[r["doc_id"]]
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(size[d] for d in kept if sources[d] == s)
    for d in kept:
        if size[d]:
            ratio = targets[sources[d]] / total[sources[d]]
            assert int(ratio) <= times[d] <= int(ratio) + 1
