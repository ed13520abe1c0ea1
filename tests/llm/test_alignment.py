"""Alignment of two tokenizers against a plain version."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from partledger.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(texts, coders):
    a, b = coders
    letters = alignment.byte_letters()
    groups = []
    for t in texts:
        x, y = ([], []) if not t else (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t))
        spell_x = [bytes(letters[c] for c in a.id_to_token(k)) for k in x]
        spell_y = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in y]
        raw = (" " + (t or "")).encode()
        if not t or b"".join(spell_x) != raw or b"".join(spell_y) != raw:
            groups.append(([], [], []))
            continue
        ends_x, ends_y = ([sum(map(len, s[: k + 1])) for k in range(len(s))] for s in (spell_x, spell_y))
        found, p, q = [], 0, 0
        for e in sorted(set(ends_x) & set(ends_y)):
            i, j = ends_x.index(e) + 1, ends_y.index(e) + 1
            found.append((x[p:i], y[q:j]))
            p, q = i, j
        groups.append((x, y, found))
    linked = [[(m, n) for g in found for m in g[0] for n in g[1]] for _, _, found in groups]
    count = Counter(p for links in linked for p in set(links))
    top = {}
    for (m, _), n in count.items():
        top[m] = max(n, top.get(m, 0))
    out = []
    for (x, y, found), links in zip(groups, linked):
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in found)
        digest = hashlib.sha256(text.encode()).hexdigest() if found else ""
        out.append((len(x), len(y), len(found), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest))
    return out


ODD = [
    None,
    "",
    " ",
    "\n\n  two  spaces\tand tab ",
    "<|endoftext|> </s> <s> <unk> <0x41>",
    "a▁b",
    "中文字符 and ไทย ภาษา 🙂🙂🙃 é",
    "ﬁ ½ ① ｆｕｌｌ",
    "x" * 700,
    "\x00 \x01 zero",
    "the cat sat on the mat " * 5,
]


def corpus():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghinorstuéü中", k=rng.randint(1, 11))) for _ in range(150)] + ["the", "and", "of"] * 20
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) + rng.choice(["", ".", "\n", " 12345"]) for _ in range(80)]
    return texts + ODD + [texts[0], texts[0], "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3000))]


def test_equals_plain_version(documents, coders):
    texts = corpus()
    frame = documents([(k, t, None, None) for k, t in enumerate(texts)]).repartition(4)
    done = alignment.align_tokenizers(frame, A, B)
    got = {r["doc_id"]: tuple(r[c] for c in alignment.ADDED) for r in done.collect()}
    assert got == dict(enumerate(brute(texts, coders)))


def test_windows_of_one_hash_and_forgetting(documents, coders, monkeypatch):
    texts = corpus()[:40]
    pair = alignment.Pair(open(A, "rb").read(), open(B, "rb").read())
    plain = alignment._block(pair, texts)
    monkeypatch.setattr(alignment, "MEMO_ENTRIES", 10)
    monkeypatch.setattr(alignment, "run_hashes", lambda values, first, last: (last - first).astype("uint64"))
    for _ in range(2):
        again = alignment._block(pair, texts)
        assert again[0]["groups_sha256"] == plain[0]["groups_sha256"] and again[1].tolist() == plain[1].tolist() and again[2].tolist() == plain[2].tolist()


def test_words_are_encoded_once(coders, monkeypatch):
    """The byte-level tokenizer meets a word again only after forgetting; ids are those of whole texts, odd white space included."""
    rng = random.Random(9)
    letters = "ab'sT .,!\n\t\r\x0b\x0c\x1c\x1d\x1f\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\u200b\ufeff1½é中\x00🙂"
    texts = ["".join(rng.choices(letters + " " * rng.choice([1, 5, 20]), k=rng.randint(1, 60))) for _ in range(3000)] + corpus()[:80]
    want = [x.ids for x in coders[0].encode_batch([" " + (t or "") for t in texts], add_special_tokens=False)]
    pair = alignment.Pair(open(A, "rb").read(), open(B, "rb").read())
    met, library = [], pair.a

    class Counted:
        def encode_batch_fast(self, words, **options):
            met.extend(words)
            return library.encode_batch_fast(words, **options)

    pair.a = Counted()
    for limit in (alignment.KNOWN_BYTES, 1 << 16):
        monkeypatch.setattr(alignment, "KNOWN_BYTES", limit)
        for part in (texts[:1000], texts[1000:], texts):
            ids, bounds, spelled = pair.encode(part)
            first = texts.index(part[0])
            assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == want[first : first + len(part)] and spelled.all()
        if limit > 1 << 16:
            assert len(met) == len(set(met)) and sum(map(len, met)) < sum(map(len, texts))
    assert len(met) > len(set(met))


def test_other_rules_take_whole_texts():
    file = json.loads(open(A).read())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": file["pre_tokenizer"] | {"use_regex": False}}):
        pair = alignment.Pair(json.dumps(file | change).encode(), open(B, "rb").read())
        text = " the cat  sat e\u0301 on\u00a0 it"
        ids, bounds, spelled = pair.encode([text[1:], text[1:]])
        want = pair.a.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and bounds.tolist() == [0, len(want), 2 * len(want)]


def test_packed_lists():
    values = np.array([0, 1, 65534, 65535, 65536, 131070, 200_000, 7])
    cuts = np.array([0, 0, 3, 6, 6, 8])
    found, again = alignment.unpacked(alignment.packed(values, cuts))
    assert found.tolist() == values.tolist() and again.tolist() == cuts.tolist()


def test_clashing_columns_nulls_and_empty_table(documents):
    frame = documents([(None, "same text", None, None), (1, "same text", None, None), (1, "same text", None, None), (2, None, None, None)])
    frame = frame.withColumns({c: F.lit(f"own {c}") for c in ("block", "slot", "names", "docs", "pairs", "n_a", "N_LINKS")}).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    rows = alignment.align_tokenizers(frame, A, B).collect()
    assert len(rows) == 4 and {r["block"] for r in rows} == {"own block"} and rows[0]["m"] == {"k": 1}
    assert sorted((r["n_links"], r["n_best"], r["count_sum"]) for r in rows) == [(0, 0, 0)] + [(2, 2, 6)] * 3
    assert alignment.align_tokenizers(frame.limit(0), A, B).collect() == []


def test_query(spark, coders):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {(d, *x) for (d, _), x in zip(rows, brute([t for _, t in rows], coders))}
    assert {tuple(r) for r in alignment.op11_tokenizer_alignment(spark, folder).collect()} == want
