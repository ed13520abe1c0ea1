"""Cross-tokenizer alignment by whitespace-token anchors.

Both tokenizers encode the whole text. A byte offset where a token of each ends, and where the next token of each is marked as
starting with a space (or the text ends), is an anchor. Anchors split a document into windows of token ids; documents are
made of few different windows, so a window's alignment is found once and remembered by its two id tuples. So are the byte-level
ids of a word with the white space before it, where the vocabulary's own rule always cuts. Pairs of linked ids are
numbered inside blocks of documents, so that counting and looking up meets each pair once a block and not once a document.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from partledger.llm.common import MIX, _power_tables, checkpointed, flat, mixed, slices, start, table

BLOCK_BYTES = 1 << 20  # about so much text is a block
CACHED_WORDS = 50_000  # that the byte-level tokenizer remembers
KNOWN_BYTES = 64 << 20  # about what a worker takes to remember words' byte-level ids; beyond that it forgets them all and goes on
WORD_BYTES = 200  # what a remembered word takes beside its letters and ids
# White space, then a word. The rule of byte-level vocabularies starts a token at every white space that follows something else, and
# does not look back. A cut comes before ASCII white space only, because versions differ in what else they count as white space.
WORD = re.compile(r"\s*\S+(?:[^\S \t\n\r\f\v]\s*\S*)*|\s+").findall
MORE = 0xFFFF
MEMO_ENTRIES = 1_000_000  # ids and links that a worker remembers; beyond that it forgets all windows and goes on
BLOCK = (
    "block bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs binary, times binary, names array<bigint>, docs array<int>"
)
ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers and the bytes of their tokens; remembers aligned windows."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(byte_level.decode())
        whole = json.loads(byte_level)
        model, rule = whole["model"], whole.get("pre_tokenizer") or {}
        plain = not (whole.get("normalizer") or whole.get("truncation") or whole.get("padding") or model.get("dropout"))
        plain = plain and all(x.get("special") for x in whole.get("added_tokens") or [])
        own_rule = rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space", True)
        self.cut = WORD if plain and own_rule else lambda text: [text]  # what another rule does at white space is not known
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        self.a.model = tokenizers.models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=CACHED_WORDS)  # the same with more room
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            self.bytes_a[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(x[3:5], 16)]) if self.b.is_byte(k) else x.replace("▁", " ").encode() for k, x in enumerate(names)]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.marked_a, self.marked_b = (np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b))
        written = [b"%d," % k for k in range(max(len(names), len(self.bytes_a)))]  # an id and room for what parts it from the next
        self.digits = np.frombuffer(b"".join(written), np.uint8)
        self.size = np.array([len(x) for x in written], np.int64)
        self.place = np.cumsum(self.size) - self.size
        self._forget()
        self._forget_words()

    def _forget_words(self) -> None:
        self.words: dict[str, int] = {}  # number of each word; its ids stand in ``tokens`` from ``starts`` on
        self.tokens, self.starts = array("i"), array("q", [0])
        self.spelled = bytearray()  # whether the word's ids spell it
        self.letters = 0

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.text: list[bytes] = []  # of a window's groups
        self.groups = array("q")
        self.names, self.at = array("q"), array("q", [0])  # the links of all windows, as id pairs

    def _held(self, more: int = 0) -> int:
        return (len(self.words) + more) * WORD_BYTES + self.letters + 4 * len(self.tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte-level ids of a space and each text, the offset of each text's, and whether the ids spell each of its words."""
        cut = [self.cut(" " + t) for t in texts]
        words = list(chain.from_iterable(cut))
        distinct = set(words)
        fresh = list(distinct.difference(self.words))
        if fresh and self._held(len(fresh)) > KNOWN_BYTES:
            self._forget_words()
            fresh = list(distinct)
        for word, coded in zip(fresh, self.a.encode_batch_fast(fresh, add_special_tokens=False)):
            ids, raw = coded.ids, word.encode("utf-8", "replace")
            self.words[word] = len(self.words)
            self.letters += len(raw)
            self.tokens.extend(ids)
            self.starts.append(len(self.tokens))
            self.spelled.append(spells(self.bytes_a, ids, raw))
        number = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        starts = np.array(self.starts, np.int64)
        first, last = starts[number], starts[number + 1]
        ids = np.array(self.tokens, np.int32)[ranges(first, last)]
        bounds = np.cumsum([0, *map(len, cut)])
        wrong = np.append(0, np.cumsum(np.array(self.spelled)[number] == 0))[bounds]
        if self._held() > KNOWN_BYTES:  # a very long text
            self._forget_words()
        return ids, np.append(0, np.cumsum(last - first))[bounds], np.diff(wrong) == 0

    def align(self, a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> None:
        """Cut windows (runs of ids of the given sizes) where tokens of both end, and remember their groups and links."""
        count = len(size_a)
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        ends = np.zeros((2, int(end_a[-1]) + 1), bool)
        ends[0, end_a], ends[1, end_b] = True, True
        last_a, last_b = ends[1, end_a], ends[0, end_b]  # tokens that end a group
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        many_a, many_b = np.bincount(of_a), np.bincount(of_b)
        window = np.repeat(np.arange(count), size_a)
        # links: every token of A with all tokens of B of its group
        each = many_b[of_a]
        first_b = np.cumsum(many_b) - many_b
        other = np.repeat(first_b[of_a] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        names = np.repeat(a.astype(np.int64) << 32, each) | b[other]
        # text: the ids of a group's A tokens, then of its B tokens
        at_a, at_b = np.arange(len(a)) + first_b[of_a], np.arange(len(b)) + np.cumsum(many_a)[of_b]
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        after[at_a[last_a]], after[at_b[last_b]] = ord("|"), ord(";")
        wide = self.size[ids]
        end = np.cumsum(wide)
        text = self.digits[np.repeat(self.place[ids] - (end - wide), wide) + np.arange(end[-1])]
        text[end - 1] = after
        text, stops = text.tobytes(), end[np.cumsum(size_a + size_b) - 1].tolist()
        start = 0
        for stop in stops:
            self.text.append(text[start : stop - 1])
            start = stop
        self.groups.frombytes(np.bincount(window[last_a], minlength=count).astype(np.int64).tobytes())
        links = np.cumsum(np.bincount(window, each, count).astype(np.int64)) + self.at[-1]
        self.at.frombytes(links.tobytes())
        self.names.frombytes(names.tobytes())

    def windows(self, first_a, last_a, ids_a, first_b, last_b, ids_b) -> np.ndarray:
        """The number of each window, a pair of runs of ids; new ones are aligned."""
        if len(self.number) and len(self.names) + len(self.number) > MEMO_ENTRIES:
            self._forget()
        name = run_hashes(ids_a, first_a, last_a) * MIX + run_hashes(ids_b, first_b, last_b)
        _, one, each = np.unique(name, return_index=True, return_inverse=True)
        if not (same_runs(ids_a, first_a, last_a, one[each]) and same_runs(ids_b, first_b, last_b, one[each])):
            one = each = np.arange(len(name))  # two windows of one hash: look every window up
        sides = ((ids_a, first_a[one], last_a[one]), (ids_b, first_b[one], last_b[one]))
        size_a, size_b = (last - first for _, first, last in sides)
        end = np.cumsum(size_a + 1 + size_b)
        start = end - (size_a + 1 + size_b)
        keys = np.full(end[-1], -1, np.int32)  # both id tuples of each window, with -1 between them
        for (ids, first, last), at, size in zip(sides, (start, start + size_a + 1), (size_a, size_b)):
            keys[ranges(at, at + size)] = ids[ranges(first, last)]
        raw = keys.tobytes()
        keys = [raw[i:j] for i, j in zip((4 * start).tolist(), (4 * end).tolist())]
        found = list(map(self.number.get, keys))
        fresh = []
        for k in [k for k, at in enumerate(found) if at is None]:
            known = len(self.number)
            found[k] = self.number.setdefault(keys[k], known)
            if len(self.number) > known:
                fresh.append(k)
        if fresh:
            new = one[fresh]
            runs = []
            for ids, first, last in ((ids_a, first_a[new], last_a[new]), (ids_b, first_b[new], last_b[new])):
                runs += [ids[ranges(first, last)], last - first]
            self.align(*runs)
        return np.array(found, np.int64)[each]


def spells(names: list[bytes], ids: list[int], raw: bytes) -> bool:
    return b"".join(map(names.__getitem__, ids)) == raw


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of all runs ``first`` … ``last - 1``, one run after the other."""
    size = last - first
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def run_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``first`` … ``last - 1`` of values."""
    power, inverse = _power_tables(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed(values.astype(np.uint64) + MIX) * power[: len(values)], out=total[1:])
    return mixed((total[last] - total[first]) * inverse[first] + (last - first).astype(np.uint64) * MIX)


def same_runs(values: np.ndarray, first: np.ndarray, last: np.ndarray, other: np.ndarray) -> bool:
    """Whether every run of values equals the run of number ``other``."""
    size = last - first
    if not np.array_equal(size, size[other]):
        return False
    return bool(np.array_equal(values[ranges(first, last)], values[ranges(first[other], last[other])]))


def _window_ends(pair: Pair, ids_a, ids_b, doc_ends) -> tuple[np.ndarray, np.ndarray]:
    """Of every window the number of tokens up to its end, for both tokenizers. ``doc_ends``: bytes up to each document's end."""
    end_a, end_b = np.cumsum(pair.length_a[ids_a]), np.cumsum(pair.length_b[ids_b])
    size = int(doc_ends[-1]) + 1
    shared, opens = np.zeros(size, bool), np.zeros(size, bool)
    shared[end_b] = True
    opens[(end_b - pair.length_b[ids_b])[pair.marked_b[ids_b]]] = True
    both = np.zeros(size, bool)
    both[(end_a - pair.length_a[ids_a])[pair.marked_a[ids_a]]] = True
    opens &= both
    opens[doc_ends] = True
    shared &= opens
    return np.flatnonzero(shared[end_a]) + 1, np.flatnonzero(shared[end_b]) + 1


def _block(pair: Pair, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
    """Columns of the documents of a block, the block's linked id pairs and in how many of its documents each is."""
    count = len(texts)
    rows = [k for k, t in enumerate(texts) if t]
    coded_a, bounds_a, spelled = pair.encode([texts[k] for k in rows])
    coded_b = pair.b.encode([texts[k] for k in rows], num_threads=1)
    raw = [b" " + texts[k].encode("utf-8", "replace") for k in rows]
    good = [
        n
        for n in range(len(rows))
        if spells(pair.bytes_b, coded_b[n], raw[n])
        and (spelled[n] or spells(pair.bytes_a, coded_a[bounds_a[n] : bounds_a[n + 1]].tolist(), raw[n]))
    ]
    numbers = {c: np.zeros(count, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digests = [""] * count
    if not good:
        none = np.zeros(0, np.int64)
        empty = pa.array([b""] * count, pa.binary())
        return numbers | {"groups_sha256": digests, "pairs": empty, "times": empty}, none, none
    doc = np.array([rows[n] for n in good])
    each_a, each_b = np.diff(bounds_a)[good], np.array([len(coded_b[n]) for n in good])
    ids_a = coded_a[ranges(bounds_a[:-1][good], bounds_a[1:][good])]
    ids_b = np.fromiter(chain.from_iterable(coded_b[n] for n in good), np.int32, each_b.sum())
    last_a, last_b = _window_ends(pair, ids_a, ids_b, np.cumsum([len(raw[n]) for n in good]))
    first_a, first_b = np.append(0, last_a[:-1]), np.append(0, last_b[:-1])
    number = pair.windows(first_a, last_a, ids_a, first_b, last_b, ids_b)
    cuts = np.append(0, np.searchsorted(last_a, np.cumsum(each_a)) + 1)  # windows of each document
    groups, at = np.array(pair.groups, np.int64), np.array(pair.at, np.int64)
    numbers["n_a"][doc], numbers["n_b"][doc] = each_a, each_b
    numbers["n_groups"][doc] = np.add.reduceat(groups[number], cuts[:-1])
    numbers["n_links"][doc] = np.add.reduceat(np.diff(at)[number], cuts[:-1])
    spelled = list(map(pair.text.__getitem__, number.tolist()))
    for k, (p, q) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        digests[doc[k]] = hashlib.sha256(b";".join(spelled[p:q])).hexdigest()
    # linked pairs of every document, each once with its number of links
    used, own = np.unique(number, return_inverse=True)
    size = np.diff(at)[used]
    names, slot = np.unique(np.frombuffer(pair.names, np.int64)[ranges(at[used], at[used + 1])], return_inverse=True)
    ends = np.cumsum(size)
    wide = size[own]
    place = ranges((ends - size)[own], ends[own])
    key = np.sort(np.repeat(np.repeat(np.arange(len(doc)), np.diff(cuts)), wide) * len(names) + slot[place])
    fresh = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    links = np.diff(np.append(fresh, len(key)))
    holder, held = np.divmod(key[fresh], len(names))
    bounds = np.zeros(count + 1, np.int64)
    bounds[doc + 1] = np.bincount(holder, minlength=len(doc))
    bounds = np.cumsum(bounds)
    steps = held - np.append(0, held[:-1])
    opens = bounds[:-1][np.diff(bounds) > 0]
    steps[opens] = held[opens]
    lists = {"pairs": packed(steps, bounds), "times": packed(links, bounds)}
    return numbers | {"groups_sha256": digests} | lists, names, np.bincount(held, minlength=len(names))


def packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Lists of small whole numbers in two bytes each; a number of ``MORE`` or above takes another two for each ``MORE`` in it."""
    each = values // MORE + 1
    out = np.full(each.sum(), MORE, "<u2")
    ends = np.cumsum(each)
    out[ends - 1] = values % MORE
    offsets = 2 * np.append(0, ends)[cuts]
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of ``packed`` lists and where each list begins."""
    data, offsets = flat(column)
    parts = np.frombuffer(data.tobytes(), "<u2").astype(np.int64)
    last = parts != MORE
    ends = np.flatnonzero(last)
    total = np.append(0, np.cumsum(parts))[ends + 1]
    return np.diff(np.append(0, total)), np.append(0, np.cumsum(last))[offsets // 2]


_pairs: dict[str, Pair] = {}


def _pair(shared) -> Pair:
    files = shared.value
    key = hashlib.sha256(b"".join(files)).hexdigest()
    if key not in _pairs:
        _pairs.clear()
        _pairs[key] = Pair(*files)
    return _pairs[key]


def _aligned(shared, fields: list[str]):
    """Rows of documents (``names`` null) and one row with the linked pairs of each block (``row`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, block = _pair(shared), TaskContext.get().partitionId() << 32
        kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        for batch in batches:
            for i, j in slices(flat(batch["text"])[1], BLOCK_BYTES):
                columns, names, docs = _block(pair, batch["text"][i:j].to_pylist())
                count = j - i
                own = [pa.array(np.full(count, block)), *(pa.array(columns[c]) for c in fields), pa.nulls(count, kinds[8]), pa.nulls(count, kinds[9])]
                schema = ["row", "block", *fields, "names", "docs"]
                yield pa.RecordBatch.from_arrays([batch["row"][i:j], *own], schema)
                if len(names):
                    rest = [pa.nulls(1, k) for k in kinds[1:8]]
                    pairs = [pa.array([names.tolist()], kinds[8]), pa.array([docs.tolist()], kinds[9])]
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, batch["row"].type), pa.array([block]), *rest, *pairs], schema)
                block += 1

    return run


def _scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over each document's links of what is known of the pairs of its block."""
    size = 1 + max(np.asarray(pairs["slot"]), default=-1)
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    slot = np.asarray(pairs["slot"])
    count[slot], best[slot] = np.asarray(pairs["count"]), np.asarray(pairs["best"])
    (steps, cuts), (times, _) = unpacked(docs["pairs"]), unpacked(docs["times"])
    place = np.cumsum(steps)
    place -= np.repeat(np.append(0, place)[cuts[:-1]], np.diff(cuts))
    sums = [np.concatenate([[0], np.cumsum(times * x[place])]) for x in (best, count)]
    values = [pa.array(x[cuts[1:]] - x[cuts[:-1]]) for x in sums]
    columns = {c: docs[c] for c in ("row", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(columns | {"n_best": values[0], "count_sum": values[1], "groups_sha256": docs["groups_sha256"]})


def align_tokenizers(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """``docs`` (``text, …``) with how the tokens of two tokenizers of each text fit together.

    A is the byte-level vocabulary, which encodes a space and the text; B the vocabulary of pieces, which adds the space itself.
    Special tokens' strings are plain text. Byte offsets where tokens of both end cut them into groups (``n_groups``); all A-B
    pairs of occurrences in a group are links (``n_links``). The count of an id pair says in how many rows it is linked;
    ``n_best`` are the links whose pair has the highest count of its A id (ties included), ``count_sum`` is the counts' sum over
    the links. ``groups_sha256`` digests ``a1,a2|b1;a3|b2,b3``: decimal ids of both, group by group.

    Null and empty texts, and texts that the tokens of A or B do not spell exactly, have no tokens: zeros and an empty digest.
    Texts of any length are taken whole. Every row is a document, so repeated rows count as often as they are there. An empty
    table gives an empty result. Other columns stay; columns with one of the seven names are replaced. Both files are read by the
    driver and sent to the workers; their size does not depend on the corpus.
    """
    spark = docs.sparkSession
    start(spark)
    files = []
    for path in (byte_level_path, piece_path):
        with open(path, "rb") as file:
            files.append(file.read())
    shared = spark.sparkContext.broadcast(tuple(files))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    row = StructField("row", rows.schema["row"].dataType)
    schema = StructType([row, *StructType.fromDDL(BLOCK).fields])
    marked = checkpointed(rows.mapInArrow(_aligned(shared, schema.names[2:-2]), schema))
    blocks = marked.where("names IS NOT NULL").select("block", F.posexplode(F.arrays_zip("names", "docs")).alias("slot", "pair"))
    blocks = blocks.select("block", "slot", F.col("pair.names").alias("name"), F.col("pair.docs").alias("n"))
    counts = blocks.groupBy("name").agg(F.sum("n").alias("count"))
    own = Window.partitionBy(F.shiftright("name", 32))  # the pairs of one A id: at most as many as B has ids
    known = checkpointed(counts.select("name", "count", (F.col("count") == F.max("count").over(own)).alias("best")))
    pairs = blocks.select("block", "slot", "name").join(known, "name").select(F.col("block").alias("of"), "slot", "count", F.col("best").cast("long").alias("best"))
    given = marked.where("names IS NULL").drop("names", "docs")
    schema = StructType([given.schema["row"]])
    for field in ADDED:
        schema = schema.add(field, "string" if field == "groups_sha256" else "long")
    done = given.groupBy("block").cogroup(pairs.groupBy("of")).applyInArrow(_scored, schema)
    others = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ADDED]
    return done.select(*others, *ADDED)


def op11_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", *ADDED)
