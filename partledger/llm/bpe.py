"""Byte-level BPE by recursive DuckDB queries inside each partition."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from partledger.llm.common import slices, start, table

KNOWN_BYTES = 96 << 20  # about what a worker takes to remember the tokens of pieces; beyond that it forgets them all and goes on
PIECE_BYTES = 180  # what a remembered piece takes beside its letters and tokens
QUERY_BYTES = 1 << 17  # about so many bytes of new pieces go into one recursive query
QUERY_MB = 200  # memory of DuckDB; a longer piece gets LONG_BYTES for each of its bytes
LONG_BYTES = 600
SHORT_BYTES = 32  # pieces up to here take one contraction a round
DECODE_IDS = 1 << 18  # about so many ids go into one decoding query
SLICE_CHARS = 1 << 19

# Each round contracts every piece's leftmost pair of lowest rank; a piece without a pair drops out. ``key`` is a token's piece and its
# place there, so one sort by one number finds every follower (a window for each piece takes three times as long).
ENCODE = """
WITH RECURSIVE work(round, key, token) AS (
  SELECT 0, piece::BIGINT << 32 | pos, token FROM symbols
  UNION ALL
  SELECT round + 1, key, token FROM (
    WITH pairs AS (
      SELECT w.*, m.merged, key >> 32 AS piece, m.merged::BIGINT << 32 | (key & 4294967295) AS pair FROM (
        SELECT *, lead(token) OVER seq AS follower, lead(key) OVER seq AS eaten FROM work WINDOW seq AS (ORDER BY key)) w
      LEFT JOIN merges m ON m.a = w.token AND m.b = w.follower AND eaten >> 32 = key >> 32),
    lowest AS (SELECT piece, min(pair) AS least, arg_min(eaten, pair) AS eaten FROM pairs WHERE merged IS NOT NULL GROUP BY piece)
    SELECT round, key, CASE WHEN pair = least THEN merged ELSE token END AS token
    FROM pairs p JOIN lowest USING (piece) WHERE p.key <> lowest.eaten))
SELECT w.key >> 32 AS piece, list(token ORDER BY key) AS tokens
FROM work w JOIN (SELECT key >> 32 AS piece, max(round) AS round FROM work GROUP BY 1) l ON w.key >> 32 = l.piece AND w.round = l.round GROUP BY 1"""

# The same for long pieces, many contractions a round. A pair of rank r may be contracted at once if no pair of lower rank stands so
# near that tokens growing from there by lower merges could touch it: ``reach`` is the longest token of lower rank. Of pairs of rank
# r near each other only the first is, or, if no merge with the new token has a lower rank (``safe``), every other one of a
# row of overlapping pairs from its start on. So the order that one contraction a round has is kept where it matters.
# The keyed recursion holds one row a place and meets the pieces that have just changed; a contracted pair's second token becomes -1.
ENCODE_LONG = """
WITH RECURSIVE work(piece, pos, token) USING KEY (piece, pos) AS (
  SELECT piece, pos, token FROM symbols
  UNION
  SELECT piece, pos, CASE WHEN eaten THEN -1 WHEN taken THEN merged ELSE token END FROM (
    SELECT *, coalesce(lag(taken) OVER (PARTITION BY piece ORDER BY pos), false) AS eaten FROM (
      SELECT *, hit AND (low = pair OR safe AND NOT first_value(follows) OVER island AND row_number() OVER island % 2 = 1) AS taken FROM (
        SELECT *, place - row_number() OVER (PARTITION BY piece, hit ORDER BY pos) AS island FROM (
          SELECT *, coalesce(low >> 32 = merged, false) AS hit, coalesce(lag(merged) OVER (PARTITION BY piece ORDER BY pos) = merged, false) AS follows
          FROM (
            SELECT *, max(merged) OVER (PARTITION BY piece) AS any_pair, min(pair) OVER (
              PARTITION BY piece ORDER BY pos RANGE BETWEEN coalesce(greatest(reach, back), 0) PRECEDING AND coalesce(reach + size, 0) FOLLOWING) AS low
            FROM (
              SELECT w.*, m.merged, m.safe, m.reach, m.size, m.merged::BIGINT << 32 | w.pos AS pair
              FROM (SELECT piece, pos, token, lead(token) OVER seq AS follower, row_number() OVER seq AS place, pos - lag(pos, 1, pos) OVER seq AS back
                    FROM recurring.work WHERE token >= 0 AND piece IN (SELECT piece FROM work) WINDOW seq AS (PARTITION BY piece ORDER BY pos)) w
              LEFT JOIN merges m ON m.a = w.token AND m.b = w.follower))
          WHERE any_pair IS NOT NULL))
      WINDOW island AS (PARTITION BY piece, hit, island ORDER BY pos)))
  WHERE taken OR eaten)
SELECT piece, list(token ORDER BY pos) AS tokens FROM work WHERE token >= 0 GROUP BY piece"""

# Every byte is the letter of its number (Latin-1).
DECODE = """
SELECT doc, string_agg(letters, '' ORDER BY pos) AS letters FROM ids JOIN vocabulary USING (token) GROUP BY doc"""


class Coder:
    """Ranks, the merge table and a DuckDB connection; one per Python worker."""

    def __init__(self, lines: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines.splitlines())}
        self.split = regex.compile(pattern).findall
        self._forget()
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": f"{QUERY_MB}MB", "temp_directory": ""})
        lowest: dict[int, int] = {}
        rows = []
        reach = list(accumulate((len(t) for t, _ in sorted(self.ranks.items(), key=lambda x: x[1])), max, initial=0))
        order = {r: k for k, r in enumerate(sorted(self.ranks.values()))}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    rows.append((a, b, rank, reach[order[rank]], len(token)))
                    lowest[a], lowest[b] = min(rank, lowest.get(a, rank)), min(rank, lowest.get(b, rank))
        columns = (pa.array(x, pa.int32()) for x in (zip(*rows) if rows else [[]] * 5))
        safe = pa.array([lowest.get(r[2], r[2]) >= r[2] for r in rows], pa.bool_())
        self._table("merges", **dict(zip(("a", "b", "merged", "reach", "size"), columns)), safe=safe)
        self._table("vocabulary", token=pa.array(self.ranks.values(), pa.int32()), letters=pa.array([t.decode("latin-1") for t in self.ranks]))
        self.written = {r: str(r) for r in self.ranks.values()}

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # number of each piece; its tokens stand in ``tokens`` from ``at`` on
        self.tokens, self.at = array("i"), array("q", [0])
        self.letters = 0

    def _keep(self, piece: str, tokens: Iterable[int]) -> None:
        self.known[piece] = len(self.known)
        self.letters += len(piece)
        self.tokens.extend(tokens)
        self.at.append(len(self.tokens))

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _learn(self, pieces: list[str]) -> None:
        """Find the tokens of new pieces; a piece that is a token itself is taken as such."""
        short, long = [], []
        for piece in pieces:
            data = piece.encode("utf-8", "replace")
            token = self.ranks.get(data)
            if token is not None:
                self._keep(piece, [token])
            else:
                (short if len(data) <= SHORT_BYTES else long).append((piece, data))
        for kind in (short, long):
            for a, b in slices(np.cumsum([0, *(len(x[1]) for x in kind)]), QUERY_BYTES):
                self._contract(*zip(*kind[a:b]))

    def _contract(self, names: tuple[str, ...], run: tuple[bytes, ...]) -> None:
        one = [self.ranks[bytes([k])] for k in range(256)]
        lengths = np.array([len(x) for x in run])
        piece = np.repeat(np.arange(len(run), dtype=np.int32), lengths)
        pos = (np.arange(len(piece)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        token = np.array(one, np.int32)[np.frombuffer(b"".join(run), np.uint8)]
        self._table("symbols", piece=pa.array(piece), pos=pa.array(pos), token=pa.array(token))
        longest = int(lengths.max())
        if wide := longest * LONG_BYTES > QUERY_MB << 20:
            self.db.execute(f"SET memory_limit = '{longest * LONG_BYTES >> 20}MB'")
        found = self.db.sql(ENCODE if longest <= SHORT_BYTES else ENCODE_LONG).to_arrow_table().combine_chunks().to_batches()[0]
        if wide:
            self.db.execute(f"SET memory_limit = '{QUERY_MB}MB'")
        sizes = found["tokens"].value_lengths().to_numpy()
        self.known.update(zip(map(names.__getitem__, found["piece"].to_pylist()), range(len(self.known), len(self.known) + len(sizes))))
        self.letters += sum(map(len, names))
        self.at.frombytes((np.cumsum(sizes, dtype=np.int64) + len(self.tokens)).tobytes())
        self.tokens.frombytes(found["tokens"].flatten().to_numpy().astype(np.int32).tobytes())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offset of each text."""
        split = [self.split(t) if t else [] for t in texts]
        pieces = list(chain.from_iterable(split))
        distinct = set(pieces)
        missing = distinct.difference(self.known)
        held = (len(self.known) + len(missing)) * PIECE_BYTES + self.letters + 4 * len(self.tokens)
        if missing and held > KNOWN_BYTES:
            self._forget()
            missing = distinct
        self._learn(list(missing))
        number = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        at = np.array(self.at, np.int64)
        first, size = at[number], at[number + 1] - at[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = np.array(self.tokens, np.int32)[np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)]
        return ids, ends[np.cumsum([0, *map(len, split)])]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids."""
        doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        self._table("ids", doc=pa.array(doc), pos=pa.array(np.arange(len(ids), dtype=np.int32)), token=pa.array(ids))
        out = [b""] * (len(offsets) - 1)
        for k, letters in self.db.execute(DECODE).fetchall():
            out[k] = letters.encode("latin-1")
        return out

    def written_ids(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by a space."""
        return " ".join(map(self.written.__getitem__, ids.tolist())).encode()


_coders: dict[tuple[str, str], Coder] = {}


def _coder(shared, pattern: str) -> Coder:
    lines = shared.value
    key = (hashlib.sha256(lines).hexdigest(), pattern)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(lines, pattern)
    return _coders[key]


def _text_runs(texts: list[str | None]) -> Iterator[list[str | None]]:
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` plus ``ids``, an array of token ids of ``text``.

    ``ranks_path`` names a rank file (base64 token, rank) that the driver reads; it holds about a megabyte whatever the
    corpus and is sent to the workers. A column that is called ``ids`` is replaced. Null and empty texts give no ids. Words of any
    length are contracted whole (about ``LONG_BYTES`` of memory for each byte of a very long word). Repeated rows give equal ids;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    start(spark)
    with open(ranks_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    kept = [c for c in docs.columns if c.lower() != "ids"]
    schema = StructType([docs.schema[c] for c in kept] + [StructField("ids", ArrayType(IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for batch in batches:
            at = 0
            for texts in _text_runs(batch["text"].to_pylist()):
                ids, offsets = coder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                rows = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), lists], [*kept, "ids"])

    return docs.select(*kept).mapInArrow(run, schema)


def decode(coded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``coded`` with its column ``ids`` (null: none) replaced by ``decoded``, the bytes they stand for.

    Repeated rows give equal bytes; an empty table gives an empty result.
    """
    spark = coded.sparkSession
    start(spark)
    with open(ranks_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    kept = [c for c in coded.columns if c.lower() not in ("ids", "decoded")]
    schema = StructType([coded.schema[c] for c in kept] + [StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for batch in batches:
            lists = batch["ids"].fill_null([])
            offsets = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
            flat_ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            for a, b in slices(offsets, DECODE_IDS):
                data = coder.decode(flat_ids[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in kept), pa.array(data, pa.binary())], [*kept, "decoded"])

    return coded.select(*kept, "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep, n_tokens, ids_sha256, decoded_sha256``: every text encoded and its ids decoded again, in one worker.

    Null and empty texts have no ids and the digests of nothing. Words of any length are contracted whole. Repeated rows give
    equal rows; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    start(spark)
    with open(ranks_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    schema = docs.select(*keep).schema.add("n_tokens", "long", False).add("ids_sha256", "string", False).add("decoded_sha256", "string", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for batch in batches:
            counts, digests, back = [], [], []
            for texts in _text_runs(batch["text"].to_pylist()):
                ids, offsets = coder.encode(texts)
                counts += np.diff(offsets).tolist()
                digests += [hashlib.sha256(coder.written_ids(ids[i:j])).hexdigest() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                for i, j in slices(offsets, DECODE_IDS):
                    found = coder.decode(ids[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    back += [hashlib.sha256(x).hexdigest() for x in found]
            results = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *results], [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def op2_byte_level_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
