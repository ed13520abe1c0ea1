"""Chat formatting as a prefix tree: shared first turns are written once, depth first.

The template writes a turn as ``### role: text</turn>`` and a line break. Inside roles and texts the characters that
control strings are made of are escaped: ``\\`` as ``\\s``, ``<`` as ``\\l``, ``#`` as ``\\h`` and, in roles, ``:`` as ``\\c``,
so no text can contain a control string. A token is one character of the formatted text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from partledger.llm.common import checkpointed, running_total, start, table

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))
NODE = 16  # bytes of a node's name; a path is the names from the root on

TURN = "conv_id: bigint, n_turns: bigint, depth: int, path: binary, leaf: boolean, position: bigint, role: string, text: string"


def escaped(text: Column, role: bool = False) -> Column:
    for plain, code in (*ESCAPES, *(((":", "\\c"),) if role else ())):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in ((":", "\\c"), *reversed(ESCAPES)):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per turn: its path of node names, each a hash of the parent's name and the turn's formatted text."""
    for batch in batches:
        out: list[tuple] = []
        for conv_id, turns in zip(batch["conv_id"].to_pylist(), batch["turns"].to_pylist()):
            path, position = b"", 0
            for k, turn in enumerate(turns):
                said = turn["head"] + turn["body"] + END
                path += hashlib.blake2b(path[-NODE:] + said.encode("utf-8", "replace"), digest_size=NODE).digest()
                out.append((conv_id, len(turns), k, path, k + 1 == len(turns), position, turn["head"], turn["body"]))
                position += len(said)
                if len(out) >= 2000:
                    yield _turn_rows(out)
                    out = []
        if out:
            yield _turn_rows(out)


def _turn_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
    names = ["conv_id", "n_turns", "depth", "path", "leaf", "position", "role", "text"]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names)


def prefix_tree(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tree of all conversations of ``turns`` (``conv_id, turn, role, text``), and each conversation's last node.

    Tree: ``node, depth, start, n_tokens, position, loss_start, loss_end, segment, ancestors``, one row per distinct prefix.
    ``start`` is the place of the node's first token in the depth-first order of all tokens, ``position`` that token's
    position id (what precedes it in its conversations), ``ancestors`` the intervals of tokens it may attend to besides
    its own, root first. ``loss_start`` and ``loss_end`` are set for assistant turns: the tokens of the text itself.

    Rows of a conversation are ordered by turn (null first), role, text; repeated rows are turns of their own. A null role
    or text is empty, a null ``conv_id`` is one conversation. Leaves: ``conv_id, n_turns, node, starts``. One conversation is
    built in one task; a prefix that many share is merged before and after the shuffle.
    """
    start(turns.sparkSession)
    said = F.struct(
        F.col("turn"),
        F.concat(F.lit(HEAD), escaped(F.coalesce("role", F.lit("")), True), F.lit(MIDDLE)).alias("head"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"),
    )
    whole = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(said)).alias("turns"))
    rows = checkpointed(whole.mapInArrow(_named, TURN))
    name = F.expr(f"substring(path, -{NODE}, {NODE})").alias("node")
    segment = F.concat("role", "text", F.lit(END))
    nodes = rows.groupBy("path").agg(*[F.first(c).alias(c) for c in ("depth", "position", "role", "text")])
    nodes = nodes.select("path", name, "depth", "position", "role", segment.alias("segment"), F.length(segment).cast("long").alias("n_tokens"), F.length("role").alias("head"))
    laid = checkpointed(running_total(checkpointed(nodes), ["path"], "n_tokens", "start").withColumn("end", F.col("start") + F.col("n_tokens")))
    above = _ancestors(laid.select("path", "node", "depth", "start", "end"))
    speaks = F.col("role") == HEAD + "assistant" + MIDDLE
    tree = laid.join(above, "node").select(
        "node", "depth", "start", "n_tokens", "position",
        F.when(speaks, F.col("start") + F.col("head")).alias("loss_start"),
        F.when(speaks, F.col("end") - len(END)).alias("loss_end"),
        "segment", "ancestors",
    )
    return tree, _leaves(rows, laid.select("node", "start"))


def _ancestors(laid: DataFrame) -> DataFrame:
    """``node, ancestors`` of nodes laid out depth first (``path, node, depth, start, end``).

    A run is a chain of first children; its tokens are contiguous. Only the head of a run looks its ancestors up, so there are
    no more lookups than turns: every conversation heads one run at most.
    """
    parent = laid.select(F.col("node").alias("_parent"), F.col("end").alias("_end"))
    up = F.when(F.col("depth") > 0, F.expr(f"substring(path, -{2 * NODE}, {NODE})"))
    marked = laid.withColumn("_parent", up).join(parent, "_parent", "left")
    heads = (F.col("depth") == 0) | (F.col("_end") != F.col("start"))
    marked = checkpointed(marked.select("path", "node", "depth", "start", "end", heads.cast("long").alias("heads")))
    placed = checkpointed(running_total(marked, ["start"], "heads", "run").withColumn("run", F.col("run") + F.col("heads")))
    names = F.transform(F.sequence(F.lit(0), F.col("depth") - 1), lambda k: F.substring("path", k * NODE + 1, F.lit(NODE)))
    asked = placed.where("heads = 1 AND depth > 0").select("run", F.explode(names).alias("node"))
    met = asked.join(placed.select("node", F.col("run").alias("of"), "start", "end"), "node")
    spans = met.groupBy("run", "of").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("above"))
    runs = placed.where("heads = 1").select("run", F.col("start").alias("first")).join(spans, "run", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    own = F.when(F.col("start") > F.col("first"), F.array(F.struct(F.col("first").alias("start"), F.col("start").alias("end")))).otherwise(none)
    return placed.join(runs, "run").select("node", F.concat(F.coalesce("above", none), own).alias("ancestors"))


def _leaves(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """``conv_id, n_turns, node, starts``: each conversation's last node and the places of its turns, looked up once a leaf."""
    last = rows.where("leaf").select("conv_id", "n_turns", F.substring("path", -NODE, NODE).alias("node"), "path")
    one = last.groupBy("node").agg(F.first("path").alias("path"), F.first("n_turns").alias("n"))
    names = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda k: F.substring("path", (k * NODE + 1).cast("int"), F.lit(NODE)))
    steps = one.select(F.col("node").alias("leaf"), F.explode(names).alias("node")).join(starts, "node")
    places = steps.groupBy(F.col("leaf").alias("node")).agg(F.sort_array(F.collect_list("start")).alias("starts"))
    return last.select("conv_id", "n_turns", "node").join(places, "node")


def read_back(tree: DataFrame, leaves: DataFrame) -> DataFrame:
    """``conv_id, turns, loss, formatted_chars`` from the output alone: a conversation's segments, parsed and unescaped.

    ``turns`` is an array of role and text, ``loss`` the text under the loss mask. Conversations that end in the same node
    are parsed once.
    """
    steps = leaves.dropDuplicates(["node"]).select("node", F.explode("starts").alias("start"))
    parts = tree.select("start", "segment", (F.col("loss_start") - F.col("start")).alias("from"), (F.col("loss_end") - F.col("loss_start")).alias("size"), "depth")
    pieces = steps.join(parts, "start")
    body = F.regexp_extract("segment", r"(?s)^### [^:]*: (.*)</turn>\n$", 1)
    turn = F.struct("depth", unescaped(F.regexp_extract("segment", r"(?s)^### ([^:]*): ", 1)).alias("role"), unescaped(body).alias("text"))
    masked = F.coalesce(F.col("segment").substr((F.col("from") + 1).cast("int"), F.col("size").cast("int")), F.lit(""))
    texts = pieces.select("node", turn.alias("turn"), F.struct("depth", unescaped(masked).alias("loss")).alias("loss"), F.length("segment").alias("n"))
    done = texts.groupBy("node").agg(
        F.transform(F.sort_array(F.collect_list("turn")), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["loss"]), "").alias("loss"),
        F.sum("n").alias("formatted_chars"),
    )
    return leaves.select("conv_id", "node").join(done, "node").drop("node")


def digests(tree: DataFrame, leaves: DataFrame) -> DataFrame:
    back = read_back(tree, leaves)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


HARD_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_formatting(spark, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)], said.schema)
    tree, leaves = prefix_tree(said.unionByName(hard))
    return digests(tree, leaves)


ORACLE_SQL = r"""
WITH said AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
turns AS (SELECT *, replace(replace(replace(text, '\', '\s'), '<', '\l'), '#', '\h') AS body,
  replace(replace(replace(replace(role, '\', '\s'), '<', '\l'), '#', '\h'), ':', '\c') AS head FROM said),
whole AS (SELECT conv_id, COUNT(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
  COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  SUM(length('### ' || head || ': ' || body || '</turn>' || chr(10)))::BIGINT AS formatted_chars FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole"""
