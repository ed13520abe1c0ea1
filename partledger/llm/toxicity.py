"""Toxicity by a small bidirectional gated recurrent network over word and character inputs, in numpy.

A text is cut into overlapping windows of words. Each distinct word has an input vector: its own embedding (hashed) next to
the mean of its character n-grams' embeddings. Two gated recurrent layers read a window in both directions, attention pools
their states, and the highest window decides the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from partledger.llm.common import LOWER, SPACE, flat, mixed, slices, span_hashes, start, table
from partledger.llm.language import held_out

WINDOW, STRIDE = 24, 12  # words
WORDS, GRAMS = 1 << 13, 1 << 14  # hash buckets
INPUT, STATE = 8, 8  # numbers in each embedding and in each direction's state
LENGTHS = (3, 4, 5)  # bytes in a character n-gram, word ends included
MAX_TOXIC, MAX_CLEAN = 1500, 2500  # bound of the labelled sample
MAX_SAMPLE_BYTES = 64 << 20  # of its texts, which the driver gets
CUT = 0.3  # score from which a text counts as toxic
BREAK = SPACE.copy()
BREAK[[k for k in range(33, 127) if not chr(k).isalnum()]] = True


@dataclass
class Windows:
    """Distinct words of some texts and, per window, the place of each of its words among them (-1: none)."""

    word: np.ndarray  # bucket of each distinct word
    gram: np.ndarray  # buckets of the n-grams of all distinct words, one after the other
    gram_at: np.ndarray  # their offsets
    at: np.ndarray  # windows x WINDOW
    doc: np.ndarray  # text of each window


def windows_of(data: np.ndarray, offsets: np.ndarray) -> Windows:
    """All overlapping windows of all texts; a text without words has none."""
    data = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~BREAK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    hashes = span_hashes(data, starts, ends)
    distinct, where, place = np.unique(hashes, return_index=True, return_inverse=True)
    gram, gram_at = _grams(data, starts[where], ends[where])
    begin = np.searchsorted(starts, offsets)
    count = np.diff(begin)
    number = np.where(count > 0, 1 + np.maximum(0, -((WINDOW - count) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(count)), number)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    at = (begin[doc] + nth * STRIDE)[:, None] + np.arange(WINDOW)
    real = at < begin[doc + 1][:, None]
    at = np.where(real, place[np.minimum(at, max(0, len(place) - 1))] if len(place) else 0, -1)
    return Windows((distinct >> np.uint64(64 - 13)).astype(np.int16), gram, gram_at, at.astype(np.int32), doc)


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-gram buckets of some words, each with a mark (byte 1) before and after it."""
    size = ends - starts + 2
    at = np.concatenate([[0], np.cumsum(size)])
    marked = np.ones(at[-1], np.uint64)
    fill = np.arange(at[-1]) - np.repeat(at[:-1], size)
    body = (fill > 0) & (fill < np.repeat(size, size) - 1)
    marked[body] = data[(np.repeat(starts, size) + fill - 1)[body]]
    value, found, word = np.zeros(len(marked), np.uint64), [], []
    owner, left = np.repeat(np.arange(len(size)), size), np.repeat(at[1:], size) - np.arange(at[-1])
    for n in range(1, max(LENGTHS) + 1):
        value *= np.uint64(1099511628211)
        value[: len(value) - n + 1] += marked[n - 1 :]
        if n in LENGTHS:
            ok = left >= n
            found.append(mixed(value[ok] + np.uint64(n)) >> np.uint64(64 - 14))
            word.append(owner[ok])
    word_of = np.concatenate(word) if word else np.zeros(0, np.int64)
    order = np.argsort(word_of, kind="stable")
    gram = np.concatenate(found).astype(np.int16)[order] if found else np.zeros(0, np.int16)
    return gram, np.concatenate([[0], np.cumsum(np.bincount(word_of, minlength=len(size)))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name. The gates of a direction stand side by side: update, reset, candidate."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)
        shape = {"word": (WORDS, INPUT), "gram": (GRAMS, INPUT), "attend": (2 * STATE,), "out": (2 * STATE,), "bias": (1,)}
        for side in "fb":
            shape |= {f"in_{side}": (2 * INPUT, 3 * STATE), f"rec_{side}": (STATE, 3 * STATE), f"bias_{side}": (3 * STATE,)}
        made = {k: draw.normal(0, 0.1 if len(s) > 1 and s[0] > 99 else 0.3, s).astype(np.float32) for k, s in shape.items()}
        return Network(made | {"shift": np.zeros(1, np.float32)})

    def inputs(self, w: Windows) -> np.ndarray:
        """Input vector of each distinct word, and a last row of zeros for places without a word."""
        out = np.zeros((len(w.word) + 1, 2 * INPUT), np.float32)
        out[:-1, :INPUT] = self.p["word"][w.word]
        if len(w.gram):
            out[:-1, INPUT:] = np.add.reduceat(self.p["gram"][w.gram], w.gram_at[:-1], axis=0) / np.diff(w.gram_at)[:, None]
        return out

    def _read(self, side: str, gates: np.ndarray, at: np.ndarray, trace: list | None) -> np.ndarray:
        """States of one direction at every place."""
        rec = self.p[f"rec_{side}"]
        states = np.zeros((WINDOW, len(at), STATE), np.float32)
        h = np.zeros((len(at), STATE), np.float32)
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            x, r = gates[at[:, t]], h @ rec
            zr = _sigmoid(x[:, : 2 * STATE] + r[:, : 2 * STATE])
            z, reset = zr[:, :STATE], zr[:, STATE:]
            n = np.tanh(x[:, 2 * STATE :] + reset * r[:, 2 * STATE :])
            new = n + z * (h - n)
            new *= (at[:, t] >= 0)[:, None]
            if trace is not None:
                trace.append((t, h, z, reset, n, r[:, 2 * STATE :]))
            states[t] = h = new
        return states

    def forward(self, w: Windows, at: np.ndarray, traces: dict | None = None) -> np.ndarray:
        """Logit of each window in ``at``."""
        x = self.inputs(w)
        states = []
        for side in "fb":
            trace = [] if traces is not None else None
            states.append(self._read(side, x @ self.p[f"in_{side}"] + self.p[f"bias_{side}"], at, trace))
            if traces is not None:
                traces[side] = trace
        h = np.concatenate(states, axis=2)
        weight = h @ self.p["attend"]
        weight[at.T < 0] = -1e9
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tb,tbk->bk", weight, h)
        if traces is not None:
            traces |= {"x": x, "h": h, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"]

    def gradients(self, w: Windows, at: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of some windows, by back-propagation through time."""
        tr: dict = {}
        logit = self.forward(w, at, tr)
        d = ((_sigmoid(logit) - label) / len(at)).astype(np.float32)
        g = {"bias": d.sum(keepdims=True), "out": tr["pooled"].T @ d}
        dpool = d[:, None] * self.p["out"]
        h, weight = tr["h"], tr["weight"]
        dweight = np.einsum("bk,tbk->tb", dpool, h)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        g["attend"] = np.einsum("tb,tbk->k", dscore, h)
        dh_all = weight[:, :, None] * dpool + dscore[:, :, None] * self.p["attend"]
        dx = np.zeros_like(tr["x"])
        for k, side in enumerate("fb"):
            rec, dgates = self.p[f"rec_{side}"], np.zeros((len(tr["x"]), 3 * STATE), np.float32)
            drec, dh = np.zeros_like(rec), np.zeros((len(at), STATE), np.float32)
            for t, before, z, reset, n, rn in reversed(tr[side]):
                dh = (dh + dh_all[t, :, k * STATE : (k + 1) * STATE]) * (at[:, t] >= 0)[:, None]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (before - n) * z * (1 - z)
                dr = dn * rn * reset * (1 - reset)
                down = np.concatenate([dz, dr, dn * reset], axis=1)
                drec += before.T @ down
                np.add.at(dgates, at[:, t], np.concatenate([dz, dr, dn], axis=1))
                dh = dh * z + down @ rec.T
            dgates[-1] = 0
            g |= {f"rec_{side}": drec, f"in_{side}": tr["x"].T @ dgates, f"bias_{side}": dgates.sum(axis=0)}
            dx += dgates @ self.p[f"in_{side}"].T
        g["word"], g["gram"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["gram"])
        np.add.at(g["word"], w.word, dx[:-1, :INPUT])
        size = np.diff(w.gram_at)
        np.add.at(g["gram"], w.gram, np.repeat(dx[:-1, INPUT:] / size[:, None], size, axis=0))
        return g

    def document_logits(self, w: Windows, docs: int) -> np.ndarray:
        """Highest logit of each text's windows; minus infinity without windows."""
        out = np.full(docs, -np.inf)
        if len(w.at):
            np.maximum.at(out, w.doc, self.forward(w, w.at))
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated score of each text, 0 for one without words."""
        out = np.zeros(len(offsets) - 1)
        for a, b in slices(offsets):
            w = windows_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            out[a:b] = _sigmoid(self.document_logits(w, b - a) - self.p["shift"][0] + np.log(CUT / (1 - CUT)))
        return out


def _some(w: Windows, rows: np.ndarray) -> tuple[Windows, np.ndarray]:
    """Only the words that some windows use, and the windows renumbered."""
    used, at = np.unique(w.at[rows], return_inverse=True)
    at = at.reshape(len(rows), WINDOW).astype(np.int32) - (1 if used[0] < 0 else 0)
    used = used[used >= 0]
    size = np.diff(w.gram_at)[used]
    fill = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    gram = w.gram[np.repeat(w.gram_at[:-1][used], size) + fill]
    return Windows(w.word[used], gram, np.concatenate([[0], np.cumsum(size)]), at, w.doc[rows]), at


def _all_windows(data: np.ndarray, offsets: np.ndarray) -> Windows:
    """As ``windows_of``, a run of texts at a time, which takes less memory; a word counts as another in each run."""
    parts = [(a, windows_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in slices(offsets)]
    parts = parts or [(0, windows_of(data, offsets))]
    words = np.cumsum([0, *(len(w.word) for _, w in parts)])
    grams = np.cumsum([0, *(len(w.gram) for _, w in parts)])
    return Windows(
        np.concatenate([w.word for _, w in parts]),
        np.concatenate([w.gram for _, w in parts]),
        np.concatenate([*(w.gram_at[:-1] + g for (_, w), g in zip(parts, grams)), grams[-1:]]),
        np.concatenate([np.where(w.at < 0, -1, w.at + k).astype(np.int32) for (_, w), k in zip(parts, words)]),
        np.concatenate([w.doc + a for a, w in parts]),
    )


def fit(texts: list[str], toxic: np.ndarray, seed: int = 7, rounds: int = 8, batch: int = 512, rate: float = 0.01) -> Network:
    """Train on labelled texts.

    At first some windows of a text carry its label; later rounds take a toxic text's highest windows and a clean text's
    highest ones, so the network learns which window decides. A tenth of the texts is kept back to place the cut.
    """
    return learn(_all_windows(*flat(pa.array(texts, pa.string()))), toxic, seed, rounds, batch, rate)


def learn(w: Windows, toxic: np.ndarray, seed: int = 7, rounds: int = 8, batch: int = 512, rate: float = 0.01) -> Network:
    """``fit`` from the windows of the texts, which need not be in memory any more."""
    net, draw = Network.fresh(seed), np.random.default_rng(seed)
    if len(set(toxic.tolist())) < 2:  # nothing to tell apart: no text is toxic, or every one with words is
        net.p["shift"][:] = -1e9 if toxic.any() else 1e9
        return net
    back = np.zeros(len(toxic), bool)
    back[draw.permutation(len(toxic))[: len(toxic) // 10]] = True
    usable = np.flatnonzero(~back[w.doc])
    label = toxic[w.doc].astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for r in range(rounds):
        if r < 3:
            rank = draw.random(len(w.at))
            most = np.where(label > 0, 12, 4)
        else:
            rank = -np.concatenate([net.forward(*_some(w, np.arange(i, min(i + 8192, len(w.at))))) for i in range(0, len(w.at), 8192)])
            rank += draw.normal(0, 0.1, len(rank))
            most = np.where(label > 0, 2, 3)
        order = np.lexsort((rank, w.doc))
        nth = np.empty(len(order), np.int64)
        nth[order] = np.arange(len(order)) - np.searchsorted(w.doc[order], w.doc[order])
        picked = usable[nth[usable] < most[usable]]
        if r >= 3:
            picked = np.concatenate([picked, draw.choice(usable[label[usable] == 0], len(picked) // 2)]) if (label[usable] == 0).any() else picked
        picked = draw.permutation(picked)
        size = min(batch, max(16, len(picked) // 60))  # small samples need as many steps
        for i in range(0, len(picked), size):
            rows = picked[i : i + size]
            step += 1
            for k, g in net.gradients(*_some(w, rows), label[rows]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                slow = rate * (0.3 if r >= rounds - 3 else 1.0)
                net.p[k] -= slow * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    logits = np.full(len(toxic), -np.inf)
    for i in range(0, len(w.at), 8192):
        rows = np.arange(i, min(i + 8192, len(w.at)))
        np.maximum.at(logits, w.doc[rows], net.forward(*_some(w, rows)))
    _place_cut(net, logits, toxic, back)
    return net


def _place_cut(net: Network, logits: np.ndarray, toxic: np.ndarray, back: np.ndarray) -> None:
    """Put the cut where fewest texts are wrong, those kept back counting most; in the middle of the gap if there is one."""
    shown = np.isfinite(logits)
    logits, toxic, weight = logits[shown], toxic[shown], np.where(back[shown], 5.0, 1.0)
    order = np.argsort(logits)
    wrong = np.concatenate([[0], np.cumsum(np.where(toxic[order] > 0, weight[order], 0))])
    wrong = wrong + np.concatenate([[0], np.cumsum(np.where(toxic[order] > 0, 0, weight[order]))])[-1]
    wrong = wrong - np.concatenate([[0], np.cumsum(np.where(toxic[order] > 0, 0, weight[order]))])
    best = np.flatnonzero(wrong == wrong.min())
    ends = np.concatenate([[logits.min() - 1], logits[order], [logits.max() + 1]])
    net.p["shift"][:] = (ends[best[0]] + ends[best[-1] + 1]) / 2


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` other labelled documents, by hash of the id.

    An id with several texts gives one of them, that of smallest hash. Of the texts in order of their ids' hashes those up to
    ``MAX_SAMPLE_BYTES`` are taken, each as a whole. Rows without id or label are left out; no labels give no rows.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marks.where("toxic = 1").orderBy(*by_hash).limit(MAX_TOXIC).unionByName(
        marks.where("toxic <> 1").withColumn("toxic", F.lit(0).cast(marks.schema["toxic"].dataType)).orderBy(*by_hash).limit(MAX_CLEAN)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", "toxic").agg(F.min_by(F.struct("text"), F.xxhash64("text")).alias("one")).select("doc_id", "one.text", "toxic")
    earlier = Window.orderBy(*by_hash)  # over at most MAX_TOXIC + MAX_CLEAN rows
    sized = one.withColumn("bytes", F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(earlier))
    return sized.where(F.col("bytes") <= MAX_SAMPLE_BYTES).drop("bytes")


def score_texts(docs: DataFrame, net: Network) -> DataFrame:
    """All columns of ``docs`` and ``toxicity``, 0 to 1; null and wordless texts get 0. Windows cover whole texts.

    A column called ``toxicity`` is replaced. Repeated rows get equal scores; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    start(spark)
    shared = spark.sparkContext.broadcast(net.p)
    kept = [c for c in docs.columns if c.lower() != "toxicity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Network(shared.value)
        for batch in batches:
            score = pa.array(here.scores(*flat(batch["text"])), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), score], [*kept, "toxicity"])

    schema = docs.select(*kept).schema.add("toxicity", "double")
    return docs.select(*kept).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """A network from a bounded sample of the labelled documents (a document with several labels is toxic if one says so).

    With labels of one kind only, or none, or an empty table, ``fit`` says what comes out.
    """
    return learn(*_sample_windows(docs, labels))


def _sample_windows(docs: DataFrame, labels: DataFrame) -> tuple[Windows, np.ndarray]:
    """Windows and labels of the sample; its texts are gone when this returns."""
    rows = labelled_sample(docs, labels).toArrow().sort_by("doc_id")  # one row for an id
    return _all_windows(*flat(rows["text"])), rows["toxic"].to_numpy().astype(np.int64)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(docs, table(spark, sf_dir, "labels").where(~held_out(4, 2)))
    scored = score_texts(docs, net)
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= CUT).cast("int").alias("predicted")
    )
