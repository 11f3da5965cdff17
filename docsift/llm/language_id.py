"""Language ID: a bidirectional gated recurrent network over bytes.

The network reads a letter run (lower-cased A-Z and all bytes above 0x7F; other
ASCII separates, runs over ``MAX_RUN`` bytes are cut into such pieces) forwards and
backwards and gives every position a probability for each language; a document's
probabilities are the mean over all positions of its whole text. A position's
label depends on its run only, so each distinct run is labelled once per worker
(bounded table) and counted as often as it stands.

Training is numpy backpropagation through time on the driver, over a bounded
random sample: at most ``TRAIN_DOCS`` labelled documents of each language that
occurs, a stretch of ``TRAIN_CHARS`` characters from a random place of each, languages
weighted equally. The learned weights are a few kilobytes and broadcast.

Defined cases: null text or text without a letter is ``und`` with score 0, as is
every document if no labelled one exists; null lang is never learned from; null
doc_id counts as not held out; repeated rows are predicted row by row; other
columns are never read; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.words import LETTERS, small, utf8
from docsift.llm.worker import kept

TRAIN_DOCS = 375              # of each language
TRAIN_CHARS = 4000
HIDDEN = 16
STEPS = 400
BATCH = 512
MAX_RUN = 128                # bytes; longer than words are, so only scripts without spaces are cut
MAX_KNOWN = 200_000
UNKNOWN = "und"
SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Cell:
    """One direction. Weights: ``wx`` (a row per byte: update, reset and candidate inputs), ``u``, ``b``."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.h = hidden
        self.wx = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.u = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
        self.b = np.zeros(3 * hidden, np.float32)

    def forward(self, x: np.ndarray, tape: list | None = None) -> np.ndarray:
        """States (time, rows, hidden) for bytes ``x`` (rows, time)."""
        h, n = self.h, len(x)
        state = np.zeros((n, h), np.float32)
        out = np.empty((x.shape[1], n, h), np.float32)
        table = self.wx + self.b
        for t in range(x.shape[1]):
            g, s = table[x[:, t]], state @ self.u
            gates = _sigmoid(g[:, :2 * h] + s[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(g[:, 2 * h:] + r * s[:, 2 * h:])
            if tape is not None:
                tape.append((state, z, r, new, s[:, 2 * h:]))
            state = new + z * (state - new)
            out[t] = state
        return out

    def backward(self, x: np.ndarray, tape: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of wx, u and b, given those of the states."""
        du, later = np.zeros_like(self.u), 0
        d_in = np.empty((x.shape[1], len(x), 3 * self.h), np.float32)
        for t in reversed(range(x.shape[1])):
            before, z, r, new, s_new = tape[t]
            d = d_out[t] + later
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * s_new * r * (1 - r)
            d_in[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_s = np.concatenate([d_z, d_r, d_new * r], axis=1)
            du += before.T @ d_s
            later = d * z + d_s @ self.u.T
        flat = d_in.reshape(-1, 3 * self.h)
        one_hot = np.zeros((len(flat), 256), np.float32)
        one_hot[np.arange(len(flat)), x.T.ravel()] = 1
        return [one_hot.T @ flat, du, flat.sum(axis=0)]


class Network:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.cells = [Cell(hidden, rng), Cell(hidden, rng)]
        self.v = rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32)
        self.c = np.zeros(len(langs), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [w for cell in self.cells for w in (cell.wx, cell.u, cell.b)] + [self.v, self.c]

    def states(self, x: np.ndarray, tapes=(None, None)) -> np.ndarray:
        ahead = self.cells[0].forward(x, tapes[0])
        back = self.cells[1].forward(x[:, ::-1], tapes[1])[::-1]
        return np.concatenate([ahead, back], axis=2)

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (time, rows, languages) at every position of equally long runs ``x`` (rows, time)."""
        logits = self.states(x) @ self.v + self.c
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean cross-entropy over all positions."""
        tapes = ([], [])
        s = self.states(x, tapes)
        logits = s @ self.v + self.c
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        d = e / e.sum(axis=2, keepdims=True)
        d[:, np.arange(len(x)), y] -= 1
        d *= (weight / (weight.sum() * x.shape[1])).astype(np.float32)[None, :, None]
        h = s.shape[2] // 2
        flat_s, flat_d = s.reshape(-1, 2 * h), d.reshape(-1, d.shape[2])
        ds = d @ self.v.T
        return [*self.cells[0].backward(x, tapes[0], ds[:, :, :h]),
                *self.cells[1].backward(x[:, ::-1], tapes[1], ds[::-1, :, h:]),
                flat_s.T @ flat_d, flat_d.sum(axis=0)]


def runs(text: bytes) -> list[bytes]:
    out = text.translate(LETTERS).split()
    if len(max(out, key=len, default=b"")) > MAX_RUN:
        out = [r[i:i + MAX_RUN] for r in out for i in range(0, len(r), MAX_RUN)]
    return out


def train(sample: list[tuple[str, bytes]], steps: int = STEPS, batch: int = BATCH, seed: int = 7) -> Network:
    """Adam on batches of equally long runs, a length drawn by its share of all positions."""
    langs = sorted({lang for lang, _ in sample})
    net, rng = Network(langs, seed=seed), np.random.default_rng(seed)
    by_length: dict[int, Counter] = {}
    for lang, text in sample:
        for run in runs(text):
            by_length.setdefault(len(run), Counter())[run, langs.index(lang)] += 1
    if not by_length:
        return net
    positions = Counter()
    for n, found in by_length.items():
        for (_, lang), k in found.items():
            positions[lang] += n * k
    pools = {}
    for n, found in by_length.items():
        x = np.frombuffer(b"".join(run for run, _ in found), np.uint8).reshape(-1, n)
        y = np.array([lang for _, lang in found])
        p = np.array(list(found.values()), float) / np.array([positions[lang] for lang in y])
        pools[n] = (x, y, p)
    lengths = np.array(sorted(pools))
    share = np.array([n * pools[n][2].sum() for n in lengths])
    first, second = ([np.zeros_like(w) for w in net.weights()] for _ in range(2))
    for step in range(1, steps + 1):
        n = rng.choice(lengths, p=share / share.sum())
        x, y, p = pools[n]
        pick = rng.choice(len(x), size=min(batch, 4 * len(x)), p=p / p.sum())
        rate = 0.02 * (1 - 0.9 * step / steps)
        for w, g, m, v in zip(net.weights(), net.gradients(x[pick], y[pick], np.ones(len(pick))), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


class Labeller:
    """Run -> summed position probabilities and length, each distinct run through the network once."""

    def __init__(self, net: Network):
        self.net, self.index = net, {}
        self.sums = np.zeros((1024, len(net.langs) + 1), np.float32)

    def learn(self, found: set[bytes]) -> None:
        new = found.difference(self.index)
        if len(self.index) + len(new) > MAX_KNOWN:
            self.index.clear()
            new = found
        start = len(self.index)
        if start + len(new) > len(self.sums):
            more = np.zeros((2 * (start + len(new)), self.sums.shape[1]), np.float32)
            more[:start] = self.sums[:start]
            self.sums = more
        by_length: dict[int, list[bytes]] = {}
        for run in new:
            by_length.setdefault(len(run), []).append(run)
        for n, group in by_length.items():
            for i in range(0, len(group), 4096):
                part = group[i:i + 4096]
                x = np.frombuffer(b"".join(part), np.uint8).reshape(-1, n)
                at = len(self.index)
                self.sums[at:at + len(part), :-1] = self.net.positions(x).sum(axis=0)
                self.sums[at:at + len(part), -1] = n
                self.index.update(zip(part, range(at, at + len(part))))

    def pooled(self, texts: list[bytes]) -> list[np.ndarray | None]:
        """Mean position probabilities of each text; None where it has no run."""
        split = [runs(t) for t in texts]
        self.learn({r for s in split for r in s})
        at, out = self.index.__getitem__, []
        for s in split:
            if s:
                total = self.sums[np.fromiter(map(at, s), np.int64, len(s))].sum(axis=0, dtype=np.float64)
                out.append(total[:-1] / total[-1])
            else:
                out.append(None)
        return out


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame) -> Network:
    """Train on a bounded sample of the documents that are not held out and have a language.

    Every language that any of them has is learned: the languages are counted over all, and the sample is drawn by
    hash for each, ``TRAIN_DOCS`` documents of the smallest hashes where there are more.
    """
    order = F.xxhash64("doc_id", F.length("text"), F.substring("text", 1, 200), F.lit("sample"))
    usable = docs.select("text", "lang", order.alias("o")).filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).collect()          # a row for each class
    if not counts:
        return train([])
    # half as many again as wanted, so that fewer are very unlikely; a task passes on few rows of a language
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 1.5 * TRAIN_DOCS / r["n"])) for r in counts], "lang string, share double")
    drawn = usable.join(F.broadcast(shares), "lang").filter(F.pmod("o", F.lit(1 << 31)) < F.col("share") * F.lit(1 << 31))
    room = F.greatest(F.length("text") - TRAIN_CHARS, F.lit(0)) + 1
    stretch = F.substring(F.col("text"), (F.pmod(F.col("o"), room) + 1).cast("int"), F.lit(TRAIN_CHARS))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("o", F.lit(1 << 31)), "o", "text"))
    sample = (drawn.select("o", "lang", stretch.alias("text")).withColumn("place", place).filter(F.col("place") <= TRAIN_DOCS)
              .orderBy("lang", "place").collect())
    return train([(r.lang, r.text.encode()) for r in sample])


def _labeller(model) -> Labeller:
    """One per Python worker, for the model in use."""
    return kept(model.value["id"], lambda: Labeller(model.value["net"]))


def _labelled(model, texts: list[bytes]) -> Iterator[tuple[str, float]]:
    """Language and score of each text."""
    langs = model.value["net"].langs
    for start in range(0, len(texts), 500):
        part = texts[start:start + 500]
        pooled = _labeller(model).pooled(part) if langs else [None] * len(part)
        for text, p in zip(part, pooled):
            if p is None or not _has_letter(text):
                yield UNKNOWN, 0.0
            else:
                best = int(p.argmax())
                yield langs[best], min(1.0, float(p[best]))


def _broadcast(docs: DataFrame, net: Network):
    return docs.sparkSession.sparkContext.broadcast({"id": uuid.uuid4().hex, "net": net})


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs(doc_id, text)``."""
    model = _broadcast(docs, net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            lang, score = zip(*found) if (found := list(_labelled(model, utf8(batch["text"])))) else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(label, SCHEMA)


def keep_languages(docs: DataFrame, net: Network, least: float, wanted: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is known, among ``wanted`` (None: any learned one), and scores
    ``least`` or more; all columns."""
    model = _broadcast(docs, net)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            stays = [lang != UNKNOWN and score >= least and (wanted is None or lang in wanted)
                     for lang, score in _labelled(model, utf8(batch["text"]))]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
