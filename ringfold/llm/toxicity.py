"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own hashed embedding next to the scaled sum of the hashed embeddings of
its character 4- and 5-grams, so that unseen forms of a known stem are recognised; in training
half of the words lose their own embedding, so that the characters learn too. Each text is read in windows of 32 words that overlap by half, all of them;
a window's states in both directions are pooled by attention into one logit, and a text's logit
is its worst window's, calibrated on whole training texts.

Training runs on the driver over a bounded sample of labelled texts from outside the held-out
fold (POSITIVES and NEGATIVES texts, taken by a hash of doc_id). A text's label does not say
which window earns it, so a toxic text teaches by the window that the current model finds worst
(at first the one whose words are most typical of toxic texts), a clean text by several.
Scoring is a map over Arrow batches: the input products are made once for each distinct word
of a chunk, and the steps run over thousands of windows at a time. Nothing is shuffled.

Edge cases: null or empty text is one window without words; texts shorter than a window are
padded; texts of any length are read to their end; without both classes in the labels the score is
the share of label 1 (0.5 without labels); repeated rows are scored each; an empty table gives no
rows; labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_arrow
from .words import chunks, coded, hashed, mixed, rolling

WINDOW, STRIDE = 32, 16
HIDDEN = 8
WORD_ROWS, WORD_DIM = 1 << 15, 8
CHAR_BITS, CHAR_DIM = 15, 8
CHAR_ROWS = 1 << CHAR_BITS
GRAMS = (4, 5)
INPUT = WORD_DIM + CHAR_DIM
POSITIVES, NEGATIVES = 2000, 3000
#: Windows of a clean training text that teach in one epoch.
CLEAN_WINDOWS = 4
#: Share of words that lose their own embedding in a training step.
DROPPED = 0.5
EPOCHS = 4
BATCH = 256
CHUNK_BYTES = 2 << 20
#: Windows that are read side by side.
SIDE_BY_SIDE = 2048
FOLDS, HELD_OUT = 5, 0

Model = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_model(seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
    model = {"words": draw(WORD_ROWS, WORD_DIM) * 0.2, "chars": draw(CHAR_ROWS, CHAR_DIM) * 0.5}
    for d in ("f", "b"):
        model |= {f"w{d}": draw(INPUT, 3 * HIDDEN), f"u{d}": draw(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
    return model | {
        "attend": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32), "scale": np.array([1.0, 0.0], np.float32)
    }


def spell(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct word, lower-cased: its embedding row, and rows of its character n-grams (all in a row, with
    bounds). Words are marked at both ends; one shorter than an n-gram has none of that length."""
    lower = pc.ascii_lower(words)
    row = (hashed(lower) % np.uint64(WORD_ROWS)).astype(np.int32)
    marked = pa.concat_arrays([pc.binary_join_element_wise("\x02", lower, "\x03", "").cast(pa.binary())])
    offsets = np.frombuffer(marked.buffers()[1], np.int32, len(marked) + 1) if len(marked) else np.zeros(1, np.int32)
    raw = np.frombuffer(marked.buffers()[2], np.uint8)[: offsets[-1]].astype(np.uint64) if len(marked) else np.zeros(0, np.uint64)
    sizes = [np.maximum(np.diff(offsets) - n + 1, 0) for n in GRAMS]
    bounds = np.r_[0, np.cumsum(sum(sizes))].astype(np.int32)
    out, start = np.empty(bounds[-1], np.int32), bounds[:-1].copy()
    for n, size in zip(GRAMS, sizes):
        gram = (mixed(rolling(raw + np.uint64(1), n, 0x9E3779B97F4A7C15) + np.uint64(n)) >> np.uint64(64 - CHAR_BITS)).astype(np.int32)
        step = np.arange(size.sum(), dtype=np.int32) - np.repeat((np.cumsum(size) - size).astype(np.int32), size)
        out[step + np.repeat(start, size)] = gram[step + np.repeat(offsets[:-1], size)]
        start += size.astype(np.int32)
    return row, out, bounds


#: Words whose inputs are made at once.
WORDS_AT_ONCE = 1 << 15


def inputs(model: Model, spelled: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Input vectors of distinct words, and a last row of zeros for padding."""
    row, grams, bounds = spelled
    out = np.zeros((len(row) + 1, INPUT), np.float32)
    out[:-1, :WORD_DIM] = model["words"][row]
    for k in range(0, len(row), WORDS_AT_ONCE):
        b = bounds[k : k + WORDS_AT_ONCE + 1]
        full = np.flatnonzero(np.diff(b))
        if len(full):
            total = np.add.reduceat(model["chars"][grams[b[0] : b[-1]]], b[full] - b[0], axis=0)
            out[k + full, WORD_DIM:] = total / np.sqrt(np.diff(b)[full])[:, None]
    return out


def windows(code: np.ndarray, bounds: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all windows (rows) of all texts, and the text of each. A text has one window at least; the last
    reaches its end."""
    size = np.diff(bounds)
    count = np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = (k * STRIDE).astype(np.int32)[:, None] + np.arange(WINDOW, dtype=np.int32)
    outside = at >= size[text].astype(np.int32)[:, None]
    at += bounds[:-1][text].astype(np.int32)[:, None]
    at[outside] = len(code)
    return np.r_[code, pad].astype(np.int32)[at], text


def _run(gates: np.ndarray, recur: np.ndarray, idx: np.ndarray, keep: bool):
    """States of one direction: gates are the inputs' products by word, idx the words of each window in order."""
    n, h = len(idx), np.zeros((len(idx), HIDDEN), np.float32)
    states = np.empty((WINDOW, n, HIDDEN), np.float32)
    tape = []
    for t in range(WINDOW):
        x, u = gates[idx[:, t]], h @ recur
        zr = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])))
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        new = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
        if keep:
            tape.append((h, z, r, new, u[:, 2 * HIDDEN :]))
        h = h + z * (new - h)
        states[t] = h
    return states, tape


def gates_of(model: Model, x: np.ndarray) -> dict[str, np.ndarray]:
    """Products of the inputs of distinct words, by direction."""
    out = {}
    for d in "fb":
        out[d] = x @ model[f"w{d}"]
        out[d] += model[f"c{d}"]
        np.clip(out[d], -30, 30, out=out[d])
    return out


def forward(model: Model, gates: dict[str, np.ndarray], idx: np.ndarray, keep: bool = False):
    """Logits of windows. gates: gates_of() the inputs, whose last row is padding; idx: words of each window."""
    real = idx != len(gates["f"]) - 1
    front, tape_f = _run(gates["f"], model["uf"], idx, keep)
    back, tape_b = _run(gates["b"], model["ub"], idx[:, ::-1], keep)
    states = np.concatenate([front, back[::-1]], axis=2)
    weight = np.where(real.T, states @ model["attend"], -1e4)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    logit = pooled @ model["out"] + model["bias"][0]
    return logit, (states, weight, pooled, tape_f, tape_b, real) if keep else None


def backward(model: Model, x: np.ndarray, idx: np.ndarray, kept, slope: np.ndarray) -> Model:
    """Gradients of the sum of slope * logit; "x" is that of the inputs."""
    states, weight, pooled, tape_f, tape_b, real = kept
    grad = {"out": pooled.T @ slope, "bias": np.array([slope.sum()])}
    d_pooled = slope[:, None] * model["out"]
    inner = (states * d_pooled).sum(axis=2)
    d_weight = weight * (inner - (weight * inner).sum(axis=0)) * real.T
    grad["attend"] = np.einsum("tn,tnh->h", d_weight, states)
    d_states = weight[:, :, None] * d_pooled + d_weight[:, :, None] * model["attend"]
    d_x = np.zeros_like(x, dtype=np.float64)
    for d, tape, order in (("f", tape_f, idx), ("b", tape_b, idx[:, ::-1])):
        d_out = d_states[:, :, :HIDDEN] if d == "f" else d_states[::-1, :, HIDDEN:]
        d_gates = np.empty((WINDOW, len(idx), 3 * HIDDEN), np.float32)
        d_recur, d_h = np.zeros_like(model[f"u{d}"]), np.zeros((len(idx), HIDDEN), np.float32)
        for t in reversed(range(WINDOW)):
            h, z, r, new, u = tape[t]
            d_h = d_h + d_out[t]
            d_new = d_h * z * (1 - new**2)
            d_z = d_h * (new - h) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            d_gates[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_recur += h.T @ d_u
            d_h = d_h * (1 - z) + d_u @ model[f"u{d}"].T
        grad[f"u{d}"] = d_recur
        by_word = np.zeros((len(x), 3 * HIDDEN))
        np.add.at(by_word, order.T.ravel(), d_gates.reshape(-1, 3 * HIDDEN))
        grad[f"w{d}"], grad[f"c{d}"] = x.T @ by_word, by_word.sum(axis=0)
        d_x += by_word @ model[f"w{d}"].T
    d_x[-1] = 0
    return grad | {"x": d_x}


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, model: Model, grad: Model) -> None:
        self.t += 1
        for k, g in grad.items():
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g
            v = self.v[k] = 0.99 * self.v.get(k, 0) + 0.01 * g * g
            model[k] = (model[k] - self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)).astype(np.float32)


def fit(texts: list[str], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Train on whole labelled texts."""
    rng, model = np.random.default_rng(seed), new_model(seed)
    words, code, bounds = coded(pa.array(texts, pa.string()))
    spelled = spell(words)
    idx, text = windows(code, bounds, len(words))
    toxic = y[text] == 1
    # words and n-grams typical of toxic texts start with a first coordinate of their own
    odds, gram_odds = _odds(spelled, code, bounds, y)
    model["words"][:, 0] += odds
    model["chars"][:, 0] += gram_odds
    worst = np.r_[odds[spelled[0]], 0][idx].max(axis=1) if len(words) else np.zeros(len(idx))
    adam = Adam(0.01)
    for epoch in range(epochs):
        if epoch:
            worst = logits(model, spelled, idx)
        order = np.lexsort((-worst, text))
        place = np.arange(len(text)) - np.repeat(np.searchsorted(text, np.arange(len(texts))), np.bincount(text, minlength=len(texts)))
        hard = order[place < np.where(toxic[order], 1, CLEAN_WINDOWS // 2)]
        other = rng.permutation(np.flatnonzero(~toxic))[: (y == 0).sum() * CLEAN_WINDOWS // 2]
        drawn = rng.permutation(np.r_[np.repeat(hard, np.where(toxic[hard], 3, 1)), other])
        for k in range(0, len(drawn), BATCH):
            one = drawn[k : k + BATCH]
            used, local = np.unique(idx[one], return_inverse=True)
            real = used[used < len(words)]
            local = local.reshape(len(one), WINDOW)
            local = np.where(idx[one] == len(words), len(real), local)
            sub = _sub(spelled, real)
            x = inputs(model, sub)
            dropped = rng.random(len(real)) < DROPPED
            x[:-1][dropped, :WORD_DIM] = 0
            logit, kept = forward(model, gates_of(model, x), local, keep=True)
            slope = ((_sigmoid(logit) - toxic[one]) / len(one)).astype(np.float32)
            grad = backward(model, x, local, kept, slope)
            d_x = grad.pop("x")[:-1]
            grad["words"] = np.zeros_like(model["words"])
            np.add.at(grad["words"], sub[0][~dropped], d_x[~dropped, :WORD_DIM])
            grad["chars"] = np.zeros_like(model["chars"])
            size = np.diff(sub[2])
            np.add.at(grad["chars"], sub[1], np.repeat(d_x[:, WORD_DIM:] / np.sqrt(np.maximum(size, 1))[:, None], size, axis=0))
            adam.step(model, grad)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, logits(model, spelled, idx))
    model["scale"] = calibrate(top, y)
    return model


def _odds(spelled, code: np.ndarray, bounds: np.ndarray, y: np.ndarray, at_once: int = 100) -> list[np.ndarray]:
    """Log odds of label 1 for texts that hold a word's or an n-gram's row, against those that hold it and have label 0."""
    has = [np.zeros((2, rows)) for rows in (WORD_ROWS, CHAR_ROWS)]
    for k in range(0, len(y), at_once):
        doc = np.repeat(np.arange(len(y[k : k + at_once])), np.diff(bounds[k : k + at_once + 1]))
        pairs = np.unique(doc * np.int64(len(spelled[0]) + 1) + code[bounds[k] : bounds[min(k + at_once, len(y))]])
        doc, word = pairs // (len(spelled[0]) + 1), pairs % (len(spelled[0]) + 1)
        size = np.diff(spelled[2])[word]
        at = np.arange(size.sum()) + np.repeat(spelled[2][word] - (np.cumsum(size) - size), size)
        for n, d, row in ((has[0], doc, spelled[0][word]), (has[1], np.repeat(doc, size), spelled[1][at])):
            own = np.unique(d * np.int64(n.shape[1]) + row)
            for label in (0, 1):
                hit = own[y[k + own // n.shape[1]] == label] % n.shape[1]
                n[label] += np.bincount(hit, minlength=n.shape[1])
    out = []
    for n in has:
        odds = np.log((n[1] + 0.5) / ((y == 1).sum() + 1)) - np.log((n[0] + 0.5) / ((y == 0).sum() + 1))
        odds[n.sum(axis=0) < 3] = 0
        out.append(np.clip(odds, -1, 3).astype(np.float32))
    return out


def _sub(spelled, chosen: np.ndarray):
    """spell() of some of its words."""
    row, three, bounds = spelled
    size = np.diff(bounds)[chosen]
    new = np.r_[0, np.cumsum(size)]
    return row[chosen], three[np.arange(new[-1]) + np.repeat(bounds[:-1][chosen] - new[:-1], size)], new


def calibrate(top: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Slope and shift that make the worst windows' logits into chances, by damped Newton steps."""
    a = np.array([1.0, 0.0])
    z = np.c_[top, np.ones(len(top))]
    for _ in range(steps):
        p = _sigmoid(z @ a)
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(z) + 1e-3 * np.eye(2)
        a = a - 0.5 * np.linalg.solve(hess, z.T @ (p - y) / len(z) + 1e-3 * (a - [1, 0]))
    return np.array([max(a[0], 0.05), a[1]], np.float32)


def logits(model: Model, spelled, idx: np.ndarray) -> np.ndarray:
    gates = gates_of(model, inputs(model, spelled))
    parts = [forward(model, gates, idx[k : k + SIDE_BY_SIDE])[0] for k in range(0, len(idx), SIDE_BY_SIDE)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    """Chance of label 1 of each whole text."""
    words, code, bounds = coded(texts)
    idx, text = windows(code, bounds, len(words))
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, logits(model, spell(words), idx))
    slope, shift = model["scale"]
    return _sigmoid(slope * top + shift).astype(float)


def fold(folds: int, one: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == one, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> Model | float:
    """A model, or the share of label 1 where there are not two classes to learn from."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    known = known.filter(~fold(folds, held_out))
    drawn = None
    for y, most in ((1, POSITIVES), (0, NEGATIVES)):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        drawn = part if drawn is None else drawn.union(part)
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").limit(2 * (POSITIVES + NEGATIVES)).collect()
    found = sorted((r["doc_id"], r["y"], r["text"] or "") for r in found)
    y = np.array([r[1] for r in found])
    if len(y) == 0 or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    return fit([r[2] for r in found], y)


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(docs, labels, label, folds, held_out)
    if isinstance(model, float):
        scored = docs.select("doc_id", F.lit(model).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in chunks(batch, 1, CHUNK_BYTES):
                    found = score_texts(sent.value, chunk.column(1))
                    yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(found)], ["doc_id", "score"])

        scored = map_arrow(docs, read, "doc_id long, score double")
    return scored.select(
        "doc_id", fold(folds, held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
