"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a text forward and backward; a softmax over their joined states labels every byte, and a
document's probabilities are the mean over all its bytes. Trained in numpy by backpropagation through time on a bounded
sample of labelled rows (SAMPLE_ROWS windows, a documented parameter); inference reads every byte of every text inside
mapInArrow, windows of many texts side by side. The windows of a text are not read alone: each layer starts a window
with the state it reaches over the CONTEXT bytes on its side of it, so a label at a window's edge has neighbours on both
sides.

The gates use softsign in place of tanh and (1 + softsign) / 2 in place of the logistic function, which numpy computes
several times faster. ASCII upper case is folded.

Defined results: a null text, or one without letters, is `und` with score 0; very long texts are read whole; repeated
rows are predicted separately; of equally likely labels the first in order is taken; other columns pass through whatever
their names, but lang_pred and score replace columns of these names; an empty table gives an empty result; with no
labelled row every document is `und`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_computed

#: Bound of the training sample: labelled rows, one window each.
SAMPLE_ROWS = 6000
WINDOW, HIDDEN, LANES = 64, 8, 1024
#: Bytes before (forward) and after (backward) a window that set a layer's state.
CONTEXT = 8
STEPS, BATCH, RATE = 500, 192, 0.02
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: A byte that UTF-8 never holds: a place without text, which leaves the state as it is.
FREE = 255
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass
class Model:
    """Tables (direction, gate, byte, hidden), recurrent weights (direction, gate, hidden, hidden), output weights."""

    tables: np.ndarray
    recur: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    langs: list[str]


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(y: np.ndarray) -> np.ndarray:
    """The derivative of softsign from its value."""
    return (1 - np.abs(y)) ** 2


def _run(m: Model, d: int, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (step, lane, hidden) of direction d over bytes x (step, lane), in reading order of that direction."""
    h = np.zeros((x.shape[1], m.recur.shape[-1]), np.float32)
    out = np.empty((*x.shape, h.shape[1]), np.float32)
    (tz, tr, tn), (uz, ur, un) = m.tables[d], m.recur[d]
    z, r, n, tmp = (np.empty_like(h) for _ in range(4))

    def gate(g: np.ndarray, table: np.ndarray, at: np.ndarray, u: np.ndarray, left: np.ndarray) -> None:
        np.take(table, at, axis=0, out=g, mode="clip")
        np.matmul(left, u, out=tmp)
        g += tmp
        np.abs(g, out=tmp)
        np.add(tmp, 1, out=tmp)
        g /= tmp

    for t in range(len(x)):
        free = x[t] == FREE
        if keep is not None:
            z, r, n = (np.empty_like(h) for _ in range(3))
        gate(z, tz, x[t], uz, h)
        gate(r, tr, x[t], ur, h)
        z *= 0.5
        z += 0.5
        r *= 0.5
        r += 0.5
        left = r * h
        gate(n, tn, x[t], un, left)
        if keep is not None:
            keep.append((h, z, r, n, left))
        o = out[t]
        np.subtract(h, n, out=o)
        o *= z
        o += n
        if free.any():
            o[free] = h[free]
        h = o
    return out


def _both(m: Model, x: np.ndarray) -> np.ndarray:
    return np.concatenate([_run(m, 0, x), _run(m, 1, x[::-1])[::-1]], axis=2)


def _both_in_context(m: Model, before: np.ndarray, x: np.ndarray, after: np.ndarray) -> np.ndarray:
    """States over x; the layers read before, or after backward, first. Lanes without such bytes hold FREE there."""
    f = _run(m, 0, np.concatenate([before, x]))[len(before) :]
    b = _run(m, 1, np.concatenate([x, after])[::-1])[len(after) :][::-1]
    return np.concatenate([f, b], axis=2)


def _softmax(s: np.ndarray) -> np.ndarray:
    s = s - s.max(axis=-1, keepdims=True)
    np.exp(s, out=s)
    s /= s.sum(axis=-1, keepdims=True)
    return s


def _gradients(m: Model, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    """Backpropagation through time of the mean cross entropy over all unmasked positions."""
    kept: list[list] = [[], []]
    f, b = _run(m, 0, x, kept[0]), _run(m, 1, x[::-1], kept[1])
    states = np.concatenate([f, b[::-1]], axis=2)
    e = _softmax(states @ m.out + m.bias)
    np.put_along_axis(e, y[None, :, None], np.take_along_axis(e, y[None, :, None], 2) - 1, 2)
    e *= (mask / mask.sum())[..., None]
    g = {"out": np.einsum("tbh,tbc->hc", states, e), "bias": e.sum((0, 1)), "tables": np.zeros_like(m.tables), "recur": np.zeros_like(m.recur)}
    ds, k = e @ m.out.T, m.recur.shape[-1]
    for d in (0, 1):
        dout, xs = (ds[..., :k], x) if d == 0 else (ds[::-1, :, k:], x[::-1])
        dh = np.zeros((x.shape[1], k), np.float32)
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, left = kept[d][t]
            dh = dh + dout[t]
            live = (xs[t] != FREE)[:, None]
            dz = live * dh * (h - n) * 0.5 * _slope(2 * z - 1)
            dn = live * dh * (1 - z) * _slope(n)
            dleft = dn @ m.recur[d, 2].T
            dr = dleft * h * 0.5 * _slope(2 * r - 1)
            for i, (dg, inp) in enumerate(((dz, h), (dr, h), (dn, left))):
                g["recur"][d, i] += inp.T @ dg
                np.add.at(g["tables"][d, i], xs[t], dg)
            dh = dh * np.where(live, z, 1) + dleft * r + dz @ m.recur[d, 0].T + dr @ m.recur[d, 1].T
    return g


def train(pieces: list[str], labels: list[str], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 7) -> Model | None:
    """A model from labelled pieces of text; None without any. Adam, a fixed seed."""
    langs, rng = sorted(set(labels)), np.random.default_rng(seed)
    if not langs:
        return None
    x, mask = np.full((len(pieces), WINDOW), FREE, np.uint8), np.zeros((len(pieces), WINDOW), np.float32)
    for i, p in enumerate(pieces):
        raw = np.frombuffer(p.encode("utf-8", "replace")[:WINDOW], np.uint8)
        x[i, : len(raw)], mask[i, : len(raw)] = _FOLD[raw], 1
    y = np.array([langs.index(v) for v in labels])
    normal = lambda *shape: rng.normal(size=shape).astype(np.float32)
    m = Model(normal(2, 3, 256, hidden) * 0.3, normal(2, 3, hidden, hidden) * 0.4, normal(2 * hidden, len(langs)) * 0.3, np.zeros(len(langs), np.float32), langs)
    first, second = ({k: np.zeros_like(getattr(m, k)) for k in ("tables", "recur", "out", "bias")} for _ in range(2))
    for step in range(1, steps + 1):
        at = rng.integers(0, len(pieces), BATCH)
        g = _gradients(m, x[at].T.astype(np.intp), y[at], mask[at].T + 1e-9)
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k, v in g.items():
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            step_k = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            setattr(m, k, (getattr(m, k) - step_k).astype(np.float32))
    return m


def _windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts in windows (window, byte), the bytes used of each, and where each text's windows begin."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    length = np.array([len(r) for r in raw], dtype=np.int64)
    n = np.maximum(1, -(-length // WINDOW))
    starts = np.concatenate([[0], np.cumsum(n)])
    free = bytes([FREE])
    padded = b"".join([r + free * (int(k) * WINDOW - len(r)) for r, k in zip(raw, n, strict=True)])
    used = np.full(starts[-1], WINDOW)
    used[starts[1:] - 1] = length - (n - 1) * WINDOW
    return _FOLD[np.frombuffer(padded, np.uint8)].reshape(-1, WINDOW), used, starts


def _window_probs(m: Model, x: np.ndarray, used: np.ndarray, starts: np.ndarray, each=None) -> np.ndarray:
    """Sums over a window's bytes of the label probabilities; each: called with (lanes, probabilities per byte)."""
    out = np.empty((len(x), len(m.langs)), np.float32)
    before, after = np.full((2, len(x), CONTEXT), FREE, np.uint8)
    before[1:], after[:-1] = x[:-1, WINDOW - CONTEXT :], x[1:, :CONTEXT]
    before[starts[:-1]] = after[starts[1:] - 1] = FREE
    lanes = lambda v: np.ascontiguousarray(v.T).astype(np.intp)
    for a in range(0, len(x), LANES):
        b = slice(a, a + LANES)
        p = _softmax(_both_in_context(m, lanes(before[b]), lanes(x[b]), lanes(after[b])) @ m.out + m.bias)
        if each:
            each(b, p)
        short = used[b] < WINDOW
        if short.any():
            p[:, short] *= (np.arange(WINDOW)[:, None] < used[b][short])[..., None]
        out[b] = p.sum(0)
    return out


def predict(m: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Label and score of each text."""
    live = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if m else []
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if live:
        x, used, starts = _windows([texts[i] for i in live])
        sums = np.add.reduceat(_window_probs(m, x, used, starts), starts[:-1], axis=0).astype(np.float64)
        sums /= sums.sum(1, keepdims=True)
        for i, k, s in zip(live, sums.argmax(1), sums.max(1), strict=True):
            langs[i], scores[i] = m.langs[k], float(min(1.0, s))
    return langs, scores


def label_positions(m: Model, text: str) -> list[str]:
    """The language label of every UTF-8 byte of a text."""
    x, used, starts = _windows([text])
    got: list[np.ndarray] = []
    _window_probs(m, x, used, starts, lambda _, p: got.append(p.argmax(-1).T.reshape(-1)))
    return [m.langs[k] for k in np.concatenate(got)[: len(text.encode("utf-8", "replace"))]]


def learn(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from at most sample_rows labelled rows, drawn by a hash of the key; from each one window's worth of
    characters at a hashed place."""
    place = F.pmod(F.xxhash64(F.lit("place"), key), F.greatest(F.lit(1), F.length(text) - WINDOW + 1)) + 1
    piece = F.substring(F.col(text), place.cast("int"), F.lit(WINDOW))
    sample = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.col(text) != ""))
    draw = F.xxhash64(F.lit("draw"), key)
    # a threshold from the count leaves little more than the sample, so that tasks do not send a sample each
    share = min(1.0, 1.2 * sample_rows / max(1, sample.count()) + 0.0001)
    drawn = sample.select(draw.alias("h"), piece.alias("piece"), F.col(lang).alias("lang"))
    least = lambda d: d.orderBy("h", "piece", "lang").limit(sample_rows).collect()
    got = least(drawn.where(F.col("h").cast("double") <= (2 * share - 1) * 2.0**63))
    if not got:  # few keys, all above the threshold
        got = least(drawn)
    return train([r["piece"] for r in got], [r["lang"] for r in got])


def label_languages(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; a text's own label, source and id are not inputs. Other columns pass through."""

    def make():
        return lambda texts: dict(zip(("lang_pred", "score"), predict(model, texts), strict=True))

    return with_computed(docs.drop("lang_pred", "score"), text, make, {"lang_pred": "string", "score": "double"}, keep=True)
