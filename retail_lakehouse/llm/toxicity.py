"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as two vectors side by side: one of its own (``WORD_BUCKETS`` hashed
words) and one of its characters (sum of the vectors of its 5- and 7-byte pieces with word
ends, ``GRAM_BUCKETS`` hashed, over the root of their number). Two gated recurrent
layers read a window of ``WINDOW`` words from both sides, attention pools their
states into one vector, and a logistic output scores it. A text is read whole, as
windows that begin every ``STRIDE`` words, so neighbours overlap; its score is the
highest of its windows.

Learning: the driver gets a bounded sample, about ``SAMPLE`` labelled documents of each
label (those whose id hashes are under a cut computed from the label's count) of
at most ``LEARN_CHARS`` characters; every text is scored whole. A label is of a document, not of a window, so
the windows to learn from are chosen first by the evidence of single words and
pieces, and twice later by the network itself: the highest window of every document, and random
ones of clean documents. Words and pieces in fewer than LEAST_DOCUMENTS documents of the sample keep the vector 0,
as do those never seen, and in the first half of the steps half of the toxic windows have the words of a clean window around their
telling ones: so a few windows are not learned by heart.

Defined results: words are runs of letters, digits and underscores, lower-cased; a text without words
(null, empty) is one window without words, scored by the output's bias alone; equal texts score
alike; repeated rows are scored each (of rows with one doc_id the smallest text teaches); label rows without doc_id, with a null
label or whose documents disagree (a doc_id with both labels) teach nothing; with one label or none to learn from, every
score is the share of label 1 in the training rows (0 without any); an empty table
gives an empty result; input columns named like an output give way to it.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import materialize
from retail_lakehouse.llm.tokens import slices, strings

WINDOW, STRIDE = 32, 26
WORD_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 16, 16, 16
GRAMS = (5, 7)
LEAST_DOCUMENTS = 3
SAMPLE = {0: 4000, 1: 2000}
LEARN_CHARS = 20_000
STEPS, BATCH, RATE, SEED = 240, 256, 0.01, 12
KNOWN_WORDS = 120_000
SLICE_BYTES = 3_000_000
LOT = 2048
ADDED = ("score", "predicted")

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def windows_of(n: int) -> np.ndarray:
    """Where the windows of ``n`` words begin: one at least, all words covered."""
    return np.arange(0, max(n - WINDOW, 0) + STRIDE, STRIDE) if n > WINDOW else np.zeros(1, dtype=np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket per word, gram buckets one word after another, grams per word)."""
    raw = [b"<" + w.encode("utf-8", "replace") + b">>>" for w in words]  # a piece at least
    ids = np.fromiter((zlib.crc32(r) % WORD_BUCKETS for r in raw), dtype=np.int64, count=len(raw))
    size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    flat = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(raw)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(flat))  # bytes to the word's end
    found, owner = [], []
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            h = (h * np.uint64(0x100000001B3)) ^ flat[at + k]
        h = h * np.uint64(0x9E3779B97F4A7C15)
        found.append((h >> np.uint64(40)).astype(np.int64) % GRAM_BUCKETS)
        owner.append(word[at])
    grams, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids, grams[order], np.bincount(owner, minlength=len(raw)).astype(np.int64)


def sums(rows: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of consecutive ``count`` rows (each at least 1)."""
    begin = np.cumsum(count) - count
    return np.add.reduceat(rows, begin, axis=0)


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, … for each (begin, count), one after another."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def summed_by(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(rows[order], first, axis=0)


# --- the network -------------------------------------------------------------------

@dataclass
class Network:
    """Parameters by name; ``prior`` scores everything if there is nothing to learn from."""

    p: dict[str, np.ndarray] | None
    prior: float = 0.0


def new_parameters(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    width = WORD_DIM + CHAR_DIM
    return {
        "words": normal(WORD_BUCKETS, WORD_DIM, scale=0.1), "grams": normal(GRAM_BUCKETS, CHAR_DIM, scale=0.1),
        # Gates of the forward and then of the backward layer: reset, update, candidate.
        "w": normal(width, 6 * HIDDEN, scale=width ** -0.5), "b": np.zeros(6 * HIDDEN, dtype=np.float32),
        "uf": normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5), "ub": normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5),
        "wa": normal(2 * HIDDEN, ATTENTION, scale=(2 * HIDDEN) ** -0.5), "ba": np.zeros(ATTENTION, dtype=np.float32),
        "va": normal(ATTENTION, scale=ATTENTION ** -0.5),
        "wo": normal(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5), "bo": np.zeros(1, dtype=np.float32),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.tanh(x * x.dtype.type(0.5))
    out += 1
    out *= 0.5
    return out


def word_inputs(p, ids, grams, count) -> np.ndarray:
    chars = sums(p["grams"][grams], count) / np.sqrt(count)[:, None].astype(np.float32)
    return np.concatenate([p["words"][ids], chars], axis=1)


def layer(x: np.ndarray, u: np.ndarray, steps, active, kept: dict | None) -> np.ndarray:
    """States (step, window, HIDDEN) of one gated layer over ``x`` (step, window, 3 HIDDEN).
    Windows are in descending length: at step t the first ``active[t]`` have a word."""
    h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
    out = np.zeros((x.shape[0], x.shape[1], HIDDEN), dtype=np.float32)
    for t in steps:
        k = active[t]
        before = h[:k].copy() if kept is not None else h[:k]
        g = before @ u
        gates = sigmoid(x[t, :k, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        reset, update, inner = gates[:, :HIDDEN], gates[:, HIDDEN:], g[:, 2 * HIDDEN:]
        new = np.tanh(x[t, :k, 2 * HIDDEN:] + reset * inner)
        if kept is not None:
            kept[t] = (before, reset, update, inner, new)
        h[:k] = new + update * (before - new)
        out[t, :k] = h[:k]
    return out


def layer_gradient(d_out: np.ndarray, u: np.ndarray, steps, active, kept: dict) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the layer's input and of ``u``."""
    dx = np.zeros((d_out.shape[0], d_out.shape[1], 3 * HIDDEN), dtype=np.float32)
    du, dh = np.zeros_like(u), np.zeros(d_out.shape[1:], dtype=np.float32)
    for t in reversed(steps):
        k = active[t]
        before, reset, update, inner, new = kept[t]
        d = dh[:k] + d_out[t, :k]
        d_new = d * (1 - update) * (1 - new * new)
        d_update = d * (before - new) * update * (1 - update)
        d_reset = d_new * inner * reset * (1 - reset)
        dx[t, :k] = np.concatenate([d_reset, d_update, d_new], axis=1)
        dg = np.concatenate([d_reset, d_update, d_new * reset], axis=1)
        du += before.T @ dg
        dh[:k] = d * update + dg @ u.T
    return dx, du


def logits(p, x: np.ndarray, length: np.ndarray, kept: dict | None = None) -> np.ndarray:
    """Output per window for gate inputs ``x`` (step, window, 6 HIDDEN), windows in descending length."""
    steps = range(x.shape[0])
    active = [int(np.searchsorted(-length, -t, side="left")) for t in steps]  # windows longer than t
    f = layer(x[:, :, :3 * HIDDEN], p["uf"], steps, active, None if kept is None else kept.setdefault("f", {}))
    b = layer(x[:, :, 3 * HIDDEN:], p["ub"], steps[::-1], active, None if kept is None else kept.setdefault("b", {}))
    states = np.concatenate([f, b], axis=2)
    shown = np.tanh(states.reshape(-1, 2 * HIDDEN) @ p["wa"] + p["ba"])
    energy = (shown @ p["va"]).reshape(states.shape[:2])
    energy[np.arange(len(steps))[:, None] >= length[None, :]] = -1e9
    share = np.exp(energy - energy.max(axis=0, initial=-1e9))
    share[np.arange(len(steps))[:, None] >= length[None, :]] = 0
    share /= np.maximum(share.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnh->nh", share, states)
    if kept is not None:
        kept.update(active=active, states=states, shown=shown, share=share, pooled=pooled)
    return pooled @ p["wo"] + p["bo"][0]


def gradients(p, x, length, labels) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Gradients of the mean log loss: of ``x`` and of the recurrent, attention and output parameters."""
    kept: dict = {}
    out = logits(p, x, length, kept)
    steps = range(x.shape[0])
    d_out = ((sigmoid(out) - labels) / len(labels)).astype(np.float32)
    d_pooled = d_out[:, None] * p["wo"][None, :]
    d_share = np.einsum("nh,tnh->tn", d_pooled, kept["states"])
    d_energy = kept["share"] * (d_share - (kept["share"] * d_share).sum(axis=0))
    d_shown = (d_energy.reshape(-1, 1) * p["va"][None, :]) * (1 - kept["shown"] ** 2)
    flat = kept["states"].reshape(-1, 2 * HIDDEN)
    d_states = kept["share"][:, :, None] * d_pooled[None] + (d_shown @ p["wa"].T).reshape(kept["states"].shape)
    dxf, duf = layer_gradient(d_states[:, :, :HIDDEN], p["uf"], steps, kept["active"], kept["f"])
    dxb, dub = layer_gradient(d_states[:, :, HIDDEN:], p["ub"], steps[::-1], kept["active"], kept["b"])
    return np.concatenate([dxf, dxb], axis=2), {
        "uf": duf, "ub": dub, "wa": flat.T @ d_shown, "ba": d_shown.sum(axis=0),
        "va": (d_energy.reshape(-1, 1) * kept["shown"]).sum(axis=0), "wo": kept["pooled"].T @ d_out, "bo": d_out.sum(keepdims=True)}


# --- learning -------------------------------------------------------------------------

class Sample:
    """Labelled texts as word codes, with the features of every distinct word."""

    def __init__(self, texts: list[str], labels: list[int]):
        vocabulary: dict[str, int] = {}
        self.codes = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], dtype=np.int64) for t in texts]
        self.labels = np.array(labels, dtype=np.float32)
        self.ids, self.grams, self.count = features(list(vocabulary)) if vocabulary else (np.zeros(0, np.int64),) * 3
        self.begin = np.cumsum(self.count) - self.count
        pairs = [(d, s) for d, c in enumerate(self.codes) for s in windows_of(len(c))]
        self.doc, self.start = np.array([x[0] for x in pairs]), np.array([x[1] for x in pairs])

    def held(self) -> np.ndarray:
        """Documents of each label (row) that hold each feature: word buckets, then gram buckets."""
        out = np.zeros((2, WORD_BUCKETS + GRAM_BUCKETS))
        for codes, y in zip(self.codes, self.labels):
            distinct = np.unique(codes)
            grams = self.grams[spread(self.begin[distinct], self.count[distinct])]
            out[int(y), np.unique(np.concatenate([self.ids[distinct], WORD_BUCKETS + grams]))] += 1
        return out

    def evidence(self, held: np.ndarray) -> np.ndarray:
        """Per word: how much more toxic than clean documents hold its best feature, times the share that does."""
        total = [max(1, int((self.labels == y).sum())) for y in (0, 1)]
        ratio = np.log((held[1] + 0.5) / (total[1] + 1)) - np.log((held[0] + 0.5) / (total[0] + 1))
        worth = np.maximum(ratio, 0) * held[1] / total[1]
        best = np.maximum.reduceat(worth[WORD_BUCKETS + self.grams], self.begin)
        return np.maximum(best, worth[self.ids])

    def best_windows(self, score: np.ndarray) -> np.ndarray:
        """The window of the highest score of each document."""
        order = np.lexsort((-score, self.doc))
        return order[np.unique(self.doc[order], return_index=True)[1]]

    def window(self, w: int) -> np.ndarray:
        """The word codes of a window."""
        return self.codes[self.doc[w]][self.start[w]:self.start[w] + WINDOW]


def lot_of(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word codes (step, window) with -1 beyond the end, lengths, order) of windows, in descending length."""
    length = np.array([len(w) for w in windows], dtype=np.int64)
    order = np.argsort(-length, kind="stable")
    out = np.full((WINDOW, len(windows)), -1, dtype=np.int64)
    for k, w in enumerate(order):
        out[:length[w], k] = windows[w]
    return out, length[order], order


def transplanted(window: np.ndarray, worth: np.ndarray, donor: np.ndarray) -> np.ndarray:
    """The telling words of ``window`` (half the best one's worth at least) among those of ``donor``."""
    if not len(window) or not len(donor):
        return window
    own = worth[window]
    out = donor.copy()
    telling = np.flatnonzero(own >= max(own.max() / 2, 1e-9))
    out[telling % len(out)] = window[telling]
    return out


def network_scores(p, sample: Sample) -> np.ndarray:
    """The network's output for every window of the sample."""
    gates = projected(p, sample.ids, sample.grams, sample.count) if len(sample.ids) else np.zeros((0, 6 * HIDDEN), np.float32)
    gates = np.concatenate([gates, np.zeros((1, 6 * HIDDEN), np.float32)])  # code -1: no word
    out = np.zeros(len(sample.doc), dtype=np.float32)
    for at in range(0, len(out), LOT):
        chosen = np.arange(at, min(at + LOT, len(out)))
        codes, length, order = lot_of([sample.window(w) for w in chosen])
        out[chosen[order]] = logits(p, gates[codes], length)
    return out


def projected(p, ids, grams, count) -> np.ndarray:
    """Gate inputs of words."""
    return word_inputs(p, ids, grams, count) @ p["w"] + p["b"]


class Adam:
    """Adam steps; for tables of vectors only the rows that have a gradient move."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.step = p, 0
        self.first = {k: np.zeros_like(v) for k, v in p.items()}
        self.second = {k: np.zeros_like(v) for k, v in p.items()}

    def move(self, gradient: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> None:
        self.step += 1
        rate = RATE * np.sqrt(1 - 0.99 ** self.step) / (1 - 0.9 ** self.step)
        for k, g in gradient.items():
            at = rows.get(k, slice(None))
            first, second = 0.9 * self.first[k][at] + 0.1 * g, 0.99 * self.second[k][at] + 0.01 * g * g
            self.first[k][at], self.second[k][at] = first, second
            self.p[k][at] -= (rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)


def train(sample: Sample, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Parameters learned from ``sample``, the same for the same sample."""
    rng = np.random.default_rng(SEED)
    p = new_parameters(rng)
    held = sample.held()
    common = held.sum(axis=0) >= LEAST_DOCUMENTS
    p["words"][~common[:WORD_BUCKETS]] = 0
    p["grams"][~common[WORD_BUCKETS:]] = 0
    adam = Adam(p)
    worth = sample.evidence(held) if len(sample.ids) else np.zeros(0)
    score = np.array([worth[sample.codes[d][s:s + WINDOW]].max(initial=0) for d, s in zip(sample.doc, sample.start)])
    toxic = sample.labels[sample.doc] > 0
    clean = np.flatnonzero(~toxic)
    for step in range(steps):
        if step in (0, steps // 2, 3 * steps // 4):
            score = score if step == 0 else sigmoid(network_scores(p, sample))
            best = sample.best_windows(score)
            hits, hard = best[toxic[best]], best[~toxic[best]]
            # The more a clean window looks toxic, the more often it is shown.
            weight = 0.02 + score[hard].astype(np.float64)
        chosen = np.concatenate([rng.choice(hits, BATCH // 2), rng.choice(hard, BATCH // 4, p=weight / weight.sum()), rng.choice(clean, BATCH // 4)])
        windows = [sample.window(w) for w in chosen]
        for k, donor in enumerate(rng.choice(clean, BATCH // 4 if step < steps // 2 else 0)):
            windows[k] = transplanted(windows[k], worth, sample.window(donor))
        codes, length, order = lot_of(windows + [np.zeros(0, dtype=np.int64)] * (BATCH // 32))  # no words: clean
        labels = np.append(toxic[chosen], np.zeros(BATCH // 32, dtype=bool))[order].astype(np.float32)
        used, where = np.unique(codes, return_inverse=True)
        real = used >= 0
        words = used[real]
        count, grams = sample.count[words], sample.grams[spread(sample.begin[words], sample.count[words])]
        inputs = np.zeros((len(used), WORD_DIM + CHAR_DIM), dtype=np.float32)
        inputs[real] = word_inputs(p, sample.ids[words], grams, count) if len(words) else 0
        dx, gradient = gradients(p, (inputs @ p["w"] + p["b"])[where.reshape(codes.shape)], length, labels)
        d_gates = np.zeros((len(used), 6 * HIDDEN), dtype=np.float32)
        at, total = summed_by(where.ravel(), dx.reshape(-1, 6 * HIDDEN))
        d_gates[at] = total
        d_gates[~real] = 0
        gradient["w"], gradient["b"] = inputs.T @ d_gates, d_gates.sum(axis=0)
        rows: dict[str, np.ndarray] = {}
        if len(words):
            d_inputs = (d_gates @ p["w"].T)[real]
            d_grams = np.repeat(d_inputs[:, WORD_DIM:] / np.sqrt(count)[:, None].astype(np.float32), count, axis=0)
            for name, ids, d, some in (("words", sample.ids[words], d_inputs[:, :WORD_DIM], common[:WORD_BUCKETS]),
                                       ("grams", grams, d_grams, common[WORD_BUCKETS:])):
                known = some[ids]
                if known.any():
                    rows[name], gradient[name] = summed_by(ids[known], d[known])
        adam.move(gradient, rows)
    return p


def learn(docs: DataFrame, labels: DataFrame, training, sample: dict[int, int] = SAMPLE, learn_chars: int = LEARN_CHARS) -> Network:
    """A network from the labelled ``docs`` (doc_id, text) for which the column
    ``training`` is true; ``labels``: (doc_id, toxic)."""
    named = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most")).where("toxic = most").drop("most")
    short = docs.where(training).where(F.length(F.coalesce("text", F.lit(""))) <= learn_chars).select("doc_id", "text")
    # Texts are not shuffled: ids meet the labels first, and few are chosen.
    marked = materialize(short.select("doc_id").distinct().join(named, "doc_id").select(
        F.col("doc_id").alias("chosen"), "toxic", F.xxhash64("doc_id").alias("order")), "labelled")
    found = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    n = sum(found.values())
    if not (found.get(0) and found.get(1)):
        return Network(None, found.get(1, 0) / n if n else 0.0)
    # Under its cut are about `sample` ids of a label, wherever they lie.
    cut = F.lit(None).cast("long")
    for y, count in found.items():
        cut = F.when(F.col("toxic") == y, F.lit(int(-2 ** 63 + min(1.0, sample[y] / count) * (2 ** 64 - 1025)))).otherwise(cut)
    few = F.broadcast(marked.where(F.col("order") <= cut))
    texts = short.join(few, F.col("doc_id") == F.col("chosen")).groupBy("order", "chosen", "toxic").agg(F.min("text").alias("text"))
    taken = sorted((tuple(r) for r in texts.collect()), key=lambda r: r[:3])
    return Network(train(Sample([r[3] for r in taken], [r[2] for r in taken])))


# --- scoring ----------------------------------------------------------------------------

class Scorer:
    """Scores of whole texts. The gate inputs of up to KNOWN_WORDS words are kept between slices."""

    def __init__(self, network: Network):
        self.network = network
        self.known: dict[str, int] = {}
        self.gates = np.zeros((1, 6 * HIDDEN), dtype=np.float32)  # row 0: no word
        self.slices = np.zeros(1, dtype=np.int32)  # in how many slices a word was

    def _learn_words(self, words: list[str]) -> None:
        if len(self.known) > KNOWN_WORDS:  # only those that came back stay
            kept = [w for w, at in self.known.items() if self.slices[at] > 1][:KNOWN_WORDS // 2]
            rows = np.array([0, *[self.known[w] for w in kept]])
            self.known = dict(zip(kept, range(1, len(kept) + 1)))
            self.gates, self.slices = self.gates[rows], np.ones(len(rows), dtype=np.int32)
        new = list(set(words).difference(self.known))
        parts = [self.gates]
        for at in range(0, len(new), 20_000):
            some = new[at:at + 20_000]
            self.known.update(zip(some, range(len(self.known) + 1, len(self.known) + 1 + len(some))))
            parts.append(projected(self.network.p, *features(some)))
        self.gates = np.concatenate(parts)
        self.slices = np.concatenate([self.slices, np.zeros(len(new), dtype=np.int32)])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.network.p is None:
            return np.full(len(texts), self.network.prior)
        split = [words_of(t) for t in texts]
        flat = [w for words in split for w in words]
        self._learn_words(flat)
        codes = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        self.slices[np.unique(codes)] += 1
        codes = np.concatenate([codes, np.zeros(WINDOW, dtype=np.int64)])
        size = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        begin = np.cumsum(size) - size
        starts = [windows_of(n) for n in size.tolist()]
        doc = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        inside = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
        length = np.minimum(size[doc] - inside, WINDOW)
        order = np.argsort(-length, kind="stable")
        best = np.full(len(texts), -np.inf)
        for at in range(0, len(order), LOT):
            lot = order[at:at + LOT]
            place = (begin[doc[lot]] + inside[lot])[None, :] + np.arange(max(1, length[lot[0]]))[:, None]
            np.maximum.at(best, doc[lot], logits(self.network.p, self.gates[codes[place]], length[lot]))
        return 1 / (1 + np.exp(-np.clip(best, -60, 60)))


def scored(docs: DataFrame, network: Network, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``docs`` (which has ``text``) with score and predicted."""
    kept = [c for c in keep if c not in ADDED]
    name = "text__"
    while name in kept:
        name += "_"
    source = docs.select(*kept, F.col("text").alias(name))
    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")

    def predict(batches):
        scorer = Scorer(network)
        for batch in batches:
            for part in slices(batch, name, SLICE_BYTES):
                score = scorer.scores(strings(part.column(len(kept))))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                                 names=[*kept, *ADDED])

    return source.mapInArrow(predict, schema)
