"""Toxicity: a bidirectional GRU with attention pooling over character and word inputs, trained and run in numpy.

A word's input is its word embedding (hashed vocabulary) beside the scaled sum of the embeddings of its byte 3-grams
and 5-grams, borders included. A GRU reads the text in both directions; attention pools the states of a window of words; a
logistic output scores the window. A document's score is that of its most toxic window, and every word starts a window
(the last one ends with the text). Overlapping windows share their words' states: a state is read with at least ``pad``
words of context on its side of the window, or up to the text's border, so the GRU runs about twice over each word, and
pooled windows are sliding sums of the attention weights and weighted states.

Labels exist per document only, so training is by multiple instances: of a toxic document the window that the
model finds most toxic counts as toxic, of a clean one its most toxic and some random windows count as clean. The first
dimension of the embeddings starts from how surely a word or gram is more frequent in toxic training documents, so
that the first windows are well chosen even with few labels.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.substrings import _powers, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings", "train", "score_documents", "training_sample", "held_out"]

# Letters to lower case, ASCII punctuation to blanks: bytes of other scripts pass as they are.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


_GRAM = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


_WORDS = 20_000  # distinct words whose grams are handled at once
_BLOCK = 100_000  # words whose windows are scored at once in training


class Settings:
    """Sizes of the model and of its training. ``sample_rows`` bounds the labelled rows that training reads, ``segment``
    the words that the GRU reads in one go besides ``pad`` words of context before and after them."""

    def __init__(self, window=32, pad=16, segment=240, hidden=8, dim=16, words=1 << 13, grams=1 << 14, sample_rows=6000,
                 epochs=6, batch=256, rate=0.01, threshold=0.7, seed=5):
        self.__dict__.update({k: v for k, v in locals().items() if k != "self"})


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges one after another, and for each the number of its range."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    return starts[owner] + np.arange(len(owner)) - (np.cumsum(lengths) - lengths)[owner], owner


class _Text:
    """Words of several texts: inputs of their distinct words and the place of every word among these."""

    def __init__(self, texts: list[str | None], s: Settings, powers):
        clean = [(t or "").encode("utf-8", "surrogatepass").translate(_CLEAN) for t in texts]
        data = b" " + b" ".join(clean) + b"     "
        bounds = np.concatenate([[0], np.cumsum([len(c) + 1 for c in clean])])
        hashes, starts, ends = word_hashes(data, powers)
        self.first = np.searchsorted(starts, bounds + 1)
        self.first[-1] = len(starts)
        keys, at, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.bucket = (keys % np.uint64(s.words)).astype(np.int64)
        raw = np.frombuffer(data, np.uint8)
        a, n = starts[at] - 1, ends[at] - starts[at]  # a word's grams start at the border before it
        def mix(at: np.ndarray, size: int) -> np.ndarray:
            out = np.zeros(len(at), np.uint32)
            for k in range(size):
                out = (out ^ raw[at + k]) * _GRAM[k]
            return out

        self.gram = np.concatenate([np.zeros(0, np.int32), *(self._grams(a[k:k + _WORDS], n[k:k + _WORDS], mix, s.grams)
                                                             for k in range(0, len(a), _WORDS))])
        self.n_grams = n + np.maximum(n - 2, 0)
        self.gram_at = np.concatenate([[0], np.cumsum(self.n_grams)])

    @staticmethod
    def _grams(a: np.ndarray, n: np.ndarray, mix, size: int) -> np.ndarray:
        """Buckets of the 3-grams and 5-grams of some words, word by word."""
        three, owner_3 = _ranges(a, n)
        five, owner_5 = _ranges(a, np.maximum(n - 2, 0))
        order = np.argsort(np.concatenate([owner_3, owner_5]), kind="stable")
        mixed = np.concatenate([mix(three, 3), mix(five, 5)])[order]
        return ((mixed ^ mixed >> np.uint32(15)) % np.uint32(size)).astype(np.int32)

    def grams_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Grams of some distinct words, and for each the place of its word among these."""
        at, owner = _ranges(self.gram_at[words], self.n_grams[words])
        return self.gram[at], owner

    def gram_sums(self, words: np.ndarray | None, table: np.ndarray) -> np.ndarray:
        """Sum of the ``table`` rows of the grams of distinct words (null: all), over the root of their number."""
        words = np.arange(len(self.n_grams)) if words is None else words
        out = np.zeros((len(words), table.shape[1]), table.dtype)
        for k in range(0, len(words), _WORDS):
            some = words[k:k + _WORDS]
            gram, n = self.grams_of(some)[0], self.n_grams[some]
            out[k:k + _WORDS] = np.add.reduceat(table[gram], np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None].astype(table.dtype)
        return out

    def windows(self, s: Settings) -> tuple[np.ndarray, np.ndarray]:
        """``(first word, document)`` of all windows: one for every word that has ``window - 1`` words after it, and one
        for a shorter text."""
        n = np.diff(self.first)
        at, doc = _ranges(self.first[:-1], np.where(n > 0, np.maximum(n - s.window + 1, 1), 0))
        return at, doc

    def part(self, a: int, b: int) -> "_Text":
        """The texts from ``a`` to ``b``, over the same distinct words."""
        out = object.__new__(_Text)
        out.__dict__.update(self.__dict__)
        out.first, out.word = self.first[a:b + 1] - self.first[a], self.word[self.first[a]:self.first[b]]
        return out

    def blocks(self, words: int) -> Iterator[tuple[int, int]]:
        """Ranges of texts with about so many words each."""
        a = 0
        for b in range(1, len(self.first)):
            if self.first[b] - self.first[a] >= words or b == len(self.first) - 1:
                yield a, b
                a = b

    def spans(self, at: np.ndarray, doc: np.ndarray, length: int, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(places, present, core)``, each (n, pad + length + pad): the words from ``at`` on, ``length`` of them, with
        context, inside their document. ``places`` are places among the distinct words, -1 for padding."""
        where = at[:, None] - pad + np.arange(length + 2 * pad)
        present = (where >= self.first[doc][:, None]) & (where < self.first[doc + 1][:, None])
        core = present & (where >= at[:, None]) & (where < at[:, None] + length)
        places = np.where(present, self.word[np.clip(where, 0, max(0, len(self.word) - 1))], -1).astype(np.int32)
        return places, present, core


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _init(s: Settings) -> dict[str, np.ndarray]:
    r, h, d = np.random.default_rng(s.seed), s.hidden, s.dim

    def normal(*shape, scale):
        return (r.standard_normal(shape) * scale).astype(np.float32)

    return {"word": normal(s.words, d, scale=0.1), "char": normal(s.grams, d, scale=0.1),
            "win": normal(2 * d, 6 * h, scale=d ** -0.5), "bin": np.zeros(6 * h, np.float32),
            "uf": normal(h, 3 * h, scale=h ** -0.5), "ub": normal(h, 3 * h, scale=h ** -0.5),
            "wa": normal(2 * h, 2 * h, scale=(2 * h) ** -0.5), "va": normal(2 * h, scale=(2 * h) ** -0.5),
            "wo": normal(2 * h, scale=(2 * h) ** -0.5), "bo": np.full(1, -2, np.float32)}


def _gru(x: np.ndarray, u: np.ndarray, keep: bool, present: np.ndarray):
    """States (time, n, hidden) of a GRU over inputs (time, n, 3 hidden), zero where nothing is ``present`` (time, n); with
    ``keep`` also what its gradient needs."""
    steps, n, h = x.shape[0], x.shape[1], u.shape[0]
    state, states, saved = np.zeros((n, h), np.float32), np.empty((steps, n, h), np.float32), []
    gates, cand = np.ascontiguousarray(u[:, :2 * h]), np.ascontiguousarray(u[:, 2 * h:])
    there = present[:, :, None].astype(np.float32)
    for t in range(steps):
        zr = _sigmoid(x[t, :, :2 * h] + state @ gates)
        z, r = zr[:, :h], zr[:, h:]
        c = np.tanh(x[t, :, 2 * h:] + (r * state) @ cand)
        if keep:
            saved.append((state, z, r, c))
        state = (state + z * (c - state)) * there[t]
        states[t] = state
    return states, saved


def _gru_gradient(d_states: np.ndarray, saved: list, u: np.ndarray, present: np.ndarray):
    """Gradients of the inputs and of ``u``."""
    steps, n, h = d_states.shape
    gates, cand = u[:, :2 * h], u[:, 2 * h:]
    dx, du, carry = np.empty((steps, n, 3 * h), np.float32), np.zeros_like(u), np.zeros((n, h), np.float32)
    there = present[:, :, None].astype(np.float32)
    for t in reversed(range(steps)):
        state, z, r, c = saved[t]
        g = (d_states[t] + carry) * there[t]
        dc = g * z * (1 - c * c)
        drs = dc @ cand.T
        dzr = np.concatenate([g * (c - state) * z * (1 - z), drs * state * r * (1 - r)], axis=1)
        dx[t, :, :2 * h], dx[t, :, 2 * h:] = dzr, dc
        du[:, :2 * h] += state.T @ dzr
        du[:, 2 * h:] += (r * state).T @ dc
        carry = g * (1 - z) + drs * r + dzr @ gates.T
    return dx, du


def _pool(p: dict, states: np.ndarray, present: np.ndarray):
    """Attention over (n, time, 2 hidden): logits, and what the gradient needs."""
    act = np.tanh(states @ p["wa"])
    e = np.where(present, act @ p["va"], -1e9)
    e = np.exp(e - e.max(axis=1, keepdims=True))
    a = e / e.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", a, states)
    return pooled @ p["wo"] + p["bo"][0], (act, a, pooled)


def _states(p: dict, x: np.ndarray, present: np.ndarray) -> np.ndarray:
    """States of both directions (n, time, 2 hidden) for inputs (time, n, 6 hidden)."""
    h = p["uf"].shape[0]
    f, _ = _gru(x[:, :, :3 * h], p["uf"], False, present)
    b, _ = _gru(x[::-1, :, 3 * h:], p["ub"], False, present[::-1])
    return np.concatenate([f, b[::-1]], axis=2).transpose(1, 0, 2)


def _word_states(p: dict, inputs: np.ndarray, t: _Text, s: Settings) -> np.ndarray:
    """States (words, 2 hidden) of all words, read in segments with context. ``inputs``: projected distinct words."""
    n = np.diff(t.first)
    parts = -(-n // s.segment)
    start, doc = _ranges(np.zeros(len(n), np.int64), parts)
    size = -(-n // np.maximum(parts, 1))  # a text is cut into equal segments
    at, length = t.first[doc] + start * size[doc], size[doc]
    out = np.zeros((len(t.word), 2 * p["uf"].shape[0]), np.float32)
    order = np.argsort(length, kind="stable")  # segments of like length together, so that few places are padding
    for k in range(0, len(order), 512):
        some = order[k:k + 512]
        longest = int(length[some].max())
        places, present, core = t.spans(at[some], doc[some], longest, s.pad)
        core &= np.arange(longest + 2 * s.pad) < (s.pad + length[some])[:, None]
        states = _states(p, inputs[places.T], present.T)
        out[(at[some][:, None] - s.pad + np.arange(longest + 2 * s.pad))[core]] = states[core]
    return out


def _sums(x: np.ndarray, window: int) -> np.ndarray:
    """Sums of ``window`` consecutive rows, by doubling: only numbers of the window itself are added."""
    total, done, at, power = None, 0, x, 1
    while done < window:
        if window & power:
            part = at[done:]
            total = part.copy() if total is None else total[:len(part)] + part[:len(total)]
            done += power
        if done < window:
            at, power = at[:-power] + at[power:], power * 2
    return total


def _logits(p: dict, inputs: np.ndarray, t: _Text, s: Settings) -> np.ndarray:
    """Logits of all windows of :meth:`_Text.windows`."""
    at, _ = t.windows(s)
    if not len(at):
        return np.zeros(0, np.float32)
    states = _word_states(p, inputs, t, s)
    e = np.exp(np.clip(np.tanh(states @ p["wa"]) @ p["va"], -60, 60)).astype(np.float64)
    # what a window needs of a word: its weight and its weighted share of the output; nothing follows a text's end
    n = np.diff(t.first)
    place = np.arange(len(e)) + (np.cumsum(np.full(len(n), s.window)) - s.window)[np.repeat(np.arange(len(n)), n)]
    spread = np.zeros((len(e) + s.window * (len(n) + 1), 2))
    spread[place, 0], spread[place, 1] = e, e * (states @ p["wo"])
    pooled = _sums(spread, s.window)[place[at]]
    return (pooled[:, 1] / pooled[:, 0] + p["bo"][0]).astype(np.float32)


def _project(p: dict, t: _Text) -> np.ndarray:
    d = p["word"].shape[1]
    x = p["word"][t.bucket] @ p["win"][:d] + t.gram_sums(None, p["char"]) @ p["win"][d:] + p["bin"]
    return np.concatenate([x, p["bin"][None, :]]).astype(np.float32)


def _gradients(p: dict, t: _Text, words: np.ndarray, windows: np.ndarray, present: np.ndarray, core: np.ndarray,
               y: np.ndarray) -> dict:
    """Gradients of the mean log loss for some windows (``core``) with their context; ``words``: the distinct words they use,
    ``windows`` places among these (the place behind the last is padding)."""
    h, d, n = p["uf"].shape[0], p["word"].shape[1], len(windows)
    emb = np.concatenate([np.concatenate([p["word"][t.bucket[words]], t.gram_sums(words, p["char"])], axis=1),
                          np.zeros((1, 2 * d), np.float32)])
    x = (emb @ p["win"] + p["bin"])[windows.T]
    f, saved_f = _gru(x[:, :, :3 * h], p["uf"], True, present.T)
    b, saved_b = _gru(x[::-1, :, 3 * h:], p["ub"], True, present.T[::-1])
    states = np.concatenate([f, b[::-1]], axis=2).transpose(1, 0, 2)
    logit, (act, a, pooled) = _pool(p, states, core)
    dl = ((_sigmoid(logit) - y) / n).astype(np.float32)
    g = {"wo": pooled.T @ dl, "bo": np.array([dl.sum()], np.float32)}
    dp = dl[:, None] * p["wo"]
    da = np.einsum("nh,nth->nt", dp, states)
    de = a * (da - (a * da).sum(axis=1, keepdims=True))
    dact = de[:, :, None] * p["va"] * (1 - act * act)
    g["va"] = np.einsum("nt,nth->h", de, act)
    g["wa"] = states.reshape(-1, 2 * h).T @ dact.reshape(-1, 2 * h)
    ds = (a[:, :, None] * dp[:, None, :] + dact @ p["wa"].T).transpose(1, 0, 2)
    dxf, g["uf"] = _gru_gradient(ds[:, :, :h], saved_f, p["uf"], present.T)
    dxb, g["ub"] = _gru_gradient(ds[::-1, :, h:], saved_b, p["ub"], present.T[::-1])
    dx = np.concatenate([dxf, dxb[::-1]], axis=2).reshape(-1, 6 * h)
    g["bin"] = dx.sum(axis=0)
    demb_in = np.zeros((len(emb), 6 * h), np.float32)
    np.add.at(demb_in, windows.T.reshape(-1), dx)
    g["win"] = emb.T @ demb_in
    demb = (demb_in @ p["win"].T)[:-1]
    g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    np.add.at(g["word"], t.bucket[words], demb[:, :d])
    gram, owner = t.grams_of(words)
    np.add.at(g["char"], gram, (demb[:, d:] / np.sqrt(t.n_grams[words])[:, None].astype(np.float32))[owner])
    return g


def _batch(t: _Text, at: np.ndarray, doc: np.ndarray, s: Settings):
    """``words, windows, present, core`` of some windows for :func:`_gradients`."""
    places, present, core = t.spans(at, doc, s.window, s.pad)
    words, place = np.unique(places, return_inverse=True)
    place = place.reshape(places.shape)
    if words[0] < 0:  # padding goes behind the last word
        words, place = words[1:], np.where(place == 0, len(words) - 1, place - 1)
    return words, place, present, core


def _most(values: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """Largest value per document (minus infinity without any)."""
    out = np.full(n, -np.inf)
    np.maximum.at(out, docs, values)
    return out


def _evidence(parts, size: int, y: np.ndarray) -> np.ndarray:
    """``parts``: (document, bucket) arrays, each document in one part only. Per bucket: by how much more than 3 standard errors its share of toxic documents exceeds that of clean ones
    (negative the other way round), in units of 3, at most 3. Rare buckets have none."""
    k1, k0 = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for doc, bucket in parts:
        pairs = np.unique(doc * size + bucket)
        toxic = y[pairs // size] == 1
        k1 += np.bincount(pairs[toxic] % size, minlength=size)
        k0 += np.bincount(pairs[~toxic] % size, minlength=size)
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    share = (k1 + k0) / (n1 + n0)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    z = (k1 / n1 - k0 / n0) / error
    return (np.sign(z) * np.clip((np.abs(z) - 3) / 3, 0, 3)).astype(np.float32)


def train(texts: list[str | None], labels: list[int], s: Settings) -> dict[str, np.ndarray]:
    """Model parameters from labelled texts. Every fifth text sets the output's offset only, so that the threshold
    lies where it separates the classes best."""
    y = np.asarray(labels, np.float32)
    rng, t = np.random.default_rng(s.seed), _Text(texts, s, _powers())
    n = np.diff(t.first)
    n_windows = np.where(n > 0, np.maximum(n - s.window + 1, 1), 0)
    p = _init(s)
    fold = np.arange(len(texts)) % 5 == 4
    seen = np.zeros(0)
    if len(t.word):
        number = np.cumsum(~fold) - 1

        def distinct():  # (documents, their distinct words), some documents at a time
            for at in range(0, len(texts), 100):
                ids = np.arange(at, min(at + 100, len(texts)))
                owner = np.repeat(ids, np.diff(t.first)[ids])
                pair = np.unique(owner * len(t.bucket) + t.word[t.first[at]:t.first[ids[-1] + 1]])
                pair = pair[~fold[pair // len(t.bucket)]]
                yield number[pair // len(t.bucket)], pair % len(t.bucket)

        def grams():
            for doc_, word in distinct():
                gram, of = t.grams_of(word)
                yield doc_[of], gram

        p["word"][:, 0] = _evidence(((doc_, t.bucket[word]) for doc_, word in distinct()), s.words, y[~fold])
        p["char"][:, 0] = _evidence(grams(), s.grams, y[~fold])
        seen = (p["word"][t.bucket, 0] + t.gram_sums(None, p["char"][:, :1])[:, 0])

    def best(epoch: int) -> tuple[np.ndarray, np.ndarray]:
        """Per document the first word of its most toxic window (-1 without words), and that window's score. Texts are
        scored some at a time; the first epoch goes by the evidence of the window's most telling word."""
        top, value = np.full(len(texts), -1), np.full(len(texts), -np.inf)
        inputs = _project(p, t) if epoch else None
        for a, b in t.blocks(_BLOCK):
            some = t.part(a, b)
            start, doc = some.windows(s)
            if not len(start):
                continue
            if epoch:
                score = _logits(p, inputs, some, s)
            else:
                word = np.append(seen[some.word], np.full(s.window, -np.inf))
                ends = np.minimum(start + s.window, some.first[doc + 1])
                score = np.max([np.where(start + k < ends, word[start + k], -np.inf) for k in range(s.window)], axis=0)
            order = np.lexsort((-score, doc))
            order = order[np.concatenate([[True], np.diff(doc[order]) != 0])]
            top[a + doc[order]], value[a + doc[order]] = t.first[a] + start[order], score[order]
        return top, value

    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    upto = np.cumsum(np.where(fold, 0, n_windows))  # windows of the training texts, one after another
    step = 0
    for epoch in range(s.epochs if len(upto) and upto[-1] else 0):
        first, _ = best(epoch)
        own = np.flatnonzero(~fold & (first >= 0))
        pick = np.unique(rng.integers(0, upto[-1], min(int(upto[-1]), 2 * len(own))))
        other = np.searchsorted(upto, pick, "right")
        place = pick - (upto - np.where(fold, 0, n_windows))[other]
        other, place = other[y[other] == 0], place[y[other] == 0]
        doc, start = np.concatenate([own, other]), np.concatenate([first[own], t.first[other] + place])
        chosen = np.arange(len(doc))
        toxic = chosen[y[doc[chosen]] == 1]
        clean = chosen[y[doc[chosen]] == 0]
        if len(toxic) and len(clean) > 2 * len(toxic):  # rare positives are shown more often
            toxic = np.tile(toxic, min(8, len(clean) // (2 * len(toxic)) + 1))
        chosen = rng.permutation(np.concatenate([toxic, clean]))
        batch = min(s.batch, max(16, len(chosen) // 40))  # few labels: smaller batches, so that there are enough steps
        for at in range(0, len(chosen), batch):
            some = chosen[at:at + batch]
            g = _gradients(p, t, *_batch(t, start[some], doc[some], s), y[doc[some]])
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            rate = s.rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, v in g.items():
                v = v / max(1.0, size)
                m1, m2 = moment[k]
                m1 += 0.1 * (v - m1)
                m2 += 0.001 * (v * v - m2)
                p[k] -= (rate * m1 / (np.sqrt(m2) + 1e-7)).astype(np.float32)
    p["offset"] = np.zeros(1)
    if len(t.word):
        _, value = best(1)
        use = fold & np.isfinite(value) if len(np.unique(y[fold & np.isfinite(value)])) > 1 else np.isfinite(value)
        p["offset"][0] = np.log(s.threshold / (1 - s.threshold)) - _cut(value[use], y[use])
    return p


def _cut(values: np.ndarray, y: np.ndarray) -> float:
    """The value that separates the classes with the fewest errors; among equal ones the middle."""
    order = np.argsort(values)
    v, k = values[order], y[order] == 1
    errors = np.concatenate([[0], np.cumsum(k)]) + np.concatenate([np.cumsum(~k[::-1])[::-1], [0]])
    mids = np.concatenate([[v[0] - 1], (v[1:] + v[:-1]) / 2, [v[-1] + 1]])
    best = np.flatnonzero(errors == errors.min())
    return float((mids[best[0]] + mids[best[-1]]) / 2)


def held_out(doc_id) -> "F.Column":
    """Rows that training must not see: crc32 of the id as text, modulo 3, is 1 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[list, list]:
    """At most ``sample_rows`` labelled texts outside the held-out rows, in the order of a hash of their id: half of
    the places are for toxic rows, as far as there are so many."""
    y = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").alias("l_id")).agg(F.max(F.col("toxic")).alias("y"))
    parts = [y.where(F.col("y") == k).orderBy(F.xxhash64("l_id"), "l_id").limit(s.sample_rows // 2) for k in (1, 0)]
    chosen = parts[0].unionByName(parts[1])
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("l_id")).select(
        "doc_id", "text", "y").orderBy(F.xxhash64("doc_id"), "text").limit(s.sample_rows).collect()
    return [r.text for r in rows], [int(r.y) for r in rows]


def score_documents(docs: DataFrame, model: dict[str, np.ndarray], s: Settings, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` per row of ``docs``; the score of a text without words is 0.

    One pass, no shuffle; texts are read in chunks of about half a megabyte, so memory does not grow with a batch.
    Null ids and repeated rows are scored like any other; null texts count as empty; extra columns are ignored.
    """
    p, size = {k: v for k, v in model.items()}, 1 << 19

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _powers()

        def scores(texts: list[str | None]) -> np.ndarray:
            t = _Text(texts, s, powers)
            best = _most(_logits(p, _project(p, t), t, s), t.windows(s)[1], len(texts))
            return np.where(np.isfinite(best), _sigmoid(best + p["offset"][0]), 0.0)

        for frame in frames:
            out, texts, bytes_ = [], [], 0
            for text in frame["text"]:
                texts.append(text)
                bytes_ += len(text or "")
                if bytes_ >= size:
                    out.append(scores(texts))
                    texts, bytes_ = [], 0
            if texts:
                out.append(scores(texts))
            score = np.concatenate(out) if out else np.zeros(0)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": score,
                                "predicted": (score >= s.threshold).astype(np.int32)})

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, "doc_id bigint, score double, predicted int")
