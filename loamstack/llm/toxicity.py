"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Words are split at blanks and punctuation of any script; longer ones than ``PIECE``
characters enter as overlapping pieces.  A word enters by a vector of its own, which every
word of ``LEAST_ROWS`` training rows has, and by its characters: each has a vector, filters
of ``WIDTH`` characters run over them in order, and the greatest response of each filter is
read.  Two gated recurrent layers, one in each direction, run over the text; the state at a
word comes from its block of ``BLOCK`` words and ``LEAD`` more on either side, so blocks
are read at once.  Attention pools the states of a window of ``WINDOW`` words and a logistic
unit scores it.  A window begins at every word; a document scores as its worst window.

Training is in numpy (backpropagation through time, Adam).  Word vectors start at the log odds
of their presence between the classes, shrunk by ``SHRINK`` rows, and the character filters
are first fitted to tell the classes' words apart; then all parameters learn from the worst
windows of each labelled document.

Defined results: a null, empty or wordless text is one window without words; a null id
is never held out; repeated rows score alike; without training rows of both classes every
document scores the prior 0.0 and nothing is predicted toxic; other columns are not read.
"""

from __future__ import annotations

import os
import pickle
import re
import subprocess
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import memory, store

WINDOW = 40
#: Words whose states are computed together, and words on either side over which the layers run up to them.
BLOCK, LEAD = 40, 20
SLICE = LEAD + BLOCK + LEAD
HIDDEN = 8
WORD_DIM = 6
GRAM_DIM = 6
CHAR_DIM = 8
#: Code points with a vector of their own, and vectors that the others share.
LETTERS, FAR_LETTERS = 768, 1021
#: Characters that a filter sees, and the filters.
WIDTH = 5
FILTERS = 24
#: The most labelled rows that are fitted, half of each class where there are so many, and their most bytes.
TRAIN_ROWS = 2400
TRAIN_BYTES = 16 << 20
#: Labelled texts beyond so many bytes are drawn after all others.
LONG_BYTES = 128 << 10
#: Rows that a word needs for a vector of its own, and rows of each class by which its odds are shrunk.
LEAST_ROWS = 3
SHRINK = 8.0
#: Steps in which the filters are fitted to words, and words of a step.
WORD_STEPS = 800
WORD_BATCH = 1024
#: Words of the documents kept out of that fit on which it is judged.
JUDGED_WORDS = 4096
EPOCHS = 20
#: Documents of a step.
BATCH = 128
#: Epochs after which the worst windows are looked for anew.
AGAIN = 3
#: Blocks that are read at a time.
BLOCKS = 512
THRESHOLD = 0.7
HELD_OUT = 1
MEMORY_WORDS = 100_000

_KEEP = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or b == 39 else 32 for b in range(256))


#: Blanks, controls and punctuation beyond ASCII, also those without width.
_BREAKS = [c for c in map(chr, range(128, 0x20000)) if unicodedata.category(c)[0] in "PZ" or unicodedata.category(c) == "Cc" or c in "\u200b\u2060\ufeff"]
_APART = re.compile("[" + "".join(c for c in _BREAKS if c <= "\uffff") + "]")
#: A class that is not of the basic plane alone is searched slowly.
_FAR_APART = re.compile("[" + "".join(c for c in _BREAKS if c > "\uffff") + "]")


def _part(text: str) -> str:
    text = _APART.sub(" ", text)
    return _FAR_APART.sub(" ", text) if max(text, default="") > "\uffff" else text


#: Characters of a word at most, and by how many pieces of a longer one overlap.
PIECE, OVERLAP = 40, 8


def words(text: str | None) -> list[bytes]:
    """Words in lower case; one of more than ``PIECE`` characters as overlapping pieces."""
    if not isinstance(text, str):
        return []
    low = text.lower()
    found = (low if low.isascii() else _part(low)).encode("utf-8", "surrogatepass").translate(_KEEP).split()
    if max(map(len, found), default=0) > PIECE:
        found = [p for w in found for p in (pieces(w) if len(w) > PIECE else (w,))]
    return found


def pieces(word: bytes) -> list[bytes]:
    w = word.decode("utf-8", "surrogatepass")
    return [w[k : k + PIECE].encode("utf-8", "surrogatepass") for k in range(0, max(len(w) - OVERLAP, 1), PIECE - OVERLAP)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Model:
    """Parameters, and the forward and backward passes over windows of word vectors."""

    def __init__(self, word_odds: dict[bytes, float], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.word_index = {w: k + 1 for k, w in enumerate(word_odds)}
        d, h = WORD_DIM + GRAM_DIM, HIDDEN
        init = lambda *s: rng.normal(0, 1 / np.sqrt(s[-2] if len(s) > 1 else s[0]), s)
        self.p = {
            "words": np.vstack([np.zeros(WORD_DIM), rng.normal(0, 0.05, (len(word_odds), WORD_DIM))]),
            "chars": np.vstack([np.zeros(CHAR_DIM), rng.normal(0, 1, (LETTERS + FAR_LETTERS - 1, CHAR_DIM))]),
            "filters": rng.normal(0, 1 / np.sqrt(WIDTH * CHAR_DIM), (WIDTH, CHAR_DIM, FILTERS)), "least": np.full(FILTERS, -0.5),
            "squeeze": rng.normal(0, 0.2 / np.sqrt(FILTERS), (FILTERS, GRAM_DIM)),
            "wx": init(2, d, 3 * h), "wh": init(2, h, 3 * h), "b": np.zeros((2, 3 * h)),
            "wa": init(2 * h, h), "ba": np.zeros(h), "va": init(h), "out": init(2 * h), "bias": np.zeros(1),
        }
        # The first coordinate of each vector starts at its log odds between the classes.
        self.p["words"][1:, 0] = 0.5 * np.array(list(word_odds.values()), float)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def responses(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Greatest response of each filter in each word, all responses, all characters, and the word of each."""
        flat, sizes, order = spelled(found)
        p, seen = self.p, int(sizes.sum())
        out = np.zeros((seen, FILTERS), p["filters"].dtype)
        for k in range(WIDTH):
            out += (p["chars"] @ p["filters"][k])[flat[k : seen + k]]
        best, at = np.zeros((len(found), FILTERS), out.dtype), 0
        # Words of equal length stand together.
        for size, n in zip(*np.unique(sizes, return_counts=True)):
            which = order[sizes[order] == size]
            part = out[at : at + n * size].reshape(n, size, FILTERS)
            part[:, size - WIDTH + 1 :] = -np.inf  # from the gap a filter would see the next word
            best[which] = part.max(1)
            at += n * size
        return best, out, flat, np.repeat(order, sizes[order])

    def spelling(self, found: list[bytes]) -> np.ndarray:
        """The characters' part of the words' vectors."""
        best = self.responses(found)[0]
        return np.maximum(best + self.p["least"], 0) @ self.p["squeeze"]

    def spelling_backward(self, kept, dvec: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the characters' part; kept: of ``responses``, dvec: of the vectors."""
        p = self.p
        best, out, flat, owner = kept
        live = best + p["least"]
        g = {"squeeze": np.maximum(live, 0).T @ dvec}
        dbest = np.where(live > 0, dvec @ p["squeeze"].T, 0)
        g["least"] = dbest.sum(0)
        g["chars"], g["filters"] = np.zeros_like(p["chars"]), np.zeros_like(p["filters"])
        at, which = np.nonzero(out == best[owner])
        # Of equal responses in a word the first counts.
        _, first = np.unique(owner[at] * FILTERS + which, return_index=True)
        at, which = at[first], which[first]
        value = dbest[owner[at], which]
        for k in range(WIDTH):
            table = np.bincount(flat[at + k].astype(np.int64) * FILTERS + which, value, p["chars"].shape[0] * FILTERS).reshape(-1, FILTERS)
            g["filters"][k] = p["chars"].T @ table
            g["chars"] += table @ p["filters"][k].T
        g["chars"][0] = 0
        return g

    def vectors(self, found: list[bytes]) -> np.ndarray:
        """Input vectors of words."""
        own = np.fromiter((self.word_index.get(w, 0) for w in found), np.int64, len(found))
        return np.hstack([self.p["words"][own], self.spelling(found)])

    def forward(self, x: np.ndarray, mask: np.ndarray, pooled_mask: np.ndarray, keep: bool = False):
        """Logit of each window.  x: [n, t, d]; mask: [n, t], where there are words; pooled_mask: [n, t], the window's."""
        p, h = self.p, HIDDEN
        n, t, _ = x.shape
        states, saved = np.zeros((n, t, 2 * h), x.dtype), []
        for d in range(2):
            xs = x @ p["wx"][d] + p["b"][d]
            wh, s, steps = p["wh"][d], np.zeros((n, h), x.dtype), []
            for k in range(t) if d == 0 else range(t - 1, -1, -1):
                m = mask[:, k, None]
                hh = s @ wh
                gate = _sigmoid(xs[:, k, : 2 * h] + hh[:, : 2 * h])
                z, r = gate[:, :h], gate[:, h:]
                new = np.tanh(xs[:, k, 2 * h :] + r * hh[:, 2 * h :])
                after = m * ((1 - z) * new + z * s) + (1 - m) * s
                if keep:
                    steps.append((k, s, z, r, new, hh[:, 2 * h :]))
                s = after
                states[:, k, d * h : d * h + h] = s
            saved.append(steps)
        hidden = np.tanh(states @ p["wa"] + p["ba"])
        e = np.where(pooled_mask > 0, hidden @ p["va"], -1e9)
        e = np.exp(e - e.max(1, keepdims=True)) * pooled_mask
        alpha = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
        pooled = (alpha[:, :, None] * states).sum(1)
        logit = pooled @ p["out"] + p["bias"][0]
        return (logit, (states, saved, hidden, alpha, pooled)) if keep else logit

    def backward(self, x, mask, kept, dlogit) -> tuple[dict[str, np.ndarray], np.ndarray]:
        p, h = self.p, HIDDEN
        states, saved, hidden, alpha, pooled = kept
        g = {"out": pooled.T @ dlogit, "bias": np.array([dlogit.sum()])}
        dpooled = dlogit[:, None] * p["out"]
        dstates = alpha[:, :, None] * dpooled[:, None, :]
        dalpha = (states * dpooled[:, None, :]).sum(2)
        de = alpha * (dalpha - (alpha * dalpha).sum(1, keepdims=True))
        g["va"] = np.einsum("nth,nt->h", hidden, de)
        dhidden = de[:, :, None] * p["va"] * (1 - hidden**2)
        g["wa"], g["ba"] = np.einsum("nts,nth->sh", states, dhidden), dhidden.sum((0, 1))
        dstates = dstates + dhidden @ p["wa"].T
        g |= {k: np.zeros_like(p[k]) for k in ("wx", "wh", "b")}
        dx = np.zeros_like(x)
        for d in range(2):
            ds = np.zeros((len(x), h), x.dtype)
            for k, s, z, r, new, hn in reversed(saved[d]):
                m = mask[:, k, None]
                ds = ds + dstates[:, k, d * h : d * h + h]
                live = m * ds
                dnew = live * (1 - z) * (1 - new**2)
                dz = live * (s - new) * z * (1 - z)
                dr = dnew * hn * r * (1 - r)
                dxs = np.concatenate([dz, dr, dnew], 1)
                dhh = np.concatenate([dz, dr, dnew * r], 1)
                g["wh"][d] += s.T @ dhh
                g["wx"][d] += x[:, k].T @ dxs
                g["b"][d] += dxs.sum(0)
                dx[:, k] += dxs @ p["wx"][d].T
                ds = live * z + (1 - m) * ds + dhh @ p["wh"][d].T
        return g, dx

    def attended(self, vectors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention and logit of each word of the blocks, as ``forward`` has them.  rows: [SLICE, n], rows of ``vectors`` (0: no word)."""
        p, h = self.p, HIDDEN
        n = rows.shape[1]
        states = np.empty((BLOCK, n, 2 * h), np.float32)
        half = np.concatenate([np.full(2 * h, 0.5), np.ones(h)]).astype(np.float32)
        for d in range(2):
            given = ((vectors @ p["wx"][d] + p["b"][d]) * half).astype(np.float32)
            given[0, :h] = 30  # where there is no word the state stays
            wh = (p["wh"][d] * half).astype(np.float32)
            s = np.zeros((n, h), np.float32)
            for k in range(LEAD + BLOCK) if d == 0 else range(SLICE - 1, LEAD - 1, -1):
                x = given[rows[k]]
                hh = s @ wh
                # The logistic function is half of one plus the tangent of half.
                gate = np.tanh(x[:, : 2 * h] + hh[:, : 2 * h])
                gate *= 0.5
                gate += 0.5
                new = hh[:, 2 * h :] * gate[:, h:]
                new += x[:, 2 * h :]
                np.tanh(new, out=new)
                s = s - new
                s *= gate[:, :h]
                s += new
                if LEAD <= k < LEAD + BLOCK:
                    states[k - LEAD, :, d * h : d * h + h] = s
        flat = states.reshape(-1, 2 * h)
        e = np.tanh(flat @ p["wa"].astype(np.float32) + p["ba"].astype(np.float32)) @ p["va"].astype(np.float32)
        return np.exp(e.astype(float)).reshape(BLOCK, n), (flat @ p["out"].astype(np.float32)).astype(float).reshape(BLOCK, n)

    def worst(self, vectors: np.ndarray, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Largest logit of each document's windows, and where that window begins.  docs: rows of ``vectors``, none of them 0."""
        bias = float(self.p["bias"][0])
        logit, start = np.full(len(docs), bias), np.zeros(len(docs), np.int64)
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        blocks = -(-lengths // BLOCK)
        first = np.cumsum(blocks) - blocks
        padded = np.zeros(int((blocks * BLOCK + 2 * LEAD).sum()), np.int32)
        places = first * BLOCK + 2 * LEAD * np.arange(len(docs))
        for at, row in zip(places + LEAD, docs):
            padded[at : at + len(row)] = row
        begins = np.repeat(places - first * BLOCK, blocks) + BLOCK * np.arange(blocks.sum())
        weight, told = np.zeros(len(begins) * BLOCK), np.zeros(len(begins) * BLOCK)
        for k in range(0, len(begins), BLOCKS):
            used, rows = np.unique(padded[begins[k : k + BLOCKS] + np.arange(SLICE)[:, None]], return_inverse=True)
            if used[0] != 0:
                used, rows = np.append(0, used), rows + 1
            e, o = self.attended(vectors[used], rows.reshape(SLICE, -1))
            weight[k * BLOCK : (k + BLOCKS) * BLOCK] = e.T.reshape(-1)
            told[k * BLOCK : (k + BLOCKS) * BLOCK] = (e * o).T.reshape(-1)
        over = [sliding(told), sliding(weight)]
        for d, n in enumerate(lengths.tolist()):
            at = first[d] * BLOCK
            if n > WINDOW:
                scores = over[0][at : at + n - WINDOW + 1] / over[1][at : at + n - WINDOW + 1]
                start[d] = scores.argmax()
                logit[d] += scores[start[d]]
            elif n:
                logit[d] += told[at : at + n].sum() / weight[at : at + n].sum()
        return logit, start


def sliding(values: np.ndarray) -> np.ndarray:
    """Sum over the window that begins at each place, by doubling."""
    out, done, width, power = None, 0, WINDOW, values
    step = 1
    while width:
        if width & 1:
            out = power[done:] if out is None else out[: max(len(power) - done, 0)] + power[done:]
            done += step
        width >>= 1
        if width:
            power, step = power[:-step] + power[step:], 2 * step
    return out


def spelled(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words' characters by their lengths, each word marked at both ends and followed by zeros; the words' sizes and their order."""
    texts = [w.decode("utf-8", "replace") for w in found]
    gap = ">" + "\0" * (WIDTH - 1)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1 + len(gap)
    order = np.argsort(sizes, kind="stable")
    flat = "".join(["<" + texts[k] + gap for k in order.tolist()]) + gap
    points = np.frombuffer(flat.encode("utf-32-le"), "<u4").astype(np.int32)
    return np.where(points < LETTERS, points, LETTERS + points % FAR_LETTERS), sizes, order


class Adam:
    """Adam with a rate that falls to nothing over ``steps`` steps."""

    def __init__(self, p: dict[str, np.ndarray], names: list[str], rate: float, steps: int):
        self.p, self.rate, self.steps, self.step = p, rate, steps, 0
        self.moment = {k: (np.zeros_like(p[k]), np.zeros_like(p[k])) for k in names}

    def __call__(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        rate = self.rate * (1 - (self.step - 1) / self.steps)
        for name, (m, v) in self.moment.items():
            grad = np.clip(grads[name], -1, 1) + 1e-4 * self.p[name]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            self.p[name] -= rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.99**self.step)) + 1e-8)


def fit_spelling(model: Model, found: list[bytes], rows: np.ndarray, kept_out: np.ndarray, sizes: list[int], rng: np.random.Generator) -> None:
    """Fit the filters so that the first coordinate tells in which class a word stands.

    rows, kept_out: [class, word], rows that have it, of those fitted and of those on which
    the fit is judged; the parameters that tell the latter best stay.
    """
    share = rows / np.array(sizes)[:, None] + 1e-12
    weight = share.sum(0)
    target = share[1] / weight
    judged = np.flatnonzero(kept_out.sum(0))
    judged = judged[rng.permutation(len(judged))[:JUDGED_WORDS]]
    judged_share = kept_out[:, judged] / np.array(sizes)[:, None]
    model.p["squeeze"][:, 0] = rng.normal(0, 0.3, FILTERS)
    names = ["chars", "filters", "least", "squeeze"]
    adam = Adam(model.p, names, 0.01, WORD_STEPS)
    bias, chance, best = 0.0, weight / weight.sum(), None
    for step in range(WORD_STEPS):
        part = rng.choice(len(found), WORD_BATCH, p=chance)
        kept = model.responses([found[k] for k in part])
        told = np.maximum(kept[0] + model.p["least"], 0) @ model.p["squeeze"][:, 0]
        apart = (_sigmoid(told + bias) - target[part]) / WORD_BATCH
        bias -= 5 * apart.sum()
        dvec = np.zeros((len(part), GRAM_DIM))
        dvec[:, 0] = apart
        adam({k: 30 * v for k, v in model.spelling_backward(kept, dvec).items()})
        if step % 25 == 24 and len(judged):
            told = model.spelling([found[k] for k in judged])[:, 0] + bias
            loss = float((judged_share[1] * np.logaddexp(0, -told) + judged_share[0] * np.logaddexp(0, told)).sum())
            if best is None or loss < best[0]:
                best = loss, {k: model.p[k].copy() for k in names}
    if best is not None:
        model.p |= best[1]


def train(texts: list[str | None], labels: list[int], seed: int = 7) -> Model | None:
    y = np.array(labels)
    if len(set(labels)) < 2:
        return None
    # Words as numbers, 0: no word.
    number: dict[bytes, int] = {}
    docs = [np.array([number.setdefault(w, len(number) + 1) for w in words(t)], np.int32) for t in texts]
    found = list(number)
    sizes = [int((y == 0).sum()), int((y == 1).sum())]
    rows, kept_out = np.zeros((2, len(found) + 1)), np.zeros((2, len(found) + 1))
    for k, (d, label) in enumerate(zip(docs, labels)):
        (kept_out if k % 5 == 4 else rows)[label, np.unique(d)] += 1
    fitted, kept_out = rows[:, 1:], kept_out[:, 1:]
    rows = fitted + kept_out
    odds = [np.log((rows[c] + SHRINK / 2) / (sizes[c] + SHRINK)) for c in (0, 1)]
    odds = np.clip(odds[1] - odds[0], -4, 4)
    model = Model({w: float(odds[k]) for k, w in enumerate(found) if rows[:, k].sum() >= LEAST_ROWS}, seed)
    rng = np.random.default_rng(seed)
    if found:
        fit_spelling(model, found, fitted, kept_out, sizes, rng)
    own = np.array([0, *(model.word_index.get(w, 0) for w in found)])
    docs = [d for d in docs if len(d)] or docs[:1]
    y = np.array([label for t, label in zip(texts, labels) if words(t)] or labels[:1])
    weight = np.where(y == 1, 0.5 / sizes[1], 0.5 / sizes[0]) * len(y)
    adam = Adam(model.p, list(model.p), 0.01, EPOCHS * -(-len(docs) // BATCH))
    first = np.concatenate([[0.0], odds]).clip(0)
    padded = [np.pad(d, (LEAD, LEAD + BLOCK)) for d in docs]

    def worst() -> np.ndarray:
        """Where the worst window of each document begins."""
        vectors = np.zeros((len(found) + 1, WORD_DIM + GRAM_DIM), np.float32)
        for k in range(0, len(found), 4096):
            vectors[k + 1 : k + 4097] = model.vectors(found[k : k + 4096])
        return np.concatenate([model.worst(vectors, docs[k : k + 256])[1] for k in range(0, len(docs), 256)])

    for epoch in range(EPOCHS):
        if epoch % AGAIN == 0:
            starts = worst() if epoch else np.array([sliding(first[d]).argmax() if len(d) > WINDOW else 0 for d in docs])
        for part in np.array_split(rng.permutation(len(docs)), -(-len(docs) // BATCH)):
            windows = np.stack([padded[d][starts[d] : starts[d] + SLICE] for d in part])
            used, at = np.unique(windows, return_inverse=True)
            at = at.reshape(-1, SLICE)
            mask = (windows > 0).astype(np.float32)
            pooled_mask = mask.copy()
            pooled_mask[:, :LEAD] = pooled_mask[:, LEAD + BLOCK :] = 0
            spelt = [found[u - 1] for u in used if u]
            kept_words = model.responses(spelt)
            vectors = np.zeros((len(used), WORD_DIM + GRAM_DIM), np.float32)
            vectors[used > 0, WORD_DIM:] = np.maximum(kept_words[0] + model.p["least"], 0) @ model.p["squeeze"]
            # Words of few rows are left out at random, so that the network doesn't lean on them.
            heard = rng.random(len(used)) < 1 - 0.5 / np.maximum(1, rows.sum(0)[used - 1] / LEAST_ROWS)
            vectors[:, :WORD_DIM] = model.p["words"][own[used]] * heard[:, None]
            x = vectors[at] * mask[:, :, None]
            logit, kept = model.forward(x, mask, pooled_mask, keep=True)
            g, dx = model.backward(x, mask, kept, ((_sigmoid(logit) - y[part]) * weight[part] / len(part)).astype(np.float32))
            flat = (dx * mask[:, :, None]).reshape(-1, x.shape[2])
            dvec = np.stack([np.bincount(at.reshape(-1), flat[:, c], len(used)) for c in range(flat.shape[1])], 1).astype(np.float32)
            g["words"] = np.zeros_like(model.p["words"])
            np.add.at(g["words"], own[used], dvec[:, :WORD_DIM] * heard[:, None])
            g["words"][0] = 0
            g |= model.spelling_backward(kept_words, dvec[used > 0, WORD_DIM:])
            adam(g)
            model.p["words"][0] = model.p["chars"][0] = 0
    return model


class WordMemory(dict):
    """word -> row of ``vectors``; row 0 is no word.  ``settle`` fills in the rows given since."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.vectors = np.zeros((1, WORD_DIM + GRAM_DIM), np.float32)
        self.used = 1

    def __missing__(self, word: bytes) -> int:
        row = self[word] = self.used
        self.used += 1
        self.new.append(word)
        return row

    def settle(self) -> None:
        if self.used > len(self.vectors):
            grown = np.zeros((max(self.used, 2 * len(self.vectors)), self.vectors.shape[1]), np.float32)
            grown[: len(self.vectors)] = self.vectors
            self.vectors = grown
        for k in range(0, len(self.new), 4096):
            at = self.used - len(self.new) + k
            part = self.new[k : k + 4096]
            self.vectors[at : at + len(part)] = self.model.vectors(part)
        self.new = []


def score_texts(model: Model, texts: list[str | None], memory: WordMemory) -> np.ndarray:
    """Largest window score of each text."""
    docs = [np.fromiter(map(memory.__getitem__, found), np.int32, len(found)) for found in map(words, texts)]
    memory.settle()
    return _sigmoid(model.worst(memory.vectors, docs)[0])


class Scorer:
    """A fitted model with the memory of the words that it has met."""

    def __init__(self, model: Model | None):
        self.model = model
        memory.begin("toxicity")
        if model is not None:
            model.p = {k: v.astype(np.float32) for k, v in model.p.items()}
            self.memory = WordMemory(model)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        scores = np.zeros(len(texts))
        if self.model is not None:
            for k in range(0, len(texts), 256):
                if len(self.memory) > MEMORY_WORDS:
                    self.memory = WordMemory(self.model)
                scores[k : k + 256] = score_texts(self.model, texts[k : k + 256], self.memory)
        return np.round(scores, 6)


def _scorer(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = Scorer(shared.value)
        for rows in batches:
            yield pd.DataFrame({"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": score(rows["text"].tolist())})

    return run


def score_udf(spark: SparkSession, model: Model | None):
    """The score of a text column."""
    shared = spark.sparkContext.broadcast(model)  # words of at most TRAIN_BYTES

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series(scorer(texts.tolist()))

    return score


def remainder(key: str = "doc_id") -> F.Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3


def training_sample(docs: DataFrame, known: DataFrame, rows: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``rows`` labelled rows that have a text, half of each class, of ``TRAIN_BYTES`` at most.

    Rows come in the order of a hash; texts beyond ``LONG_BYTES`` come after all others, the shorter first,
    so a long text costs its own place alone.  Each class has its first row whatever its size.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    sizes = texts.select("doc_id", F.octet_length("text").cast("long").alias("size")).join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.max("size").alias("size"))
    order = [F.when(F.col("size") > LONG_BYTES, F.col("size")).otherwise(0), F.xxhash64("doc_id"), "doc_id"]
    halves = [sizes.where(F.col("toxic") == c).orderBy(*order).limit(rows // 2) for c in (0, 1)]
    places = Window.partitionBy("toxic").orderBy(*order)  # of at most rows / 2 rows
    drawn = halves[0].unionByName(halves[1]).withColumns({"upto": F.sum("size").over(places), "place": F.row_number().over(places)})
    drawn = drawn.where((F.col("upto") <= TRAIN_BYTES // 2) | (F.col("place") == 1)).select("doc_id", "toxic")
    # Of the texts of a repeated id the least.
    return store.materialize(texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "sample")


#: Training in a process of its own, which gives all its memory back to the system: a worker would keep some for the stages after.
_TRAIN = "import sys, pickle; from loamstack.llm import toxicity as t; m = t.train(*pickle.load(sys.stdin.buffer)); sys.stdout.buffer.write(pickle.dumps(m))"


def _trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memory.begin("toxicity-training")
    sample = sorted(row for rows in batches for row in zip(rows["doc_id"], rows["text"], rows["toxic"]))
    given = pickle.dumps(([text for _, text, _ in sample], [int(toxic) for _, _, toxic in sample]))
    path = os.pathsep.join(p for p in sys.path if p)
    model = subprocess.run([sys.executable, "-c", _TRAIN], input=given, stdout=subprocess.PIPE, env=os.environ | {"PYTHONPATH": path}, check=True).stdout
    if pickle.loads(model) is not None:
        yield pd.DataFrame({"model": [model]})
    del sample, given, model
    memory.trim()


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on ``training_sample`` of the labelled rows whose remainder is not the held-out one, in a task of an executor."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.where(remainder() != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = training_sample(docs, known, rows)
    fitted = sample.repartition(1).mapInPandas(_trained, "model binary").collect()  # one model, with the words of the sample
    store.drop(sample)
    if not fitted:
        return None
    model = pickle.loads(fitted[0]["model"])
    # The classes weigh alike in training; scores are for their shares among the labelled rows.
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    model.p["bias"] = model.p["bias"] + np.float32(np.log(n[1] / n[0]))
    return model


def toxicity(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words of at most TRAIN_BYTES
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out"))
    return rows.mapInPandas(_scorer(shared), "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, store.table(spark, sf_dir, "labels")))
