"""A bidirectional gated recurrent network with attention pooling in numpy: its gradients and its fast form for scoring."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

WORD = re.compile(r"\w+")
GRAM = 4
MIN_DOCUMENTS = 4  # words and n-grams of fewer training documents are unknown
SIZE, HIDDEN, ATTENTION = 16, 8, 8
LENGTH, STRIDE = 32, 16  # words in a window, and from one window to the next: any 16 words in a row lie within one
PARAMETERS = ("word", "gram", "wf", "uf", "bf", "wb", "ub", "bb", "a", "a0", "v", "u", "c")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str) -> list[str]:
    """Character n-grams with the word's ends marked."""
    marked = f"<{word}>"
    return [marked[i : i + GRAM] for i in range(max(1, len(marked) - GRAM + 1))]


def vocabulary(documents: list[list[str]], labels: np.ndarray) -> tuple[dict[str, int], dict[str, int], np.ndarray, np.ndarray]:
    """Numbers from 1 of the words and n-grams of at least ``MIN_DOCUMENTS`` documents, and how far each speaks for label 1.

    The last two are log odds over documents, drawn to 0 for what few documents of label 1 have; at 0 is 0.
    """
    numbers, odds = [], []
    for grams in (False, True):
        seen = (Counter(), Counter())
        for words, label in zip(documents, labels.astype(int)):
            distinct = set(words)
            seen[label].update({g for w in distinct for g in grams_of(w)} if grams else distinct)
        chosen = sorted(w for w, n in (seen[0] + seen[1]).items() if n >= MIN_DOCUMENTS)
        numbers.append({w: i + 1 for i, w in enumerate(chosen)})
        with_it = np.array([[seen[0][w], seen[1][w]] for w in chosen], dtype=np.float64).reshape(-1, 2)
        total = np.array([(labels == 0).sum(), (labels == 1).sum()])
        logs = np.log((with_it + 0.5) / (total + 1))
        sure = np.minimum(1, with_it[:, 1] / 8) * (with_it[:, 1] >= 4)
        odds.append(np.concatenate([[0], np.clip((logs[:, 1] - logs[:, 0]) * sure, -1, 4)]).astype(np.float32))
    return numbers[0], numbers[1], odds[0], odds[1]


def new_parameters(word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random numbers; the first dimension of the vectors starts from the log odds, and attention at large ones."""
    rng = np.random.RandomState(seed)
    features = 2 * HIDDEN + SIZE

    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {}
    for name, odds in (("word", word_odds), ("gram", gram_odds)):
        p[name] = (rng.standard_normal((len(odds), SIZE)) * 0.05).astype(np.float32)
        p[name][:, 0] = odds
        p[name][0] = 0
    for side in "fb":
        p |= {f"w{side}": draw(SIZE, 3 * HIDDEN), f"u{side}": draw(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
    p |= {"a": draw(features, ATTENTION) * 0.3, "a0": np.zeros(ATTENTION, np.float32), "v": draw(ATTENTION) * 0.3, "u": draw(features) * 0.3}
    p["a"][2 * HIDDEN, 0], p["v"][0], p["u"][2 * HIDDEN] = 0.5, 4, 1.5
    return p | {"c": np.full(1, -2, np.float32)}


class Inputs:
    """Numbers for words, and the rows that make up each word's vector; number 0 is padding. Unknown words and n-grams add 0."""

    def __init__(self, words: dict[str, int], grams: dict[str, int]):
        self.words, self.grams = words, grams
        self.number: dict[str, int] = {"": 0}
        self.word, self.gram, self.owner, self.share = [0], [], [], []

    def ids(self, words: list[str]) -> list[int]:
        known = self.grams
        for w in words:
            if w not in self.number:
                self.number[w] = n = len(self.word)
                found = grams_of(w)
                rows = [row for g in found if (row := known.get(g))]
                self.word.append(self.words.get(w, 0))
                self.gram += rows
                self.owner += [n] * len(rows)
                self.share += [1 / len(found)] * len(rows)
        return [self.number[w] for w in words]

    def vectors(self, p: dict[str, np.ndarray]) -> np.ndarray:
        x = p["word"][self.word]
        parts = p["gram"][self.gram] * np.array(self.share, dtype=np.float32)[:, None]
        if self.owner:
            owner = np.array(self.owner)
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            x[owner[heads]] += np.add.reduceat(parts, heads)
        return x


def window_ids(ids: np.ndarray) -> np.ndarray:
    """All windows of ``LENGTH`` words, ``STRIDE`` apart, up to the end; one at least, padded with 0."""
    count = 1 + max(0, -(-(len(ids) - LENGTH) // STRIDE))
    padded = np.zeros((count - 1) * STRIDE + LENGTH, dtype=np.int64)
    padded[: len(ids)] = ids
    return padded[np.arange(count)[:, None] * STRIDE + np.arange(LENGTH)[None, :]]


def _run(gates: np.ndarray, u: np.ndarray, mask: np.ndarray):
    """Hidden states of one direction and what its gradient needs. ``gates``: time, window, 3 x hidden."""
    steps, n, _ = gates.shape
    h = np.zeros((steps + 1, n, HIDDEN), dtype=np.float32)
    kept = []
    for t in range(steps):
        from_state = h[t] @ u
        zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + from_state[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        inner = from_state[:, 2 * HIDDEN :]
        new = np.tanh(gates[t, :, 2 * HIDDEN :] + r * inner)
        m = mask[t][:, None]
        h[t + 1] = m * ((1 - z) * new + z * h[t]) + (1 - m) * h[t]
        kept.append((z, r, inner, new))
    return h, kept


def _run_back(dh: np.ndarray, h: np.ndarray, kept: list, u: np.ndarray, mask: np.ndarray):
    d_gates = np.zeros((len(kept), dh.shape[1], 3 * HIDDEN), dtype=np.float32)
    du, carry = np.zeros_like(u), np.zeros_like(h[0])
    for t in reversed(range(len(kept))):
        z, r, inner, new = kept[t]
        m = mask[t][:, None]
        total = dh[t] + carry
        through = total * m
        dn = through * (1 - z) * (1 - new**2)
        dz = through * (h[t] - new) * z * (1 - z)
        dr = dn * inner * r * (1 - r)
        d_gates[t] = np.concatenate([dz, dr, dn], axis=1)
        d_state = np.concatenate([dz, dr, dn * r], axis=1)
        du += h[t].T @ d_state
        carry = total * (1 - m) + through * z + d_state @ u.T
    return d_gates, du


def forward(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray):
    """A logit for each window; ``x``: time, window, ``SIZE``."""
    fore, kept_f = _run(x @ p["wf"] + p["bf"], p["uf"], mask)
    back, kept_b = _run((x @ p["wb"] + p["bb"])[::-1], p["ub"], mask[::-1])
    features = np.concatenate([fore[1:], back[1:][::-1], x], axis=2)
    hidden = np.tanh(features @ p["a"] + p["a0"])
    weight = np.exp(np.clip(hidden @ p["v"], -30, 30)) * mask
    weight = weight / np.maximum(weight.sum(0), 1e-9)
    pooled = (weight[:, :, None] * features).sum(0)
    return pooled @ p["u"] + p["c"][0], (x, mask, fore, kept_f, back, kept_b, features, hidden, weight, pooled)


def backward(p: dict[str, np.ndarray], d_logit: np.ndarray, state) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of all but the vectors, and the gradient of ``x``."""
    x, mask, fore, kept_f, back, kept_b, features, hidden, weight, pooled = state
    g = {"u": pooled.T @ d_logit, "c": np.array([d_logit.sum()], dtype=np.float32)}
    d_pooled = d_logit[:, None] * p["u"][None, :]
    d_weight = (features * d_pooled[None]).sum(2)
    d_score = weight * (d_weight - (weight * d_weight).sum(0)[None])
    g["v"] = (hidden * d_score[:, :, None]).sum((0, 1))
    d_hidden = d_score[:, :, None] * p["v"] * (1 - hidden**2)
    g["a"] = np.einsum("tbf,tba->fa", features, d_hidden, optimize=True)
    g["a0"] = d_hidden.sum((0, 1))
    d_features = weight[:, :, None] * d_pooled[None] + d_hidden @ p["a"].T
    d_x = d_features[:, :, 2 * HIDDEN :].copy()
    for side, h, kept, flip in (("f", fore, kept_f, 1), ("b", back, kept_b, -1)):
        part = d_features[:, :, :HIDDEN] if side == "f" else d_features[:, :, HIDDEN : 2 * HIDDEN]
        d_gates, g[f"u{side}"] = _run_back(part[::flip], h, kept, p[f"u{side}"], mask[::flip])
        d_gates = d_gates[::flip]
        g[f"w{side}"] = np.einsum("tbi,tbj->ij", x, d_gates, optimize=True)
        g[f"b{side}"] = d_gates.sum((0, 1))
        d_x += d_gates @ p[f"w{side}"].T
    return g, d_x


def train(texts: list[str], labels: list[int], *, epochs: int = 5, batch: int = 32, rate: float = 0.01, drop: float = 0.15, decay: float = 1e-4, seed: int = 7):
    """Vocabulary and parameters, fitted by Adam to labels 0 and 1.

    A document's logit is the mean of its windows', weighted towards the largest; the rare label weighs more. In the
    end the constant is moved to where the largest windows tell the two labels apart best.
    """
    rng = np.random.RandomState(seed)
    documents = [words_of(t) for t in texts]
    words, grams, word_odds, gram_odds = vocabulary(documents, np.array(labels))
    inputs, p = Inputs(words, grams), new_parameters(word_odds, gram_odds)
    if not texts:
        return words, grams, p
    windows = [window_ids(np.array(inputs.ids(d), dtype=np.int64)) for d in documents]
    y = np.array(labels, dtype=np.float32)
    positive = np.clip(y.mean(), 0.05, 0.95)
    importance = np.where(y > 0, 0.5 / positive, 0.5 / (1 - positive)).astype(np.float32)
    gram, owner = np.array(inputs.gram, dtype=np.int64), np.array(inputs.owner, dtype=np.int64)
    share = np.array(inputs.share, dtype=np.float32)
    of_owner = np.searchsorted(owner, np.arange(len(inputs.word) + 1))
    word = np.array(inputs.word)
    first, second = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), batch):
            docs = order[begin : begin + batch]
            ids = np.concatenate([windows[d] for d in docs])
            of_doc = np.repeat(np.arange(len(docs)), [len(windows[d]) for d in docs])
            ids = np.where(rng.random_sample(ids.shape) < drop, 0, ids).T
            used, place = np.unique(ids, return_inverse=True)
            place = place.reshape(ids.shape)
            at = np.concatenate([np.arange(of_owner[k], of_owner[k + 1]) for k in used])
            local = np.searchsorted(used, owner[at])
            vectors = p["word"][word[used]].copy()
            np.add.at(vectors, local, p["gram"][gram[at]] * share[at][:, None])
            mask = (ids > 0).astype(np.float32)
            logit, state = forward(p, vectors[place], mask)
            peak = np.full(len(docs), -np.inf, dtype=np.float32)
            np.maximum.at(peak, of_doc, logit)
            soft = np.exp(2 * (logit - peak[of_doc]))
            soft /= np.bincount(of_doc, soft)[of_doc]
            whole = np.bincount(of_doc, soft * logit)
            error = (_sigmoid(whole) - y[docs]) * importance[docs] / len(docs)
            g, d_x = backward(p, (error[of_doc] * soft).astype(np.float32), state)
            d_vectors = np.zeros_like(vectors)
            np.add.at(d_vectors, place.ravel(), d_x.reshape(-1, SIZE))
            step += 1
            speed = rate * (1 - epoch / (epochs + 1))
            for k in PARAMETERS:
                if k in ("word", "gram"):  # only the rows in use
                    rows, inverse = np.unique(word[used] if k == "word" else gram[at], return_inverse=True)
                    grad = np.zeros((len(rows), SIZE), dtype=np.float32)
                    np.add.at(grad, inverse, d_vectors if k == "word" else d_vectors[local] * share[at][:, None])
                    grad[rows == 0] = 0
                else:
                    rows, grad = slice(None), g[k]
                grad = grad + decay * p[k][rows]
                first[k][rows] += 0.1 * (grad - first[k][rows])
                second[k][rows] += 0.01 * (grad**2 - second[k][rows])
                p[k][rows] -= speed * (first[k][rows] / (1 - 0.9**step)) / (np.sqrt(second[k][rows] / (1 - 0.99**step)) + 1e-6)
    peak = Scorer((words, grams, p)).logits(texts)
    p["c"] -= _best_cut(peak, y, importance)
    return words, grams, p


def _best_cut(peak: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.float32:
    """The middle of the cuts with the least weighted error."""
    order = np.argsort(peak, kind="stable")
    sorted_peak = np.concatenate([[peak.min() - 1], peak[order], [peak.max() + 1]])
    missed = np.cumsum(np.concatenate([[0], np.where(y[order] > 0, weight[order], 0)]))
    wrong = missed + np.concatenate([[0], np.cumsum(np.where(y[order] > 0, 0, weight[order])[::-1])])[::-1]
    best = np.flatnonzero(wrong <= wrong.min() + 1e-6)
    return np.float32((sorted_peak[best[0]] + sorted_peak[best[-1] + 1]) / 2)


class Scorer:
    """Scores texts; what a word adds to the gates and to attention is computed once and remembered."""

    BATCH = 2048  # windows
    CACHE = 100_000  # words

    def __init__(self, model: tuple[dict[str, int], dict[str, int], dict[str, np.ndarray]]):
        self.words, self.grams, self.p = model
        self.number: dict[str, int] = {}
        # Per word: the gates of both directions, its part of attention, its part of the logit.
        self.table = np.zeros((self.CACHE + 1, 6 * HIDDEN + ATTENTION + 1), dtype=np.float32)

    def _learn(self, words: list[str]):
        inputs = Inputs(self.words, self.grams)
        inputs.ids(words)
        x = inputs.vectors(self.p)[1:]
        p, edge = self.p, 2 * HIDDEN
        rows = np.concatenate(
            [x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"], x @ p["a"][edge:] + p["a0"], (x @ p["u"][edge:])[:, None]], axis=1
        )
        start = len(self.number) + 1
        self.table[start : start + len(words)] = rows
        self.number.update(zip(words, range(start, start + len(words))))

    def _logits(self, ids: np.ndarray) -> np.ndarray:
        p, out = self.p, []
        for begin in range(0, len(ids), self.BATCH):
            part = np.ascontiguousarray(ids[begin : begin + self.BATCH].T)
            mask = (part > 0).astype(np.float32)
            rows = self.table[part]
            states = []
            for u, gates, flip in ((p["uf"], rows[:, :, : 3 * HIDDEN], 1), (p["ub"], rows[:, :, 3 * HIDDEN : 6 * HIDDEN], -1)):
                h = np.zeros((part.shape[1], HIDDEN), dtype=np.float32)
                steps = np.empty((len(part), part.shape[1], HIDDEN), dtype=np.float32)
                for t in range(len(part))[::flip]:
                    from_state = h @ u
                    zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + from_state[:, : 2 * HIDDEN])
                    new = np.tanh(gates[t, :, 2 * HIDDEN :] + zr[:, HIDDEN:] * from_state[:, 2 * HIDDEN :])
                    m = mask[t][:, None]
                    h = h + m * (1 - zr[:, :HIDDEN]) * (new - h)
                    steps[t] = h
                states.append(steps)
            both = np.concatenate(states, axis=2)
            edge = 2 * HIDDEN
            hidden = np.tanh(both @ p["a"][:edge] + rows[:, :, 6 * HIDDEN : 6 * HIDDEN + ATTENTION])
            weight = np.exp(np.clip(hidden @ p["v"], -30, 30)) * mask
            weight /= np.maximum(weight.sum(0), 1e-9)
            out.append((weight * (both @ p["u"][:edge] + rows[:, :, -1])).sum(0) + p["c"][0])
        return np.concatenate(out)

    def logits(self, texts: list[str]) -> np.ndarray:
        """The largest logit over each text's windows."""
        best = np.full(len(texts), -np.inf)
        stretch = STRIDE * self.BATCH  # words; long texts go in stretches that share their windows' overlap
        parts: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            words = words_of(text)
            for begin in range(0, max(1, len(words) - LENGTH + STRIDE), stretch):
                parts.append((i, words[begin : begin + stretch - STRIDE + LENGTH]))
                size += len(parts[-1][1])
                if size >= stretch:
                    self._score(parts, best)
                    parts, size = [], 0
        self._score(parts, best)
        return best

    def _score(self, parts: list[tuple[int, list[str]]], best: np.ndarray):
        if not parts:
            return
        new = set().union(*(words for _, words in parts)) - self.number.keys()
        if len(self.number) + len(new) > self.CACHE:
            self.number.clear()
            new = set().union(*(words for _, words in parts))
        if new:
            self._learn(sorted(new))
        known = self.number
        windows = [window_ids(np.array([known[w] for w in words], dtype=np.int64)) for _, words in parts]
        logits = self._logits(np.concatenate(windows))
        heads = np.cumsum([0] + [len(w) for w in windows[:-1]])
        np.maximum.at(best, [i for i, _ in parts], np.maximum.reduceat(logits, heads))

    def scores(self, texts: list[str]) -> np.ndarray:
        """The largest probability over each text's windows."""
        return _sigmoid(self.logits(texts))
