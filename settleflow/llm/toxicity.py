"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.tables import fitted, in_fold, labelled_sample
from settleflow.llm.words import _LOWER, Texts, lengths_to_rows, pieces, spans, word_hashes

#: Words of a window and from one window to the next: any 12 words in a row are together in some window.
WINDOW, STRIDE = 32, 20
#: Sizes of the word and character embeddings and of the state of each direction.
WORD, CHAR, STATE = 6, 4, 8
#: Most words known, and buckets of character trigrams.
VOCABULARY, GRAMS = 20_000, 1 << 13
#: Most labelled texts of each class, and most characters of all of them.
FIT_ROWS, FIT_CHARS = 1000, 20_000_000
_GROUP = 2048

# Letters and digits in lower case, bytes of other letters; everything else parts words.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[ord(c) for c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_IS_WORD[128:] = True
_SIGN = np.where(_IS_WORD, _LOWER, 0).astype(np.uint32)


def read_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first word of each text, trigram bucket of every byte in a word, first of them of each word."""
    begin, end, bounds = spans(texts, _IS_WORD)
    if not len(begin):
        return np.zeros(0, np.uint64), bounds, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _LOWER[texts.data]
    words = word_hashes(low, begin, end)
    sign = _SIGN[texts.data]
    before, after = np.zeros_like(sign), np.zeros_like(sign)
    before[1:], after[:-1] = sign[:-1], sign[1:]
    before[begin], after[end - 1] = 0, 0
    gram = (before * np.uint32(65536) + sign * np.uint32(256) + after) * np.uint32(0x9E3779B1)
    size = end - begin
    first = np.concatenate([[0], np.cumsum(size)])
    inside = _IS_WORD[texts.data]
    return words, bounds, (gram[inside] >> np.uint32(32 - 13)).astype(np.int32), first[:-1]


def word_ids(vocabulary: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Place in the sorted vocabulary plus one; 0 for a word that is not in it."""
    if not len(vocabulary):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words, at + 1, 0)


def window_index(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all overlapping windows (-1 is padding) and the text of every window.

    A text without words has one window of padding, so that it gets a score of the same network.
    """
    counts = np.diff(bounds)
    per = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(counts)), per)
    first = np.concatenate([[0], np.cumsum(per)])[:-1]
    at = ((np.arange(len(row)) - first[row]) * STRIDE)[:, None] + np.arange(WINDOW)
    return np.where(at < counts[row][:, None], at + bounds[:-1][row][:, None], -1), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # exp of a very negative input is infinite, its sigmoid 0
        y = np.exp(-x)
    y += 1
    return np.reciprocal(y, out=y)


class Network:
    """Parameters by name, forward pass, and gradients.

    States are kept feature by feature, (feature, window), so that every step works on long rows.
    """

    def __init__(self, vocabulary: np.ndarray, word: np.ndarray, char: np.ndarray, rng):
        self.vocabulary = vocabulary
        small = lambda *shape: rng.normal(0, 0.35, shape)
        p = {"word": word, "char": char}
        for side in "fb":
            p[f"in_{side}"] = small(3 * STATE, WORD + CHAR)
            p[f"state_{side}"] = small(3 * STATE, STATE)
            p[f"bias_{side}"] = np.zeros(3 * STATE)
        p["attend"], p["query"] = small(STATE, 2 * STATE), small(STATE)
        p["out"], p["out_bias"] = small(2 * STATE), np.zeros(1)
        self.p = {name: value.astype(np.float32) for name, value in p.items()}

    def inputs(self, ids: np.ndarray, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Word embedding beside the mean of the character embeddings, for every word."""
        out = np.empty((len(ids), WORD + CHAR), np.float32)
        if len(ids):
            out[:, :WORD] = self.p["word"][ids]
            size = np.diff(np.append(first, len(grams))).astype(np.float32)
            for i in range(CHAR):
                column = np.ascontiguousarray(self.p["char"][:, i])
                out[:, WORD + i] = np.add.reduceat(column[grams], first) / size
        return out

    def _direction(self, x: np.ndarray, mask: np.ndarray, side: str, tape: list | None) -> np.ndarray:
        """States of one direction, (step, state, window); x: (step, window, input), mask: (step, window)."""
        steps, count, _ = x.shape
        out = np.empty((steps, STATE, count), np.float32)
        h = np.zeros((STATE, count), np.float32)
        enter, weight, bias = self.p[f"in_{side}"], self.p[f"state_{side}"], self.p[f"bias_{side}"][:, None]
        full = mask.all(axis=1)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            a = enter @ x[t].T
            a += bias
            u = weight @ h
            a[: 2 * STATE] += u[: 2 * STATE]
            z, r = _sigmoid(a[: 2 * STATE]).reshape(2, STATE, count)
            n = r * u[2 * STATE :]
            n += a[2 * STATE :]
            np.tanh(n, out=n)
            if tape is not None:
                tape.append((t, h, z, r, n, u[2 * STATE :]))
            change = n - h
            change *= 1 - z
            if not full[t]:
                change *= mask[t]
            out[t] = h = h + change
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; x: (step, window, input), mask: (step, window)."""
        p = self.p
        tapes = {"f": [], "b": []} if keep else {"f": None, "b": None}
        h = np.concatenate([self._direction(x, mask, side, tapes[side]) for side in "fb"], axis=1)
        look = np.tanh(p["attend"] @ h)
        weight = np.where(mask, np.einsum("k,tkb->tb", p["query"], look), np.float32(-1e4))
        weight = np.exp(weight - weight.max(axis=0))
        weight *= mask
        weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tb,tib->ib", weight, h)
        logit = p["out"] @ pooled + p["out_bias"]
        return (logit, (h, look, weight, pooled, tapes)) if keep else logit

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, share: np.ndarray):
        """Of the weighted mean cross entropy, by parameter, and with respect to the inputs."""
        p = self.p
        logit, (h, look, weight, pooled, tapes) = self.forward(x, mask, keep=True)
        d = ((_sigmoid(logit) - y) * share / share.sum()).astype(np.float32)
        g = {"out": pooled @ d, "out_bias": d.sum(keepdims=True)}
        d_pool = p["out"][:, None] * d
        d_weight = np.einsum("tib,ib->tb", h, d_pool)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_look = d_score[:, None, :] * p["query"][:, None] * (1 - look**2)
        g["query"] = np.einsum("tb,tkb->k", d_score, look)
        g["attend"] = np.einsum("tkb,tib->ki", d_look, h)
        dh = weight[:, None, :] * d_pool + p["attend"].T @ d_look
        dx = np.zeros_like(x)
        for at, side in enumerate("fb"):
            w, d_in = p[f"state_{side}"], np.empty((x.shape[0], 3 * STATE, x.shape[1]), np.float32)
            g_state, carry = np.zeros_like(w), np.zeros((STATE, x.shape[1]), np.float32)
            for t, h0, z, r, n, un in reversed(tapes[side]):
                total = carry + dh[t, at * STATE : (at + 1) * STATE]
                step = total * mask[t]
                dn = step * (1 - z) * (1 - n * n)
                dz = -step * (n - h0) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                gate = np.concatenate([dz, dr, dn * r])
                d_in[t] = np.concatenate([dz, dr, dn])
                g_state += gate @ h0.T
                carry = total - step * (1 - z) + w.T @ gate
            g[f"state_{side}"] = g_state
            g[f"in_{side}"] = np.matmul(d_in, x).sum(axis=0)
            g[f"bias_{side}"] = d_in.sum(axis=(0, 2))
            dx += np.swapaxes(p[f"in_{side}"].T @ d_in, 1, 2)
        return g, dx

    def window_logits(self, inputs: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Logits of windows of words given by their places in ``inputs``; -1 is padding."""
        padded = np.concatenate([inputs, np.zeros((1, inputs.shape[1]), np.float32)])
        out = np.empty(len(index), np.float32)
        for at in range(0, len(index), _GROUP):
            part = index[at : at + _GROUP].T
            out[at : at + _GROUP] = self.forward(padded[part], part >= 0)
        return out

    def score(self, texts: Texts) -> np.ndarray:
        """The highest probability of any window of each text."""
        words, bounds, grams, first = read_words(texts)
        index, row = window_index(bounds)
        logits = self.window_logits(self.inputs(word_ids(self.vocabulary, words), grams, first), index)
        start = np.searchsorted(row, np.arange(len(bounds) - 1))
        return _sigmoid(np.maximum.reduceat(logits, start).astype(np.float64))


def _odds(present: np.ndarray, positive: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Smoothed log odds of being seen in a text of label 1, damped to about -2..2."""
    return np.tanh((np.log((positive + 0.5) / (n1 + 1)) - np.log((present - positive + 0.5) / (n0 + 1))) / 2) * 2


def train(samples: list[tuple[str, int]], steps: int = 280, rate: float = 0.01, seed: int = 5) -> Network | float:
    """Fit on labelled texts; with one class only, the smoothed share of label 1.

    A label holds for a whole text, of which some window shows why. Each epoch takes, of every text,
    the window that now scores highest and one other, and follows the gradient of those: the
    first teaches what is toxic, the other windows of clean texts what is not. One coordinate of the embeddings starts as
    log odds of the word or trigram in the sample.
    """
    labels = np.array([label for _, label in samples], np.float32)
    if len(set(labels.tolist())) < 2:
        return float((labels.sum() + 1) / (len(labels) + 2))
    rng = np.random.default_rng(seed)
    parts = [read_words(texts) for texts in pieces(pa.array([text for text, _ in samples]), 1 << 40)]
    words, bounds, grams, first = parts[0]
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    of = lengths_to_rows(bounds)
    # Texts each word and trigram is in, and those of label 1.
    vocabulary, code = np.unique(words, return_inverse=True)
    pair = np.unique(of * len(vocabulary) + code)
    present = np.bincount(pair % len(vocabulary), minlength=len(vocabulary))
    positive = np.bincount(pair % len(vocabulary), weights=labels[pair // len(vocabulary)], minlength=len(vocabulary))
    common = np.flatnonzero(present >= 3)
    common = np.sort(common[np.argsort(-present[common], kind="stable")[:VOCABULARY]])
    gram_of = np.repeat(of, np.diff(np.append(first, len(grams))))
    pair = np.unique(gram_of * GRAMS + grams)
    gram_present = np.bincount(pair % GRAMS, minlength=GRAMS)
    gram_positive = np.bincount(pair % GRAMS, weights=labels[pair // GRAMS], minlength=GRAMS)
    word = rng.normal(0, 0.05, (len(common) + 1, WORD))
    word[1:, 0] = _odds(present[common], positive[common], n1, n0)
    word[0] = 0
    char = rng.normal(0, 0.05, (GRAMS, CHAR))
    char[:, 0] = np.where(gram_present >= 3, _odds(gram_present, gram_positive, n1, n0), 0)
    net = Network(vocabulary[common], word, char, rng)
    ids = word_ids(net.vocabulary, words)
    index, row = window_index(bounds)
    start = np.searchsorted(row, np.arange(len(bounds)))
    last = np.append(first, len(grams))
    state = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in net.p.items()}
    share = np.where(labels == 1, 0.5 / n1, 0.5 / n0).astype(np.float32)
    step = 0
    batches = max(1, (len(labels) + n0) // 64)
    for epoch in range(-(-steps // batches)):
        inputs = net.inputs(ids, grams, first)
        if epoch:
            strength = net.window_logits(inputs, index)
        else:  # before anything is learned, the word with the highest log odds
            odds = np.append(inputs[:, 0] + inputs[:, WORD], -9.0)
            strength = odds[index].max(axis=1)
        order = np.lexsort((strength, row))
        top = order[start[1:] - 1]
        other = start[:-1] + (rng.random(len(labels)) * np.diff(start)).astype(np.int64)
        clean = np.flatnonzero(labels == 0)
        chosen = np.concatenate([top, other[clean]])
        truth = np.concatenate([labels, np.zeros(len(clean), np.float32)])
        weight = np.concatenate([share, share[clean]])
        for rows in np.array_split(rng.permutation(len(chosen)), batches):
            part = index[chosen[rows]].T
            used, place = np.unique(part, return_inverse=True)
            place = place.reshape(part.shape)
            real = used >= 0
            spot = used[real]
            picked = np.concatenate([np.arange(last[i], last[i + 1]) for i in spot]) if len(spot) else np.zeros(0, int)
            size = (last[spot + 1] - last[spot]).astype(np.int64)
            begin = np.concatenate([[0], np.cumsum(size)])[:-1]
            table = np.zeros((len(used), WORD + CHAR), np.float32)
            table[real] = net.inputs(ids[spot], grams[picked], begin)
            grads, dx = net.gradients(table[place], part >= 0, truth[rows], weight[rows])
            d_table = np.zeros_like(table)
            np.add.at(d_table, place.ravel(), dx.reshape(-1, WORD + CHAR))
            grads["word"], grads["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
            np.add.at(grads["word"], ids[spot], d_table[real][:, :WORD])
            np.add.at(grads["char"], grams[picked], np.repeat(d_table[real][:, WORD:] / size[:, None], size, axis=0))
            grads["word"][0] = 0
            step += 1
            for name, gradient in grads.items():
                m, v = state[name]
                m += 0.1 * (gradient - m)
                v += 0.01 * (gradient * gradient - v)
                net.p[name] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, fold: int = 2, threshold: float = 0.3
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every document.

    Words (runs of letters and digits, ASCII in lower case) enter the network as an embedding of the word beside
    the mean of embeddings of its character trigrams, so that unseen forms of a known stem count. Two gated
    recurrent layers read every window of ``WINDOW`` words from both ends, attention pools their states, and a text
    scores as its highest window. Windows overlap and cover the whole text.

    The network is trained in numpy on at most ``FIT_ROWS`` labelled texts of each class outside the held-out
    fold, in one task, and broadcast (under 2 MB whatever the data); scoring is one pass without a shuffle.

    Null and empty texts get the score of a window without words. Null and other labels than 0 and 1 are not learned
    from; without labels of both classes all scores are the smoothed share of label 1. A null id counts as held
    out. Repeated rows give a row each; other columns are ignored.
    """
    sample = labelled_sample(docs, labels, label, folds, fold, FIT_ROWS, FIT_CHARS)
    shared = docs.sparkSession.sparkContext.broadcast(fitted(sample, train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for texts in pieces(batch.column(1), 1 << 20):
                count = len(texts.offsets) - 1
                score = net.score(texts) if isinstance(net, Network) else np.full(count, net)
                ids = batch.column(0).slice(texts.first, count)
                yield pa.RecordBatch.from_arrays([ids, pa.array(score)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, score double")
    return found.select(
        "doc_id",
        in_fold(F.col("doc_id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
