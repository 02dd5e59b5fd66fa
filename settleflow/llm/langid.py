"""Language of whole texts by a byte convolutional network trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.tables import filled, in_fold
from settleflow.llm.words import _LOWER, Texts, mixed, pieces

#: Bytes of a window; a text is cut into windows side by side, each read with the first bytes of the next
#: one so that no run of bytes is lost, the last one padded.
WINDOW = 128
WIDTHS = (2, 3, 4)
EXTRA = max(WIDTHS) - 1
FILTERS = 10
#: Most texts learned from for each language and, shared evenly, for all of them; each language may have LEAST_ROWS.
FIT_ROWS, TOTAL_ROWS, LEAST_ROWS = 600, 38_400, 8
#: Windows of one text that are learned from, whatever its length.
FIT_WINDOWS = 6


class Network(NamedTuple):
    """Byte classes, filter weights by width (position, class, filter), filter bias, output layer."""

    classes: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    names: list[str]


def window_starts(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Begin and text of every window."""
    size = np.diff(texts.offsets)
    per = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), per)
    first = np.concatenate([[0], np.cumsum(per)])[:-1]
    return texts.offsets[:-1][row] + (np.arange(len(row)) - first[row]) * WINDOW, row


def windows(texts: Texts, codes: np.ndarray, begin: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Byte classes of the windows, one row each; 0 is padding."""
    if not len(begin):
        return np.zeros((0, WINDOW + EXTRA), codes.dtype)
    at = begin[:, None] + np.arange(WINDOW + EXTRA)
    inside = at < texts.offsets[1:][row][:, None]
    return np.where(inside, codes[np.minimum(at, len(codes) - 1)], 0)


def responses(net: Network, x: np.ndarray) -> list[np.ndarray]:
    """Filter responses before pooling, by width: (window, position, filter)."""
    found = []
    for width, weight, bias in zip(WIDTHS, net.filters, net.bias):
        total = weight[0][x[:, :WINDOW]]
        for j in range(1, width):
            total += weight[j][x[:, j : j + WINDOW]]
        found.append(total + bias)
    return found


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Scorer:
    """The network with the weights of neighbouring bytes added up beforehand.

    One lookup by bytes t, t+1 and one by t+2, t+3 give the responses of all widths at t.
    """

    def __init__(self, net: Network):
        self.net = net
        self.count = count = net.filters[0].shape[1]
        two, three, four = net.filters
        pair = lambda a, b: a[:, None, :] + b[None, :, :]
        only = np.broadcast_to(three[2][:, None, :], (count, count, FILTERS))
        self.head = np.concatenate([pair(f[0], f[1]) for f in (three, four, two)], axis=2)
        self.head = self.head.reshape(-1, 3 * FILTERS).astype(np.float32)
        self.tail = np.concatenate([only, pair(four[2], four[3])], axis=2).reshape(-1, 2 * FILTERS).astype(np.float32)
        self.bias = np.concatenate([net.bias[1], net.bias[2], net.bias[0]])
        self.out = np.concatenate([net.out[FILTERS:], net.out[:FILTERS]])

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        codes = x[:, :-1].astype(np.int64) * self.count + x[:, 1:]
        response = np.take(self.head, codes[:, :WINDOW], axis=0, mode="clip")
        response[:, :, : 2 * FILTERS] += np.take(self.tail, codes[:, 2 : WINDOW + 2], axis=0, mode="clip")
        hidden = np.maximum(response.max(axis=1) + self.bias, 0)
        return np.log(_softmax(hidden @ self.out + self.net.out_bias) + 1e-9)


def excerpts(texts: Texts) -> list[list[bytes]]:
    """The windows of every text that are learned from: one of each of ``FIT_WINDOWS`` equal parts, chosen by hash."""
    size = np.diff(texts.offsets)
    per = -(-size // WINDOW)
    found = []
    for begin, end, count in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), per.tolist()):
        parts = min(count, FIT_WINDOWS)
        edge = np.arange(parts + 1) * count // max(parts, 1)
        pick = mixed(np.arange(parts, dtype=np.uint64) + np.uint64(FIT_WINDOWS * (end - begin))) % np.diff(edge).astype(np.uint64)
        starts = begin + (edge[:-1] + pick.astype(np.int64)) * WINDOW
        found.append([texts.data[at : min(at + WINDOW + EXTRA, end)].tobytes() for at in starts])
    return found


def train(samples: list[tuple[str, str]], epochs: int = 8, rate: float = 0.02, seed: int = 7) -> Network | None:
    """Fit the network on (text, language) pairs; None without samples."""
    column = pa.array([text for text, _ in samples], pa.string())
    found = [windows for texts in pieces(column) for windows in excerpts(texts)]
    return fit([(windows, name) for windows, (_, name) in zip(found, samples)], epochs, rate, seed)


def fit(samples: list[tuple[list[bytes], str]], epochs: int = 8, rate: float = 0.02, seed: int = 7) -> Network | None:
    """Fit the network on the windows of texts and their languages by Adam; None without samples."""
    names = sorted({name for _, name in samples})
    if not names:
        return None
    rng = np.random.default_rng(seed)
    number = {name: i for i, name in enumerate(names)}
    y = np.array([number[name] for found, name in samples for _ in found])
    (texts,) = pieces(pa.array([window for found, _ in samples for window in found], pa.binary()), 1 << 40)
    seen = np.bincount(_LOWER[texts.data], minlength=256)
    classes = np.ones(256, np.int16)  # 0 is padding, 1 a byte not learned from
    classes[np.flatnonzero(seen)] = np.arange(2, 2 + np.count_nonzero(seen))
    x = windows(texts, classes[_LOWER[texts.data]], texts.offsets[:-1], np.arange(len(y)))
    size = int(classes.max()) + 1
    net = Network(
        classes,
        [rng.normal(0, 0.3, (w, size, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(names))),
        np.zeros(len(names)),
        names,
    )
    weights = [*net.filters, *net.bias, net.out, net.out_bias]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            grads = _gradients(net, x[rows], y[rows])
            step += 1
            for w, g, (m, v) in zip(weights, grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy. Max pooling passes the gradient to one position per window and filter."""
    rows = np.arange(len(x))
    best, pooled = [], []
    for response in responses(net, x):
        at = response.argmax(axis=1)
        best.append(at)
        pooled.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0, :])
    raw = np.concatenate(pooled, axis=1)
    hidden = np.maximum(raw, 0)
    error = _softmax(hidden @ net.out + net.out_bias)
    error[rows, y] -= 1
    error /= len(x)
    back = (error @ net.out.T) * (raw > 0)
    filters, bias = [], []
    for i, (width, weight) in enumerate(zip(WIDTHS, net.filters)):
        part = back[:, i * FILTERS : (i + 1) * FILTERS]
        grad = np.zeros_like(weight)
        for j in range(width):
            code = x[rows[:, None], best[i] + j]
            np.add.at(grad[j], (code, np.arange(FILTERS)[None, :]), part)
        filters.append(grad)
        bias.append(part.sum(axis=0))
    return [*filters, *bias, hidden.T @ error, error.sum(axis=0)]


def _chosen(usable: DataFrame) -> list[tuple]:
    """``_id`` and ``_label`` of the rows to learn from, of every label: those with the smallest hashes of the id.

    Hashes below a bound that leaves each label about twice its share of rows come to the driver and are ranked
    there, all labels at once. The row with a label's smallest hash is always among them.
    """
    place = F.xxhash64("_id")
    labels = usable.groupBy("_label").agg(F.approx_count_distinct("_id").alias("ids"), F.min(place).alias("least")).collect()
    share = max(LEAST_ROWS, min(FIT_ROWS, TOTAL_ROWS // max(len(labels), 1)))
    below = lambda ids: min((1 << 63) - 1, ((2 * share + 32) << 64) // max(ids, 1) - (1 << 63))
    bounds = usable.sparkSession.createDataFrame(
        [(row["_label"], max(row["least"], below(row["ids"]))) for row in labels], "_of string, _below long"
    )
    near = usable.join(F.broadcast(bounds), (F.col("_label") == F.col("_of")) & (place <= F.col("_below")))
    rows = near.select("_label", place.alias("_place"), "_id").distinct().collect()
    taken, found = {}, []
    for label, _, row_id in sorted(rows):
        taken[label] = taken.get(label, 0) + 1
        if taken[label] <= share:
            found.append((row_id, label))
    return found


def learn(docs: DataFrame, folds: int, fold: int) -> Network | None:
    """A network from texts of every language that has a text outside the held-out fold.

    A language has at most ``FIT_ROWS`` texts, fewer where the languages together would exceed ``TOTAL_ROWS``
    but no fewer than ``LEAST_ROWS`` of those there are. The rows are those with the smallest hash of the id. Only the windows
    learned from reach the driver, so a text may have any length; of rows that repeat an id and a language one counts.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & ~in_fold(F.col("doc_id"), folds, fold) & (F.char_length("text") > 0)
    ).select(F.col("doc_id").alias("_id"), F.col("lang").cast("string").alias("_label"))
    chosen = docs.sparkSession.createDataFrame(_chosen(usable), usable.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column(2)):
                part = batch.slice(texts.first, len(texts.offsets) - 1)
                found = pa.array(excerpts(texts), pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], ["_id", "_label", "_windows"])

    texts = docs.where(F.char_length("text") > 0).select(
        F.col("doc_id").alias("_of"), F.col("lang").cast("string").alias("_lang"), filled(F.col("text")).alias("_text")
    )
    near = texts.join(F.broadcast(chosen), (F.col("_of") == F.col("_id")) & (F.col("_lang") == F.col("_label")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = near.select("_id", "_label", "_text").mapInArrow(run, f"_id {kind}, _label string, _windows array<binary>")
    rows = found.groupBy("_id", "_label").agg(F.min("_windows").alias("_windows")).collect()
    return fit([(row["_windows"], row["_label"]) for row in sorted(rows, key=lambda row: (row["_label"], row["_id"]))])


def _has_letter(texts: Texts) -> np.ndarray:
    """Whether a text has a letter: ASCII letters by their bytes, others by decoding the texts without."""
    letter = np.concatenate([[0], np.cumsum((_LOWER[texts.data] >= 97) & (_LOWER[texts.data] <= 122))])
    found = letter[texts.offsets[1:]] > letter[texts.offsets[:-1]]
    for i in np.flatnonzero(~found):
        text = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode()
        found[i] = any(sign.isalpha() for sign in text)
    return found


def predict(scorer: Scorer, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language of every text and its probability: mean log probability over all windows."""
    begin, row = window_starts(texts)
    codes = scorer.net.classes[_LOWER[texts.data]]
    total = np.zeros((len(texts.offsets) - 1, len(scorer.net.names)))
    for at in range(0, len(row), 128):  # a few windows at a time, however long the text
        part = slice(at, at + 128)
        np.add.at(total, row[part], scorer.log_probabilities(windows(texts, codes, begin[part], row[part])))
    counts = np.maximum(np.bincount(row, minlength=len(total)), 1)
    probability = _softmax(total / counts[:, None])
    return probability.argmax(axis=1), probability.max(axis=1)


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` for every document.

    A byte convolutional network (filters over 2, 3 and 4 bytes, max pooling, softmax) is trained in numpy on
    texts with a known language outside the held-out fold and applied to every window of every whole
    text; the log probabilities of the windows are averaged. The model (under 2 MB and 240 bytes a language) is
    broadcast; scoring is one pass without a shuffle.

    A text that is null or has no letter is ``und`` with score 0, as is everything if nothing can be learned.
    Null languages are not learned from; a null id counts as held out. Every other language is learned, whatever their number and
    the length of their texts. Repeated rows give a row each; other columns are ignored.
    """
    net = learn(docs, folds, fold)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value else None
        for batch in batches:
            for texts in pieces(batch.column(1), 1 << 20):
                count = len(texts.offsets) - 1
                names, score = np.full(count, "und", object), np.zeros(count)
                if scorer:
                    best, probability = predict(scorer, texts)
                    known = _has_letter(texts)
                    names[known] = np.array(scorer.net.names, object)[best[known]]
                    score[known] = probability[known]
                ids = batch.column(0).slice(texts.first, count)
                yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double"
    )
    return found.select("doc_id", in_fold(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score")
