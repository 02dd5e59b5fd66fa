"""Secrets in texts: three fixed patterns, and a conditional random field that learns from what they find."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settleflow.llm import crf
from settleflow.llm.tables import filled
from settleflow.llm.words import _LOWER, Texts, pieces, word_hashes

# Kinds of the patterns in their order, and the least length of what counts (of group 2 for the first).
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}
#: What an ``assign`` holds in any case, as lower-case bytes; the others are found by their own bytes.
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Most texts with a pattern, and most without, that are learned from; characters of a window to each side of what is learned.
FIT_ROWS, MARGIN = 400, 120
#: What being outside is favoured by when texts are decoded, as logarithm of odds: a false alarm costs more than a miss.
CAUTION = 3.0
#: Bits of a hashed feature, and features with the one kept for what is not there.
BITS = 15
FEATURES = (1 << BITS) + 1

# Classes of bytes: 0 space, 1 lower, 2 upper, 3 digit, 4 joining signs, 5 other than ASCII, 6 any other sign.
_CLASS = np.full(256, 6, np.uint8)
for _signs, _class in (
    (b" \t\n\x0b\x0c\r", 0), (b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b"+/_-", 4),
):
    _CLASS[list(_signs)] = _class
_CLASS[128:] = 5
_BODY = (_CLASS > 0) & (_CLASS < 6)
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
#: Kinds of features that tell of neighbours or of the word itself.
LOOSE = [3, 4, 5, 6]


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """``start``, ``order``, ``kind``, ``end`` of what the patterns find: leftmost matches that do not overlap, per kind."""
    found = []
    for order, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        if kind == "hex":  # the same matches, without stopping at every short one
            pattern = _LONG_HEX
        found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


_LONG_HEX = re.compile(r"[0-9a-f]{32,}")


_WORD = re.compile(r"\S+")


def _width(span: tuple[int, int]) -> int:
    return span[1] - span[0]


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Begin and end of the secret itself in every match: of an assignment, what is assigned."""
    parts = []
    for kind, (pattern, group, least) in PATTERNS.items():
        found = (_LONG_HEX if kind == "hex" else pattern).finditer(text)
        parts += [m.span(group) for m in found if m.end(group) - m.start(group) >= least]
    return sorted(parts)


def may_match(texts: Texts) -> np.ndarray:
    """Texts that may hold a match: those with a name, with AKIA, or with 32 hexadecimal digits in a row."""
    raw, lower = texts.data.tobytes(), _LOWER[texts.data].tobytes()
    at = []
    for body, names in ((lower, _NAMES), (raw, (b"AKIA",))):
        for name in names:
            place = body.find(name)
            while place >= 0:
                at.append(place)
                place = body.find(name, place + 1)
    fourth = _HEX[texts.data[::4]]  # 32 in a row cover seven places in a row that are divisible by four
    if len(fourth) >= 7:
        run = fourth[:-1] & fourth[1:]
        run = run[:-2] & run[2:]
        run = run[:-3] & run[3:]
        at += (np.flatnonzero(run) * 4).tolist()
    out = np.zeros(len(texts.offsets) - 1, bool)
    out[np.searchsorted(texts.offsets, np.array(at, np.int64), side="right") - 1] = True
    return out


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every token and the first token of every text (one more at the end).

    A token is a run of letters, digits, joining signs and other than ASCII characters, or any other sign by itself.
    """
    kind = _CLASS[texts.data]
    body, sign = _BODY[texts.data], kind == 6
    first, last = body.copy(), body.copy()
    first[1:] &= ~body[:-1]
    last[:-1] &= ~body[1:]
    some = np.diff(texts.offsets) > 0
    edges, ends = texts.offsets[:-1][some], texts.offsets[1:][some] - 1
    first[edges], last[ends] = body[edges], body[ends]
    begin, end = np.flatnonzero(first | sign), np.flatnonzero(last | sign) + 1
    return begin, end, np.searchsorted(begin, texts.offsets)


def file_features(texts: Texts) -> np.ndarray:
    """Three small numbers of every whole text: its length by powers of four, its share of digits and its share of signs."""
    size = np.diff(texts.offsets)
    kind = _CLASS[texts.data]
    share = []
    for which in (3, 6):
        count = np.concatenate([[0], np.cumsum(kind == which)])[texts.offsets]
        share.append(np.minimum(np.diff(count) * 40 // np.maximum(size, 1), 7))
    return np.stack([np.log2(size + 1).astype(np.int64) // 2, *share], axis=1)


def features(texts: Texts, begin: np.ndarray, end: np.ndarray, bounds: np.ndarray, file: np.ndarray) -> np.ndarray:
    """Hashed features (token, kind): shape of the token, words around it, and features of its file.

    Feature 0 is kept for what is not there.
    """
    size = end - begin
    kind = _CLASS[texts.data]
    edges = np.stack([begin, end], axis=1).ravel()[:-1]  # every second stretch lies between two tokens
    within = lambda what, marks, **as_: what.reduceat(marks, edges, **as_)[::2]
    change = np.zeros(len(kind), bool)
    change[1:] = kind[1:] != kind[:-1]
    changes = within(np.add, change, dtype=np.int32) - change[begin]
    present = within(np.bitwise_or, np.uint8(1) << kind).astype(np.int64) >> 1
    digits = within(np.add, kind == 3, dtype=np.int32) * 8 // size
    hexes = within(np.logical_and, _HEX[texts.data])
    length = np.minimum(np.log2(size).astype(np.int64) * 2 + (size & (size - 1) > 0), 15)
    mixed = np.minimum(changes * 16 // size, 7)
    shape = ((present * 16 + length) * 8 + mixed) * 2 + hexes
    joined = np.zeros(len(begin), np.int64)  # whether nothing is between this token and the one before
    joined[1:] = begin[1:] == end[:-1]
    words = (word_hashes(_LOWER[texts.data], begin, end) >> np.uint64(20)).astype(np.int64)
    words[size > 16] = -1  # a long word is known by its shape

    def moved(values: np.ndarray, by: int) -> np.ndarray:
        """The value of the token ``by`` places on, -2 outside the text."""
        out = np.full(len(values), -2, np.int64)
        if by > 0:
            out[:-by] = values[by:]
        else:
            out[-by:] = values[:by]
        for i in range(abs(by)):
            place = bounds[1:] - 1 - i if by > 0 else bounds[:-1] + i
            out[place[(place >= bounds[:-1]) & (place < bounds[1:])]] = -2
        return out

    of = np.repeat(file, np.diff(bounds), axis=0)
    columns = [
        shape, length * 8 + digits, (joined * 2 + np.maximum(moved(joined, 1), 0)) * 64 + present,
        words, moved(words, -1), moved(words, -2), moved(words, 1), moved(shape, -1), moved(shape, 1),
        of[:, 0] * 16 + length, of[:, 1] * 64 + present, of[:, 2] * 64 + present,
    ]
    out = np.empty((len(columns), len(begin)), np.int32)
    for i, column in enumerate(columns):
        key = column.view(np.uint64) + np.uint64(i << 48)
        key ^= key >> np.uint64(29)
        key *= np.uint64(0x9E3779B97F4A7C15)
        out[i] = (key >> np.uint64(64 - BITS)).view(np.int64) + 1
    return out.T


def tags_of(text: str, parts: list[tuple[int, int]], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Tags of the tokens (byte offsets) by the secrets in ``parts`` (code points); overlapping ones are one."""
    at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])])
    tags = np.zeros(len(begin), np.int64)
    for low, high in parts:
        inside = np.flatnonzero((begin < at[high]) & (end > at[low]))
        fresh = inside[tags[inside] == crf.OUTSIDE]
        tags[fresh] = crf.INSIDE
        if len(fresh) == len(inside) > 0:
            tags[fresh[0]] = crf.BEGIN
    return tags


def learn(samples: list[tuple[str, list[int]]], seed: int = 13) -> crf.Field:
    """A field from windows of texts, each with the features of its file; the patterns say where secrets are.

    Windows with a secret are learned from twice, the second time with other characters in its place.
    """
    rng = np.random.default_rng(seed)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    found = []
    for window, file in samples:
        parts = secret_parts(window)
        found.append((window, parts, file))
        signs = list(window)
        for low, high in parts:
            signs[low:high] = rng.choice(letters, high - low)
        if parts:
            found.append(("".join(signs), parts, file))
    xs, together, ys = [], [], []
    for window, parts, file in found:
        for texts in pieces(pa.array([window])):
            begin, end, bounds = tokens(texts)
            if len(begin):
                xs.append(features(texts, begin, end, bounds, np.array([file])))
                together.append(np.append(False, begin[1:] == end[:-1]))
                ys.append(tags_of(window, parts, begin, end))
    if not any(y.any() for y in ys):
        xs, together, ys = [], [], []
    return crf.train(xs, together, ys, FEATURES, LOOSE)


def tagged(field: crf.Field, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, begin and end (bytes of the piece) of every secret the field decodes. A secret has no space inside."""
    begin, end, bounds = tokens(texts)
    if not len(begin) or not field.weights.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = features(texts, begin, end, bounds, file_features(texts))
    emit = sum(np.take(field.weights, ids[:, kind], axis=0) for kind in range(ids.shape[1])).astype(np.float64)
    emit[:, crf.OUTSIDE] += CAUTION
    emit[1:][begin[1:] != end[:-1], crf.INSIDE] = crf.NEVER
    first = np.zeros(len(begin), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    tags = crf.viterbi(emit, first, field.after, field.start)
    starts = np.flatnonzero(tags == crf.BEGIN)
    goes_on = np.append((tags[1:] == crf.INSIDE) & ~first[1:], False)
    stops = np.flatnonzero((tags != crf.OUTSIDE) & ~goes_on)
    row = np.searchsorted(bounds, starts, side="right") - 1
    return row, begin[starts], end[stops]


def scan(field: crf.Field, texts: Texts) -> Iterator[list[tuple[int, int, str, int]]]:
    """The spans of every text in code points, by start and kind; those of the field only where no pattern found anything."""
    row, low, high = tagged(field, texts)
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)]) if len(row) else np.zeros(1, np.int64)
    first = np.searchsorted(row, np.arange(len(texts.offsets)))
    may = may_match(texts)
    for i in range(len(texts.offsets) - 1):
        at, to = texts.offsets[i], texts.offsets[i + 1]
        spans = base_spans(texts.data[at:to].tobytes().decode()) if may[i] else []
        found = range(first[i], first[i + 1])
        if len(found):
            known, base = sorted((s, e) for s, _, _, e in spans), points[at]
            more = [(int(points[low[j]] - base), int(points[high[j]] - base)) for j in found]
            if known:
                reach = np.maximum.accumulate([e for _, e in known])
                starts = [s for s, _ in known]
                free = lambda s, e: (k := int(np.searchsorted(starts, e))) == 0 or reach[k - 1] <= s
                more = [(s, e) for s, e in more if free(s, e)]
            spans = sorted(spans + [(s, len(PATTERNS), "crf", e) for s, e in more])
        yield spans


def _windows(docs: DataFrame) -> DataFrame:
    """``_place``, ``_has``, ``_window``, ``_file``: for every task, windows of the texts with the smallest hashes of the id,
    ``FIT_ROWS`` with a pattern and as many without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, list] = {True: [], False: []}
        bound = {True: np.inf, False: np.inf}  # a larger hash is not among the smallest
        for batch in batches:
            place = batch.column(0).to_numpy()
            for texts in pieces(batch.column(1)):
                may, file = may_match(texts), None
                for i in range(len(texts.offsets) - 1):
                    of = int(place[texts.first + i])
                    if texts.offsets[i] == texts.offsets[i + 1] or of > max(bound.values() if may[i] else [bound[False]]):
                        continue
                    text = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode()
                    parts = secret_parts(text) if may[i] else []
                    if parts:
                        low, high = parts[of % len(parts)]
                    else:  # any place, or the longest word, which is most like a secret
                        low, high = 2 * (of % len(text),) if of % 3 == 0 else max((m.span() for m in _WORD.finditer(text)), key=_width, default=(0, 0))
                    window = text[max(0, low - MARGIN) : min(high, low + MARGIN) + MARGIN]
                    file = file_features(texts) if file is None else file
                    rows = kept[bool(parts)]
                    rows.append((of, window, file[i].tolist()))
                    if len(rows) >= 2 * FIT_ROWS:
                        rows[:] = sorted(rows)[:FIT_ROWS]
                        bound[bool(parts)] = rows[-1][0]
        rows = [(has, *row) for has, found in kept.items() for row in sorted(found)[:FIT_ROWS]]
        columns = [list(column) for column in zip(*rows)] or [[], [], [], []]
        kinds = [pa.bool_(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_has", "_place", "_window", "_file"])

    return docs.select("_place", "_text").mapInArrow(run, "_has boolean, _place long, _window string, _file array<long>")


def field_of(docs: DataFrame) -> crf.Field:
    """A field learned from a bounded sample of ``docs`` (``_place``, ``_text``), fitted in one task."""
    # Smallest hashes of some tasks together first, so that the last step does not grow with the number of tasks.
    windows = _windows(docs).withColumn("_some", F.spark_partition_id() % 256)
    for by in (["_has", "_some"], ["_has"]):
        order = Window.partitionBy(*by).orderBy("_place", "_window", "_file")
        windows = windows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= FIT_ROWS)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        field = learn([(window, file) for _, window, file in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(field)], pa.binary())], ["field"])

    found = windows.select("_place", "_window", "_file").repartition(1).mapInArrow(fit, "field binary").collect()
    return pickle.loads(found[0]["field"]) if found else learn([])


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` (start, kind, end; code points, end exclusive, by start) of every document.

    Three fixed patterns find assignments to a name of secrets, access keys and long hexadecimal numbers: kinds ``assign``,
    ``access``, ``hex``. A linear-chain conditional random field adds spans of kind ``crf`` where no pattern found anything. It tags
    every token of the whole text as begin, inside or outside of a secret, by the token's shape, the words around it and
    features of its file (length, shares of digits and signs), and is decoded by Viterbi.

    The field is trained in numpy, in one task, on windows of at most ``FIT_ROWS`` texts in which a pattern finds
    something and as many others, those with the smallest hashes of the id. The patterns say where secrets are; words and
    neighbours are left out at random and the characters of secrets exchanged, so that a secret is known by its looks
    where none of the names stands.
    Two passes over the texts, no shuffle but of those windows; the field is broadcast (400 KB whatever the data).

    Null is the empty text, which has no spans. Repeated rows and null ids give a row each. If no pattern finds anything in
    any text there is nothing to learn from and no ``crf`` span. An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id).alias("_id"), filled(F.col(text)).alias("_text"))
    place = F.xxhash64(F.col("_id").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(field_of(rows.withColumn("_place", place)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        for batch in batches:
            for texts in pieces(batch.column(1), 1 << 20):
                spans = [[{"start": s, "kind": k, "end": e} for s, _, k, e in found] for found in scan(shared.value, texts)]
                ids = batch.column(0).slice(texts.first, len(spans))
                yield pa.RecordBatch.from_arrays([ids, pa.array(spans, kind)], ["doc_id", "spans"])

    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<start: long, kind: string, end: long>>")
