"""Repeated passages by level-wise doubling of window lengths."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.tables import written
from settleflow.llm.words import PIECE, Runs, Texts, hashed, lists, mixed, pieces

#: Shortest windows that are worth a level of their own.
LEAST = 16
#: Words of the corpus for each range of hash values: bounds what one group of hashes holds (16 MB, should every
#: window repeat). The larger it is, the fewer entries a piece sends: at most one a range.
WORDS_PER_RANGE = 2_000_000
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def levels(length: int) -> list[int]:
    """Window lengths, each at most twice the one before, ending with ``length``; two at least."""
    found = [length]
    while len(found) < 2 or -(-found[0] // 2) >= LEAST:
        found.insert(0, max(1, -(-found[0] // 2)))
    return found


def window_hashes(words: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window from every word and whether it lies inside one text."""
    place = np.arange(len(words))
    left = np.repeat(bounds[1:], np.diff(bounds)) - place
    inside = left >= length
    out = np.full(len(words), _TOP)
    start = np.flatnonzero(inside)
    out[start] = Runs(words).of(start, length)
    return out, inside


def anchors(words: np.ndarray, bounds: np.ndarray, short: int, long: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled windows of the first length that every window of the second length has one of.

    The anchor of a long window is the least hash of the short windows in it, which depends on its words
    alone: equal long windows have equal anchors. Returned are the hashes of the anchors (one for every place
    that is an anchor), and for every word the anchor of its long window and whether it has one.
    """
    hashes, _ = window_hashes(words, bounds, short)
    span = long - short + 1
    least, width = hashes.copy(), 1
    while width < span:  # least over ``width`` places, doubled until it covers the span
        step = min(width, span - width)
        if step < len(least):
            least[:-step] = np.minimum(least[:-step], least[step:])
        width += step
    has = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(words)) >= long
    of_window = np.where(has, least, 0)
    is_anchor = np.zeros(len(words), bool)
    for back in range(min(span, len(words))):
        is_anchor[back:] |= of_window[: len(words) - back] == hashes[back:]
    # Least hashes are small numbers; mixed once more they spread evenly over the ranges of values.
    return mixed(hashes[is_anchor]), mixed(of_window), has


def blobs(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, whether each occurs again here, and where each range of values begins."""
    distinct, count = np.unique(hashes, return_counts=True)
    edges = (np.arange(ranges, dtype=np.float64) * (2.0**64 / ranges)).astype(np.uint64)
    return distinct, count > 1, np.append(np.searchsorted(distinct, edges), len(distinct))


BLOBS = "array<struct<_range: int, _hashes: binary, _again: binary>>"


def _blob_array(rows: list[np.ndarray], ranges: int) -> pa.Array:
    """For each row of hashes its distinct ones, cut by ranges of values; empty ranges are left out."""
    which, data, again, ends = [], [], [], [0]
    for hashes in rows:
        distinct, twice, edge = blobs(hashes, ranges)
        some = np.flatnonzero(np.diff(edge))
        which += some.tolist()
        data += [distinct[edge[i] : edge[i + 1]].tobytes() for i in some]
        again += [np.packbits(twice[edge[i] : edge[i + 1]]).tobytes() for i in some]
        ends.append(len(which))
    kinds = [pa.array(which, pa.int32()), pa.array(data, pa.binary()), pa.array(again, pa.binary())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(kinds, ["_range", "_hashes", "_again"]))


def _repeated(blobs_of: DataFrame) -> DataFrame:
    """``_piece``, ``_masks``: for the blobs of every piece, which of its hashes occur at two places or more.

    Hashes meet by ranges of their values. A piece sends each hash once however often it has it, so a hash that
    is everywhere is one entry per piece; the answer is a bit per hash.
    """

    def merge(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(raw, np.uint64) for raw in table.column("_hashes").to_pylist()]
        size = np.array([len(h) for h in hashes])
        again = [np.unpackbits(np.frombuffer(raw, np.uint8), count=n) for raw, n in zip(table.column("_again").to_pylist(), size)]
        whole, of = np.unique(np.concatenate(hashes), return_inverse=True)
        seen = np.bincount(of, weights=1 + np.concatenate(again).astype(np.float64), minlength=len(whole))
        masks = np.split(seen[of] > 1, np.cumsum(size)[:-1])
        return pa.table(
            {
                "_piece": table.column("_piece"),
                "_range": table.column("_range"),
                "_mask": pa.array([np.packbits(mask).tobytes() for mask in masks], pa.binary()),
                "_count": pa.array(size.astype(np.int32)),
            }
        )

    rows = blobs_of.select("_piece", F.explode("_blobs").alias("_b")).select("_piece", "_b._range", "_b._hashes", "_b._again")
    answers = rows.groupBy("_range").applyInArrow(merge, "_piece long, _range int, _mask binary, _count int")
    parts = F.sort_array(F.collect_list(F.struct("_range", "_mask", "_count")))
    return answers.groupBy("_piece").agg(parts.alias("_masks"))


def _mask(parts: list[dict] | None) -> np.ndarray:
    """The bits of all ranges one after the other, as the sorted distinct hashes of the piece are."""
    found = [np.unpackbits(np.frombuffer(p["_mask"], np.uint8), count=p["_count"]) for p in parts or []]
    return np.concatenate(found).astype(bool) if found else np.zeros(0, bool)


def _member(values: np.ndarray, hashes: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which of ``values`` are among the hashes that the mask says are repeated."""
    distinct = np.unique(hashes)[mask]
    if not len(distinct):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(distinct, values), len(distinct) - 1)
    return distinct[at] == values


def _as_texts(row: dict) -> Texts:
    return Texts(0, np.frombuffer(row["_data"], np.uint8), np.asarray(row["_ends"], np.int64))


def remove_repeats(docs: DataFrame, length: int = 35, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the remaining words, one space between) per document.

    A word (a run without space and 0x09-0x0D, unchanged) is removed if some window of ``length`` words over it has
    a sequence that also starts anywhere else, in the same document too; all windows are judged on the input.

    Windows are taken through lengths that double up to ``length`` (18 and 35 for 35; 25, 50, 100 for 100):

    1. Texts are packed into pieces of about 2 MB and written. At the first length only anchors
       are compared: the least hash inside every window of the second length, about a tenth of all words.
    2. At each further length only those windows are hashed whose anchor, or whose first and last part of the length
       before, occur again. Nothing that occurs again at one length can be missed, as all its parts do.
    3. Windows that repeat at the last length are compared once more by a second, independent hash.
    4. When that is done, or nothing has survived, the repeated windows cover the words to remove.

    Hashes are compared by ranges of their values (:func:`_repeated`): per piece each hash once and a
    bit back. So work per task is bounded by the size of a piece and of a range, and neither a passage in
    every document nor a group of copies is gathered anywhere.

    Each of the two hashes has 64 bits: a window that repeats by neither is removed with a probability of about n**2 / 2**128
    among n compared ones.

    Null, empty and blank texts have no words. Null and repeated ids are carried along, a row each. An
    empty table gives an empty result; other columns are ignored.
    """
    if length < 2:
        raise ValueError("a window has two words at least")
    steps = [*levels(length), length]  # the last one again, by the other hash
    kind = docs.schema[id].dataType.simpleString()
    texts = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    # Bytes bound words from above and are counted without splitting.
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    ranges = max(1, size // 6 // WORDS_PER_RANGE)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in pieces(batch.column(1), PIECE):
                found, _, _ = anchors(*hashed(part, lower=False), steps[0], steps[1])
                count = len(part.offsets) - 1
                ids = batch.column(0).slice(part.first, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, count], pa.int32()), ids),
                        lists(part.offsets, np.array([0, count + 1])),
                        pa.array([part.data.tobytes()], pa.binary()),
                        _blob_array([found], ranges),
                    ],
                    ["_piece", "_ids", "_ends", "_data", "_blobs"],
                )
                number += 1

    packed = written(
        texts.mapInArrow(pack, f"_piece long, _ids array<{kind}>, _ends array<long>, _data binary, _blobs {BLOBS}"), "repeats-pieces"
    )
    body = packed.select(F.col("_piece").alias("_of"), "_ids", "_ends", "_data")
    state = packed.select("_piece", F.lit(None).cast("binary").alias("_alive"), "_blobs")

    def words_at(row: dict, level: int) -> tuple[np.ndarray, np.ndarray]:
        return hashed(_as_texts(row), lower=False, seed=int(level == len(steps) - 1))

    def survivors(row: dict, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, bounds, and the starts of windows of the level after this one whose parts all occur again."""
        words, bounds = words_at(row, level)
        mask = _mask(row["_masks"])
        if level == 0:
            hashes, of_window, has = anchors(words, bounds, steps[0], steps[1])
            return words, bounds, np.flatnonzero(has & _member(of_window, hashes, mask))
        again = np.zeros(len(words) + 1, bool)
        start = np.flatnonzero(np.unpackbits(np.frombuffer(row["_alive"], np.uint8), count=len(words)))
        hashes = Runs(words).of(start, steps[level])
        again[start] = _member(hashes, hashes, mask)
        if level == len(steps) - 1:
            return words, bounds, np.flatnonzero(again)
        ends = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(words)) >= steps[level + 1]
        later = np.minimum(np.arange(len(words)) + steps[level + 1] - steps[level], len(words))
        return words, bounds, np.flatnonzero(ends & again[:-1] & again[later])

    def joined(state: DataFrame) -> DataFrame:
        answers = _repeated(state).select(F.col("_piece").alias("_p"), "_masks")
        full = state.select("_piece", "_alive").join(answers, F.col("_piece") == F.col("_p"), "left").drop("_p")
        return body.join(full, F.col("_of") == F.col("_piece")).select("_piece", "_ids", "_ends", "_data", "_alive", "_masks")

    def extend(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    words, _, start = survivors(row, level)
                    alive = np.zeros(len(words), bool)
                    alive[start] = True
                    if level + 1 == len(steps) - 1 and len(start):
                        words, _ = words_at(row, level + 1)
                    hashes = Runs(words).of(start, steps[level + 1]) if len(start) else np.zeros(0, np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["_piece"]], pa.int64()),
                            pa.array([np.packbits(alive).tobytes()], pa.binary()),
                            _blob_array([hashes], ranges),
                        ],
                        ["_piece", "_alive", "_blobs"],
                    )

        return run

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                words, bounds, start = survivors(row, len(steps) - 1)
                cover = np.zeros(len(words) + 1, np.int32)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + length, -1)
                keep = np.cumsum(cover[:-1]) == 0
                ends, data = row["_ends"], row["_data"]
                gone = np.concatenate([[0], np.cumsum(~keep)])
                removed = gone[bounds[1:]] - gone[bounds[:-1]]
                kept = []
                for i in range(len(ends) - 1):
                    parts = data[ends[i] : ends[i + 1]].split()
                    if removed[i]:
                        parts = compress(parts, keep[bounds[i] : bounds[i + 1]].tolist())
                    kept.append(b" ".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(at, 1).flatten(),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(removed.astype(np.int64)),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    for level in range(len(steps) - 1):
        state = written(joined(state).mapInArrow(extend(level), f"_piece long, _alive binary, _blobs {BLOBS}"), f"repeats-{steps[level + 1]}")
        if state.where(F.size("_blobs") > 0).isEmpty():  # no candidate is left; the alive bits are all unset
            break
    return joined(state).mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept string")
