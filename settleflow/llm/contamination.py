"""Benchmark items inside documents: size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.minhash import permutations
from settleflow.llm.tables import written
from settleflow.llm.words import hashed, lists, mixed, pieces, runs_in_order, shingles

SHINGLE = 5
#: One-row bands. Of a size class, an item is between half and all of a block and a window is two blocks, so
#: a containment of 0.75 is a Jaccard similarity of at least 0.176 with some window; none of 48 minima
#: then agrees with a probability of 9 in 100,000 (3 in a million for a whole item).
PERMUTATIONS = 48
#: Entries of the filters of item keys and shingles, at most: one byte each, whatever the data.
LEAST_FILTER, MOST_FILTER = 1 << 20, 1 << 26


def size_class(count: np.ndarray) -> np.ndarray:
    """Exponent of the smallest power of two that holds the set."""
    return np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)


def _minima(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Minimum of every permutation over the runs of values that begin at ``start``: (permutation, run)."""
    factor, offset = permutations(PERMUTATIONS, seed=23)
    out = np.empty((PERMUTATIONS, len(start)), np.uint32)
    for i in range(PERMUTATIONS):
        y = values * factor[i]
        y += offset[i]
        out[i] = np.minimum.reduceat((y >> np.uint64(32)).astype(np.uint32), start)
    return out


def _keys(minima: np.ndarray, level: int) -> np.ndarray:
    """64-bit key of size class, permutation and minimum."""
    which = (np.arange(PERMUTATIONS, dtype=np.uint64) + np.uint64(level << 8)) << np.uint64(32)
    return mixed(minima + which[:, None])


def _places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a key in a filter of a power of two entries."""
    mask = np.uint64(size - 1)
    return (keys & mask).astype(np.int64), ((keys >> np.uint64(30)) & mask).astype(np.int64)


def window_keys(values: np.ndarray, of: np.ndarray, levels: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By size class: the text of every window and the keys of the windows (permutation, window).

    A window is two neighbouring blocks. Minima are taken over the blocks of the smallest class; those of twice
    the size are minima of two of them.
    """
    size = np.diff(of)
    texts = np.flatnonzero(size)
    blocks = -(-size[texts] // (1 << levels[0]))
    row = np.repeat(texts, blocks)
    first = np.concatenate([[0], np.cumsum(blocks)])
    place = np.arange(len(row)) - np.repeat(first[:-1], blocks)
    minima = _minima(values, of[row] + place * (1 << levels[0]))
    for level in range(levels[0], levels[-1] + 1):
        if level > levels[0]:
            even = np.flatnonzero(place % 2 == 0)
            minima = np.minimum.reduceat(minima, even, axis=1)
            row, place = row[even], place[even] // 2
        if level in levels:
            window = minima.copy()
            together = row[1:] == row[:-1]
            window[:, :-1] = np.where(together, np.minimum(minima[:, :-1], minima[:, 1:]), minima[:, :-1])
            yield row, _keys(window, level)


def _items(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """``_item``, ``_n``, ``_level``, ``_keys``, ``_set`` of every item with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column(1)):
                values, of = shingles(*hashed(texts, lower=True), SHINGLE)
                size = np.diff(of)
                some = np.flatnonzero(size)
                if not len(some):
                    continue
                level = size_class(size[some])
                minima = _minima(values, of[:-1][some])
                keys = np.stack([_keys(minima[:, i : i + 1], int(n))[:, 0] for i, n in enumerate(level)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(size)).take(pa.array(some)),
                        pa.array(size[some].astype(np.int64)),
                        pa.array(level),
                        lists(keys.ravel(), np.arange(len(some) + 1) * PERMUTATIONS),
                        lists(values, np.append(of[:-1][some], len(values))),
                    ],
                    ["_item", "_n", "_level", "_keys", "_set"],
                )

    kind = benchmark.schema[id].dataType.simpleString()
    return benchmark.select(F.col(id).alias("_item"), F.col(text).cast("string")).mapInArrow(
        run, f"_item {kind}, _n long, _level long, _keys array<long>, _set array<long>"
    )


def _filter(hashes: DataFrame, column: str, size: int) -> np.ndarray:
    """Marks of both places of every hash: at most ``size`` places reach the driver, whatever the items."""
    mask = F.lit(size - 1)
    places = F.array(F.col(column).bitwiseAND(mask), F.shiftrightunsigned(column, 30).bitwiseAND(mask))
    marks = np.zeros(size, bool)
    words = (
        hashes.select(F.explode(places).alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    )
    for row in words.toLocalIterator():
        bits = np.array([row["bits"]], np.int64).view(np.uint8)
        marks[row["w"] * 64 : row["w"] * 64 + 64] = np.unpackbits(bits, bitorder="little").astype(bool)
    return marks


def contained_items(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", percent: int = 75
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item``, ``n_shared``, ``containment`` of every item found in a document.

    An item is found when at least ``percent`` of its distinct five-word shingles (A-Z lower-cased) are among those of
    the document. A MinHash of a whole long document says nothing about a short item, so sizes are partitioned on both
    sides: items by the power of two that holds their set, documents into overlapping windows of two
    blocks of that size, at every size some item has.

    1. Items get 48 minima. Filters of their keys and of their shingles, fixed in size, are broadcast.
    2. One pass over the documents gives the minima of all windows; only keys and shingles that pass the
       filters leave the task, so nothing of a clean document is shuffled.
    3. Keys meet the items in an exact join: the candidates.
    4. The shingles kept for a candidate and those of the item are intersected: exact containment in
       the whole document. A filter never loses a shingle of an item.

    Null, empty and blank texts contain nothing and are contained in nothing; an item of fewer than five words is one shingle, which
    only a document of the same words has. Rows without an id are not reported; rows that repeat an id
    count with the largest share. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    items = written(_items(benchmark, item, "text"), "leak-items")
    levels = sorted(row[0] for row in items.select("_level").distinct().collect())  # at most the logarithm of the longest item
    total = items.agg(F.sum(F.size("_set"))).first()[0] or 0
    size = min(MOST_FILTER, max(LEAST_FILTER, 1 << int(total * PERMUTATIONS).bit_length()))
    of_item = written(items.select("_item", F.explode("_keys").alias("_k")), "leak-keys")
    marks = spark.sparkContext.broadcast(
        (
            np.packbits(_filter(of_item, "_k", size)),
            np.packbits(_filter(items.select(F.explode("_set").alias("_s")), "_s", size)),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_marks, set_marks = (np.unpackbits(bits).astype(bool) for bits in marks.value)

        def passing(hashes, filled):
            one, two = _places(hashes, size)
            return filled[one] & filled[two]

        for batch in batches:
            for texts in pieces(batch.column(1), 1 << 18):
                values, of = runs_in_order(*hashed(texts, lower=True), SHINGLE)
                if not levels or not len(values):
                    continue
                hit_row, hit_key = [], []
                for row, keys in window_keys(values, of, levels):
                    which, window = np.nonzero(passing(keys, key_marks))
                    hit_row.append(row[window])
                    hit_key.append(keys[which, window])
                hits = np.unique(np.stack([np.concatenate(hit_row).astype(np.uint64), np.concatenate(hit_key)], axis=1), axis=0)
                if not len(hits):
                    continue
                rows = np.unique(hits[:, 0]).astype(np.int64)
                kept = np.flatnonzero(passing(values, set_marks))
                row_of = np.searchsorted(of, kept, side="right") - 1
                keep = np.isin(row_of, rows)
                pair = np.unique(np.stack([row_of[keep].astype(np.uint64), values[kept[keep]]], axis=1), axis=0)
                ends = lambda part: np.append(np.searchsorted(part[:, 0], rows.astype(np.uint64)), len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(texts.offsets) - 1).take(pa.array(rows)),
                        lists(np.ascontiguousarray(hits[:, 1]), ends(hits)),
                        lists(np.ascontiguousarray(pair[:, 1]), ends(pair)),
                    ],
                    ["_doc", "_hits", "_kept"],
                )

    kind = docs.schema[id].dataType.simpleString()
    found = docs.select(F.col(id).alias("_doc"), F.col(text).cast("string")).where(F.col("_doc").isNotNull())
    hits = written(found.mapInArrow(run, f"_doc {kind}, _hits array<long>, _kept array<long>"), "leak-hits")
    candidates = written(
        hits.select("_doc", F.explode("_hits").alias("_h")).join(of_item, F.col("_h") == F.col("_k")).select("_doc", "_item").distinct(),
        "leak-candidates",
    )
    sets = items.select(F.col("_item").alias("_i"), "_n", "_set")
    kept = hits.select(F.col("_doc").alias("_d"), "_kept")
    return (
        candidates.join(kept, F.col("_doc") == F.col("_d"))
        .join(sets, F.col("_item") == F.col("_i"))
        .select("_doc", "_item", "_n", F.size(F.array_intersect("_kept", "_set")).cast("long").alias("_shared"))
        .groupBy("_doc", "_item")
        .agg(F.max_by("_n", F.col("_shared") / F.col("_n")).alias("_n"), F.max_by("_shared", F.col("_shared") / F.col("_n")).alias("_shared"))
        .where(100 * F.col("_shared") >= percent * F.col("_n"))
        .select(
            F.col("_doc").alias("doc_id"),
            F.col("_item").alias("item_id"),
            F.col("_n").alias("n_item"),
            F.col("_shared").alias("n_shared"),
            (F.col("_shared") / F.col("_n")).alias("containment"),
        )
    )
