"""Ranked lexical search: tiles of items times tiles of documents as dense matrix products."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settleflow.llm.tables import filled, written
from settleflow.llm.terms import LETTERS_DIGITS, codes_in, terms_of
from settleflow.llm.words import lists, pieces

#: Bytes of item texts (one item more at most) whose vocabulary is broadcast at once. More items take more passes.
GROUP_BYTES = 8 << 20
#: Items of a tile, and documents whose impacts are held as a dense matrix at once.
TILE_ITEMS, TILE_DOCS = 32, 512
#: Entries of a dense matrix, at most: bounds the terms of a tile, which then takes several products.
TILE_TERMS = 1 << 14
#: Rows a task gathers before it cuts each item to its best.
BUFFER = 100_000
#: Fixed values of the score.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 90


class Tile(NamedTuple):
    """Some items: their rows in the group, their terms (places in the vocabulary) and weights (term, item)."""

    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def item_tiles(codes: list[np.ndarray], weight: np.ndarray, size: int = TILE_ITEMS) -> list[Tile]:
    """Items in tiles of ``size``, each with the compact vocabulary of its own items."""
    tiles = []
    for at in range(0, len(codes), size):
        part = codes[at : at + size]
        terms = np.unique(np.concatenate(part)) if part else np.zeros(0, np.int64)
        weights = np.zeros((len(terms), len(part)))
        for i, of_item in enumerate(part):
            place = np.searchsorted(terms, of_item)
            weights[place, i] = weight[of_item]
        tiles.append(Tile(np.arange(at, at + len(part)), terms, weights))
    return tiles


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(SCALE * tf) div (1000 * tf + 8 * m) with m = 10 + (90 * n * documents) div length, all in whole numbers."""
    if len(n) and LENGTH_SHARE * int(n.max()) * documents >= 1 << 63:
        m = np.array([LENGTH_SHARE * int(x) * documents // length for x in n], np.int64)
    else:
        m = LENGTH_SHARE * n * documents // max(length, 1)
    return SCALE * tf // (1000 * tf + SATURATION * (100 - LENGTH_SHARE + m))


def tile_scores(tile: Tile, row: np.ndarray, code: np.ndarray, impact: np.ndarray, docs: int, scratch: np.ndarray) -> np.ndarray:
    """Scores (document, item) of one block of documents, as whole numbers.

    Weights and impacts are whole numbers in float64. A product is cut along the terms where a partial sum could
    reach 2**53, so every sum is exact whatever the order BLAS adds in.
    """
    scratch[tile.terms] = np.arange(len(tile.terms))
    column = scratch[code]
    scratch[tile.terms] = -1
    hit = column >= 0
    row, column, impact = row[hit], column[hit], impact[hit]
    out = np.zeros((docs, len(tile.items)), np.int64)
    largest = float(tile.weights.max(initial=0)) * float(impact.max(initial=0))
    width = min(TILE_TERMS, max(1, int((2**53 - 1) // max(largest, 1.0))))
    for at in range(0, len(tile.terms), width):
        inside = (column >= at) & (column < at + width)
        dense = np.zeros((docs, min(width, len(tile.terms) - at)))
        dense[row[inside], column[inside] - at] = impact[inside]
        out += (dense @ tile.weights[at : at + width]).astype(np.int64)
    return out


class _Best:
    """The best documents of every item seen by a task; equal scores by ascending id."""

    def __init__(self, items: int, k: int, kind: pa.DataType):
        self.k = k
        self.least = np.ones(items, np.int64)  # a row below it cannot be among the best
        self.schema = pa.schema([("item", pa.int32()), ("doc", kind), ("score", pa.int64())])
        self.rows, self.count = [], 0

    def add(self, items: np.ndarray, scores: np.ndarray, ids: pa.Array) -> None:
        doc, item = np.nonzero(scores >= self.least[items][None, :])
        if not len(doc):
            return
        self.rows.append(
            pa.table([pa.array(items[item].astype(np.int32)), ids.take(pa.array(doc)), pa.array(scores[doc, item])], schema=self.schema)
        )
        self.count += len(doc)
        if self.count > BUFFER:
            self.cut()

    def cut(self) -> pa.Table:
        """Keep ``k`` rows of every item."""
        table = pa.concat_tables([self.schema.empty_table(), *self.rows])
        order = pc.sort_indices(
            table, sort_keys=[("item", "ascending"), ("score", "descending"), ("doc", "ascending")], null_placement="at_end"
        )
        table = table.take(order)
        item = table["item"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        table = table.filter(pa.array(place < self.k))
        item, score, place = table["item"].to_numpy(), table["score"].to_numpy(), place[place < self.k]
        full = place == self.k - 1
        self.least[item[full]] = score[full]
        self.rows, self.count = [table], 0
        return table


def _groups(items: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Items with a group (``_bucket``, ``_part``) whose texts have ``GROUP_BYTES`` and one item more at most, and the groups."""
    size = (F.octet_length("_text") + 64).cast("long")  # an item without text is not free
    total = items.agg(F.sum(size)).first()[0] or 0
    buckets = 1 + 2 * total // GROUP_BYTES
    spread = items.withColumn("_size", size).withColumn("_bucket", F.pmod(F.xxhash64("_item", "_text"), F.lit(buckets)))
    running = Window.partitionBy("_bucket").orderBy("_text", F.col("_item").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(running), F.lit(0).cast("long"))
    grouped = written(spread.withColumn("_part", F.floor(before / GROUP_BYTES).cast("long")), "search-items")
    found = grouped.select("_bucket", "_part").distinct().collect()  # twice the bytes of the items / GROUP_BYTES, and one
    return grouped, sorted((r[0], r[1]) for r in found)


def _vectors(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``_doc``, ``_n`` (terms with repeats), ``_codes``, ``_tfs`` of every document with a term. One pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        wide = np.int64(max(1, len(known)))
        for batch in batches:
            for texts in pieces(batch.column(1)):
                terms, bounds = terms_of(texts, LETTERS_DIGITS)
                code = codes_in(terms, known)
                n = np.diff(bounds)
                row = np.repeat(np.arange(len(n)), n)[code >= 0]
                key, tf = np.unique(row * wide + code[code >= 0], return_counts=True)
                some = np.flatnonzero(n)
                starts = np.append(np.searchsorted(key, some * wide), len(key))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(n)).take(pa.array(some)),
                        pa.array(n[some].astype(np.int64)),
                        lists((key % wide).astype(np.int32), starts),
                        lists(tf.astype(np.int64), starts),
                    ],
                    ["_doc", "_n", "_codes", "_tfs"],
                )

    kind = docs.schema["_doc"].dataType.simpleString()
    return docs.select("_doc", "_text").mapInArrow(run, f"_doc {kind}, _n long, _codes array<int>, _tfs array<long>")


def _frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary: summed in map tasks, one row a term reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(count[held])], ["_code", "_df"])

    out = np.zeros(size, np.int64)
    sums = vectors.select("_codes").mapInArrow(run, "_code int, _df long").groupBy("_code").agg(F.sum("_df").alias("_df"))
    for row in sums.collect():
        out[row["_code"]] = row["_df"]
    return out


def _scored(vectors: DataFrame, tiles: list[Tile], items: int, vocabulary: int, documents: int, length: int, k: int) -> DataFrame:
    """``_row`` (of the item in its group), ``_doc``, ``score``: the best ``k`` documents of every item in every task."""
    shared = vectors.sparkSession.sparkContext.broadcast(tiles)
    size = max(1, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, scratch = None, np.full(size, -1, np.int64)
        for batch in batches:
            best = best or _Best(items, k, batch.column(0).type)
            for at in range(0, len(batch), TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                width = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(part)), width)
                code = part.column(2).flatten().to_numpy(zero_copy_only=False)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False)
                n = part.column(1).to_numpy(zero_copy_only=False)
                impact = impacts(tf, n[row], documents, length)
                for tile in shared.value:
                    best.add(tile.items, tile_scores(tile, row, code, impact, len(part), scratch), part.column(0))
        if best is not None:
            table = best.cut()
            yield from table.rename_columns(["_row", "_doc", "score"]).to_batches()

    kind = vectors.schema["_doc"].dataType.simpleString()
    return vectors.mapInArrow(run, f"_row int, _doc {kind}, score long")


def rank_documents(
    docs: DataFrame, benchmark: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text"
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` highest-scoring documents of every item.

    Terms are runs of letters, digits and other than ASCII characters, A-Z lower-cased. A term of an item weighs
    floor(1000 * ln((2N + 2) / (2df + 1))), its impact in a document is (10**9 * tf) div (1000 * tf + 8m) with
    m = 10 + (90 * n * N) div L; the score sums weight times impact over the distinct terms of the item.

    1. Items are grouped so that a group's texts have ``GROUP_BYTES`` and one item more at most; a group's vocabulary is
       broadcast. 2. One pass over the texts writes, for every document, its length and the counts of those terms: the only
       thing read afterwards. Terms are compared as bytes. 3. Document frequencies are summed in map tasks. 4. Items
       become tiles, each with the compact vocabulary of its few items. Blocks of documents become dense impact matrices,
       one per tile, and one float64 product gives all scores of a tile; products are cut where a partial sum could reach
       2**53, so scores are exact. 5. A task keeps the best ``k`` of every item, equal scores by ascending id, and those are
       ranked again per item. A further group repeats the passes.

    Null, empty and term-less texts match nothing and do not count in N; an item without terms has no rows. Every row of
    either table counts as a document or an item of its own, repeated ids too; rows equal in all of id and score are
    ranked in any order. Null ids come last among equal scores. With no documents or no items the result is empty. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id).alias("_doc"), filled(F.col(text)).alias("_text"))
    items, groups = _groups(benchmark.select(F.col(item).alias("_item"), filled(F.col(query)).alias("_text")))
    kinds = (benchmark.schema[item].dataType, docs.schema[id].dataType)
    parts = []
    for bucket, part in groups:
        rows = items.where((F.col("_bucket") == bucket) & (F.col("_part") == part)).select("_item", "_text").collect()
        column = pa.array([row["_text"] for row in rows], pa.string())
        codes, vocabulary = [], pa.array([], pa.large_binary())
        found = [terms_of(texts_, LETTERS_DIGITS) for texts_ in pieces(column, 1 << 40)]
        if found:
            terms, bounds = found[0]
            vocabulary = terms.unique()
            place = codes_in(terms, vocabulary)
            codes = [np.unique(place[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]
        vectors = written(_vectors(texts, vocabulary), "search-vectors")
        documents, length = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        df = _frequencies(vectors, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.float64)
        tiles = item_tiles(codes, weight)
        best = _scored(vectors, tiles, len(rows), len(vocabulary), documents, length, k)
        names = spark.createDataFrame([(i, row["_item"]) for i, row in enumerate(rows)], items.select(F.lit(0).alias("_at"), "_item").schema)
        parts.append(best.join(F.broadcast(names), F.col("_row") == F.col("_at")).withColumn("_group", F.lit(f"{bucket} {part}")))
    if not parts:
        return spark.createDataFrame([], f"item_id {kinds[0].simpleString()}, rank int, doc_id {kinds[1].simpleString()}, score long")
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("_group", "_row").orderBy(F.desc("score"), F.col("_doc").asc_nulls_last())
    return (
        every.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("_item").alias("item_id"), "rank", F.col("_doc").alias("doc_id"), "score")
    )
