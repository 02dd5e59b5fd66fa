"""Small helpers the operators share: written tables, labels, held-out rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.session import new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def written(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder.

    Cuts the lineage without executor-local blocks, so a lost executor costs a re-read. The table
    stays until it is removed, as results are evaluated late. ``narrow`` is for tables of ids, keys and
    links, far smaller than the texts: they are written by four tasks per core, not one per shuffle partition.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name)
    (df.coalesce(4 * spark.sparkContext.defaultParallelism) if narrow else df).write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def filled(text: Column) -> Column:
    """Text, with null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    Texts of ASCII only take the quick built-in; ``lower`` would change other letters too.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def in_fold(row_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; a null id is taken to be in it."""
    return F.coalesce(F.crc32(row_id.cast("string")) % folds == fold, F.lit(True))


#: Windows that stand for a text too long to be learned from whole.
PARTS = 16


def _shortened(text: Column, most: int) -> Column:
    """Texts of at most ``most`` characters as they are, of longer ones a window of each of ``PARTS`` equal parts.

    Windows lie at places chosen by hash; together they have at most ``most`` characters.
    """
    size, wide = max(1, most // PARTS - 1), F.char_length(text).cast("long")
    windows = []
    for i in range(PARTS):
        begin = F.floor(wide * i / PARTS)
        room = F.greatest(F.floor(wide * (i + 1) / PARTS) - begin - size + 1, F.lit(1).cast("long"))
        windows.append(text.substr((begin + F.pmod(F.xxhash64(wide, F.lit(i)), room) + 1).cast("int"), F.lit(size)))
    return F.when(wide <= most, text).otherwise(F.concat_ws("\n", *windows))


def _level(sizes: list[int], total: int) -> int:
    """The largest length to which texts of these sizes can be shortened so that they have ``total`` characters at most."""
    left = total
    for i, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - i) > left:
            return left // (len(sizes) - i)
        left -= size
    return max(sizes, default=0)


def texts_of(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """``_id``, ``_label``, ``_text`` of the documents in ``ids`` (``_id``, ``_label``), a table of at most a few thousand rows.

    The ids are broadcast, so no text is shuffled before it is shortened to ``most`` characters. Of rows that repeat an id
    the least text counts; empty texts are left out.
    """
    texts = docs.select(F.col("doc_id").alias("_of"), filled(F.col("text")).alias("_whole"))
    near = texts.join(F.broadcast(ids), F.col("_of") == F.col("_id")).select("_id", "_label", _shortened(F.col("_whole"), most).alias("_text"))
    return near.where(F.col("_text") != "").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int, total: int) -> DataFrame:
    """``_id``, ``_label``, ``_text`` of at most ``rows`` documents of each class, none in the held-out fold.

    The bounds are what lets a model be fitted in one task: the rows are those with the smallest hash of the id,
    and the texts have ``total`` characters at most. Only if whole texts exceed that, the longest are learned from in windows spread
    over the whole text. Only ids and lengths meet the labels. Conflicting labels of one id count as 1.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~in_fold(F.col("doc_id"), folds, fold))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    size = F.char_length("text")
    usable = docs.where(size > 0).groupBy(F.col("doc_id").alias("_of")).agg(F.max(size).alias("_size"))
    joined = known.join(usable, F.col("_of") == F.col("_id")).select("_id", "_label", "_size")
    found = [joined.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(rows).collect() for value in (0, 1)]
    ids = [(row["_id"], row["_label"]) for row in found[0] + found[1]]
    chosen = docs.sparkSession.createDataFrame(ids, joined.select("_id", "_label").schema)
    return texts_of(docs, chosen, _level([row["_size"] for row in found[0] + found[1]], total))


Model = TypeVar("Model")


def fitted(sample: DataFrame, fit: Callable[[list[tuple[str, int]]], Model]) -> Model:
    """The model of a sample, fitted in one task: the texts meet there and only the model reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
        model = fit([(text, label) for _, text, label in sorted(rows)])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = sample.select("_id", "_text", "_label").repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([])
