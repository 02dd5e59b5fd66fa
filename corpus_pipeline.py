"""From raw documents to a training mixture: five stages, each an operator of ``settleflow.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes it to the shared folder and
the next stage reads it again. All stages but the last return the columns of ``documents`` (further
columns of the input pass through) and remove rows; the last gives every remaining row its place in the mixture.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleflow.llm.contamination import contained_items
from settleflow.llm.exact import exact_copies
from settleflow.llm.minhash import near_copies
from settleflow.llm.mixing import mix
from settleflow.llm.quality import score_quality
from settleflow.llm.queries import BLOCK, SHARES
from settleflow.llm.tables import written
from settleflow.session import configure


def _told_apart(docs: DataFrame, nulls: str) -> tuple[DataFrame, str]:
    """The rows, and a column no two of them share: ``doc_id`` if it is one, else a key that orders rows by it.

    The key is the id and where the row lies in its file (rows that are not read from files are written first). Null ids are
    the ``first`` or the ``last``.
    """
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs, "doc_id"
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place.getField("row_index")).schema
    except AnalysisException:
        docs = written(docs, "pipeline-rows")
        place = docs.metadataColumn("_metadata")
    file, at = F.xxhash64(place.getField("file_path")).alias("file"), place.getField("row_index").alias("at")
    known = F.col("doc_id").isNotNull() if nulls == "first" else F.col("doc_id").isNull()
    return docs.select("*", F.struct(known.alias("known"), F.col("doc_id").alias("id"), file, at).alias("__row")), "__row"


def _without(docs: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key is not among the dropped ones (``doc_id``), all columns of the documents as they are."""
    gone = dropped.select(F.col("doc_id").alias("__dropped"))
    return docs.join(gone, F.col(key) == F.col("__dropped"), "left_anti").drop("__row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier gives a score of at least 0.3.

    Every row is judged by its own text and passed on or not as it is scored: null and repeated ids make no difference. Null and
    empty texts get the share of good labels. Without labels of both classes all texts get one score. An empty table
    stays empty.
    """
    labels = configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score_quality(docs, labels, row="__row").where("predicted = 1").select("__row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays.

    One row of every group, also where the largest id is repeated. Of rows without an id one stays, if no row of its group
    has an id. Null texts are empty texts, and those are copies of each other. An empty table stays empty.
    """
    configure(spark)
    docs, key = _told_apart(docs, nulls="first")
    return _without(docs, key, exact_copies(docs, id=key).where("NOT kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates linked with each other the row with the smallest id stays.

    One row of every group, also where ids are repeated; a row without an id stays only if no row of its group has one.
    Null, empty and blank texts are linked with nothing and stay. An empty table stays empty.
    """
    configure(spark)
    docs, key = _told_apart(docs, nulls="last")
    return _without(docs, key, near_copies(docs, id=key).where("NOT kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Every row is judged by its own text, also without an id or with a repeated one. Null, empty and blank texts hold
    nothing and stay. An empty table stays empty, and without items every row stays.
    """
    benchmark = configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    docs, key = _told_apart(docs, nulls="last")
    return _without(docs, key, contained_items(docs, benchmark, id=key).select("doc_id").distinct())


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture of sources.

    A row for every row. Null and unlisted sources have no place; ties of null or repeated ids are settled in any order. An
    empty table stays empty.
    """
    configure(spark)
    return mix(docs, SHARES, BLOCK)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Quality and near duplicates cannot be said in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(configure(spark), docs, sf_dir), f"pipeline-{name}")
    return docs
