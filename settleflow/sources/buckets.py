"""Tables in buckets of their keys, of which a keyed write touches only those it changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.operators.merge import merge_update, merge_upsert
from settleflow.session import new_folder

BUCKET = "bucket"


class BucketTable:
    """Parquet files partitioned by a function of the keys.

    ``by`` gives the bucket of a row from its key columns: a hash of them unless something better is known, such as ranges
    of a number that grows with time, by which changes come in clusters. A merge reads and joins the buckets its source
    has keys in and replaces these alone, by a dynamic partition overwrite; the files of all other buckets stay as they
    are. The list of touched buckets is the only thing that reaches the driver.

    The new rows are complete in a table of their own before any bucket is replaced. A merge that ends before that has
    changed nothing; one that ends while buckets are being replaced has to be run again, which gives the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, by: Column | None = None, buckets: int = 64):
        if not keys:
            raise ValueError("a bucketed table needs key columns")
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        if BUCKET in schema.names:
            raise ValueError(f"{BUCKET} is the name of the partition column")
        # Keys are hashed as the types of the table, so that a source with narrower ones finds its rows.
        typed = [F.col(k).cast(schema[k].dataType) for k in self.keys]
        self.by = (F.pmod(F.xxhash64(*typed), F.lit(buckets)) if by is None else by).cast("bigint")

    def _write(self, rows: DataFrame) -> None:
        out = rows.withColumn(BUCKET, F.coalesce(self.by, F.lit(-1)))
        out.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def create(self, rows: DataFrame) -> BucketTable:
        """Lay the rows out; buckets too big for one task are split into several files."""
        self._write(rows.select(*self.schema.names))
        return self

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets: the others are not opened."""
        kind = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.LongType())])
        rows = self.spark.read.schema(kind).parquet(self.path)
        return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(*buckets))).drop(BUCKET)

    def touched(self, source: DataFrame) -> list[int]:
        """The buckets the source has keys in."""
        found = source.select(F.coalesce(self.by, F.lit(-1)).alias(BUCKET)).distinct()
        return sorted(row[BUCKET] for row in found.collect())

    def _merge(self, buckets: list[int], merged: Callable[[DataFrame], DataFrame]) -> list[int]:
        if not buckets:
            return []
        folder = new_folder(self.spark, "bucket-merge")
        merged(self.read(buckets)).select(*self.schema.names).write.parquet(folder)
        self._write(self.spark.read.schema(self.schema).parquet(folder))
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return buckets

    def update(self, source: DataFrame, set_cols: Sequence[str] | None = None, order_by: Sequence[Column | str] | None = None) -> list[int]:
        """:func:`merge_update` in place; the buckets it replaced. Keys the table lacks change nothing."""
        keyed = source.dropna(subset=self.keys)
        return self._merge(self.touched(keyed), lambda target: merge_update(target, keyed, self.keys, set_cols, order_by))

    def upsert(self, source: DataFrame, order_by: Sequence[Column | str] | None = None) -> list[int]:
        """:func:`merge_upsert` in place; the buckets it replaced. Rows without a key are added."""
        return self._merge(self.touched(source), lambda target: merge_upsert(target, source, self.keys, order_by))
