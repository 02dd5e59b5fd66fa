"""File listings as flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from settleflow.functions import text
from settleflow.operators.sequence import with_sequence

# What a listing can be ordered by; the path makes the order total.
ORDERS = {"name": "name", "mtime": "modificationTime", "size": "length"}


def list_files(
    spark: SparkSession,
    folder: str | list[str],
    mask: str = "*",
    order: str = "name",
    desc: bool = False,
    exclude: str | None = None,
    recursive: bool = False,
    case_sensitive: bool = True,
) -> DataFrame:
    """Files whose name fits a mask: ``path, name, length, modificationTime``, ordered.

    Only the listing is read: the content column is pruned from the scan.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")
    )
    name = F.col("name") if case_sensitive else F.lower("name")
    files = files.filter(text.mask_match(name, mask if case_sensitive else mask.lower()))
    if exclude:
        files = files.filter(~text.mask_match(name, exclude if case_sensitive else exclude.lower()))
    by = [F.col(ORDERS[order]), F.col("path")]
    return files.orderBy(*[c.desc() if desc else c.asc() for c in by])


def number_files(manifest: DataFrame, cap: int | None = None) -> DataFrame:
    """``iteration, path, name, dir`` of all files by name, or of the first ``cap`` of them."""
    rows = manifest.select(
        "path", "name", F.regexp_replace("path", r"/[^/]*$", "").alias("dir")
    )
    if cap is None:
        numbered = with_sequence(rows, "iteration", ["name", "path"])
    else:
        # A top-k: the window below sees no more than ``cap`` rows.
        first = rows.orderBy("name", "path").limit(cap)
        rank = F.row_number().over(Window.orderBy("name", "path"))
        numbered = first.withColumn("iteration", rank.cast("bigint"))
    return numbered.select("iteration", "path", "name", "dir")
