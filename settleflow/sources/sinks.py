"""Writing flows: tables, delimited files, exports and loads by column name."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.operators.rows import OUTPUT, Expression, observe_rows, tagged
from settleflow.sources.tables import GROUP

# What a failed job raises: a Spark error, or the Java error it was not turned into one from.
FAILURES = (PySparkException, Py4JJavaError)

EXPORT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def _reason(error: Exception) -> str:
    text = error.java_exception.toString() if isinstance(error, Py4JJavaError) else str(error)
    return text.split("\n", 1)[0]


def write_insert(df: DataFrame, target: str, cols: Sequence[str] | None = None, mode: str = "append") -> None:
    """Write the declared columns to a table or a parquet path; ``mode="overwrite"`` rebuilds it."""
    out = (df.select(*cols) if cols else df).write.mode(mode)
    if "/" in target:
        out.parquet(target)
    else:
        out.saveAsTable(target)


def write_snapshot(df: DataFrame, root: str) -> str:
    """Write a new snapshot of a table beside the old ones and return its path.

    A merge reads the snapshot it replaces, so the old one must stay until the new one is complete.
    """
    path = f"{root.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def write_routes(
    df: DataFrame,
    outputs: Mapping[str, tuple[Expression | None, Mapping[str, Expression | None] | None]],
    path: str,
    reject: str | None = None,
) -> DataFrame:
    """Write all outputs of :func:`settleflow.operators.rows.route` in one pass; ``output, path, rows`` of each.

    One scan of the input and no shuffle: rows are tagged with their outputs and written to a partition per output.
    The counts are taken as the rows pass. Read an output with :func:`read_route`.
    """
    spark, names = df.sparkSession, [*outputs, *([reject] if reject else [])]
    seen = Observation()
    rows = tagged(df, outputs, reject)
    counted = rows.observe(seen, *[F.count_if(F.col(OUTPUT) == name).alias(name) for name in names])
    counted.write.partitionBy(OUTPUT).parquet(path)
    for name in names:
        if not seen.get[name]:  # an output without rows still has its columns
            rows.limit(0).drop(OUTPUT).coalesce(1).write.parquet(f"{path}/{OUTPUT}={name}")
    return spark.createDataFrame([(n, f"{path}/{OUTPUT}={n}", seen.get[n]) for n in names], "output string, path string, rows long")


def read_route(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One output that :func:`write_routes` wrote; the files of the others are not opened."""
    return spark.read.parquet(f"{path}/{OUTPUT}={name}").select(f"`{name}`.*")


def write_groups(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write one partition per group. Rows are gathered by group, a group too big for one task is split."""
    df.hint("rebalance", F.col(GROUP)).write.mode(mode).partitionBy(GROUP).parquet(path)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = False,
    cols: Sequence[str] | None = None,
    append: bool = False,
    compression: str | None = None,
    encoding: str | None = None,
    line_sep: str | None = None,
    rows_per_file: int = 0,
) -> None:
    """Write declared columns as separated text, split after ``rows_per_file`` rows when set.

    Text is written as it is: space around it stays, a quote is doubled, line breaks are quoted.
    """
    out = (df.select(*cols) if cols else df).write.mode("append" if append else "overwrite")
    out = out.option("sep", sep).option("header", header).option("emptyValue", '""').option("maxRecordsPerFile", rows_per_file)
    out = out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("escape", '"')
    for name, value in (("compression", compression), ("encoding", encoding), ("lineSep", line_sep)):
        if value:
            out = out.option(name, value)
    out.csv(path)


def export_parquet(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Write every table below ``folder`` and list the results; one that fails does not stop the rest.

    The result has a row per table, with its bytes from the listing of the files written.
    """
    done = []
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}.parquet"
        try:
            df.write.mode("overwrite").parquet(path)
            done.append((name, path, "ok", None))
        except FAILURES as error:
            done.append((name, path, "error", _reason(error)))
    listed = spark.createDataFrame(done, EXPORT_SCHEMA)
    written = [path for _, path, status, _ in done if status == "ok"]
    if not written:
        return listed.withColumn("size", F.lit(None).cast("bigint"))
    files = spark.read.format("binaryFile").load(written).select("path", "length")
    table = F.regexp_extract("path", r"/([^/]*)\.parquet/[^/]*$", 1)
    sizes = files.groupBy(table.alias("table")).agg(F.sum("length").alias("size"))
    return listed.join(sizes, "table", "left")


def match_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of the target, taken by name in any case and cast; missing ones are NULL, others left out."""
    folded = {c.lower(): c for c in df.columns}
    if len(folded) != len(df.columns):
        raise ValueError("column names differ by case only")
    return df.select(
        *[
            (F.col(folded[f.name.lower()]) if f.name.lower() in folded else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def append_by_name(df: DataFrame, target: DataFrame) -> DataFrame:
    """The target with the rows of ``df`` added, columns matched by name in any case."""
    return target.unionByName(match_columns(df, target.schema))


def load_by_name(spark: SparkSession, exported: Mapping[str, str], targets: Mapping[str, str]) -> DataFrame:
    """Append exported parquet to target paths by column name: ``table, status, rows, error``.

    One table that fails does not stop the rest. Rows are counted while they are written.
    """
    out = []
    for name, path in exported.items():
        try:
            target = spark.read.parquet(targets[name]).schema
            rows = spark.read.parquet(path)
            counted, seen = observe_rows(match_columns(rows, target), f"load_{name}")
            counted.write.mode("append").parquet(targets[name])
            out.append((name, "ok", int(seen.get["rows"]), None))
        except (*FAILURES, KeyError, ValueError) as error:
            out.append((name, "error", None, _reason(error)))
    return spark.createDataFrame(out, "table string, status string, rows bigint, error string")


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch: int = 10_000) -> None:
    """Append to a remote table, one connection per partition."""
    df.write.option("batchsize", batch).jdbc(url, table, mode="append", properties=dict(properties))


def truncate(df: DataFrame) -> DataFrame:
    """The emptied table: same columns, no rows, nothing read."""
    return df.filter(F.lit(False))
