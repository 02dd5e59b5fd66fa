"""Delimited and full-row text files, read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.operators.rows import number_text
from settleflow.schema import cast_to
from settleflow.sources.records import read_records


# Edge lines of all files whose numbers are sent to every task, 16 bytes each.
BROADCAST_EDGES = 2_000_000


def _edge_lines(placed: DataFrame, header: int, footer: int) -> DataFrame:
    """``_edge``, the numbers ``_id`` of the first ``header`` and the last ``footer`` lines of each file.

    The lines of a file split have consecutive numbers, so its first number and its count tell where each of its lines
    stands in the file once the counts of the splits around it are known: one row per split, no text.
    """
    splits = placed.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    in_file = Window.partitionBy("_file").orderBy("_block")
    before = F.sum("_lines").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    after = F.sum("_lines").over(in_file.rowsBetween(1, Window.unboundedFollowing))
    around = splits.withColumns({"_before": F.coalesce(before, F.lit(0)), "_after": F.coalesce(after, F.lit(0))})
    leading = F.least("_lines", F.greatest(F.lit(header) - F.col("_before"), F.lit(0)))
    trailing = F.least("_lines", F.greatest(F.lit(footer) - F.col("_after"), F.lit(0)))
    counted = around.withColumns({"_up": leading, "_down": trailing}).filter("_up > 0 OR _down > 0")
    places = F.filter(
        F.sequence(F.lit(0).cast("bigint"), F.lit(header + footer - 1).cast("bigint")),
        lambda i: F.when(i < header, i < F.col("_up")).otherwise(i - header < F.col("_down")),
    )
    number = F.transform(places, lambda i: F.when(i < header, i).otherwise(F.col("_lines") - 1 - (i - header)) + F.col("_first"))
    return counted.select(F.explode(number).alias("_edge"))


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    col: str = "line",
    header: int = 0,
    footer: int = 0,
    encoding: str | None = None,
    line_sep: str | None = None,
) -> DataFrame:
    """One text column per line, without the first ``header`` and last ``footer`` lines of each file.

    Lines are numbered where they are read, and the numbers of the edge lines are taken out of the flow by a join: by
    broadcast up to ``BROADCAST_EDGES`` numbers, told from the number of files, else as Spark's own size check says. No
    line leaves the JVM; the numbers come from one more pass that reads places only.
    """
    reader = spark.read
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    if encoding:
        reader = reader.option("encoding", encoding)
    lines = reader.text(path)
    if header == 0 and footer == 0:
        return lines.select(F.col("value").alias(col))
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    edges = _edge_lines(placed, header, footer)
    if len(lines.inputFiles()) * (header + footer) <= BROADCAST_EDGES:
        edges = F.broadcast(edges)
    return placed.join(edges, F.col("_id") == F.col("_edge"), "left_anti").select(F.col("value").alias(col))


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    header: int = 0,
    footer: int = 0,
    encoding: str | None = None,
    quote: str | None = '"',
    escape: str | None = None,
    line_sep: str | None = None,
    trim: bool = False,
    remove_empty_rows: bool = True,
    thousands: str | None = None,
    decimal: str | None = None,
    limit: int | None = None,
    random_rows: int | None = None,
    seed: int = 0,
    on_error: str | None = None,
    corrupt: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read separated text with declared columns.

    A quote inside quotes is doubled unless another ``escape`` is named. ``multi_line`` reads line breaks inside
    quotes as part of the value (see :func:`settleflow.sources.records.read_records`); large files are read by many tasks.

    A bad row ends the job, unless ``corrupt`` or ``on_error="null"`` asks for it: then a bad field is NULL, and ``corrupt``
    names a column that holds the whole text of a row with a wrong field count or a bad field.
    ``limit`` reads that many rows, ``random_rows`` a random choice of that many. Compressed files
    are unpacked by their suffix.
    """
    on_error = on_error or ("null" if corrupt else "fail")
    if on_error not in ("null", "fail"):
        raise ValueError("on_error is 'null' or 'fail'")
    own_numbers = bool(thousands or (decimal and decimal != "."))
    fields = [
        T.StructField(f.name, T.StringType())
        if own_numbers and isinstance(f.dataType, T.NumericType)
        else T.StructField(f.name, f.dataType)
        for f in schema.fields
    ]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
    patterns = {
        kind: {f.metadata["pattern"] for f in schema.fields if "pattern" in f.metadata and isinstance(f.dataType, of)}
        for kind, of in (
            ("dateFormat", T.DateType),
            ("timestampFormat", T.TimestampType),
            ("timestampNTZFormat", T.TimestampNTZType),
        )
    }
    options = {
        "sep": sep,
        "mode": "FAILFAST" if on_error == "fail" else "PERMISSIVE",
        "ignoreLeadingWhiteSpace": str(trim).lower(),
        "ignoreTrailingWhiteSpace": str(trim).lower(),
        "quote": quote or "",
        "escape": escape or '"',
        "multiLine": str(multi_line).lower(),
    }
    if multi_line and (footer > 0 or line_sep not in (None, "\n") or not quote):
        raise ValueError("where values span lines, lines end with a line feed, values are quoted and there is no footer")
    for kind, formats in patterns.items():
        if len(formats) > 1:
            raise ValueError("one date pattern per file: read the columns as text and use apply_schema")
        if formats:
            options[kind] = formats.pop()
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    if multi_line or header > 1 or footer > 0 or not remove_empty_rows:  # the reader skips empty lines
        if multi_line:
            lines = read_records(spark, path, quote, escape, header, encoding).withColumnRenamed("record", "line")
        else:
            lines = read_lines(spark, path, "line", header, footer, encoding, line_sep)
        if remove_empty_rows:
            lines = lines.filter(F.trim("line") != "")
        else:  # an empty line is a row of NULLs, not a bad one
            lines = lines.select(F.when(F.trim("line") != "", F.col("line")).alias("line"))
        parsed = lines.select(F.from_csv("line", T.StructType(fields).simpleString(), options).alias("row"))
        rows = parsed.select("row.*")
    else:
        for name, value in (("encoding", encoding), ("lineSep", line_sep)):
            if value:
                options[name] = value
        rows = spark.read.schema(T.StructType(fields)).options(**options).csv(path, header=header == 1)
    if own_numbers:
        rows = rows.select(
            *[
                cast_to(number_text(F.trim(F.col(f.name)), thousands, decimal), f, on_error == "fail").alias(f.name)
                if isinstance(f.dataType, T.NumericType)
                else F.col(f.name)
                for f in schema.fields
            ],
            *([F.col(corrupt)] if corrupt else []),
        )
    if random_rows is not None:
        return rows.orderBy(F.rand(seed)).limit(random_rows)
    return rows if limit is None else rows.limit(limit)
