"""Row mapping: projections with variables, routing to several outputs, field extraction."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.functions import text
from settleflow.schema import cast_to

Expression = Column | str


def column_of(expression: Expression) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


#: Column that names the output a tagged row goes to.
OUTPUT = "output"


def map_rows(df: DataFrame, columns: Mapping[str, Expression | None] | None) -> DataFrame:
    """Project to ``name -> expression``; no expression takes the column of that name, no columns take all."""
    if not columns:
        return df.select("*")
    return df.select(*[F.col(n) if e is None else column_of(e).alias(n) for n, e in columns.items()])


def with_vars(df: DataFrame, variables: Mapping[str, Expression]) -> DataFrame:
    """Add named intermediate values in order; a later one may use an earlier one."""
    for name, expression in variables.items():
        df = df.withColumn(name, column_of(expression))
    return df


def where(df: DataFrame, condition: Expression) -> DataFrame:
    return df.filter(condition)


def route(
    df: DataFrame,
    outputs: Mapping[str, tuple[Expression | None, Mapping[str, Expression | None] | None]],
    reject: str | None = None,
) -> dict[str, DataFrame]:
    """Feed one flow to several outputs, each with its own condition and columns.

    Outputs may overlap. ``reject`` names one more output for the rows none of the others took,
    where a condition that is NULL did not take the row.
    """
    taken = F.lit(False)
    flows = {}
    for name, (condition, columns) in outputs.items():
        condition = F.lit(True) if condition is None else column_of(condition)
        flows[name] = map_rows(df.filter(condition), columns)
        taken = taken | F.coalesce(condition, F.lit(False))
    if reject:
        flows[reject] = df.filter(~taken)
    return flows


def tagged(
    df: DataFrame,
    outputs: Mapping[str, tuple[Expression | None, Mapping[str, Expression | None] | None]],
    reject: str | None = None,
) -> DataFrame:
    """The flows of :func:`route` as one: a row per row and output, ``output`` and a struct of each output's columns.

    Every condition is evaluated once and the input is read once however many outputs there are. A struct is NULL in the rows
    of other outputs.
    """
    conditions = {name: F.lit(True) if c is None else F.coalesce(column_of(c), F.lit(False)) for name, (c, _) in outputs.items()}
    projections = {name: columns for name, (_, columns) in outputs.items()}
    if reject:
        taken = F.lit(False)
        for condition in conditions.values():
            taken = taken | condition
        conditions[reject], projections[reject] = ~taken, None
    if OUTPUT in conditions:
        raise ValueError(f"no output can be named {OUTPUT}")
    tags = F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions.items()])
    rows = df.withColumn("_to", F.explode(F.filter(tags, lambda tag: tag.isNotNull())))
    flows = []
    for name, columns in projections.items():
        fields = [F.col(n) if e is None else column_of(e).alias(n) for n, e in (columns or dict.fromkeys(df.columns)).items()]
        flows.append(F.when(F.col("_to") == name, F.struct(*fields)).alias(name))
    return rows.select(F.col("_to").alias(OUTPUT), *flows)


def row_program(
    df: DataFrame, variables: Mapping[str, Expression], outputs: Mapping[str, Expression]
) -> DataFrame:
    """Local variables, then assignments; the output has the assigned columns only."""
    return map_rows(with_vars(df, variables), outputs)


def context_row(spark: SparkSession, assignments: Mapping[str, Expression]) -> DataFrame:
    """One row with a ``ctx_`` column per assignment."""
    return spark.range(1).select(*[column_of(e).alias(f"ctx_{n}") for n, e in assignments.items()])


def with_context(df: DataFrame, assignments: Mapping[str, Expression]) -> DataFrame:
    """Add the columns of :func:`context_row` to every row, as constants instead of a join."""
    return df.withColumns({f"ctx_{n}": column_of(e) for n, e in assignments.items()})


def number_text(value: Column, thousands: str | None, decimal: str | None) -> Column:
    """Plain number text out of one with its own separators."""
    if thousands:
        value = F.replace(value, F.lit(thousands), F.lit(""))
    if decimal and decimal != ".":
        value = F.replace(value, F.lit(decimal), F.lit("."))
    return value


def split_lines(df: DataFrame, col: str, sep: str) -> DataFrame:
    """Add the fields of a delimited line as the array ``_pieces``.

    They come out of a one-element explode: a filter on a field stays above it, so every line is
    split once however many fields and rules read it.
    """
    return df.withColumn("_pieces", F.explode(F.array(text.split(F.col(col), sep))))


def extract_fields(
    df: DataFrame,
    schema: T.StructType,
    col: str = "line",
    sep: str = ",",
    trim: bool = True,
    on_error: str = "fail",
    thousands: str | None = None,
    decimal: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Split ``col`` and give the i-th piece to the i-th declared column.

    A missing piece is NULL. ``on_error`` says what a piece that does not fit its type becomes:
    ``"null"``, or ``"fail"`` to end the job.
    """
    if on_error not in ("null", "fail"):
        raise ValueError("on_error is 'null' or 'fail'")
    pieces = split_lines(df, col, sep)
    columns = [F.col(name) for name in keep]
    for position, field in enumerate(schema.fields, start=1):
        piece = text.element(F.col("_pieces"), position)
        if trim:
            piece = F.trim(piece)
        if isinstance(field.dataType, T.NumericType):
            piece = number_text(piece, thousands, decimal)
        columns.append(cast_to(piece, field, on_error == "fail").alias(field.name, metadata=field.metadata))
    return pieces.select(*columns)


def split_rejects(
    df: DataFrame, rules: Mapping[str, Expression], on_error: str = "reject"
) -> tuple[DataFrame, DataFrame]:
    """Separate the rows that break a rule.

    ``rules`` maps a reason to the condition of a *bad* row. The rejects carry the first reason
    met in ``reject_reason``. With ``on_error="fail"`` a bad row ends the job instead.
    """
    reason = F.lit(None).cast("string")
    if rules:
        reason = F.coalesce(*[F.when(column_of(bad), F.lit(why)) for why, bad in rules.items()])
    if on_error == "fail":
        checked = df.filter(F.when(reason.isNotNull(), F.raise_error(reason)).otherwise(F.lit(True)))
        return checked, df.filter(F.lit(False)).withColumn("reject_reason", reason)
    marked = df.withColumn("reject_reason", reason)
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())


def line_rules(
    pieces: Column,
    field_count: int | None = None,
    dates: Mapping[int, str] | None = None,
    trim: bool = True,
) -> dict[str, Column]:
    """Rules for the fields of a line: how many there are, and the 1-based ones that must be dates."""
    rules = {}
    if field_count is not None:
        # A NULL line has no fields at all.
        rules["field count"] = F.coalesce(F.size(pieces), F.lit(0)) != field_count
    for position, pattern in (dates or {}).items():
        piece = text.element(pieces, position)
        piece = F.trim(piece) if trim else piece
        rules[f"date in field {position}"] = piece.isNotNull() & F.try_to_timestamp(piece, F.lit(pattern)).isNull()
    return rules


def reject_lines(
    df: DataFrame,
    col: str = "line",
    sep: str = ",",
    field_count: int | None = None,
    dates: Mapping[int, str] | None = None,
    trim: bool = True,
    on_error: str = "reject",
) -> tuple[DataFrame, DataFrame]:
    """Separate the lines with a wrong number of fields or a bad date: ``(good, rejects)``."""
    rules = line_rules(F.col("_pieces"), field_count, dates, trim)
    good, rejects = split_rejects(split_lines(df, col, sep), rules, on_error)
    return good.drop("_pieces"), rejects.drop("_pieces")


def rename(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Pass a flow on under new column names (``old -> new``)."""
    return df.withColumnsRenamed(dict(mapping or {}))


def buffer(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Keep a flow that several outputs read. The caller unpersists it."""
    return df.persist(level)


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The flow, and what holds its row count in ``get["rows"]`` once a job has read it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def merge_flows(*flows: DataFrame) -> DataFrame:
    """All rows of all flows, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), flows)


def sql_row(spark: SparkSession, sql: str, args: Mapping | None = None, **flows: DataFrame) -> DataFrame:
    """Free SQL. Values come from ``args`` as ``:name``, flows are read as ``{name}``.

    A statement wrapped in quotes or in BEGIN/END is unwrapped first.
    """
    body = sql.strip()
    if len(body) > 1 and body[0] == body[-1] == '"':
        body = body[1:-1].strip()
    if body.upper().startswith("BEGIN") and body.rstrip("; \n").upper().endswith("END"):
        body = body[len("BEGIN") :].rstrip("; \n")[: -len("END")]
    return spark.sql(body.strip().rstrip(";"), args=dict(args or {}), **flows)


def register_routine(
    spark: SparkSession, name: str, fn: Callable[..., pd.Series], return_type: str | T.DataType
):
    """Make a routine over whole batches usable in every expression; unknown names fail at analysis."""
    routine = F.pandas_udf(fn, returnType=return_type)
    return spark.udf.register(name, routine)
