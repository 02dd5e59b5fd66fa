"""Tables, group tables, queries and fixed rows as flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.operators.rows import sql_row

GROUP = "grp"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or parquet files by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_query(spark: SparkSession, sql: str, args: Mapping | None = None, **flows: DataFrame) -> DataFrame:
    """Any SELECT; values as ``:name``, flows as ``{name}``."""
    return sql_row(spark, sql, args, **flows)


def group_table_name(base: str, grp: int | str, test_suffix: str = "") -> str:
    """Table of one group: ``{N}`` in the base stands for the group, else the group is appended."""
    name = base.replace("{N}", str(grp)) if "{N}" in base else f"{base}{grp}"
    return name + test_suffix


def read_group_table(spark: SparkSession, base: str, grp: int | str, test_suffix: str = "") -> DataFrame:
    return read_table(spark, group_table_name(base, grp, test_suffix)).withColumn(GROUP, F.lit(str(grp)))


def read_all_groups(spark: SparkSession, path: str, grps: Sequence[str] | None = None) -> DataFrame:
    """All groups of a table partitioned by group; naming some reads only their partitions."""
    schema = spark.read.parquet(path).schema
    fields = [f for f in schema.fields if f.name != GROUP]
    rows = spark.read.schema(T.StructType([*fields, T.StructField(GROUP, T.StringType())])).parquet(path)
    return rows if grps is None else rows.filter(F.col(GROUP).isin(*[str(g) for g in grps]))


def fixed_rows(spark: SparkSession, schema: T.StructType, values: Mapping | None = None, n: int = 1) -> DataFrame:
    """``n`` rows of the given values, or declared defaults, or NULL."""
    values = values or {}
    columns = []
    for field in schema.fields:
        value = values.get(field.name, field.metadata.get("default"))
        columns.append(F.lit(value).cast(field.dataType).alias(field.name))
    return spark.range(n).select(*columns)


def read_mapping(spark: SparkSession, source: str | DataFrame, key: str, value: str) -> DataFrame:
    """A two-column lookup as text, one row per key; rows without a key or value are left out.

    A key with different values ends the job: which one counts is not for the reader to choose.
    """
    rows = read_table(spark, source) if isinstance(source, str) else source
    pairs = rows.select(F.col(key).cast("string").alias(key), F.col(value).cast("string").alias(value))
    known = pairs.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    said = F.concat(F.lit(f"{key} has several values of {value}: "), F.col(key))
    one = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.raise_error(said))
    ends = known.groupBy(key).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    return ends.select(key, one.alias(value))
