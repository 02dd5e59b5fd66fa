"""Declared column types, and the schema a flow is held to."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared type names of a component schema and the Spark type of each.
# Any name not listed here is read as a string.
TYPES: dict[str, T.DataType] = {
    "id_String": T.StringType(),
    "String": T.StringType(),
    "id_Object": T.StringType(),
    "id_Character": T.StringType(),
    "id_Byte": T.ByteType(),
    "id_Short": T.ShortType(),
    "id_Integer": T.IntegerType(),
    "Integer": T.IntegerType(),
    "id_Long": T.LongType(),
    "Long": T.LongType(),
    "id_Float": T.FloatType(),
    "Float": T.FloatType(),
    "id_Double": T.DoubleType(),
    "Double": T.DoubleType(),
    "id_BigDecimal": T.DecimalType(38, 4),
    "BigDecimal": T.DecimalType(38, 4),
    "id_Boolean": T.BooleanType(),
    "Boolean": T.BooleanType(),
    "id_Date": T.DateType(),
    "Date": T.DateType(),
    "id_Timestamp": T.TimestampNTZType(),
}


def type_of(declared: str, length: int | None = None, precision: int | None = None) -> T.DataType:
    """Spark type of a declared type name."""
    if declared in ("id_BigDecimal", "BigDecimal") and length:
        return T.DecimalType(length, precision or 0)
    return TYPES.get(declared, T.StringType())


def schema_of(spec: Iterable[Mapping]) -> T.StructType:
    """Build a ``StructType`` from column declarations.

    A declaration is a mapping with ``name`` and ``type`` and optionally ``length``,
    ``precision``, ``key``, ``nullable``, ``default`` and ``pattern``. What a Spark type cannot
    hold (key, string length, date pattern, default) is kept as field metadata.
    """
    fields = []
    for column in spec:
        declared = column.get("type", "id_String")
        length = column.get("length")
        meta = {}
        if declared == "id_Character":
            meta["length"] = 1
        elif length and declared in ("id_String", "String"):
            meta["length"] = int(length)
        for item in ("key", "default", "pattern"):
            if column.get(item) is not None:
                meta[item] = column[item]
        fields.append(
            T.StructField(
                column["name"],
                type_of(declared, length, column.get("precision")),
                bool(column.get("nullable", True)),
                meta,
            )
        )
    return T.StructType(fields)


def key_columns(schema: T.StructType) -> list[str]:
    """Names of the columns declared as keys."""
    return [field.name for field in schema.fields if field.metadata.get("key")]


def cast_to(value: Column, field: T.StructField, strict: bool = False) -> Column:
    """Cast text or another type to a declared field; a failed cast is NULL unless ``strict``."""
    pattern = field.metadata.get("pattern")
    if pattern and isinstance(field.dataType, T.DateType):
        parsed = F.to_timestamp(value, pattern) if strict else F.try_to_timestamp(value, F.lit(pattern))
        return parsed.cast("date")
    if pattern and isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
        parsed = F.to_timestamp(value, pattern) if strict else F.try_to_timestamp(value, F.lit(pattern))
        return parsed.cast(field.dataType)
    return value.cast(field.dataType) if strict else value.try_cast(field.dataType)


def apply_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Project a flow onto a declared schema, filling declared defaults."""
    columns = []
    for field in schema.fields:
        value = cast_to(F.col(field.name), field, strict)
        default = field.metadata.get("default")
        if default is not None:
            value = F.coalesce(value, F.lit(default).cast(field.dataType))
        columns.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*columns)


def schema_rules(schema: T.StructType, raw: str = "", typed: str | None = None) -> dict[str, Column]:
    """Reasons why a row does not fit a schema, as conditions over the uncast columns.

    ``raw`` and ``typed`` are prefixes of the uncast and, when they exist already, the cast columns.
    """
    rules = {}
    for field in schema.fields:
        value = F.col(raw + field.name)
        cast = cast_to(value, field) if typed is None else F.col(typed + field.name)
        if not field.nullable and "default" not in field.metadata:
            rules[f"{field.name}: null"] = value.isNull()
        if not isinstance(field.dataType, T.StringType):
            rules[f"{field.name}: not {field.dataType.simpleString()}"] = value.isNotNull() & cast.isNull()
        if "length" in field.metadata:
            rules[f"{field.name}: too long"] = F.char_length(value.cast("string")) > field.metadata["length"]
    return rules
