"""Fields outside the schema (S3, P14): kept at landing, reported, read later.

The landing schema is explicit, so a field that a new release of the client
sends has no column. A row with such a field also carries its whole object as a
VARIANT in ``_extra`` (null for all other rows, so known traffic costs nothing);
:func:`report` lists what has arrived, with types, and :func:`with_field` reads a
field of landed rows, without a new landing and without the topic.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXTRA = "_extra"


def extra(text: str, known: Iterable[str]) -> Column:
    """The object in ``text`` as a VARIANT if it has a field not in ``known``,
    else null. No object, or no JSON: null."""
    unknown = F.size(F.array_except(F.json_object_keys(text), F.array(*map(F.lit, known)).cast("array<string>"))) > 0
    return F.when(unknown, F.try_parse_json(F.col(text)))


def exploded(rows: DataFrame, known: Iterable[str], column: str = EXTRA) -> DataFrame:
    """(field, value): one row for each unknown field of each row."""
    spark = rows.sparkSession
    some = rows.where(F.col(column).isNotNull()).select(column)
    each = some.lateralJoin(spark.tvf.variant_explode(F.col(column).outer()))
    return each.where(F.col("key").isNotNull() & ~F.col("key").isin(list(known))).select(F.col("key").alias("field"), "value")


def report(rows: DataFrame, known: Iterable[str], column: str = EXTRA) -> DataFrame:
    """(field, rows, type): the unknown fields of landed rows, how many rows
    have each, and the type that holds all of its values."""
    return exploded(rows, known, column).groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("value").alias("type"))


def with_field(rows: DataFrame, field: str, type_: str, name: str | None = None, column: str = EXTRA) -> DataFrame:
    """Add a field of ``_extra`` as a column; null where the row has none or
    its value is not of the type. ``field`` may be a path (``a.b``, ``a[0]``)."""
    return rows.withColumn(name or field, F.try_variant_get(F.col(column), f"$.{field}", type_))


def with_fields(rows: DataFrame, fields: dict[str, str], column: str = EXTRA) -> DataFrame:
    """Several fields, by name -> type."""
    for field, type_ in fields.items():
        rows = with_field(rows, field, type_, column=column)
    return rows
