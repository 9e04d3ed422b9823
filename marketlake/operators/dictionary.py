"""The data dictionary: one row per column of every table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StringType, StructType

from marketlake.functions import text
from marketlake.operators import filters, joins

COLUMN_SCHEMA = (
    "owner string, table_name string, column_name string, base string, length int, "
    "precision int, scale int, nullable boolean, column_position int"
)
# Decimal digits of the integral types.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _base(kind: DataType, max_bytes: int | None, digits: int | None = None) -> tuple[str, int | None, int | None, int | None]:
    """(base type, length, precision, scale) of a Spark type."""
    if isinstance(kind, StringType):
        return ("VARCHAR2", max_bytes, None, None) if max_bytes else ("CLOB", None, None, None)
    if isinstance(kind, DecimalType):
        return ("NUMBER", None, kind.precision, kind.scale)
    if isinstance(kind, IntegralType):
        return ("NUMBER", None, digits or DIGITS[kind.simpleString()], 0)
    names = {"date": "DATE", "double": "NUMBER", "float": "NUMBER", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
    return names.get(kind.simpleString(), "CLOB"), None, None, None  # lists and the like are kept as text


def columns_of(spark: SparkSession, owner: str, tables: Iterable[tuple[str, StructType]]) -> DataFrame:
    """Column facts of declared schemas; as many rows as there are columns, whatever the data."""
    rows = [
        (owner, name, f.name, *_base(f.dataType, f.metadata.get("max_bytes"), f.metadata.get("max_digits")), f.nullable, position)
        for name, schema in tables
        for position, f in enumerate(schema, 1)
    ]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def dictionary(columns: DataFrame, table_comments: DataFrame, column_comments: DataFrame, owner: str) -> DataFrame:
    """Columns with type text, nullable flag and comments, sorted for reading."""
    owned = filters.owned_by(columns, "owner", owner)
    joined = joins.left_chain(
        owned,
        (table_comments, ["owner", "table_name"]),
        (column_comments, ["owner", "table_name", "column_name"]),
    )
    rendered = text.type_text(F.col("base"), F.col("length"), F.col("precision"), F.col("scale"))
    return joined.select(
        "owner",
        "table_name",
        "table_comment",
        "column_name",
        rendered.alias("type_text"),
        text.yes_no(F.col("nullable")).alias("nullable_flag"),
        "column_position",
        "column_comment",
    ).orderBy("owner", "table_name", "column_position")


def comments_of(spark: SparkSession, owner: str, specs) -> tuple[DataFrame, DataFrame]:
    """Table and column comments of dataset specs."""
    tables = [(owner, s.name, s.comment) for s in specs]
    fields = [(owner, s.name, f.name, f.metadata["label"]) for s in specs for f in s.schema]
    return (
        spark.createDataFrame(tables, "owner string, table_name string, table_comment string"),
        spark.createDataFrame(fields, "owner string, table_name string, column_name string, column_comment string"),
    )
