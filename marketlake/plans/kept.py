"""What a table holds per key, kept beside its data: first and last date, and the close at the last one.

Every load writes the state after it, one row a key, and commits it with its rows. Plans read the
newest state instead of the table, so that a load costs what it brings and one row a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marketlake import schema as spec_rules
from marketlake.schema import DatasetSpec

#: Write modes whose loads keep a state.
MODES = (spec_rules.APPEND, spec_rules.INSERT, spec_rules.REVISE)


def keys(spec: DatasetSpec) -> list[str]:
    return [spec.scope] if spec.scope else []


def schema(spec: DatasetSpec) -> StructType:
    day = spec.schema[spec.date].dataType
    fields = [spec.schema[k] for k in keys(spec)] + [StructField("first_date", day), StructField("last_date", day)]
    if spec.write == spec_rules.REVISE:
        fields.append(StructField("last_close", spec.schema["close"].dataType))
    return StructType(fields)


def state_of(spec: DatasetSpec, rows: DataFrame) -> DataFrame:
    """The state of these rows; a key without a date is in none. Combines on the map side."""
    found = [F.min(spec.date).alias("first_date"), F.max(spec.date).alias("last_date")]
    if spec.write == spec_rules.REVISE:
        found.append(F.max_by("close", spec.date).alias("last_close"))
    return rows.groupBy(*keys(spec)).agg(*found).filter("last_date IS NOT NULL").select(*schema(spec).fieldNames())


def merged(spec: DatasetSpec, old: DataFrame, new: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """The state after a load: its own where a key is new or replaced, else both together."""
    if replaced is not None:
        old = old.join(replaced, keys(spec), "left_anti")
    both = old.unionByName(new)
    found = [F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")]
    if spec.write == spec_rules.REVISE:
        found.append(F.max_by("last_close", "last_date").alias("last_close"))
    merged = both.groupBy(*keys(spec)).agg(*found).filter("last_date IS NOT NULL")
    return merged.select(*schema(spec).fieldNames())
