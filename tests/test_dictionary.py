"""The data dictionary of tables whose rows hold nulls."""

from marketlake.queries import REGISTRY, Tables
from marketlake.queries.loads import TABLE_COLUMNS

TYPES = {"CLOB": "string", "NUMBER": "double", "NUMBER(10)": "int", "NUMBER(19)": "bigint", "TIMESTAMP": "timestamp"}


def test_a_column_is_nullable_if_its_rows_hold_a_null(spark, tmp_path):
    for table, columns in TABLE_COLUMNS.items():
        fields = ", ".join(f"{n} {TYPES[kind]}" for n, kind in (c.split() for c in columns.split(", ")))
        rows = [(1, None, 7), (2, "US", 7)] if table == "nation" else []
        spark.createDataFrame(rows, fields).write.parquet(str(tmp_path / f"{table}.parquet"))
    found = REGISTRY["dict_columns"].run(Tables(spark, str(tmp_path))).collect()
    assert len(found) == sum(len(c.split(", ")) for c in TABLE_COLUMNS.values())
    assert [(r.table_name, r.column_name) for r in found if r.nullable_flag == "YES"] == [("nation", "n_name")]
