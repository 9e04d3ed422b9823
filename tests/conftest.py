import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marketlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )


@pytest.fixture()
def lake(spark, tmp_path):
    from marketlake.sources.tables import Lake

    return Lake(spark, str(tmp_path / "lake"))


def by_value(row):
    """Sort key for rows: by value, nulls last."""
    return [(v is None, "" if v is None else v) for v in row]


def rows(df, *order):
    """Rows as tuples, sorted for comparison."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=by_value)
