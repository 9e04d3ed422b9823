"""Table files: visibility, repetition, replaced slices."""

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from marketlake.sources.tables import LakeTable, publish_pair, publish_together
from tests.conftest import rows

SCHEMA = StructType([StructField("k", StringType()), StructField("v", IntegerType())])


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def table(lake, name="t"):
    return LakeTable(lake, name, SCHEMA)


def test_batches(spark, lake):
    t = table(lake)
    assert rows(t.read_batches()) == []
    t.write_batch(frame(spark, [("a", 1)]), "b1")
    t.write_batch(frame(spark, [("b", 2)]), "b2")
    t.write_batch(frame(spark, [("b", 3)]), "b2")
    assert rows(t.read_batches()) == [("a", 1), ("b", 3)]
    assert rows(t.read_batches(exclude="b2")) == [("a", 1)]


def test_units_appear_together(spark, lake):
    one, two = table(lake, "one"), table(lake, "two")
    one.write_batch(frame(spark, [("lost", 0)]), "u0", unit="u0")  # the run died before the commit
    assert rows(one.read_batches()) == []
    publish_together("u1", (one, frame(spark, [("a", 1)])), (two, frame(spark, [("b", 2)])))
    assert rows(one.read_batches()) == [("a", 1)] and rows(two.read_batches()) == [("b", 2)]
    assert not publish_pair("u2", (one, frame(spark, [("c", 1)])), (two, frame(spark, [])))
    assert rows(one.read_batches()) == [("a", 1)]


def test_marked_slices(spark, lake):
    t = table(lake)
    t.write_marked(frame(spark, [("a", 1), ("b", 1)]), frame(spark, []), ["k"], "b1")
    t.write_marked(frame(spark, [("a", 2), ("b", 2)]), frame(spark, [("a", 0)]), ["k"], "b2")
    assert rows(t.read_marked(["k"])) == [("a", 2), ("b", 1), ("b", 2)]
    t.write_marked(frame(spark, [("a", 3)]), frame(spark, []), ["k"], "b3")
    assert rows(t.read_marked(["k"])) == [("a", 2), ("a", 3), ("b", 1), ("b", 2)]


def test_versions(spark, lake):
    t = table(lake)
    assert rows(t.read_version()) == []
    for i in range(11):
        t.write_version(frame(spark, [("a", i)]))
    assert rows(t.read_version()) == [("a", 10)]
    t.write_version(t.read_version())  # reading the old version while the new one is written
    assert rows(t.read_version()) == [("a", 10)]


def test_partitions(spark, lake):
    t = table(lake)
    t.replace_partitions(frame(spark, [("a", 1), ("b", 1), ("b", 2)]), ["k"], "b1")
    t.replace_partitions(frame(spark, [("b", 9)]), ["k"], "b2")
    assert rows(t.read_partitions(["k"])) == [("a", 1), ("b", 9)]
    t.replace_partitions(frame(spark, []), ["k"], "b3")
    assert rows(t.read_partitions(["k"])) == [("a", 1), ("b", 9)]


def test_scratch_needs_a_shared_folder(spark):
    from marketlake.session import scratch_dir

    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


@pytest.mark.parametrize("name", ["stock_yjbb_em", "fund_name_em"])
def test_other_errors_are_not_taken_for_an_empty_table(spark, lake, name, tmp_path):
    broken = tmp_path / "lake" / "data" / name
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        LakeTable(lake, name, SCHEMA).read_partitions(["k"]).count()
