"""Write modes on literal frames: what changes, what must not."""

from datetime import date

from pyspark.sql import functions as F

from marketlake.operators import checks, filters, revision, synclog, writes
from tests.conftest import by_value, rows


def frame(spark, data, schema="k int, v string, seq int"):
    return spark.createDataFrame(data, schema)


def test_insert_if_absent(spark):
    old = frame(spark, [(1, "old", 0)])
    new = frame(spark, [(1, "new", 1), (2, "a", 1), (2, "b", 2), (None, "x", 3)])
    after = writes.insert_if_absent(old, new, ["k"], ["seq"])
    assert rows(after) == [(1, "old", 0), (2, "b", 2)]
    assert rows(writes.insert_if_absent(after, new, ["k"], ["seq"])) == rows(after)


def test_loading_in_parts_equals_loading_at_once(spark):
    new = frame(spark, [(i % 7, str(i), i) for i in range(30)])
    parts = [new.filter("k < 3"), new.filter("k >= 3")]
    empty = frame(spark, [])
    once = writes.insert_if_absent(empty, new, ["k"], ["seq"])
    step = empty
    for part in parts:
        step = writes.insert_if_absent(step, part, ["k"], ["seq"])
    assert rows(step) == rows(once)


def test_replace_slices_touches_only_its_slices(spark):
    old = frame(spark, [(1, "a", 0), (1, "b", 0), (2, "c", 0)])
    new = frame(spark, [(1, "z", 1), (3, "n", 1)])
    assert rows(writes.replace_slices(old, new, ["k"])) == [(1, "z", 1), (2, "c", 0), (3, "n", 1)]


HOLDINGS = "fund string, q date, v int"


def test_replace_range_bounds(spark):
    q4, q3 = date(2020, 12, 31), date(2020, 9, 30)
    old = spark.createDataFrame([("f", q3, 1), ("f", q4, 1), ("g", q4, 1)], HOLDINGS)
    new = spark.createDataFrame([("f", q3, 2), ("f", q4, 2)], HOLDINGS)
    closed = writes.replace_range(old, new, "fund", "q", "2020-01-01", "2020-12-31")
    assert rows(closed) == [("f", q3, 2), ("f", q4, 2), ("g", q4, 1)]
    half_open = writes.replace_range(old, new, "fund", "q", "2020-01-01", "2020-12-31", inclusive=False)
    assert ("f", q4, 1) in rows(half_open) and ("f", q4, 2) in rows(half_open)


def test_replace_like(spark):
    schema = "exchange string, board string, v int"
    old = spark.createDataFrame([("A", "main-x", 1), ("A", "growth", 1), ("B", "main-x", 1), ("A", None, 1)], schema)
    new = spark.createDataFrame([("A", "main", 2)], schema)
    after = rows(writes.replace_like(old, new, "exchange", "board"))
    assert after == sorted([("A", "growth", 1), ("B", "main-x", 1), ("A", None, 1), ("A", "main", 2)], key=by_value)


def test_replace_where_keeps_rows_of_unknown_slice(spark):
    old = frame(spark, [(1, None, 0), (2, "in", 0)])
    new = frame(spark, [(3, "in", 1)])
    assert rows(writes.replace_where(old, new, F.col("v") == "in")) == [(1, None, 0), (3, "in", 1)]


def test_snapshot_guard(spark):
    old, new = frame(spark, [(1, "a", 0)]), frame(spark, [(2, "b", 0)])
    assert rows(writes.replace_snapshot(old, new)) == [(2, "b", 0)]
    assert rows(writes.replace_snapshot(old, new.filter("k > 9"))) == [(1, "a", 0)]


def test_parent_date(spark):
    parent = spark.createDataFrame([("f", date(2019, 1, 1)), ("g", None)], "code string, latest date")
    child = spark.createDataFrame([("f", date(2020, 3, 31)), ("f", date(2020, 6, 30))], "code string, q date")
    fallback = F.lit("2019-12-31").cast("date")
    after = writes.update_parent_date(parent, child, "code", "q", "latest", fallback)
    assert rows(after, "code", "latest") == [("f", date(2020, 6, 30)), ("g", date(2019, 12, 31))]
    assert rows(writes.reset_parent_date(parent, "latest")) == [("f", None), ("g", None)]


BARS = "symbol string, trade_date date, close double"


def bar(symbol, day, close):
    return (symbol, date(2024, 1, day), close)


def test_revision_classes(spark):
    stored = spark.createDataFrame([bar("same", 1, 9.0), bar("same", 2, 10.0), bar("moved", 2, 10.0), bar("lost", 2, 10.0)], BARS)
    incoming = spark.createDataFrame(
        [bar("same", 2, 10.0), bar("same", 3, 11.0), bar("moved", 2, 5.0), bar("moved", 3, 5.5), bar("lost", 3, 11.0), bar("new", 3, 1.0)],
        BARS,
    )
    strict = {r.symbol: r.action for r in revision.classify(stored, incoming).collect()}
    assert strict == {"same": "append", "moved": "reload", "lost": "reload", "new": "append"}
    lenient = {r.symbol: r.action for r in revision.classify(stored, incoming, lenient=True).collect()}
    assert lenient["lost"] == "append"

    history = spark.createDataFrame([bar("moved", 1, 4.5), bar("moved", 2, 5.0), bar("moved", 3, 5.5), bar("lost", 3, 11.0)], BARS)
    after = rows(revision.apply(stored, incoming, history, revision.classify(stored, incoming)))
    assert after == sorted(
        [bar("same", 1, 9.0), bar("same", 2, 10.0), bar("same", 3, 11.0), bar("moved", 1, 4.5), bar("moved", 2, 5.0),
         bar("moved", 3, 5.5), bar("lost", 3, 11.0), bar("new", 3, 1.0)], key=by_value,
    )


LOG = "interface string, table_name string, trade_date date, status string"


def test_sync_log(spark):
    old = spark.createDataFrame([("api", "t", date(2024, 1, 1), synclog.SUCCESS)], LOG)
    runs = spark.createDataFrame([("api", "t", date(2024, 1, 2)), ("api", "u", date(2024, 1, 3))], LOG.rsplit(",", 1)[0])
    done = synclog.succeed(old, runs)
    assert rows(done) == [("api", "t", date(2024, 1, 2), synclog.SUCCESS), ("api", "u", date(2024, 1, 3), synclog.SUCCESS)]
    failed = synclog.fail(old, runs)
    assert rows(failed) == [("api", "t", date(2024, 1, 1), synclog.FAILED), ("api", "u", date(1970, 1, 1), synclog.FAILED)]
    assert rows(synclog.purge(done, runs.filter("table_name = 'u'"))) == [("api", "t", date(2024, 1, 2), synclog.SUCCESS)]
    fresh = synclog.freshness(old, F.lit("2024-01-11 09:00:00").cast("timestamp_ntz")).first()
    assert fresh.lag_days == 10


def test_checks_and_overlap(spark):
    df = frame(spark, [(1, "a", 0), (1, "b", 0), (2, "c", 0)])
    assert rows(checks.duplicate_keys(df, ["k"])) == [(1, 2)]
    starts = spark.createDataFrame([(1, 0)], "k int, start int")
    kept = filters.drop_overlap(df, starts, "k", "seq", "start")
    assert rows(kept) == [(2, "c", 0)]
    named = spark.createDataFrame(
        [("000001", "ok"), ("000002", "ST x"), ("000003", "*ST y"), ("900000", "b"), ("910000", "b"), ("920000", "b"), ("920001", "c")],
        "symbol string, symbol_name string",
    )
    assert rows(filters.universe(named), "symbol") == [("000001",), ("920001",)]


def test_absent_rows_with_keys_of_another_type(spark):
    """Equal keys hash differently where their types differ, and are found all the same."""
    stored = spark.createDataFrame([(1, 0.0), (2, 5.0)], "id long, at double")
    for kind in ("long", "int", "string"):
        come = spark.createDataFrame([(1, -0.0, 1), (2, 6.0, 1), (2, 6.0, 2), (3, 0.0, 1), (3, -0.0, 2)], "id long, at double, n int")
        come = come.withColumn("id", F.col("id").cast(kind))
        got = writes.absent_rows(stored, come, ["id", "at"], ["n"])
        assert got.columns == ["id", "at", "n"] and got.schema["id"].dataType == come.schema["id"].dataType
        assert rows(got.select(F.col("id").cast("long"), F.abs("at"), "n")) == [(2, 6.0, 2), (3, 0.0, 2)]
