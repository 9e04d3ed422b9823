"""Streamed pairs and revisions: bounded state, repeated micro-batches."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake import schema
from marketlake.plans import runner
from marketlake.sources.tables import LakeTable
from marketlake.streaming import loads
from marketlake.queries import REGISTRY, Tables
from tests.conftest import rows

SIDE = "symbol string, day date, v int"


def land(spark, path, records):
    spark.createDataFrame(records, SIDE).coalesce(1).write.mode("append").parquet(path)


def test_pairs_leave_the_state_after_the_delay(spark, lake, tmp_path):
    kind = spark.createDataFrame([], SIDE).schema
    tables = [(LakeTable(lake, n, kind), str(tmp_path / n)) for n in ("one", "two")]
    day = lambda d: date(2024, 1, d)
    load = lambda: loads.load_pair(spark, *tables, "symbol", "day", str(tmp_path / "checkpoint"), delay="2 days")
    land(spark, tables[0][1], [("a", day(1), 1), ("a", day(1), 2), ("b", day(1), 1), ("b", day(2), 5)])
    land(spark, tables[1][1], [("a", day(1), 3)])
    load()
    stored = lambda: [rows(t.read_batches()) for t, _ in tables]
    assert stored() == [[("a", day(1), 1), ("a", day(1), 2)], [("a", day(1), 3)]]
    # the other side of b's second day comes late, but within the delay
    land(spark, tables[1][1], [("b", day(2), 4), ("a", day(1), 3)])
    load()
    assert stored()[1] == [("a", day(1), 3), ("b", day(2), 4)] and len(stored()[0]) == 3
    # both streams move on: units from before the watermark are dropped from the state, and come too late
    for n in (0, 1):
        land(spark, tables[n][1], [("c", day(20), 7)])
    load()
    land(spark, tables[1][1], [("b", day(1), 9)])
    query = load()
    state = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert max(op["numRowsTotal"] for op in state[-3:]) <= 2
    assert [r for r in stored()[1] if r[0] == "b"] == [("b", day(2), 4)]
    assert ("c", day(20), 7) in stored()[0] and ("c", day(20), 7) in stored()[1]


@pytest.fixture()
def context(spark, lake):
    return lambda: runner.Context(lake, spark.range(0), datetime(2024, 1, 31, 17))


def test_revisions_and_repeated_micro_batches(spark, lake, context, monkeypatch):
    spec = schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    kinds = {f.name: f.dataType for f in spec.schema}

    def bars(*records):
        df = spark.createDataFrame([(s, date(2024, 1, d), c) for s, d, c in records], "symbol string, trade_date date, close double")
        return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in kinds.items()])

    history = bars(("1", 1, 5.0), ("1", 2, 5.5), ("1", 3, 6.0), ("2", 1, 1.0))
    batches = [
        bars(("1", 1, 10.0), ("1", 2, 11.0), ("2", 1, 1.0)),
        bars(("1", 2, 5.5), ("1", 3, 6.0), ("2", 1, 1.0), ("2", 2, 2.0)),  # 1 was recalculated
        bars(("1", 1, 10.0), ("2", 2, 2.0), ("2", 3, 3.0)),  # an old delivery and a new bar
    ]

    def replay(stream, checkpoint, publish):
        for number, rows_ in enumerate(batches):
            for _ in range(2):  # each micro-batch comes again after a failure
                publish(rows_, f"stream-x-{number:010d}")

    monkeypatch.setattr(loads, "_each_batch", replay)
    loads.load_revised(None, context(), spec, "unused", history)
    got = rows(runner.stored_rows(context(), spec), "symbol", "trade_date", "close")
    assert [(s, d.day, float(c)) for s, d, c in got] == [("1", 1, 5.0), ("1", 2, 5.5), ("1", 3, 6.0), ("2", 1, 1.0), ("2", 2, 2.0), ("2", 3, 3.0)]
    assert len(rows(lake.committed(spec.name))) == 3


def test_last_bars_are_written_before_they_meet_all_bars(spark, tmp_path, monkeypatch):
    """stream_revisions joins every bar with the last one of its symbol, whose size a written table tells."""
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"
    trades = [(n, 1, 1, symbol, 2.0, 10.0 + n, "N", "O", day) for n, (symbol, day) in enumerate([
        (6, "1998-12-30"), (6, "1998-12-31"), (6, "1999-01-04"), (7, "1998-12-31"), (7, "1999-01-05"), (8, "1999-01-05"), (6, "1999-01-04"), (9, "1998-12-29"),
    ])]
    moment = F.col("day").cast("timestamp_ntz")
    lines = spark.createDataFrame(trades, f"{line}, day string")
    lines.withColumn("l_shipdate", moment).drop("day").write.parquet(str(tmp_path / "lineitem.parquet"))
    lines.select(moment.alias("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    staged, write = {}, Tables.staged
    monkeypatch.setattr(Tables, "staged", lambda t, df, label: staged.setdefault(label, write(t, df, label)))
    got = rows(REGISTRY["stream_revisions"].run(Tables(spark, str(tmp_path))).select("symbol", F.col("trade_date").cast("string"), "volume", "close"))
    assert got == [
        ("6", "1998-12-30", 2, 10.0), ("6", "1998-12-31", 2, 11.0), ("6", "1999-01-04", 4, 16.0), ("7", "1998-12-31", 2, 26.0),
        ("7", "1999-01-05", 2, 28.0), ("8", "1999-01-05", 2, 15.0), ("9", "1998-12-29", 2, 17.0),
    ]
    last = rows(staged["marks"].select("symbol", F.col("last_date").cast("string")))
    assert last == [("6", "1998-12-31"), ("7", "1998-12-31"), ("9", "1998-12-29")]
