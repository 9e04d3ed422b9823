"""Measures: the documented sample of adjusted bars, gaps, zero guards, skewed keys."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake.functions import numbers
from marketlake.operators import aggregates, reshape
from marketlake.plans import bars, boards, funds, markets, statements
from marketlake.queries import Tables
from tests.conftest import rows

# Eight forward-adjusted bars with negative prices
# (date, open, close, high, low, amplitude %, change %, change).
SAMPLE = """
19920730 -2.34 -2.33 -2.33 -2.34 -0.43  0.43  0.01
19920731 -2.33 -2.34 -2.33 -2.34 -0.43 -0.43 -0.01
19920803 -2.34 -2.39 -2.33 -2.39 -2.56 -2.14 -0.05
19920804 -2.39 -2.37 -2.36 -2.41 -2.09  0.84  0.02
19920805 -2.37 -2.36 -2.35 -2.38 -1.27  0.42  0.01
19920806 -2.36 -2.37 -2.36 -2.38 -0.85 -0.42 -0.01
19920807 -2.37 -2.35 -2.35 -2.38 -1.27  0.84  0.02
19920810 -2.35 -2.33 -2.33 -2.35 -0.85  0.85  0.02
"""


def test_change_on_negative_prices(spark):
    data = [line.split() for line in SAMPLE.split("\n") if line]
    names = "trade_date open close high low amplitude change_pct change".split()
    df = spark.createDataFrame(data, names).withColumn("symbol", F.lit("000001"))
    typed = df.select(
        "symbol", F.to_date("trade_date", "yyyyMMdd").alias("trade_date"),
        *[F.col(c).cast("decimal(10,2)").alias(c) for c in ("open", "close", "high", "low")],
    )
    got = {r.trade_date: r for r in bars.with_change(typed).collect()}
    for day, *_, amplitude, pct, change in data[1:]:
        row = got[date(int(day[:4]), int(day[4:6]), int(day[6:]))]
        assert (float(row.change), round(row.change_pct, 2), round(row.amplitude_pct, 2)) == (float(change), float(pct), float(amplitude))


def test_weekly_of_monthly_bounds(spark):
    data = [("a", date(2024, 1, d), d, d + 1, d + 2, d - 1, 1, 10) for d in (1, 5, 8, 31)]
    df = spark.createDataFrame(data, "symbol string, trade_date date, open int, close int, high int, low int, volume int, amount int")
    weeks = rows(bars.weekly(df), "week_start", "trade_date", "open", "close", "high", "low", "volume")
    assert weeks[0] == (date(2024, 1, 1), date(2024, 1, 5), 1, 6, 7, 0, 2)
    assert rows(bars.monthly(df), "month", "trade_date", "open", "close", "volume") == [(date(2024, 1, 1), date(2024, 1, 31), 1, 32, 4)]


def test_growth_across_gaps(spark):
    df = spark.createDataFrame(
        [("a", date(2023, 3, 31), 10), ("a", date(2023, 6, 30), 20), ("a", date(2024, 3, 31), -5), ("a", date(2024, 9, 30), 1)],
        "symbol string, report_date date, v int",
    )
    got = rows(statements.growth(df, "symbol", "report_date", ["v"]), "report_date", "v_qoq", "v_yoy")
    assert [r[1:] for r in got] == [(None, None), (100.0, None), (None, -150.0), (None, None)]


def test_zero_guards_and_effective_date(spark):
    sheet = spark.createDataFrame([(0, 5), (10, 5)], "total_assets int, total_liabilities int")
    assert [r.debt_ratio for r in statements.balance_ratios(sheet).collect()] == [None, 50.0]
    days = spark.createDataFrame(
        [(date(2024, 4, 1), date(2024, 4, 5), None, date(2024, 4, 7))], "planned date, c1 date, c2 date, actual date"
    )
    row = statements.disclosure_delay(days, "planned", ["c1", "c2"], "actual").first()
    assert (row.effective_date, row.delay_days) == (date(2024, 4, 5), 2)


def test_transpose(spark):
    df = spark.createDataFrame([("cap", "1", "2"), ("count", "3", None)], "metric string, main string, star string")
    assert rows(reshape.transpose(df, "metric", ["main", "star"], ["cap", "count"], "board")) == [("main", "1", "3"), ("star", "2", None)]


# --- one key holds a third of all rows -------------------------------------------------


@pytest.fixture()
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997 + 1)
    return spark.range(30000).select(
        key.alias("symbol"), F.col("id").alias("seq"), (F.xxhash64("id") % 1000).alias("value"),
        (F.col("id") % 5).alias("part"),
    )


def test_keep_last_on_a_hot_key(skewed):
    last = aggregates.keep_last(skewed, ["symbol"], ["seq"])
    expected = skewed.groupBy("symbol").agg(F.max("seq"))
    assert rows(last, "symbol", "seq") == rows(expected)
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle, once after it


def test_top_k_on_a_hot_key(skewed):
    top = funds.top_holdings(skewed, ["symbol"], 3, value="value", tie="seq")
    hot = skewed.filter("symbol = 0").toPandas().sort_values(["value", "seq"], ascending=[False, True]).head(3)
    assert [r.seq for r in top.filter("symbol = 0").orderBy("rank").collect()] == list(hot.seq)


def test_weights_and_custody_on_a_hot_key(skewed):
    weighted = funds.weights(skewed, ["symbol"], value="value")
    assert weighted.count() == skewed.count()
    detail = skewed.select("symbol", F.col("part").alias("holder_type"), F.col("seq").alias("participant_id"), F.lit(1).alias("holding"))
    got = markets.custody_summary(detail, ["symbol"]).filter("symbol = 0").collect()
    assert sum(r.participants for r in got) == 10000 and abs(sum(r.pct for r in got) - 100) < 1e-9


def test_leader_tie_goes_to_the_lowest_symbol(spark):
    df = spark.createDataFrame([(2, "b", 5.0), (1, "b", 5.0), (3, "b", None)], "symbol int, board string, change_pct double")
    got = boards.leaders(df.withColumn("trade_date", F.lit("2024-01-02"))).first()
    assert (got.leader, got.leader_change_pct) == (1, 5.0)


def test_packed_order_keys(spark):
    """Bars by a packed key equal those by a struct, negative prices and ties among them, and need no sort."""
    import random

    rng = random.Random(3)
    stamp = lambda: datetime(2024, 1, rng.choice([1, 2]), rng.randint(0, 23), rng.choice([0, 59]), 59, rng.choice([0, 999999]))
    ticks = [(rng.choice("ab"), stamp(), rng.randint(0, 2), rng.randint(-300, 300) / 100, 1) for _ in range(400)]
    df = spark.createDataFrame(ticks, "symbol string, ts timestamp_ntz, event_id long, price double, volume int")
    df = df.withColumns({"price": F.col("price").cast("decimal(18,2)"), "amount": F.col("price").cast("decimal(18,2)")})
    for kind in ("timestamp_ntz", "timestamp"):
        source = df.withColumn("ts", F.col("ts").cast(kind))
        packed = bars.from_trades(source, ["symbol"], ["ts", "event_id"], digits=bars.TICK_DIGITS)
        assert rows(packed) == rows(bars.from_trades(source, ["symbol"], ["ts", "event_id"]))
        plan = packed.select("*")._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and plan.count("HashAggregate") == 2
    wide = df.withColumn("event_id", F.lit(10**12))
    with pytest.raises(Exception, match="too many digits"):
        bars.from_trades(wide, ["symbol"], ["ts", "event_id"], digits=bars.TICK_DIGITS).collect()
    with pytest.raises(ValueError):
        numbers.packed([(F.lit(1), 20), (F.lit(1), 19)])


def test_trades_are_dealt_by_bar_before_they_combine(spark, tmp_path, capsys):
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"
    trades = [(n, 1, 1, symbol, 2.0, price, "N", "O", day) for n, (symbol, price, day) in enumerate([
        (6, 3.0, "1998-12-30"), (6, 1.0, "1998-12-30"), (6, 4.0, "1998-12-31"), (7, 5.0, "1998-12-30"), (6, 2.0, "1998-12-30"), (None, 9.0, "1998-12-30"),
    ])]
    lines = spark.createDataFrame(trades, f"{line}, day string").withColumn("l_shipdate", F.col("day").cast("timestamp_ntz"))
    lines.drop("day").write.parquet(str(tmp_path / "lineitem.parquet"))
    daily = Tables(spark, str(tmp_path)).daily_bars()
    got = rows(daily.select("symbol", F.col("trade_date").cast("string"), *[F.col(c).cast("double") for c in ("open", "close", "high", "low", "amount")], "volume"))
    assert got == [
        (6, "1998-12-30", 3.0, 2.0, 3.0, 1.0, 6.0, 6), (6, "1998-12-31", 4.0, 4.0, 4.0, 4.0, 4.0, 2),
        (7, "1998-12-30", 5.0, 5.0, 5.0, 5.0, 5.0, 2), (None, "1998-12-30", 9.0, 9.0, 9.0, 9.0, 9.0, 2),
    ]
    daily.explain()
    steps = re.findall("HashAggregate|Exchange", capsys.readouterr().out)
    assert steps == ["HashAggregate", "HashAggregate", "Exchange"]
