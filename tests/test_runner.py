"""Dataset runs end to end on literal landings."""

import re
from dataclasses import replace
from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake import schema
from marketlake.operators import dictionary, synclog
from marketlake.plans import kept, runner
from marketlake.sources import landing
from tests.conftest import rows


def landed(spark, spec, records):
    """Landed text columns; what a record does not name is null."""
    columns = {c: pa.array([r.get(c) for r in records], pa.string()) for c in spec.landed_columns}
    columns["_batch"] = pa.array(["b"] * len(records), pa.string())
    columns["_pos"] = pa.array(range(len(records)), pa.int32())
    return spark.createDataFrame(pa.table(columns))


@pytest.fixture()
def calendar(spark):
    days = spark.sql("SELECT explode(sequence(date'2023-12-01', date'2024-12-31')) AS trade_date")
    return days.filter("weekday(trade_date) < 5 AND trade_date <> date'2024-01-01'")


def context(lake, calendar, *clock):
    return runner.Context(lake, calendar, datetime(*clock))


def log_of(ctx):
    return {r.table_name: (r.status, r.trade_date) for r in runner.read_log(ctx).collect()}


def test_every_spec_is_consistent():
    assert len(schema.SPECS) == len(schema.REGISTRY) == 44
    for spec in schema.SPECS:
        names = spec.schema.fieldNames()
        assert set(spec.key) <= set(names), spec.name
        assert spec.date in names and set(spec.slices) <= set(names), spec.name
        assert spec.scope is None or spec.scope in names, spec.name
        assert {n for n, _ in spec.constants} <= set(names), spec.name
        assert len(spec.landed_columns) + len(spec.constants) == len(names), spec.name


@pytest.mark.parametrize("name", [n for n in schema.REGISTRY if n != "sync_logs"])
def test_every_dataset_can_be_planned_and_picked(name, spark, lake, calendar):
    """A row in the load range is picked, one from long ago or from the future is not."""
    spec = schema.REGISTRY[name]
    default = "2023-12-01" if spec.windows.startswith("months") else "2023-11-30"
    spec = replace(spec, default="-50d" if "30min" in name else default)
    ctx = context(lake, calendar, 2024, 5, 14, 17)
    marks = None
    if spec.scope:
        marks = spark.createDataFrame([("X", date(2023, 11, 30))], f"{spec.scope} string, watermark date")
    if spec.rules:
        rule = ("X", "", date(2023, 11, 30))
        marks = spark.createDataFrame([rule], f"{spec.rules[0]} string, {spec.rules[1]} string, watermark date")
    end = runner.cutoff(ctx, spec)
    planned = runner.plan(ctx, spec, end, marks=marks)
    inside = {"quarters": "20231231", "months": "20240101", "months_until_gap": "20240101"}
    inside = inside.get(spec.windows.split(":")[0], "20240105")
    days = [inside, "20100101", "20991231"]
    if name.startswith("stock_zh_a_hist_30min"):
        days = ["2024-04-08 10:00:00", "2010-01-01 10:00:00", "2099-01-01 10:00:00"]
    text = {c: "X" for c in spec.landed_columns if spec.schema[c].dataType.simpleString() == "string"}
    source = landed(spark, spec, [{**text, spec.date: d, "list_date": d} for d in days])
    rows_ = runner.cleaned(spec, runner.pick(ctx, spec, runner.typed(ctx, spec, source, end), planned))
    got = rows_.count()
    if spec.windows == "snapshot":
        assert got == (1 if spec.keep_last else 3)
    elif spec.windows == "after":
        assert got == 2
    else:
        assert got == 1


def test_load_range_reaches_the_scan(spark, lake, calendar, tmp_path):
    spec = schema.REGISTRY["stock_sse_summary"]
    raw = landed(spark, spec, [{"trade_date": "2024-01-02"}]).withColumn("trade_date", F.col("trade_date").cast("date"))
    raw.write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    ctx = context(lake, calendar, 2024, 1, 10, 17)
    end = runner.cutoff(ctx, spec)
    rows_ = runner.pick(ctx, spec, runner.typed(ctx, spec, source, end), runner.plan(ctx, spec, end))
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trade_date" in plan and "LessThanOrEqual(trade_date" in plan


def test_append_is_idempotent_and_resumes(spark, lake, calendar):
    spec = schema.REGISTRY["stock_margin_szse"]
    days = ["20240102", "20240103", "2024-01-04", "20240106", "20240110"]
    source = landed(spark, spec, [{"trade_date": d, "margin_buy": "1.005"} for d in days + days[:1]])
    runner.run(context(lake, calendar, 2024, 1, 5, 9), spec, source)
    first = rows(runner.stored_rows(context(lake, calendar, 2024, 1, 5, 9), spec), "trade_date", "margin_buy")
    assert [r[0] for r in first] == [date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 4)]
    runner.run(context(lake, calendar, 2024, 1, 5, 9), spec, source)
    ctx = context(lake, calendar, 2024, 1, 11, 9)
    assert rows(runner.stored_rows(ctx, spec), "trade_date", "margin_buy") == first
    runner.run(ctx, spec, source)
    got = [r[0] for r in rows(runner.stored_rows(ctx, spec), "trade_date")]
    assert got == [date(2024, 1, d) for d in (2, 3, 4, 10)]  # the 6th is no trading day
    assert log_of(ctx)[spec.name] == (synclog.SUCCESS, date(2024, 1, 10))


def test_keyed_append_plans_every_symbol(spark, lake, calendar):
    spec = schema.REGISTRY["stock_zh_a_hist_daily_bfq"]
    universe = spark.createDataFrame([("1",), ("2",), ("3",)], "symbol string")
    bars = lambda s, days: [{"symbol": s, "trade_date": f"202401{d:02d}", "close": "9.5"} for d in days]
    ctx = context(lake, calendar, 2024, 1, 3, 17)
    runner.run(ctx, spec, landed(spark, spec, bars("1", [2, 3, 4]) + bars("9", [2])), universe)
    assert rows(runner.stored_rows(ctx, spec), "symbol", "trade_date") == [("1", date(2024, 1, 2)), ("1", date(2024, 1, 3))]
    ctx = context(lake, calendar, 2024, 1, 4, 16)  # before the close: the 4th is not finished
    runner.run(ctx, spec, landed(spark, spec, bars("1", [2, 3, 4]) + bars("2", [3])), universe)
    assert len(rows(runner.stored_rows(ctx, spec))) == 3


def test_calendar_table_takes_all_new_dates(spark, lake, calendar):
    spec = schema.REGISTRY["stock_trade_date"]
    source = landed(spark, spec, [{"exchange": "SSE", "trade_date": d} for d in ("20240102", "20240103", "20241231")])
    for clock in ((2024, 1, 3, 9), (2024, 1, 4, 9)):
        ctx = context(lake, calendar, *clock)
        runner.run(ctx, spec, source)
    got = rows(runner.stored_rows(ctx, spec), "trade_date", "load_date")
    assert got == [(date(2024, m, d), date(2024, 1, 3)) for m, d in ((1, 2), (1, 3), (12, 31))]


def test_excluded_boards(spark, lake, calendar):
    spec = schema.REGISTRY["stock_board_concept_hist_em"]
    universe = spark.createDataFrame([("BK1631",), ("BK0001",)], "board_code string")
    record = lambda b, d: {"board_code": b, "board_name": b, "trade_date": d}
    source = landed(spark, spec, [record(b, d) for b in ("BK1631", "BK0001") for d in ("20240104", "20240105", "20240108")])
    ctx = context(lake, calendar, 2024, 1, 8, 16)  # strictly before the 8th: the 5th is the last one
    runner.run(ctx, spec, source, universe)
    assert rows(runner.stored_rows(ctx, spec), "board_code", "trade_date") == [("BK0001", date(2024, 1, 4)), ("BK0001", date(2024, 1, 5))]


def test_quarters_are_replaced_whole(spark, lake, calendar):
    spec = schema.REGISTRY["stock_yjyg_em"]
    one = {"report_date": "20231231", "symbol": "000001", "metric": "m", "announce_date": "20240201", "reason_text": "a"}
    old = {"report_date": "20230930", "symbol": "000001", "metric": "m", "announce_date": "20231020"}
    ctx = context(lake, calendar, 2024, 2, 15, 9)
    runner.run(ctx, spec, landed(spark, spec, [old, one, {**one, "reason_text": "b"}, {**one, "symbol": "000002"}]))
    assert rows(runner.stored_rows(ctx, spec), "report_date", "symbol", "reason_text") == [
        (date(2023, 9, 30), "000001", None), (date(2023, 12, 31), "000001", "b"), (date(2023, 12, 31), "000002", "a"),
    ]
    ctx = context(lake, calendar, 2024, 3, 15, 9)
    runner.run(ctx, spec, landed(spark, spec, [{**one, "reason_text": "c"}]))
    assert rows(runner.stored_rows(ctx, spec), "report_date", "symbol", "reason_text") == [
        (date(2023, 9, 30), "000001", None), (date(2023, 12, 31), "000001", "c"),
    ]


def test_revised_history(spark, lake, calendar):
    spec = schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    universe = spark.createDataFrame([("1",), ("2",)], "symbol string")
    series = lambda s, closes: [{"symbol": s, "trade_date": f"202401{d:02d}", "close": c} for d, c in closes.items()]
    first = series("1", {2: "10", 3: "11"}) + series("2", {2: "-5", 3: "-6"})
    runner.run(context(lake, calendar, 2024, 1, 3, 17), spec, landed(spark, spec, first), universe)
    later = series("1", {2: "5", 3: "5.5", 4: "6"}) + series("2", {2: "0", 3: "-6", 4: "-7"})
    for _ in range(2):
        ctx = context(lake, calendar, 2024, 1, 4, 17)
        runner.run(ctx, spec, landed(spark, spec, later), universe)
        got = [(s, d.day, float(c)) for s, d, c in rows(runner.stored_rows(ctx, spec), "symbol", "trade_date", "close")]
        assert got == [("1", 2, 5.0), ("1", 3, 5.5), ("1", 4, 6.0), ("2", 2, -5.0), ("2", 3, -6.0), ("2", 4, -7.0)]


def test_intraday_bars_start_fifty_days_back(spark, lake, calendar):
    spec = schema.REGISTRY["stock_zh_a_hist_30min_qfq"]
    universe = spark.createDataFrame([("1",)], "symbol string")
    times = ["2023-12-01 10:00:00", "2024-01-10 10:00:00", "2024-01-10 10:30:00", "2024-01-10 11:00:00"]
    source = landed(spark, spec, [{"symbol": "1", "bar_time": t, "close": "1"} for t in times])
    ctx = context(lake, calendar, 2024, 2, 1, 17)
    runner.run(ctx, spec, source, universe)
    assert [r[0].hour for r in rows(runner.stored_rows(ctx, spec), "bar_time")] == [10, 10, 11]


def test_snapshot_and_like(spark, lake, calendar):
    boards = schema.REGISTRY["stock_board_concept_name_em"]
    ctx = context(lake, calendar, 2024, 1, 4, 17)
    runner.run(ctx, boards, landed(spark, boards, [{"board_name": "x", "rank": "1"}, {"board_name": "y", "rank": "2"}]))
    later = context(lake, calendar, 2024, 1, 5, 17)
    runner.run(later, boards, landed(spark, boards, []))
    assert rows(runner.stored_rows(later, boards), "board_name", "trade_date") == [("x", date(2024, 1, 4)), ("y", date(2024, 1, 4))]
    runner.run(later, boards, landed(spark, boards, [{"board_name": "z"}]))
    assert rows(runner.stored_rows(later, boards), "board_name") == [("z",)]

    stocks = schema.REGISTRY["stock_basic_info"]
    record = lambda s, b, e="SSE": {"symbol": s, "symbol_name": "n", "exchange": e, "board": b, "list_date": "19990101"}
    incomplete = {**record("9", "main"), "list_date": "n/a"}
    runner.run(ctx, stocks, landed(spark, stocks, [record("1", "main-a"), record("2", "star"), record("3", "main-a", "SZSE")]))
    week = context(lake, calendar, 2024, 1, 14, 17)
    runner.run(week, stocks, landed(spark, stocks, [record("4", "main"), incomplete, record("5", "main", "BSE")]))
    assert [r[0] for r in rows(runner.stored_rows(week, stocks), "symbol")] == ["2", "3", "4", "5", ]


def test_exchanges_and_boards_have_their_own_watermarks(spark, lake, calendar):
    """Two exchanges in one week; a rule replaces the boards that contain its text, and no others."""
    spec = schema.REGISTRY["stock_basic_info"]
    record = lambda s, e, b: {"symbol": s, "symbol_name": "n", "exchange": e, "board": b, "list_date": "19990101"}
    rules = spark.createDataFrame(list(schema.SECURITY_RULES), "exchange string, board string")
    delisted = spark.createDataFrame([("9",)], "symbol string")
    load = lambda day, records: runner.run(
        context(lake, calendar, 2024, 1, day, 17), spec, landed(spark, spec, records), rules, without=delisted
    )
    stored = lambda: [(s, b, d.day) for s, b, d in rows(runner.stored_rows(context(lake, calendar, 2024, 1, 14, 17), spec), "symbol", "board", "load_date")]
    load(7, [record("1", "SSE", "主板A股"), record("9", "SSE", "主板A股"), record("2", "SSE", "科创板")])
    load(7, [record("3", "SZSE", "A股列表-主板"), record("4", "SZSE", "A股列表-创业板"), record("5", "SZSE", "B股列表-主板")])
    assert stored() == [("1", "主板A股", 5), ("2", "科创板", 5), ("3", "A股列表-主板", 5), ("4", "A股列表-创业板", 5), ("5", "B股列表-主板", 5)]
    load(7, [record("6", "SSE", "主板A股"), record("7", "BSE", "北交所")])  # only the second was not loaded this week
    assert [s for s, *_ in stored()] == ["1", "2", "3", "4", "5", "7"]
    load(14, [record("8", "SZSE", "A股列表-主板"), record("0", "XXX", "主板A股")])  # both boards of the rule go; no rule names XXX
    assert stored() == [("1", "主板A股", 5), ("2", "科创板", 5), ("5", "B股列表-主板", 5), ("7", "北交所", 5), ("8", "A股列表-主板", 12)]


def test_members_and_funds(spark, lake, calendar):
    members = schema.REGISTRY["stock_board_industry_cons_em"]
    universe = spark.createDataFrame([("B1",), ("B2",)], "board_code string")
    record = lambda b, s: {"board_code": b, "symbol": s}
    ctx = context(lake, calendar, 2024, 1, 7, 17)
    runner.run(ctx, members, landed(spark, members, [record("B1", "1"), record("B1", "1"), record("B2", "2")]), universe)
    assert rows(runner.stored_rows(ctx, members), "board_code", "symbol") == [("B1", "1"), ("B2", "2")]

    funds = schema.REGISTRY["fund_name_em"]
    runner.run(ctx, funds, landed(spark, funds, [{"fund_code": "f", "fund_type": "a"}]))
    week = context(lake, calendar, 2024, 1, 14, 17)
    runner.run(week, funds, landed(spark, funds, [{"fund_code": "f", "fund_type": "b"}, {"fund_code": "g"}, {"fund_type": "x"}]))
    assert rows(runner.stored_rows(week, funds), "fund_code", "fund_type") == [("f", "a"), ("g", None)]


def test_fund_years(spark, lake, calendar):
    spec = schema.REGISTRY["fund_portfolio_hold_em"]
    hold = lambda f, q, s, v="1": {"fund_code": f, "report_date": q, "symbol": s, "holding_value": v, "symbol_name": "中" * 12}
    ctx = context(lake, calendar, 2024, 2, 10, 9)
    marks = spark.createDataFrame([("f", date(2022, 12, 31)), ("g", date(2023, 6, 30))], "fund_code string, watermark date")
    source = [hold("f", "20221231", "old"), hold("f", "20231231", "1"), hold("f", "20231231", "1", "2"), hold("g", "20231231", "1")]
    runner.run(ctx, spec, landed(spark, spec, source), marks=marks)
    got = rows(runner.stored_rows(ctx, spec), "fund_code", "symbol", "holding_value")
    assert [(f, s, float(v)) for f, s, v in got] == [("f", "1", 2.0), ("g", "1", 1.0)]
    assert {r.symbol_name for r in runner.stored_rows(ctx, spec).collect()} == {"中" * 10}
    ctx = context(lake, calendar, 2024, 3, 10, 9)
    runner.run(ctx, spec, landed(spark, spec, [hold("f", "20231231", "2"), hold("f", "20230331", "3")]), marks=marks)
    assert [r[:2] for r in rows(runner.stored_rows(ctx, spec), "fund_code", "symbol")] == [("f", "2"), ("f", "3"), ("g", "1")]


def test_months_stop_at_the_first_gap(spark, lake, calendar):
    spec = schema.REGISTRY["stock_szse_sector_summary"]
    months = [{"month": m, "name": "n"} for m in ("20190101", "20190201", "20190401")]
    ctx = context(lake, calendar, 2019, 7, 2, 9)
    runner.run(ctx, spec, landed(spark, spec, months))
    assert [r[0].month for r in rows(runner.stored_rows(ctx, spec), "month")] == [1, 2]


def test_custody_pair(spark, lake, calendar):
    summary, detail = schema.REGISTRY["stock_hk_ccass_records_summary"], schema.REGISTRY["stock_hk_ccass_records"]
    universe = spark.createDataFrame([("00001",)], "symbol string")
    s = landed(spark, summary, [{"trade_date": d, "symbol": "00001", "holder_type": "t", "holding": "5"} for d in ("20240104", "20240106")])
    d = landed(spark, detail, [{"trade_date": "20240104", "symbol": "00001", "participant_id": p, "holding": "5"} for p in "ab"])
    ctx = context(lake, calendar, 2024, 1, 8, 9)
    assert runner.run_pair(ctx, (summary, s), (detail, d), universe)
    assert len(rows(runner.stored_rows(ctx, summary))) == 1  # the 6th is a Saturday
    assert len(rows(runner.stored_rows(ctx, detail))) == 2
    later = context(lake, calendar, 2024, 1, 9, 9)
    assert not runner.run_pair(later, (summary, s), (detail, d), universe)


def test_failures_are_logged_and_raised(spark, lake, calendar):
    spec = schema.REGISTRY["stock_margin_szse"]
    bad = landed(spark, spec, [{"trade_date": "20240102"}]).withColumn("margin_buy", F.raise_error(F.lit("broken")))
    ctx = context(lake, calendar, 2024, 1, 5, 9)
    with pytest.raises(Exception, match="broken"):
        runner.run(ctx, spec, bad)
    assert log_of(ctx)[spec.name] == (synclog.FAILED, date(1970, 1, 1))
    assert rows(runner.stored_rows(ctx, spec)) == []
    runner.purge_log(ctx, [spec.name])
    assert log_of(ctx) == {}


def test_runs_that_end_at_once_keep_their_log_rows(spark, lake, calendar):
    from concurrent.futures import ThreadPoolExecutor

    names = ["stock_margin_szse", "stock_margin_sse", "stock_sse_summary", "stock_trade_date"]
    specs = [schema.REGISTRY[n] for n in names]

    def load(spec):
        runner.run(context(lake, calendar, 2024, 1, 5, 9), spec, landed(spark, spec, [{spec.date: "20240102"}]))

    lake.commits("sync_logs").count(), lake.commits("units").count()
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(load, specs))
    assert set(log_of(context(lake, calendar, 2024, 1, 5, 9))) == set(names)


def _bars(symbol, closes):
    return [{"symbol": symbol, "trade_date": f"202401{d:02d}", "close": c} for d, c in closes.items()]


def test_history_is_never_cut(spark, lake, calendar):
    spec = schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    universe = spark.createDataFrame([("1",)], "symbol string")
    runner.run(context(lake, calendar, 2024, 1, 3, 17), spec, landed(spark, spec, _bars("1", {2: "10", 3: "11"})), universe)
    before = rows(runner.stored_rows(context(lake, calendar, 2024, 1, 3, 17), spec), "trade_date", "close")
    ctx = context(lake, calendar, 2024, 1, 5, 17)
    with pytest.raises(ValueError, match="no overlap bar"):
        runner.run(ctx, spec, landed(spark, spec, _bars("1", {4: "12"})), universe)
    with pytest.raises(ValueError, match="history of 1 starts after"):
        runner.run(ctx, spec, landed(spark, spec, _bars("1", {3: "5.5", 4: "6", 5: "7"})), universe)
    assert rows(runner.stored_rows(ctx, spec), "trade_date", "close") == before
    assert log_of(ctx)[spec.name] == (synclog.FAILED, date(2024, 1, 3))
    history = landed(spark, spec, _bars("1", {2: "5", 3: "5.5", 4: "6"}))
    runner.run(ctx, spec, landed(spark, spec, _bars("1", {3: "5.5", 4: "6"})), universe, history=history)
    assert [float(c) for _, c in rows(runner.stored_rows(ctx, spec), "trade_date", "close")] == [5.0, 5.5, 6.0]


def test_later_load_wins_whatever_the_clock_says(spark, lake, calendar):
    spec = schema.REGISTRY["fund_portfolio_hold_em"]
    marks = spark.createDataFrame([("f", date(2022, 12, 31))], "fund_code string, watermark date")
    hold = lambda v: landed(spark, spec, [{"fund_code": "f", "report_date": "20231231", "symbol": "1", "holding_value": v}])
    for clock, value in (((2024, 3, 10, 9), "1"), ((2024, 3, 10, 9), "2"), ((2024, 2, 10, 9), "3")):
        ctx = context(lake, calendar, *clock)
        runner.run(ctx, spec, hold(value), marks=marks)
        assert [float(r[0]) for r in rows(runner.stored_rows(ctx, spec), "holding_value")] == [float(value)]


def test_funds_are_due_after_four_months(spark, lake, calendar):
    spec = schema.REGISTRY["fund_portfolio_hold_em"]
    marks = spark.createDataFrame([("f", date(2023, 12, 31))], "fund_code string, watermark date")
    for clock, due in (((2024, 1, 31, 9), 0), ((2024, 4, 29, 9), 0), ((2024, 4, 30, 9), 1)):
        ctx = context(lake, calendar, *clock)
        assert runner.plan(ctx, spec, runner.cutoff(ctx, spec), marks=marks).count() == due


def test_what_does_not_fit_fails_the_load(spark, lake, calendar):
    spec = schema.REGISTRY["stock_szse_area_summary"]
    ctx = context(lake, calendar, 2020, 6, 2, 9)
    with pytest.raises(Exception, match="does not fit"):
        runner.run(ctx, spec, landed(spark, spec, [{"month": "202003", "area": "a", "market_pct": "100.00"}]))
    assert rows(runner.stored_rows(ctx, spec)) == [] and log_of(ctx)[spec.name][0] == synclog.FAILED
    runner.run(ctx, spec, landed(spark, spec, [{"month": "202003", "area": "a", "market_pct": "n/a"}]))
    assert rows(runner.stored_rows(ctx, spec), "month", "market_pct") == [(date(2020, 3, 1), None)]


def test_whole_numbers_that_do_not_fit_fail_the_load(spark, lake, calendar):
    spec = schema.REGISTRY["stock_szse_sector_summary"]
    ctx = context(lake, calendar, 2019, 7, 2, 9)
    one = {"month": "201901", "name": "n"}
    for column, value in (("trade_days", "99999999999"), ("trade_days", "100"), ("amount", "12345678901234567890"), ("deals", "1e40"), ("volume_pct", "1e40")):
        with pytest.raises(Exception, match=f"{column}: value does not fit .*{value.replace('.', '[.]')} in row 201901 n"):
            runner.run(ctx, spec, landed(spark, spec, [{**one, column: value}]))
    assert rows(runner.stored_rows(ctx, spec)) == [] and log_of(ctx)[spec.name][0] == synclog.FAILED
    runner.run(ctx, spec, landed(spark, spec, [{**one, "trade_days": "22", "amount": "123456789012345678", "deals": "n/a", "volume": "7.5"}]))
    got = rows(runner.stored_rows(ctx, spec), "trade_days", "amount", "deals", "volume")
    assert got == [(22, 123456789012345678, None, 8)]


def test_numbers_that_need_no_rounding(spark, lake, calendar):
    """Landed whole numbers and decimals fit or fail as text does; the failure names nulls in the key."""
    spec = schema.REGISTRY["stock_zh_a_hist_daily_bfq"]
    good = landed(spark, spec, [{"trade_date": "20240105", "symbol": "a"}]).withColumns(
        {"close": F.lit("12345678.90").cast("decimal(28,2)"), "open": F.lit(7), "high": F.lit("1.005").cast("decimal(18,3)"), "volume": F.lit(9999999999)}
    )
    ctx = context(lake, calendar, 2024, 5, 14, 17)
    typed = lambda df: runner.typed(ctx, spec, df, runner.cutoff(ctx, spec))
    assert [str(v) for v in typed(good).select("close", "open", "high", "volume", "low").first()] == ["12345678.90", "7.00", "1.00", "9999999999", "None"]
    for column, value in (("close", F.lit("123456789.00").cast("decimal(28,2)")), ("open", F.lit(123456789)), ("volume", F.lit(-10000000000))):
        for day, text in (("20240105", "20240105"), (None, "null")):
            df = good.withColumns({column: value, "trade_date": F.lit(day).cast("string")})
            with pytest.raises(Exception, match=f"{column}: value does not fit .*: -?1[0-9.]+ in row (a {text}|{text} a)"):
                typed(df).collect()


@pytest.mark.parametrize("name", ["stock_zh_a_hist_daily_bfq", "stock_zh_a_hist_daily_qfq", "stock_zh_a_hist_30min_qfq"])
def test_casting_bars_is_compiled(name, spark, lake, calendar, tmp_path, capsys):
    """Java interprets methods above 8,000 bytes."""
    spec = schema.REGISTRY[name]
    one = landed(spark, spec, [{"symbol": "a"}]).withColumns({c: F.lit(1).cast("decimal(18,2)") for c in ("open", "close", "high", "low", "amount")})
    one.write.parquet(str(tmp_path / "landing"))
    ctx = context(lake, calendar, 2024, 5, 14, 17)
    runner.typed(ctx, spec, spark.read.parquet(str(tmp_path / "landing")), runner.cutoff(ctx, spec)).explain("codegen")
    sizes = [int(n) for n in re.findall("maxMethodCodeSize:([0-9]+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("text, day", [
    ("20240105", date(2024, 1, 5)), ("2024-01-05", date(2024, 1, 5)), ("2024-1-5", date(2024, 1, 5)), ("2024-01-05 10:30:00", date(2024, 1, 5)),
    ("202401", date(2024, 1, 1)), ("2024", None), ("20240", None), ("2024010", None), ("20241301", None), ("n/a", None), ("", None), (None, None),
])
def test_known_date_forms(text, day, spark):
    spec = schema.REGISTRY["stock_margin_sse"]
    df = landed(spark, spec, [{"trade_date": text}])
    assert df.select(runner.coerce(df.schema["trade_date"], spec.schema["trade_date"])).first()[0] == day


def test_keys_that_come_twice_fail_the_load(spark, lake, calendar):
    ctx = context(lake, calendar, 2024, 2, 15, 9)
    reports = schema.REGISTRY["stock_yjbb_em"]  # the last arrival does not count here: the key has to be unique
    one = {"report_date": "20231231", "symbol": "000001", "eps": "1"}
    with pytest.raises(ValueError, match="2 rows with the key report_date 2023-12-31, symbol 000001"):
        runner.run(ctx, reports, landed(spark, reports, [one, {**one, "eps": "2"}, {**one, "symbol": "000002"}]))
    assert rows(runner.stored_rows(ctx, reports)) == []
    boards = schema.REGISTRY["stock_board_concept_name_em"]
    with pytest.raises(ValueError, match="2 rows with the key board_name x"):
        runner.run(ctx, boards, landed(spark, boards, [{"board_name": "x"}, {"board_name": "x"}]))
    bars = schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    universe = spark.createDataFrame([("1",)], "symbol string")
    with pytest.raises(ValueError, match="2 rows with the key trade_date 2024-02-01, symbol 1"):
        runner.run(ctx, bars, landed(spark, bars, [{"symbol": "1", "trade_date": "20240201"}] * 2), universe)
    stocks = schema.REGISTRY["stock_basic_info"]
    record = lambda b: landed(spark, stocks, [{"symbol": "1", "symbol_name": "n", "exchange": "SSE", "board": b, "list_date": "19990101"}])
    runner.run(ctx, stocks, record("main"))
    with pytest.raises(ValueError, match="2 rows with the key symbol 1, exchange SSE"):  # stored on another board
        runner.run(ctx, stocks, record("star"))
    assert rows(runner.stored_rows(ctx, stocks), "board") == [("main",)]
    summary, detail = schema.REGISTRY["stock_hk_ccass_records_summary"], schema.REGISTRY["stock_hk_ccass_records"]
    s = landed(spark, summary, [{"trade_date": "20240201", "symbol": "1", "holder_type": "t"}] * 2)
    d = landed(spark, detail, [{"trade_date": "20240201", "symbol": "1", "participant_id": "a"}])
    with pytest.raises(ValueError, match="holder_type t"):
        runner.run_pair(ctx, (summary, s), (detail, d), universe)
    assert rows(runner.stored_rows(ctx, summary)) == [] and {v[0] for v in log_of(ctx).values()} >= {synclog.FAILED}


def test_one_sided_units_wait(spark, lake, calendar):
    summary, detail = schema.REGISTRY["stock_hk_ccass_records_summary"], schema.REGISTRY["stock_hk_ccass_records"]
    universe = spark.createDataFrame([("1",), ("2",)], "symbol string")
    s = landed(spark, summary, [{"trade_date": "20240104", "symbol": x, "holder_type": "t", "holding": "5"} for x in "12"])
    d = landed(spark, detail, [{"trade_date": "20240104", "symbol": "1", "participant_id": "a", "holding": "5"}])
    ctx = context(lake, calendar, 2024, 1, 8, 9)
    assert runner.run_pair(ctx, (summary, s), (detail, d), universe)
    assert rows(runner.stored_rows(ctx, summary), "symbol") == [("1",)]


def test_late_sides_fill_their_gap(spark, lake, calendar):
    """The detail of the 4th lands after the 5th was loaded; a repeat finds nothing."""
    summary, detail = schema.REGISTRY["stock_hk_ccass_records_summary"], schema.REGISTRY["stock_hk_ccass_records"]
    universe = spark.createDataFrame([("1",)], "symbol string")
    s = landed(spark, summary, [{"trade_date": d, "symbol": "1", "holder_type": "t", "holding": "5"} for d in ("20240104", "20240105")])
    side = lambda *days: landed(spark, detail, [{"trade_date": d, "symbol": "1", "participant_id": "a", "holding": "5"} for d in days])
    ctx = context(lake, calendar, 2024, 1, 8, 9)
    assert runner.run_pair(ctx, (summary, s), (detail, side("20240105")), universe)
    assert rows(runner.stored_rows(ctx, summary), "trade_date") == [(date(2024, 1, 5),)]
    later = context(lake, calendar, 2024, 1, 9, 9)
    assert runner.run_pair(later, (summary, s), (detail, side("20240104", "20240105")), universe)
    for spec in (summary, detail):
        assert rows(runner.stored_rows(later, spec), "trade_date") == [(date(2024, 1, 4),), (date(2024, 1, 5),)]
    again = context(lake, calendar, 2024, 1, 9, 10)
    assert not runner.run_pair(again, (summary, s), (detail, side("20240104", "20240105")), universe)
    # the plan reads the kept intervals, not the tables
    plan = runner.plan_units(again, summary, runner.cutoff(again, summary), universe)
    files = plan.inputFiles()
    assert files and all("__units" in f or "/commits/" in f for f in files)


@pytest.mark.parametrize("grain, folders", [("day", 2), ("month", 1)])
def test_the_plan_prunes_the_folders_of_a_keyed_landing(grain, folders, spark, lake, calendar, tmp_path):
    spec, path = schema.REGISTRY["stock_zh_a_hist_daily_bfq"], str(tmp_path / "in")
    universe = spark.createDataFrame([("1",), ("2",)], "symbol string")
    days = ["2023-11-30", "2023-12-29", "2024-01-02", "2024-01-03", "2024-01-04", "2024-02-01"]
    bars = landed(spark, spec, [{"symbol": s, "trade_date": d, "close": "1"} for s in "12" for d in days]).drop("_batch", "_pos")
    landing.land(bars.withColumn("trade_date", F.col("trade_date").cast("date")), path, "trade_date", grain)
    source = landing.read_landing(spark, path)
    first = context(lake, calendar, 2024, 1, 2, 17)
    runner.run(first, spec, source, universe)
    assert runner.stored_rows(first, spec).count() == 6
    ctx = context(lake, calendar, 2024, 1, 4, 17)
    end = runner.cutoff(ctx, spec)
    picked = runner.pick(ctx, spec, runner.typed(ctx, spec, source, end), runner.plan(ctx, spec, end, universe))
    assert picked.count() == 4
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    scan = _landing_scan(picked)
    assert scan.metrics().get("numPartitions").get().value() == folders
    runner.run(ctx, spec, source, universe)
    assert runner.stored_rows(ctx, spec).count() == 10


def _landing_scan(df):
    """The scan of the landing in the executed plan of a frame that ran."""
    df.collect()
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet") and "dynamicpruning" in node.toString():
            return node
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    raise AssertionError("no pruned scan")


def test_arrival_is_the_time_of_writing(spark, lake, calendar, tmp_path):
    """The later file wins, whatever the files and their folders are called."""
    import os

    spec = schema.REGISTRY["stock_yjyg_em"]
    one = {"report_date": "20231231", "symbol": "000001", "metric": "m", "announce_date": "20240201"}
    for folder, text, written in (("b/z", "early", 1_700_000_000), ("a/a", "late", 1_700_000_500)):
        landed(spark, spec, [{**one, "reason_text": text}]).drop("_batch", "_pos").coalesce(1).write.parquet(str(tmp_path / folder))
        for file in (tmp_path / folder).glob("*.parquet"):
            os.utime(file, (written, written))
    ctx = context(lake, calendar, 2024, 2, 15, 9)
    both = landing.with_arrival(spark.read.parquet(*[str(tmp_path / f) for f in ("b/z", "a/a")]))
    runner.run(ctx, spec, both)
    assert rows(runner.stored_rows(ctx, spec), "reason_text") == [("late",)]


def test_plans_read_the_kept_state(spark, lake, calendar):
    """States equal those of the stored rows after appended, repeated and revised loads."""
    universe = spark.createDataFrame([("1",), ("2",), ("3",)], "symbol string")
    spec = schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    loads = [
        (3, _bars("1", {2: "10", 3: "11"}) + _bars("2", {2: "1"})),
        (4, _bars("1", {3: "11", 4: "12"}) + _bars("2", {2: "1", 4: "2"}) + _bars("3", {4: "7"})),
        (4, _bars("1", {4: "12"})),
        (5, _bars("1", {1: "4", 2: "5", 4: "6", 5: "6.5"}) + _bars("2", {4: "2"})),
    ]
    for day, records in loads:
        ctx = context(lake, calendar, 2024, 1, day, 17)
        runner.run(ctx, spec, landed(spark, spec, records), universe)
        stored = runner.stored_rows(ctx, spec)
        assert rows(runner.state(ctx, spec)) == rows(kept.state_of(spec, stored))
        plan = runner.plan(ctx, spec, runner.cutoff(ctx, spec), universe)
        files = plan.inputFiles()
        assert files and all(f"/{spec.name}__state/" in f or "/commits/" in f for f in files)
    assert [r.first_date for r in runner.state(ctx, spec).filter("symbol = '1'").collect()] == [date(2024, 1, 1)]


def test_a_table_without_kept_state_is_scanned_once(spark, lake, calendar):
    spec = schema.REGISTRY["stock_margin_szse"]
    ctx = context(lake, calendar, 2024, 1, 3, 9)
    table = ctx.table(spec)
    old = runner.typed(ctx, spec, landed(spark, spec, [{"trade_date": "20240102", "margin_buy": "1"}]), F.lit(None))
    table.write_batch(old, "before")
    later = context(lake, calendar, 2024, 1, 5, 9)
    source = landed(spark, spec, [{"trade_date": d, "margin_buy": "2"} for d in ("20240102", "20240103")])
    runner.run(later, spec, source)
    assert [(d.day, int(v)) for d, v in rows(runner.stored_rows(later, spec), "trade_date", "margin_buy")] == [(2, 1), (3, 2)]
    assert rows(runner.state(later, spec)) == [(date(2024, 1, 2), date(2024, 1, 3))]


def test_source_columns_are_renamed_by_position(spark):
    spec = schema.REGISTRY["stock_hk_short_sale"]
    raw = spark.createDataFrame([("a", "b", "c", "d", "e", "f", 1)], "x1 string, x2 string, x3 string, x4 string, x5 string, _batch string, _pos int")
    assert runner.from_source_columns(spec, raw).columns == [*spec.schema.fieldNames(), "_batch", "_pos"]


    with pytest.raises(ValueError, match="6 source columns for 5"):
        runner.from_source_columns(spec, raw.withColumnRenamed("_pos", "x6"))


def test_the_parent_keeps_the_date_of_the_last_planned_year(spark, lake, calendar):
    spec, master = schema.REGISTRY["fund_portfolio_hold_em"], schema.REGISTRY["fund_name_em"]
    ctx = lambda *clock: context(lake, calendar, *clock)
    runner.run(ctx(2022, 2, 9, 9), master, landed(spark, master, [{"fund_code": f, "fund_type": "x"} for f in "fgh"]))
    shown = lambda: dict(rows(runner.stored_rows(ctx(2024, 1, 1, 9), master), "fund_code", "latest_holding_date"))
    assert shown() == {"f": None, "g": None, "h": None}
    spec = replace(spec, default="2020-12-31")
    hold = lambda f, q: {"fund_code": f, "report_date": q, "symbol": "1", "holding_value": "1"}
    universe = spark.createDataFrame([("f",), ("g",)], "fund_code string")
    source = [hold("f", "20211231"), hold("f", "20220331"), hold("g", "20210331"), hold("h", "20220331")]
    runner.run(ctx(2022, 5, 10, 9), spec, landed(spark, spec, source), universe)
    # g had no rows in 2022, the last planned year
    assert shown() == {"f": date(2022, 3, 31), "g": date(2021, 12, 31), "h": None}
    runner.run(ctx(2022, 6, 10, 9), spec, landed(spark, spec, source), universe)  # f is not due, g has no rows again
    assert shown() == {"f": date(2022, 3, 31), "g": date(2021, 12, 31), "h": None}
    runner.run(ctx(2022, 8, 10, 9), spec, landed(spark, spec, [*source, hold("f", "20220630"), hold("g", "20220630")]), universe)
    assert shown() == {"f": date(2022, 6, 30), "g": date(2022, 6, 30), "h": None}


def test_reports_of_metrics_and_items(spark, lake, calendar):
    spec = schema.REGISTRY["stock_sse_deal_daily"]
    raw = [
        ("挂牌数", "10", "3", None, "a", 0, "2024-01-02"), ("成交金额", "1.5", "2.25", None, "a", 1, "2024-01-02"), ("别的", "9", "9", "9", "a", 2, "2024-01-02"),
        ("挂牌数", "11", "4", "5", "b", 0, "2024-01-03"), ("市价总值", "1", None, "7", "b", 1, "2024-01-03"),
    ]
    reports = spark.createDataFrame(raw, "what string, `主板A` string, `主板B` string, `科创板` string, _batch string, _pos int, day string")
    source = runner.from_reports(spec, reports, date="day")
    ctx = context(lake, calendar, 2024, 1, 3, 17)
    missing = {c: F.lit(None).cast("string") for c in spec.landed_columns if c not in source.columns}
    runner.run(ctx, replace(spec, floor=None, default="2023-12-31"), source.withColumns(missing))
    got = rows(runner.stored_rows(ctx, spec), "trade_date", "board", "listed_count", "amount", "market_cap")
    number = lambda v: None if v is None else float(v)
    assert [(d.day, b, n, number(a), number(m)) for d, b, n, a, m in got] == [
        (2, "主板A", 10, 1.5, None), (2, "主板B", 3, 2.25, None),
        (3, "主板A", 11, None, 1.0), (3, "主板B", 4, None, None), (3, "科创板", 5, None, 7.0),
    ]


def test_data_dictionary(spark):
    specs = list(schema.SPECS)
    columns = dictionary.columns_of(spark, "LAKE", [(s.name, s.schema) for s in specs])
    tables, labels = dictionary.comments_of(spark, "LAKE", specs)
    result = dictionary.dictionary(columns, tables, labels, "lake")
    assert result.count() == sum(len(s.schema) for s in specs)
    row = result.filter("table_name = 'stock_yjbb_em' AND column_name = 'eps'").first()
    assert (row.type_text, row.nullable_flag, row.column_position, row.column_comment) == ("NUMBER(10,2)", "YES", 4, "eps")


def test_a_keyed_plan_is_joined_by_its_ranges_not_by_its_days(spark, lake, calendar, monkeypatch):
    """What a plan writes and joins is a row a key, and beyond a number of rows that is not broadcast, however
    small its file is."""
    monkeypatch.setattr(runner, "BROADCAST_ROWS", 10)
    written = []
    stage = runner._written
    monkeypatch.setattr(runner, "_written", lambda c, s, planned: written.append(stage(c, s, planned)) or written[-1])
    for name, kept_days in (("stock_hk_ccass_records_summary", ["20240105"]), ("stock_hk_short_sale_em", ["20240105", "20240106"])):
        spec = schema.REGISTRY[name]
        ctx = context(lake, calendar, 2024, 5, 14, 17)
        end = runner.cutoff(ctx, spec)
        source = landed(spark, spec, [{"symbol": str(s), "trade_date": d} for s in (3, 99) for d in ("20220105", "20240105", "20240106", "20250106")])
        universe = spark.range(20).selectExpr("CAST(id AS string) AS symbol")
        planned = runner.plan(ctx, spec, end, universe, universe.selectExpr("symbol", "DATE'2023-12-31' AS watermark"))
        picked = runner.pick(ctx, spec, runner.typed(ctx, spec, source, end), planned)
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert rows(picked.selectExpr("symbol", "date_format(trade_date, 'yyyyMMdd')")) == [("3", d) for d in kept_days]
    assert [df.count() for df in written] == [20, 20]
