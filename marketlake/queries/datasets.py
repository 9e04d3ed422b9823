"""Loads of the datasets whose mix of write mode, load rule and cut-off no other query runs."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake import schema
from marketlake.functions import text
from marketlake.functions.numbers import money
from marketlake.plans import bars, runner
from marketlake.queries.base import BAR_VALUES, SQL_CALENDAR, SQL_QUARTERS, Tables, doubles, query, sql_bars, sql_doubles
from marketlake.queries.loads import _lake, _landed

BAR_COLUMNS = ("symbol", "trade_date", "volume", *BAR_VALUES)


def _runs(t: Tables, spec: schema.DatasetSpec, loads: list[tuple[datetime, DataFrame]], **given) -> DataFrame:
    """The table after a load at each clock."""
    lake = _lake(t, spec.name)
    for now, landed in loads:
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, landed, **given)
    return runner.stored_rows(context, spec)


def _suppliers(t: Tables, column: str = "symbol") -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").cast("string").alias(column))


def _bars(t: Tables, df: DataFrame, spec: schema.DatasetSpec) -> DataFrame:
    return t.staged(_landed(spec, df, symbol=F.col("symbol").cast("string")), "landing")


# --- appended bars -----------------------------------------------------------------------

SQL_BAR_ROWS = f"CAST(symbol AS VARCHAR) AS symbol, trade_date, volume, {sql_doubles(*BAR_VALUES)}"


@query(f"""WITH {sql_bars()}, {SQL_CALENDAR} SELECT {SQL_BAR_ROWS} FROM bars
WHERE trade_date <= (SELECT max(trade_date) FROM calendar WHERE trade_date <= DATE '2001-06-14')""")
def maintain_unadjusted(t: Tables) -> DataFrame:
    """Unadjusted daily bars in three runs; before the close, the last finished trading day is that of yesterday."""
    spec = schema.REGISTRY["stock_zh_a_hist_daily_bfq"]
    landed = _bars(t, t.daily_bars(), spec)
    clocks = (datetime(1998, 1, 5, 17), datetime(1999, 1, 4, 17), datetime(2001, 6, 15, 16))
    return doubles(_runs(t, spec, [(c, landed) for c in clocks], universe=_suppliers(t)).select(*BAR_COLUMNS), *BAR_VALUES)


SQL_WEEKS = f"""{sql_bars()}, weeks AS (SELECT symbol, CAST(date_trunc('week', trade_date) + INTERVAL 4 DAY AS DATE) AS trade_date,
  CAST(sum(volume) AS BIGINT) AS volume, arg_min(open, trade_date) AS open, arg_max(close, trade_date) AS close, max(high) AS high, min(low) AS low,
  sum(amount) AS amount FROM bars GROUP BY symbol, date_trunc('week', trade_date))"""


def _weeks(t: Tables) -> DataFrame:
    return bars.weekly(t.daily_bars()).withColumn("trade_date", F.date_add("week_start", 4))


@query(f"""WITH {SQL_WEEKS} SELECT {SQL_BAR_ROWS} FROM weeks WHERE trade_date <= DATE '2001-06-08'""")
def maintain_weekly(t: Tables) -> DataFrame:
    """Backward-adjusted weekly bars in two runs, up to the Friday of the last finished week."""
    spec = schema.REGISTRY["stock_zh_a_hist_weekly_hfq"]
    landed = _bars(t, _weeks(t), spec)
    clocks = (datetime(1999, 1, 6, 17), datetime(2001, 6, 15, 17))
    return doubles(_runs(t, spec, [(c, landed) for c in clocks], universe=_suppliers(t)).select(*BAR_COLUMNS), *BAR_VALUES)


@query(f"""WITH {SQL_WEEKS}, moved AS (SELECT * REPLACE (CASE WHEN symbol % 7 = 0 THEN close / 2 ELSE close END AS close) FROM weeks)
SELECT {SQL_BAR_ROWS.replace('CAST(close AS DOUBLE)', 'CAST(CAST(round_even(CAST(close AS DECIMAL(18,4)), 2) AS DECIMAL(10,2)) AS DOUBLE)')}
FROM moved WHERE trade_date <= DATE '2001-06-08'""")
def maintain_weekly_revised(t: Tables) -> DataFrame:
    """Forward-adjusted weekly bars; before the second run every seventh symbol's closes were halved at the source."""
    spec = schema.REGISTRY["stock_zh_a_hist_weekly_qfq"]
    weeks = t.staged(_weeks(t), "weeks")
    halved = weeks.withColumn("close", F.when(F.col("symbol") % 7 == 0, F.col("close") / 2).otherwise(F.col("close")))
    loads = [(datetime(1999, 1, 6, 17), _bars(t, weeks, spec)), (datetime(2001, 6, 15, 17), _bars(t, halved, spec))]
    return doubles(_runs(t, spec, loads, universe=_suppliers(t)).select(*BAR_COLUMNS), *BAR_VALUES)


SQL_MONTHS = f"""{sql_bars()}, months AS (SELECT symbol, last_day(trade_date) AS trade_date, CAST(sum(volume) AS BIGINT) AS volume,
  arg_min(open, trade_date) AS open, arg_max(close, trade_date) AS close, max(high) AS high, min(low) AS low, sum(amount) AS amount
  FROM bars GROUP BY symbol, last_day(trade_date))"""


@query(f"""WITH {SQL_MONTHS} SELECT {SQL_BAR_ROWS} FROM months WHERE trade_date <= DATE '2001-05-31'""")
def maintain_monthly(t: Tables) -> DataFrame:
    """Backward-adjusted monthly bars in two runs, up to the end of the last month."""
    spec = schema.REGISTRY["stock_zh_a_hist_monthly_hfq"]
    landed = _bars(t, bars.monthly(t.daily_bars()).withColumn("trade_date", F.last_day("month")), spec)
    clocks = (datetime(1999, 1, 31, 17), datetime(2001, 6, 15, 17))
    return doubles(_runs(t, spec, [(c, landed) for c in clocks], universe=_suppliers(t)).select(*BAR_COLUMNS), *BAR_VALUES)


@query(f"""WITH {sql_bars()}, {SQL_CALENDAR} SELECT CAST(symbol AS VARCHAR) AS board_code, trade_date, volume, CAST(close AS DOUBLE) AS close FROM bars
WHERE symbol <> 3 AND trade_date > DATE '1998-01-01' AND trade_date <= (SELECT max(trade_date) FROM calendar WHERE trade_date < DATE '2001-06-15')""")
def maintain_board_history(t: Tables) -> DataFrame:
    """Daily bars of concept boards in two runs, up to the trading day before the last finished one; one
    board's history cannot be delivered."""
    spec = replace(schema.REGISTRY["stock_board_concept_hist_em"], default="1998-01-01", excluded=("3",))
    code = F.col("symbol").cast("string")
    landed = t.staged(_landed(spec, t.daily_bars(), board_code=code, board_name=code), "landing")
    loads = [(datetime(1999, 1, 5, 9), landed), (datetime(2001, 6, 15, 16), landed)]
    stored = _runs(t, spec, loads, universe=_suppliers(t, "board_code"))
    return doubles(stored.select("board_code", "trade_date", "volume", "close"), "close")


# --- slices and snapshots ----------------------------------------------------------------


@query("""WITH m AS (SELECT substr(p_brand, 7) AS board_code, CAST(p_partkey AS VARCHAR) AS symbol, p_size > 48 AS later FROM part),
b AS (SELECT board_code, bool_or(later) AS replaced FROM m GROUP BY 1)
SELECT board_code, symbol, CASE WHEN replaced THEN DATE '1999-01-15' ELSE DATE '1999-01-08' END AS trade_date
FROM m JOIN b USING (board_code) WHERE later OR NOT replaced""")
def maintain_members(t: Tables) -> DataFrame:
    """Members of industry boards in two weeks. Each member lands twice; a board that lands again is replaced whole."""
    spec = schema.REGISTRY["stock_board_industry_cons_em"]
    members = t.part.select(F.substring("p_brand", 7, 6).alias("board_code"), F.col("p_partkey").cast("string").alias("symbol"), "p_size")
    twice = members.unionByName(members)
    boards = members.select("board_code").distinct()
    loads = [
        (datetime(1999, 1, 11, 9), _landed(spec, twice)),
        (datetime(1999, 1, 12, 9), _landed(spec, twice.limit(0))),
        (datetime(1999, 1, 18, 9), _landed(spec, twice.filter("p_size > 48"))),
    ]
    return _runs(t, spec, loads, universe=boards).select("board_code", "symbol", "trade_date")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS etf_code, d AS load_date, CAST(CAST(s_suppkey % 1000 + n AS DECIMAL(8,3)) AS DOUBLE) AS last_price
FROM supplier, (VALUES (DATE '1999-01-05', 1), (DATE '1999-01-06', 4)) v(d, n)""")
def maintain_etf(t: Tables) -> DataFrame:
    """The closing snapshot, asked for four times in two days: it is taken once a day, after the close."""
    spec = replace(schema.REGISTRY["fund_etf_spot_em"], default="1998-01-01")
    clocks = (datetime(1999, 1, 5, 15, 30), datetime(1999, 1, 5, 16), datetime(1999, 1, 6, 10), datetime(1999, 1, 6, 15, 30))
    loads = [
        (c, _landed(spec, t.supplier, etf_code=F.col("s_suppkey").cast("string"), last_price=F.col("s_suppkey") % 1000 + n, load_date=F.lit(c).cast("date")))
        for n, c in enumerate(clocks, 1)
    ]
    return doubles(_runs(t, spec, loads).select("etf_code", "load_date", "last_price"), "last_price")


@query(f"""WITH {SQL_QUARTERS} SELECT report_date, lpad(CAST(symbol AS VARCHAR), CAST(greatest(6, length(CAST(symbol AS VARCHAR))) AS INTEGER), '0') AS symbol,
  CAST(revenue + CASE WHEN report_date >= DATE '1998-12-31' THEN 1 ELSE 0 END AS DOUBLE) AS cash
FROM company_quarters WHERE report_date >= DATE '1995-03-31' AND report_date <= DATE '2001-03-31'""")
def maintain_balance(t: Tables) -> DataFrame:
    """Balance sheets in two runs. The second begins with the last stored quarter, in which, as in all later
    ones, every sheet was corrected."""
    spec = replace(schema.REGISTRY["stock_zcfz_em"], default="1995-03-31")
    loads = []
    for now, correction in ((datetime(1999, 3, 15, 17), 0), (datetime(2001, 6, 15, 17), 1)):
        sheets = _landed(
            spec, t.company_quarters(), symbol=text.pad_code(F.col("symbol"), 6), cash=F.col("revenue") + correction,
            announce_date=F.add_months("report_date", 1),
        )
        loads.append((now, sheets))
    return doubles(_runs(t, spec, loads).select("report_date", "symbol", "cash"), "cash")


# --- market totals -----------------------------------------------------------------------


def _per_day(t: Tables, column: str) -> DataFrame:
    return t.orders_by_day().groupBy(F.col("o_orderdate").alias("trade_date"), F.col("o_orderpriority").alias(column)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money(F.col("o_totalprice"))).alias("total")
    )


@query("""SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderpriority AS category, count(*) AS "count",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders
WHERE isodow(o_orderdate) < 6 AND o_orderdate > TIMESTAMP '1997-12-31' AND o_orderdate <= TIMESTAMP '2001-06-15' GROUP BY 1, 2""")
def maintain_categories(t: Tables) -> DataFrame:
    """Daily totals per category, trading day by trading day, in two runs; today counts."""
    spec = replace(schema.REGISTRY["stock_szse_summary"], default="1997-12-31", floor=None)
    landed = t.staged(_landed(spec, _per_day(t, "category"), count=F.col("n"), amount=F.col("total")), "landing")
    stored = _runs(t, spec, [(datetime(1999, 1, 5, 9), landed), (datetime(2001, 6, 15, 9), landed)])
    return doubles(stored.select("trade_date", "category", "count", "amount"), "amount")


@query("""SELECT CAST(o_orderdate AS DATE) AS trade_date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS margin_balance FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2001-06-15' GROUP BY 1""")
def maintain_margin_totals(t: Tables) -> DataFrame:
    """Margin totals in two runs, loaded year by year up to today."""
    spec = replace(schema.REGISTRY["stock_margin_sse"], default="1995-12-31")
    totals = t.orders_by_day().groupBy(F.col("o_orderdate").alias("trade_date")).agg(F.sum(money(F.col("o_totalprice"))).alias("margin_balance"))
    landed = t.staged(_landed(spec, totals), "landing")
    stored = _runs(t, spec, [(datetime(1999, 1, 5, 9), landed), (datetime(2001, 6, 15, 9), landed)])
    return doubles(stored.select("trade_date", "margin_balance"), "margin_balance")


@query("""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS name, count(*) AS deals FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-02-01' AND o_orderdate < TIMESTAMP '1999-06-01' GROUP BY 1, 2""")
def maintain_sectors(t: Tables) -> DataFrame:
    """Monthly sector totals. In the first landing March 1998 is missing: the load stops there, although later
    months have landed, and the next one goes on."""
    spec = replace(schema.REGISTRY["stock_szse_sector_summary"], default="1996-01-01", floor=None)
    months = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month"), F.col("o_orderpriority").alias("name"))
    whole = t.staged(_landed(spec, months.agg(F.count(F.lit(1)).alias("deals"))), "landing")
    gap = whole.filter(F.col("month") != "1998-03-01")
    stored = _runs(t, spec, [(datetime(1998, 8, 5, 9), gap), (datetime(1999, 6, 15, 9), whole)])
    return stored.select("month", "name", "deals")


@query(f"""WITH {SQL_CALENDAR} SELECT exchange, trade_date, CASE WHEN trade_date <= DATE '1998-12-31' THEN DATE '1998-06-01' ELSE DATE '1999-06-01' END AS load_date
FROM calendar, (VALUES ('SSE'), ('SZSE')) e(exchange)""")
def maintain_calendar(t: Tables) -> DataFrame:
    """The trading calendar in two loads: each brings all dates that came out since, future ones as well."""
    spec = replace(schema.REGISTRY["stock_trade_date"], default="1900-01-01")
    per_exchange = t.calendar().withColumn("exchange", F.explode(F.array(F.lit("SSE"), F.lit("SZSE"))))
    landed = _landed(spec, per_exchange)
    loads = [(datetime(1998, 6, 1, 9), landed.filter(F.col("trade_date") <= "1998-12-31")), (datetime(1999, 6, 1, 9), landed)]
    return _runs(t, spec, loads).select("exchange", "trade_date", "load_date")
