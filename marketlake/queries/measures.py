"""Market measures derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.numbers import money
from marketlake.operators import aggregates, writes
from marketlake.plans import bars, boards, funds, markets, statements
from marketlake.queries.base import (
    BAR_VALUES,
    OVERLAP,
    SPLIT,
    SQL_BAR_COLUMNS,
    SQL_HOLDINGS,
    SQL_QUARTERS,
    Tables,
    doubles,
    quarter_end,
    query,
    sql_bars,
    sql_doubles,
    sql_quarter_end,
)

day = lambda value: F.lit(value).cast("date")
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
QTY = "CAST(l_quantity AS BIGINT)"
SHIP = "CAST(l_shipdate AS DATE)"


def sql_pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0)"


def sql_if(condition: str, value: str) -> str:
    return f"sum(CASE WHEN {condition} THEN {value} ELSE 0 END)"


def sum_if(condition, value):
    return F.sum(F.when(condition, value).otherwise(0))


# --- bars ------------------------------------------------------------------------------

SQL_CHANGE = f"""changed AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev_close FROM bars),
measured AS (SELECT symbol, trade_date, volume, {sql_doubles(*BAR_VALUES, 'prev_close')},
  CAST(close - prev_close AS DOUBLE) AS change, {sql_pct('(close - prev_close)', 'abs(prev_close)')} AS change_pct,
  {sql_pct('(high - low)', 'prev_close')} AS amplitude_pct FROM changed)"""
CHANGE_DOUBLES = (*BAR_VALUES, "prev_close", "change")


@query(f"""WITH {sql_bars()}, {SQL_CHANGE}
SELECT * FROM measured QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) = 1""")
def bars_latest(t: Tables) -> DataFrame:
    """Incremental load of the bars, then the last bar of each symbol with its change."""
    all_bars = t.daily_bars()
    stored = all_bars.filter(F.col("trade_date") < day(SPLIT))
    incoming = all_bars.filter(F.col("trade_date") >= day(OVERLAP))
    table = writes.insert_if_absent(stored, incoming, ["symbol", "trade_date"], ["close"])
    latest = aggregates.keep_last(bars.with_change(table), ["symbol"], ["trade_date"])
    return doubles(latest, *CHANGE_DOUBLES)


def _sql_rollup(start: str, name: str) -> str:
    return f"""WITH {sql_bars()}
SELECT symbol, CAST(date_trunc('{start}', trade_date) AS DATE) AS {name}, max(trade_date) AS trade_date,
  CAST(arg_min(open, trade_date) AS DOUBLE) AS open, CAST(arg_max(close, trade_date) AS DOUBLE) AS close,
  CAST(max(high) AS DOUBLE) AS high, CAST(min(low) AS DOUBLE) AS low, CAST(sum(volume) AS BIGINT) AS volume,
  CAST(sum(amount) AS DOUBLE) AS amount FROM bars GROUP BY 1, 2"""


@query(_sql_rollup("week", "week_start"))
def bars_weekly(t: Tables) -> DataFrame:
    return doubles(bars.weekly(t.daily_bars()), *BAR_VALUES)


@query(_sql_rollup("month", "month"))
def bars_monthly(t: Tables) -> DataFrame:
    return doubles(bars.monthly(t.daily_bars()), *BAR_VALUES)


@query("""WITH ticks AS (SELECT event_type AS symbol, strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS bar_time,
  ts, event_id, CAST(value AS DECIMAL(18,2)) AS price, CAST(json_extract(props, '$.k') AS BIGINT) AS volume FROM events)
SELECT symbol, bar_time, CAST(arg_min(price, (ts, event_id)) AS DOUBLE) AS open, CAST(arg_max(price, (ts, event_id)) AS DOUBLE) AS close,
  CAST(max(price) AS DOUBLE) AS high, CAST(min(price) AS DOUBLE) AS low, CAST(sum(volume) AS BIGINT) AS volume,
  CAST(sum(price) AS DOUBLE) AS amount FROM ticks GROUP BY 1, 2""")
def bars_30min(t: Tables) -> DataFrame:
    keys = ["symbol", bars.slots(F.col("ts")).alias("bar_time")]
    result = bars.from_trades(ticks(t.events), keys, ["ts", "event_id"], digits=bars.TICK_DIGITS)
    result = result.withColumn("bar_time", F.date_format("bar_time", "yyyy-MM-dd HH:mm:ss"))
    return doubles(result, *BAR_VALUES)


def ticks(events: DataFrame) -> DataFrame:
    price = money(F.col("value"))
    return events.select(
        F.col("event_type").alias("symbol"),
        "ts",
        "event_id",
        price.alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        price.alias("amount"),
    )


@query(f"WITH {sql_bars()}, {SQL_CHANGE} SELECT * FROM measured")
def bars_change(t: Tables) -> DataFrame:
    return doubles(bars.with_change(t.daily_bars()), *CHANGE_DOUBLES)


SQL_SHARES = "shares AS (SELECT s_suppkey AS symbol, CAST(s_suppkey % 50 * 1000 AS BIGINT) AS float_shares FROM supplier)"


@query(f"""WITH {sql_bars()}, {SQL_SHARES} SELECT {SQL_BAR_COLUMNS}, float_shares, {sql_pct('volume', 'float_shares')} AS turnover_pct
FROM bars LEFT JOIN shares USING (symbol)""")
def bars_turnover(t: Tables) -> DataFrame:
    """A symbol without floating shares has no turnover rate."""
    shares = t.supplier.select(
        F.col("s_suppkey").alias("symbol"), (F.col("s_suppkey") % 50 * 1000).alias("float_shares")
    )
    return doubles(bars.with_turnover(t.daily_bars(), shares), *BAR_VALUES)


# --- boards ----------------------------------------------------------------------------

SQL_MEMBERS = f"""{sql_bars('l_partkey')}, changed AS (
  SELECT *, close - lag(close) OVER w AS change, {sql_pct('(close - lag(close) OVER w)', 'abs(lag(close) OVER w)')} AS change_pct
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)),
members AS (SELECT changed.*, p_brand AS board, close * p_size * 1000 AS market_cap, close * p_size * 600 AS float_cap
  FROM changed JOIN part ON symbol = p_partkey)"""


def _stocks(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("symbol"),
        F.col("p_brand").alias("board"),
        (F.col("p_size") * 1000).alias("total_shares"),
        (F.col("p_size") * 600).alias("float_shares"),
    )


def _members(t: Tables) -> DataFrame:
    return boards.with_caps(bars.with_change(t.daily_bars("l_partkey")), _stocks(t))


@query(f"""WITH {SQL_MEMBERS} SELECT symbol, trade_date, CAST(close AS DOUBLE) AS close, CAST(market_cap AS DOUBLE) AS market_cap,
  CAST(float_cap AS DOUBLE) AS float_cap FROM members""")
def valuation_caps(t: Tables) -> DataFrame:
    capped = boards.with_caps(t.daily_bars("l_partkey"), _stocks(t))
    picked = capped.select("symbol", "trade_date", "close", "market_cap", "float_cap")
    return doubles(picked, "close", "market_cap", "float_cap")


@query(f"""WITH {SQL_MEMBERS}, daily AS (SELECT trade_date, board, count(*) FILTER (WHERE change > 0) AS risers,
  count(*) FILTER (WHERE change < 0) AS fallers, sum(market_cap) AS market_cap, sum(change) AS change FROM members GROUP BY 1, 2)
SELECT trade_date, board, risers, fallers, CAST(market_cap AS DOUBLE) AS market_cap, CAST(change AS DOUBLE) AS change,
  CAST(rank() OVER (PARTITION BY trade_date ORDER BY market_cap DESC) AS INTEGER) AS rank FROM daily""")
def board_breadth(t: Tables) -> DataFrame:
    return doubles(boards.breadth(_members(t)), "market_cap", "change")


@query(f"""WITH {SQL_MEMBERS} SELECT trade_date, board, arg_max(symbol, (change_pct, -symbol)) AS leader,
  max(change_pct) AS leader_change_pct FROM members WHERE change_pct IS NOT NULL GROUP BY 1, 2""")
def board_leader(t: Tables) -> DataFrame:
    return boards.leaders(_members(t))


@query(f"""WITH {SQL_MEMBERS} SELECT board, trade_date, {', '.join(f'CAST(sum({c}) AS DOUBLE) AS {c}' for c in BAR_VALUES)},
  CAST(sum(volume) AS BIGINT) AS volume FROM members GROUP BY 1, 2""")
def board_history(t: Tables) -> DataFrame:
    member_bars = boards.members(t.daily_bars("l_partkey"), _stocks(t).select("symbol", "board"))
    return doubles(boards.history(member_bars), *BAR_VALUES)


# --- margin, short sales, custody ------------------------------------------------------

SQL_MARGIN = f"""detail AS (SELECT {SHIP} AS trade_date, l_suppkey AS symbol, sum({PRICE}) AS margin_balance,
  {sql_if("l_returnflag = 'A'", PRICE)} AS margin_buy, CAST({sql_if("l_linestatus = 'O'", QTY)} AS BIGINT) AS short_volume,
  max({PRICE}) AS price FROM lineitem GROUP BY 1, 2)"""


def _margin_detail(t: Tables) -> DataFrame:
    return t.trades().groupBy("trade_date", "symbol").agg(
        F.sum("amount").alias("margin_balance"),
        sum_if(F.col("l_returnflag") == "A", F.col("amount")).alias("margin_buy"),
        sum_if(F.col("l_linestatus") == "O", F.col("volume")).alias("short_volume"),
        F.max("price").alias("price"),
    )


@query(f"""WITH {SQL_MARGIN} SELECT trade_date, CAST(sum(margin_balance) AS DOUBLE) AS margin_balance,
  CAST(sum(margin_buy) AS DOUBLE) AS margin_buy, CAST(sum(short_volume) AS BIGINT) AS short_volume FROM detail GROUP BY 1""")
def margin_totals(t: Tables) -> DataFrame:
    totals = markets.margin_totals(_margin_detail(t), ["margin_balance", "margin_buy", "short_volume"])
    return doubles(totals, "margin_balance", "margin_buy")


@query(f"""WITH {SQL_MARGIN} SELECT trade_date, symbol, CAST(margin_balance AS DOUBLE) AS margin_balance, short_volume,
  CAST(short_volume * price AS DOUBLE) AS short_balance, CAST(margin_balance + short_volume * price AS DOUBLE) AS total_balance FROM detail""")
def margin_balance(t: Tables) -> DataFrame:
    full = markets.with_total_balance(_margin_detail(t)).drop("margin_buy", "price")
    return doubles(full, "margin_balance", "short_balance", "total_balance")


@query(f"""WITH s AS (SELECT l_suppkey AS symbol, {SHIP} AS trade_date, CAST({sql_if("l_returnflag = 'R'", QTY)} AS BIGINT) AS short_shares,
  {sql_if("l_returnflag = 'R'", PRICE)} AS short_amount, sum({PRICE}) AS amount FROM lineitem GROUP BY 1, 2)
SELECT symbol, trade_date, short_shares, CAST(amount AS DOUBLE) AS amount,
  CAST(short_amount AS DOUBLE) / nullif(CAST(short_shares AS DOUBLE), 0) AS short_avg_price,
  {sql_pct('short_amount', 'amount')} AS short_pct FROM s""")
def short_ratio(t: Tables) -> DataFrame:
    result = markets.short_share(t.trades(), ["symbol", "trade_date"], F.col("l_returnflag") == "R")
    return doubles(result.drop("short_amount"), "amount")


@query(f"""WITH p AS (SELECT l_suppkey AS symbol, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_linestatus AS holder_type,
  l_partkey, sum({QTY}) AS holding FROM lineitem GROUP BY 1, 2, 3, 4),
h AS (SELECT symbol, month, holder_type, CAST(sum(holding) AS BIGINT) AS holding, count(*) AS participants FROM p GROUP BY 1, 2, 3)
SELECT *, {sql_pct('holding', 'sum(holding) OVER (PARTITION BY symbol, month)')} AS pct FROM h""")
def custody_summary(t: Tables) -> DataFrame:
    detail = t.trades().select(
        "symbol",
        F.trunc("trade_date", "month").alias("month"),
        F.col("l_linestatus").alias("holder_type"),
        F.col("l_partkey").alias("participant_id"),
        F.col("volume").alias("holding"),
    )
    return markets.custody_summary(detail, ["symbol", "month"])


# --- statements ------------------------------------------------------------------------


def _sql_growth(name: str, back: str) -> str:
    return f"""CAST({back}.{name} AS DOUBLE) AS {name}_{back}_base,
  {sql_pct(f'(c.{name} - {back}.{name})', f'abs({back}.{name})')} AS {name}_{back}"""


SQL_BACK = """LEFT JOIN {table} qoq ON qoq.symbol = c.symbol AND qoq.report_date = last_day(CAST(c.report_date - INTERVAL 3 MONTH AS DATE))
LEFT JOIN {table} yoy ON yoy.symbol = c.symbol AND yoy.report_date = last_day(CAST(c.report_date - INTERVAL 12 MONTH AS DATE))"""


@query(f"""WITH {SQL_QUARTERS} SELECT c.symbol, c.report_date, c.n_orders, CAST(c.revenue AS DOUBLE) AS revenue,
  {_sql_growth('revenue', 'qoq')}, {_sql_growth('revenue', 'yoy')} FROM company_quarters c {SQL_BACK.format(table='company_quarters')}""")
def growth_yoy_qoq(t: Tables) -> DataFrame:
    grown = statements.growth(t.company_quarters(), "symbol", "report_date", ["revenue"])
    return doubles(grown, "revenue", "revenue_qoq_base", "revenue_yoy_base")


TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"


@query(f"""WITH b AS (SELECT o_custkey AS symbol, {sql_quarter_end('o_orderdate')} AS report_date, sum({TOTAL}) AS total_assets,
  {sql_if("o_orderstatus = 'F'", TOTAL)} AS total_liabilities FROM orders GROUP BY 1, 2)
SELECT symbol, report_date, {sql_doubles('total_assets', 'total_liabilities')}, CAST(total_assets - total_liabilities AS DOUBLE) AS equity,
  {sql_pct('total_liabilities', 'total_assets')} AS debt_ratio FROM b""")
def balance_ratios(t: Tables) -> DataFrame:
    total = money(F.col("o_totalprice"))
    sheet = t.orders.groupBy(
        F.col("o_custkey").alias("symbol"), quarter_end("o_orderdate").alias("report_date")
    ).agg(
        F.sum(total).alias("total_assets"),
        sum_if(F.col("o_orderstatus") == "F", total).alias("total_liabilities"),
    )
    return doubles(statements.balance_ratios(sheet), "total_assets", "total_liabilities", "equity")


SQL_FLOWS = f"""f AS (SELECT l_suppkey AS symbol, {sql_quarter_end('l_shipdate')} AS report_date,
  {sql_if("l_returnflag = 'A'", PRICE)} AS operating_cf, -{sql_if("l_returnflag = 'N'", PRICE)} AS investing_cf,
  {sql_if("l_returnflag = 'R'", PRICE)} AS financing_cf FROM lineitem GROUP BY 1, 2)"""
FLOWS = ["operating_cf", "investing_cf", "financing_cf"]


@query(f"""WITH {SQL_FLOWS}, n AS (SELECT *, operating_cf + investing_cf + financing_cf AS net_cash_flow FROM f)
SELECT symbol, report_date, {sql_doubles(*FLOWS, 'net_cash_flow')},
  {', '.join(f"{sql_pct(c, 'net_cash_flow')} AS {c}_share" for c in FLOWS)} FROM n""")
def cashflow_mix(t: Tables) -> DataFrame:
    flag, price = F.col("l_returnflag"), money(F.col("l_extendedprice"))
    flows = t.lineitem.groupBy(
        F.col("l_suppkey").alias("symbol"), quarter_end("l_shipdate").alias("report_date")
    ).agg(
        sum_if(flag == "A", price).alias("operating_cf"),
        (-sum_if(flag == "N", price)).alias("investing_cf"),
        sum_if(flag == "R", price).alias("financing_cf"),
    )
    return doubles(statements.cashflow_mix(flows, FLOWS), *FLOWS, "net_cash_flow")


RATE = "CAST({} AS DECIMAL(4,2))"
COSTS = {"operating_cost": "l_discount", "selling_expense": "l_tax"}
SQL_INCOME = f"""i AS (SELECT l_suppkey AS symbol, {sql_quarter_end('l_shipdate')} AS report_date, sum({PRICE}) AS revenue,
  {', '.join(f'sum({PRICE} * {RATE.format(c)}) AS {name}' for name, c in COSTS.items())} FROM lineitem GROUP BY 1, 2)"""


def _income(t: Tables) -> DataFrame:
    price = money(F.col("l_extendedprice"))
    return t.lineitem.groupBy(
        F.col("l_suppkey").alias("symbol"), quarter_end("l_shipdate").alias("report_date")
    ).agg(
        F.sum(price).alias("revenue"),
        *[F.sum(price * F.col(c).cast("decimal(4,2)")).alias(name) for name, c in COSTS.items()],
    )


@query(f"""WITH {SQL_INCOME} SELECT symbol, report_date, {sql_doubles('revenue', *COSTS)},
  CAST(operating_cost + selling_expense AS DOUBLE) AS total_expense,
  CAST(revenue - (operating_cost + selling_expense) AS DOUBLE) AS operating_profit FROM i""")
def income_totals(t: Tables) -> DataFrame:
    totals = statements.income_totals(_income(t), list(COSTS))
    return doubles(totals, "revenue", *COSTS, "total_expense", "operating_profit")


@query(f"""WITH {SQL_INCOME}, c0 AS (SELECT symbol, report_date, revenue - operating_cost AS forecast_value FROM i)
SELECT c.symbol, c.report_date, CAST(c.forecast_value AS DOUBLE) AS forecast_value, CAST(yoy.forecast_value AS DOUBLE) AS prev_year_value,
  {sql_pct('(c.forecast_value - yoy.forecast_value)', 'abs(yoy.forecast_value)')} AS forecast_change_pct
FROM c0 c LEFT JOIN c0 yoy ON yoy.symbol = c.symbol AND yoy.report_date = last_day(CAST(c.report_date - INTERVAL 12 MONTH AS DATE))""")
def forecast_change(t: Tables) -> DataFrame:
    forecast = _income(t).select(
        "symbol", "report_date", (F.col("revenue") - F.col("operating_cost")).alias("forecast_value")
    )
    grown = statements.growth(forecast, "symbol", "report_date", ["forecast_value"])
    picked = grown.select(
        "symbol",
        "report_date",
        "forecast_value",
        F.col("forecast_value_yoy_base").alias("prev_year_value"),
        F.col("forecast_value_yoy").alias("forecast_change_pct"),
    )
    return doubles(picked, "forecast_value", "prev_year_value")


@query(f"""WITH s AS (SELECT l_orderkey, {', '.join(f'min({SHIP}) FILTER (WHERE l_linenumber = {i}) AS changed_date_{i}' for i in (1, 2, 3))},
  max({SHIP}) AS actual_date FROM lineitem GROUP BY 1),
d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS planned_date, s.*,
  coalesce(changed_date_3, changed_date_2, changed_date_1, CAST(o_orderdate AS DATE)) AS effective_date FROM orders JOIN s ON o_orderkey = l_orderkey)
SELECT o_orderkey, planned_date, effective_date, actual_date, CAST(actual_date - effective_date AS INTEGER) AS delay_days FROM d""")
def disclosure_delay(t: Tables) -> DataFrame:
    shipped = F.to_date("l_shipdate")
    changes = [f"changed_date_{i}" for i in (1, 2, 3)]
    schedule = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.min(F.when(F.col("l_linenumber") == i, shipped)).alias(c) for i, c in enumerate(changes, 1)],
        F.max(shipped).alias("actual_date"),
    )
    planned = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("planned_date"))
    delayed = statements.disclosure_delay(planned.join(schedule, "o_orderkey"), "planned_date", changes, "actual_date")
    return delayed.drop(*changes)


# --- market totals ---------------------------------------------------------------------


def _sql_ranked(group: str, source: str) -> str:
    return f"""WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {group}, sum({PRICE}) AS amount
  FROM {source} GROUP BY 1, 2)
SELECT month, {group.split(' AS ')[1]}, CAST(amount AS DOUBLE) AS amount, {sql_pct('amount', 'sum(amount) OVER (PARTITION BY month)')} AS pct,
  CAST(rank() OVER (PARTITION BY month ORDER BY amount DESC) AS INTEGER) AS rank FROM m"""


def _monthly(t: Tables, key: str) -> DataFrame:
    """Amounts per month and key, reduced before any join."""
    month = F.trunc(F.to_date("l_shipdate"), "month").alias("month")
    return t.lineitem.groupBy(month, key).agg(F.sum(money(F.col("l_extendedprice"))).alias("amount"))


@query(_sql_ranked("p_type AS sector", "lineitem JOIN part ON l_partkey = p_partkey"))
def sector_share(t: Tables) -> DataFrame:
    sectors = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("sector"))
    return doubles(markets.ranked_share(_monthly(t, "l_partkey").join(sectors, "l_partkey"), "month", "sector", "amount"), "amount")


@query(_sql_ranked("n_name AS area", "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"))
def area_rank(t: Tables) -> DataFrame:
    areas = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("area")
    )
    return doubles(markets.ranked_share(_monthly(t, "l_suppkey").join(areas, "l_suppkey"), "month", "area", "amount"), "amount")


@query(f"""SELECT {SHIP} AS trade_date, l_returnflag AS category, count(*) AS count, CAST(sum({PRICE}) AS DOUBLE) AS amount,
  CAST(sum({QTY}) AS BIGINT) AS volume FROM lineitem GROUP BY 1, 2""")
def category_summary(t: Tables) -> DataFrame:
    rows = t.trades().withColumnRenamed("l_returnflag", "category")
    return doubles(markets.category_totals(rows, ["trade_date", "category"], "count", ["amount", "volume"]), "amount")


@query(f"""SELECT {SHIP} AS trade_date, l_linestatus AS board, count(DISTINCT l_partkey) AS listed_count, CAST(sum({QTY}) AS BIGINT) AS volume,
  CAST(sum({PRICE}) AS DOUBLE) AS amount, CAST(sum({PRICE} * {RATE.format('l_tax')}) AS DOUBLE) AS earnings,
  CAST(sum({PRICE}) AS DOUBLE) / nullif(CAST(sum({PRICE} * {RATE.format('l_tax')}) AS DOUBLE), 0) AS avg_pe FROM lineitem GROUP BY 1, 2""")
def board_daily_summary(t: Tables) -> DataFrame:
    price = money(F.col("l_extendedprice"))
    rows = t.lineitem.select(
        F.to_date("l_shipdate").alias("trade_date"),
        F.col("l_linestatus").alias("board"),
        F.col("l_partkey").alias("symbol"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        price.alias("amount"),
        (price * F.col("l_tax").cast("decimal(4,2)")).alias("earnings"),
    )
    return doubles(markets.board_day(rows, ["trade_date", "board"]), "amount", "earnings")


# --- funds -----------------------------------------------------------------------------


@query(f"""WITH {SQL_HOLDINGS}, t AS (SELECT fund_code, report_date, sum(holding_value) AS total_value FROM holdings GROUP BY 1, 2)
SELECT fund_code, report_date, symbol, shares, {sql_doubles('holding_value', 'total_value')}, {sql_pct('holding_value', 'total_value')} AS nav_pct
FROM holdings JOIN t USING (fund_code, report_date)""")
def fund_weights(t: Tables) -> DataFrame:
    totals = t.lineitem.groupBy(
        F.col("l_suppkey").alias("fund_code"), quarter_end("l_shipdate").alias("report_date")
    ).agg(F.sum(money(F.col("l_extendedprice"))).alias("total_value"))
    weighted = funds.weights(t.holdings(), ["fund_code", "report_date"], totals=totals)
    return doubles(weighted, "holding_value", "total_value")


@query(f"""WITH {SQL_HOLDINGS}, r AS (SELECT fund_code, symbol, report_date, shares, CAST(holding_value AS DOUBLE) AS holding_value,
  CAST(row_number() OVER (PARTITION BY fund_code, report_date ORDER BY holdings.holding_value DESC, symbol) AS INTEGER) AS rank FROM holdings)
SELECT * FROM r WHERE rank <= 3""")
def fund_top_holdings(t: Tables) -> DataFrame:
    return doubles(funds.top_holdings(t.holdings(), ["fund_code", "report_date"], 3), "holding_value")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice AS price, p_retailprice * l_quantity AS iopv,
  (l_extendedprice - p_retailprice * l_quantity) * 100.0 / nullif(p_retailprice * l_quantity, 0) AS discount_pct
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def etf_discount(t: Tables) -> DataFrame:
    quotes = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        (F.col("p_retailprice") * F.col("l_quantity")).alias("iopv"),
    )
    return funds.with_discount(quotes, "price", "iopv")


SIGNED = f"(CASE l_returnflag WHEN 'A' THEN {PRICE} WHEN 'R' THEN -{PRICE} ELSE 0 END)"
SQL_BUCKETS = {"s": "l_quantity < 10", "m": "l_quantity >= 10 AND l_quantity < 25", "l": "l_quantity >= 25 AND l_quantity < 40", "xl": "l_quantity >= 40"}


@query(f"""SELECT l_suppkey AS symbol, {SHIP} AS trade_date,
  {', '.join(f'CAST({sql_if(c, SIGNED)} AS DOUBLE) AS {n}_inflow' for n, c in SQL_BUCKETS.items())},
  CAST(sum({SIGNED}) AS DOUBLE) AS net_inflow FROM lineitem GROUP BY 1, 2""")
def flow_buckets(t: Tables) -> DataFrame:
    trades, size = t.trades(), F.col("volume")
    sign = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", -1).otherwise(0)
    buckets = {"s": size < 10, "m": (size >= 10) & (size < 25), "l": (size >= 25) & (size < 40), "xl": size >= 40}
    flows = funds.bucket_flows(trades, ["symbol", "trade_date"], buckets, F.col("amount") * sign)
    return doubles(flows, *[f"{b}_inflow" for b in buckets], "net_inflow")
