"""Loads that write files: streams, paired tables, dataset runs, and the data dictionary.

Each writes under a fresh folder of ``spark.checkpoint.dir`` and returns what it reads back.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import schema
from marketlake.functions import text
from marketlake.operators import aggregates, checks, dictionary
from marketlake.plans import bars, markets, runner
from marketlake.queries.base import (
    BAR_VALUES,
    SPLIT,
    SQL_CALENDAR,
    SQL_HOLDINGS,
    SQL_QUARTERS,
    Tables,
    doubles,
    query,
    sql_bars,
    sql_doubles,
)
from marketlake.queries.measures import ticks
from marketlake.queries.shaping import PRIORITIES
from marketlake.session import scratch_dir
from marketlake.sources import landing
from marketlake.sources.tables import Lake, LakeTable, publish_pair
from marketlake.streaming import loads

day = lambda value: F.lit(value).cast("date")


def _lake(t: Tables, label: str) -> Lake:
    return Lake(t.spark, scratch_dir(t.spark, label))


# --- writes with a count ---------------------------------------------------------------


@query(f"""SELECT 'stored' AS batch, count(*) AS n_rows FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}'
UNION ALL SELECT 'incoming', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT}'""")
def metric_rows_written(t: Tables) -> DataFrame:
    """Rows per batch, counted by the writes themselves."""
    lake, orders = _lake(t, "metric"), t.orders_by_day().select("o_orderkey", "o_custkey", "o_orderdate")
    table = LakeTable(lake, "orders", orders.schema)
    split = F.lit(SPLIT).cast("date")
    rows = []
    for batch, part in (("stored", F.col("o_orderdate") < split), ("incoming", F.col("o_orderdate") >= split)):
        counted, metric = aggregates.count_rows(orders.filter(part), batch)
        table.write_batch(counted, batch)
        rows.append((batch, metric.get["rows"]))
    return t.spark.createDataFrame(rows, "batch string, n_rows bigint")


SQL_CUSTODY = """p AS (SELECT l_suppkey AS symbol, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_linestatus AS holder_type,
  l_partkey AS participant_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS holding FROM lineitem GROUP BY 1, 2, 3, 4)"""


@query(f"""WITH {SQL_CUSTODY}
SELECT 'detail' AS kind, symbol, month, holder_type, participant_id AS n, holding FROM p
UNION ALL SELECT 'summary', symbol, month, holder_type, count(*), CAST(sum(holding) AS BIGINT) FROM p GROUP BY 2, 3, 4""")
def write_two_tables(t: Tables) -> DataFrame:
    """Custody detail and its summary appear together; a pair with an empty side is not written."""
    lake = _lake(t, "pair")
    detail = (
        t.trades()
        .groupBy(
            "symbol",
            F.trunc("trade_date", "month").alias("month"),
            F.col("l_linestatus").alias("holder_type"),
            F.col("l_partkey").alias("participant_id"),
        )
        .agg(F.sum("volume").alias("holding"))
    )
    detail_table = LakeTable(lake, "detail", detail.schema)
    detail = detail_table.stage(detail, "input")
    summary = markets.custody_summary(detail, ["symbol", "month"]).drop("pct")
    summary_table = LakeTable(lake, "summary", summary.schema)
    publish_pair("b1", (summary_table, summary), (detail_table, detail))
    publish_pair("b2", (summary_table, summary), (detail_table, detail.filter("holding < 0")))
    columns = ["symbol", "month", "holder_type"]
    read_detail = detail_table.read_batches().select(
        F.lit("detail").alias("kind"), *columns, F.col("participant_id").alias("n"), "holding"
    )
    return read_detail.unionByName(
        summary_table.read_batches().select(
            F.lit("summary").alias("kind"), *columns, F.col("participants").alias("n"), "holding"
        )
    )


# --- streams ---------------------------------------------------------------------------

SQL_TICKS = """ticks AS (SELECT event_type AS symbol, time_bucket(INTERVAL 30 MINUTE, ts) AS slot, ts, event_id,
  CAST(value AS DECIMAL(18,2)) AS price, CAST(json_extract(props, '$.k') AS BIGINT) AS volume FROM events)"""


@query(f"""WITH {SQL_TICKS}
SELECT symbol, strftime(slot, '%Y-%m-%d %H:%M:%S') AS bar_time, CAST(arg_min(price, (ts, event_id)) AS DOUBLE) AS open,
  CAST(arg_max(price, (ts, event_id)) AS DOUBLE) AS close, CAST(max(price) AS DOUBLE) AS high, CAST(min(price) AS DOUBLE) AS low,
  CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(price) AS DOUBLE) AS amount FROM ticks GROUP BY symbol, slot
HAVING slot + INTERVAL 30 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)""")
def stream_bars(t: Tables) -> DataFrame:
    """Bars whose window the watermark has passed; the last open windows are still in the state."""
    root = scratch_dir(t.spark, "bars")
    stream = loads.file_stream(t.spark, t.path("events"), t.events.schema)
    loads.write_available(loads.bars_30min(ticks(stream)), f"{root}/out", f"{root}/checkpoint")
    result = t.spark.read.parquet(f"{root}/out")
    result = result.withColumn("bar_time", F.date_format("bar_time", "yyyy-MM-dd HH:mm:ss"))
    return doubles(result, *BAR_VALUES)


SQL_EVENTS = "SELECT event_id, event_type, value FROM events"


@query(SQL_EVENTS)
def stream_dedup(t: Tables) -> DataFrame:
    """Every event is delivered twice and kept once."""
    root = scratch_dir(t.spark, "dedup")
    stream = loads.file_stream(t.spark, t.path("events"), t.events.schema)
    twice = stream.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    once = loads.distinct_within(twice, ["event_id"], "ts", "1 hour")
    loads.write_available(once.select("event_id", "event_type", "value"), f"{root}/out", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/out")


def _events_table(lake: Lake, t: Tables) -> LakeTable:
    return LakeTable(lake, "events", t.events.select("event_id", "event_type", "value").schema)


@query(SQL_EVENTS)
def stream_incremental(t: Tables) -> DataFrame:
    """Insert-if-absent of a file stream; a second run finds nothing new."""
    lake = _lake(t, "incremental")
    table = _events_table(lake, t)
    for _ in range(2):
        stream = loads.file_stream(t.spark, t.path("events"), t.events.schema)
        loads.load_available(stream, table, f"{lake.root}/checkpoint", ["event_id"], ["ts"])
    return table.read_batches()


@query(SQL_EVENTS)
def stream_resume(t: Tables) -> DataFrame:
    """The first half of the month lands and is loaded, then all of it lands again: the second run
    picks up the new files only, and drops what they re-deliver."""
    lake = _lake(t, "resume")
    table, folder = _events_table(lake, t), f"{lake.root}/landing"
    first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for delivery in (t.events.filter(first_half), t.events):
        delivery.write.mode("append").parquet(folder)
        stream = loads.file_stream(t.spark, folder, t.events.schema)
        loads.load_available(stream, table, f"{lake.root}/checkpoint", ["event_id"], ["ts"])
    return table.read_batches()


@query(f"""WITH {sql_bars()} SELECT CAST(symbol AS VARCHAR) AS symbol, trade_date, volume,
  CAST(CASE WHEN symbol % 7 = 0 THEN close * 2 ELSE close END AS DOUBLE) AS close, {sql_doubles('open', 'high', 'low', 'amount')} FROM bars""")
def stream_revisions(t: Tables) -> DataFrame:
    """Forward-adjusted bars from a stream. The second delivery brings each symbol's last bar again and
    newer ones, with every seventh symbol recalculated; in the end all deliveries come once more."""
    lake, spec = _lake(t, "stream-revisions"), schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    table = runner.Context(lake, t.calendar(), datetime(2001, 6, 15, 17)).table(spec)
    given = {c: F.col(c).cast(spec.schema[c].dataType) for c in ("symbol", "trade_date", "volume", *BAR_VALUES)}
    columns = [given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in spec.schema]
    daily = t.staged(t.daily_bars().select(*columns), "bars")
    revised = daily.withColumn("close", (F.col("close") * F.when(F.col("symbol").cast("int") % 7 == 0, 2).otherwise(1)).cast("decimal(10,2)"))
    old = daily.filter(F.col("trade_date") < SPLIT)
    # written, as its size then tells that it may be sent to the bars
    last = t.staged(old.groupBy("symbol").agg(F.max("trade_date").alias("last_date")), "marks")
    newer = revised.join(last, "symbol", "left").filter("last_date IS NULL OR trade_date >= last_date").drop("last_date")
    folder = f"{lake.root}/landing"
    for delivery, checkpoint in ((old, "one"), (newer, "one"), (None, "two")):
        if delivery is not None:
            delivery.write.mode("append").parquet(folder)
        context = runner.Context(lake, t.calendar(), datetime(2001, 6, 15, 17))
        stream = loads.file_stream(t.spark, folder, table.schema)
        loads.load_revised(stream, context, spec, f"{lake.root}/checkpoint-{checkpoint}", revised)
    stored = runner.stored_rows(context, spec).select("symbol", "trade_date", "volume", *BAR_VALUES)
    return doubles(stored, *BAR_VALUES)


@query("""WITH d AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS trade_date, CAST(l_partkey AS VARCHAR) AS participant_id,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS holding FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_shipdate < TIMESTAMP '1999-04-01'
  GROUP BY 1, 2, 3), whole AS (SELECT * FROM d WHERE NOT (CAST(symbol AS BIGINT) % 5 = 0 AND trade_date < DATE '1999-02-01'))
SELECT 'detail' AS kind, symbol, trade_date, participant_id AS label, holding FROM whole
UNION ALL SELECT 'summary', symbol, trade_date, CAST(count(*) AS VARCHAR), CAST(sum(holding) AS BIGINT) FROM whole GROUP BY 2, 3""")
def stream_pair(t: Tables) -> DataFrame:
    """Custody detail and summary from two streams, stored unit by unit once both sides have landed. The
    summary of a quarter lands first, the detail month by month, and all of it once more in the end; every
    fifth symbol's January detail never comes."""
    lake = _lake(t, "stream-pair")
    quarter = t.trades().filter(F.col("trade_date").between("1999-01-01", "1999-03-31"))
    code, part = F.col("symbol").cast("string"), F.col("l_partkey").cast("string")
    detail = quarter.groupBy(code.alias("symbol"), "trade_date", part.alias("participant_id")).agg(F.sum("volume").alias("holding"))
    detail = t.staged(detail, "detail")
    summary = detail.groupBy("symbol", "trade_date").agg(F.count(F.lit(1)).cast("string").alias("participants"), F.sum("holding").alias("holding"))
    tables = [(LakeTable(lake, n, df.schema), f"{lake.root}/landing-{n}") for n, df in (("summary", summary), ("detail", detail))]
    came = detail.filter((F.col("symbol").cast("int") % 5 > 0) | (F.col("trade_date") >= "1999-02-01"))
    summary.write.parquet(tables[0][1])
    for month, checkpoint in ((1, "one"), (2, "one"), (3, "one"), (None, "two")):
        if month is not None:
            came.filter(F.month("trade_date") == month).write.mode("append").parquet(tables[1][1])
        loads.load_pair(t.spark, *tables, "symbol", "trade_date", f"{lake.root}/checkpoint-{checkpoint}", delay="120 days")
    out = [table.read_batches() for table, _ in tables]
    labelled = lambda kind, df, label: df.select(F.lit(kind).alias("kind"), "symbol", "trade_date", F.col(label).alias("label"), "holding")
    return labelled("summary", out[0], "participants").unionByName(labelled("detail", out[1], "participant_id"))


# --- dataset runs ----------------------------------------------------------------------


def _landed(spec: schema.DatasetSpec, df: DataFrame, **values: Column) -> DataFrame:
    """Landed rows of a dataset: given values, columns of the same name, else nulls."""
    source = {c: F.col(c) for c in df.columns} | values
    nothing = F.lit(None).cast("string")
    columns = [source.get(c, nothing).alias(c) for c in spec.landed_columns]
    return df.select(*columns, F.lit("b").alias("_batch"), F.lit(0).alias("_pos"))


SQL_DUE = "trade_date IN (SELECT trade_date FROM calendar) AND trade_date > DATE '1995-01-01' AND trade_date <= DATE '2001-06-14'"


@query(f"""WITH {SQL_CALENDAR}, d AS (SELECT CAST(l_shipdate AS DATE) AS trade_date, CAST(l_suppkey AS VARCHAR) AS symbol,
  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS margin_balance FROM lineitem GROUP BY 1, 2)
SELECT trade_date, symbol, CAST(margin_balance AS DOUBLE) AS margin_balance FROM d WHERE {SQL_DUE}""")
def maintain_margin(t: Tables) -> DataFrame:
    """Three runs of the margin detail, trading day by trading day; the last finds nothing new. The
    landing has a folder per year, and each run reads the planned ones."""
    lake = _lake(t, "margin")
    spec = replace(schema.REGISTRY["stock_margin_detail_sse"], default="1995-01-01")
    detail = t.trades().groupBy("trade_date", "symbol").agg(F.sum("amount").alias("margin_balance"))
    path = scratch_dir(t.spark, "landing")
    landing.land(_landed(spec, detail, symbol=F.col("symbol").cast("string")).drop(*landing.ARRIVAL), path, spec.date, "year")
    landed = landing.read_landing(t.spark, path)
    for now in (datetime(1999, 1, 5, 9), datetime(2001, 6, 15, 17), datetime(2001, 6, 15, 18)):
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, landed)
    return doubles(runner.stored_rows(context, spec).select("trade_date", "symbol", "margin_balance"), "margin_balance")


@query(f"""WITH {SQL_HOLDINGS}, h AS (SELECT * FROM holdings WHERE report_date <= DATE '2001-06-15')
SELECT 'holding' AS kind, CAST(fund_code AS VARCHAR) AS fund_code, CAST(symbol AS VARCHAR) AS symbol, report_date,
  CAST(holding_value + CASE WHEN year(report_date) >= 1999 THEN 1 ELSE 0 END AS DOUBLE) AS holding_value
FROM h WHERE fund_code % 3 > 0 AND year(report_date) BETWEEN 1996 AND 2001
UNION ALL SELECT 'fund', CAST(s_suppkey AS VARCHAR), NULL, CASE WHEN s_suppkey % 3 > 0 THEN coalesce(last, DATE '2000-12-31') END, NULL
FROM supplier LEFT JOIN (SELECT fund_code, max(report_date) AS last FROM h WHERE year(report_date) = 2001 GROUP BY 1) ON fund_code = s_suppkey""")
def maintain_funds(t: Tables) -> DataFrame:
    """The fund master and two runs of the holdings, planned from the date that the master keeps per
    fund. The second starts after 1998 and replaces the years since then, in which every value was corrected.
    Every third fund is not followed, and keeps no date."""
    lake = _lake(t, "funds")
    master = schema.REGISTRY["fund_name_em"]
    spec = replace(schema.REGISTRY["fund_portfolio_hold_em"], default="1995-12-31")
    holdings = t.staged(t.holdings(), "landing")
    code = F.col("fund_code").cast("string")
    funds = t.supplier.select(F.col("s_suppkey").cast("string").alias("fund_code"), F.lit("x").alias("fund_type"))
    followed = t.supplier.filter("s_suppkey % 3 > 0").select(F.col("s_suppkey").cast("string").alias("fund_code"))
    runner.run(runner.Context(lake, t.calendar(), datetime(1999, 2, 9, 9)), master, _landed(master, funds))
    for now, correction in ((datetime(1999, 2, 10, 9), 0), (datetime(2001, 6, 15, 9), 1)):
        landed = _landed(
            spec, holdings.filter(F.col("report_date") <= F.lit(now).cast("date")), fund_code=code,
            symbol=F.col("symbol").cast("string"), holding_value=F.col("holding_value") + correction,
        )
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, landed, followed)
    table = runner.stored_rows(context, spec).select(F.lit("holding").alias("kind"), "fund_code", "symbol", "report_date", "holding_value")
    dates_ = runner.stored_rows(context, master).select(
        F.lit("fund").alias("kind"), "fund_code", F.col("latest_holding_date").alias("report_date")
    )
    return doubles(table.unionByName(dates_, allowMissingColumns=True), "holding_value")


@query(f"""WITH {SQL_CALENDAR}, o AS (SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderpriority AS item, CAST(count(*) AS INTEGER) AS listed_count,
  CAST(count(*) * 1000.25 AS DECIMAL(12,2)) AS market_cap FROM orders GROUP BY 1, 2)
SELECT trade_date, item, listed_count, CAST(market_cap AS DOUBLE) AS market_cap FROM o
WHERE trade_date BETWEEN DATE '1998-01-01' AND (SELECT max(trade_date) FROM calendar WHERE trade_date < DATE '1998-06-15')""")
def maintain_sse_overview(t: Tables) -> DataFrame:
    """Two runs of the exchange overview, whose daily reports land as metric rows and item columns."""
    lake, spec = _lake(t, "overview"), replace(schema.REGISTRY["stock_sse_summary"], default="1997-12-31")
    daily = t.orders_by_day().groupBy("o_orderdate").pivot("o_orderpriority", list(PRIORITIES)).count()
    day_text = F.date_format("o_orderdate", "yyyyMMdd")

    def row(label: str, value) -> Column:
        cells = [F.when(F.col(p).isNotNull(), value(F.col(p))).cast("string").alias(p) for p in PRIORITIES]
        return F.struct(F.lit(label).alias("item"), *cells)

    rows = [
        row("报告时间", lambda n: day_text), row("上市股票", lambda n: n), row("总市值", lambda n: n * F.lit(1000.25)), row("注", lambda n: F.lit("note")),
    ]
    reports = daily.select(F.date_format("o_orderdate", "yyyyMMdd").alias("_batch"), F.inline(F.array(*rows)))
    landed = t.staged(reports.withColumn("_pos", F.lit(0)), "landing")
    for now in (datetime(1998, 3, 2, 9), datetime(1998, 6, 15, 9)):
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, _complete(spec, runner.from_reports(spec, landed)))
    return doubles(runner.stored_rows(context, spec).select("trade_date", "item", "listed_count", "market_cap"), "market_cap")


def _complete(spec: schema.DatasetSpec, df: DataFrame) -> DataFrame:
    """Columns that the landing lacks are null."""
    return df.withColumns({c: F.lit(None).cast("string") for c in spec.landed_columns if c not in df.columns})


@query("""WITH c AS (SELECT max(CAST(ts AS DATE)) AS last FROM events WHERE isodow(ts) < 6),
b AS (SELECT event_type AS symbol, time_bucket(INTERVAL 30 MINUTE, ts) AS slot, max(CAST(value AS DECIMAL(10,2))) AS high FROM events GROUP BY 1, 2)
SELECT symbol, strftime(slot, '%Y-%m-%d %H:%M:%S') AS bar_time, CAST(high AS DOUBLE) AS high FROM b, c
WHERE slot <= last + INTERVAL 15 HOUR""")
def maintain_intraday(t: Tables) -> DataFrame:
    """Two runs of the 30-minute bars. The second landing starts after the overlap bar, which counts
    as unchanged at this frequency."""
    lake, spec = _lake(t, "intraday"), schema.REGISTRY["stock_zh_a_hist_30min_qfq"]
    slots = ticks(t.events).groupBy("symbol", bars.slots(F.col("ts")).alias("bar_time"))
    landed_bars = t.staged(_landed(spec, slots.agg(F.max("price").alias("high"))), "landing")
    days = t.events.select(F.to_date("ts").alias("trade_date")).distinct().filter("weekday(trade_date) < 5")
    symbols = landed_bars.select("symbol").distinct()
    later = landed_bars.filter(F.col("bar_time") > F.lit("2024-01-15 15:00:00").cast("timestamp_ntz"))
    for now, landed in ((datetime(2024, 1, 15, 17), landed_bars), (datetime(2024, 2, 1, 17), later)):
        context = runner.Context(lake, days, now)
        runner.run(context, spec, landed, symbols)
    table = runner.stored_rows(context, spec).select("symbol", "bar_time", "high")
    table = table.withColumn("bar_time", F.substring(F.col("bar_time").cast("string"), 1, 19))
    return doubles(table, "high")


SQL_CUSTODY_DAYS = """d AS (SELECT CAST(l_shipdate AS DATE) AS trade_date, CAST(l_suppkey AS VARCHAR) AS symbol, l_linestatus AS holder_type,
  CAST(l_partkey AS VARCHAR) AS participant_id, sum(CAST(l_quantity AS BIGINT)) AS holding FROM lineitem
  WHERE isodow(l_shipdate) < 6 AND l_shipdate BETWEEN TIMESTAMP '1998-06-15' AND TIMESTAMP '2000-03-14' GROUP BY 1, 2, 3, 4)"""


@query(f"""WITH {SQL_CUSTODY_DAYS}
SELECT 'detail' AS kind, trade_date, symbol, participant_id AS label, CAST(sum(holding) AS BIGINT) AS holding FROM d GROUP BY 2, 3, 4
UNION ALL SELECT 'summary', trade_date, symbol, holder_type, CAST(sum(holding) AS BIGINT) FROM d GROUP BY 2, 3, 4""")
def maintain_custody(t: Tables) -> DataFrame:
    """Two runs of both custody tables: business days since a year before the first run. Every fifth
    symbol's detail of April 1999 lands after the first run, which loads later days of these symbols; the
    second run fills the gap. A summary that never gets its detail is not loaded."""
    lake = _lake(t, "custody")
    summary_spec, detail_spec = (schema.REGISTRY[f"stock_hk_ccass_records{n}"] for n in ("_summary", ""))
    code = F.col("symbol").cast("string")

    def landed(spec: schema.DatasetSpec, label: str, column: str) -> DataFrame:
        rows = t.trades().groupBy("trade_date", code.alias("symbol"), F.col(column).cast("string").alias(label))
        return t.staged(_landed(spec, rows.agg(F.sum("volume").alias("holding"))), "landing")

    summary = landed(summary_spec, "holder_type", "l_linestatus")
    detail = landed(detail_spec, "participant_id", "l_partkey")
    alone = summary.limit(1).withColumns({"trade_date": day("2000-03-01"), "symbol": F.lit("no detail")})
    symbols = t.supplier.select(F.col("s_suppkey").cast("string").alias("symbol"))
    symbols = symbols.unionByName(alone.select("symbol"))
    late = (F.col("symbol").cast("int") % 5 == 0) & F.col("trade_date").between("1999-04-01", "1999-04-30")
    for now, arrived in ((datetime(1999, 6, 15, 9), detail.filter(~late)), (datetime(2000, 3, 15, 9), detail)):
        context = runner.Context(lake, t.calendar(), now)
        runner.run_pair(context, (summary_spec, summary.unionByName(alone)), (detail_spec, arrived), symbols)
    head = ["trade_date", "symbol"]
    return runner.stored_rows(context, detail_spec).select(
        F.lit("detail").alias("kind"), *head, F.col("participant_id").alias("label"), "holding"
    ).unionByName(
        runner.stored_rows(context, summary_spec).select(
            F.lit("summary").alias("kind"), *head, F.col("holder_type").alias("label"), "holding"
        )
    )



@query(f"""WITH {SQL_QUARTERS} SELECT report_date, lpad(CAST(symbol AS VARCHAR), CAST(greatest(6, length(CAST(symbol AS VARCHAR))) AS INTEGER), '0') AS symbol,
  CAST(revenue + CASE WHEN report_date >= DATE '1998-09-30' THEN 1 ELSE 0 END AS DOUBLE) AS net_cash_flow
FROM company_quarters WHERE report_date <= DATE '2001-03-31'""")
def maintain_quarterly(t: Tables) -> DataFrame:
    """Two runs of the cash-flow statements. The second re-reads two quarters, in which every
    report was corrected; each report also lands twice, and the later arrival counts."""
    lake = _lake(t, "quarterly")
    spec = replace(schema.REGISTRY["stock_xjll_em"], default="1995-03-31")
    reports = t.company_quarters()

    def landed(correction: int) -> DataFrame:
        right = _landed(
            spec,
            reports,
            symbol=text.pad_code(F.col("symbol"), 6),
            net_cash_flow=F.col("revenue") + correction,
            announce_date=F.date_format(F.add_months("report_date", 1), "yyyyMMdd"),
        )
        early = right.withColumns({"_batch": F.lit("a"), "net_cash_flow": F.col("net_cash_flow") - 5})
        return right.unionByName(early)

    for now, correction in ((datetime(1999, 3, 15, 17), 0), (datetime(2001, 6, 15, 17), 1)):
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, landed(correction))
    table = runner.stored_rows(context, spec).select("report_date", "symbol", "net_cash_flow")
    return doubles(table, "net_cash_flow")


@query(f"""WITH {sql_bars()}, {SQL_CALENDAR}
SELECT CAST(symbol AS VARCHAR) AS symbol, trade_date, volume, CAST(CASE WHEN symbol % 7 = 0 THEN close * 2 ELSE close END AS DOUBLE) AS close,
  {sql_doubles('open', 'high', 'low', 'amount')} FROM bars
WHERE trade_date <= (SELECT max(trade_date) FROM calendar WHERE trade_date <= DATE '2001-06-15')""")
def maintain_bars(t: Tables) -> DataFrame:
    """Two runs of the forward-adjusted daily bars. Before the second, every seventh symbol was
    recalculated at the source, so its history is loaded again; the others only grow."""
    lake = _lake(t, "bars")
    spec = schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    # bars land as files; every step below reads those, not the trades
    daily = t.staged(t.daily_bars(), "landing")
    universe = t.supplier.select(F.col("s_suppkey").cast("string").alias("symbol"))
    for now, factor in ((datetime(1999, 1, 4, 17), 1), (datetime(2001, 6, 15, 17), 2)):
        revised = F.when(F.col("symbol") % 7 == 0, factor).otherwise(1)
        landed = _landed(spec, daily, symbol=F.col("symbol").cast("string"), close=F.col("close") * revised)
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, landed, universe)
    table = runner.stored_rows(context, spec).select("symbol", "trade_date", "volume", *BAR_VALUES)
    return doubles(table, *BAR_VALUES)


SQL_REVISED = f"""WITH {sql_bars()}, {SQL_CALENDAR}
SELECT CAST(symbol AS VARCHAR) AS symbol, trade_date, volume, CAST(CASE WHEN symbol % 7 = 0 THEN close * 2 ELSE close END AS DOUBLE) AS close,
  {sql_doubles('open', 'high', 'low', 'amount')} FROM bars
WHERE trade_date <= (SELECT max(trade_date) FROM calendar WHERE trade_date <= DATE '2001-06-15')"""


@query(SQL_REVISED)
def maintain_bars_incremental(t: Tables) -> DataFrame:
    """As maintain_bars, but the second landing holds each symbol's overlap bar and the newer ones
    only; the histories of revised symbols come apart from it."""
    lake = _lake(t, "bars")
    spec = schema.REGISTRY["stock_zh_a_hist_daily_qfq"]
    daily = t.staged(t.daily_bars(), "landing")
    universe = t.supplier.select(F.col("s_suppkey").cast("string").alias("symbol"))
    revised = F.when(F.col("symbol") % 7 == 0, 2).otherwise(1)
    bars_of = lambda df, factor: _landed(spec, df, symbol=F.col("symbol").cast("string"), close=F.col("close") * factor)
    first = runner.Context(lake, t.calendar(), datetime(1999, 1, 4, 17))
    runner.run(first, spec, bars_of(daily, F.lit(1)), universe)
    marks = runner.stored_rows(first, spec).groupBy("symbol").agg(F.max("trade_date").alias("last_date"))
    marks = t.staged(marks.select(F.col("symbol").cast("bigint").alias("symbol"), "last_date"), "marks")
    newer = daily.join(marks, "symbol", "left").filter("last_date IS NULL OR trade_date >= last_date").drop("last_date")
    second = runner.Context(lake, t.calendar(), datetime(2001, 6, 15, 17))
    runner.run(second, spec, bars_of(newer, revised), universe, history=bars_of(daily, revised))
    table = runner.stored_rows(second, spec).select("symbol", "trade_date", "volume", *BAR_VALUES)
    return doubles(table, *BAR_VALUES)


@query("""SELECT CAST(make_date(CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT), 1) AS DATE) AS month, c_mktsegment AS area,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1998-06-01' GROUP BY ALL""")
def maintain_areas(t: Tables) -> DataFrame:
    """Two runs of the area totals, whose months land as yyyyMM text."""
    lake = _lake(t, "areas")
    spec = replace(schema.REGISTRY["stock_szse_area_summary"], default="1997-01-01", floor=None)
    orders = t.orders_by_day().join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    totals = orders.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month"), F.col("c_mktsegment").alias("area"))
    landed = t.staged(_landed(spec, totals.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_amount"))), "landing")
    for now in (datetime(1998, 1, 10, 9), datetime(1998, 6, 15, 9)):
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, landed)
    return doubles(runner.stored_rows(context, spec).select("month", "area", "total_amount"), "total_amount")


@query("""WITH s AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol, CAST(c_nationkey AS VARCHAR) AS exchange, c_mktsegment AS board, c_acctbal >= 0 AS alive,
  'A-' || c_mktsegment AS listed, c_custkey % 3 AS part FROM customer)
SELECT symbol, exchange, listed AS board, CAST(CASE WHEN c.late THEN DATE '1999-01-15' ELSE DATE '1999-01-08' END AS DATE) AS load_date
FROM s, LATERAL (SELECT exchange = '7' AND board IN ('BUILDING', 'MACHINERY') AS late) c
WHERE alive AND (exchange IN ('1', '2') AND part > 0 AND board <> 'FURNITURE' OR exchange = '7' AND (late AND part = 2 OR NOT late AND part > 0 AND board <> 'FURNITURE'))""")
def maintain_securities(t: Tables) -> DataFrame:
    """Four loads of the securities: two exchanges in one week, one of them again, and a later week.

    A rule names an exchange and a part of its boards' names, and has its own watermark. Securities with a
    negative balance are delisted. The third load finds nothing due, the fourth replaces the boards that
    contain its rules' text; boards that no rule names are never loaded."""
    lake, spec = _lake(t, "securities"), schema.REGISTRY["stock_basic_info"]
    code = lambda c: F.col(c).cast("string")
    listed = t.customer.select(
        code("c_custkey").alias("symbol"), code("c_nationkey").alias("exchange"), F.concat(F.lit("A-"), "c_mktsegment").alias("board"),
        (F.col("c_custkey") % 3).alias("part"), "c_acctbal",
    )
    delisted = listed.filter("c_acctbal < 0").select("symbol")
    fixed = {"symbol_name": F.lit("name"), "list_date": F.lit("19900101")}
    segments = F.explode(F.array(*[F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")]))
    rules = listed.select("exchange").distinct().select("exchange", segments.alias("board"))
    late = F.col("exchange").isin("7") & F.col("board").rlike("BUILDING|MACHINERY") & (F.col("part") == 2)
    loads_ = (
        (datetime(1999, 1, 11, 9), F.col("exchange").isin("1", "2") & (F.col("part") > 0)),
        (datetime(1999, 1, 11, 10), F.col("exchange").isin("7") & (F.col("part") > 0)),
        (datetime(1999, 1, 11, 11), F.col("exchange").isin("1", "7")),
        (datetime(1999, 1, 18, 9), late),
    )
    for now, arrived in loads_:
        context = runner.Context(lake, t.calendar(), now)
        runner.run(context, spec, _landed(spec, listed.filter(arrived), **fixed), rules, without=delisted)
    return runner.stored_rows(context, spec).select("symbol", "exchange", "board", "load_date")


@query(f"""WITH {sql_bars()} SELECT symbol, max(trade_date) AS last_date, CAST(arg_max(close, trade_date) AS DOUBLE) AS last_value FROM bars GROUP BY symbol""")
def agg_last_value(t: Tables) -> DataFrame:
    """Last date of every symbol and its close on that day."""
    return doubles(aggregates.last_value(t.daily_bars(), "symbol", "trade_date", "close"), "last_value")


@query(SQL_EVENTS)
def stream_two_sources(t: Tables) -> DataFrame:
    """Two streams, each with its own checkpoint, fill one table."""
    lake = _lake(t, "two-sources")
    table = _events_table(lake, t)
    first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for name, part in (("one", first_half), ("two", ~first_half)):
        t.events.filter(part).write.parquet(f"{lake.root}/{name}")
        stream = loads.file_stream(t.spark, f"{lake.root}/{name}", t.events.schema)
        loads.load_available(stream, table, f"{lake.root}/checkpoint-{name}", ["event_id"], ["ts"])
    return table.read_batches()


# --- data dictionary -------------------------------------------------------------------

# Every table with the type text that each of its columns must render to.
TABLE_COLUMNS = {
    "region": "r_regionkey NUMBER(10), r_name CLOB",
    "nation": "n_nationkey NUMBER(10), n_name CLOB, n_regionkey NUMBER(10)",
    "customer": "c_custkey NUMBER(19), c_name CLOB, c_nationkey NUMBER(10), c_acctbal NUMBER, c_mktsegment CLOB",
    "supplier": "s_suppkey NUMBER(19), s_name CLOB, s_nationkey NUMBER(10), s_acctbal NUMBER",
    "part": "p_partkey NUMBER(19), p_name CLOB, p_brand CLOB, p_type CLOB, p_size NUMBER(10), p_retailprice NUMBER",
    "orders": "o_orderkey NUMBER(19), o_custkey NUMBER(19), o_orderstatus CLOB, o_totalprice NUMBER, "
    "o_orderdate TIMESTAMP, o_orderpriority CLOB",
    "lineitem": "l_orderkey NUMBER(19), l_partkey NUMBER(19), l_suppkey NUMBER(19), l_linenumber NUMBER(10), l_quantity NUMBER, "
    "l_extendedprice NUMBER, l_discount NUMBER, l_tax NUMBER, l_returnflag CLOB, l_linestatus CLOB, l_shipdate TIMESTAMP",
    "events": "event_id NUMBER(19), ts TIMESTAMP, user_id NUMBER(19), event_type CLOB, value NUMBER, props CLOB",
    "documents": "doc_id NUMBER(19), text CLOB, lang CLOB, source CLOB, n_chars NUMBER(19)",
    "embeddings": "vec_id NUMBER(19), embedding CLOB, label NUMBER(10)",
    "pages": "page_id NUMBER(19), url CLOB, html CLOB",
    "benchmark": "item_id NUMBER(19), text CLOB",
    "labels": "doc_id NUMBER(19), quality NUMBER(10), toxic NUMBER(10)",
    "conversations": "conv_id NUMBER(19), turn NUMBER(19), role CLOB, text CLOB",
}


def _sql_dictionary() -> str:
    parts = []
    for table, columns in TABLE_COLUMNS.items():
        for position, column in enumerate(columns.split(", "), 1):
            name, kind = column.split()
            parts.append(
                f"SELECT 'LAKE' AS owner, '{table}' AS table_name, 'table ' || '{table}' AS table_comment, '{name}' AS column_name, "
                f"'{kind}' AS type_text, CASE WHEN count(*) > count({name}) THEN 'YES' ELSE 'NO' END AS nullable_flag, "
                f"CAST({position} AS INTEGER) AS column_position, replace('{name}', '_', ' ') AS column_comment FROM {table}"
            )
    return "\nUNION ALL ".join(parts)


@query(_sql_dictionary())
def dict_columns(t: Tables) -> DataFrame:
    """Dictionary of all tables; a column counts as nullable if its data holds a null."""
    tables = {name: getattr(t, name) for name in TABLE_COLUMNS}
    columns = dictionary.columns_of(t.spark, "LAKE", [(n, df.schema) for n, df in tables.items()])
    profiles = [checks.null_profile(df, df.columns).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    nulls = reduce(DataFrame.unionByName, profiles)
    columns = columns.drop("nullable").join(nulls, ["table_name", "column_name"])
    columns = columns.withColumn("nullable", F.col("n_misfits") > 0)
    comments = t.spark.createDataFrame([("LAKE", n, f"table {n}") for n in tables], "owner string, table_name string, table_comment string")
    labels = [("LAKE", n, c, c.replace("_", " ")) for n, df in tables.items() for c in df.columns]
    labels = t.spark.createDataFrame(labels, "owner string, table_name string, column_name string, column_comment string")
    return dictionary.dictionary(columns, comments, labels, "lake")
