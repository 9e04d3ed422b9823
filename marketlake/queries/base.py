"""Query registry and the roles that the driver tables play."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import text
from marketlake.functions.numbers import money
from marketlake.plans import bars as bar_plans
from marketlake.session import scratch_dir

# Where stored rows end and the clock value of a run, for all queries.
SPLIT = "1999-01-01"
OVERLAP = "1998-07-01"
NOW = "2001-06-15 17:00:00"
TODAY = "2001-06-15"
# Days from 2000-01-01 to 2024-01-01: moves event times into the years of the orders.
SHIFT_DAYS = 8766


@dataclass(frozen=True)
class Query:
    run: Callable[["Tables"], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def register(fn):
        REGISTRY[fn.__name__] = Query(fn, sql)
        return fn

    return register


class Tables:
    """The driver tables by name, and the frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        """The frame as a written table, for inputs that several steps read."""
        path = scratch_dir(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def spread(self, df: DataFrame) -> DataFrame:
        """The rows dealt out evenly, before costly work on each: a small compressed file of many rows is one task."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(max(tasks, self.spark.sparkContext.defaultParallelism))

    # --- roles ---

    def securities(self) -> DataFrame:
        return self.customer.select(
            text.pad_code(F.col("c_custkey"), 6).alias("symbol"),
            F.col("c_name").alias("symbol_name"),
            F.col("c_nationkey").alias("exchange"),
            F.col("c_mktsegment").alias("board"),
            F.col("c_acctbal").alias("balance"),
        )

    def trades(self, symbol: str = "l_suppkey") -> DataFrame:
        price = money(F.col("l_extendedprice"))
        return self.lineitem.select(
            F.col(symbol).alias("symbol"),
            F.to_date("l_shipdate").alias("trade_date"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            price.alias("price"),
            F.col("l_quantity").cast("bigint").alias("volume"),
            price.alias("amount"),
            "l_returnflag",
            "l_linestatus",
        )

    def daily_bars(self, symbol: str = "l_suppkey") -> DataFrame:
        """Bars of a symbol's days. Nearly every trade is a bar of its own, so a task that combines before the shuffle
        holds all of its rows, more than fit at size: trades are dealt by bar first, and combine behind it. One bar's
        trades meet in one task, which keeps one row of them; a symbol's days are spread."""
        other = "l_partkey" if symbol == "l_suppkey" else "l_suppkey"  # the symbol is one within a bar
        order, keys = ["l_orderkey", "l_linenumber", other, "volume"], ["symbol", "trade_date"]
        trades = self.trades(symbol).repartition(*keys)
        return bar_plans.from_trades(trades, keys, order, digits=(13, 1, 11, 2, 11))

    def orders_by_day(self) -> DataFrame:
        return self.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))

    def calendar(self) -> DataFrame:
        """Trading dates: the distinct weekdays on which something was ordered."""
        days = self.orders.select(F.to_date("o_orderdate").alias("trade_date")).distinct()
        return days.filter(F.weekday("trade_date") < 5)

    def supplier_marks(self) -> DataFrame:
        """Per-supplier watermark before the split, spread over 180 days."""
        last = (
            self.lineitem.filter(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz"))
            .groupBy(F.col("l_suppkey").alias("symbol"))
            .agg(F.max(F.to_date("l_shipdate")).alias("_last"))
        )
        back = (F.col("symbol") % 180).cast("int")
        return last.select("symbol", F.date_sub("_last", back).alias("watermark"))

    def holdings(self) -> DataFrame:
        """Fund holdings per fund (supplier), stock (part) and quarter end."""
        return (
            self.lineitem.select(
                F.col("l_suppkey").alias("fund_code"),
                F.col("l_partkey").alias("symbol"),
                quarter_end("l_shipdate").alias("report_date"),
                F.col("l_quantity").cast("bigint").alias("shares"),
                money(F.col("l_extendedprice")).alias("holding_value"),
            )
            .groupBy("fund_code", "symbol", "report_date")
            .agg(F.sum("shares").alias("shares"), F.sum("holding_value").alias("holding_value"))
        )

    def company_quarters(self) -> DataFrame:
        """Company reports: ordered value and number of orders per customer and quarter."""
        return self.orders.groupBy(
            F.col("o_custkey").alias("symbol"), quarter_end("o_orderdate").alias("report_date")
        ).agg(
            F.sum(money(F.col("o_totalprice"))).alias("revenue"),
            F.count(F.lit(1)).alias("n_orders"),
        )

    def events_2000(self) -> DataFrame:
        """Clock values: event times moved to the year 2000."""
        moved = F.col("ts") - F.make_dt_interval(F.lit(SHIFT_DAYS))
        return self.events.select("event_id", moved.alias("now"))


def quarter_end(date: str):
    return F.last_day(F.add_months(F.trunc(F.to_date(date), "quarter"), 2))


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Decimal results leave as doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


BAR_VALUES = ("open", "close", "high", "low", "amount")

# --- SQL twins of the roles ---

SQL_SECURITIES = """securities AS (
  SELECT CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 6 THEN CAST(c_custkey AS VARCHAR)
              ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS symbol,
         c_name AS symbol_name, c_nationkey AS exchange, c_mktsegment AS board, c_acctbal AS balance
  FROM customer)"""


def sql_bars(symbol: str = "l_suppkey", name: str = "bars") -> str:
    order = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)"
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"
    return f"""{name} AS (
  SELECT {symbol} AS symbol, CAST(l_shipdate AS DATE) AS trade_date,
         arg_min({price}, {order}) AS open, arg_max({price}, {order}) AS close,
         max({price}) AS high, min({price}) AS low,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume, sum({price}) AS amount
  FROM lineitem GROUP BY 1, 2)"""


SQL_CALENDAR = """calendar AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date FROM orders
  WHERE isodow(o_orderdate) < 6)"""

SQL_MARKS = f"""marks AS (
  SELECT l_suppkey AS symbol,
         CAST(max(CAST(l_shipdate AS DATE)) - CAST(l_suppkey % 180 AS INTEGER) AS DATE) AS watermark
  FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT}' GROUP BY l_suppkey)"""


def sql_quarter_end(date: str) -> str:
    return f"last_day(CAST(date_trunc('quarter', {date}) + INTERVAL 2 MONTH AS DATE))"


SQL_HOLDINGS = f"""holdings AS (
  SELECT l_suppkey AS fund_code, l_partkey AS symbol, {sql_quarter_end('l_shipdate')} AS report_date,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS shares,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS holding_value
  FROM lineitem GROUP BY 1, 2, 3)"""

SQL_QUARTERS = f"""company_quarters AS (
  SELECT o_custkey AS symbol, {sql_quarter_end('o_orderdate')} AS report_date,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, count(*) AS n_orders
  FROM orders GROUP BY 1, 2)"""

SQL_EVENTS_2000 = f"""clocks AS (
  SELECT event_id, ts - INTERVAL {SHIFT_DAYS} DAY AS now FROM events)"""


def sql_doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


SQL_BAR_COLUMNS = f"symbol, trade_date, volume, {sql_doubles(*BAR_VALUES)}"
