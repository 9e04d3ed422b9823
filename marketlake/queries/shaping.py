"""Scans, projections, filters, sorts, unions and reshapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.numbers import money
from marketlake.operators import aggregates, asof, filters, joins, projections, reshape
from marketlake.queries.base import (
    SPLIT,
    SQL_MARKS,
    SQL_SECURITIES,
    Tables,
    doubles,
    query,
    sql_bars,
    SQL_BAR_COLUMNS,
    BAR_VALUES,
)
from marketlake.sources import landing

SECURITY_COLUMNS = "symbol, symbol_name, exchange, board"


# --- scans -----------------------------------------------------------------------------


@query(f"""WITH {SQL_SECURITIES}
SELECT {SECURITY_COLUMNS} FROM securities WHERE board <> 'BUILDING' AND balance > 0 ORDER BY symbol""")
def scan_universe(t: Tables) -> DataFrame:
    kept = t.securities().filter("board <> 'BUILDING' AND balance > 0")
    return kept.select("symbol", "symbol_name", "exchange", "board").orderBy("symbol")


@query("SELECT s_suppkey AS symbol, s_name AS symbol_name, s_nationkey AS exchange FROM supplier ORDER BY 1")
def scan_lookup(t: Tables) -> DataFrame:
    return projections.rename_map(
        t.supplier.select("s_suppkey", "s_name", "s_nationkey"),
        {"s_suppkey": "symbol", "s_name": "symbol_name", "s_nationkey": "exchange"},
    ).orderBy("symbol")


# --- projections -----------------------------------------------------------------------


@query("SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def proj_select(t: Tables) -> DataFrame:
    return projections.select_columns(t.part, ["p_partkey", "p_name", "p_brand", "p_retailprice"])


@query("""SELECT l_suppkey AS symbol, l_partkey AS stock, l_quantity AS volume, l_extendedprice AS price
FROM lineitem""")
def proj_rename_positional(t: Tables) -> DataFrame:
    picked = t.lineitem.select("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")
    return projections.rename_positional(picked, ["symbol", "stock", "volume", "price"])


@query("""SELECT p_partkey AS symbol, p_name AS symbol_name, p_brand AS board, p_type, p_size, p_retailprice
FROM part""")
def proj_rename_map(t: Tables) -> DataFrame:
    return projections.rename_map(
        t.part, {"p_partkey": "symbol", "p_name": "symbol_name", "p_brand": "board"}
    )


@query("""SELECT l_orderkey AS key, l_extendedprice AS price_total, l_discount AS price_discount FROM lineitem""")
def proj_normalise_names(t: Tables) -> DataFrame:
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("raw-key"),
        F.col("l_extendedprice").alias("raw-price-total"),
        F.col("l_discount").alias("raw-price-discount"),
    )
    return projections.normalise_names(raw, "-", drop_prefix="raw_")


@query("""SELECT p_partkey, 'SZSE' AS exchange, 'main' AS board, DATE '2001-06-15' AS load_date FROM part""")
def proj_tag_constants(t: Tables) -> DataFrame:
    day = F.lit("2001-06-15").cast("date")
    return projections.tag(t.part.select("p_partkey"), exchange="SZSE", board="main", load_date=day)


@query("""SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8, 2) AS lots,
  round_even(l_extendedprice, 2) AS l_extendedprice, round_even(l_discount, 2) AS l_discount,
  round_even(l_tax, 2) AS l_tax FROM lineitem""")
def proj_round_floats(t: Tables) -> DataFrame:
    raw = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") / 8).alias("lots"),
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )
    return projections.round_floats(raw, 2)


@query("""SELECT l_orderkey, l_linenumber, l_returnflag,
  TRY_CAST(CASE WHEN l_returnflag = 'N' THEN '-' ELSE CAST(l_discount AS VARCHAR) END AS DOUBLE) AS discount,
  round_even(l_quantity / 8, 2) AS lots FROM lineitem""")
def proj_cast_tail(t: Tables) -> DataFrame:
    raw = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.when(F.col("l_returnflag") == "N", "-").otherwise(F.col("l_discount").cast("string")).alias("discount"),
        (F.col("l_quantity") / 8).cast("string").alias("lots"),
    )
    return projections.cast_tail(raw, 3)


@query("SELECT p_partkey, p_name, CAST(NULL AS DATE) AS latest_holding_date FROM part")
def proj_null_column(t: Tables) -> DataFrame:
    return projections.null_column(t.part.select("p_partkey", "p_name"), "latest_holding_date", "date")


@query("SELECT p_partkey, 'board-' || p_brand AS board FROM part")
def proj_concat_label(t: Tables) -> DataFrame:
    raw = t.part.select("p_partkey", F.col("p_brand").alias("board"))
    return projections.concat_label(raw, "board", "board", "board")


# --- filters ---------------------------------------------------------------------------


@query(f"""WITH {SQL_SECURITIES}
SELECT {SECURITY_COLUMNS} FROM securities
WHERE symbol_name NOT LIKE 'Customer#0000001%' AND symbol_name NOT LIKE '%77'
  AND (CAST(symbol AS BIGINT) < 500 OR CAST(symbol AS BIGINT) > 700)""")
def filter_universe(t: Tables) -> DataFrame:
    kept = filters.universe(t.securities(), patterns=("Customer#0000001%", "%77"), low=500, high=700)
    return kept.select("symbol", "symbol_name", "exchange", "board")


@query(f"""WITH {SQL_SECURITIES}
SELECT {SECURITY_COLUMNS} FROM securities WHERE symbol < '000500' OR symbol > '000700'""")
def filter_code_range(t: Tables) -> DataFrame:
    kept = filters.code_range(t.securities(), "symbol", "000500", "000700")
    return kept.select("symbol", "symbol_name", "exchange", "board")


@query(f"""WITH {SQL_SECURITIES}
SELECT {SECURITY_COLUMNS} FROM securities WHERE board IN ('BUILDING', 'MACHINERY')""")
def filter_isin(t: Tables) -> DataFrame:
    kept = filters.is_in(t.securities(), "board", ["BUILDING", "MACHINERY"])
    return kept.select("symbol", "symbol_name", "exchange", "board")


@query(f"""WITH {SQL_SECURITIES}
SELECT {SECURITY_COLUMNS} FROM securities WHERE board NOT IN ('BUILDING', 'MACHINERY')""")
def filter_not_isin(t: Tables) -> DataFrame:
    kept = filters.not_in(t.securities(), "board", ["BUILDING", "MACHINERY"])
    return kept.select("symbol", "symbol_name", "exchange", "board")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def filter_positive(t: Tables) -> DataFrame:
    return filters.positive(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal")


@query(f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem
                                   WHERE l_shipdate < TIMESTAMP '{SPLIT}')""")
def filter_after_watermark(t: Tables) -> DataFrame:
    stored = t.lineitem.filter(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz"))
    mark = aggregates.watermark(stored.select(F.to_date("l_shipdate").alias("d")), "d", "1990-01-01")
    orders = t.orders_by_day().select("o_orderkey", "o_orderdate")
    return filters.after_watermark(orders, "o_orderdate", mark)


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'""")
def filter_between(t: Tables) -> DataFrame:
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "1998-12-31"))
    kept = filters.between(t.orders, "o_orderdate", low, high)
    return kept.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))


SQL_HOLES = """holes AS (SELECT c_custkey, n_name, nullif(c_mktsegment, 'BUILDING') AS board
  FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON c_nationkey = n_nationkey)"""


def _holes(t: Tables) -> DataFrame:
    nations = t.nation.filter("n_regionkey < 3")
    joined = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.selectExpr("c_custkey", "n_name", "nullif(c_mktsegment, 'BUILDING') AS board")


@query(f"""WITH {SQL_HOLES} SELECT * FROM holes WHERE n_name IS NOT NULL AND board IS NOT NULL""")
def filter_dropna_any(t: Tables) -> DataFrame:
    return filters.complete_rows(_holes(t))


@query(f"""WITH {SQL_HOLES} SELECT * FROM holes WHERE board IS NOT NULL""")
def filter_dropna_key(t: Tables) -> DataFrame:
    return filters.complete_keys(_holes(t), ["c_custkey", "board"])


@query(f"""WITH {sql_bars()}, starts AS (
  SELECT symbol, max(trade_date) AS start_date FROM bars WHERE trade_date < DATE '{SPLIT}' GROUP BY symbol)
SELECT {SQL_BAR_COLUMNS} FROM bars LEFT JOIN starts USING (symbol)
WHERE start_date IS NULL OR (trade_date <> start_date)""")
def filter_drop_overlap(t: Tables) -> DataFrame:
    bars = t.daily_bars()
    starts = (
        t.trades()
        .filter(F.col("trade_date") < F.lit(SPLIT).cast("date"))
        .groupBy("symbol")
        .agg(F.max("trade_date").alias("start_date"))
    )
    kept = filters.drop_overlap(bars, starts, "symbol", "trade_date", "start_date")
    return doubles(kept, *BAR_VALUES)


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment LIKE '%IN%'")
def filter_like(t: Tables) -> DataFrame:
    return filters.contains(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "IN")


# --- sorts and limits ------------------------------------------------------------------


@query(f"WITH {SQL_SECURITIES} SELECT symbol, symbol_name FROM securities ORDER BY symbol")
def sort_code(t: Tables) -> DataFrame:
    return t.securities().select("symbol", "symbol_name").orderBy(*filters.code_order("symbol"))


@query("""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
ORDER BY o_orderdate, o_custkey, o_orderkey""")
def sort_multi(t: Tables) -> DataFrame:
    orders = t.orders_by_day().select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.orderBy(*filters.code_order("o_orderdate", "o_custkey", "o_orderkey"))


@query("""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
ORDER BY o_orderdate DESC, o_custkey, o_orderkey LIMIT 1""")
def limit_first(t: Tables) -> DataFrame:
    orders = t.orders_by_day().select("o_orderkey", "o_custkey", "o_orderdate")
    return landing.first_n(orders, [F.desc("o_orderdate"), F.asc("o_custkey"), F.asc("o_orderkey")], 1)


@query("""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
ORDER BY o_custkey, o_orderdate DESC, o_orderkey LIMIT 5000""")
def topk_page(t: Tables) -> DataFrame:
    orders = t.orders_by_day().select("o_orderkey", "o_custkey", "o_orderdate")
    return landing.first_n(orders, [F.asc("o_custkey"), F.desc("o_orderdate"), F.asc("o_orderkey")], 5000)


# --- unions and reshapes ---------------------------------------------------------------

SQL_ORDER_COLUMNS = "o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate"


def _orders(t: Tables, status: str) -> DataFrame:
    rows = t.orders_by_day().filter(F.col("o_orderstatus") == status)
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query(f"SELECT {SQL_ORDER_COLUMNS} FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')")
def union_batches(t: Tables) -> DataFrame:
    batches = [_orders(t, status) for status in "FOP"]
    return reshape.union_batches(t.spark, batches[0].schema, batches)


@query(f"""SELECT {SQL_ORDER_COLUMNS},
  CASE o_orderstatus WHEN 'F' THEN 'SSE' WHEN 'O' THEN 'SZSE' ELSE 'BSE' END AS exchange
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""")
def union_tagged(t: Tables) -> DataFrame:
    segments = {"SSE": _orders(t, "F"), "SZSE": _orders(t, "O"), "BSE": _orders(t, "P")}
    return reshape.union_tagged(segments, "exchange")


@query(f"""SELECT {SQL_ORDER_COLUMNS}, o_orderstatus FROM orders
WHERE o_orderstatus <> 'P' OR o_orderdate >= TIMESTAMP '1998-01-01'""")
def union_date_gated(t: Tables) -> DataFrame:
    segments = {s: _orders(t, s) for s in ("F", "O", "P")}
    union = reshape.union_tagged(segments, "o_orderstatus")
    return reshape.gate_segments(union, F.col("o_orderstatus"), ["P"], F.col("o_orderdate"), "1998-01-01")


@query(f"""SELECT {SQL_ORDER_COLUMNS} FROM orders WHERE o_orderstatus = 'F'""")
def union_empty(t: Tables) -> DataFrame:
    """The typed empty frame of no batches takes part in a union like any other."""
    rows = _orders(t, "F")
    return reshape.union_batches(t.spark, rows.schema, []).unionByName(rows)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("""SELECT o_orderpriority AS board, CAST(count(*) AS DOUBLE) AS listed,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS market_cap, max(o_totalprice) AS highest
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
GROUP BY 1""")
def reshape_transpose(t: Tables) -> DataFrame:
    per_board = t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).cast("double").alias("listed"),
        F.sum(money(F.col("o_totalprice"))).cast("double").alias("market_cap"),
        F.max("o_totalprice").alias("highest"),
    )
    metrics = ["listed", "market_cap", "highest"]
    # the landed shape: one row per metric, one column per board
    landed = (
        per_board.unpivot("o_orderpriority", metrics, "metric", "value")
        .groupBy("metric")
        .pivot("o_orderpriority", list(PRIORITIES))
        .agg(F.first("value"))
    )
    return reshape.transpose(landed, "metric", PRIORITIES, metrics, "board")


# --- joins on keys ---------------------------------------------------------------------


@query(f"""WITH {SQL_SECURITIES} SELECT {SECURITY_COLUMNS} FROM securities s
WHERE NOT EXISTS (SELECT 1 FROM securities d WHERE d.balance < 0 AND d.symbol = s.symbol)""")
def join_anti_delisted(t: Tables) -> DataFrame:
    delisted = t.securities().filter("balance < 0")
    kept = joins.without(t.securities(), delisted, ["symbol"])
    return kept.select("symbol", "symbol_name", "exchange", "board")


@query(f"""SELECT {SQL_ORDER_COLUMNS} FROM orders o WHERE o_orderdate >= TIMESTAMP '1998-07-01'
AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderdate < TIMESTAMP '{SPLIT}'
                AND e.o_custkey = o.o_custkey AND e.o_orderdate = o.o_orderdate)""")
def join_anti_composite(t: Tables) -> DataFrame:
    orders = t.orders_by_day().select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    existing = orders.filter(F.col("o_orderdate") < F.lit(SPLIT).cast("date"))
    incoming = orders.filter(F.col("o_orderdate") >= F.lit("1998-07-01").cast("date"))
    return joins.without(incoming, existing, ["o_custkey", "o_orderdate"])


@query("""SELECT c_custkey, c_name, c_nationkey, n_name, n_regionkey, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def join_left_chain(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey")
    nations = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.left_chain(customers, (nations, ["c_nationkey"]), (regions, ["n_regionkey"]))


@query("""SELECT trade_date, unnest(['SSE', 'SZSE', 'BSE']) AS exchange
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date FROM orders)""")
def join_cross_exchange(t: Tables) -> DataFrame:
    days = t.orders.select(F.to_date("o_orderdate").alias("trade_date")).distinct()
    return joins.per_exchange(days, ["SSE", "SZSE", "BSE"])


# --- distinct and keep-last ------------------------------------------------------------

LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) = 1""")
def dedup_keep_last(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("l_shipdate", F.to_date("l_shipdate"))
    return aggregates.keep_last(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER)


@query("SELECT DISTINCT p_brand, p_type FROM part")
def dedup_full_row(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct()


@query(f"""WITH {sql_bars()}, mondays AS (SELECT symbol, trade_date AS bar_date, close FROM bars WHERE isodow(trade_date) = 1 AND symbol % 9 > 0)
SELECT l_orderkey, l_linenumber, l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS trade_date, bar_date, CAST(close AS DOUBLE) AS close
FROM lineitem ASOF LEFT JOIN mondays ON l_suppkey = symbol AND CAST(l_shipdate AS DATE) >= bar_date""")
def join_asof_keyed(t: Tables) -> DataFrame:
    """Every trade with its symbol's last Monday bar at or before its day; every ninth symbol has none."""
    bars = t.daily_bars().filter((F.weekday("trade_date") == 0) & (F.col("symbol") % 9 > 0))
    mondays = bars.select("symbol", F.col("trade_date").alias("bar_date"), "close")
    trades = t.trades().select("l_orderkey", "l_linenumber", "symbol", "trade_date")
    joined = asof.keyed_asof(trades, mondays, "symbol", "trade_date", "bar_date", ["bar_date", "close"])
    return joined.withColumn("close", F.col("close").cast("double"))
