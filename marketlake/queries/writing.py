"""Write modes, revision, sync log and checks.

Stored and incoming tables are slices of one driver table, so each query returns the table as
it is after the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import numbers
from marketlake.operators import checks, filters, revision, synclog, writes
from marketlake.queries.base import (
    BAR_VALUES,
    NOW,
    OVERLAP,
    SPLIT,
    SQL_BAR_COLUMNS,
    SQL_HOLDINGS,
    SQL_QUARTERS,
    Tables,
    doubles,
    query,
    sql_bars,
)

day = lambda value: F.lit(value).cast("date")
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
SQL_ORDERS = """orders_d AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders)"""


def _stored(t: Tables) -> DataFrame:
    return t.orders_by_day().filter(F.col("o_orderdate") < day(SPLIT)).select(*ORDER_COLUMNS)


def _incoming(t: Tables, since: str) -> DataFrame:
    return t.orders_by_day().filter(F.col("o_orderdate") >= day(since)).select(*ORDER_COLUMNS)


# --- append and insert-if-absent -------------------------------------------------------


@query(f"WITH {SQL_ORDERS} SELECT * FROM orders_d")
def write_append(t: Tables) -> DataFrame:
    return writes.append(_stored(t), _incoming(t, SPLIT))


@query(f"""WITH {SQL_ORDERS}, stored AS (SELECT * FROM orders_d WHERE o_orderdate < DATE '{SPLIT}'),
fresh AS (SELECT * FROM orders_d i WHERE o_orderdate >= DATE '{OVERLAP}' AND NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.o_custkey = i.o_custkey AND s.o_orderdate = i.o_orderdate)
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate
    ORDER BY o_orderkey DESC, o_totalprice DESC, o_orderstatus DESC, o_orderpriority DESC) = 1)
SELECT * FROM stored UNION ALL SELECT * FROM fresh""")
def write_insert_if_absent(t: Tables) -> DataFrame:
    order = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    key = ["o_custkey", "o_orderdate"]
    return writes.insert_if_absent(_stored(t), _incoming(t, OVERLAP), key, order, within="o_orderdate")


# --- replace a slice -------------------------------------------------------------------


@query(f"""WITH {SQL_QUARTERS}
SELECT symbol, report_date, CAST(revenue + CASE WHEN report_date >= DATE '2001-06-30' THEN 100 ELSE 0 END AS DOUBLE) AS revenue, n_orders
FROM company_quarters""")
def write_replace_quarter(t: Tables) -> DataFrame:
    stored = t.company_quarters()
    again = stored.filter(F.col("report_date") >= day("2001-06-30"))
    again = again.withColumn("revenue", (F.col("revenue") + 100).cast(stored.schema["revenue"].dataType))
    return doubles(writes.replace_slices(stored, again, ["report_date"]), "revenue")


@query(f"""WITH {sql_bars()} SELECT symbol, trade_date, volume, CAST(open AS DOUBLE) AS open,
  CAST(CASE WHEN symbol % 7 = 0 THEN close * 2 ELSE close END AS DOUBLE) AS close,
  CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(amount AS DOUBLE) AS amount FROM bars""")
def write_replace_symbol(t: Tables) -> DataFrame:
    stored = t.daily_bars()
    reloaded = stored.filter(F.col("symbol") % 7 == 0)
    reloaded = reloaded.withColumn("close", (F.col("close") * 2).cast("decimal(18,2)"))
    return doubles(writes.replace_slices(stored, reloaded, ["symbol"]), *BAR_VALUES)


@query("""SELECT p_partkey, p_brand, CASE WHEN p_brand IN ('Brand#3', 'Brand#11') THEN 'new' ELSE p_type END AS p_type
FROM part WHERE p_brand NOT IN ('Brand#3', 'Brand#11') OR p_size > 10""")
def write_replace_board(t: Tables) -> DataFrame:
    stored = t.part.select("p_partkey", "p_brand", "p_type")
    members = t.part.filter("p_brand IN ('Brand#3', 'Brand#11') AND p_size > 10")
    members = members.select("p_partkey", "p_brand", F.lit("new").alias("p_type"))
    return writes.replace_slices(stored, members, ["p_brand"])


@query("""WITH arrived AS (SELECT c_custkey, c_nationkey, 'IN' AS c_mktsegment FROM customer
  WHERE c_nationkey < 10 AND c_mktsegment LIKE '%IN%' AND c_acctbal > 0)
SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
WHERE NOT (c_mktsegment LIKE '%IN%' AND c_nationkey IN (SELECT c_nationkey FROM arrived))
UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment FROM arrived""")
def write_replace_like(t: Tables) -> DataFrame:
    """A nation's segments that contain the arriving segment's name give way to the arriving rows."""
    stored = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    inside = (F.col("c_nationkey") < 10) & F.col("c_mktsegment").contains("IN") & (F.col("c_acctbal") > 0)
    arrived = t.customer.filter(inside).select("c_custkey", "c_nationkey", F.lit("IN").alias("c_mktsegment"))
    return writes.replace_like(stored, arrived, "c_nationkey", "c_mktsegment")


@query(f"""WITH {SQL_HOLDINGS}
SELECT fund_code, symbol, report_date, shares, CAST(CASE WHEN fund_code % 5 = 0 AND year(report_date) = 1998
  THEN holding_value + 1 ELSE holding_value END AS DOUBLE) AS holding_value FROM holdings""")
def write_replace_range(t: Tables) -> DataFrame:
    stored = t.holdings()
    again = stored.filter((F.col("fund_code") % 5 == 0) & (F.year("report_date") == 1998))
    again = again.withColumn("holding_value", (F.col("holding_value") + 1).cast(stored.schema["holding_value"].dataType))
    after = writes.replace_range(stored, again, "fund_code", "report_date", "1998-01-01", "1998-12-31")
    return doubles(after, "holding_value")


@query("""SELECT r_regionkey AS code, r_name AS name, 'region' AS kind FROM region
UNION ALL SELECT n_nationkey, n_name, 'nation' FROM nation""")
def write_snapshot_replace(t: Tables) -> DataFrame:
    """One snapshot arrives and replaces the table, the other is empty and leaves it alone."""
    regions = t.region.select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("name"))
    nations = t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    replaced = writes.replace_snapshot(nations.filter("code > 3"), regions)
    kept = writes.replace_snapshot(nations, regions.filter("code > 1000"))
    return replaced.withColumn("kind", F.lit("region")).unionByName(
        kept.withColumn("kind", F.lit("nation"))
    )


@query(f"""WITH {SQL_HOLDINGS}
SELECT s_suppkey AS fund_code, s_name AS fund_name, coalesce(last, DATE '2000-12-31') AS latest_holding_date
FROM supplier LEFT JOIN (SELECT fund_code, max(report_date) AS last FROM holdings WHERE report_date > DATE '2001-09-30' GROUP BY 1)
  ON fund_code = s_suppkey""")
def update_parent_watermark(t: Tables) -> DataFrame:
    parent = t.supplier.select(F.col("s_suppkey").alias("fund_code"), F.col("s_name").alias("fund_name"))
    parent = writes.reset_parent_date(parent, "latest_holding_date")
    child = t.holdings().filter(F.col("report_date") > day("2001-09-30"))
    return writes.update_parent_date(
        parent, child, "fund_code", "report_date", "latest_holding_date", day("2000-12-31")
    )


# --- revision --------------------------------------------------------------------------


def _revision_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored bars, the bars that arrive from each last stored date on, and the full history.

    Every seventh symbol was recalculated; every eleventh lost its overlap bar. The bars are
    written once, as the tables they stand for would be.
    """
    bars = t.staged(t.daily_bars(), "bars")
    stored = bars.filter(F.col("trade_date") < day(SPLIT)).filter(F.col("symbol") % 13 != 0)
    revised = F.when(F.col("symbol") % 7 == 0, 2).otherwise(1)
    history = bars.withColumn("close", (F.col("close") * revised).cast("decimal(18,2)"))
    last = stored.groupBy("symbol").agg(F.max("trade_date").alias("_last"))
    arrived = history.join(last, "symbol", "left").filter(
        F.col("_last").isNull()
        | (F.col("trade_date") > F.col("_last"))
        | ((F.col("trade_date") == F.col("_last")) & (F.col("symbol") % 11 != 0))
    )
    return stored, arrived.drop("_last"), history


SQL_REVISION = f"""{sql_bars()},
stored AS (SELECT * FROM bars WHERE trade_date < DATE '{SPLIT}' AND symbol % 13 <> 0),
history AS (SELECT symbol, trade_date, open, CAST(close * CASE WHEN symbol % 7 = 0 THEN 2 ELSE 1 END AS DECIMAL(18,2)) AS close,
  high, low, volume, amount FROM bars),
lasts AS (SELECT symbol, max(trade_date) AS last_date, arg_max(close, trade_date) AS last_close FROM stored GROUP BY 1),
arrived AS (SELECT history.* FROM history LEFT JOIN lasts USING (symbol)
  WHERE last_date IS NULL OR trade_date > last_date OR (trade_date = last_date AND symbol % 11 <> 0)),
overlap AS (SELECT a.symbol, a.close AS overlap_close FROM arrived a JOIN lasts l ON a.symbol = l.symbol AND a.trade_date = l.last_date),
keys AS (SELECT DISTINCT symbol FROM arrived),
actions AS (SELECT symbol, last_date, last_close, overlap_close,
  CASE WHEN last_date IS NULL THEN 'append' WHEN overlap_close IS NULL THEN '{{missing}}'
       WHEN overlap_close = last_close THEN 'append' ELSE 'reload' END AS action
  FROM keys LEFT JOIN lasts USING (symbol) LEFT JOIN overlap USING (symbol))"""

SQL_ACTIONS = """SELECT symbol, last_date, CAST(last_close AS DOUBLE) AS last_close,
  CAST(overlap_close AS DOUBLE) AS overlap_close, action FROM actions"""


@query(f"WITH {SQL_REVISION.format(missing='reload')} {SQL_ACTIONS}")
def detect_revisions(t: Tables) -> DataFrame:
    stored, incoming, _ = _revision_inputs(t)
    return doubles(revision.classify(stored, incoming), "last_close", "overlap_close")


@query(f"WITH {SQL_REVISION.format(missing='append')} {SQL_ACTIONS}")
def detect_revisions_lenient(t: Tables) -> DataFrame:
    stored, incoming, _ = _revision_inputs(t)
    return doubles(revision.classify(stored, incoming, lenient=True), "last_close", "overlap_close")


@query(f"""WITH {SQL_REVISION.format(missing='reload')}, after AS (
  SELECT stored.* FROM stored WHERE symbol NOT IN (SELECT symbol FROM actions WHERE action = 'reload')
  UNION ALL SELECT arrived.* FROM arrived JOIN actions USING (symbol)
    WHERE action = 'append' AND (last_date IS NULL OR trade_date <> last_date)
  UNION ALL SELECT history.* FROM history WHERE symbol IN (SELECT symbol FROM actions WHERE action = 'reload'))
SELECT {SQL_BAR_COLUMNS} FROM after""")
def apply_revisions(t: Tables) -> DataFrame:
    stored, incoming, history = _revision_inputs(t)
    actions = t.staged(revision.classify(stored, incoming), "actions")
    return doubles(revision.apply(stored, incoming, history, actions), *BAR_VALUES)


# --- sync log --------------------------------------------------------------------------

SQL_LOG = f"""log AS (SELECT o_orderpriority AS interface, o_orderstatus AS table_name,
  max(CAST(o_orderdate AS DATE)) AS trade_date, '{synclog.SUCCESS}' AS status
  FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderdate < TIMESTAMP '{SPLIT}' GROUP BY 1, 2),
runs AS (SELECT o_orderpriority AS interface, o_orderstatus AS table_name, max(CAST(o_orderdate AS DATE)) AS trade_date
  FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1, 2)"""


def _log(t: Tables) -> DataFrame:
    old = t.orders_by_day().filter("o_orderstatus IN ('F', 'O')").filter(F.col("o_orderdate") < day(SPLIT))
    return (
        old.groupBy(F.col("o_orderpriority").alias("interface"), F.col("o_orderstatus").alias("table_name"))
        .agg(F.max("o_orderdate").alias("trade_date"))
        .withColumn("status", F.lit(synclog.SUCCESS))
    )


def _runs(t: Tables) -> DataFrame:
    new = t.orders_by_day().filter("o_orderstatus IN ('O', 'P')")
    return new.groupBy(
        F.col("o_orderpriority").alias("interface"), F.col("o_orderstatus").alias("table_name")
    ).agg(F.max("o_orderdate").alias("trade_date"))


@query(f"""WITH {SQL_LOG} SELECT interface, table_name, coalesce(r.trade_date, l.trade_date) AS trade_date,
  '{synclog.SUCCESS}' AS status FROM log l FULL JOIN runs r USING (interface, table_name)""")
def synclog_success(t: Tables) -> DataFrame:
    return synclog.succeed(_log(t), _runs(t))


@query(f"""WITH {SQL_LOG} SELECT interface, table_name, coalesce(l.trade_date, DATE '{synclog.NEVER}') AS trade_date,
  CASE WHEN r.trade_date IS NULL THEN l.status ELSE '{synclog.FAILED}' END AS status
FROM log l FULL JOIN runs r USING (interface, table_name)""")
def synclog_failure(t: Tables) -> DataFrame:
    return synclog.fail(_log(t), _runs(t))


@query(f"""WITH {SQL_LOG} SELECT * FROM log WHERE table_name NOT IN (SELECT table_name FROM runs)""")
def synclog_purge(t: Tables) -> DataFrame:
    return synclog.purge(_log(t), _runs(t).select("table_name").distinct())


@query(f"""WITH {SQL_LOG} SELECT interface, table_name, trade_date, status,
  CAST(DATE '{NOW[:10]}' - trade_date AS INTEGER) AS lag_days FROM log""")
def synclog_freshness(t: Tables) -> DataFrame:
    return synclog.freshness(_log(t), F.lit(NOW).cast("timestamp_ntz"))


# --- checks ----------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def check_unique_key(t: Tables) -> DataFrame:
    return checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(f"""WITH landed AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS trade_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS close, l_quantity
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-12-01' AND l_shipdate < TIMESTAMP '1999-02-01'),
stored AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS trade_date, CAST(count(*) AS BIGINT) AS n_stored FROM lineitem
  WHERE l_shipdate < TIMESTAMP '{SPLIT}' AND l_returnflag = 'R' GROUP BY 1, 2),
keys AS (SELECT symbol, trade_date, CAST(count(*) AS BIGINT) AS n_rows, bool_or(close >= 100000) AS wide, bool_or(l_quantity >= 50) AS many
  FROM landed GROUP BY 1, 2)
SELECT symbol, trade_date, n_rows, coalesce(n_stored, 0) AS n_stored,
  concat_ws(',', CASE WHEN wide THEN 'close' END, CASE WHEN many THEN 'volume' END) AS misfits
FROM keys LEFT JOIN stored USING (symbol, trade_date) WHERE n_rows + coalesce(n_stored, 0) > 1 OR wide OR many""")
def check_before_publish(t: Tables) -> DataFrame:
    """Keys that a load would have to fail for: they land twice, are stored already, or hold a value that
    does not fit its column."""
    trades = t.trades().select("symbol", "trade_date", F.col("price").alias("close"), "volume", "l_returnflag")
    landed = trades.filter(F.col("trade_date").between("1998-12-01", "1999-01-31"))
    stored = trades.filter((F.col("trade_date") < SPLIT) & (F.col("l_returnflag") == "R"))
    rules = {"close": numbers.fits_decimal(F.col("close"), 7, 2), "volume": F.col("volume") < 50}
    return checks.violations(landed, ["symbol", "trade_date"], rules, stored, within="trade_date")


@query("""SELECT 'text' AS column_name, count(*) FILTER (WHERE strlen(text) > 2000) AS n_misfits FROM documents
UNION ALL SELECT 'lang', count(*) FILTER (WHERE strlen(lang) > 1) FROM documents
UNION ALL SELECT 'l_extendedprice', count(*) FILTER (WHERE TRY_CAST(l_extendedprice AS DECIMAL(6,2)) IS NULL) FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE TRY_CAST(l_tax AS DECIMAL(6,2)) IS NULL) FROM lineitem""")
def check_column_fit(t: Tables) -> DataFrame:
    texts = {
        "text": numbers.fits_bytes(F.col("text"), 2000),
        "lang": numbers.fits_bytes(F.col("lang"), 1),
    }
    money = {c: numbers.fits_decimal(F.col(c), 6, 2) for c in ("l_extendedprice", "l_tax")}
    return checks.column_misfits(t.documents, texts).unionByName(checks.column_misfits(t.lineitem, money))


@query(f"""WITH {SQL_ORDERS} SELECT 'stored' AS batch, count(*) AS n_rows, count(*) = 0 AS is_empty FROM orders_d WHERE o_orderdate < DATE '{SPLIT}'
UNION ALL SELECT 'incoming', count(*), count(*) = 0 FROM orders_d WHERE o_orderdate >= DATE '{SPLIT}'
UNION ALL SELECT 'future', count(*), count(*) = 0 FROM orders_d WHERE o_orderdate >= DATE '2030-01-01'""")
def guard_nonempty(t: Tables) -> DataFrame:
    when = F.col("o_orderdate")
    slices = {
        "stored": when < day(SPLIT),
        "incoming": when >= day(SPLIT),
        "future": when >= day("2030-01-01"),
    }
    counts = checks.count_where(t.orders_by_day(), slices, "batch", "n_rows")
    return counts.withColumn("is_empty", F.col("n_rows") == 0)
