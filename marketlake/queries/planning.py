"""Scalars, calendar rules, watermarks and load plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import dates, numbers, text
from marketlake.operators import aggregates, joins
from marketlake.plans import units, windows
from marketlake.queries.base import (
    NOW,
    SPLIT,
    SQL_CALENDAR,
    SQL_EVENTS_2000,
    SQL_MARKS,
    TODAY,
    Tables,
    query,
)

today = lambda: F.lit(TODAY).cast("date")
now = lambda: F.lit(NOW).cast("timestamp_ntz")
day = lambda value: F.lit(value).cast("date")
SQL_TIME = "strftime(ts, '%H:%M:%S')"
SQL_DAY = "CAST(ts AS DATE)"
SQL_WEEKDAY = "(isodow(ts) - 1)"


def sql_minus(date: str, days: str) -> str:
    return f"CAST({date} - CAST({days} AS INTEGER) AS DATE)"


# --- text and number scalars -----------------------------------------------------------


@query("""SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS code6,
  lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(2, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS code2 FROM customer""")
def str_pad_code(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        key, text.pad_code(key, 6).alias("code6"), text.pad_code(key, 2).alias("code2")
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day,
  replace(replace(format('{:,}', CAST(o_totalprice * 100 AS BIGINT)), ',', ''), '-', '') AS amount FROM orders""")
def str_strip_chars(t: Tables) -> DataFrame:
    cents = F.format_number((F.col("o_totalprice") * 100).cast("decimal(20,0)"), 0)
    return t.orders.select(
        "o_orderkey",
        text.strip_chars(F.date_format("o_orderdate", "yyyy-MM-dd"), "/-").alias("day"),
        text.strip_chars(cents, ",-").alias("amount"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_discount AS rate, CAST(l_quantity AS DOUBLE) AS amount_10k FROM lineitem""")
def str_drop_unit(t: Tables) -> DataFrame:
    percent = F.concat(F.lit("  "), F.col("l_discount").cast("string"), F.lit("% "))
    wan = F.concat(F.col("l_quantity").cast("string"), F.lit("万"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        numbers.to_number(text.drop_unit(percent)).alias("rate"),
        numbers.to_number(text.drop_unit(wan)).alias("amount_10k"),
    )


@query("""SELECT page_id, regexp_extract(url, '[^./]*$') AS suffix, list_extract(string_split(url, '/'), -1) AS last FROM pages""")
def str_split_last(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select(
        "page_id",
        text.split_last(text.split_last(url, "."), "/").alias("suffix"),
        text.split_last(url, "/").alias("last"),
    )


@query("""SELECT p_partkey, string_split(p_name, ' ')[1] AS part0, string_split(p_name, ' ')[2] AS part1,
  string_split(p_name, ' ')[9] AS part8 FROM part""")
def str_split_parts(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        text.split_part(name, 0).alias("part0"),
        text.split_part(name, 1).alias("part1"),
        text.split_part(name, 8).alias("part8"),
    )


@query("""SELECT doc_id, left(text, list_max(list_filter(range(0, 33), lambda n: strlen(left(text, n)) <= 32))) AS short
FROM documents""")
def str_truncate_bytes(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.truncate_bytes(F.col("text"), 32).alias("short"))


@query("""SELECT doc_id, coalesce(TRY_CAST(CASE WHEN doc_id % 3 = 0 THEN lang ELSE CAST(n_chars AS VARCHAR) END AS BIGINT), -1) AS n,
  TRY_CAST(CASE WHEN doc_id % 2 = 0 THEN '-' ELSE CAST(n_chars AS VARCHAR) END AS DOUBLE) AS x FROM documents""")
def num_try_cast(t: Tables) -> DataFrame:
    chars = F.col("n_chars").cast("string")
    code = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(chars)
    return t.documents.select(
        "doc_id",
        F.coalesce(numbers.to_number(code, "bigint"), F.lit(-1)).alias("n"),
        numbers.to_number(F.when(F.col("doc_id") % 2 == 0, "-").otherwise(chars)).alias("x"),
    )


@query("""SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, 0) AS balance FROM customer""")
def num_default_zero(t: Tables) -> DataFrame:
    cell = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    return t.customer.select("c_custkey", numbers.zero_if_missing(cell).alias("balance"))


@query("""SELECT p_partkey,
  CASE WHEN base IN ('VARCHAR2', 'CHAR') THEN base || '(' || len || ')'
       WHEN base = 'NUMBER' AND prec IS NOT NULL
         THEN base || '(' || prec || CASE WHEN scale > 0 THEN ',' || scale ELSE '' END || ')'
       ELSE base END AS type_text,
  CASE WHEN p_retailprice < 950 THEN 'YES' ELSE 'NO' END AS nullable
FROM (SELECT p_partkey, p_retailprice, list_extract(['VARCHAR2', 'NUMBER', 'DATE', 'CHAR', 'NUMBER'], CAST(p_partkey % 5 + 1 AS INTEGER)) AS base,
             CAST(p_size AS VARCHAR) AS len, CAST(nullif(p_size % 7, 0) AS VARCHAR) AS prec, p_size % 3 AS scale FROM part)""")
def case_render_type(t: Tables) -> DataFrame:
    bases = F.array(*[F.lit(b) for b in ("VARCHAR2", "NUMBER", "DATE", "CHAR", "NUMBER")])
    base = F.get(bases, (F.col("p_partkey") % 5).cast("int"))
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        text.type_text(base, size, F.nullif(size % 7, F.lit(0)), size % 3).alias("type_text"),
        text.yes_no(F.col("p_retailprice") < 950).alias("nullable"),
    )


# --- date scalars ----------------------------------------------------------------------

SQL_ORDER_TEXT = """texts AS (SELECT o_orderkey, o_orderdate,
  CASE o_orderkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN strftime(o_orderdate, '%Y%m%d')
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS txt FROM orders)"""


def _date_texts(t: Tables) -> DataFrame:
    kind = F.col("o_orderkey") % 5
    shown = (
        F.when(kind == 0, "n/a")
        .when(kind == 1, F.date_format("o_orderdate", "yyyyMMdd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return t.orders.select("o_orderkey", "o_orderdate", shown.alias("txt"))


@query(f"""WITH {SQL_ORDER_TEXT} SELECT o_orderkey, CASE WHEN txt <> 'n/a' THEN CAST(o_orderdate AS DATE) END AS day,
  CASE WHEN txt <> 'n/a' THEN strftime(o_orderdate, '%Y%m%d') END AS day_text FROM texts""")
def date_parse_coerce(t: Tables) -> DataFrame:
    parsed = dates.parse_date(F.col("txt"), "yyyy-MM-dd", "yyyyMMdd")
    return _date_texts(t).select(
        "o_orderkey", parsed.alias("day"), F.date_format(parsed, "yyyyMMdd").alias("day_text")
    )


@query("""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_int,
  CAST(o_orderdate AS DATE) AS day FROM orders""")
def date_to_int(t: Tables) -> DataFrame:
    number = dates.date_to_int(F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey", number.alias("day_int"), dates.int_to_date(number).alias("day")
    )


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS local_day,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS compact_day FROM orders""")
def date_parse_text(t: Tables) -> DataFrame:
    local = F.date_format("o_orderdate", "yyyy年M月d日")
    compact = F.when(F.col("o_orderkey") % 4 == 0, "31131999").otherwise(F.date_format("o_orderdate", "ddMMyyyy"))
    return t.orders.select(
        "o_orderkey",
        dates.parse_text_date(local).alias("local_day"),
        dates.parse_date(compact, "ddMMyyyy").alias("compact_day"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0
  THEN last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)) END AS report_date FROM orders""")
def date_quarter_label(t: Tables) -> DataFrame:
    label = F.concat(
        F.year("o_orderdate").cast("string"), F.lit("年"),
        F.quarter("o_orderdate").cast("string"), F.lit("季度股票投资明细"),
    )
    label = F.when(F.col("o_orderkey") % 6 == 0, "明细").otherwise(label)
    return t.orders.select("o_orderkey", dates.quarter_label_end(label).alias("report_date"))


@query("""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS bar_time FROM events""")
def date_parse_ts(t: Tables) -> DataFrame:
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = dates.parse_timestamp(F.when(F.col("event_id") % 7 == 0, "later").otherwise(shown))
    return t.events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("bar_time"))


@query(f"""SELECT o_orderkey, strftime(o_orderdate + INTERVAL 10 DAY, '%Y%m%d') AS later,
  strftime(o_orderdate - INTERVAL 40 DAY, '%Y%m%d') AS earlier,
  least(CAST(o_orderdate AS DATE), DATE '{SPLIT}') AS low, greatest(CAST(o_orderdate AS DATE), DATE '{SPLIT}') AS high
FROM orders""")
def date_shift_minmax(t: Tables) -> DataFrame:
    shown = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select(
        "o_orderkey",
        dates.shift_text_date(shown, 10).alias("later"),
        dates.shift_text_date(shown, -40).alias("earlier"),
        F.least(F.to_date("o_orderdate"), day(SPLIT)).alias("low"),
        F.greatest(F.to_date("o_orderdate"), day(SPLIT)).alias("high"),
    )


# --- calendar rules over a column of clock values --------------------------------------


@query(f"""SELECT event_id,
  CASE WHEN {SQL_TIME} > '16:30:00' THEN {SQL_DAY} ELSE {sql_minus(SQL_DAY, '1')} END AS cutoff,
  CASE WHEN {SQL_TIME} > '15:30:00' THEN {SQL_DAY} ELSE {sql_minus(SQL_DAY, '1')} END AS board_cutoff,
  CASE WHEN {SQL_TIME} >= '16:30:00' THEN {SQL_DAY} ELSE {sql_minus(SQL_DAY, '1')} END AS value_cutoff FROM events""")
def cal_day_cutoff(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        dates.day_cutoff(ts).alias("cutoff"),
        dates.day_cutoff(ts, dates.BOARD_CLOSE).alias("board_cutoff"),
        dates.day_cutoff(ts, closing_counts=True).alias("value_cutoff"),
    )


@query(f"""SELECT event_id, CASE WHEN {SQL_WEEKDAY} < 5 OR ({SQL_WEEKDAY} = 5 AND {SQL_TIME} < '16:30:00')
  THEN {sql_minus(SQL_DAY, SQL_WEEKDAY + ' + 3')} ELSE {sql_minus(SQL_DAY, SQL_WEEKDAY + ' - 4')} END AS friday FROM events""")
def cal_last_friday(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.last_friday(F.col("ts")).alias("friday"))


@query(f"""SELECT event_id, {sql_minus(SQL_DAY, SQL_WEEKDAY + ' + 3')} AS friday FROM events""")
def cal_prev_week_friday(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.prev_week_friday(F.col("ts")).alias("friday"))


@query("""SELECT event_id, CAST(date_trunc('month', ts) - INTERVAL 1 DAY AS DATE) AS month_end FROM events""")
def cal_prev_month_end(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.prev_month_end(F.col("ts")).alias("month_end"))


@query(f"""SELECT event_id,
  (last < yesterday AND (tm > '15:00:00' OR tm < '06:00:00')) OR (last = yesterday AND tm > '15:00:00') AS gate,
  (last < yesterday AND (tm > '15:00:00' OR tm < '6:00:00')) OR (last = yesterday AND tm > '15:00:00') AS compat_gate
FROM (SELECT event_id, {SQL_TIME} AS tm, {sql_minus(SQL_DAY, '1')} AS yesterday,
             {sql_minus(SQL_DAY, 'event_id % 3')} AS last FROM events)""")
def cal_snapshot_gate(t: Tables) -> DataFrame:
    ts = F.col("ts")
    last = F.date_sub(F.to_date(ts), (F.col("event_id") % 3).cast("int"))
    return t.events.select(
        "event_id",
        dates.snapshot_gate(last, ts).alias("gate"),
        dates.snapshot_gate(last, ts, compat=True).alias("compat_gate"),
    )


SQL_ASOF = """(SELECT max(trade_date) FROM calendar WHERE trade_date {op} {day})"""


@query(f"""WITH {SQL_EVENTS_2000}, {SQL_CALENDAR}
SELECT event_id, {SQL_ASOF.format(op='<=', day='CAST(now AS DATE)')} AS asof_date FROM clocks""")
def join_asof_calendar(t: Tables) -> DataFrame:
    clocks = t.events_2000().withColumn("day", F.to_date("now"))
    return joins.asof_join(clocks, "day", t.calendar()).select("event_id", "asof_date")


@query(f"""WITH {SQL_EVENTS_2000}, {SQL_CALENDAR}
SELECT event_id, {SQL_ASOF.format(op='<', day='CAST(now AS DATE)')} AS asof_date FROM clocks""")
def join_asof_calendar_strict(t: Tables) -> DataFrame:
    clocks = t.events_2000().withColumn("day", F.to_date("now"))
    dated = joins.asof_join(clocks, "day", t.calendar())
    return dated.select("event_id", F.col("before_date").alias("asof_date"))


def _sql_intraday(opening: str) -> str:
    return f"""CASE WHEN tm > '16:30:00' THEN strftime(last_day_, '%Y-%m-%d') || ' 15:00:00'
       WHEN tm < '{opening}' THEN strftime(prev_day_, '%Y-%m-%d') || ' 15:00:00'
       ELSE strftime(now, '%Y-%m-%d %H:') || CASE WHEN minute(now) < 30 THEN '00' ELSE '30' END || ':00' END"""


@query(f"""WITH {SQL_EVENTS_2000}, {SQL_CALENDAR}, dated AS (
  SELECT event_id, now, strftime(now, '%H:%M:%S') AS tm,
    {SQL_ASOF.format(op='<=', day='CAST(now AS DATE)')} AS last_day_,
    {SQL_ASOF.format(op='<=', day='CAST(now AS DATE) - 1')} AS prev_day_ FROM clocks)
SELECT event_id, {_sql_intraday('09:30:00')} AS cutoff, {_sql_intraday('9:30:00')} AS compat_cutoff FROM dated""")
def cal_intraday_cutoff(t: Tables) -> DataFrame:
    """The day before today and "strictly before today" name the same trading date."""
    clocks = t.events_2000().withColumn("day", F.to_date("now"))
    clocks = joins.asof_join(clocks, "day", t.calendar())
    args = (F.col("now"), F.col("asof_date"), F.col("before_date"))
    return clocks.select(
        "event_id",
        dates.intraday_cutoff(*args).alias("cutoff"),
        dates.intraday_cutoff(*args, compat=True).alias("compat_cutoff"),
    )


# --- watermarks ------------------------------------------------------------------------


@query(f"""SELECT coalesce(max(CAST(l_shipdate AS DATE)) FILTER (WHERE l_shipdate < TIMESTAMP '{SPLIT}'), DATE '1990-01-01') AS watermark,
  coalesce(max(CAST(l_shipdate AS DATE)) FILTER (WHERE l_shipdate < TIMESTAMP '1980-01-01'), DATE '1990-01-01') AS empty_watermark
FROM lineitem""")
def agg_watermark_global(t: Tables) -> DataFrame:
    ship = t.lineitem.select(F.to_date("l_shipdate").alias("trade_date"))
    stored = ship.filter(F.col("trade_date") < day(SPLIT))
    nothing = ship.filter(F.col("trade_date") < day("1980-01-01"))
    mark = aggregates.watermark(stored, "trade_date", "1990-01-01")
    empty = aggregates.watermark(nothing, "trade_date", "1990-01-01")
    return mark.select("watermark", empty.scalar().alias("empty_watermark"))


@query(f"""SELECT c_custkey AS symbol, coalesce(max(CAST(o_orderdate AS DATE)), DATE '1990-01-01') AS watermark
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01') o ON c_custkey = o_custkey
GROUP BY 1""")
def agg_watermark_keyed(t: Tables) -> DataFrame:
    stored = t.orders.filter(F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz"))
    stored = stored.select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("d"))
    universe = t.customer.select(F.col("c_custkey").alias("symbol"))
    return aggregates.keyed_watermark(universe, stored, "symbol", "d", day("1990-01-01"))


@query("""SELECT c_custkey AS symbol, strftime(coalesce(max(ts), TIMESTAMP '2024-02-01 17:00:00' - INTERVAL 50 DAY), '%Y-%m-%d %H:%M:%S') AS watermark
FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY 1""")
def agg_watermark_relative(t: Tables) -> DataFrame:
    universe = t.customer.select(F.col("c_custkey").alias("symbol"))
    stored = t.events.select(F.col("user_id").alias("symbol"), "ts")
    clock = F.lit("2024-02-01 17:00:00").cast("timestamp_ntz")
    return windows.relative_watermark(universe, stored, "symbol", "ts", clock)


@query("""SELECT s_suppkey AS fund_code, coalesce(last, DATE '2010-03-31') AS watermark
FROM supplier LEFT JOIN (SELECT l_suppkey, max(last_day(CAST(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH AS DATE))) AS last
  FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey AND s_acctbal > 5000""")
def agg_watermark_parent(t: Tables) -> DataFrame:
    """The watermark is a column of the parent table; here the parent is put together first, and
    funds with a low balance have no date yet."""
    last = t.holdings().groupBy("fund_code").agg(F.max("report_date").alias("last"))
    parent = t.supplier.select(F.col("s_suppkey").alias("fund_code"), "s_acctbal").join(last, "fund_code", "left")
    latest = F.when(F.col("s_acctbal") > 5000, F.col("last"))
    return parent.select("fund_code", F.coalesce(latest, day("2010-03-31")).alias("watermark"))


@query(f"""WITH {SQL_CALENDAR}, starts AS (
  SELECT r_name AS market, unnest(generate_series(DATE '1995-01-01' + r_regionkey, DATE '{TODAY}', INTERVAL 365 DAY)) AS s FROM region),
batches AS (SELECT market, CAST(s AS DATE) AS window_start, least(CAST(s AS DATE) + 364, DATE '{TODAY}') AS window_end FROM starts)
SELECT market, window_start, min(trade_date) AS first_date, max(trade_date) AS last_date
FROM batches JOIN calendar ON trade_date BETWEEN window_start AND window_end GROUP BY 1, 2""")
def agg_batch_bounds(t: Tables) -> DataFrame:
    start = F.date_add(day("1995-01-01"), F.col("r_regionkey"))
    markets = t.region.select(F.col("r_name").alias("market"), start.alias("start"))
    batches = windows.explode_windows(markets, dates.split_range(F.col("start"), today(), 365))
    days = joins.calendar_days(batches, t.calendar(), F.col("window_start"), F.col("window_end"))
    return aggregates.batch_bounds(days, ["market", "window_start"], "trade_date")


# --- load plans ------------------------------------------------------------------------


@query(f"""WITH {SQL_MARKS}, {SQL_CALENDAR}, universe AS (
  SELECT s_suppkey AS symbol, coalesce(CASE WHEN s_suppkey % 9 <> 0 THEN watermark END, DATE '1970-01-01') AS watermark
  FROM supplier LEFT JOIN marks ON s_suppkey = symbol)
SELECT symbol, trade_date FROM universe JOIN calendar
  ON trade_date >= greatest(watermark + 1, DATE '2000-06-15') AND trade_date <= DATE '{TODAY}'""")
def join_plan_symbol_dates(t: Tables) -> DataFrame:
    universe = t.supplier.select(F.col("s_suppkey").alias("symbol"))
    known = t.supplier_marks().select("symbol", F.when(F.col("symbol") % 9 != 0, F.col("watermark")).alias("d"))
    marks = aggregates.keyed_watermark(universe, known, "symbol", "d", day("1970-01-01"))
    floor = F.add_months(today(), -12)
    return windows.symbol_dates(marks, t.calendar(), today(), floor).select("symbol", "trade_date")


@query(f"""WITH {SQL_MARKS}, {SQL_CALENDAR}
SELECT symbol, count(*) FILTER (WHERE trade_date > watermark) AS n_open_left,
  count(*) FILTER (WHERE trade_date < watermark + 45) AS n_open_right, count(*) AS n_closed
FROM marks JOIN calendar ON trade_date BETWEEN watermark AND watermark + 45 GROUP BY 1""")
def join_range_calendar(t: Tables) -> DataFrame:
    """The three kinds of bounds in one pass over each key's days."""
    marks = t.supplier_marks().withColumn("until", F.date_add("watermark", 45))
    days = joins.calendar_days(marks, t.calendar(), F.col("watermark"), F.col("until"))
    return days.groupBy("symbol").agg(
        F.count_if(F.col("trade_date") > F.col("watermark")).alias("n_open_left"),
        F.count_if(F.col("trade_date") < F.col("until")).alias("n_open_right"),
        F.count(F.lit(1)).alias("n_closed"),
    )


@query(f"""WITH {SQL_MARKS} SELECT symbol, CAST(watermark + 1 AS DATE) AS next_day, CAST(watermark + 7 AS DATE) AS next_week,
  CAST(watermark + INTERVAL 4 MONTH AS DATE) AS next_report FROM marks""")
def plan_next_start(t: Tables) -> DataFrame:
    mark = F.col("watermark")
    return t.supplier_marks().select(
        "symbol",
        dates.next_start(mark, days=1).alias("next_day"),
        dates.next_start(mark, weeks=1).alias("next_week"),
        dates.next_start(mark, months=4).alias("next_report"),
    )


@query(f"""WITH {SQL_MARKS} SELECT symbol, greatest(CAST(watermark + 1 AS DATE), DATE '1998-10-01') AS fixed_floor,
  greatest(CAST(watermark + 1 AS DATE), CAST(DATE '1999-10-15' - INTERVAL 1 YEAR AS DATE)) AS year_floor FROM marks""")
def plan_start_floor(t: Tables) -> DataFrame:
    start = dates.next_start(F.col("watermark"), days=1)
    year_ago = F.add_months(day("1999-10-15"), -12)
    return t.supplier_marks().select(
        "symbol",
        dates.start_floor(start, day("1998-10-01")).alias("fixed_floor"),
        dates.start_floor(start, year_ago).alias("year_floor"),
    )


@query(f"""WITH {SQL_MARKS} SELECT symbol, watermark + 1 <= DATE '1998-10-01' AS due_daily, watermark < DATE '1998-10-01' AS due_adjusted,
  watermark + 7 < DATE '1998-10-01' AS due_weekly, CAST(watermark + INTERVAL 4 MONTH AS DATE) <= DATE '1999-02-01' AS due_report FROM marks""")
def plan_due(t: Tables) -> DataFrame:
    mark, end = F.col("watermark"), day("1998-10-01")
    return t.supplier_marks().select(
        "symbol",
        dates.due(dates.next_start(mark, days=1), end, inclusive=True).alias("due_daily"),
        dates.due(mark, end, inclusive=False).alias("due_adjusted"),
        dates.due(dates.next_start(mark, weeks=1), end, inclusive=False).alias("due_weekly"),
        dates.due(dates.next_start(mark, months=4), day("1999-02-01"), inclusive=True).alias("due_report"),
    )


@query(f"""WITH {SQL_MARKS}, q AS (
  SELECT symbol, fwd, unnest(generate_series(CAST(date_trunc('quarter', watermark) + to_months(2 + 3 * fwd) AS DATE),
    DATE '2001-05-31', INTERVAL 3 MONTH)) AS m FROM marks, (VALUES (-1), (0)) f(fwd))
SELECT symbol, fwd AS forward, last_day(CAST(m AS DATE)) AS report_date FROM q""")
def plan_quarters(t: Tables) -> DataFrame:
    marks = t.supplier_marks()
    plans = [
        windows.explode_dates(marks, dates.quarter_ends(F.col("watermark"), today(), fwd), "report_date")
        .withColumn("forward", F.lit(fwd))
        for fwd in (-1, 0)
    ]
    return plans[0].unionByName(plans[1]).select("symbol", "forward", "report_date")


@query(f"""WITH {SQL_MARKS} SELECT symbol, CAST(unnest(generate_series(CAST(date_trunc('month', watermark) + INTERVAL 1 MONTH AS DATE),
  DATE '2001-05-01', INTERVAL 1 MONTH)) AS DATE) AS month FROM marks""")
def plan_months(t: Tables) -> DataFrame:
    months = dates.month_starts(F.add_months("watermark", 1), F.add_months(today(), -1))
    return windows.explode_dates(t.supplier_marks(), months, "month").select("symbol", "month")


SQL_MONTH_GAP = "CAST(date_trunc('month', DATE '1999-06-01' + to_months(CAST(symbol % 24 AS INTEGER))) AS DATE)"


@query(f"""WITH {SQL_MARKS}, plan AS (
  SELECT symbol, CAST(unnest(generate_series(CAST(date_trunc('month', watermark) + INTERVAL 1 MONTH AS DATE),
    DATE '2001-05-01', INTERVAL 1 MONTH)) AS DATE) AS month FROM marks),
have AS (SELECT DISTINCT l_suppkey AS symbol, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem),
gaps AS (SELECT p.symbol, min(p.month) AS gap FROM plan p LEFT JOIN have h ON p.symbol = h.symbol AND p.month = h.month
  AND h.month <> CAST(DATE '1999-06-01' + to_months(CAST(h.symbol % 24 AS INTEGER)) AS DATE)
  WHERE h.symbol IS NULL GROUP BY 1)
SELECT symbol, month FROM plan LEFT JOIN gaps USING (symbol) WHERE gap IS NULL OR month < gap""")
def plan_until_gap(t: Tables) -> DataFrame:
    months = dates.month_starts(F.add_months("watermark", 1), F.add_months(today(), -1))
    plan = windows.explode_dates(t.supplier_marks(), months, "month")
    removed = F.add_months(day("1999-06-01"), (F.col("symbol") % 24).cast("int"))
    have = (
        t.lineitem.select(
            F.col("l_suppkey").alias("symbol"), F.trunc(F.to_date("l_shipdate"), "month").alias("month")
        )
        .distinct()
        .filter(F.col("month") != removed)
        .withColumn("present", F.lit(True))
    )
    checked = plan.join(have, ["symbol", "month"], "left").fillna(False, ["present"])
    return windows.until_gap(checked, "symbol", "month", "present").select("symbol", "month")


@query(f"""WITH {SQL_MARKS}, s AS (
  SELECT symbol, CAST(unnest(generate_series(watermark + 7, DATE '{TODAY}', INTERVAL 70 DAY)) AS DATE) AS window_start FROM marks)
SELECT symbol, window_start, least(CAST(window_start + 69 AS DATE), DATE '{TODAY}') AS window_end FROM s""")
def plan_split_range(t: Tables) -> DataFrame:
    pieces = dates.split_range(dates.next_start(F.col("watermark"), weeks=1), today(), 70)
    return windows.explode_windows(t.supplier_marks(), pieces).select("symbol", "window_start", "window_end")


@query(f"""WITH {SQL_MARKS}, d AS (
  SELECT symbol, CAST(unnest(generate_series(greatest(watermark + 1, DATE '2000-06-15'), DATE '2001-06-14', INTERVAL 1 DAY)) AS DATE) AS trade_date FROM marks)
SELECT symbol, trade_date FROM d WHERE isodow(trade_date) < 6""")
def plan_business_days(t: Tables) -> DataFrame:
    start = dates.start_floor(dates.next_start(F.col("watermark"), days=1), F.add_months(today(), -12))
    days = dates.business_days(start, F.date_sub(today(), 1))
    return windows.explode_dates(t.supplier_marks(), days, "trade_date").select("symbol", "trade_date")


@query(f"""WITH {SQL_MARKS}, b AS (
  SELECT symbol, CASE WHEN symbol % 4 = 0 THEN DATE '1997-12-31' ELSE watermark END AS watermark,
         CASE WHEN symbol % 5 = 0 THEN DATE '2001-01-20' ELSE DATE '{TODAY}' END AS run FROM marks)
SELECT symbol, CAST(unnest(generate_series(year(watermark) + CASE WHEN strftime(watermark, '%m%d') = '1231' THEN 1 ELSE 0 END,
  year(run) - CASE WHEN strftime(run, '%m%d') < '0131' THEN 1 ELSE 0 END)) AS INTEGER) AS year FROM b""")
def plan_years(t: Tables) -> DataFrame:
    marks = t.supplier_marks().withColumns(
        {
            "watermark": F.when(F.col("symbol") % 4 == 0, day("1997-12-31")).otherwise(F.col("watermark")),
            "run": F.when(F.col("symbol") % 5 == 0, day("2001-01-20")).otherwise(today()),
        }
    )
    years = dates.holding_years(F.col("watermark"), F.col("run"))
    return windows.explode_dates(marks, years, "year").select("symbol", "year")


@query("""WITH loaded AS (SELECT DISTINCT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS d FROM lineitem
  WHERE isodow(l_shipdate) < 6 AND l_shipdate < TIMESTAMP '1999-01-01' AND (l_suppkey + month(l_shipdate)) % 4 > 0),
due AS (SELECT s_suppkey AS symbol, CAST(unnest(generate_series(DATE '1998-10-03' - CAST(s_suppkey % 30 AS INTEGER), DATE '1998-12-27',
  INTERVAL 1 DAY)) AS DATE) AS d FROM supplier),
missing AS (SELECT symbol, d, 5 * CAST(floor(date_diff('day', DATE '1970-01-05', d) / 7.0) AS BIGINT) + isodow(d) AS n
  FROM due ANTI JOIN loaded USING (symbol, d) WHERE isodow(d) < 6),
runs AS (SELECT symbol, d, n - row_number() OVER (PARTITION BY symbol ORDER BY d) AS run FROM missing)
SELECT symbol, min(d) AS "start", max(d) AS "end" FROM runs GROUP BY symbol, run""")
def plan_gaps(t: Tables) -> DataFrame:
    """Business days that are due and not loaded, per symbol as ranges: loads of every month but each
    fourth one, kept as the intervals that every month's load brought."""
    shipped = t.lineitem.select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("trade_date"))
    shipped = shipped.filter((F.col("trade_date") < SPLIT) & ((F.col("symbol") + F.month("trade_date")) % 4 > 0))
    # a month's load brings its own intervals; neighbouring months adjoin
    months = shipped.withColumn("_load", F.concat_ws("-", "symbol", F.date_format("trade_date", "yyyyMM")))
    own = units.islands(months, "_load", "trade_date")
    kept = units.united(own.withColumn("symbol", F.split("_load", "-")[0].cast("bigint")), "symbol")
    first = F.date_sub(day("1998-10-03"), (F.col("s_suppkey") % 30).cast("int"))
    due = t.supplier.select(F.col("s_suppkey").alias("symbol"), first.alias("start"), day("1998-12-27").alias("end"))
    return units.gaps(due, kept, "symbol")
