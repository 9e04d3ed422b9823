"""Loads from landed payloads: report files, HTML pages and JSON, each with rows that no table can take."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import schema
from marketlake.functions import text
from marketlake.plans import runner
from marketlake.queries.base import SQL_CALENDAR, Tables, query
from marketlake.queries.landed import SQL_CUSTODY, custody_day, custody_page
from marketlake.session import scratch_dir
from marketlake.sources import landing, pages
from marketlake.sources.tables import Lake


def _load(t: Tables, lake: Lake, spec: schema.DatasetSpec, judged: DataFrame, clocks: list[datetime], **given) -> runner.Context:
    """The same landing, read and judged again by a run at each clock."""
    for now in clocks:
        context = runner.Context(lake, t.calendar(), now)
        rows, _ = runner.accept(context, spec, judged)
        runner.run(context, spec, rows, **given)
    return context


def _with_rejects(context: runner.Context, stored: DataFrame) -> DataFrame:
    """Stored rows, and the rejects per reason; ``raw`` is kept where it is short."""
    short = F.when(F.length("raw") <= 60, F.col("raw")).alias("raw")
    bad = runner.rejects_table(context).read_batches().groupBy("reason", short).agg(F.sum("n_rows").alias("n_rows"))
    stored = stored.withColumn("n_rows", F.lit(1).cast("long"))
    return stored.unionByName(bad, allowMissingColumns=True)


@query("""WITH d AS (SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS s, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS shares FROM lineitem
  WHERE isodow(l_shipdate) = 5 GROUP BY 1, 2)
SELECT lpad(CAST(s AS VARCHAR), CAST(greatest(5, length(CAST(s AS VARCHAR))) AS INTEGER), '0') AS symbol, d AS trade_date, shares AS short_shares,
  CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS raw, CAST(1 AS BIGINT) AS n_rows FROM d
  WHERE s % 7 <> 0 AND s % 5 <> 0 AND d BETWEEN DATE '1998-01-02' AND DATE '2001-06-08'
UNION ALL SELECT NULL, NULL, NULL, 'trade_date', 'n/a,' || s || ',Co, Ltd,' || shares || ',' || shares * 2, CAST(count(*) AS BIGINT) FROM d WHERE s % 7 = 0 GROUP BY s, shares
UNION ALL SELECT NULL, NULL, NULL, 'fields', 'broken line of ' || r_name, CAST(1 AS BIGINT) FROM region""")
def maintain_short_positions(t: Tables) -> DataFrame:
    """Weekly short-position reports as CSV files, loaded in two runs. Every seventh company's lines have
    no date, a file holds lines with one field; every fifth company's positions are zero, which is no reject."""
    lake, spec = Lake(t.spark, scratch_dir(t.spark, "short")), replace(schema.REGISTRY["stock_hk_short_sale"], default="1997-12-26")
    weekly = t.trades().filter(F.weekday("trade_date") == 4).groupBy("trade_date", "symbol").agg(F.sum("volume").alias("shares"))
    shares = F.when((F.col("symbol") % 5 == 0) & (F.col("symbol") % 7 != 0), 0).otherwise(F.col("shares"))
    fields = {
        "Date": F.when(F.col("symbol") % 7 == 0, "n/a").otherwise(F.date_format("trade_date", "dd/MM/yyyy")),
        "Stock Code": F.col("symbol"),
        "Stock Name": F.lit("Co, Ltd"),
        "Shares": shares,
        "Value": shares * 2,
    }
    folders = [f"{lake.root}/landing/{name}" for name in ("reports", "broken")]
    lines = weekly.select(*[v.cast("string").alias(n) for n, v in fields.items()])
    broken = t.region.select(F.concat(F.lit("broken line of "), "r_name").alias("Date"))
    for frame, folder in zip((lines, broken), folders):
        frame.write.option("header", True).csv(folder)
    judged = landing.judged_short_positions(landing.read_short_lines(t.spark, *folders))
    context = _load(t, lake, spec, judged, [datetime(2000, 1, 12, 9), datetime(2001, 6, 15, 9)])
    return _with_rejects(context, runner.stored_rows(context, spec).select("symbol", "trade_date", "short_shares"))


def _landed_pages(t: Tables, lake: Lake, html: Column) -> DataFrame:
    t.spread(t.part).select(html.alias("html")).write.parquet(f"{lake.root}/landing")
    return landing.read_landing(t.spark, f"{lake.root}/landing")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS symbol, CAST(DATE '2000-01-03' + CAST(p_size AS INTEGER) AS DATE) AS trade_date,
  CAST(round_even(CAST(p_retailprice AS DECIMAL(18,2)), 0) AS BIGINT) AS amount_10k, CAST(NULL AS VARCHAR) AS reason,
  CAST(NULL AS VARCHAR) AS raw, CAST(1 AS BIGINT) AS n_rows FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 7 <> 0
UNION ALL SELECT NULL, NULL, NULL, 'cells', '<td>short</td>', CAST(count(*) AS BIGINT) FROM part
UNION ALL SELECT NULL, NULL, NULL, 'trade_date', NULL, CAST(count(*) AS BIGINT) FROM part WHERE p_partkey % 7 = 0""")
def maintain_short_turnover(t: Tables) -> DataFrame:
    """Turnover pages, one per part, loaded for every second symbol in two runs. Each page has a row with
    one cell, and every seventh page's row has no date."""
    lake, spec = Lake(t.spark, scratch_dir(t.spark, "turnover")), schema.REGISTRY["stock_hk_short_sale_em"]
    cell = lambda v, unit="": F.concat(F.lit("<td><span>"), v.cast("string"), F.lit(f"{unit}</span></td>"))
    shown = F.date_add(F.lit("2000-01-03").cast("date"), F.col("p_size")).cast("string")
    html = F.concat(
        F.lit("<table><tbody><tr>"), cell(F.lit(1)), cell(F.col("p_partkey")), cell(F.lit("A&amp;B")), cell(F.lit("-")),
        cell(F.col("p_size") * 1000), cell(F.lit("16.5")), cell(F.col("p_size"), "万"), cell(F.col("p_retailprice"), "万"),
        cell(F.lit("3.48"), "%"), cell(F.when(F.col("p_partkey") % 7 == 0, "?").otherwise(shown)),
        F.lit("</tr><tr><td>short</td></tr></tbody></table>"),
    )
    judged = pages.judged_short_turnover(_landed_pages(t, lake, html))
    symbols = t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("symbol"))
    context = _load(t, lake, spec, judged, [datetime(2000, 2, 1, 17), datetime(2000, 3, 1, 17)], universe=symbols)
    return _with_rejects(context, runner.stored_rows(context, spec).select("symbol", "trade_date", "amount_10k"))


@query("""SELECT 'stock_' || p_partkey AS interface, 'http://' || p_brand AS url, DATE '2000-01-04' AS load_date, CAST(NULL AS VARCHAR) AS reason,
  CAST(NULL AS VARCHAR) AS raw, CAST(1 AS BIGINT) AS n_rows FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 5 <> 0
UNION ALL SELECT NULL, NULL, NULL, CASE WHEN p_partkey % 2 = 0 THEN 'url' ELSE 'label' END, NULL, CAST(count(*) AS BIGINT)
FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 5 = 0 GROUP BY ALL""")
def maintain_catalogue(t: Tables) -> DataFrame:
    """The interface catalogue, one page per part, taken on two days. Every fourth page describes another kind
    of interface; every fifth lacks its address, or the label of it."""
    lake, spec = Lake(t.spark, scratch_dir(t.spark, "catalogue")), schema.REGISTRY["stock_table_api_summary"]
    key, (name, url, description, note) = F.col("p_partkey"), pages.CATALOGUE_LABELS
    kind = F.when(key % 4 == 0, "fund_").otherwise("stock_")
    address = F.concat(F.lit(url), F.lit("http://"), "p_brand")
    address = F.when(key % 10 == 0, url).when(key % 5 == 0, "nothing").otherwise(address)
    line = lambda value: F.concat(F.lit("<p>"), value, F.lit("</p>"))
    html = F.concat(
        F.lit('<body><section id="x"><h3>t<a href="#">¶</a></h3>'), line(F.concat(F.lit(name), kind, key.cast("string"))), line(address),
        line(F.concat(F.lit(description), "p_type")), line(F.concat(F.lit(note), F.col("p_size").cast("string"))),
        F.lit("<p>in</p><p>out</p></section><section><p>short</p></section></body>"),
    )
    judged = pages.judged_catalogue(_landed_pages(t, lake, html))
    context = _load(t, lake, spec, judged, [datetime(2000, 1, 3, 9), datetime(2000, 1, 4, 9)])
    return _with_rejects(context, runner.stored_rows(context, spec).select("interface", "url", "load_date"))


@query(f"""WITH {SQL_CALENDAR}, d AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS trade_date,
  max(CAST(l_extendedprice AS DECIMAL(10,2))) AS close FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2)
SELECT symbol, trade_date, CAST(close AS DOUBLE) AS close, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS raw, CAST(1 AS BIGINT) AS n_rows
  FROM d WHERE trade_date IN (SELECT trade_date FROM calendar) AND trade_date <= DATE '2000-06-15' AND CAST(symbol AS BIGINT) % 9 <> 0
UNION ALL SELECT NULL, NULL, NULL, 'payload', '{{"result": ', CAST(count(*) AS BIGINT) FROM region
UNION ALL SELECT NULL, NULL, NULL, 'trade_date', 'n/a,' || symbol || ',' || symbol || '.SZ,,1,,,,' || close || ',,,,,,,,,,', CAST(count(*) AS BIGINT)
  FROM d WHERE CAST(symbol AS BIGINT) % 9 = 0 GROUP BY symbol, close""")
def maintain_valuation(t: Tables) -> DataFrame:
    """Valuation payloads, one per company and month, loaded in two runs, trading day by trading day. Every
    ninth company's rows have no date, and some payloads are cut off."""
    lake = Lake(t.spark, scratch_dir(t.spark, "valuation"))
    spec = replace(schema.REGISTRY["stock_value_em"], default="1997-12-31")
    daily = t.trades().filter(F.col("trade_date") >= "1998-01-01").groupBy("symbol", "trade_date").agg(F.max("price").alias("close"))
    code = F.col("symbol").cast("string")
    element = F.struct(
        F.when(F.col("symbol") % 9 == 0, "n/a").otherwise(F.col("trade_date").cast("string")).alias("TRADE_DATE"),
        code.alias("SECURITY_CODE"), F.concat(code, F.lit(".SZ")).alias("SECUCODE"), F.lit("1").alias("BOARD_CODE"),
        F.col("close").cast("string").alias("CLOSE_PRICE"),
    )
    # a company has one row a day: a month's payload is bounded
    monthly = daily.groupBy("symbol", F.trunc("trade_date", "month").alias("month")).agg(F.collect_list(element).alias("data"))
    whole = monthly.select(F.to_json(F.struct(F.struct("data").alias("result"))).alias("body"))
    whole.unionByName(t.region.select(F.lit('{"result": ').alias("body"))).write.parquet(f"{lake.root}/landing")
    judged = landing.judged_valuations(landing.read_landing(t.spark, f"{lake.root}/landing"))
    context = _load(t, lake, spec, judged, [datetime(1999, 1, 5, 9), datetime(2000, 6, 15, 17)])
    stored = runner.stored_rows(context, spec).select("symbol", "trade_date", F.col("close").cast("double").alias("close"))
    return _with_rejects(context, stored)


@query(f"""WITH {SQL_CUSTODY}, due AS (SELECT * FROM c WHERE isodow(trade_date) < 6 AND p_partkey % 2 = 0)
SELECT symbol, CAST(trade_date AS DATE) AS trade_date, 'C' || p_size || ' Broker' AS label, CAST(1000 + p_partkey AS BIGINT) * 1000 AS holding, CAST(NULL AS VARCHAR) AS reason,
  CAST(NULL AS VARCHAR) AS raw, CAST(1 AS BIGINT) AS n_rows FROM due
UNION ALL SELECT symbol, CAST(trade_date AS DATE), p_type, CAST(1000 + p_partkey AS BIGINT) * 1000, NULL, NULL, 1 FROM due
UNION ALL SELECT NULL, NULL, NULL, NULL, 'holding', NULL, CAST(count(*) AS BIGINT) FROM c""")
def maintain_custody_pages(t: Tables) -> DataFrame:
    """Custody pages parsed once into both tables, for every second symbol in two runs. The bank's holding
    on each page cannot be read; every sixth page answers another date and is left out."""
    lake = Lake(t.spark, scratch_dir(t.spark, "custody-pages"))
    summary, detail = (schema.REGISTRY[f"stock_hk_ccass_records{n}"] for n in ("_summary", ""))
    t.spread(t.part).select(custody_day().alias("asked_date"), custody_page(F.lit("n/a")).alias("html")).write.parquet(f"{lake.root}/landing")
    judged = pages.judged_custody(landing.read_landing(t.spark, f"{lake.root}/landing"))
    symbols = t.part.filter("p_partkey % 2 = 0").select(text.pad_code(F.col("p_partkey"), 5).alias("symbol"))
    for now in (datetime(2000, 2, 1, 9), datetime(2000, 3, 1, 9)):
        context = runner.Context(lake, t.calendar(), now)
        rows, _ = runner.accept(context, detail, judged)
        runner.run_pair(context, (summary, pages.custody_summary(rows)), (detail, pages.custody_detail(rows)), symbols)
    participant = F.concat_ws(" ", "participant_id", "participant_name")
    head = ["symbol", F.col("trade_date")]
    stored = runner.stored_rows(context, detail).select(*head, participant.alias("label"), "holding").unionByName(
        runner.stored_rows(context, summary).select(*head, F.col("holder_type").alias("label"), "holding")
    )
    return _with_rejects(context, stored)
