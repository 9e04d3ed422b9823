"""Landed payloads: CSV lines, JSON and HTML, as pages of the driver tables or rendered from
their rows by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import text
from marketlake.queries.base import Tables, query
from marketlake.sources import landing, pages


@query("""SELECT CAST(l_shipdate AS DATE) AS trade_date, lpad(CAST(l_suppkey AS VARCHAR), CAST(greatest(5, length(CAST(l_suppkey AS VARCHAR))) AS INTEGER), '0') AS symbol,
  'Stock, ' || l_returnflag AS symbol_name, CAST(l_quantity AS BIGINT) - 10 AS short_shares, CAST(round(l_extendedprice) AS BIGINT) AS short_value
FROM lineitem WHERE l_quantity > 10""")
def land_csv_reports(t: Tables) -> DataFrame:
    """Report lines rendered from the trades, with a quoted comma in the name."""
    line = F.concat_ws(
        ",",
        F.date_format("l_shipdate", "dd/MM/yyyy"),
        F.col("l_suppkey").cast("string"),
        F.concat(F.lit('"Stock, '), F.col("l_returnflag"), F.lit('"')),
        (F.col("l_quantity").cast("bigint") - 10).cast("string"),
        F.round("l_extendedprice").cast("bigint").cast("string"),
    )
    return landing.parse_short_report_lines(t.lineitem.select(line.alias("line")), "line")


SQL_PAYLOAD = """p AS (SELECT event_id, ts, user_id, value, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
rows_ AS (SELECT event_id, CAST(ts AS DATE) AS trade_date, CAST(user_id AS VARCHAR) AS symbol, event_type AS symbol_name, 'SZ' AS exchange,
    CAST(k AS VARCHAR) AS board_code, value AS close, CAST(k AS DOUBLE) AS total_shares FROM p
  UNION ALL SELECT event_id, NULL, CAST(user_id AS VARCHAR), event_type, 'SH', CAST(k AS VARCHAR), NULL, CAST(k AS DOUBLE) * 2 FROM p)"""


@query(f"WITH {SQL_PAYLOAD} SELECT * FROM rows_")
def land_json_payload(t: Tables) -> DataFrame:
    """Two rows per payload; in the second, the close and the date are not parseable."""
    k = F.get_json_object("props", "$.k").cast("bigint")

    def element(date, suffix: str, close, shares):
        fields = {
            "TRADE_DATE": date,
            "SECURITY_CODE": F.col("user_id").cast("string"),
            "SECUCODE": F.concat(F.col("user_id").cast("string"), F.lit(suffix)),
            "SECURITY_NAME_ABBR": F.col("event_type"),
            "BOARD_CODE": k.cast("string"),
            "CLOSE_PRICE": close,
            "TOTAL_SHARES": shares.cast("string"),
        }
        return F.struct(*[v.alias(n) for n, v in fields.items()])

    rows = F.array(
        element(F.date_format("ts", "yyyy-MM-dd"), ".SZ", F.col("value").cast("string"), k),
        element(F.lit("n/a"), ".SH", F.lit("-"), k * 2),
    )
    body = F.to_json(F.struct(F.struct(rows.alias("data")).alias("result"))).alias("body")
    parsed = landing.valuation_rows(t.events.select("event_id", body))
    return parsed.select(
        "event_id", "trade_date", "symbol", "symbol_name", "exchange", "board_code", "close", "total_shares"
    )


# --- HTML ------------------------------------------------------------------------------

SQL_LINK = r"""(?is)<a\b[^>]*\bhref=["'']([^"'']*)["''][^>]*>.*?</a>"""


@query(f"""WITH m AS (SELECT page_id, regexp_extract_all(html, '{SQL_LINK}', 1) AS links FROM pages)
SELECT page_id, CAST(unnest(range(0, len(links))) AS INTEGER) AS pos, unnest(links) AS href FROM m""")
def html_link_list(t: Tables) -> DataFrame:
    links = pages.fragments(t.pages, "page_id", "html", pages.LINK)
    return links.withColumnRenamed("fragment", "href").orderBy("page_id", F.desc("pos"))


@query(r"""WITH m AS (SELECT page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1) AS items FROM pages),
i AS (SELECT page_id, CAST(unnest(range(0, len(items))) AS INTEGER) AS pos, unnest(items) AS item FROM m)
SELECT page_id, pos, replace(replace(replace(replace(replace(trim(regexp_replace(item, '(?s)<[^>]*>', '', 'g')),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&') AS item FROM i""")
def html_list_items(t: Tables) -> DataFrame:
    items = pages.fragments(t.pages, "page_id", "html", r"(?is)<li\b[^>]*>(.*?)</li>")
    return items.select("page_id", "pos", pages.plain_text(F.col("fragment")).alias("item"))


@query("""SELECT p_partkey AS page_id, '中 ' || p_name || ' & &lt; &#0; <' || p_brand || '>' AS name FROM part""")
def html_entities(t: Tables) -> DataFrame:
    """Names written as decimal entities, brands as hexadecimal ones, and what must not be decoded twice."""
    decimal = F.transform(F.split("p_name", ""), lambda c: F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";")))
    hexadecimal = F.transform(F.split("p_brand", ""), lambda c: F.concat(F.lit("&#x"), F.hex(F.ascii(c)), F.lit(";")))
    html = F.concat(
        F.lit("<td> &#20013; <b>"), F.array_join(decimal, ""), F.lit("</b> & &amp;lt; &#0; &lt;"), F.array_join(hexadecimal, ""), F.lit("&gt;</td>")
    )
    return t.spread(t.part).select(F.col("p_partkey").alias("page_id"), pages.plain_text(html).alias("name"))


@query("""SELECT o_orderkey AS page_id, CAST(o_orderdate AS DATE) AS report_date, '/reports/' || o_orderkey || '.csv' AS href,
  CAST(1 AS INTEGER) AS pos FROM orders""")
def html_report_list(t: Tables) -> DataFrame:
    """One list page per order: a short row, the report row and an unscoped row."""
    html = F.concat(
        F.lit('<table><tr scope="row"><td colspan="2">x</td><td>y</td></tr><tr class="r" scope="row"><td>\n'),
        F.date_format("o_orderdate", "yyyy年M月d日"),
        F.lit('</td><td>CSV</td><td><a class="l" href="/reports/'),
        F.col("o_orderkey").cast("string"),
        F.lit('.csv">file</a></td></tr><tr><td>1</td><td>2</td><td><a href="/no">3</a></td></tr></table>'),
    )
    return pages.report_links(t.orders.select(F.col("o_orderkey").alias("page_id"), html.alias("html")))


@query("""SELECT p_partkey AS page_id, CAST(0 AS INTEGER) AS pos, DATE '2000-01-03' + CAST(p_size AS INTEGER) AS trade_date,
  CAST(p_partkey AS VARCHAR) AS symbol, 'A&B ' || p_name AS symbol_name, p_retailprice AS last_price, CAST(p_size AS BIGINT) * 1000 AS short_shares,
  p_size + 0.25 AS short_avg_price, CAST(p_size AS DOUBLE) AS short_amount_10k, p_retailprice AS amount_10k, CAST(p_size AS DOUBLE) AS short_pct
FROM part""".replace("p_size + 0.25", "CAST(p_size + 0.25 AS DOUBLE)"))
def html_table_rows(t: Tables) -> DataFrame:
    """One turnover page per part; the same page also holds a row with too few cells."""
    span = lambda c, unit="": F.concat(F.lit("<td><span>"), c.cast("string"), F.lit(f"{unit}</span></td>"))
    link = lambda c: F.concat(F.lit('<td><a href="#">'), c, F.lit("</a></td>"))
    size = F.col("p_size")
    html = F.concat(
        F.lit("<div><table><thead><tr><td>h</td></tr></thead><tbody><tr class='o'><td>1</td>"),
        link(F.col("p_partkey").cast("string")),
        link(F.concat(F.lit("A&amp;B "), F.col("p_name"))),
        span(F.col("p_retailprice")),
        span(size * 1000),
        span(size + F.lit(0.25)),
        span(size, "万"),
        span(F.col("p_retailprice"), "万"),
        span(size, "%"),
        span(F.date_add(F.lit("2000-01-03").cast("date"), size)),
        F.lit("</tr><tr><td>short</td></tr></tbody></table></div>"),
    )
    return pages.short_turnover(t.part.select(F.col("p_partkey").alias("page_id"), html.alias("html")))


@query("""SELECT 'stock_' || p_name AS interface, 'http://' || p_brand AS url, p_type AS description, CAST(p_size AS VARCHAR) AS note
FROM part WHERE p_partkey % 4 <> 0""")
def html_catalogue(t: Tables) -> DataFrame:
    """One page per part; every fourth names a fund interface, which is not wanted."""
    kind = F.when(F.col("p_partkey") % 4 == 0, "fund_").otherwise("stock_")
    line = lambda label, value: F.concat(F.lit(f"<p>{label}"), value, F.lit("</p>"))
    html = F.concat(
        F.lit('<body><section id="x"><h3>t<a href="#">¶</a></h3>'),
        line(pages.CATALOGUE_LABELS[0], F.concat(kind, F.col("p_name"))),
        line(pages.CATALOGUE_LABELS[1], F.concat(F.lit("http://"), F.col("p_brand"))),
        line(pages.CATALOGUE_LABELS[2], F.col("p_type")),
        line(pages.CATALOGUE_LABELS[3], F.col("p_size").cast("string")),
        F.lit("<p>in</p><p>out</p></section><section><p>short</p></section></body>"),
    )
    return pages.interface_catalogue(t.part.select(html.alias("html")))


SQL_CUSTODY = """c AS (SELECT p_partkey, DATE '2000-01-03' + CAST(p_size AS INTEGER) AS trade_date,
  lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(5, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS symbol, p_brand AS symbol_name, p_size, p_type
  FROM part WHERE p_partkey % 6 <> 0)"""


def custody_day() -> Column:
    return F.date_add(F.lit("2000-01-03").cast("date"), F.col("p_size"))


def custody_page(bank: Column | None = None) -> Column:
    """A custody page of a part: one holder type, a broker, and a bank with the given holding."""
    asked = custody_day()
    shown = F.when(F.col("p_partkey") % 6 == 0, F.date_add(asked, 1)).otherwise(asked)
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    bank = size if bank is None else bank
    count = F.format_number((F.lit(1000) + key) * 1000, 0)
    percent_cell = F.when(key % 5 == 0, "").otherwise(
        F.concat(_body("col-shareholding-percent text-right", F.concat(size, F.lit(".25%"))))
    )
    return F.concat(
        F.lit('<div class="search-bar__selectedItem-filter searchDate">Shareholding Date: <b>'),
        F.date_format(shown, "yyyy/MM/dd"),
        F.lit('</b></div><div class="search-bar__selectedItem-filter searchStock"> '),
        text.pad_code(key, 5),
        F.lit(" "),
        F.col("p_brand"),
        F.lit(' H</div><div class="ccass-search-datarow x"><div class="summary-category">'),
        F.col("p_type"),
        F.lit("</div>"),
        _value("shareholding", count),
        _value("number-of-participants", size),
        _value("percent-of-participants", F.concat(size, F.lit(".50%"))),
        F.lit("</div><table><thead><tr><th>ID</th></tr></thead><tbody><tr>"),
        _body("col-participant-id", F.concat(F.lit("C"), size)),
        _body("col-participant-name", F.lit("Broker")),
        _body("col-shareholding text-right", count),
        percent_cell,
        F.lit("</tr><tr>"),
        _body("col-participant-id", F.lit("B01")),
        _body("col-participant-name", F.lit("Bank")),
        _body("col-shareholding text-right", bank),
        _body("col-shareholding-percent text-right", F.lit("0.01%")),
        F.lit("</tr></tbody></table>"),
    )


@query(f"""WITH {SQL_CUSTODY}
SELECT 'summary' AS kind, CAST(trade_date AS DATE) AS trade_date, symbol, symbol_name, p_type AS label, CAST(1000 + p_partkey AS BIGINT) * 1000 AS holding,
  CAST(p_size AS DOUBLE) AS participants, p_size + 0.5 AS pct FROM c
UNION ALL SELECT 'detail', CAST(trade_date AS DATE), symbol, symbol_name, 'C' || p_size || ' Broker', CAST(1000 + p_partkey AS BIGINT) * 1000, -1,
  CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size + 0.25 END FROM c
UNION ALL SELECT 'detail', CAST(trade_date AS DATE), symbol, symbol_name, 'B01 Bank', CAST(p_size AS BIGINT), -1, 0.01 FROM c""".replace("p_size + 0.5 AS pct", "CAST(p_size + 0.5 AS DOUBLE) AS pct"))
def html_two_outputs(t: Tables) -> DataFrame:
    """One custody page per stock, parsed once into summary and detail rows. Every sixth page
    answers another date than the asked one; every fifth lacks one percentage cell."""
    rows = pages.custody_rows(t.spread(t.part).select(custody_day().alias("asked_date"), custody_page().alias("html")))
    participant = F.concat_ws(" ", "participant_id", "participant_name")
    return rows.select(
        "kind",
        *pages.CUSTODY_HEAD,
        F.coalesce("holder_type", participant).alias("label"),
        "holding",
        F.coalesce(F.col("participants").cast("double"), F.lit(-1.0)).alias("participants"),
        "pct",
    )


def _value(css: str, value):
    return F.concat(F.lit(f'<div class="{css}"><div class="header">h</div><div class="value"> '), value, F.lit("</div></div>"))


def _body(css: str, value):
    return F.concat(
        F.lit(f'<td class="{css}"><div class="mobile-list-heading">h:</div><div class="mobile-list-body">'),
        value,
        F.lit("</div></td>"),
    )
