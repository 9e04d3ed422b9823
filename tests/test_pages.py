"""Landed files and pages."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from marketlake.queries import REGISTRY, Tables, payloads
from marketlake.sources import landing, pages
from tests.conftest import rows

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"

CUSTODY = """<html><div class="search-bar__selectedItem-filter searchDate">
 Shareholding Date: <span>{shown}</span></div>
<div class="search-bar__selectedItem-filter searchStock"> 00700 TENCENT HOLDINGS </div>
<div class="ccass-search-datarow ccass-search-total"><div class="summary-category"> Total </div>
 <div class="shareholding"><div class="header">Shares</div><div class="value">1,234,567</div></div>
 <div class="number-of-participants"><div class="header">N</div><div class="value">12</div></div>
 <div class="percent-of-participants"><div class="header">%</div><div class="value"> 45.67% </div></div></div>
<div class="ccass-search-datarow"><div class="summary-category">Others</div>
 <div class="shareholding"><div class="value">n/a</div></div>
 <div class="number-of-participants"><div class="value">1</div></div>
 <div class="percent-of-participants"><div class="value">0.1%</div></div></div>
<table><thead><tr><th>x</th></tr></thead><tbody>
<tr><td class="col-participant-id"><div class="mobile-list-heading">ID:</div><div class="mobile-list-body">A1</div></td>
 <td class="col-participant-name"><div class="mobile-list-body">ONE &amp; CO</div></td>
 <td class="col-shareholding text-right"><div class="mobile-list-body">1,000</div></td>
 <td class="col-shareholding-percent text-right"><div class="mobile-list-body">1.50%</div></td></tr>
<tr><td class="col-participant-id"><div class="mobile-list-body"></div></td>
 <td class="col-participant-name"><div class="mobile-list-body">TWO</div></td>
 <td class="col-shareholding text-right"><div class="mobile-list-body">7</div></td></tr>
</tbody></table></html>"""


def test_custody_page(spark):
    asked = date(2024, 1, 5)
    df = spark.createDataFrame(
        [(asked, CUSTODY.format(shown="2024/01/05")), (asked, CUSTODY.format(shown="2024/01/04")), (asked, "<p>busy</p>"), (asked, None)],
        "asked_date date, html string",
    )
    parsed = pages.custody_rows(df)
    head = (asked, "00700", "TENCENT")
    assert rows(pages.custody_summary(parsed)) == [
        (*head, "Others", None, 1, 0.1),
        (*head, "Total", 1234567, 12, 45.67),
    ]
    assert rows(pages.custody_detail(parsed)) == [(*head, "", "TWO", 7, 0.0), (*head, "A1", "ONE & CO", 1000, 1.5)]


CATALOGUE = """<section id="a"><h1>Outer<a href="#a">#</a></h1>
<section id="b"><h3>Inner<a href="#b">#</a></h3><p>接口: stock_one</p><p>目标地址: http://x</p><p>描述: first</p>
<p>限量: all <code>rows</code></p><p>in</p><p>out</p></section>
<section id="c"><h3>No<a>#</a></h3><p>接口: fund_two</p><p>目标地址: y</p><p>描述: d</p><p>限量: l</p><p>i</p><p>o</p></section>
<section id="d"><h3>Few<a>#</a></h3><p>接口: stock_three</p><p>目标地址: y</p><p>描述: d</p><p>限量: l</p></section></section>"""


def test_catalogue(spark):
    df = spark.createDataFrame([(CATALOGUE,), ("<p>none</p>",), (None,)], "html string")
    assert rows(pages.interface_catalogue(df)) == [("stock_one", "http://x", "first", "all rows")]


def test_report_links(spark):
    html = """<table><tr scope="row"><td>2025年7月18日</td><td>x</td><td><a href="/new.csv">csv</a></td></tr>
    <tr scope="row"><td colspan=2>note</td><td>y</td></tr>
    <tr scope="row"><td>2025年10月1日</td><td>x</td><td><a href="/old.csv">csv</a></td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>"""
    links = pages.report_links(spark.createDataFrame([(1, html)], "page_id int, html string"))
    oldest_first = [tuple(r)[2:] for r in links.orderBy(F.desc("pos")).collect()]
    assert oldest_first == [(date(2025, 10, 1), "/old.csv"), (date(2025, 7, 18), "/new.csv")]


def test_short_turnover(spark):
    cell = lambda v: f"<td><span>{v}</span></td>"
    html = (
        "<tbody><tr><td>1</td><td><a>01810</a></td><td><a>XIAOMI</a></td>"
        + "".join(map(cell, ["-", "200", "16.5", "12万", "345万", "3.48%", "2025-01-02"]))
        + "</tr></tbody><tbody><tr>" + cell("x") * 10 + "</tr></tbody>"
    )
    got = pages.short_turnover(spark.createDataFrame([(1, html)], "page_id int, html string")).first()
    assert tuple(got)[2:] == (date(2025, 1, 2), "01810", "XIAOMI", None, 200, 16.5, 12.0, 345.0, 3.48)


def test_short_reports(spark, tmp_path):
    text = "Date,Stock Code,Stock Name,Shares,Value\n18/07/2025,1,\"CK, HLDGS\",100,2000\n18/07/2025,700,T,0,0\n18/07/2025,9988,A,x,1\n"
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text(text)
    got = rows(landing.read_short_reports(spark, str(tmp_path)))
    assert got == [(date(2025, 7, 18), "00001", "CK, HLDGS", 100, 2000)] * 2


def test_valuation_payload(spark):
    body = """{"result": {"data": [
      {"TRADE_DATE": "2025-01-02 00:00:00", "SECURITY_CODE": "300766", "SECUCODE": "300766.SZ", "SECURITY_NAME_ABBR": "n",
       "BOARD_CODE": "1", "BOARD_NAME": "b", "TOTAL_MARKET_CAP": 1.125, "PE_TTM": null, "PEG_CAR": "-"}]}}"""
    df = spark.createDataFrame([(body, 1), ('{"result": null}', 2), ("broken", 3)], "body string, page int")
    row = landing.valuation_rows(df).collect()
    assert len(row) == 1
    assert (row[0].page, row[0].trade_date, row[0].exchange, row[0].market_cap, row[0].pe_ttm, row[0].peg) == (
        1, date(2025, 1, 2), "SZ", 1.12, None, None,
    )


def test_landing_keeps_arrival_order(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    got = landing.read_landing(spark, str(tmp_path / "in")).collect()
    assert [r._pos for r in got] == [r.id for r in got] and len({r._batch for r in got}) == 1


@pytest.mark.parametrize(
    "html, want",
    [
        ("A &amp; B", "A & B"),
        ("&lt;b&gt; &quot;x&quot;&nbsp;&apos;y&apos;", "<b> \"x\" 'y'"),
        ("&#20013;&#x56fd;&#X1F600;", "中国\U0001f600"),
        ("it&#39;s", "it's"),
        ("&amp;lt; &#38;amp; &amp;#39;", "&lt; &amp; &#39;"),
        ("&#0; &#55296; &#1114112; &#9999999; &#; &#x; &other; &amp AT&T &", "&#0; &#55296; &#1114112; &#9999999; &#; &#x; &other; &amp AT&T &"),
        ("&&amp;&", "&&&"),
        ("", ""),
        (None, None),
    ],
)
def test_entities_are_decoded_once(spark, html, want):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(pages.plain_text(F.col("html"))).first()[0] == want


@pytest.mark.parametrize("name", ["html_entities", "html_two_outputs"])
def test_pages_from_one_small_file_are_parsed_by_many_tasks(name, spark, tmp_path):
    one = spark.createDataFrame([(k, "name", "Brand", "TYPE", 3, 1.5) for k in range(1, 21)], PART)
    one.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    df = REGISTRY[name].run(Tables(spark, str(tmp_path)))
    sizes = df.rdd.mapPartitions(lambda found: [sum(1 for _ in found)]).collect()
    assert len([n for n in sizes if n]) > 1


def test_rendered_pages_land_in_many_files(spark, lake, tmp_path):
    one = spark.createDataFrame([(k, "name", "Brand", "TYPE", 3, 1.5) for k in range(1, 21)], PART)
    one.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    landed = payloads._landed_pages(Tables(spark, str(tmp_path)), lake, F.col("p_name"))
    assert len(landed.inputFiles()) > 1 and landed.count() == 20
