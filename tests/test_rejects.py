"""Judged rows: reasons, arrival, and one reject for a row however often its landing is read."""

from datetime import date, datetime

from marketlake import schema
from marketlake.plans import runner
from marketlake.sources import landing, pages, rejects
from tests.conftest import rows

REPORT = """Date,Stock Code,Stock Name,Shares,Value
18/07/2025,1,"CK, HLDGS",100,2000
18/07/2025,700,T,0,0
18/07/2025,9988,A,x,1
n/a,5,B,7,1
n/a,5,B,7,1
18/07/2025,,C,7,1
only one field
"""


def test_short_reports(spark, lake, tmp_path):
    (tmp_path / "a.csv").write_text(REPORT)
    judged = landing.judged_short_positions(landing.read_short_lines(spark, str(tmp_path)))
    calendar = spark.sql("SELECT date'2025-07-18' AS trade_date")
    spec = schema.REGISTRY["stock_hk_short_sale"]
    for _ in range(2):
        context = runner.Context(lake, calendar, datetime(2025, 7, 30, 9))
        good, counts = runner.accept(context, spec, judged)
        assert rows(good.drop("_batch", "_pos")) == [(date(2025, 7, 18), "00001", "CK, HLDGS", 100, 2000)]
        assert counts == {"rows": 6, "rejects": 5}
    got = rows(runner.rejects_table(context).read_batches(), "table_name", "reason", "raw", "n_rows")
    assert got == [
        (spec.name, "fields", "only one field", 1),
        (spec.name, "short_shares", "18/07/2025,9988,A,x,1", 1),
        (spec.name, "symbol", "18/07/2025,,C,7,1", 1),
        (spec.name, "trade_date", "n/a,5,B,7,1", 2),
    ]
    assert all(r.file.endswith("a.csv") and r.place for r in runner.rejects_table(context).read_batches().collect())


def test_nothing_rejected_writes_nothing(spark, lake):
    judged = spark.createDataFrame([("a", "f", 1, None, None)], "x string, _batch string, _pos int, _reason string, _raw string")
    context = runner.Context(lake, spark.range(0), datetime(2025, 7, 30, 9))
    good, counts = runner.accept(context, schema.REGISTRY["stock_hk_short_sale"], judged)
    assert rows(good) == [("a", "f", 1)] and counts == {"rows": 1, "rejects": 0}
    assert runner.rejects_table(context).read_batches().count() == 0


def test_payloads(spark):
    bodies = [
        ('{"result": {"data": [{"TRADE_DATE": "2025-01-02", "SECURITY_CODE": "1", "SECUCODE": "1.SZ"}, {"TRADE_DATE": "x", "SECURITY_CODE": "2"}]}}', 1),
        ('{"result": null}', 2), ("broken", 3), ('{"result": {"data": []}}', 4), (None, 5),
    ]
    judged = landing.judged_valuations(spark.createDataFrame(bodies, "body string, _pos int"))
    got = rows(judged, "_pos", "symbol", rejects.REASON)
    assert got == [(1, "1", None), (1, "2", "trade_date"), (3, None, "payload")]


def test_turnover_and_catalogue_places(spark):
    cell = lambda v: f"<td><span>{v}</span></td>"
    row = lambda day, code="7": "<tr>" + "".join(map(cell, ["1", code, "n", "-", "2", "3", "4万", "5万", "6%", day])) + "</tr>"
    html = f"<tbody>{row('2025-01-02')}{row('?')}<tr><td>x</td></tr>{row('2025-01-03', '')}</tbody>"
    got = pages.judged_short_turnover(spark.createDataFrame([(html, "f", 9)], "html string, _batch string, _pos int"))
    assert [(r._pos.page, r._pos.row, r._reason) for r in got.orderBy("_pos").collect()] == [(9, 0, None), (9, 1, "trade_date"), (9, 2, "cells"), (9, 3, "symbol")]
