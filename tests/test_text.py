"""Text and number scalars against their Python meaning."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.functions import numbers, text
from marketlake.operators import checks, projections

plain_text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(plain_text, min_size=20, max_size=60))
def test_truncate_bytes(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for limit in (4, 7, 32):
        got = [r.s for r in df.select(text.truncate_bytes(F.col("v"), limit).alias("s")).collect()]
        assert got == [v.encode()[:limit].decode("utf-8", "ignore") for v in values]


def test_truncate_bytes_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("中文字",)], "v string")
    assert [r.s for r in df.select(text.truncate_bytes(F.col("v"), 7).alias("s")).collect()] == [None, "中文"]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_codes_and_units(spark):
    assert one(spark, text.pad_code(F.lit(7), 5)) == "00007"
    assert one(spark, text.pad_code(F.lit("1234567"), 5)) == "1234567"
    assert one(spark, text.drop_unit(F.lit(" 12.5% "))) == "12.5"
    assert one(spark, text.drop_unit(F.lit(""))) == ""
    assert one(spark, text.split_last(F.lit("600000.SH"), ".")) == "SH"
    assert one(spark, text.split_part(F.lit("00700 TENCENT X"), 1)) == "TENCENT"
    assert one(spark, text.strip_chars(F.lit("1,234-5/6"), ",-/")) == "123456"


def test_numbers(spark):
    assert one(spark, numbers.to_number(F.lit("-"))) is None
    assert one(spark, numbers.to_number(F.lit("1.5"))) == 1.5
    assert one(spark, numbers.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.fits_decimal(F.lit(9999.994), 6, 2)) is True
    assert one(spark, numbers.fits_decimal(F.lit(9999.995), 6, 2)) is False
    assert one(spark, numbers.fits_decimal(F.lit("abc"), 6, 2)) is False


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125, 0.375, 1, "a")], "a double, b double, c int, d string")
    assert tuple(projections.round_floats(df).first()) == (0.12, 0.38, 1, "a")


def test_type_text(spark):
    render = lambda *a: one(spark, text.type_text(*[F.lit(x).cast(k) for x, k in zip(a, ("string", "int", "int", "int"))]))
    assert render("VARCHAR2", 12, None, None) == "VARCHAR2(12)"
    assert render("NUMBER", None, 18, 2) == "NUMBER(18,2)"
    assert render("NUMBER", None, 8, 0) == "NUMBER(8)"
    assert render("NUMBER", None, None, None) == "NUMBER"
    assert render("DATE", 7, None, None) == "DATE"


def test_column_fit_of_a_declared_schema(spark):
    from marketlake.schema import REGISTRY

    schema = REGISTRY["stock_hk_ccass_records"].schema
    raw = spark.createDataFrame(
        [("00001", "中" * 11, "1000.005"), ("x" * 13, "ok", "12.5")], "symbol string, symbol_name string, pct string"
    )
    rules = {k: v for k, v in checks.fit_rules(schema).items() if k in raw.columns}
    assert {r.column_name: r.n_misfits for r in checks.column_misfits(raw, rules).collect()} == {
        "symbol": 1, "symbol_name": 1, "pct": 1,
    }
