"""Dataset registry: layout, key, load rule and write mode of every table."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

# --- column types ----------------------------------------------------------------------

# Type rules by column name; a dataset states only the columns that differ.
NAMED_TYPES = {
    "month": "date",
    "symbol": "string(12)",
    "symbol_name": "string(32)",
    "board_name": "string(32)",
    "board_code": "string(6)",
    "exchange": "string(4)",
    "fund_code": "string(12)",
    "open": "dec(10,2)",
    "close": "dec(10,2)",
    "high": "dec(10,2)",
    "low": "dec(10,2)",
    "change": "dec(10,2)",
    "last_price": "dec(10,2)",
    "volume": "long(10)",
    "industry": "string(32)",
}
SUFFIX_TYPES = (("_date", "date"), ("_pct", "dec(8,2)"))
DEFAULT_TYPE = "dec(18,2)"

_SIMPLE = {"int": T.IntegerType(), "long": T.LongType(), "date": T.DateType(), "timestamp": T.TimestampNTZType()}


def _type_of(name: str) -> str:
    if name in NAMED_TYPES:
        return NAMED_TYPES[name]
    return next((kind for suffix, kind in SUFFIX_TYPES if name.endswith(suffix)), DEFAULT_TYPE)


def _field(token: str) -> T.StructField:
    """``name`` or ``name=type``; string(n) carries its byte limit, int(n) and long(n) their digits as metadata."""
    name, _, kind = token.partition("=")
    kind = kind or _type_of(name)
    numbers = [int(n) for n in re.findall(r"\d+", kind)]
    metadata = {"label": name.replace("_", " ")}
    if kind.startswith("string"):
        if numbers:
            metadata["max_bytes"] = numbers[0]
        return T.StructField(name, T.StringType(), True, metadata)
    if kind.startswith("dec"):
        return T.StructField(name, T.DecimalType(*numbers), True, metadata)
    if numbers:
        metadata["max_digits"] = numbers[0]
    return T.StructField(name, _SIMPLE[kind.partition("(")[0]], True, metadata)


# --- dataset specification -------------------------------------------------------------

APPEND = "append"
INSERT = "insert_if_absent"
SLICES = "replace_slices"
LIKE = "replace_like"
RANGE = "replace_range"
SNAPSHOT = "replace_snapshot"
REVISE = "revise"
PAIR = "two_tables"


@dataclass(frozen=True)
class DatasetSpec:
    """One table.

    ``scope`` is the column a watermark is kept per, or None for one watermark per table. With ``rules``, an
    equal and a contained column, a watermark is kept per rule: a row belongs to a rule that is equal in
    the first and contained in the second.
    ``step`` is the number of days from the watermark to the first day to load, ``cutoff``
    the rule that ends the load, ``windows`` how the range is cut up. ``constants`` are
    columns that the run adds to the landed ones, ``excluded`` scope values that are not loaded.
    ``parent`` names the table and the column that keep the watermark per scope key. ``report`` maps the
    labels of a landed report's rows to columns, where each landed column is a row of the table.
    """

    name: str
    comment: str
    columns: str
    key: tuple[str, ...]
    write: str
    date: str
    default: str
    scope: str | None = None
    rules: tuple[str, ...] = ()
    step: int = 1
    inclusive: bool = True
    cutoff: str = "today"
    floor: str | None = None
    windows: str = "range"
    slices: tuple[str, ...] = ()
    constants: tuple[tuple[str, str], ...] = ()
    keep_last: bool = False
    complete: bool = False
    cut_text: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    report: tuple[tuple[str, str], ...] = ()
    lenient: bool = False

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType([_field(token) for token in self.columns.split()])

    @cached_property
    def landed_columns(self) -> list[str]:
        """Columns in the order of the landed files: all but those the run adds."""
        added = {name for name, _ in self.constants}
        return [f.name for f in self.schema if f.name not in added]


# --- shared layouts --------------------------------------------------------------------

BARS = (
    "trade_date symbol=string(8) open close high low volume amount=dec(16,2) "
    "amplitude_pct=dec(12,2) change_pct change turnover_pct"
)
INTRADAY_BARS = BARS.replace("trade_date", "bar_time=timestamp")
BOARD_BARS = (
    "trade_date board_code board_name open close high low change_pct change volume amount "
    "amplitude_pct turnover_pct=dec(5,2)"
)
BOARD_NAMES = (
    "trade_date rank=int(4) board_name board_code last_price change change_pct=dec(10,2) market_cap "
    "turnover_pct=dec(5,2) risers=int(4) fallers=int(4) leader=string(32) leader_change_pct=dec(5,2)"
)
MEMBERS = "trade_date board_code board_name symbol symbol_name"
MARGIN_TOTALS = "trade_date margin_balance margin_buy short_volume short_balance short_sell_volume total_balance"
MARGIN_TOTALS_SZ = "trade_date margin_buy margin_balance short_sell_volume short_volume short_balance total_balance"
MARGIN_DETAIL = MARGIN_TOTALS.replace("trade_date", "trade_date symbol symbol_name")
STATEMENT_HEAD = "report_date symbol=string(6) symbol_name"

TODAY_DATE = ("load_date", "today")
TODAY_TRADE = ("trade_date", "today")


def _bars(freq: str, adjust: str, text: str, **rule) -> DatasetSpec:
    intraday = freq == "30min"
    date = "bar_time" if intraday else "trade_date"
    return DatasetSpec(
        name=f"stock_zh_a_hist_{freq}_{adjust}",
        comment=f"{freq} bars, {text}",
        columns=INTRADAY_BARS if intraday else BARS,
        key=("symbol", date) if intraday else ("trade_date", "symbol"),
        date=date,
        scope="symbol",
        **rule,
    )


def _statement(name: str, comment: str, columns: str, default: str, **rule) -> DatasetSpec:
    rule = {"windows": "quarters:-1", "key": ("report_date", "symbol"), "keep_last": False, **rule}
    return DatasetSpec(
        name=name,
        comment=comment,
        columns=f"{STATEMENT_HEAD} {columns}",
        write=SLICES,
        slices=("report_date",),
        date="report_date",
        default=default,
        **rule,
    )


ANNOUNCED = ("report_date", "symbol", "announce_date")

# Concept boards whose history the source cannot deliver.
BROKEN_BOARDS = ("BK1631", "BK1632", "BK1633", "BK1634")

# Row labels of the two landed reports of the Shanghai exchange, and the columns that they fill.
SSE_OVERVIEW = (
    ("报告时间", "trade_date"),
    ("上市股票", "listed_count"),
    ("总股本", "total_shares"),
    ("流通股本", "float_shares"),
    ("总市值", "market_cap"),
    ("流通市值", "float_cap"),
    ("平均市盈率", "avg_pe"),
)
SSE_DEALS = (
    ("挂牌数", "listed_count"),
    ("市价总值", "market_cap"),
    ("流通市值", "float_cap"),
    ("成交金额", "amount"),
    ("成交量", "volume"),
    ("平均市盈率", "avg_pe"),
    ("换手率", "turnover_pct"),
    ("流通换手率", "float_turnover_pct"),
)

# Exchanges and the part of a board's name that is listed and loaded on its own.
SECURITY_RULES = (
    ("SSE", "主板A股"),
    ("SSE", "主板B股"),
    ("SSE", "科创板"),
    ("BSE", "北交所"),
    ("HKSE", "港交所"),
    ("SZSE", "A股列表"),
    ("SZSE", "B股列表"),
)

# --- the datasets ----------------------------------------------------------------------

SPECS: tuple[DatasetSpec, ...] = (
    DatasetSpec(
        "stock_trade_date", "trading calendar per exchange",
        "exchange trade_date load_date", ("trade_date", "exchange"), APPEND,
        "trade_date", "1990-01-01", step=0, inclusive=False, windows="after", constants=(TODAY_DATE,),
    ),
    DatasetSpec(
        "stock_basic_info", "listed securities",
        "symbol symbol_name exchange board=string(24) list_date load_date", ("symbol", "exchange"), LIKE,
        "load_date", "1990-01-01", rules=("exchange", "board"), step=0, inclusive=False, cutoff="friday", windows="snapshot",
        constants=(("load_date", "cutoff"),), complete=True,
    ),
    DatasetSpec(
        "stock_hk_ggt_components_em", "securities of the HK connect list",
        "symbol symbol_name exchange load_date", ("symbol",), SNAPSHOT,
        "load_date", "1990-01-01", step=7, inclusive=False, windows="snapshot",
        constants=(("exchange", "HK"), TODAY_DATE),
    ),
    *[
        DatasetSpec(
            f"stock_board_{kind}_name_em", f"{kind} boards", BOARD_NAMES, ("board_name", "trade_date"), SNAPSHOT,
            "trade_date", "1970-01-01", step=0, inclusive=False, windows="snapshot", constants=(TODAY_TRADE,),
        )
        for kind in ("concept", "industry")
    ],
    *[
        DatasetSpec(
            f"stock_board_{kind}_cons_em", f"members of {kind} boards", MEMBERS, key, SLICES,
            "trade_date", "1970-01-01", scope="board_code", cutoff="friday", windows="snapshot",
            slices=("board_code",), constants=(("trade_date", "cutoff"),), keep_last=kind == "industry",
        )
        for kind, key in (
            ("concept", ("board_code", "symbol")),
            ("industry", ("trade_date", "board_code", "symbol")),
        )
    ],
    *[
        DatasetSpec(
            f"stock_board_{kind}_hist_em", f"daily bars of {kind} boards", BOARD_BARS, ("board_name", "trade_date"), APPEND,
            "trade_date", default, scope="board_code", cutoff="board_close_strict", excluded=excluded,
        )
        for kind, default, excluded in (("concept", "2020-01-01", BROKEN_BOARDS), ("industry", "1970-01-01", ()))
    ],
    DatasetSpec(
        "fund_name_em", "funds",
        "fund_code pinyin_short=string(32) fund_name=string(128) fund_type=string(24) pinyin_full=string(256) "
        "load_date latest_holding_date", ("fund_code", "fund_type"), INSERT,
        "load_date", "1990-01-01", step=0, inclusive=False, cutoff="friday", windows="snapshot",
        constants=(("load_date", "cutoff"), ("latest_holding_date", "null")),
    ),
    DatasetSpec(
        "fund_etf_spot_em", "closing snapshot of exchange-traded funds",
        "etf_code=string(12) etf_name=string(48) last_price=dec(8,3) iopv=dec(8,4) discount_pct change=dec(8,2) change_pct "
        "volume=dec(18,2) amount open=dec(8,4) high=dec(8,4) low=dec(8,4) prev_close=dec(8,4) amplitude_pct turnover_pct "
        "volume_ratio=dec(8,2) order_ratio=dec(8,2) outer_volume inner_volume "
        + " ".join(f"{size}_inflow {size}_inflow_pct=dec(6,2)" for size in ("main", "xl", "l", "m", "s"))
        + " shares_outstanding float_cap market_cap load_date update_time=timestamp",
        ("load_date", "etf_code"), APPEND,
        "load_date", "2026-01-01", cutoff="snapshot_gate", windows="snapshot",
    ),
    DatasetSpec(
        "fund_portfolio_hold_em", "fund holdings per quarter",
        "fund_code symbol symbol_name nav_pct=dec(5,2) shares holding_value report_date",
        ("fund_code", "symbol", "report_date"), RANGE,
        "report_date", "2010-03-31", scope="fund_code", windows="years", slices=("fund_code",),
        parent=("fund_name_em", "latest_holding_date"),
        keep_last=True, cut_text=("symbol_name",),
    ),
    _bars("daily", "bfq", "unadjusted", write=APPEND, default="1990-01-01", cutoff="day_close"),
    _bars("daily", "hfq", "backward adjusted", write=APPEND, default="1990-01-01", cutoff="day_close"),
    _bars("daily", "qfq", "forward adjusted", write=REVISE, default="1970-01-01", cutoff="day_close", step=0, inclusive=False),
    _bars("weekly", "hfq", "backward adjusted", write=APPEND, default="1990-01-01", cutoff="friday", step=7, inclusive=False),
    _bars("weekly", "qfq", "forward adjusted", write=REVISE, default="1970-01-01", cutoff="friday", step=0, inclusive=False),
    _bars("monthly", "hfq", "backward adjusted", write=APPEND, default="1990-01-01", cutoff="month_end"),
    _bars("monthly", "qfq", "forward adjusted", write=REVISE, default="1970-01-01", cutoff="month_end", step=0, inclusive=False),
    *[
        _bars("30min", adjust, text, write=REVISE, default="-50d", cutoff="intraday", step=0, inclusive=False, lenient=True)
        for adjust, text in (("hfq", "backward adjusted"), ("qfq", "forward adjusted"))
    ],
    DatasetSpec(
        "stock_value_em", "valuation per security and day",
        "trade_date symbol=string(8) symbol_name exchange board_code=string(8) board_name market_cap float_cap close change_pct "
        "total_shares=long(16) float_shares=long(16) "
        + " ".join(f"{m}=dec(16,2)" for m in ("pe_ttm", "pe_lar", "pb", "pcf_ttm", "pcf_lar", "ps_ttm", "peg")),
        ("symbol", "trade_date", "board_code"), APPEND,
        "trade_date", "2018-01-01", cutoff="day_closing", windows="trading_days",
    ),
    _statement(
        "stock_yjbb_em", "earnings reports",
        "eps=dec(10,2) revenue revenue_yoy revenue_qoq net_profit net_profit_yoy net_profit_qoq bvps=dec(10,2) roe "
        "ocf_per_share gross_margin=dec(10,2) industry announce_date", "2015-06-30",
    ),
    _statement(
        "stock_yjkb_em", "earnings flash reports",
        "eps=dec(10,2) revenue revenue_prev_year revenue_yoy revenue_qoq net_profit net_profit_prev_year net_profit_yoy "
        "net_profit_qoq bvps=dec(10,2) roe=dec(10,2) industry announce_date", "2010-06-30",
    ),
    _statement(
        "stock_yjyg_em", "earnings forecasts",
        "metric=string(48) change_text=string forecast_value forecast_change_pct=dec(18,2) reason_text=string "
        "forecast_type=string(12) prev_year_value announce_date", "2010-06-30",
        key=("report_date", "symbol", "metric", "announce_date"), keep_last=True,
    ),
    _statement(
        "stock_yysj_em", "disclosure schedule",
        "planned_date changed_date_1=date changed_date_2=date changed_date_3=date actual_date", "2012-06-30", keep_last=True,
    ),
    _statement(
        "stock_zcfz_em", "balance sheets",
        "exchange cash receivables inventory total_assets total_assets_yoy payables total_liabilities advances "
        "total_liabilities_yoy debt_ratio equity announce_date", "2013-06-30",
        windows="quarters:0", key=ANNOUNCED, keep_last=True,
    ),
    _statement(
        "stock_lrb_em", "income statements",
        "net_profit net_profit_yoy revenue revenue_yoy operating_cost selling_expense admin_expense finance_expense "
        "total_expense operating_profit total_profit announce_date", "2012-06-30", key=ANNOUNCED, keep_last=True,
    ),
    _statement(
        "stock_xjll_em", "cash-flow statements",
        "net_cash_flow net_cash_flow_yoy operating_cf operating_cf_share investing_cf investing_cf_share financing_cf "
        "financing_cf_share announce_date", "2012-06-30", key=ANNOUNCED, keep_last=True,
    ),
    DatasetSpec(
        "stock_sse_summary", "overview of the Shanghai exchange",
        "trade_date item=string(16) listed_count=int(6) total_shares=dec(12,2) float_shares=dec(12,2) market_cap=dec(12,2) "
        "float_cap=dec(12,2) avg_pe=dec(8,2)", ("trade_date", "item"), APPEND,
        "trade_date", "1990-01-01", cutoff="yesterday_strict", report=SSE_OVERVIEW,
    ),
    DatasetSpec(
        "stock_sse_deal_daily", "daily deals of the Shanghai exchange",
        "trade_date board=string(16) listed_count=int(6) market_cap=dec(10,2) float_cap=dec(10,2) amount=dec(10,2) volume=dec(10,2) "
        "avg_pe=dec(6,2) turnover_pct=dec(5,2) float_turnover_pct=dec(5,2)", ("trade_date", "board"), APPEND,
        "trade_date", "1990-01-01", floor="2022-01-01", cutoff="day", windows="trading_days", report=SSE_DEALS,
    ),
    DatasetSpec(
        "stock_szse_summary", "categories of the Shenzhen exchange",
        "trade_date category=string(24) count=long(10) amount=dec(24,5) market_cap=dec(24,5) float_cap=dec(24,5)",
        ("trade_date", "category"), APPEND,
        "trade_date", "1990-01-01", floor="2010-01-02", windows="trading_days",
    ),
    DatasetSpec(
        "stock_szse_area_summary", "areas of the Shenzhen exchange",
        "month area=string(16) total_amount market_pct=dec(4,2) stock_amount fund_amount bond_amount",
        ("month", "area"), APPEND,
        "month", "1990-01-01", step=31, floor="2020-01-01", cutoff="month_end", windows="months",
    ),
    DatasetSpec(
        "stock_szse_sector_summary", "sectors of the Shenzhen exchange",
        "month name=string(16) name_en=string(32) trade_days=int(2) amount=long(18) amount_pct=dec(5,2) volume=long(18) volume_pct=dec(5,2) "
        "deals=long(18) deals_pct=dec(5,2)", ("month", "name"), APPEND,
        "month", "1990-01-01", step=31, floor="2019-01-01", cutoff="month_end", windows="months_until_gap",
    ),
    DatasetSpec(
        "stock_margin_sse", "margin totals, Shanghai", MARGIN_TOTALS, ("trade_date",), APPEND,
        "trade_date", "2013-01-01", inclusive=False, cutoff="today", windows="split:365",
    ),
    DatasetSpec(
        "stock_margin_detail_sse", "margin per security, Shanghai",
        "trade_date symbol symbol_name margin_balance margin_buy margin_repay short_volume short_sell_volume short_repay_volume",
        ("trade_date", "symbol"), APPEND,
        "trade_date", "2014-01-01", cutoff="yesterday", windows="trading_days",
    ),
    DatasetSpec(
        "stock_margin_szse", "margin totals, Shenzhen", MARGIN_TOTALS_SZ, ("trade_date",), APPEND,
        "trade_date", "2013-01-01", cutoff="yesterday", windows="trading_days",
    ),
    DatasetSpec(
        "stock_margin_detail_szse", "margin per security, Shenzhen",
        MARGIN_TOTALS_SZ.replace("trade_date", "trade_date symbol symbol_name"), ("trade_date", "symbol"), APPEND,
        "trade_date", "2014-01-01", cutoff="yesterday", windows="trading_days", cut_text=("symbol_name",),
    ),
    DatasetSpec(
        "stock_hk_short_sale", "reported short positions, Hong Kong",
        "trade_date symbol symbol_name short_shares=long(16) short_value=long(16)", ("symbol", "trade_date"), APPEND,
        "trade_date", "2012-08-20", step=7, cutoff="prev_week_friday", windows="split:70",
    ),
    DatasetSpec(
        "stock_hk_short_sale_em", "short turnover, Hong Kong",
        "trade_date symbol symbol_name last_price short_shares=long(16) short_avg_price=dec(10,2) short_amount_10k=long(10) "
        "amount_10k=long(10) short_pct=dec(5,2)", ("symbol", "trade_date"), APPEND,
        "trade_date", "1970-01-01", scope="symbol", floor="-1y", cutoff="day", windows="split:50",
    ),
    DatasetSpec(
        "stock_hk_ccass_records", "custody by participant, Hong Kong",
        "trade_date symbol symbol_name participant_id=string(12) participant_name=string(48) holding=long(16) pct=dec(5,2)",
        (), PAIR, "trade_date", "1970-01-01", scope="symbol", floor="-1y", cutoff="yesterday", windows="business_days",
    ),
    DatasetSpec(
        "stock_hk_ccass_records_summary", "custody by holder type, Hong Kong",
        "trade_date symbol symbol_name holder_type=string(48) holding=long(16) participants=int(8) pct=dec(5,2)",
        ("symbol", "trade_date", "holder_type"), PAIR,
        "trade_date", "1970-01-01", scope="symbol", floor="-1y", cutoff="yesterday", windows="business_days",
    ),
    DatasetSpec(
        "stock_table_api_summary", "catalogue of interfaces",
        "interface=string(64) url=string(256) description=string(256) note=string(256) load_date", ("interface",), SNAPSHOT,
        "load_date", "1990-01-01", step=0, inclusive=False, windows="snapshot", constants=(TODAY_DATE,),
    ),
    DatasetSpec(
        "sync_logs", "sync log",
        "interface=string(64) table_name=string(64) trade_date status=string(12)", ("interface", "table_name"), SNAPSHOT,
        "trade_date", "1970-01-01", windows="snapshot",
    ),
)

REGISTRY: dict[str, DatasetSpec] = {spec.name: spec for spec in SPECS}

#: Column that a table's rows get from the loads of another table, and the column that both are keyed by.
KEPT_BY_CHILD = {spec.parent[0]: (spec.parent[1], spec.scope) for spec in SPECS if spec.parent}
