"""Company statements: growth, ratios, shares of a total, disclosure delay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import numbers


def quarter_index(day: Column) -> Column:
    """Running number of the quarter, so that one step is one quarter."""
    return F.year(day) * 4 + F.quarter(day)


def growth(reports: DataFrame, company: str, report_date: str, measures: Sequence[str]) -> DataFrame:
    """Value a quarter and a year ago and the growth in percent, null where that quarter is missing.

    A range frame of exactly -1 or -4 quarters finds the right row even across gaps, and all
    lookups share one shuffle and sort; a company has one row per quarter.
    """
    by_quarter = Window.partitionBy(company).orderBy(quarter_index(F.col(report_date)))
    columns: dict[str, Column] = {}
    for name in measures:
        for tag, back in (("qoq", 1), ("yoy", 4)):
            before = F.max(name).over(by_quarter.rangeBetween(-back, -back))
            columns[f"{name}_{tag}_base"] = before
            columns[f"{name}_{tag}"] = numbers.percent(F.col(name) - before, F.abs(before))
    return reports.withColumns(columns)


def balance_ratios(sheet: DataFrame) -> DataFrame:
    """Equity and debt ratio, null for a company without assets."""
    return sheet.withColumns(
        {
            "equity": F.col("total_assets") - F.col("total_liabilities"),
            "debt_ratio": numbers.percent(F.col("total_liabilities"), F.col("total_assets")),
        }
    )


def cashflow_mix(flows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Net cash flow and each flow's share of it."""
    net = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    df = flows.withColumn("net_cash_flow", net)
    return df.withColumns(
        {f"{p}_share": numbers.percent(F.col(p), F.col("net_cash_flow")) for p in parts}
    )


def income_totals(income: DataFrame, expenses: Sequence[str]) -> DataFrame:
    total = sum((F.col(e) for e in expenses[1:]), F.col(expenses[0]))
    return income.withColumns(
        {"total_expense": total, "operating_profit": F.col("revenue") - total}
    )


def effective_date(changes: Sequence[str], planned: str) -> Column:
    """Last announced date: the latest change that was made, else the planned date."""
    return F.coalesce(*changes[::-1], planned)


def disclosure_delay(schedule: DataFrame, planned: str, changes: Sequence[str], actual: str) -> DataFrame:
    df = schedule.withColumn("effective_date", effective_date(changes, planned))
    return df.withColumn("delay_days", F.datediff(actual, "effective_date"))
