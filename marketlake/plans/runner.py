"""One load of one dataset: plan, pick the landed rows, normalise, publish, log.

The driver only sees one-row frames (watermark, cut-off, counts). Everything per key or per
row is a join or an aggregation over all keys at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from marketlake import schema as spec_rules
from marketlake.functions import dates, text
from marketlake.operators import aggregates, checks, filters, joins, reshape, revision, synclog, writes
from marketlake.plans import kept, units, windows
from marketlake.schema import DatasetSpec
from marketlake.sources import rejects
from marketlake.sources.landing import ARRIVAL, folder_day, folder_of
from marketlake.sources.tables import Lake, LakeTable, publish_together

YEAR = StructField("_year", IntegerType())
INTRADAY_BACK_DAYS = 50
#: Rows beyond which a written plan is not broadcast: its file says little of its size in memory, as keys that
#: are due for the same days compress to almost nothing.
BROADCAST_ROWS = 100_000
#: Windows that hold all days of a range that follow a rule of the day alone.
DAY_WINDOWS = ("trading_days", "business_days", "split")


@dataclass(frozen=True)
class Context:
    """What a run needs to know besides the landed rows. Make a new one per run: its batch id is
    unique, so the leftovers of a run that died are never committed."""

    lake: Lake
    calendar: DataFrame
    now: datetime
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex[:8])

    @property
    def clock(self) -> Column:
        return F.lit(self.now).cast("timestamp_ntz")

    @property
    def batch(self) -> str:
        return f"{self.now:%Y%m%d%H%M%S}-{self.attempt}"

    def table(self, spec: DatasetSpec) -> LakeTable:
        schema = spec.schema
        if spec.write == spec_rules.RANGE:
            schema = StructType([*schema.fields, YEAR])
        by_scope = (spec.scope, spec.date) if spec.scope else (spec.date,)
        sort = by_scope + tuple(c for c in spec.key if c not in by_scope)
        return LakeTable(self.lake, spec.name, schema, sort)


def _slices(spec: DatasetSpec) -> list[str]:
    """Columns of the slice that a load replaces in a marked table."""
    return [*spec.slices, "_year"] if spec.write == spec_rules.RANGE else ["symbol"]


def stored_rows(context: Context, spec: DatasetSpec) -> DataFrame:
    """Rows of the table, from whichever layout its write mode uses."""
    if spec.name in spec_rules.KEPT_BY_CHILD:
        return _with_kept_column(context, spec)
    return _own_rows(context, spec)


def _own_rows(context: Context, spec: DatasetSpec) -> DataFrame:
    table = context.table(spec)
    if spec.write in (spec_rules.APPEND, spec_rules.INSERT, spec_rules.PAIR):
        return table.read_batches()
    if spec.write in (spec_rules.LIKE, spec_rules.SNAPSHOT):
        return table.read_version()
    if spec.write == spec_rules.SLICES:
        return table.read_partitions(spec.slices)
    return table.read_marked(_slices(spec)).select(*spec.schema.fieldNames())


# --- a parent's column that loads of its child keep ---------------------------------------


def parent_table(context: Context, spec: DatasetSpec) -> LakeTable:
    """Date per scope key that the loads of a child table keep for its parent."""
    parent, column = spec.parent
    fields = [spec.schema[spec.scope], StructField(column, DateType())]
    return LakeTable(context.lake, f"{parent}__{column}", StructType(fields))


def parent_dates(context: Context, spec: DatasetSpec) -> DataFrame:
    table = parent_table(context, spec)
    newest = table.read_newest()
    return reshape.typed_empty(context.lake.spark, table.schema) if newest is None else newest


def _with_kept_column(context: Context, spec: DatasetSpec) -> DataFrame:
    """The parent's rows, with the column as its child's loads left it."""
    column, key = spec_rules.KEPT_BY_CHILD[spec.name]
    child = next(c for c in spec_rules.SPECS if c.parent == (spec.name, column))
    kept_dates = parent_dates(context, child)
    return _own_rows(context, spec).drop(column).join(kept_dates, key, "left").select(*spec.schema.fieldNames())


def _dates_after(context: Context, spec: DatasetSpec, planned: DataFrame, rows: DataFrame) -> DataFrame:
    """The parent's dates after a load by years: the latest row of the last planned year, or the end of the
    year before where that year had no rows; unplanned keys keep theirs."""
    column = spec.parent[1]
    last = load_dates(context, spec, planned).groupBy(spec.scope).agg(F.max("_year").alias("_last"))
    found = rows.withColumn("_year", F.year(spec.date)).join(last, spec.scope).filter("_year = _last")
    fallback = F.make_date(F.col("_last") - 1, F.lit(12), F.lit(31))
    new = writes.update_parent_date(last, found, spec.scope, spec.date, column, fallback).select(spec.scope, column)
    return joins.without(parent_dates(context, spec), new, [spec.scope]).unionByName(new)


# --- kept state --------------------------------------------------------------------------


def state_table(context: Context, spec: DatasetSpec) -> LakeTable:
    return LakeTable(context.lake, f"{spec.name}__state", kept.schema(spec))


def state(context: Context, spec: DatasetSpec) -> DataFrame:
    """First and last date per key, as the last load left them. Only a table that was loaded before
    states were kept is scanned."""
    newest = state_table(context, spec).read_newest()
    return kept.state_of(spec, stored_rows(context, spec)) if newest is None else newest


def _commit(context: Context, spec: DatasetSpec, batch: str, *parts: tuple[LakeTable, DataFrame], replaced: DataFrame | None = None) -> None:
    """Write a batch of the table (the first part) and what belongs to it, and the state after it: all or nothing."""
    old, table = state(context, spec), parts[0][0]
    for part, rows in parts:
        part.write_batch(rows, batch, unit=batch)
    if spec.write == spec_rules.REVISE:  # the other modes add absent keys only
        ensure_unique(spec, table.read_batch(batch))
    beside = state_table(context, spec)
    new = kept.merged(spec, old, kept.state_of(spec, table.read_batch(batch)), replaced)
    beside.write_batch(new, beside.next_batch(context.attempt), unit=batch)
    context.lake.commit("units", batch)


# --- plan ------------------------------------------------------------------------------


def _last_trading(context: Context, day: Column, strict: bool = False) -> Column:
    keep = F.col("trade_date") < day if strict else F.col("trade_date") <= day
    return F.lit(context.calendar.agg(F.max(F.when(keep, F.col("trade_date")))).first()[0])


def cutoff(context: Context, spec: DatasetSpec) -> Column:
    """Last day (or bar end) that may be loaded at the clock of the run."""
    now, today = context.clock, F.to_date(context.clock)
    yesterday = F.date_sub(today, 1)
    match spec.cutoff:
        case "today":
            return today
        case "yesterday":
            return yesterday
        case "day":
            return dates.day_cutoff(now)
        case "day_closing":
            return dates.day_cutoff(now, closing_counts=True)
        case "day_close":
            return _last_trading(context, dates.day_cutoff(now))
        case "board_close_strict":
            return _last_trading(context, dates.day_cutoff(now, dates.BOARD_CLOSE), strict=True)
        case "yesterday_strict":
            return _last_trading(context, today, strict=True)
        case "friday":
            return dates.last_friday(now)
        case "prev_week_friday":
            return dates.prev_week_friday(now)
        case "month_end":
            return dates.prev_month_end(now)
        case "snapshot_gate":
            return yesterday
        case "intraday":
            last = _last_trading(context, today)
            before = _last_trading(context, today, strict=True)
            return dates.intraday_cutoff(now, last, before).cast("timestamp_ntz")
    raise ValueError(f"unknown cut-off rule {spec.cutoff!r}")


def _default_mark(context: Context, spec: DatasetSpec) -> Column:
    if spec.default == f"-{INTRADAY_BACK_DAYS}d":
        return context.clock - F.make_dt_interval(F.lit(INTRADAY_BACK_DAYS))
    return F.lit(spec.default).cast("date")


def plan(
    context: Context,
    spec: DatasetSpec,
    end: Column,
    universe: DataFrame | None = None,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Due load ranges: (scope key, start, end) per key, or one (start, end) row per table.

    For a dataset with rules, ``universe`` holds the rules, and there is a range per rule. ``marks`` replaces the stored watermark where a parent table keeps it.
    """
    default = _default_mark(context, spec)
    if marks is None and spec.parent:
        known = parent_dates(context, spec)
        marks = universe.select(spec.scope).distinct().join(known, spec.scope, "left")
        marks = marks.select(spec.scope, F.coalesce(spec.parent[1], default).alias("watermark"))
    if marks is None:
        by_state = spec.write in kept.MODES
        stored, date = (state(context, spec), "last_date") if by_state else (stored_rows(context, spec), spec.date)
        if spec.rules:
            marks = aggregates.rule_watermark(universe, stored, *spec.rules, date, default)
        elif spec.scope is None:
            marks = stored.agg(F.coalesce(F.max(date), default).alias("watermark"))
        else:
            marks = aggregates.keyed_watermark(universe, stored, spec.scope, date, default)
    planned = marks.withColumns({"start": _start(context, spec, F.col("watermark")), "end": end})
    if spec.excluded:
        planned = filters.not_in(planned, spec.scope, spec.excluded)
    return planned.filter(_due(context, spec))


def _start(context: Context, spec: DatasetSpec, mark: Column) -> Column:
    """First day to load behind a watermark."""
    start = mark
    if spec.step and spec.cutoff != "intraday":
        start = dates.next_start(start, days=spec.step)
    if spec.floor is not None:
        year_ago = F.add_months(F.to_date(context.clock), -12)
        start = dates.start_floor(start, year_ago if spec.floor == "-1y" else F.lit(spec.floor).cast("date"))
    return start


def units_table(context: Context, spec: DatasetSpec) -> LakeTable:
    """Intervals of the units that each load of the table brought, written as part of the load."""
    day = spec.schema[spec.date].dataType
    fields = [spec.schema[spec.scope], *[StructField(name, day) for name in units.INTERVAL]]
    return LakeTable(context.lake, f"{spec.name}__units", StructType(fields), (spec.scope,))


def plan_units(context: Context, spec: DatasetSpec, end: Column, universe: DataFrame) -> DataFrame:
    """(scope key, start, end) of all business days that are due and not loaded, gaps included.

    Reads the kept intervals, not the table.
    """
    start = _start(context, spec, _default_mark(context, spec))
    due = universe.select(spec.scope).distinct().select(spec.scope, start.alias("start"), end.alias("end"))
    return units.gaps(due.filter("start <= end"), units_table(context, spec).read_batches(), spec.scope)


def _due(context: Context, spec: DatasetSpec) -> Column:
    if spec.cutoff == "snapshot_gate":
        return dates.snapshot_gate(F.col("watermark"), context.clock)
    if spec.windows.startswith("quarters"):
        return F.lit(True)
    if spec.windows == "years":  # a quarter's holdings are out four months after it at the latest
        return F.add_months("watermark", 4) <= F.to_date(context.clock)
    if spec.windows.startswith("months"):
        return F.trunc("start", "month") <= F.trunc("end", "month")
    return dates.due(F.col("start"), F.col("end"), spec.inclusive)


def load_dates(context: Context, spec: DatasetSpec, planned: DataFrame) -> DataFrame | None:
    """The planned dates as rows, for datasets that are loaded date by date; None for a plain
    range or a snapshot."""
    kind, _, number = spec.windows.partition(":")
    match kind:
        case "trading_days":
            days = windows.explode_dates(planned, dates.day_range(F.col("start"), F.col("end")), spec.date)
            return days.join(context.calendar.select(F.col("trade_date").alias(spec.date)), spec.date, "left_semi")
        case "business_days":
            return windows.explode_dates(planned, dates.business_days(F.col("start"), F.col("end")), spec.date)
        case "quarters":
            today = F.to_date(context.clock)
            ends = dates.quarter_ends(F.col("watermark"), today, int(number))
            return windows.explode_dates(planned, ends, spec.date)
        case "months" | "months_until_gap":
            return windows.explode_dates(planned, dates.month_starts(F.col("start"), F.col("end")), spec.date)
        case "split":
            pieces = dates.split_range(F.col("start"), F.col("end"), int(number))
            cut = windows.explode_windows(planned, pieces)
            return windows.explode_dates(cut, dates.day_range(F.col("window_start"), F.col("window_end")), spec.date)
        case "years":
            return windows.explode_dates(planned, dates.holding_years(F.col("watermark"), context.clock), "_year")
    return None


def _written(context: Context, spec: DatasetSpec, planned: DataFrame) -> DataFrame:
    """The plan as a file, as several steps read it; its size is known before it is joined."""
    return context.table(spec).stage(planned, f"{context.batch}-plan-{uuid.uuid4().hex[:8]}")


def _side(df: DataFrame, n_rows: int) -> DataFrame:
    """A written side of a join, which is shuffled where it has many rows, whatever its file's size."""
    return df.hint("merge") if n_rows > BROADCAST_ROWS else df


def _days_of_ranges(context: Context, spec: DatasetSpec, planned: DataFrame) -> DataFrame:
    """The days that the ranges of all keys hold together: one row a day at most."""
    ranges = planned.select("start", "end").distinct()
    return load_dates(context, spec, ranges).select(spec.date).distinct()


def _in_keyed_days(context: Context, spec: DatasetSpec, landed: DataFrame, planned: DataFrame) -> DataFrame:
    """Landed rows on the planned days of their key. Each row meets the ranges of its key and the rule of the
    day: the days of every key are not written out, as there are many times more of them than keys."""
    planned = _written(context, spec, planned.select(spec.scope, "start", "end"))
    low, high, n_rows = planned.agg(F.min("start"), F.max("end"), F.count(F.lit(1))).first()
    if low is None or high is None:
        return landed.limit(0)
    days = _days_of_ranges(context, spec, planned) if folder_of(landed) else None
    landed = pruned(spec, landed, planned, days).filter(F.col(spec.date).between(F.lit(low), F.lit(high)))
    if spec.windows == "trading_days":
        landed = landed.join(context.calendar.select(F.col("trade_date").alias(spec.date)), spec.date, "left_semi")
    elif spec.windows == "business_days":
        landed = landed.filter(F.weekday(spec.date) < 5)
    ranges = planned.select(F.col(spec.scope).alias("_key"), F.col("start").alias("_from"), F.col("end").alias("_to"))
    wanted = (F.col(spec.scope) == F.col("_key")) & F.col(spec.date).between(F.col("_from"), F.col("_to"))
    return landed.join(_side(ranges, n_rows), wanted, "left_semi")


def planned_folders(spec: DatasetSpec, planned: DataFrame, days: DataFrame | None, name: str, grain: str) -> DataFrame:
    """First days of all folders that a plan may ask for, over all keys: one row a folder at most."""
    if days is None:
        ranges = planned.select(F.to_date("start").alias("start"), F.to_date("end").alias("end")).distinct()
        at = ranges.select(F.explode(dates.day_range(F.col("start"), F.col("end"))).alias("_at"))
    elif spec.windows == "years":
        first, last = (F.make_date(F.col("_year"), F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
        at = days.select("_year").distinct().select(F.explode(F.sequence(first, last)).alias("_at"))
    else:
        at = days.select(F.to_date(spec.date).alias("_at"))
    return at.select(folder_day(grain, F.col("_at")).alias(name)).distinct()


def pruned(spec: DatasetSpec, landed: DataFrame, planned: DataFrame, days: DataFrame | None) -> DataFrame:
    """Rows of a landing by date in the folders that the plan names; any other landing as it is.

    The plan was written, so that its few folders are broadcast by their size, and prune the scan of
    the landing at run time.
    """
    folder = folder_of(landed)
    if folder is None:
        return landed
    if days is not None or spec.windows not in ("snapshot", "after"):
        wanted = planned_folders(spec, planned, days, *folder)
        # the bound lets the planner see that the folders are a selection
        landed = landed.join(wanted.filter(F.col(folder[0]) <= F.lit("9999-12-31").cast("date")), folder[0], "left_semi")
    return landed.drop(folder[0])


def pick(context: Context, spec: DatasetSpec, landed: DataFrame, planned: DataFrame) -> DataFrame:
    """Landed rows that the plan asks for."""
    keys = [spec.scope] if spec.scope else []
    if spec.rules:
        landed = pruned(spec, landed, planned, None)
        fit = joins.by_rule(landed.select(*spec.rules).distinct(), planned, *spec.rules)
        return landed.join(fit.select(*spec.rules).distinct(), list(spec.rules), "left_semi")
    if keys and spec.windows.partition(":")[0] in DAY_WINDOWS:
        return _in_keyed_days(context, spec, landed, planned)
    days = load_dates(context, spec, planned)
    if days is not None:
        days = _written(context, spec, days.select(*keys, "_year" if spec.windows == "years" else spec.date))
    elif spec.windows != "snapshot":
        planned = _written(context, spec, planned)
    landed = pruned(spec, landed, planned, days)
    if spec.windows == "years":
        landed = landed.withColumn("_year", F.year(spec.date))
        return landed.join(days, [*keys, "_year"], "left_semi").drop("_year")
    if days is not None:
        if spec.windows == "months_until_gap":
            present = landed.select(spec.date).distinct().withColumn("_present", F.lit(True))
            checked = days.join(present, spec.date, "left").fillna(False, ["_present"])
            checked = checked.withColumn("_all", F.lit(0))
            days = windows.until_gap(checked, "_all", spec.date, "_present").select(spec.date)
        return landed.join(days, [*keys, spec.date], "left_semi")
    if spec.windows == "snapshot":
        return landed.join(planned.select(*keys), keys, "left_semi") if keys else _if_due(landed, planned)
    if keys:
        # the range over all keys reaches the scan
        low, high = planned.agg(F.min("start"), F.max("end")).first()
        if low is None:
            return landed.limit(0)
        landed = landed.filter(F.col(spec.date).between(F.lit(low), F.lit(high)))
        joined = landed.join(planned.select(*keys, "start", "end"), keys)
        return joined.filter(F.col(spec.date).between(F.col("start"), F.col("end"))).drop("start", "end")
    row = planned.first()
    if row is None:
        return landed.limit(0)
    if spec.windows == "after":
        return landed.filter(F.col(spec.date) > F.lit(row["watermark"]))
    return landed.filter(F.col(spec.date).between(F.lit(row["start"]), F.lit(row["end"])))


def _if_due(landed: DataFrame, ranges: DataFrame) -> DataFrame:
    return landed.limit(0) if ranges.isEmpty() else landed


# --- normalise -------------------------------------------------------------------------


def _misfit(value: Column, declared: StructField, key: Sequence[str] | None) -> Column:
    """The failure of the load, naming the row's key. One formatted text: the step that casts a row holds the
    message of each of its columns, and Java compiles no method above 8,000 bytes."""
    row = "a row" if key is None else " ".join(["row", *["%s" for _ in key]])
    message = f"{declared.name}: value does not fit {declared.dataType.simpleString()}: %s in {row}"
    return F.raise_error(F.format_string(message, value.cast("string"), *[F.col(c).cast("string") for c in key or ()]))


def _fits(value: Column, ok: Column, declared: StructField, key: Sequence[str] | None) -> Column:
    """The value, or the failure of the load where a given value does not fit its column."""
    return F.when(value.isNotNull() & ~ok, _misfit(value, declared, key)).otherwise(value)


def _unrounded(landed: DataType, declared: DataType) -> bool:
    """Whether all values of a landed number type have no more decimal places than the declared one."""
    scale = landed.scale if isinstance(landed, DecimalType) else 0 if isinstance(landed, IntegralType) else None
    return scale is not None and scale <= (declared.scale if isinstance(declared, DecimalType) else 0)


#: Texts that are read as dates: a day with or without hyphens, a time behind it, or a month.
_DAY_TEXT, _HYPHENED, _MONTH_TEXT = "^[0-9]{8}$", "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$", "^[0-9]{6}$"


def coerce(landed: StructField, declared: StructField, cut: bool = False, key: Sequence[str] | None = None) -> Column:
    """Landed value to the declared type. What cannot be read becomes null; what can be read but
    does not fit the column fails the load. Values that already have the type pass through, so
    that filters on them still reach the scan, unless the column limits their digits. ``cut`` text is
    cut to its limit later. ``key`` names the columns that tell a row in the failure."""
    value, kind = F.col(landed.name), declared.dataType
    limit, digits = declared.metadata.get("max_bytes"), declared.metadata.get("max_digits")
    if isinstance(kind, StringType) and limit and not cut:
        as_text = value.cast("string")
        return _fits(as_text, F.octet_length(as_text) <= limit, declared, key)
    if isinstance(kind, (DecimalType, IntegerType, LongType)) and (landed.dataType != kind or digits):
        if _unrounded(landed.dataType, kind):
            exact, given = value, value.isNotNull()
        else:  # a number that is too large for any decimal is read as double, and fits nothing
            exact = F.bround(value.try_cast("decimal(38,10)"), kind.scale if isinstance(kind, DecimalType) else 0)
            given = F.abs(value.try_cast("double")) < F.lit(float("inf"))
        narrow = exact.try_cast(kind if digits is None else DecimalType(digits, 0))
        return F.coalesce(narrow, F.when(given, _misfit(value, declared, key))).try_cast(kind)
    if landed.dataType == kind:
        return value
    if isinstance(kind, DateType):
        as_text = value.cast("string")
        month = F.try_to_date(F.concat(F.when(as_text.rlike(_MONTH_TEXT), as_text), F.lit("01")), "yyyyMMdd")
        day = F.try_to_date(F.when(as_text.rlike(_DAY_TEXT), as_text), "yyyyMMdd")
        return F.coalesce(month, day, F.when(as_text.rlike(_HYPHENED), as_text).try_cast("date"))
    if isinstance(kind, StringType):
        return value.cast("string")
    return value.try_cast(kind)


def typed(context: Context, spec: DatasetSpec, landed: DataFrame, end: Column) -> DataFrame:
    """Landed rows in the table's schema, with the run's constants and the arrival order.

    ``landed`` holds the dataset's columns by name, and ``_batch`` and ``_pos``; and the folder
    column where the landing is dealt out by date.
    """
    fixed = {"today": F.to_date(context.clock), "cutoff": end, "null": F.lit(None)}
    tags = {name: fixed[v] if v in fixed else F.lit(v) for name, v in spec.constants}
    key = [c for c in spec.key if c in landed.columns]
    columns = []
    for declared in spec.schema:
        if declared.name in tags:
            value = tags[declared.name]
        else:
            value = coerce(landed.schema[declared.name], declared, declared.name in spec.cut_text, key)
        if declared.name in spec.cut_text:
            value = text.truncate_bytes(value, declared.metadata["max_bytes"])
        columns.append(value.cast(declared.dataType).alias(declared.name))
    folder = folder_of(landed)
    return landed.select(*columns, *ARRIVAL, *(folder[:1] if folder else ()))


def cleaned(spec: DatasetSpec, rows: DataFrame) -> DataFrame:
    """Complete rows where the dataset asks for them, and the last arrival per key."""
    if spec.complete:
        rows = rows.dropna("any", subset=spec.landed_columns)
    if spec.keep_last:
        rows = aggregates.keep_last(rows, spec.key, list(ARRIVAL))
    return rows


def _source_columns(raw: DataFrame) -> list[str]:
    """Columns of the source file: all but arrival and folder."""
    folder = folder_of(raw)
    return [c for c in raw.columns if c not in (*ARRIVAL, *(folder[:1] if folder else ()))]


def from_source_columns(spec: DatasetSpec, raw: DataFrame) -> DataFrame:
    """Source files name their columns in their own language: rename them by position. Another number
    of columns than the dataset has would shift all values, and fails."""
    source, wanted = _source_columns(raw), spec.landed_columns
    if len(source) != len(wanted):
        raise ValueError(f"{spec.name}: {len(source)} source columns for {len(wanted)}: {', '.join(source)}")
    return raw.select(*[F.col(s).alias(w) for s, w in zip(source, wanted)], *[c for c in raw.columns if c not in source])


def from_reports(spec: DatasetSpec, raw: DataFrame, date: str | None = None) -> DataFrame:
    """Landed reports whose rows are metrics and whose columns are the table's rows: first the label of
    the metric, then a column per row. ``date`` names a column with the reports' day, for reports that do not
    name it. One report is what came in one file; its arrival is that of its first row."""
    label, *names = [c for c in _source_columns(raw) if c != date]
    by = ["_batch", *([date] if date else [])]
    column = spec.key[1]  # a report has one row per day and item
    raw = raw.withColumnRenamed(label, "_metric")
    rows = reshape.transpose_reports(raw, by, "_metric", names, dict(spec.report), column)
    if date and date != spec.date:
        rows = rows.withColumnRenamed(date, spec.date)
    return rows.withColumn("_pos", F.lit(0))


# --- check -----------------------------------------------------------------------------


def ensure_unique(spec: DatasetSpec, rows: DataFrame) -> None:
    """Fail the load if a key comes twice in written rows. One action, and one offender is enough."""
    twice = checks.violations(rows, spec.key, {}).first() if spec.key else None
    if twice is not None:
        key = ", ".join(f"{c} {twice[c]}" for c in spec.key)
        raise ValueError(f"{spec.name}: {twice['n_rows']} rows with the key {key}")


# --- publish ---------------------------------------------------------------------------


def publish(
    context: Context, spec: DatasetSpec, rows: DataFrame, history: DataFrame | None = None, planned: DataFrame | None = None
) -> None:
    """Write normalised rows in the dataset's mode. An empty load leaves the table as it is.

    ``planned`` holds the rules that were due, where the dataset has rules, and the keys and years
    where a parent keeps their date.
    """
    table, batch = context.table(spec), context.batch
    names = spec.schema.fieldNames()
    match spec.write:
        case spec_rules.APPEND | spec_rules.INSERT:
            key = [spec.key[0]] if spec.write == spec_rules.INSERT else list(spec.key)
            within = spec.date if spec.date in key else None
            new = writes.absent_rows(table.read_batches(), rows, key, list(ARRIVAL), within)
            _commit(context, spec, batch, (table, new))
        case spec_rules.SLICES:
            table.replace_partitions(rows, spec.slices, batch, partial(ensure_unique, spec))
        case spec_rules.LIKE:
            new = table.stage(rows.select(*names), batch)
            if not new.isEmpty():
                after = writes.replace_like(table.read_version(), new, *spec.rules, planned)
                table.write_version(after, partial(ensure_unique, spec))
        case spec_rules.SNAPSHOT:
            if not rows.isEmpty():
                table.write_version(rows, partial(ensure_unique, spec))
        case spec_rules.RANGE:
            new = table.stage(rows.withColumn("_year", F.year(spec.date)), batch)
            batch = table.next_batch(context.attempt)
            parts = [(table, new), table.marks(_slices(spec), new, batch)]
            if planned is not None:
                beside = parent_table(context, spec)
                after = beside.stage(_dates_after(context, spec, planned, new), context.batch)
                beside.write_batch(after, beside.next_batch(context.attempt), unit=batch)
            publish_together(batch, *parts)
        case spec_rules.REVISE:
            _publish_revised(context, spec, rows.select(*names), history.select(*names))
        case _:
            raise ValueError(f"{spec.name} is published as a pair")


def _publish_revised(context: Context, spec: DatasetSpec, rows: DataFrame, history: DataFrame) -> None:
    """New bars of unchanged symbols and the whole history of revised ones form one batch.

    A revised symbol is replaced only by a history that reaches back to its first stored bar, and
    where the overlap bar decides, it has to be there: else the load fails and the table stays.
    """
    table, batch = context.table(spec), context.batch
    last = state(context, spec)
    actions = revision.classify(None, rows, date=spec.date, lenient=spec.lenient, last=last)
    actions = table.stage(actions, batch)
    missing = actions.filter((F.col("action") == revision.RELOAD) & F.col("overlap_close").isNull()).first()
    if missing is not None:
        raise ValueError(f"{spec.name}: no overlap bar of {missing['symbol']} at {missing['last_date']}")
    revised = revision.revised(actions)
    new = revision.news(rows, actions, date=spec.date)
    some = not revised.isEmpty()
    if some:
        reloaded = history.join(revised, "symbol", "left_semi").select(*rows.columns)
        reach = reloaded.groupBy("symbol").agg(F.min(spec.date).alias("_landed"))
        both = last.join(revised, "symbol", "left_semi").join(reach, "symbol", "left")
        short = both.filter(F.col("_landed").isNull() | (F.col("_landed") > F.col("first_date"))).first()
        if short is not None:
            raise ValueError(f"{spec.name}: the history of {short['symbol']} starts after {short['first_date']}")
        new = new.unionByName(reloaded)
    batch = table.next_batch(context.attempt)
    marks = table.marks(_slices(spec), revised, batch)
    _commit(context, spec, batch, (table, new), marks, replaced=revised if some else None)


# --- run -------------------------------------------------------------------------------

LOG_SPEC = spec_rules.REGISTRY["sync_logs"]


def _log_table(context: Context) -> LakeTable:
    """Runs are appended, each under an id of its own, so that several may end at once."""
    return LakeTable(context.lake, LOG_SPEC.name, StructType([*LOG_SPEC.schema.fields, StructField("_at", TimestampType())]))


def _log(context: Context, spec: DatasetSpec, end: Column, failed: bool) -> None:
    name = F.lit(spec.name)
    done = context.lake.spark.range(1, numPartitions=1).select(
        name.alias("interface"), name.alias("table_name"), F.to_date(end).alias("trade_date")
    )
    log = _log_table(context)
    nothing = reshape.typed_empty(context.lake.spark, LOG_SPEC.schema)
    row = (synclog.fail if failed else synclog.succeed)(nothing, done)
    log.write_batch(row.withColumn("_at", F.current_timestamp()), f"{context.batch}-{uuid.uuid4().hex[:8]}")


def read_log(context: Context) -> DataFrame:
    """The sync log: status of the last run per key, and the date of the last that succeeded."""
    return synclog.latest(_log_table(context).read_batches(), "_at").select(*LOG_SPEC.schema.fieldNames())


def run(
    context: Context,
    spec: DatasetSpec,
    landed: DataFrame,
    universe: DataFrame | None = None,
    marks: DataFrame | None = None,
    history: DataFrame | None = None,
    without: DataFrame | None = None,
) -> None:
    """Load what is missing of one dataset and record it; a failed load is recorded and raised.

    ``universe`` names the keys to plan, or the rules of a dataset that has some; by default each pair of
    values that landed is a rule. Rows whose values are in ``without``, such as delisted symbols, are left out.

    For a revised dataset, ``history`` is where the whole history of revised symbols is read, apart
    from what has landed for this load; without it ``landed`` has to hold it.
    """
    end = cutoff(context, spec)
    try:
        rows = typed(context, spec, landed, end)
        if without is not None:
            rows = joins.without(rows, without, without.columns)
        if spec.rules and universe is None:
            universe = rows.select(*spec.rules).distinct()
        planned = plan(context, spec, end, universe, marks)
        tell = bool(spec.rules or (spec.parent and marks is None))
        if tell:
            planned = _written(context, spec, planned)
        due = pick(context, spec, rows, planned)
        whole = None
        if spec.write == spec_rules.REVISE:
            first = _default_mark(context, spec)
            source = rows if history is None else typed(context, spec, history, end)
            whole = cleaned(spec, source.filter(F.col(spec.date).between(first, end)))
        publish(context, spec, cleaned(spec, due), whole, planned if tell else None)
    except Exception:
        _log(context, spec, end, failed=True)
        raise
    _log(context, spec, end, failed=False)


def rejects_table(context: Context) -> LakeTable:
    return LakeTable(context.lake, "rejected_rows", rejects.SCHEMA, ("table_name", "file"))


def accept(context: Context, spec: DatasetSpec, judged: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Good rows of a judged landing, and the counts of rows and of rejects.

    The landing is parsed once: judged rows are written, and counted by that write. Rejects that the
    table of rejects does not hold yet are appended to it, so a landing may be read again.
    """
    counter = Observation()
    counts = {"rows": F.count(F.lit(1)), "rejects": F.count_if(F.col(rejects.REASON).isNotNull())}
    counted = judged.observe(counter, *[c.alias(n) for n, c in counts.items()])
    label = f"{context.batch}-{spec.name}"
    staged = context.table(spec).stage(counted, f"{label}-judged")
    found = {n: int(counter.get[n]) for n in counts}
    if found["rejects"]:
        table = rejects_table(context)
        # many rejects differ in a few characters only: their files are far smaller than they are
        stored = table.read_batches().select(*rejects.KEY).hint("merge")
        new = joins.without(rejects.rejected(staged, spec.name), stored, rejects.KEY)
        table.write_batch(new, f"{label}-{uuid.uuid4().hex[:8]}")
    return rejects.good(staged), found


def _on_both(left: DataFrame, right: DataFrame, unit: list[str]) -> DataFrame:
    """Units that both sides have rows of, from one grouping; a unit with a null is none."""
    sides = [side.select(*unit, F.lit(n).alias("_side")) for n, side in enumerate((left, right))]
    seen = sides[0].unionByName(sides[1]).dropna("any", subset=unit).groupBy(*unit)
    return seen.agg(F.min("_side").alias("_first"), F.max("_side").alias("_last")).filter("_first < _last").select(*unit)


def run_pair(
    context: Context,
    first: tuple[DatasetSpec, DataFrame],
    second: tuple[DatasetSpec, DataFrame],
    universe: DataFrame,
) -> bool:
    """Load two tables that come from one source together, with one plan from the first.

    A unit is loaded when both sides have rows of it. Until then it stays due, however much later
    units were loaded: the units of a load are written with it as intervals, and the plan is the
    due days without them. Returns whether anything was loaded.
    """
    end = cutoff(context, first[0])
    unit = [first[0].scope, first[0].date]
    try:
        planned = _written(context, first[0], plan_units(context, first[0], end, universe))
        sides = []
        for spec, landed in (first, second):
            due = cleaned(spec, pick(context, spec, typed(context, spec, landed, end), planned))
            sides.append((context.table(spec), context.table(spec).stage(due, context.batch)))
        (one, left), (two, right) = sides
        kept = units_table(context, first[0])
        whole = kept.stage(_on_both(left, right, unit), context.batch)
        n_units = whole.count()
        loaded = n_units > 0
        if loaded:
            parts = [(table, rows.join(_side(whole, n_units), unit, "left_semi")) for table, rows in ((one, left), (two, right))]
            specs = {spec.name: spec for spec, _ in (first, second)}
            unique = lambda table, rows: ensure_unique(specs[table.name], rows) if table.name in specs else None
            publish_together(context.batch, *parts, (kept, units.islands(whole, *unit)), check=unique)
    except Exception:
        _log(context, first[0], end, failed=True)
        raise
    _log(context, first[0], end, failed=False)
    return loaded


def purge_log(context: Context, names: list[str]) -> None:
    """Forget the log rows of tables that are about to be rebuilt; a marker row does it."""
    log = _log_table(context)
    listed = F.explode(F.array(*[F.lit(n) for n in names])).alias("table_name")
    tables = context.lake.spark.range(1, numPartitions=1).select(listed)
    marker = tables.select(
        F.lit(None).cast("string").alias("interface"), "table_name", F.lit(None).cast("date").alias("trade_date"),
        F.lit(synclog.PURGED).alias("status"), F.current_timestamp().alias("_at"),
    )
    log.write_batch(marker, f"{context.batch}-{uuid.uuid4().hex[:8]}")
