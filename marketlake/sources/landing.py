"""Readers for landed files. Each adds the arrival order that keep-last needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.functions import dates, numbers, text
from marketlake.sources import rejects

# Field names of the landed short-position report, in file order.
SHORT_REPORT_FIELDS = "trade_date string, symbol string, symbol_name string, short_shares string, short_value string"

# Field names of the landed valuation payload and our names for them.
VALUATION_FIELDS = {
    "TRADE_DATE": "trade_date",
    "SECURITY_CODE": "symbol",
    "SECUCODE": "full_code",
    "SECURITY_NAME_ABBR": "symbol_name",
    "BOARD_CODE": "board_code",
    "BOARD_NAME": "board_name",
    "TOTAL_MARKET_CAP": "market_cap",
    "NOTLIMITED_MARKETCAP_A": "float_cap",
    "CLOSE_PRICE": "close",
    "CHANGE_RATE": "change_pct",
    "TOTAL_SHARES": "total_shares",
    "FREE_SHARES_A": "float_shares",
    "PE_TTM": "pe_ttm",
    "PE_LAR": "pe_lar",
    "PB_MRQ": "pb",
    "PCF_OCF_TTM": "pcf_ttm",
    "PCF_OCF_LAR": "pcf_lar",
    "PS_TTM": "ps_ttm",
    "PEG_CAR": "peg",
}


#: Arrival of a landed row: when its file came, and its place in the file.
ARRIVAL = ("_batch", "_pos")
#: Folder columns of a landing that is dealt out by the date of its rows: the first day of each folder.
FOLDERS = {"day": "_day", "month": "_month", "year": "_year_from"}


def with_arrival(df: DataFrame, lines: bool = False) -> DataFrame:
    """Landed rows with their arrival order: by the time at which the file was written, then by its
    path, then by the place in it.

    File names say nothing about time: those that Spark gives are random. ``lines`` is for text
    formats, which have no row numbers: there the place is the block's start, and a number that grows
    inside the block, as one task reads a block from start to end.
    """
    written = F.lpad(F.unix_micros(F.col("_metadata.file_modification_time")).cast("string"), 20, "0")
    place = F.col("_metadata.row_index")
    if lines:
        place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", F.concat_ws(" ", written, F.col("_metadata.file_path")).alias("_batch"), place.alias("_pos"))


def folder_day(grain: str, date: Column) -> Column:
    """First day of the folder that a date belongs to."""
    return F.to_date(date) if grain == "day" else F.trunc(date, grain)


def land(df: DataFrame, path: str, date: str, grain: str = "day") -> None:
    """Append rows to a landing with a folder per day, month or year. Rows without a date land in a folder of their own."""
    name = FOLDERS[grain]
    dealt = df.withColumn(name, folder_day(grain, F.col(date))).hint("rebalance", F.col(name))
    dealt.write.mode("append").partitionBy(name).parquet(path)


def folder_of(landed: DataFrame) -> tuple[str, str] | None:
    """(folder column, grain) of a landing that is dealt out by date."""
    return next(((name, grain) for grain, name in FOLDERS.items() if name in landed.columns), None)


def read_landing(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Landed Parquet files with arrival order; of a landing with a folder per date also the folder's
    date, by which a load prunes the folders that its plan does not name."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return with_arrival(reader.parquet(path))


#: Column that holds a line or payload which could not be taken apart.
BROKEN = "_broken"
_LENIENT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}


def read_short_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Fields and arrival of all landed short-position reports of some folders, unreadable lines included."""
    reader = spark.read.schema(f"{SHORT_REPORT_FIELDS}, {BROKEN} string").option("header", True).options(**_LENIENT)
    return with_arrival(reader.csv(list(paths)), lines=True)


def read_short_reports(spark: SparkSession, path: str) -> DataFrame:
    """All landed short-position reports of a directory, normalised."""
    return short_positions(read_short_lines(spark, path).drop(BROKEN, *ARRIVAL))


def parse_short_report_lines(lines: DataFrame, column: str) -> DataFrame:
    """The same for reports that landed as a table of text lines."""
    fields = F.from_csv(F.col(column), F.lit(SHORT_REPORT_FIELDS), {"mode": "PERMISSIVE"})
    return short_positions(lines.select(fields.alias("_r")).select("_r.*"))


def _short_columns() -> list[Column]:
    day = dates.parse_date(text.strip_chars(F.col("trade_date"), "/"), "ddMMyyyy")
    return [
        day.alias("trade_date"),
        text.pad_code(F.col("symbol"), 5).alias("symbol"),
        F.col("symbol_name"),
        numbers.to_number(F.col("short_shares"), "bigint").alias("short_shares"),
        numbers.to_number(F.col("short_value"), "bigint").alias("short_value"),
    ]


def short_positions(raw: DataFrame) -> DataFrame:
    """Report rows with a parsed date, a five-digit code and a positive position.

    The code stays text, so its leading zeros survive.
    """
    return raw.select(*_short_columns()).filter(F.col("short_shares") > 0)


def judged_short_positions(lines: DataFrame) -> DataFrame:
    """The same with arrival, for :func:`read_short_lines`; lines without a readable date, code or
    position are judged instead of dropped. A position that is not above zero is no reject: it is left out."""
    fields = [f.split()[0] for f in SHORT_REPORT_FIELDS.split(", ")]
    raw = F.coalesce(F.col(BROKEN), F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields]))
    rows = lines.select(*_short_columns(), *ARRIVAL, BROKEN, raw.alias("_line"))
    broken = {
        "fields": F.col(BROKEN).isNotNull(),
        "trade_date": F.col("trade_date").isNull(),
        "symbol": F.col("symbol").isNull(),
        "short_shares": F.col("short_shares").isNull(),
    }
    judged = rejects.judged(rows, F.col("_line"), broken).drop(BROKEN, "_line")
    return judged.filter(F.col(rejects.REASON).isNotNull() | (F.col("short_shares") > 0))


def explode_payload(df: DataFrame, body: str, fields: dict[str, str], broken: bool = False) -> DataFrame:
    """Rows of ``result.data[]`` in each payload, renamed; other columns are kept.

    Values are read as text, and numbers are coerced by the caller. With ``broken`` a payload that is no
    JSON gives one row with its text in the column of that name.
    """
    element = ", ".join(f"`{name}`: string" for name in fields)
    schema = f"result struct<data: array<struct<{element}>>>, {BROKEN} string"
    kept = [c for c in df.columns if c != body]
    read = df.select(*kept, F.from_json(F.col(body), schema, _LENIENT).alias("_read"))
    whole, text_ = F.col("_read")["result"]["data"], F.col("_read")[BROKEN]
    if not broken:
        return read.select(*kept, F.inline(whole)).withColumnsRenamed(fields)
    rows = read.select(*kept, text_.alias(BROKEN), F.inline_outer(whole)).withColumnsRenamed(fields)
    # a readable payload without rows gives none
    return rows.filter(F.col(BROKEN).isNotNull() | F.coalesce(*fields.values()).isNotNull())


def _valuation_columns() -> list[Column]:
    measures = list(VALUATION_FIELDS.values())[6:]
    return [
        F.col("trade_date").try_cast("date").alias("trade_date"),
        F.col("symbol"),
        F.col("symbol_name"),
        text.split_last(F.col("full_code"), ".").alias("exchange"),
        F.col("board_code"),
        F.col("board_name"),
        *[F.bround(numbers.to_number(F.col(c)), 2).alias(c) for c in measures],
    ]


def valuation_rows(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Valuation payloads as typed rows: exchange from the full code, measures rounded to 2.

    Other columns of the payload table, such as its arrival order, are kept.
    """
    kept = [c for c in payloads.columns if c != body]
    return explode_payload(payloads, body, VALUATION_FIELDS).select(*kept, *_valuation_columns())


def judged_valuations(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The same, with payloads that are no JSON and rows without date or code judged."""
    kept = [c for c in payloads.columns if c != body]
    rows = explode_payload(payloads, body, VALUATION_FIELDS, broken=True)
    raw = F.coalesce(F.col(BROKEN), F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in VALUATION_FIELDS.values()]))
    broken = {"payload": F.col(BROKEN).isNotNull(), "trade_date": F.col("trade_date").isNull(), "symbol": F.col("symbol").isNull()}
    rows = rows.select(*kept, BROKEN, raw.alias("_line"), *_valuation_columns())
    return rejects.judged(rows, F.col("_line"), broken).drop(BROKEN, "_line")


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First page of a sorted source, with the page size in the open."""
    return df.orderBy(*order).limit(n)
