"""Landed HTML pages as tables.

The pages are machine-made from fixed templates, so their fields are cut out with built-in
regular expressions: parsing stays in generated JVM code, and no page crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import dates, numbers, text
from marketlake.sources import rejects

# Patterns of list rows, table rows, cells and links in landed pages.
TABLE_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
TABLE_BODY = r"(?is)<tbody\b[^>]*>(.*?)</tbody>"
REPORT_ROW = r"""(?is)<tr\b[^>]*\bscope=["']?row["']?[^>]*>(.*?)</tr>"""
CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
LINK = r"""(?is)<a\b[^>]*\bhref=["']([^"']*)["'][^>]*>.*?</a>"""
ANY_TAG = r"(?s)<[^>]*>"


def all_matches(html: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(group))


# Named entities that are decoded, and the form of any entity at the start of what follows "&".
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&"}
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|lt|gt|quot|apos|nbsp|amp);"


def _entity_piece(piece: Column) -> Column:
    """What follows an "&", with the entity that it starts with decoded; otherwise with its "&" again."""
    name = F.regexp_extract(piece, ENTITY, 1)
    rest = F.substring(piece, F.length(name) + 2, F.length(piece))
    digits = F.when(F.lower(F.substring(name, 1, 2)) == "#x", F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10))
    point = F.coalesce(digits, F.substring(name, F.lit(2), F.length(name))).try_cast("int")
    is_char = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    named = F.lit(None).cast("string")
    for entity, char in ENTITIES.items():
        named = F.when(name == entity, F.lit(char)).otherwise(named)
    numeric = F.when(is_char, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
    char = F.when(name.startswith("#"), numeric).otherwise(named)
    return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))


def decoded(value: Column) -> Column:
    """The text with named and numeric entities decoded, each once: ``&amp;lt;`` becomes ``&lt;``. Numbers that are
    no characters, and other names, stay as they are."""
    pieces = F.split(value, "&", -1)
    whole = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(after_first(pieces), _entity_piece), ""))
    return F.when(F.contains(value, F.lit("&")), whole).otherwise(value)


def plain_text(fragment: Column) -> Column:
    """Fragment without tags, trimmed, with entities decoded."""
    return decoded(F.trim(F.regexp_replace(fragment, ANY_TAG, "")))


def after_first(pieces: Column) -> Column:
    """All elements but the first, such as the pieces that follow a marker. A text is shorter than
    2^31 bytes, so it cannot hold 2^30 markers."""
    return F.slice(pieces, 2, 2**30)


def fragments(pages: DataFrame, page: str, html: str, pattern: str, group: int = 1) -> DataFrame:
    """(page, position, fragment) for every match of the pattern, in page order."""
    return pages.select(page, F.posexplode(all_matches(F.col(html), pattern, group)).alias("pos", "fragment"))


def report_links(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, position, report date, link) of rows with exactly three cells; ``pos`` descending
    is oldest first, because the source lists the newest report on top."""
    rows = fragments(pages, page, html, REPORT_ROW)
    cells = rows.withColumn("cells", all_matches(F.col("fragment"), CELL)).filter(F.size("cells") == 3)
    return cells.select(
        page,
        "pos",
        dates.parse_text_date(plain_text(F.col("cells")[0])).alias("report_date"),
        F.regexp_extract(F.col("cells")[2], LINK, 1).alias("href"),
    )


TURNOVER_CELLS = 10


def _turnover_columns() -> list[Column]:
    cell = lambda i: plain_text(F.get("cells", F.lit(i)))
    return [
        dates.parse_date(text.strip_chars(cell(9), "-"), "yyyyMMdd").alias("trade_date"),
        cell(1).alias("symbol"),
        cell(2).alias("symbol_name"),
        numbers.to_number(cell(3)).alias("last_price"),
        numbers.to_number(cell(4), "bigint").alias("short_shares"),
        numbers.to_number(cell(5)).alias("short_avg_price"),
        numbers.to_number(text.drop_unit(cell(6))).alias("short_amount_10k"),
        numbers.to_number(text.drop_unit(cell(7))).alias("amount_10k"),
        numbers.to_number(text.drop_unit(cell(8))).alias("short_pct"),
    ]


def short_turnover(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """Short-turnover rows of the first table body of each page."""
    body = pages.select(page, F.regexp_extract(html, TABLE_BODY, 1).alias("body"))
    rows = fragments(body, page, "body", TABLE_ROW)
    cells = rows.select(page, "pos", all_matches(F.col("fragment"), CELL).alias("cells"))
    return cells.filter(F.size("cells") == TURNOVER_CELLS).select(page, "pos", *_turnover_columns())


def judged_short_turnover(pages: DataFrame, html: str = "html") -> DataFrame:
    """The same with arrival, from pages(html, _batch, _pos): rows with another number of cells, or
    without a readable date or code, are judged. Numbers that cannot be read are null, as a price may be a dash."""
    body = F.regexp_extract(html, TABLE_BODY, 1)
    found = pages.select("_batch", F.col("_pos").alias("_page"), F.posexplode(all_matches(body, TABLE_ROW)).alias("_row", "fragment"))
    cells = found.withColumn("cells", all_matches(F.col("fragment"), CELL))
    place = F.struct(F.col("_page").alias("page"), F.col("_row").alias("row")).alias("_pos")
    rows = cells.select("_batch", place, F.size("cells").alias("_cells"), "fragment", *_turnover_columns())
    broken = {
        "cells": F.col("_cells") != TURNOVER_CELLS,
        "trade_date": F.col("trade_date").isNull(),
        "symbol": F.coalesce(F.col("symbol"), F.lit("")) == "",
    }
    return rejects.judged(rows, F.col("fragment"), broken).drop("_cells", "fragment")


# --- custody pages: two tables in one page ---------------------------------------------

# Class names that mark the parts of a custody page.
DATE_BLOCK = "search-bar__selectedItem-filter searchDate"
STOCK_BLOCK = "search-bar__selectedItem-filter searchStock"
SUMMARY_BLOCK = "ccass-search-datarow"
CATEGORY = "summary-category"
SUMMARY_VALUES = ("shareholding", "number-of-participants", "percent-of-participants")
DETAIL_CELLS = (
    "col-participant-id",
    "col-participant-name",
    "col-shareholding text-right",
    "col-shareholding-percent text-right",
)
VALUE_BLOCK, BODY_BLOCK = "value", "mobile-list-body"


def _block(css: str) -> str:
    """Pattern of the content of the first block with exactly this class attribute."""
    return rf"""(?s)\bclass=["']{css}["'][^>]*>(.*?)</div>"""


def _inner(css: str, inner: str) -> str:
    """Pattern of the content of a block of class ``inner`` that follows a block of class ``css``."""
    return rf"""(?s)\bclass=["']{css}["'][^>]*>.*?\bclass=["']{inner}["'][^>]*>(.*?)</div>"""


def _cut(html: Column | str, pattern: str) -> Column:
    """First match as text, empty when there is none."""
    return plain_text(F.regexp_extract(html, pattern, 1))


def _custody_fragments(pages: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """Fragments of both custody tables, with their place in the page. Pages that answer another date
    than the asked one are left out."""
    shown = F.right(_cut("html", _block(DATE_BLOCK)), F.lit(10))
    stock = _cut("html", _block(STOCK_BLOCK))
    marker = rf"""<div\b[^>]*\bclass=["'](?:[^"']* )?{SUMMARY_BLOCK}(?: [^"']*)?["']"""
    blocks = after_first(F.split("html", marker))
    rows = all_matches(F.regexp_extract("html", TABLE_BODY, 1), TABLE_ROW)
    tagged = lambda kind: lambda f: F.struct(F.lit(kind).alias("kind"), f.alias("fragment"))
    both = F.concat(F.transform(blocks, tagged("summary")), F.transform(rows, tagged("detail")))
    places = F.transform(both, lambda f, i: F.struct(i.alias("_place"), f["kind"].alias("kind"), f["fragment"].alias("fragment")))
    return (
        pages.filter(dates.parse_date(shown, "yyyy/MM/dd") == F.col("asked_date"))
        .withColumn("stock", stock)
        .select("asked_date", "stock", *kept, F.inline(places))
        .select(
            *kept,
            "_place",
            F.col("asked_date").alias("trade_date"),
            text.split_part(F.col("stock"), 0).alias("symbol"),
            text.split_part(F.col("stock"), 1).alias("symbol_name"),
            "kind",
            "fragment",
        )
    )


def _percent(cell: Column) -> Column:
    return numbers.to_number(text.drop_unit(cell))


def _count(cell: Column) -> Column:
    return numbers.to_number(text.strip_chars(cell, ","), "bigint")


CUSTODY_HEAD = ("trade_date", "symbol", "symbol_name")


def _custody_columns() -> list[Column]:
    summed = F.col("kind") == "summary"
    in_summary = lambda css: _cut("fragment", _inner(css, VALUE_BLOCK))
    in_detail = lambda css: _cut("fragment", _inner(css, BODY_BLOCK))
    code, name, held, percent = DETAIL_CELLS
    sum_held, sum_count, sum_percent = SUMMARY_VALUES
    has_percent = summed | F.col("fragment").contains(percent)
    holding = F.when(summed, in_summary(sum_held)).otherwise(in_detail(held))
    share = F.when(summed, in_summary(sum_percent)).otherwise(in_detail(percent))
    return [
        *map(F.col, CUSTODY_HEAD),
        F.col("kind"),
        F.when(summed, _cut("fragment", _block(CATEGORY))).alias("holder_type"),
        F.when(~summed, in_detail(code)).alias("participant_id"),
        F.when(~summed, in_detail(name)).alias("participant_name"),
        _count(holding).alias("holding"),
        F.when(summed, _count(in_summary(sum_count))).alias("participants"),
        F.when(has_percent, _percent(share)).otherwise(0.0).alias("pct"),
    ]


def custody_rows(pages: DataFrame) -> DataFrame:
    """Rows of both custody tables, told apart by ``kind``, from pages(asked_date, html). Each
    page is read once. A detail row without a percentage cell counts as 0 percent."""
    return _custody_fragments(pages).select(*_custody_columns())


def judged_custody(pages: DataFrame) -> DataFrame:
    """The same with arrival, from pages(asked_date, html, _batch, _pos): rows without a readable code,
    holding, holder type or participant are judged."""
    found = _custody_fragments(pages, ("_batch", "_pos"))
    place = F.struct(F.col("_pos").alias("page"), F.col("_place").alias("row")).alias("_pos")
    label = F.coalesce("holder_type", "participant_id", F.lit("")) == ""
    broken = {"symbol": F.coalesce(F.col("symbol"), F.lit("")) == "", "label": label, "holding": F.col("holding").isNull()}
    rows = found.select("_batch", place, "fragment", *_custody_columns())
    return rejects.judged(rows, F.col("fragment"), broken).drop("fragment")


def _arrival(rows: DataFrame) -> list[str]:
    return [c for c in ("_batch", "_pos") if c in rows.columns]


def custody_summary(rows: DataFrame) -> DataFrame:
    return rows.filter("kind = 'summary'").select(
        *CUSTODY_HEAD, "holder_type", "holding", "participants", "pct", *_arrival(rows)
    )


def custody_detail(rows: DataFrame) -> DataFrame:
    return rows.filter("kind = 'detail'").select(
        *CUSTODY_HEAD, "participant_id", "participant_name", "holding", "pct", *_arrival(rows)
    )


# --- interface catalogue ---------------------------------------------------------------

# Leading labels of a catalogue section, in order; the first also fixes the prefix.
CATALOGUE_PREFIX = "接口: stock"
CATALOGUE_LABELS = ("接口: ", "目标地址: ", "描述: ", "限量: ")
FIRST_LABELLED, FEWEST_TAGS = 2, 6


def _catalogue_sections(pages: DataFrame, html: str, kept: list[str]) -> DataFrame:
    """(kept, _section, s, tags, lines): the sections of each page with their first labelled lines.

    A section is read up to the next section start, which is all that its labelled lines need.
    """
    sections = pages.select(*kept, F.posexplode(after_first(F.split(html, r"(?i)<section\b"))).alias("_section", "s"))
    own = F.regexp_replace("s", r"(?is)</section\b.*", "")
    tags = sections.select(*kept, "_section", "s", F.split(own, r"<(?=[a-zA-Z])").alias("tags"))
    # tags[0] is the rest of the section tag; the text of a tag runs to its closing tag
    rest = lambda i: F.concat(F.lit("<"), F.array_join(F.slice("tags", F.lit(i + 2), F.size("tags")), "<"))
    content = lambda i: F.regexp_replace(
        F.regexp_extract(rest(i), r"(?s)^<(\w+)\b[^>]*>(.*?)</\1>", 2), ANY_TAG, ""
    )
    lines = F.array(*[content(FIRST_LABELLED + i) for i in range(4)])
    return tags.withColumn("lines", F.when(F.size("tags") - 1 > FEWEST_TAGS, lines))


def _catalogue_columns() -> list[Column]:
    names = ("interface", "url", "description", "note")
    return [text.strip_label(F.col("lines")[i], CATALOGUE_LABELS[i]).alias(n) for i, n in enumerate(names)]


def interface_catalogue(pages: DataFrame, html: str = "html") -> DataFrame:
    """Interfaces described in pages(html): sections with more than six tags, of which the third
    and fourth carry the fixed labels."""
    wanted = F.col("lines")[0].startswith(CATALOGUE_PREFIX) & F.col("lines")[1].startswith(CATALOGUE_LABELS[1])
    return _catalogue_sections(pages, html, []).filter(wanted).select(*_catalogue_columns())


def judged_catalogue(pages: DataFrame, html: str = "html") -> DataFrame:
    """The same with arrival, from pages(html, _batch, _pos): a section that names an interface of
    the wanted kind, but lacks the label or the text of its address, is judged. Other sections are no rejects."""
    found = _catalogue_sections(pages, html, ["_batch", "_pos"]).filter(F.col("lines")[0].startswith(CATALOGUE_PREFIX))
    place = F.struct(F.col("_pos").alias("page"), F.col("_section").alias("section")).alias("_pos")
    labelled = F.col("lines")[1].startswith(CATALOGUE_LABELS[1]).alias("_labelled")
    rows = found.select("_batch", place, "s", labelled, *_catalogue_columns())
    broken = {"label": ~F.col("_labelled"), "url": F.trim("url") == ""}
    return rejects.judged(rows, F.col("s"), broken).drop("_labelled", "s")
