"""Mixing sources to target weights: token totals per source, repetition rates, whole copies and one chance copy.

A source's target is its weight's share of the wanted tokens, at most ``most`` times what it holds; what it
cannot take is shared among the others. Its rate is target by size: every document is emitted
floor(rate) times, and once more if a number drawn from its hash lies below the rate's fraction.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import fresh, staged
from marketlake.llm.ranks import ranked

#: Words between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that make a document's draw.
DRAW_BITS = 52
_WHOLE = "decimal(38,0)"


def size_of(text: str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, *columns: str) -> Column:
    """A number from 0 to below 1 from a hash of the seed and the values; equal values have equal draws."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
    head = F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), *parts), 256), 1, DRAW_BITS // 4)
    return F.conv(head, 16, 10).cast("long") / F.lit(float(1 << DRAW_BITS))


def targets(
    sized: DataFrame,
    source: str,
    size: str,
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
) -> DataFrame:
    """(source, source_size, target, rate), one row a source.

    Weights repeat over the sources by code point, null last. All share ``share`` times the sum of
    all sizes by weight. Sources above ``most`` times their size are held there, and the rest is shared
    again by the weights of the others, until none is above; each round is one sum over the sources.
    A source without words has target and rate 0.
    """
    sums = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    sums = sums.withColumn("_all", F.lit(0))
    placed = ranked(sums, "_all", [F.col("source").asc_nulls_last()], "_place", "_n")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    placed = staged(placed.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * most
    held, level = -1, None
    while True:
        # the level at which weights are served: what the held sources leave, by the weights of the others
        above = F.lit(False) if level is None else _above(cap, level, share.denominator)
        row = placed.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, cap)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == held or not row["weight"]:
            break
        held = row["n"]
        level = share.numerator * total - share.denominator * (row["held"] or 0), row["weight"]
    if level is None:
        target = F.lit(0.0)
    else:
        served = (F.col("weight") * F.lit(level[0])).cast("double") / F.lit(float(share.denominator * level[1]))
        target = F.when(_above(cap, level, share.denominator), cap.cast("double")).otherwise(served)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return staged(placed.select("source", "source_size", target.alias("target")).withColumn("rate", rate), "targets")


def _above(cap: Column, level: tuple[int, int], denominator: int) -> Column:
    """The weight's share at this level is above the cap, in whole numbers."""
    return F.col("weight").cast(_WHOLE) * F.lit(level[0]).cast(_WHOLE) > cap.cast(_WHOLE) * F.lit(denominator * level[1]).cast(_WHOLE)


def copies(sized: DataFrame, rates: DataFrame, source: str, drawn: str) -> DataFrame:
    """``sized`` with source_size, target and copies (long): the whole part of the rate, and one more by chance.

    A source's few numbers meet its documents in an equi-join that adaptive execution broadcasts if
    they measure small, and splits at hot sources if not.
    """
    name, rate = fresh(sized, "_source", "_rate")
    known = rates.select(F.col("source").alias(name), "source_size", "target", F.col("rate").alias(rate))
    joined = sized.join(known, F.col(source).eqNullSafe(F.col(name)), "inner")
    whole = F.floor(rate)
    extra = (F.col(drawn) < F.col(rate) - whole).cast("long")
    return joined.withColumn("copies", whole + extra).drop(name, rate)


def repetitions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 42,
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
) -> DataFrame:
    """(id, size, source_size, target, copies) of every document.

    Null text has size 0, a null source is a source of its own, and a null id draws like a value. The
    draw hashes id, source and text: documents that share an id draw apart, equal rows draw alike and keep
    a row each. Other columns do not matter. Without documents there are no rows. Texts are read once:
    ids, sources, sizes and draws are written to the shared folder.
    """
    narrow = docs.select(
        F.col(id_col),
        F.col(source_col).cast("string").alias("_source"),
        size_of(text_col).alias("size"),
        draw(seed, id_col, source_col, text_col).alias("_draw"),
    )
    narrow = staged(narrow, "sized")
    out = copies(narrow, targets(narrow, "_source", "size", weights, share, most), "_source", "_draw")
    return out.select(id_col, "size", "source_size", "target", "copies")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 42,
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
) -> DataFrame:
    """The mixture: rows of ``docs``, all columns, each as often as :func:`repetitions` says, with ``copy`` from 1.

    Sizes are counted once for the totals and once when the documents are emitted, so that whole texts are
    not written in between. A column ``copy`` of ``docs`` is replaced. Nulls, equal rows and empty tables are
    as in :func:`repetitions`.
    """
    kept = [c for c in docs.columns if c.lower() != "copy"]
    source, size, drawn = fresh(docs, "_source", "_size", "_draw")
    sized = docs.withColumns(
        {source: F.col(source_col).cast("string"), size: size_of(text_col), drawn: draw(seed, id_col, source_col, text_col)}
    )
    rates = targets(sized.select(source, size), source, size, weights, share, most)
    # only the names that are needed go into the join, as those of the documents may clash with it
    values = F.struct(*kept).alias("_row")
    repeated = copies(sized.select(values, source, drawn), rates, source, drawn)
    once = repeated.filter("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return once.select("_row.*", "copy")
