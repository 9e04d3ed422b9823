"""URL filter: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of blocks of eight 32-bit words; a URL's hash picks the block and one bit of each
word. Probing is an equi-join with the blocks and a bit test, so the whole filter is DataFrame work. Only
possible hits reach the exact hash join with the list, which removes the false positives.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import fresh, staged

#: URLs per block: 16 bits for a URL.
PER_BLOCK = 16
#: Blocks that are broadcast at most, 2^18 * 40 bytes = 10 MB. The filter of a longer list is joined by block instead.
MOST_BLOCKS = 1 << 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)[?]?([^#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one or for null."""
    url = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host part or for null."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: str | Column) -> Column:
    """Host without ``www.``, path without closing slashes, query sorted and without tracking fields; no scheme, no fragment."""
    url = F.col(url) if isinstance(url, str) else url
    fields = F.split(F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit("")), "&")
    fields = F.filter(fields, lambda f: (f != "") & ~f.startswith("utm_") & ~f.startswith("ref="))
    query = F.array_join(F.array_sort(fields), "&")
    base = F.concat(F.regexp_replace(host(url), "^www[.]", ""), F.regexp_replace(path(url), "/+$", ""))
    return F.when(query == "", base).otherwise(F.concat_ws("?", base, query))


def first_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else null; ties go to the first in the list."""
    none = F.lit(None).cast("string")
    text, verdict = none, none
    for rule in reversed(sorted(rules, key=lambda r: -len(r.text))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit in each of eight 32-bit words, two words in a long."""
    slices = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(slices, 5 * i).bitwiseAND(F.lit(31)).cast("int") + 32 * (i % 2)
        return F.call_function("shiftleft", one, place)

    return [bit(2 * j).bitwiseOR(bit(2 * j + 1)) for j in range(4)]


def bloom_filter(listed: DataFrame, key: str, count: int) -> tuple[DataFrame, int]:
    """(block, w0..w3) of the keys, and the number of blocks; combined on the map side."""
    blocks = max(1, -(-count // PER_BLOCK))
    own = listed.select(_block(F.col(key), blocks).alias("block"), *[b.alias(f"w{j}") for j, b in enumerate(_bits(F.col(key)))])
    return own.groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(4)]), blocks


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """``pages``, all columns, with host, path, canonical_url, rule, listed and verdict.

    The longest rule that fits decides; without one, a page whose canonical URL is on the list is
    blocked and any other allowed. Columns of ``pages`` with these names are replaced. A null URL, or
    one without ``://``, has empty host and path and fits no rule; nothing without a host is listed.
    Repeated rows keep a row each; empty tables give no rows, an empty list blocks nothing.
    """
    out = ["host", "path", "canonical_url", "rule", "listed", "verdict"]
    kept = [c for c in pages.columns if c.lower() not in out]
    url = F.col(url_col)
    parts = pages.select(*kept, host(url).alias("host"), path(url).alias("path"), F.coalesce(canonical(url), F.lit("")).alias("canonical_url"))
    rule, verdict = first_rule(rules, F.col("host"), F.col("path"))
    block, decided, *words = fresh(parts, "block", "decided", "w0", "w1", "w2", "w3")
    parts = parts.withColumns({"rule": rule, decided: verdict})
    urls = listed.select(canonical(listed_col).alias("canonical_url")).filter("canonical_url <> ''").distinct()
    urls = staged(urls, "listed")
    bits, blocks = bloom_filter(urls, "canonical_url", urls.count())
    bits = bits.select(F.col("block").alias(block), *[F.col(f"w{j}").alias(w) for j, w in enumerate(words)])
    bits = F.broadcast(bits) if blocks <= MOST_BLOCKS else staged(bits, "filter")
    probed = parts.withColumn(block, _block(F.col("canonical_url"), blocks)).join(bits, block, "left")
    masks = _bits(F.col("canonical_url"))
    maybe = reduce(lambda a, b: a & b, [F.col(w).isNotNull() & (F.col(w).bitwiseAND(m) == m) for w, m in zip(words, masks)])
    # possible hits alone take part in the exact join
    misses = probed.filter(~maybe).withColumn("listed", F.lit(False))
    known = urls.withColumn("listed", F.lit(True))
    hits = probed.filter(maybe).join(known, "canonical_url", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    both = misses.unionByName(hits)
    judged = F.coalesce(F.col(decided), F.when(F.col("listed"), "block").otherwise("allow"))
    return both.withColumn("verdict", judged).select(*kept, *out)
