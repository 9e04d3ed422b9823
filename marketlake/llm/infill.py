"""Fill-in-the-middle: texts cut at two unit ends, with middle and suffix exchanged between sentinels.

Units end where a word ends, or where the text does. A batch's UTF-8 bytes are viewed as 64-bit words,
eight bytes at a time: arithmetic on whole words marks the unit-ending bytes by their high bit, a bit
count per word and its running sum number the units of the batch, a search in the running sum finds
the word of the k-th unit end, and a select inside the word finds the byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import fresh

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Batches are worked through in slices of about so many bytes; a longer text is a slice of its own.
SLICE = 8 << 20
_CUTS = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])


def _every(byte: int) -> np.uint64:
    """The byte in all eight places."""
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW7, _ONE = _every(0x80), _every(0x7F), np.uint64(1)


def white(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that is a blank or one of 0x09 to 0x0D; exact, without carries between bytes."""
    seven = words & _LOW7
    blank = ~(((words ^ _every(0x20)) & _LOW7) + _LOW7) & ~words
    control = (seven + _every(0x80 - 0x09)) & ~(seven + _every(0x80 - 0x0E)) & ~words
    return (blank | control) & _HIGH


def unit_ends(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """High bit of every unit-ending byte; ``last`` holds the place of the last byte of each text.

    A unit ends at a byte that is not white before one that is, and at the end of a text, whether that
    is a word's end or closing white space.
    """
    blank = white(words)
    after = blank >> np.uint64(8)
    after[:-1] |= blank[1:] << np.uint64(56)
    marks = ~blank & after & _HIGH
    marks.view(np.uint8)[last] |= 0x80
    return marks


def _select(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place (0 to 7) of the byte that holds the word's mark number ``rank`` (from 1)."""
    flags = (word[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(7))) & _ONE
    return (np.cumsum(flags, axis=1) < rank[:, None]).sum(axis=1)


def cut_points(data: np.ndarray, offsets: np.ndarray, draws: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Units n of each text, and the bytes that the smaller and the larger of draw % (n + 1) units take.

    ``data``: bytes of all texts one after another, text i from offsets[i] to offsets[i + 1].
    """
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    size = int(end[-1]) if len(end) else 0
    padded = np.full(max(1, -(-size // 8)) * 8, 0x20, np.uint8)
    padded[:size] = data[offsets[0] : offsets[0] + size]
    marks = unit_ends(padded.view("<u8"), end[end > start] - 1)
    upto = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def numbered(place: np.ndarray) -> np.ndarray:
        """Unit ends before a byte."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        inside = np.minimum(word, len(marks) - 1)
        whole = np.where(word > 0, upto[word - 1], 0)
        part = np.bitwise_count(marks[inside] & ((_ONE << (byte * np.uint64(8))) - _ONE))
        return whole + np.where(word < len(marks), part, 0)

    base = numbered(start)
    n = numbered(end) - base

    def taken(units: np.ndarray) -> np.ndarray:
        """Bytes of the first units of each text."""
        rank = base + units
        word = np.minimum(np.searchsorted(upto, rank), len(marks) - 1)
        before = np.where(word > 0, upto[word - 1], 0)
        place = word * 8 + _select(marks[word], rank - before) + 1
        return np.where(units > 0, place - start, 0)

    a, b = (d % (n + 1) for d in draws)
    return n, taken(np.minimum(a, b)), taken(np.maximum(a, b))


def _cut(text: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """(n, first, second) of binary texts, for two draws a row."""
    text = text.cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    draws = [np.asarray(d.to_numpy(zero_copy_only=False), np.int64) for d in (low, high)]
    parts, at = [], 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        parts.append(cut_points(data, offsets[at : to + 1], tuple(d[at:to] for d in draws)))
        at = to
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_CUTS))


def draws(seed: int, id_col: str) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of seed, ``:`` and id (null: nothing)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm: int = 80
) -> DataFrame:
    """``docs``, all columns, with n (units), form, prefix_chars, middle_chars and output.

    The form is plain, with the text as output, for empty texts, texts that hold a sentinel and all
    but ``rate`` percent of the others; of these ``spm`` percent have form spm, the rest psm. Null text is
    empty; a null id draws as an id of no digits; rows of one id draw alike and keep a row each. Columns of
    ``docs`` with the names of the results are replaced; without rows there are none. Only the cut
    points come from Python: whole texts, of any length, are taken apart by their bytes.
    """
    out = ["n", "form", "prefix_chars", "middle_chars", "output"]
    text, h1, h2, h3, h4, cuts = fresh(docs, "_text", "_h1", "_h2", "_h3", "_h4", "_cuts")
    numbers = dict(zip((h1, h2, h3, h4), draws(seed, id_col)))
    known = docs.withColumns({text: F.coalesce(F.col(text_col).cast("string"), F.lit("")), **numbers})
    # an annotated function of this module would be pickled by value with its types
    cut = F.arrow_udf(_cut, "n long, first long, second long")
    known = known.withColumn(cuts, cut(F.col(text).cast("binary"), F.col(h1), F.col(h2)))
    body = F.col(text).cast("binary")
    first, second = F.col(cuts)["first"].cast("int"), F.col(cuts)["second"].cast("int")
    prefix = F.substring(body, F.lit(1), first).cast("string")
    middle = F.substring(body, first + 1, second - first).cast("string")
    suffix = F.substring(body, second + 1, F.octet_length(body)).cast("string")
    sentinel = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (F.col(text) == "") | sentinel | (F.col(h3) % 100 >= rate)
    form = F.when(plain, "plain").when(F.col(h4) % 100 < spm, "spm").otherwise("psm")
    output = (
        F.when(form == "plain", F.col(text))
        .when(form == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    )
    results = {
        "n": F.col(cuts)["n"],
        "form": form,
        "prefix_chars": F.when(~plain, F.length(prefix).cast("long")),
        "middle_chars": F.when(~plain, F.length(middle).cast("long")),
        "output": output,
    }
    kept = [F.col(c) for c in docs.columns if c.lower() not in out]
    return known.select(*kept, *[c.alias(name) for name, c in results.items()])


def restored(output: str, form: str) -> Column:
    """The text that an output of the form was made from. A part never holds a sentinel, so the first ones count."""
    value = F.col(output)

    def between(start: str, end: str | None) -> Column:
        rest = F.substring(value, F.instr(value, start) + len(start), F.length(value))
        return rest if end is None else F.substring(rest, F.lit(1), F.instr(rest, end) - 1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(value)
