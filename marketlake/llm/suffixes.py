"""Removal of repeated byte strings: a sparse, enhanced suffix array with its common-prefix interval tree.

A byte goes if a string of ``length`` bytes that covers it also starts earlier. Two equal strings of that
length hold the same anchor, the k-gram with the smallest hash, at the same place. So suffixes are taken
at anchors only, and each anchor carries the bytes around it, its context, that such a string can reach.

1. Exact copies: of equal texts only the first goes on; the others are covered wholly.
2. Where a context repeats within a batch of texts, all but its first place are covered at once, and
   travel apart from their k-gram: of a hot passage a k-gram gets one anchor a batch, not one a document.
   The others are sorted by k-gram, context digest and place. Lone k-grams drop out. Where a context
   repeats, the later ones are covered; the first of each different context goes on.
3. Contexts of a k-gram are sorted as suffixes with their common-prefix lengths. A stack scan yields the
   prefix intervals; inside an interval the left extensions are scanned in the same way, so that each
   maximal repeat comes with all its occurrences. All but the first occurrence are covered.
4. The covered ranges of a document are united.

A text is told by its id ``d`` and ``t``, the first 60 bits of its MD5: what is gathered for a row is that of its
own text, however many texts share an id. Texts that agree in both stand one after another, at their ``base``.

Step 3 holds the contexts of at most ``GROUP`` anchors of a k-gram. Beyond that, each string goes on its
own, as a 128-bit digest, and equal ones stand next to each other and stream by; those that repeat
within a batch are covered at once here too.

Contexts are told apart by a 64-bit digest under a 64-bit k-gram hash: two different ones are taken for
equal with a probability below 2^-64 a pair of anchors that share their k-gram.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import fresh, staged, table_batches, utf8

LENGTH = 100
#: Bytes of an anchor's k-gram: long enough that chance repeats are rare.
GRAM = 24
#: Contexts of one k-gram that are sorted together, at most.
GROUP = 65_536
LAST = 2**63 - 1
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the k-gram at every position, by doubling."""
    parts, width, code, offset, total = [], 1, _TABLE[data], 0, None
    while True:
        if gram & width:
            parts.append((offset, code))
            offset += width
        if width * 2 > gram:
            break
        code = code[:-width] * np.uint64(0x9E3779B97F4A7C15) + code[width:]
        code ^= code >> np.uint64(31)
        width *= 2
    n = max(0, len(data) - gram + 1)
    for start, code in parts:
        piece = code[start : start + n]
        total = piece.copy() if total is None else total * np.uint64(0xD6E8FEB86659FD93) + piece
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(29))


def _slide(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """The picked (smallest or largest) value of every run of ``width`` values."""
    step = 1
    while step * 2 <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return pick(values[: len(values) - (width - step)], values[width - step :]) if width > step else values


def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(positions, k-gram hashes) of the anchors of all strings of ``length`` bytes inside one text.

    ``starts`` are the bounds of the texts in ``data``.
    """
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    full = gram_hashes(data, gram)
    order = (full >> np.uint64(32)).astype(np.uint32)
    order[order == 0xFFFFFFFF] = 0xFFFFFFFE
    for end in starts[1:]:  # k-grams over the end of a text
        order[max(0, end - gram + 1) : end] = 0xFFFFFFFF
    width = length - gram + 1
    lows = _slide(order, width, np.minimum)
    inside = np.ones(len(lows), bool)
    for end in starts[1:-1]:  # strings over the end of a text
        inside[max(0, end - length + 1) : end] = False
    lows[~inside] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint32), lows, np.zeros(width - 1, np.uint32)])
    chosen = np.flatnonzero((_slide(padded, width, np.maximum) == order) & (order != 0xFFFFFFFF))
    return chosen, full[chosen]


def _own_part(parts: list[dict], tag: str) -> dict:
    return next(p for p in parts if p["tag"] == tag)


def _anchor_rows(text: str, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table_batches(batches, 2 << 20):
            texts, owners = [], []
            for body, doc, half, key, own in zip(utf8(batch.column(text)), *(batch.column(c).to_pylist() for c in names)):
                part = _own_part(own, key)
                if part["first"] and len(body) >= LENGTH:
                    texts.append(body), owners.append((doc, half, part["base"]))
            if not texts:
                continue
            starts = np.cumsum([0] + [len(t) for t in texts])
            everything = b"".join(texts)
            place, hashes = anchors(np.frombuffer(everything, np.uint8), starts)
            row = np.searchsorted(starts, place, "right") - 1
            left = np.maximum(place - (LENGTH - GRAM), starts[row])
            right = np.minimum(place + LENGTH, starts[row + 1])
            digest = xxhash.xxh3_64_intdigest
            context = np.fromiter(
                (digest(everything[i:j], p - i) for i, j, p in zip(left.tolist(), right.tolist(), place.tolist())),
                np.uint64,
                len(place),
            )
            doc, half, base = np.array(owners, np.int64)[row].T
            rows = np.stack([hashes.view(np.int64), context.view(np.int64), doc, half, base + place - starts[row]])
            later = _later(rows)
            # nothing is compared for what is covered: it needs neither k-gram nor digest
            rows[0] = np.where(later, _spread(rows[2], rows[4]), rows[0])
            rows[1][later] = 0
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows] + [pa.array(later)], ANCHOR)

    return run


#: Anchor rows: k-gram (of a covered one a number that deals it out), context digest, place, and whether it is known to be covered.
ANCHOR = ["h", "c", "d", "t", "p", "later"]


def _later(rows: np.ndarray) -> np.ndarray:
    """Whether a row (what repeats in two fields, place in three) has an equal with a smaller place among these."""
    order = np.lexsort(rows[::-1])
    own = rows[:, order]
    first = np.concatenate([[True], (own[:2, 1:] != own[:2, :-1]).any(0)]) if own.shape[1] else np.zeros(0, bool)
    start = np.flatnonzero(first)[np.cumsum(first) - 1]
    out = np.empty(own.shape[1], bool)
    # the same place again is no repeat
    out[order] = (own[2:] != own[2:, start]).any(0)
    return out


def _spread(*fields: np.ndarray) -> np.ndarray:
    """A number that deals rows out evenly, whatever their k-gram."""
    mixed = np.zeros(len(fields[0]), np.uint64)
    for field in fields:
        mixed = (mixed ^ field.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams anchors sorted by (h, c, d, t, p): what repeats wholly (kind 0), and what is to be compared (1, 2: large group).

    Anchors that are known to be covered pass through; the others are dealt by their k-gram. Of the group that is still open, at most GROUP requests are held back.
    """
    schema = ["d", "t", "p", "h", "kind"]
    last_h, last_c, last_place = None, None, (None, None, None)
    held: list[np.ndarray] = []  # requests of the group that is still open
    count = 0

    def out(rows: np.ndarray, kinds: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*rows.T, kinds.astype(np.int8))], schema)

    def close() -> Iterator[pa.RecordBatch]:
        if count > 1 and held:
            rows = np.concatenate(held)
            yield out(rows, np.full(len(rows), 2 if count > GROUP else 1))

    for batch in batches:
        known = batch.column(5).to_numpy(zero_copy_only=False)
        h, c, d, t, p = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if known.any():
            yield out(np.stack([d, t, p, h], 1)[known], np.zeros(known.sum()))
            h, c, d, t, p = (x[~known] for x in (h, c, d, t, p))
        if not len(h):
            continue
        new_h = h != np.concatenate([[~h[0] if last_h is None else last_h], h[:-1]])
        new = new_h | (c != np.concatenate([[0 if last_c is None else last_c], c[:-1]]))
        # equal rows of the table give the same anchors again
        again = ~new
        again[1:] &= (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (p[1:] == p[:-1])
        again[0] &= (d[0], t[0], p[0]) == last_place
        last_h, last_c, last_place = h[-1], c[-1], (d[-1], t[-1], p[-1])
        rows = np.stack([d, t, p, h], 1)
        later = ~new & ~again
        if later.any():
            yield out(rows[later], np.zeros(later.sum()))
        group, rows = np.cumsum(new_h)[new], rows[new]
        sizes = np.bincount(group, minlength=int(new_h.sum()) + 1)
        held.append(rows[group == 0])
        count += int(sizes[0])
        if len(sizes) > 1:
            yield from close()
            whole = (group > 0) & (group < len(sizes) - 1) & (sizes[group] > 1)
            if whole.any():
                yield out(rows[whole], np.where(sizes[group[whole]] > GROUP, 2, 1))
            held, count = [rows[group == len(sizes) - 1]], int(sizes[-1])
        if count > GROUP:
            yield from close()
            held = []
    yield from close()


def _lists(column: pa.ListArray) -> tuple[list[int], list[np.ndarray]]:
    """Bounds of each row's list in the flat values, and the fields of these."""
    bounds = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)]))
    return bounds.tolist(), [f.to_numpy(zero_copy_only=False) for f in column.flatten().flatten()]


def _context_rows(text: str, names: list[str]):
    d, t, tag, parts, marks = names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table_batches(batches, 4 << 20):
            rows: list[tuple] = []
            whole: list[tuple] = []  # strings of large groups
            bounds, (places, grams, kinds) = _lists(batch.column(marks))
            columns = (batch.column(c).to_pylist() for c in (d, t, tag, parts))
            for i, (body, doc, half, key, own) in enumerate(zip(utf8(batch.column(text)), *columns)):
                part = _own_part(own, key)
                base, n = part["base"], len(body)
                if not part["first"] or bounds[i] == bounds[i + 1]:
                    continue
                mine = slice(bounds[i], bounds[i + 1])
                asked = kinds[mine] > 0
                for at, gram, kind in zip((places[mine][asked] - base).tolist(), grams[mine][asked].tolist(), kinds[mine][asked].tolist()):
                    if not 0 <= at < n:
                        continue
                    low, high = max(0, at - (LENGTH - GRAM)), min(n, at + LENGTH)
                    if kind == 1:
                        rows.append((gram, body[low:at][::-1], body[at:high], doc, half, base + at))
                    else:
                        for start in range(low, high - LENGTH + 1):
                            string = xxhash.xxh3_128_digest(body[start : start + LENGTH])
                            whole.append((int.from_bytes(string[:8], "big", signed=True), None, string, doc, half, base + start))
                    if len(rows) + len(whole) > 200_000:
                        yield _rows(rows + _dealt(whole))
                        rows, whole = [], []
            if rows or whole:
                yield _rows(rows + _dealt(whole))

    return run


def _dealt(whole: list[tuple]) -> list[tuple]:
    """Strings of large groups: those that an earlier one among them repeats lose their digest, and are dealt out by their place."""
    if not whole:
        return whole
    halves = np.array([(r[0], int.from_bytes(r[2][8:], "big", signed=True), *r[3:]) for r in whole], np.int64).T
    deal = _spread(halves[2], halves[4])
    return [(int(deal[i]), None, None, *r[3:]) if late else r for i, (r, late) in enumerate(zip(whole, _later(halves).tolist()))]


CONTEXT = pa.schema([("h", pa.int64()), ("left", pa.binary()), ("right", pa.binary()), ("d", pa.int64()), ("t", pa.int64()), ("p", pa.int64())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTEXT)], schema=CONTEXT)


def _matrix(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in rows of a fixed width, a multiple of eight, and their lengths."""
    return (
        np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(-1, width),
        np.fromiter(map(len, values), np.int64, len(values)),
    )


def _sorted(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.lexsort((lengths, *np.ascontiguousarray(matrix).view(">u8").T[::-1]))


def _prefixes(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common-prefix lengths of neighbouring rows."""
    differ = matrix[1:] != matrix[:-1]
    common = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
    return np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))


def intervals(prefixes: Iterable[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of the neighbours' common-prefix lengths: (first, last, depth) of each interval of depth >= least."""
    stack: list[tuple[int, int]] = []  # (depth, first)
    place = 0
    for place, depth in enumerate(prefixes):
        first = place
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield first, place, top
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    while stack:
        top, first = stack.pop()
        yield first, place + 1, top


def maximal_repeats(groups: np.ndarray, left: list[bytes], right: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, int, int]]:
    """(occurrences, left extent, right extent) of the maximal repeats of at least ``length`` bytes around anchors.

    left: the bytes before an anchor, reversed; right: those from the anchor on. Occurrences are
    indices into these; only those of one group are compared.
    """
    after, after_n = _matrix(right, -(-length // 8) * 8)
    before, before_n = _matrix(left, -(-length // 8) * 8)
    order = np.lexsort((after_n, *np.ascontiguousarray(after).view(">u8").T[::-1], groups))
    common = _prefixes(after[order], after_n[order])
    common[groups[order][1:] != groups[order][:-1]] = -1
    pair = _prefixes(before[order], before_n[order])
    for first, last, depth in intervals(common.tolist(), 1):
        need = max(0, length - depth)
        members = order[first : last + 1]
        if len(members) == 2:
            if pair[first] >= need:
                yield members, int(pair[first]), depth
            continue
        # left-extension diversity: where members go on differently to the left, each branch is a repeat of its own
        branch = members[_sorted(before[members], before_n[members])]
        for i, j, reach in intervals(_prefixes(before[branch], before_n[branch]).tolist(), need):
            yield branch[i : j + 1], reach, depth


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams contexts sorted by (h, left, right, d, t, p) and gives the covered ranges."""
    held: list[tuple] = []
    opened = 0  # where the group that is still open starts in ``held``
    last: tuple | None = None
    covered: tuple | None = None  # the last row that repeats ``last``
    ranges: list[tuple[int, int, int, int]] = []

    def flush(rows: list[tuple]):
        if len(rows) < 2:
            return
        groups = np.array([r[0] for r in rows])
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort([[r[i] for r in rows] for i in (5, 4, 3)])] = np.arange(len(rows))
        reach = np.full((2, len(rows)), -1)
        for found, before, after in maximal_repeats(groups, [r[1] for r in rows], [r[2] for r in rows]):
            later = found[rank[found] != rank[found].min()]
            reach[0, later] = np.maximum(reach[0, later], before)
            reach[1, later] = np.maximum(reach[1, later], after)
        for i in np.flatnonzero(reach[1] >= 0).tolist():
            ranges.append((*rows[i][3:5], rows[i][5] - int(reach[0, i]), rows[i][5] + int(reach[1, i])))

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*ranges)], ["d", "t", "s", "e"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if row[2] is None:  # known to be covered
                ranges.append((*row[3:5], row[5], row[5] + LENGTH))
                continue
            if row == last or row == covered:  # a whole string that two anchors share, or a row that is there again
                continue
            if last is not None and row[:3] == last[:3]:
                before, after = (len(row[1]), len(row[2])) if row[1] is not None else (0, LENGTH)
                ranges.append((*row[3:5], row[5] - before, row[5] + after))
                covered = row
                continue
            if row[1] is None:  # the first of equal whole strings
                last = row
                continue
            if last is not None and row[0] != last[0]:
                if len(held) - opened == 1:
                    held.pop()  # alone in its group
                if len(held) > GROUP:
                    flush(held)
                    held = []
                opened = len(held)
            held.append(row)
            last = row
        if len(ranges) > 50_000:
            yield out()
            ranges = []
    flush(held)
    if ranges:
        yield out()


def united(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([first[1:], [True]])
    return list(zip(starts[first].tolist(), ends[last].tolist()))


def kept_bytes(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    bounds = [0, *(x for span in spans for x in span), len(body)]
    return b"".join(body[i:j] for i, j in zip(bounds[::2], bounds[1::2]))


def kept_text(body: bytes, spans: list[tuple[int, int]]) -> str:
    """What is left as text: a character goes if any of its bytes goes."""
    wide = []
    for start, end in spans:
        while 0 < start < len(body) and body[start] & 0xC0 == 0x80:
            start -= 1
        while end < len(body) and body[end] & 0xC0 == 0x80:
            end += 1
        wide.append((start, end))
    return kept_bytes(body, united(*np.array(wide, np.int64).reshape(-1, 2).T)).decode()


def _finish(text: str, names: list[str], columns: list[str], give: Callable, extra: list[str]):
    tag, parts, marks, covers = names[2:]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table_batches(batches, 8 << 20):
            results = []
            mark_bounds, (places, _, kinds) = _lists(batch.column(marks))
            cover_bounds, (starts, ends) = _lists(batch.column(covers))
            values = (batch.column(c).to_pylist() for c in (tag, parts))
            for i, (body, key, own) in enumerate(zip(utf8(batch.column(text)), *values)):
                part = _own_part(own, key)
                base, n = part["base"], len(body)
                if not part["first"]:
                    results.append(give(body, [(0, n)] if n >= LENGTH else []))
                    continue
                mine = slice(mark_bounds[i], mark_bounds[i + 1])
                at = places[mine][kinds[mine] == 0] - base
                at = at[(at >= 0) & (at < n)]
                mine = slice(cover_bounds[i], cover_bounds[i + 1])
                low, high = starts[mine] - base, ends[mine] - base
                own_range = (low >= 0) & (low < n)
                results.append(
                    give(
                        body,
                        united(
                            np.concatenate([np.maximum(at - (LENGTH - GRAM), 0), low[own_range]]),
                            np.concatenate([np.minimum(at + LENGTH, n), high[own_range]]),
                        ),
                    )
                )
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array([r[i] for r in results], TYPES[c][1]) for i, c in enumerate(extra)], columns + extra
            )

    return run


TYPES = {
    "n_bytes": ("long", pa.int64()),
    "n_removed": ("long", pa.int64()),
    "n_spans": ("long", pa.int64()),
    "kept_sha256": ("string", pa.string()),
    "kept": ("string", pa.string()),
    "spans": ("array<struct<start:long,end:long>>", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
}


def _digest(body: bytes, spans: list[tuple[int, int]]) -> tuple:
    kept = kept_bytes(body, spans)
    return len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


def _text_and_spans(body: bytes, spans: list[tuple[int, int]]) -> tuple:
    return kept_text(body, spans), [{"start": s, "end": e} for s, e in spans]


def _applied(docs: DataFrame, id_col: str, text_col: str, give: Callable, extra: list[str]) -> DataFrame:
    """``docs`` with the columns that ``give`` makes from a text and its removed runs.

    One plan: the texts are shuffled by id and MD5 once, and that exchange is read again for the
    contexts and for the results; so are the marks.
    """
    d, t, tag, parts, marks, covers = names = fresh(docs, "d", "t", "tag", "parts", "marks", "covers")
    source = docs.withColumns({d: F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), tag: F.md5(F.coalesce(F.col(text_col), F.lit("")))})
    source = source.withColumn(t, F.conv(F.substring(tag, 1, 15), 16, 10).cast("long"))
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
    sizes = source.select(F.col(d).alias("d"), F.col(t).alias("t"), F.col(tag).alias("tag"), size.alias("n")).distinct()
    ordered = Window.partitionBy("d", "t").orderBy("tag").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("base", F.coalesce(F.sum("n").over(ordered), F.lit(0)).cast("long"))
    firsts = placed.groupBy("tag").agg(F.min("d").alias("least"))
    own = F.struct("tag", "base", (F.col("d") == F.col("least")).alias("first"))
    info = placed.join(firsts, "tag").groupBy("d", "t").agg(F.collect_list(own).alias("parts"))
    info = staged(info, "copies").select(F.col("d").alias(d), F.col("t").alias(t), F.col("parts").alias(parts))
    placed_docs = source.join(info.hint("shuffle_hash"), [d, t])
    found = placed_docs.mapInArrow(_anchor_rows(text_col, [d, t, tag, parts]), "h long, c long, d long, t long, p long, later boolean")
    marked = found.repartition("h").sortWithinPartitions("h", "c", "d", "t", "p").mapInArrow(_marks, "d long, t long, p long, h long, kind byte")
    by_text = [F.col("d").alias(d), F.col("t").alias(t)]
    asked = placed_docs.join(marked.groupBy(*by_text).agg(F.collect_list(F.struct("p", "h", "kind")).alias(marks)).hint("shuffle_hash"), [d, t], "left")
    contexts = asked.mapInArrow(
        _context_rows(text_col, [d, t, tag, parts, marks]), "h long, left binary, right binary, d long, t long, p long"
    )
    compared = (
        contexts.repartition("h").sortWithinPartitions("h", "left", "right", "d", "t", "p").mapInArrow(_compare, "d long, t long, s long, e long")
    )
    covered = compared.groupBy(*by_text).agg(F.collect_list(F.struct("s", "e")).alias(covers))
    final = asked.join(covered.hint("shuffle_hash"), [d, t], "left")
    kept = [f for f in docs.schema.fields if f.name not in extra]
    layout = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{c} {TYPES[c][0]}" for c in extra])
    return final.mapInArrow(_finish(text_col, names, [f.name for f in kept], give, extra), layout)


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for every row.

    Texts are UTF-8 bytes, null is empty, and strings never cross documents. Order is by id, nulls
    last, then by start; rows that share an id are parts of one document in the order of their
    texts' MD5, and equal rows of an id are one and the same. Texts below ``LENGTH`` bytes stay
    whole. An empty table gives no rows.
    """
    picked = docs.select(id_col, text_col)
    extra = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return _applied(picked, id_col, text_col, _digest, extra).select(id_col, *extra)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with repeated strings cut out of the texts; no row goes.

    Same rules as :func:`repeat_digests`; a character of which a byte is removed goes as a whole.
    A null text comes back empty.
    """
    kept, spans = fresh(docs, "kept", "spans")
    types = {kept: TYPES["kept"], spans: TYPES["spans"]}
    TYPES.update(types)
    out = _applied(docs, id_col, text_col, _text_and_spans, [kept, spans])
    return out.withColumn(text_col, F.col(kept)).select(*docs.columns)
