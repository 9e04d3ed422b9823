"""Benchmark decontamination: which documents hold a test item, by size-partitioned MinHash containment search.

Texts are words of ASCII letters and digits and all non-ASCII characters, A-Z lower-cased; shingles are
five consecutive words, the whole sequence where there are fewer. Items are partitioned by the number
of their shingles, in classes (u/2, u]. For a class, a document is cut into blocks of u shingles, so
that an item is compared with sets of its own size, however long the document is. A block and an item
are candidates if one of ``HASHES`` minimum hashes is equal. For an item of q shingles of which 0.8
are in the document, wherever they stand, each hash agrees with probability 0.8 q / (q + u) > 0.26 at
least; all 48 miss with probability below 1e-6. Candidates are verified by the exact shingle strings.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import WORD_TABLE, ascii_words, fresh, row_key, staged, table_batches, utf8

SHINGLE, LEAST, HASHES = 5, 0.8, 48
#: Items that go to the tasks together: with their texts and signatures a bounded broadcast. More items take more passes.
BLOCK_ITEMS, BLOCK_BYTES = 5_000, 16 << 20
_RANDOM = np.random.default_rng(11)
#: Odd multipliers and offsets of the hash functions, on 32-bit shingle hashes.
MULTIPLY = (_RANDOM.integers(0, 2**31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
ADD = _RANDOM.integers(0, 2**32, HASHES, dtype=np.uint32)
_WEIGHTS = _RANDOM.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Powers of an odd number and of its inverse modulo 2^64, for hashes of byte ranges from one running sum.
_BASE, _MOST = 0x9E3779B97F4A7C15, 1 << 16
_POWERS, _INVERSE = (
    np.multiply.accumulate(np.full(_MOST, odd, np.uint64)) for odd in (_BASE, pow(_BASE, -1, 1 << 64))
)
_LETTERS = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word of a text, in order; takes all words of a text in a few array operations."""
    out = []
    plain = text.translate(WORD_TABLE) + b" "
    at = 0
    while at < len(plain):
        # slices of whole words that the tables of powers reach; a longer word is hashed on its own
        end = at + _MOST - 1 if len(plain) - at >= _MOST else len(plain)
        if end < len(plain):
            last = plain.rfind(b" ", at, end)
            if last < 0:
                end = plain.index(b" ", end) + 1
                word = plain[at:end].strip()
                out.append(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
                at = end
                continue
            end = last + 1
        data = np.frombuffer(plain, np.uint8, end - at, at)
        blank = data == 32
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        bounds = np.concatenate([[0], edge]) if not blank[0] else edge
        starts, ends = bounds[0::2], bounds[1::2]
        starts = starts[: len(ends)]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_LETTERS[data] * _POWERS[: len(data)], dtype=np.uint64)])
        out.append((sums[ends] - sums[starts]) * _INVERSE[starts])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_hashes(each: np.ndarray) -> np.ndarray:
    """32-bit hash of each shingle, in text order, from the words' hashes."""
    if not len(each):
        return np.empty(0, np.uint32)
    size = min(SHINGLE, len(each))
    n = len(each) - size + 1
    each = each ^ (each >> np.uint64(32))
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += each[i : i + n] * _WEIGHTS[i]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return (total >> np.uint64(32)).astype(np.uint32)


def shingle_set(words: list[bytes]) -> set[bytes]:
    if not words:
        return set()
    size = min(SHINGLE, len(words))
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def signature(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Minimum of hash function k in each run of shingles."""
    return np.minimum.reduceat(hashes * MULTIPLY[k] + ADD[k], starts)


@dataclass
class Items:
    """A block of items: ids, shingle sets, and for each class and function the sorted minima with their items.

    ``marked`` says for the upper 16 bits of a minimum whether any item has it.
    """

    ids: list
    sets: list[set[bytes]]
    tables: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def prepare(rows: list[tuple]) -> Items:
    """rows: (item id, text); items without words are left out."""
    ids, sets, by_class = [], [], {}
    for item, text in rows:
        found = shingle_set(ascii_words(text))
        if found:
            hashes = np.unique(shingle_hashes(word_hashes(text)))
            size = 1 << (len(found) - 1).bit_length()
            by_class.setdefault(size, []).append((len(ids), hashes))
            ids.append(item)
            sets.append(found)
    tables = {}
    for size, members in sorted(by_class.items()):
        starts = np.cumsum([0] + [len(h) for _, h in members[:-1]])
        every, who = np.concatenate([h for _, h in members]), np.array([i for i, _ in members])
        tables[size] = []
        for k in range(HASHES):
            minima = signature(every, starts, k)
            order = np.argsort(minima, kind="stable")
            marked = np.zeros(1 << 16, bool)
            marked[minima >> np.uint32(16)] = True
            tables[size].append((minima[order], who[order], marked))
    return Items(ids, sets, tables)


def candidates(hashes: np.ndarray, bounds: np.ndarray, items: Items) -> set[tuple[int, int]]:
    """(text, item) with an equal minimum in a block of the item's size class; bounds: where each text's shingles start."""
    found: set[tuple[int, int]] = set()
    sizes = np.diff(bounds)
    layout = {}
    for size in items.tables:
        counts = -(-sizes // size)
        row = np.repeat(np.arange(len(sizes)), counts)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        layout[size] = row, bounds[row] + inner * size
    for k in range(HASHES):
        mixed = hashes * MULTIPLY[k] + ADD[k]
        for size, table in items.tables.items():
            (row, starts), (minima, who, marked) = layout[size], table[k]
            own = np.minimum.reduceat(mixed, starts)
            hit = np.flatnonzero(marked[own >> np.uint32(16)])
            low, high = (np.searchsorted(minima, own[hit], side) for side in ("left", "right"))
            for block, i, j in zip(hit[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                found.update((int(row[block]), int(x)) for x in who[i:j])
    return found


def _found(items: Items, least: float):
    names = ["id", "k1", "k2", "item", "n_item", "n_found"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table_batches(batches, 1 << 20):
            texts = utf8(batch.column("text"))
            parts = [shingle_hashes(word_hashes(t)) for t in texts]
            bounds = np.cumsum([0] + [len(p) for p in parts])
            rows, known, result = batch.select(["id", "k1", "k2"]), {}, []
            if bounds[-1]:
                for text, item in sorted(candidates(np.concatenate(parts), bounds, items)):
                    if text not in known:
                        known = {text: shingle_set(ascii_words(texts[text]))}
                    both = len(items.sets[item] & known[text])
                    if both >= least * len(items.sets[item]):
                        result.append((text, items.ids[item], len(items.sets[item]), both))
            if result:
                own = rows.take(pa.array([r[0] for r in result]))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array([r[1] for r in result]), *(pa.array([r[i] for r in result], pa.int64()) for i in (2, 3))],
                    names,
                )

    return run


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items as query blocks of bounded number and size, one at a time on the driver."""
    rows, size = [], 0
    named = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    for row in named.toLocalIterator():
        text = (row["text"] or "").encode()
        rows.append((row["item"], text))
        size += len(text)
        if len(rows) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _pairs(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, least: float) -> DataFrame:
    k1, k2 = row_key(id_col, text_col)
    picked = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    kind, item_kind = dict(picked.dtypes)["id"], dict(items.dtypes)[item_col]
    layout = f"id {kind}, k1 long, k2 int, item {item_kind}, n_item long, n_found long"
    out = None
    for rows in _item_blocks(items, item_col, text_col):
        found = staged(picked.mapInArrow(_found(prepare(rows), least), layout), "leaks")
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], layout) if out is None else out


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least: float = LEAST
) -> DataFrame:
    """(id, item id, n_item, n_found, containment) of every document that holds at least ``least`` of an item's shingles.

    n_item and n_found count distinct shingles. Null and empty texts, and items without words, match
    nothing; an item below five words matches only a text of just these words. Repeated rows and ids
    give a row each. Empty tables give no rows.
    """
    found = _pairs(docs, items, id_col, text_col, item_col, least)
    return found.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "n_item", "n_found", (F.col("n_found") / F.col("n_item")).alias("containment")
    )


def without_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least: float = LEAST
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item."""
    a, b = fresh(docs, "k1", "k2")
    found = _pairs(docs, items, id_col, text_col, item_col, least)
    leaked = found.select(F.col("k1").alias(a), F.col("k2").alias(b)).distinct()
    k1, k2 = row_key(id_col, text_col)
    return docs.withColumns({a: k1, b: k2}).join(leaked, [a, b], "left_anti").select(*docs.columns)
