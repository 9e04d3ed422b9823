"""SimHash near-duplicates: documents link where their 64-bit fingerprints differ in few bits.

Links are found with a Gray-order hierarchical index. Distinct fingerprints are range-partitioned and
sorted by Gray rank, so that neighbours share bits, and cut into blocks; a block's shared bits are its
root pattern. Inside a block the sorted codes form a tree of nodes; a node keeps only the shared bits
that its parent does not have. A search adds up the differing bits along the path from the root and
drops a whole node as soon as the sum exceeds the bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import fresh, row_key, spaced_words, staged, stars, table_batches, utf8
from marketlake.llm.components import connected_components

SEED = 42
#: Fingerprints in a block of the index: its search tree fits in a task (about 1 MB).
BLOCK = 16_384
#: Codes under one node, from the upper level of a block down to single codes.
WIDTHS = (1024, 64, 8, 1)
#: Queries that walk the tree of a block together; bounds the frontier in memory.
TOGETHER = 512


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint: a bit is set where over half of the shingles' XXH64 have it; 0 without words."""
    words = spaced_words(text)
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    count = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 4096):
        chunk = hashes[start : start + 4096].astype(">u8").view(np.uint8)
        ones += np.unpackbits(chunk).reshape(-1, 64).sum(0, dtype=np.uint16)
    return int(np.packbits(2 * ones > count).view(">i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table_batches(batches):
            codes = [fingerprint(t, shingle) for t in utf8(batch.column("text"))]
            columns = [batch.column(c) for c in ("id", "k1", "k2")] + [pa.array(codes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "k1", "k2", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, k1, k2, fp) for every row; k1 and k2 tell rows apart by id and text."""
    k1, k2 = row_key(id_col, text_col)
    picked = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    kind = dict(picked.dtypes)["id"]
    return picked.mapInArrow(_fingerprints(shingle), f"id {kind}, k1 long, k2 int, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the sequence whose neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _ranks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flip = np.uint64(1 << 63)  # signed order of the flipped rank is the unsigned order of the rank
    for batch in batches:
        codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        ranks = (gray_rank(codes) ^ flip).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ranks)], ["fp", "rank"])


def shared_bits(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits that all codes of each run of ``width`` codes share, and their values."""
    starts = np.arange(0, len(codes), width)
    ones, zeros = np.bitwise_and.reduceat(codes, starts), np.bitwise_and.reduceat(~codes, starts)
    return ones | zeros, ones


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted codes of a partition, cut into blocks with their root pattern."""
    held = np.empty(0, np.uint64)

    def rows(codes: np.ndarray) -> pa.RecordBatch:
        mask, value = (int(x[0]) for x in (y.view(np.int64) for y in shared_bits(codes, len(codes))))
        low, high = gray_rank(codes[[0, -1]])
        columns = [[int(codes[0].view(np.int64))], [mask], [value], [int(low >> np.uint64(32))], [int(high >> np.uint64(32))]]
        arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array([codes.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["block", "mask", "value", "low", "high", "codes"])

    for batch in batches:
        held = np.concatenate([held, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
        while len(held) >= BLOCK:
            yield rows(held[:BLOCK])
            held = held[BLOCK:]
    if len(held):
        yield rows(held)


def search(queries: np.ndarray, codes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query index, code index) within the bound; codes are sorted by Gray rank."""
    levels, above = [], None
    for width in WIDTHS:
        mask, value = shared_bits(codes, width)
        own = mask if above is None else mask & ~np.repeat(above[0], above[1] // width)[: len(mask)]
        levels.append((width, own, value))
        above = (mask, width)
    for start in range(0, len(queries), TOGETHER):
        asked = queries[start : start + TOGETHER]
        top = len(levels[0][1])
        who, node = np.repeat(np.arange(len(asked)), top), np.tile(np.arange(top), len(asked))
        sums = np.zeros(len(who), np.uint8)
        for depth, (width, own, value) in enumerate(levels):
            if depth:
                fan = levels[depth - 1][0] // width
                node = (node[:, None] * fan + np.arange(fan)).ravel()
                real = node < len(own)
                who, sums, node = np.repeat(who, fan)[real], np.repeat(sums, fan)[real], node[real]
            sums = sums + np.bitwise_count((asked[who] ^ value[node]) & own[node])
            near = sums <= bits
            who, node, sums = who[near], node[near], sums[near]
        if len(who):
            yield who + start, node


def _links(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, same in zip(*(batch.column(i).to_pylist() for i in range(3))):
                a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                nodes, roots = np.empty(0, np.int64), np.empty(0, np.int64)
                for i, j in search(a, b, bits):
                    if same:
                        i, j = i[i < j], j[i < j]
                    # only a spanning forest of a block pair's links leaves the task
                    nodes, roots = stars(
                        np.concatenate([nodes, a[i].view(np.int64)]), np.concatenate([roots, b[j].view(np.int64)])
                    )
                if len(nodes):
                    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

    return run


def _near_blocks(blocks: DataFrame, n_blocks: int, bits: int) -> DataFrame:
    """Pairs of blocks (i <= j by code) whose root patterns differ in at most ``bits`` bits.

    Blocks meet in a node of the upper index, a prefix of the Gray order; a block visits the prefixes
    within the bound of its own. With 2^depth prefixes there are about as many as blocks.
    """
    depth = min(20, max(0, (n_blocks - 1).bit_length()))
    masks = [sum(1 << p for p in c) for n in range(min(bits, depth) + 1) for c in combinations(range(depth), n)]
    heads = blocks.select("block", "mask", "value", "low", "high").withColumn(
        "own",
        F.explode(F.sequence(F.shiftright("low", 32 - depth), F.shiftright("high", 32 - depth))),
    )
    heads = heads.withColumn("own", F.col("own").bitwiseXOR(F.shiftright("own", 1)))
    visits = heads.withColumn("own", F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: m.bitwiseXOR(F.col("own")))))
    left = heads.select(F.col("own"), F.col("block").alias("i"), F.col("mask").alias("mi"), F.col("value").alias("vi"))
    right = visits.select(F.col("own"), F.col("block").alias("j"), F.col("mask").alias("mj"), F.col("value").alias("vj"))
    apart = F.bit_count(F.col("vi").bitwiseXOR(F.col("vj")).bitwiseAND(F.col("mi")).bitwiseAND(F.col("mj")))
    return left.join(right, "own").filter((F.col("i") <= F.col("j")) & (apart <= bits)).select("i", "j").distinct()


def links(codes: DataFrame, bits: int = 3, column: str = "fp") -> DataFrame:
    """(a, b): a set of links that joins exactly the distinct codes reachable over at most ``bits`` bits."""
    ranked = codes.select(F.col(column).alias("fp")).distinct().mapInArrow(_ranks, "fp long, rank long")
    tree = ranked.repartitionByRange("rank").sortWithinPartitions("rank")
    layout = "block long, mask long, value long, low long, high long, codes binary"
    blocks = staged(tree.select("fp").mapInArrow(_blocks, layout), "gray-blocks")
    pairs = _near_blocks(blocks, blocks.count(), bits)
    left = blocks.select(F.col("block").alias("i"), F.col("codes").alias("left"))
    right = blocks.select(F.col("block").alias("j"), F.col("codes").alias("right"))
    # the pairs are dealt out one by one: a pair is a unit of work of bounded size
    joined = pairs.join(left, "i").join(right, "j").repartition("i", "j")
    return joined.select("left", "right", (F.col("i") == F.col("j")).alias("same")).mapInArrow(_links(bits), "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the rows, and (fp, root) for every distinct fingerprint."""
    own = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    found = connected_components(links(own, bits)).withColumnRenamed("node", "fp")
    codes = own.select("fp").distinct().join(found, "fp", "left")
    return own, codes.select("fp", F.coalesce("component", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3
) -> DataFrame:
    """One row per row of ``docs``: (id, fingerprint, component_id).

    component_id is the smallest id reachable over fingerprints at most ``bits`` bits apart. Texts that
    are null, empty or without words have fingerprint zero and link like any other. Rows that repeat
    an id keep a row each; a null id is never a component_id, unless its component has no other id.
    Fingerprints are linked, not documents: a copy costs one row. An empty table gives no rows.
    """
    own, roots = _grouped(docs, id_col, text_col, shingle, bits)
    codes = own.groupBy("fp").agg(F.min("id").alias("least")).join(roots, "fp")
    least = codes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_code = codes.join(least, "root").select("fp", "component_id")
    return own.join(by_code, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: the one with the smallest id.

    Null ids come last. Of rows with the same id and text one stays; of rows with the same id and other
    texts in one group, the one with the smallest key.
    """
    own, roots = _grouped(docs, id_col, text_col, shingle, bits)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("first")
    codes = own.groupBy("fp").agg(first).join(roots, "fp")
    a, b, n = fresh(docs, "k1", "k2", "n")
    kept = codes.groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.k1").alias(a), F.col("first.k2").alias(b)).distinct().hint("shuffle_hash")
    k1, k2 = row_key(id_col, text_col)
    rows = docs.withColumns({a: k1, b: k2}).join(kept, [a, b])
    numbered = rows.withColumn(n, F.row_number().over(Window.partitionBy(a, b).orderBy(a)))
    return numbered.filter(F.col(n) == 1).select(*docs.columns)
