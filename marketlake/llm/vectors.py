"""Embedding near-duplicates: subspace pigeonhole join on rotated unit vectors.

Unit vectors with cosine c are 2 - 2c apart in squared distance. The rotated dimensions are split into
``BLOCKS`` blocks; two vectors within a squared distance e are within e / BLOCKS in at least one block. In
each block a vector belongs to a cell of a grid over the block's first dimensions and visits the lower
cells that it comes near to, so that every pair within the block's budget meets once. Candidates are verified
by the exact cosine, and a link counts in the first block whose budget it meets.

Equal vectors are one row with their number. A cell of more than ``CHUNK`` vectors is cut into chunks,
which are compared pair by pair in tasks of their own. A task gives link counts and a spanning forest,
never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged, stars, table_batches
from marketlake.llm.components import connected_components

BLOCKS, GRID = 8, 3
CHUNK = 2048
#: For single-precision coordinates: what a distance or a place may be off.
SLACK = 1e-4
KEY = ["label", "dims", "block", "c0", "c1", "c2"]
_MEMBER = [("home", pa.bool_()), ("node", pa.int64()), ("copies", pa.int64()), ("raw", pa.binary()), ("turned", pa.binary())]


def rotation(dims: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def bounds(dims: int) -> list[int]:
    """Where the blocks of the rotated dimensions start, and the end."""
    blocks = min(BLOCKS, dims)
    return [dims * b // blocks for b in range(blocks + 1)]


def _cells(least: float):
    names = [*KEY, *(n for n, _ in _MEMBER)]
    layout = pa.schema([("label", pa.string()), *((k, pa.int32()) for k in KEY[1:]), *_MEMBER])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in table_batches(batches, 1 << 20):
            by_dims: dict[int, list[int]] = {}
            vectors = batch.column("vec").to_pylist()
            for i, v in enumerate(vectors):
                by_dims.setdefault(len(v), []).append(i)
            labels, nodes, copies = (batch.column(c).to_pylist() for c in ("label", "node", "copies"))
            for dims, members in by_dims.items():
                raw = np.array([vectors[i] for i in members], np.float64)
                # scaled by a power of two, which is exact: squares of extreme components stay finite
                raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(1, keepdims=True))[1])
                unit = raw / np.sqrt((raw**2).sum(1, keepdims=True))
                turned = (unit @ turns.setdefault(dims, rotation(dims))).astype(np.float32)
                cuts, rows = bounds(dims), []
                reach = float(np.sqrt((2 - 2 * least) / (len(cuts) - 1))) + SLACK
                side = 4 * reach
                raw_bytes, turned_bytes = [r.tobytes() for r in raw], [t.tobytes() for t in turned]
                for block, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    part = turned[:, start : min(end, start + GRID)].astype(np.float64)
                    low, own, high = (np.floor((part + d) / side).astype(int) for d in (-reach, 0, reach))
                    for k, i in enumerate(members):
                        home = tuple(own[k].tolist())
                        for cell in product(*(range(a, b + 1) for a, b in zip(low[k].tolist(), high[k].tolist()))):
                            if cell <= home:
                                place = (*cell, 0, 0, 0)[:GRID]
                                rows.append((labels[i], dims, block, *place, cell == home, nodes[i], copies[i], raw_bytes[k], turned_bytes[k]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), layout)], names)

    return run


class Members:
    """Vectors of one cell, as arrays."""

    def __init__(self, node: np.ndarray, copies: np.ndarray, raw: np.ndarray, turned: np.ndarray):
        self.node, self.copies, self.raw, self.turned = node, copies, raw, turned

    @classmethod
    def of(cls, rows: list[tuple], dims: int) -> Members:
        raw = np.frombuffer(b"".join(r[3] for r in rows), np.float64).reshape(-1, dims)
        turned = np.frombuffer(b"".join(r[4] for r in rows), np.float32).reshape(-1, dims)
        return cls(np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), raw, turned)


def linked(a: Members, b: Members, block: int, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs that link and whose first block within its budget is this one; a pair of the same rows counts once."""
    cuts = bounds(a.raw.shape[1])
    budget = (2 - 2 * least) / (len(cuts) - 1) * (1 + SLACK)
    x, y = (m.turned[:, cuts[block] : cuts[block + 1]] for m in (a, b))
    found = []
    for start in range(0, len(x), 512):
        part = x[start : start + 512]
        apart = (part**2).sum(1)[:, None] + (y**2).sum(1)[None] - 2 * part @ y.T
        i, j = np.nonzero(apart <= budget + SLACK)
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        # slices, so that a dense pair of chunks stays small in memory
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            u, v = a.raw[p], b.raw[q]
            cosine = (u * v).sum(1) / (np.sqrt((u**2).sum(1)) * np.sqrt((v**2).sum(1)))
            near = cosine >= least
            p, q = p[near], q[near]
            gap = (a.turned[p].astype(np.float64) - b.turned[q]) ** 2
            within = np.stack([gap[:, s:e].sum(1) for s, e in zip(cuts, cuts[1:])], 1) <= budget
            first = within.any(1) & (within.argmax(1) == block)
            found.append((p[first], q[first]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


class Result:
    """Link counts and a spanning forest, gathered over cells."""

    def __init__(self) -> None:
        self.counts: dict[int, int] = {}
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, a: Members, b: Members, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        for nodes, other, own, far in ((a.node, b.copies, i, j), (b.node, a.copies, j, i)):
            sums = np.bincount(own, other[far], len(nodes))
            for k in np.flatnonzero(sums).tolist():
                node = int(nodes[k])
                self.counts[node] = self.counts.get(node, 0) + int(sums[k])
        self.edges.append(stars(a.node[i], b.node[j]))
        self.size += len(self.edges[-1][0])

    def rows(self) -> list[tuple]:
        out = [(n, n, c) for n, c in self.counts.items()]
        if self.edges:
            a, b = stars(*(np.concatenate(x) for x in zip(*self.edges)))
            out += zip(a.tolist(), b.tolist(), [0] * len(a))
        self.__init__()
        return out


_OUT = pa.schema(
    [("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64()), ("cell", pa.string()), ("block", pa.int32()), ("dims", pa.int32())]
    + [("part", pa.int64()), ("home", pa.bool_()), ("nodes", pa.binary()), ("copies", pa.binary()), ("raw", pa.binary()), ("turned", pa.binary())]
)
_OUT_DDL = (
    "node long, root long, links long, cell string, block int, dims int, part long, home boolean,"
    " nodes binary, copies binary, raw binary, turned binary"
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r + (None,) * (len(_OUT) - len(r)) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)


def _within_cells(least: float):
    """Streams members sorted by cell, homes first. Cells of one chunk are compared, larger ones handed on in chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        result, key, rows, part = Result(), None, [], 0

        def chunks() -> Iterator[pa.RecordBatch]:
            nonlocal part
            for members in filter(None, split()):
                yield chunk(members)
                part += 1

        def chunk(members: list[tuple]) -> pa.RecordBatch:
            m = Members.of(members, key[1])
            return _batch([(None, None, None, repr(key), key[2], key[1], part, members[0][0], m.node.tobytes(), m.copies.tobytes(), m.raw.tobytes(), m.turned.tobytes())])

        def split() -> tuple[list[tuple], list[tuple]]:
            return [r for r in rows if r[0]], [r for r in rows if not r[0]]

        def close() -> None:
            own, guests = split()
            if own:
                a = Members.of(own, key[1])
                result.add(a, a, *linked(a, a, key[2], least, True))
                if guests:
                    b = Members.of(guests, key[1])
                    result.add(a, b, *linked(a, b, key[2], least, False))

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(KEY) + len(_MEMBER)))):
                if row[: len(KEY)] != key:
                    if part:
                        yield from chunks()
                    elif len(rows) > 1:
                        close()
                    key, rows, part = row[: len(KEY)], [], 0
                    if result.size + len(result.counts) > 50_000:
                        yield _batch(result.rows())
                rows.append(row[len(KEY) :])
                if len(rows) >= CHUNK:
                    yield from chunks()
                    rows = []
        if part:
            yield from chunks()
        elif len(rows) > 1:
            close()
        last = result.rows()
        if last:
            yield _batch(last)

    return run


def _between_chunks(least: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (
                    Members(
                        np.frombuffer(row[f"nodes{s}"], np.int64),
                        np.frombuffer(row[f"copies{s}"], np.int64),
                        np.frombuffer(row[f"raw{s}"], np.float64).reshape(-1, row["dims"]),
                        np.frombuffer(row[f"turned{s}"], np.float32).reshape(-1, row["dims"]),
                    )
                    for s in "12"
                )
                result = Result()
                result.add(a, b, *linked(a, b, row["block"], least, row["same"]))
                rows = result.rows()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["node", "root", "links"])

    return run


def _chunk_pairs(chunks: DataFrame) -> DataFrame:
    """Chunks of a cell that have to be compared: homes with homes once, homes with guests."""
    heads = chunks.select("cell", "part", "home")
    left, right = (heads.select("cell", F.col("part").alias(f"part{s}"), F.col("home").alias(f"home{s}")) for s in "12")
    pairs = left.join(right, "cell").filter("home1 AND (NOT home2 OR part1 <= part2)")
    pairs = pairs.select("cell", "part1", "part2", (F.col("part1") == F.col("part2")).alias("same"))
    body = ["nodes", "copies", "raw", "turned"]
    one = chunks.select("cell", F.col("part").alias("part1"), "block", "dims", *[F.col(c).alias(f"{c}1") for c in body])
    two = chunks.select("cell", F.col("part").alias("part2"), *[F.col(c).alias(f"{c}2") for c in body])
    return pairs.repartition("cell", "part1", "part2").join(one, ["cell", "part1"]).join(two, ["cell", "part2"])


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98
) -> DataFrame:
    """One row per row of ``vectors``: (id, n_links, component_id, kept).

    Rows of the same label link if the cosine of their vectors in double precision is at least ``least``.
    Null labels, and vectors that are null, empty, zero or hold null or non-finite components, link
    with nothing: 0, the row's own id, true. Vectors of different length do not link. A repeated
    row is a vector of its own and links with its copies. component_id is the smallest id
    reachable; null ids are passed over, and are kept only where the component has no other. An
    empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vec")
    )
    real = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & real, F.lit(False))
    distinct = rows.filter(usable).groupBy("label", "vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    distinct = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    layout = ", ".join(["label string", *(f"{k} int" for k in KEY[1:]), "home boolean, node long, copies long, raw binary, turned binary"])
    cells = distinct.select("label", "node", "copies", "vec").mapInArrow(_cells(least), layout)
    order = [*KEY, F.desc("home"), "node"]
    met = staged(cells.repartition(*KEY).sortWithinPartitions(*order).mapInArrow(_within_cells(least), _OUT_DDL), "cells")
    more = _chunk_pairs(met.filter("node IS NULL")).mapInArrow(_between_chunks(least), "node long, root long, links long")
    found = staged(met.filter("node IS NOT NULL").select("node", "root", "links").unionByName(more), "links")
    components = connected_components(found.filter("node <> root"), "node", "root")
    counts = found.groupBy("node").agg(F.sum("links").alias("links")).filter("links > 0")
    nodes = distinct.join(counts, "node", "left").join(components, "node", "left")
    nodes = nodes.select("label", "vec", "least", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    smallest = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = nodes.join(smallest, "component").select("label", "vec", "n_links", "component_id")
    linked_rows = rows.filter(usable).join(known, ["label", "vec"]).select("id", "n_links", "component_id")
    alone = rows.filter(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked_rows.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return out.withColumnRenamed("id", id_col)
