"""Helpers that the operators share: written intermediates, word rules, pieces of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_dir

#: Bytes of words in the ASCII range are digits and letters; A-Z are lower-cased, all else separates words.
WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared scratch folder; cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two columns that tell rows apart by id and text (96 bits, never null)."""
    return [F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.hash(F.col(text_col), F.col(id_col).cast("string"))]


def fold(column: str | Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; null where the value is null."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % n


def utf8(values: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]


def ascii_words(text: bytes) -> list[bytes]:
    """Lower-cased words of digits, letters and all non-ASCII characters."""
    return text.translate(WORD_TABLE).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words between ASCII white space."""
    return text.lower().split()


def table_batches(batches: Iterable[pa.RecordBatch], most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded size, so that a few long texts do not fill a task's memory."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links as edges (node, smallest node of its component), node > root."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
