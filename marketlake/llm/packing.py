"""Packing of token pieces into sequences by the sum-of-squares rule.

A piece goes where the squared counts of open sequences per residual gap add up to the least. Pieces are
tokenized once, in parallel, and dealt at random to shards of about ``SHARD`` pieces; a shard is packed
in one task, longest piece first. The space that a shard wastes falls with the square root of its
pieces, so that the share lost does not depend on how many shards there are.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged, table_batches

LIMIT, END = 1024, 2
#: Short pieces of a shard: so many that under one per cent of the space is lost, so few that a task holds them.
SHARD = 65_536
#: Segments whose ids a task remembers.
MEMORY = 400_000
_CLEAN_BLANK = re.compile(r"(?<=\S) (?=\S)")
_DOUBLE_SPACE = re.compile(r"\s\s")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of texts as little-endian bytes.

    A blank or line end between two visible characters always starts a new word of the byte-level
    vocabulary, so a text is the sequence of its segments led by these, and a segment's ids are looked up once. New
    segments go through a faster reader of the same vocabulary, which gives the same ids; texts with a
    special token's string go through the tokenizer itself.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(vocabulary, encoding="utf-8") as file:
            tokens = json.load(file)["model"]["vocab"]
        of = _byte_of_character()
        ranks = {bytes(of[c] for c in t): i for t, i in tokens.items() if t not in self.special}
        self.quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def segments(self, text: str) -> list[str]:
        if _DOUBLE_SPACE.search(text):
            parts = _CLEAN_BLANK.split(text)
            return parts[:1] + [" " + p for p in parts[1:]]
        if "\0" in text:
            return [text]
        # a blank or a line end between visible characters leads a segment
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def encode(self, texts: list[str]) -> list[bytes]:
        known, quick = self.known, self.quick.encode_ordinary
        out = []
        for text in texts:
            if any(s in text for s in self.special):
                out.append(self._whole(text))
                continue
            parts = self.segments(text)
            try:
                out.append(b"".join(map(known.__getitem__, parts)))
            except KeyError:
                if len(known) > MEMORY:
                    known.clear()
                for part in parts:
                    if part not in known:
                        known[part] = array("I", quick(part)).tobytes()
                out.append(b"".join(map(known.__getitem__, parts)))
        return out


def cuts(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full, but for the first."""
    if length <= limit:
        return [(0, length)]
    first = length % limit or limit
    return [(0, first)] + [(s, limit) for s in range(first, length, limit)]


def _pieces(vocabulary: str, limit: int, end: int, with_ids: bool):
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in table_batches(batches, 2 << 20):
            owner, rows, ids = [], [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, found in enumerate(encoder.encode(texts)):
                found += tail
                for piece, (start, length) in enumerate(cuts(len(found) // 4, limit)):
                    body = found[4 * start : 4 * (start + length)]
                    owner.append(i)
                    rows.append((piece, start, length, zlib.crc32(body)))
                    if with_ids:
                        ids.append(np.frombuffer(body, "<u4").astype(np.int32))
            columns = [batch.column("id").take(pa.array(owner, pa.int64()))]
            columns += [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            columns += [pa.array(ids, pa.list_(pa.int32()))] * with_ids
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def sum_of_squares(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, taken in the given order.

    Moving a bin from gap g to gap g - s changes the squared counts by 2 (N[g - s] - N[g] + 1); a bin that
    gets full no longer counts. A new bin is opened only where no open one has room: with the longest
    pieces first this wastes far less than opening one whenever that is cheaper. Ties: the smallest gap.
    """
    counts = np.zeros(limit + 1)
    open_bins: list[list[int]] = [[] for _ in range(limit + 1)]
    levels: list[int] = []
    where, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        gaps = counts[size:limit]
        change = 2 * (counts[: limit - size] - gaps) + 2
        if len(change):
            change[0] = 1 - 2 * gaps[0]
            change[gaps == 0] = np.inf
        best = int(change.argmin()) if len(change) else -1
        if best >= 0 and change[best] < np.inf:
            gap = best + size
            chosen = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            chosen, gap = len(levels), limit
            levels.append(0)
        where[i], offsets[i] = chosen, levels[chosen]
        levels[chosen] += size
        if gap > size:
            counts[gap - size] += 1
            open_bins[gap - size].append(chosen)
    return where, offsets


def _packed(limit: int):
    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        shard = table.column("shard")[0].as_py()
        order = np.lexsort((table.column("n").to_numpy(), -lengths))
        where, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        where[order], offsets[order] = sum_of_squares(lengths[order], limit)
        kept = table.drop_columns(["shard"])
        kept = kept.append_column("sequence_id", pa.array(where + (shard << 32)))
        return kept.append_column("offset", pa.array(offsets))

    return run


def _placed(pieces: DataFrame, limit: int) -> DataFrame:
    """Written pieces with their place; ``n`` numbers the rows of the written table."""
    numbered = pieces.drop("ids").withColumn("n", F.monotonically_increasing_id())
    full = numbered.filter(F.col("length") >= limit)
    short = numbered.filter(F.col("length") < limit)
    shards = max(1, -(-short.count() // SHARD))
    dealt = short.withColumn("shard", F.pmod(F.xxhash64("n"), F.lit(shards)))
    kind = dict(pieces.dtypes)["id"]
    layout = f"id {kind}, piece int, start long, length long, ids_crc32 long, n long, sequence_id long, offset long"
    packed = dealt.groupBy("shard").applyInArrow(_packed(limit), layout)
    alone = full.withColumns({"sequence_id": -1 - F.col("n"), "offset": F.lit(0).cast("long")})
    return alone.unionByName(packed)


def _tokenized(docs: DataFrame, id_col: str, text_col: str, vocabulary: str | None, limit: int, end: int, with_ids: bool) -> DataFrame:
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(picked.dtypes)["id"]
    layout = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    cut = picked.mapInArrow(_pieces(vocabulary or default_vocabulary(), limit, end, with_ids), layout)
    return staged(cut, "pieces")


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = LIMIT, end: int = END
) -> DataFrame:
    """One row per piece: (id, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its ids and the end id, a null or empty text the end id alone. Documents above the
    limit are cut into full pieces and a first piece with the rest. Repeated rows are packed once each;
    ids may be null. An empty table gives no rows.
    """
    placed = _placed(_tokenized(docs, id_col, text_col, vocabulary, limit, end, False), limit)
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = LIMIT, end: int = END
) -> DataFrame:
    """(sequence_id, ids, length): the packed token ids themselves, at most ``limit`` in a row."""
    pieces = _tokenized(docs, id_col, text_col, vocabulary, limit, end, True)
    ids = pieces.select("ids").withColumn("n", F.monotonically_increasing_id())
    placed = _placed(pieces, limit).join(ids, "n")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    out = placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    return out.withColumn("length", F.size("ids"))
