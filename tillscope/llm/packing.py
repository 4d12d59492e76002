"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents become pieces: one, or for a document longer than a sequence
pieces of full length with a shorter one first.  Pieces are packed by
bulk-synchronous best fit:

1. Range sort.  Every piece gets its rank among the pieces of its length
   (a distributed two-level count, so a length that a third of all pieces
   share is dealt over many tasks).  Lengths, longest first, and the gaps
   of the open sequences by size form two sorted lists of classes.  All
   pieces of a class are alike, so a class is its size and a count; there
   are at most ``capacity`` of them, however many documents.
2. Sweep.  Each class of pieces goes to its successor: the smallest gap
   that holds it.
3. Conflicts.  Pieces that want the same class of gaps take its sequences
   in the order of their ranks; those left over go to the next gap, or
   open new sequences.
4. Update.  The gaps shrink, and the next class is swept.

Sweeps only move bounds of rank ranges, so every piece is then placed at
once: a task looks up the run that holds (length, rank) and adds the
run's first sequence.  No piece passes through the driver; the runs are
bounded by the square of the capacity.

Null and empty texts hold the closing id alone; repeated rows are packed
as often as they occur; an empty table gives an empty result; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm import pretokens as P
from tillscope.llm.common import map_arrow, map_texts, saved, steps

SHARDS = 64  # a length's pieces are counted in so many parts
LONG_TEXT = 1_000_000  # characters; a longer text is tokenized in parts, which bounds the lists of ids
RUN = np.dtype([("key", "<i8"), ("sequence", "<i8"), ("offset", "<i4")])


class ByteIds:
    """Token ids of whole texts as little-endian bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of_char = {c: b for b, c in P.byte_alphabet().items()}
        self.path = path
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # ranks of a byte-level BPE are its ids where those follow the merges; else the library does all
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in pairs]
        self.ranked = all(x < y for x, y in zip(made, made[1:]))
        ranks = {bytes(of_char[c] for c in s): i for s, i in spec["model"]["vocab"].items()}
        self.fast = tiktoken.Encoding("pieces", pat_str=P.BYTE_PATTERN.pattern, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def library(self) -> tokenizers.Tokenizer:
        """Only texts with a special string need it."""
        return tokenizers.Tokenizer.from_file(self.path)

    def ids(self, text: str) -> bytes:
        if not self.ranked or any(s in text for s in self.specials):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([np.array(self.fast.encode_ordinary(part), "<u4").tobytes() for part in _parts(text)])


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that are tokenized independently: each later part starts with a space that starts a pre-token."""
    if len(text) <= LONG_TEXT:
        yield text
        return
    held, size = [], 0
    for i, piece in enumerate(P.space_pieces(text)):
        held.append(piece if i == 0 else " " + piece)
        size += len(piece)
        if size >= LONG_TEXT:
            yield "".join(held)
            held, size = [], 0
    yield "".join(held)


@functools.lru_cache(maxsize=2)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)


def cut(docs: DataFrame, tokenizer: str, capacity: int, closing_id: int = 0, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    id_type = docs.schema[id_col].dataType.simpleString()
    closing = np.array([closing_id], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_ids(tokenizer)
        for batch, texts in steps(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for r, text in enumerate(texts):
                ids = of.ids(text) + closing
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                for k, at in enumerate([0, *range(first, n, capacity)]):
                    size = first if k == 0 else capacity
                    row.append(r)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_texts(docs, task, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long", id_col, text_col)


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs of placements: pieces (length, ranks from ``key``) go to sequences from ``sequence`` on, at ``offset``.

    ``counts``: pieces by length.  The work is bounded by the capacity, not
    by the counts.
    """
    sizes: list[int] = []  # sizes of open gaps, ascending
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, how many)
    runs: list[tuple[int, int, int]] = []
    opened = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap > 0:
            if gap not in gaps:
                insort(sizes, gap)
            gaps.setdefault(gap, []).append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)  # the successor: the smallest gap that holds the length
            if at == len(sizes):
                # no gap holds it: open as many sequences as these pieces fill
                n = -(-left // (capacity // length))
                leave(capacity, opened, n)
                opened += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            take = min(n, left)
            runs.append(((length << 48) | rank, first, capacity - gap))
            rank, left = rank + take, left - take
            if take < n:
                leave(gap, first + take, n - take)
            leave(gap - length, first, take)
    return np.array(runs, RUN)


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with rank, its number (from 0) among the pieces of its length."""
    parts = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SHARDS)))
    before = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("length", "_shard").agg(F.count("*").alias("_n")).select(
        "length", "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece", "ids_crc32")
    return parts.withColumn("_row", F.row_number().over(inside)).join(offsets, ["length", "_shard"]).withColumn(
        "rank", F.col("_before") + F.col("_row") - 1).drop("_shard", "_row", "_before")


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Pack pieces (rows with a length): adds sequence_id and offset."""
    pieces = saved(pieces, "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = sweep(counts, capacity)
    runs.sort(order="key")
    table = pieces.sparkSession.sparkContext.broadcast(runs)
    names = pieces.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = table.value
        for batch in batches:
            key = (batch.column("length").to_numpy() << 48) | batch.column("rank").to_numpy()
            at = np.searchsorted(plan["key"], key, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(plan["sequence"][at] + key - plan["key"][at]), pa.array(plan["offset"][at].astype(np.int64))],
                [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return map_arrow(ranked(pieces).select(*names, "rank"), task, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, closing_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return place(cut(docs, tokenizer, capacity, closing_id, id_col, text_col), capacity)
