"""Bounded-space online packing of documents into training sequences.

Every partition reads its documents once, in order, and keeps ``open_windows`` open windows.  A document is cut into
full windows and a rest; the rest goes to the open window it fits best; when it fits none, the fullest is emitted and
a new one opened.  What is still open at a partition's end is merged: those windows, as whole items, are packed the
same way over fewer and fewer partitions.  Memory per task: the open windows and one Arrow batch.

The placements (no ids in them) are written to the shared folder before the leftovers are merged, so tokenization
runs once.  Sequence ids depend only on the input's partitions and their order; a retried task repeats them.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import checkpoint, id_text
from gleanery.llm.wordbpe import load

SEQUENCE = 4096
OPEN_WINDOWS = 64
END_ID = 2
MERGE_FAN_IN = 32  # partitions whose leftovers one task merges


class Windows:
    """Open windows by free space: best fit, fullest out."""

    def __init__(self, size: int, most: int, first_id: int):
        self.size, self.most, self.next = size, most, first_id
        self.open: list[tuple[int, int]] = []  # (free, id), ascending: the fullest first

    def place(self, length: int) -> tuple[int, int, list[int]]:
        """(window, offset there, windows closed)."""
        closed: list[int] = []
        at = bisect_left(self.open, (length, -1))
        if at < len(self.open):
            free, w = self.open.pop(at)
        else:
            if len(self.open) >= self.most:
                closed.append(self.open.pop(0)[1])
            free, w = self.size, self.next
            self.next += 1
        if free > length:
            insort(self.open, (free - length, w))
        else:
            closed.append(w)
        return w, self.size - free, closed


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def raw_ids(ids: np.ndarray) -> bytes:
    return ids.astype("<u4", copy=False).tobytes()


def tokens(path: str) -> Callable[[str], np.ndarray]:
    encode = load(path).encode
    end = np.array([END_ID], "<u4")
    return lambda text: np.concatenate([encode(text), end])


def _pack(path: str, size: int, most: int, payload: Callable, kind: pa.DataType):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("payload", kind), ("doc_tokens", pa.int64()), ("window", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokens(path)
        windows = Windows(size, most, TaskContext.get().partitionId() << 32)
        for b in batches:
            docs, texts = b.column(0).to_pylist(), b.column(1)
            for lo in range(0, b.num_rows, 512):
                rows = []
                for doc, text in zip(docs[lo : lo + 512], texts.slice(lo, 512).to_pylist()):
                    ids = ids_of(text)
                    n = len(ids)
                    for start in range(0, n, size):
                        part = ids[start : start + size]
                        w, at, _ = windows.place(len(part))
                        rows.append((doc, start, len(part), payload(part), n, w, at))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if windows.open:  # a row of length 0 says that its window is still open
            rows = [(None, None, 0, None, None, w, None) for _, w in windows.open]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _merge(size: int, most: int, level: int):
    """Rows (window, used): to which window of this level each goes, and at what offset; at the end those still open,
    without a window."""
    schema = pa.schema([("window", pa.int64()), ("into", pa.int64()), ("shift", pa.int64()), ("used", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(size, most, (level << 56) + (TaskContext.get().partitionId() << 32))
        for b in batches:
            rows = [(w, *windows.place(u)[:2], u) for w, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if windows.open:
            rows = [(None, w, 0, size - free) for free, w in windows.open]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, open_windows: int = OPEN_WINDOWS, payload: Callable = raw_ids, payload_type: str = "binary") -> DataFrame:
    """doc_id, start, length, payload, doc_tokens, sequence_id, offset: one row per piece.

    ``payload`` makes of a piece's ids (uint32 array) what the piece carries, by default the ids themselves as
    little-endian bytes.  Null text counts as empty: its document is the end id alone.  Repeated rows are packed as
    often as they come; a null doc_id stays null.  Texts of any length are cut, never shortened; sequences are
    filled from offset 0 without gaps; padding up to ``size`` is the reader's.  An empty table gives no piece.
    """
    kind = {"binary": pa.binary(), "long": pa.int64()}[payload_type]
    pieces = id_text(docs).mapInArrow(_pack(tokenizer, size, open_windows, payload, kind), f"doc_id long, start long, length long, payload {payload_type}, doc_tokens long, window long, offset long")
    pieces = checkpoint(pieces)
    used = pieces.where(F.col("length") < size).groupBy("window").agg(F.sum("length").alias("used"), F.min("length").alias("least")).where("least = 0")
    pieces = pieces.where("length > 0")
    n = pieces.rdd.getNumPartitions()
    moves = None
    level = 1
    while True:
        n = max(1, n // MERGE_FAN_IN)
        dealt = used.select("window", "used").repartition(n, F.xxhash64("window")).sortWithinPartitions(F.col("used").desc(), "window")
        step = checkpoint(dealt.mapInArrow(_merge(size, open_windows, level), "window long, into long, shift long, used long"))
        hop = step.where("window is not null").select(F.col("window").alias("w"), "into", "shift")
        if moves is None:
            moves = hop.select("w", F.col("into").alias("sequence_id"), "shift")
        else:
            more = hop.select(F.col("w").alias("sequence_id"), F.col("into").alias("i2"), F.col("shift").alias("s2"))
            moves = moves.join(more, "sequence_id", "left").select("w", F.coalesce("i2", "sequence_id").alias("sequence_id"), (F.col("shift") + F.coalesce("s2", F.lit(0))).alias("shift"))
        if n == 1:
            break
        used = step.where("window is null").select(F.col("into").alias("window"), "used")
        level += 1
    moves = moves.withColumnRenamed("w", "window")
    out = pieces.join(moves, "window", "left")
    return out.select("doc_id", "start", "length", "payload", "doc_tokens", F.coalesce("sequence_id", "window").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
