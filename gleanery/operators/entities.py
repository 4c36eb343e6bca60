"""Entity mentions: by gazetteer, where word runs of the texts meet the names of a list in a hash join, or by a recogniser."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.batches import values

_WORD = re.compile(r"[^\W_]+")
BITS = 1 << 23
MENTION = "chunk_id long, key string, offset_start long, offset_end long"


def _key(name: str) -> str:
    return " ".join(_WORD.findall(name.lower()))


def mentions(chunks: DataFrame, gazetteer: DataFrame, max_words: int = 3) -> DataFrame:
    """chunk_id, entity_id, offset_start, offset_end (characters) of every run of up to ``max_words`` words that is an
    entity's name, whatever the case and what stands between the words.

    ``chunks`` is (chunk_id, text), ``gazetteer`` (entity_id, name).  Names are joined by hash; a short list is
    broadcast by the planner, a long one shuffled.  Word runs leave a text only if their first word seems to be some
    name's, by a Bloom filter of fixed size (1 MB).  Null texts and names match nothing.
    """
    key = F.pandas_udf(lambda s: s.map(lambda x: _key(x) if x else None), "string")
    names = gazetteer.select("entity_id", key(F.col("name")).alias("key")).where("key <> ''").distinct()
    bit = F.xxhash64(F.substring_index("key", " ", 1)).bitwiseAND(F.lit(BITS - 1))
    rows = names.select(bit.alias("bit")).groupBy(F.shiftrightunsigned("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toPandas()
    words = np.zeros(BITS // 64, np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    held = chunks.sparkSession.sparkContext.broadcast(words)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = held.value
        seen: dict[str, bool] = {}

        def maybe(word: str) -> bool:
            if word not in seen:
                if len(seen) > 200_000:
                    seen.clear()
                at = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) & BITS - 1
                seen[word] = bool(int(filter_[at >> 6]) >> (at & 63) & 1)
            return seen[word]

        for b in batches:
            for chunk, text in zip(values(b.column(0)), values(b.column(1))):
                spans = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text or "")]
                for lo in range(0, len(spans), 20_000):
                    starts = [i for i in range(lo, min(lo + 20_000, len(spans))) if maybe(spans[i][0])]
                    rows = [(chunk, " ".join(w for w, _, _ in spans[i : i + n]), spans[i][1], spans[i + n - 1][2]) for i in starts for n in range(1, max_words + 1) if i + n <= len(spans)]
                    if not rows:
                        continue
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["chunk_id", "key", "offset_start", "offset_end"])

    found = chunks.select(F.col("chunk_id").cast("long").alias("chunk_id"), "text").mapInArrow(runs, MENTION)
    return found.join(names, "key").select("chunk_id", "entity_id", "offset_start", "offset_end")


Recogniser = Callable[[list[str]], list[list[tuple[int, int, str]]]]


def recognised(chunks: DataFrame, make: Callable[[], Recogniser], batch: int = 128) -> DataFrame:
    """chunk_id, label, name, offset_start, offset_end (characters) of what a recogniser of one's own finds in (chunk_id, text):
    of every text its (start, end, label).  ``make`` builds it once a task, so a model is loaded there; it gets ``batch``
    texts at a time.  A null text counts as empty; topics of whole texts are spans from 0 to the text's end."""
    shape = pa.schema([("chunk_id", pa.int64()), ("label", pa.string()), ("name", pa.string()), ("offset_start", pa.int64()), ("offset_end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make()
        for b in batches:
            for lo in range(0, b.num_rows, batch):
                ids, texts = b.column(0).slice(lo, batch).to_pylist(), b.column(1).slice(lo, batch).to_pylist()
                rows = [(i, label, t[start:end], start, end) for i, t, found in zip(ids, texts, find(texts)) for start, end, label in found]
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)

    d = chunks.select(F.col("chunk_id").cast("long").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("text"))
    return d.mapInArrow(run, "chunk_id long, label string, name string, offset_start long, offset_end long")
