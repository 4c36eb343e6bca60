"""64-bit SimHash signatures over word shingles and their distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.batches import values
from gleanery.operators.minhash import shingle_hashes


def simhash(text: str, width: int = 3) -> int:
    """Bit i is set if it is set in more than half of the distinct shingles' hashes; no words: 0."""
    h = shingle_hashes(text, width)
    if not len(h):
        return 0
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        ones += np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def simhash64(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """id, simhash64 (as a signed number) of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.fromiter((simhash(t, width) for t in values(b.column(1))), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(s.view(np.int64))], names=["id", "simhash64"])

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return d.mapInArrow(run, "id long, simhash64 long").withColumnRenamed("id", id_col)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
