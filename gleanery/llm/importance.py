"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text (documents labelled good) and one of the raw corpus (all
documents).  A document's importance is the sum over its n-grams of log target - log raw.  The resample is drawn
without replacement, with odds that follow the importance weights, by Gumbel top-k: importance plus standard Gumbel
noise, the k largest stay, the others are rejected.  Noise is in nats, like importance; a text whose importance is far
from the k-th key has its fate settled by its words, a short or mixed one by chance.

n-grams: words as they stand, pairs of words, word shapes and pairs of shapes, hashed into ``BUCKETS``.  The target
model is fitted on a bounded sample (``SAMPLE`` good documents, those with the smallest hash of doc_id); the raw model
counts every document.  k is a number or a share of the documents; by default as many as there are documents that the
target model finds more probable than the raw one does, so that the size of the resample follows the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.batches import values
from gleanery.llm.bytewords import SPACE, bounds, hashes
from gleanery.llm.common import checkpoint, id_text
from gleanery.operators.joins import free_name

BUCKETS = 1 << 16
SAMPLE = 2000
SMOOTHING = 60.0  # occurrences a bucket; of 1, 5, 20 and 60 the one that kept most held-out good documents of the sf tables
SEED = 17

# byte classes of word shapes: letters to a or A, digits to 9, bytes over 127 count as letters, others stand for themselves
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[128:] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("9")


def features(text: str) -> np.ndarray:
    """Buckets of a text's n-grams, repeats included.  A shape has runs of one class shortened to two."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = bounds(b)
    if not len(starts):
        return np.empty(0, np.int64)
    w = hashes(b, starts, ends)
    c = _CLASS[b]
    keep = np.ones(len(c), bool)
    keep[2:] = (c[2:] != c[1:-1]) | (c[2:] != c[:-2]) | SPACE[b[2:]]
    c = c[keep]
    s = hashes(c, *bounds(c)) ^ np.uint64(0x5BF03635)
    pair = lambda x, k: x[:-1] * np.uint64(0x9E3779B97F4A7C15) + (x[1:] ^ np.uint64(k))
    every = np.concatenate([w, s, pair(w, 3), pair(s, 4)])
    return (every * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    np.seterr(over="ignore")
    total = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for t in values(b.column(b.num_columns - 1)):
            f = features(t)
            if len(f) > BUCKETS // 4:
                total += np.bincount(f, minlength=BUCKETS)
            else:
                np.add.at(total, f, 1)
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def _counts(texts: DataFrame) -> np.ndarray:
    rows = texts.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Of every bucket: log of its probability in the target model less that in the raw one.  Raw counts are scaled to the
    target's total first, so that both models are smoothed alike and a bucket too rare to say anything has a ratio near 0."""
    scaled = raw * (target.sum() / max(1, raw.sum()))
    return np.log(target + SMOOTHING) - np.log(scaled + SMOOTHING)


def _scored(docs: DataFrame, ratio: np.ndarray, n_name: str, s_name: str) -> DataFrame:
    """All columns of ``docs``, the number of its n-grams and their importance (null text: empty)."""
    held = docs.sparkSession.sparkContext.broadcast(ratio)
    at = docs.columns.index("text")
    names = [*docs.columns, n_name, s_name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        r = held.value
        for b in batches:
            n, s = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for i, t in enumerate(values(b.column(at))):
                f = features(t or "")
                n[i], s[i] = len(f), r[f].sum()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n), pa.array(s)], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(n_name, T.LongType()), T.StructField(s_name, T.DoubleType())]))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> np.ndarray | None:
    """The buckets' log ratios.  Labels with a null id or quality are ignored; an id whose labels differ counts as bad; of rows
    that repeat an id the smallest text is learned from.  None without good labels."""
    lab = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("quality"))
    pick = lab.where("quality > 0").select("_id").orderBy(F.xxhash64("_id"), "_id").limit(per_class)
    known = id_text(docs).join(F.broadcast(pick), F.col("doc_id") == F.col("_id"), "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    target = _counts(known.select("text"))
    return log_ratio(target, _counts(id_text(docs).select("text"))) if target.sum() else None


def kth_largest(df: DataFrame, key: str, k: int, gather: int = 10_000, bins: int = 4096) -> float:
    """Exact k-th largest value of a double column, by histograms that narrow down; at most ``gather`` values are
    collected.  Minus infinity if there are no more than k."""
    n, lo, hi = df.agg(F.count(key), F.min(key), F.max(key)).first()
    if k >= n:
        return -np.inf
    if k <= 0:
        return np.inf
    while True:
        inside = df.where(F.col(key).between(lo, hi))
        if n <= gather or lo == hi:
            if lo == hi:
                return lo
            return sorted((r[0] for r in inside.select(key).collect()), reverse=True)[k - 1]
        at = F.least(F.lit(bins - 1), F.floor((F.col(key) - F.lit(lo)) / F.lit((hi - lo) / bins)))
        rows = sorted(inside.groupBy(at.alias("bin")).agg(F.count(F.lit(1)), F.min(key), F.max(key)).collect(), reverse=True)
        for _, c, low, high in rows:
            if k <= c:
                n, lo, hi = c, low, high
                break
            k -= c


def _keyed(docs: DataFrame, labels: DataFrame, per_class: int, k: float | None, seed: int, names: tuple[str, str, str]) -> tuple[DataFrame, float]:
    """``docs`` with its n-grams, importance and key under the given names, and the least key that stays.  Texts are read twice:
    for the raw model, and to be scored."""
    ratio = fit(docs, labels, per_class)
    n_name, s_name, key = names
    u = (F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")).bitwiseAND(F.lit((1 << 53) - 1)) + 0.5) / float(1 << 53)
    d = _scored(docs, np.zeros(BUCKETS) if ratio is None else ratio, n_name, s_name)
    d = checkpoint(d.withColumn(key, F.when(F.col(n_name) > 0, F.col(s_name) - F.log(-F.log(u)))))
    if k is None and ratio is None:
        return d, -np.inf
    alive = d.where(F.col(n_name) > 0)
    if k is None:
        k = alive.where(F.col(s_name) > 0).count()
    elif k < 1:
        k = round(k * alive.count())
    return d, kth_largest(d, key, int(k))


def resample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, k: float | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_ratio (mean over the n-grams), importance (their sum), gumbel_key, keep: one row per input row.

    ``k``: how many stay, below 1 which share (of the documents with an n-gram); None: see the module.  Texts are scored
    whole; a null or empty text has no n-gram and is rejected, whatever the noise.  Noise depends on doc_id and seed
    only, so a run can be repeated; rows with equal keys stay or go together.  Without good labels all importances are
    0 and, if ``k`` isn't given, every document with an n-gram is kept.  An empty table gives an empty result.
    """
    d, least = _keyed(id_text(docs), labels, per_class, k, seed, ("n_grams", "importance", "gumbel_key"))
    mean = F.when(F.col("n_grams") > 0, F.col("importance") / F.col("n_grams")).otherwise(0.0)
    return d.select("doc_id", "n_grams", mean.alias("log_ratio"), "importance", "gumbel_key", F.coalesce(F.col("gumbel_key") >= F.lit(least), F.lit(False)).alias("keep"))


def resampled(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, k: float | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, all columns, that ``resample`` keeps, whatever the columns' names; no row is shuffled for it.
    Repeated rows stay or go together; an empty table gives an empty result."""
    names = tuple(free_name(docs.columns, x) for x in ("_n", "_s", "_key"))
    d, least = _keyed(docs, labels, per_class, k, seed, names)
    return d.where(F.col(names[2]) >= F.lit(least)).drop(*names)
