"""Language ID by language-bitmask n-gram filters.

One bit-sliced Bloom filter for all languages: a slot holds a mask with a bit for each language, and the AND of an
n-gram's slots is the set of languages that (may) contain it.  A text's n-grams are looked up once for all languages,
the set bits are counted per language, each count is corrected for that language's false-positive rate (the share of
slots that have its bit, to the power of the number of hashes), and the largest share of explained n-grams decides.

The filter is fitted on a bounded sample: of each language the ``SAMPLE`` training documents with the smallest hash of
doc_id.  An n-gram enters a language's filter if at least ``MIN_COUNT`` of those documents have it (a tenth of them, if a
language has fewer than 30), and the share that has it is at least ``MIN_SHARE`` of the share in the language where it
is most common: passages in another language that some documents quote would otherwise make that language look like
theirs.  The filter has 2^20 slots with one 64-bit word for every 64 languages (8 MB each), whatever the data's size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.batches import parts, values
from gleanery.llm.common import id_text

SLOTS = 1 << 20
HASHES = 2
GRAM = 4
SAMPLE = 1500
MIN_COUNT = 3
MIN_SHARE = 0.1
SPACE = 0x20

_tables: dict[str, np.ndarray] = {}


def _fold() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for all that is not a letter."""
    if "fold" not in _tables:
        t = np.full(sys.maxunicode + 1, SPACE, np.uint32)
        for c in range(sys.maxunicode + 1):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _tables["fold"] = t
    return _tables["fold"]


def gram_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the letter n-grams of a text, repeats included; a run of other characters counts as one space."""
    cp = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not len(cp):
        return np.empty(0, np.uint64)
    letters = cp != SPACE
    if not letters.any():
        return np.empty(0, np.uint64)
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    cp = np.concatenate(([SPACE], cp[keep], [SPACE, SPACE])).astype(np.uint64)
    n = len(cp) - GRAM + 1
    h = cp[:n].copy()
    with np.errstate(over="ignore"):
        for i in range(1, GRAM):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += cp[i : i + n]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def slots_of(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(21 * i)) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


def held_out() -> Column:
    """A fifth of the documents, by the CRC-32 of doc_id as text; a null doc_id gives null."""
    return F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")


class Filter:
    """languages, and the slots' masks: an array of 2^20 words for every 64 languages."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        fill = [(masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(languages))]
        self.false_rate = np.array([f**HASHES for f in fill])

    def score(self, text: str | None) -> tuple[str, float]:
        h = gram_hashes(text or "")
        if not len(h) or not self.languages:
            return "und", 0.0
        first, *more = slots_of(h)
        count = np.zeros(len(self.languages), np.int64)
        for w, masks in enumerate(self.masks):
            mask = masks[first]
            for s in more:
                mask &= masks[s]
            for i in range(64 * w, min(64 * w + 64, len(count))):
                count[i] = np.count_nonzero(mask & np.uint64(1 << i % 64))
        share = (count / len(h) - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
        best = int(np.argmax(share))  # a tie: the first language in order of name
        return self.languages[best], float(min(1.0, max(0.0, share[best])))


def fit(docs: DataFrame, per_language: int = SAMPLE, min_count: int = MIN_COUNT) -> Filter:
    """Learn from text and lang of the rows of ``docs`` with neither null, and with an id; of rows that repeat id and language
    the smallest text is learned from.  What is held is one row a language and the filter."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("doc_id is not null and lang is not null and text is not null")
    counts = sorted(tuple(r) for r in d.groupBy("lang").count().collect())
    langs = [lang for lang, _ in counts]
    words = -(-len(langs) // 64)
    if not langs:
        return Filter([], np.zeros((0, SLOTS), np.uint64))
    # ids first (the text is not sorted), then the texts of at most per_language x languages rows.  Hashes over twice the
    # share a language's sample needs can't be among its smallest, so a language that holds most rows is not ranked whole
    cut = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, int((1 << 62) * min(1.0, 2 * max(per_language, 500) / n)))])
    pick = d.select(F.col("lang").alias("_lang"), F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 62) - 1)).alias("h"), F.col("doc_id").alias("_id")).where(F.col("h") <= cut[F.col("_lang")])
    pick = pick.distinct().withColumn("k", F.row_number().over(Window.partitionBy("_lang").orderBy("h", "_id"))).where(F.col("k") <= per_language)
    d = d.join(F.broadcast(pick.select("_lang", "_id")), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
    d = d.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    number = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for whole in batches for p in parts(whole, 128)):
            by: dict[int, list[np.ndarray]] = {}
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(number[lang], []).append(np.unique(gram_hashes(t)))
            for lang, hs in by.items():
                g, n = np.unique(np.concatenate(hs), return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(g), lang, np.int32)), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    docs_of = F.create_map(*[F.lit(x) for lang, n in counts for x in (number[lang], float(min(n, per_language)))])
    least = F.least(F.lit(float(min_count)), F.ceil(docs_of[F.col("lang")] / 10).cast("double"))
    grams = d.select("text", "lang").mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    grams = grams.withColumn("share", F.col("n") / docs_of[F.col("lang")])
    grams = grams.withColumn("most", F.max("share").over(Window.partitionBy("gram"))).where(F.col("share") >= MIN_SHARE * F.col("most"))  # a row a language
    slot = F.explode(F.array(*[F.shiftrightunsigned("gram", 21 * i).bitwiseAND(F.lit(SLOTS - 1)) for i in range(HASHES)]))
    rows = grams.select(F.expr("lang div 64").cast("int").alias("word"), slot.alias("slot"), F.expr("shiftleft(1L, lang % 64)").alias("bit"))
    rows = rows.groupBy("word", "slot").agg(F.bit_or("bit").alias("mask")).toPandas()
    masks = np.zeros((words, SLOTS), np.uint64)
    masks[rows["word"].to_numpy(np.int64), rows["slot"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return Filter(langs, masks)


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """doc_id, lang_pred, score for every row, from its whole text alone.

    ``und`` with score 0 for a text that is null or has no letter, and for any text if no language was learned.  The
    score is the corrected share of the text's n-grams that the predicted language explains.  Repeated rows are
    returned as often, a null doc_id stays null, and an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Filter(*held.value)
        for b in batches:
            got = [f.score(t) for t in values(b.column(1))]
            yield pa.record_batch([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score: fitted on the documents that are not held out (see ``fit``).

    One row per input row.  A row without an id is learned from by no one and counts as not held out.  Null and
    letterless texts are ``und``; without any learned language all are.  An empty table gives an empty result.
    """
    model = fit(docs.where(~held_out()), per_language)
    return identify(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


LEAST = 0.3


def in_known_language(docs: DataFrame, least: float = LEAST, per_language: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in a learned language: predicted with a score of ``least`` or
    more.  Null texts and texts without letters go; repeated rows stay or go together; without a learned language all
    rows go; an empty table gives an empty result.  No row is shuffled for it, and Python gets the texts alone and gives
    back a boolean each, so that no Arrow batch holds the rows a second time on their way back."""
    model = fit(docs.where(~held_out()), per_language)
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks))

    @F.arrow_udf("boolean")
    def known(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = Filter(*held.value)
        for column in columns:
            got = (f.score(t) for t in values(column))
            yield pa.array([lang != "und" and score >= least for lang, score in got], pa.bool_())

    return docs.where(known(F.col("text")))
