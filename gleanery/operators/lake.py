"""The staged mining lake: contracts of its tables and the stages between them, each a plain ``DataFrame -> DataFrame``.

Order: sources and blobs, extractions, normalized, chunks, then dedupe map, embeddings, entities, promotion.  Ids are
content hashes (SHA-256 over the text and the recipe's version), so a stage that runs again gives the same ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gleanery.functions import text as T
from gleanery.functions.batches import values
from gleanery.operators.minhash import shingle_hashes, signature
from gleanery.operators.simhash import simhash

SCHEMAS = {
    "sources": "source_id string, uri string, collected_at long, mime string, size_bytes long, sha256 string, blob_cid string, headers string, license string, labels string",
    "blobs": "blob_cid string, sha256 string, size_bytes long, mime string, storage_uri string",
    "extractions": "ext_cid string, blob_cid string, recipe_v string, text_stats string, text string",
    "normalized_extractions": "norm_cid string, ext_cid string, norm_hash string, simhash64 long, minhash_sig binary, lang string, text string",
    "chunks": "chunk_id string, norm_cid string, span_start long, span_end long, text string, norm_hash string",
    "embeddings": "obj_type string, obj_id string, model string, dim int, dtype string, vector array<float>",
    "entities": "entity_id string, name string, type string",
    "mentions": "chunk_id string, entity_id string, offset_start long, offset_end long",
    "dedupe_map": "norm_hash string, canonical_chunk_id string",
    "runs": "run_id string, kind string, params_json string, git_sha string, started_at long, ended_at long, counts_json string, status string",
}
DOCS = "doc_uid string, dataset_id string, source_path string, mime string, bytes long, checksum string, created_ts string, modified_ts string, title string, author string, lang string, charset string, chunk_count long, quarantine boolean, nsfw_score double, toxicity_score double, illicit_score double, pii_score double, risk_tags array<string>"
CHUNKS = "doc_uid string, chunk_id string, idx long, offset_start long, offset_end long, lang string, nsfw_score double, toxicity_score double, illicit_score double, pii_score double, text string"
FRAGMENT = "checksum string, idx long, start long, frag_cid string, content binary"


def _cid(text: Column, recipe: str) -> Column:
    return F.sha2(F.concat(text, F.lit(recipe)), 256)


def sources(files: DataFrame, collected_at: int, license: str | None = None) -> DataFrame:
    """One row an acquisition (``files`` as from ``sources.files.scan``); the id follows from path and time."""
    none = F.lit(None).cast("string")
    return files.select(
        F.sha2(F.concat("path", F.lit(f"|{collected_at}")), 256).alias("source_id"), F.col("path").alias("uri"), F.lit(collected_at).cast("long").alias("collected_at"), "mime", F.col("bytes").alias("size_bytes"), F.col("checksum").alias("sha256"), F.col("checksum").alias("blob_cid"),
        none.alias("headers"), F.lit(license).cast("string").alias("license"), none.alias("labels"),
    )


def blobs(found: DataFrame, root: str) -> DataFrame:
    """Each content once."""
    return found.groupBy("blob_cid").agg(F.min("sha256").alias("sha256"), F.min("size_bytes").alias("size_bytes"), F.min("mime").alias("mime")).withColumn("storage_uri", F.concat(F.lit(f"{root}/"), F.left("blob_cid", F.lit(2)), F.lit("/"), "blob_cid"))


def text_stats(text: Column, lang: Column) -> Column:
    """JSON of chars, tokens and lang."""
    return F.to_json(F.struct(F.length(text).cast("long").alias("chars"), T.token_count(text).alias("tokens"), lang.alias("lang")))


def extracted(found: DataFrame, extractors: dict[str, Callable[[bytes], str | None]]) -> DataFrame:
    """``found`` (mime, content, ...) with text by an extractor of one's own for each MIME type: a function from bytes to text.
    A type without one, null content, and what an extractor raises on give null: the job goes on without that file."""
    names = [*found.columns, "text"]
    at, kind = names.index("content"), names.index("mime")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for data, mime in zip(values(b.column(at), 8), values(b.column(kind))):
                try:
                    texts.append(extractors[mime](data) if data is not None and mime in extractors else None)
                except Exception:
                    texts.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=names)

    return found.mapInArrow(run, StructType([*found.schema.fields, StructField("text", StringType())]))


def extractions(texts: DataFrame, recipe: str = "v1") -> DataFrame:
    """Of (blob_cid, text): texts that are null are no extraction.  Other formats than text and HTML plug in ahead: ``extracted``."""
    return texts.where("text is not null").select(_cid(F.col("text"), recipe).alias("ext_cid"), "blob_cid", F.lit(recipe).alias("recipe_v"), text_stats(F.col("text"), F.lit("und")).alias("text_stats"), "text")


def normalized(extracted: DataFrame, recipe: str = "v1", lower: bool = False) -> DataFrame:
    """Compatibility form with folded white space, its exact hash and both near-duplicate signatures."""
    text = T.normalize_recipe(F.col("text"))
    n = extracted.select("ext_cid", (F.lower(text) if lower else text).alias("text")).dropDuplicates(["ext_cid"])
    n = n.withColumn("norm_hash", F.sha2("text", 256)).withColumn("norm_cid", _cid(F.concat("ext_cid", "norm_hash"), recipe))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [(simhash(t), signature(shingle_hashes(t, 5)).tobytes()) for t in values(b.column(1))]
            fp = np.array([x for x, _ in both], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), pa.array(fp), pa.array([x for _, x in both], pa.binary())], names=["norm_hash", "simhash64", "minhash_sig"])

    once = n.groupBy("norm_hash").agg(F.min("text").alias("text"))  # signatures are computed once a distinct text
    return n.join(once.mapInArrow(marks, "norm_hash string, simhash64 long, minhash_sig binary"), "norm_hash", "left").select("norm_cid", "ext_cid", "norm_hash", "simhash64", "minhash_sig", F.lit("und").alias("lang"), "text")


def window_chunks(norm: DataFrame, recipe: str = "v1", size: int = 800, overlap: int = 200, longest: int = 8000) -> DataFrame:
    """Fixed windows of tokens with spans into the normalized text (single spaces between tokens, so that spans map back); one of
    over ``longest`` characters goes in several chunks, so that no text is lost."""
    step = size - overlap
    n = norm.where("text <> ''").select("norm_cid", F.split("text", " ").alias("t"))
    # characters of every step's tokens, and their running sum: each token is measured once
    wide = F.transform(F.sequence(F.lit(0), F.size("t") - 1, F.lit(step)), lambda at: F.length(F.array_join(F.slice(F.col("t"), at + 1, step), " ")) + 1)
    sums = F.aggregate(wide, F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(0).cast("long").alias("at")), lambda s, w: F.struct(F.concat(s.starts, F.array(s["at"])).alias("starts"), (s["at"] + w).cast("long").alias("at")), lambda s: s.starts)
    n = n.select("norm_cid", "t", F.posexplode(sums).alias("k", "start"))
    n = n.select("norm_cid", "start", F.array_join(F.slice("t", F.col("k") * step + 1, F.lit(size)), " ").alias("w"))
    n = n.where("w <> ''").select("norm_cid", "start", "w", F.explode(F.sequence(F.lit(1), F.length("w"), F.lit(longest))).alias("from_"))
    c = n.select("norm_cid", (F.col("start") + F.col("from_") - 1).cast("long").alias("span_start"), F.substring("w", F.col("from_"), F.lit(longest)).alias("text"))
    return c.select(_cid(F.concat("norm_cid", F.col("span_start").cast("string"), "text"), recipe).alias("chunk_id"), "norm_cid", "span_start", (F.col("span_start") + F.length("text")).alias("span_end"), "text", F.sha2("text", 256).alias("norm_hash"))


def dedupe_map(chunks: DataFrame) -> DataFrame:
    """norm_hash, canonical_chunk_id: the smallest id of equal texts.  Nothing is deleted."""
    return chunks.groupBy("norm_hash").agg(F.min("chunk_id").alias("canonical_chunk_id"))


def canonical(chunks: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds canonical_chunk_id; a chunk the map doesn't know is its own."""
    return chunks.join(mapping, "norm_hash", "left").withColumn("canonical_chunk_id", F.coalesce("canonical_chunk_id", "chunk_id"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key no row of ``parent`` has; a null key is one.  None: every row can be traced."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def with_license(chunks: DataFrame, norm: DataFrame, extracted: DataFrame, found: DataFrame) -> DataFrame:
    """Chunks with the licences of all sources they come from, sorted.  Keys only travel up the chain; the texts don't."""
    terms = found.groupBy("blob_cid").agg(F.array_sort(F.collect_set("license")).alias("licenses"))
    up = chunks.select("chunk_id", "norm_cid").join(norm.select("norm_cid", "ext_cid"), "norm_cid").join(extracted.select("ext_cid", "blob_cid"), "ext_cid").join(terms, "blob_cid")
    by = up.groupBy("chunk_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("licenses")))).alias("licenses"))
    return chunks.join(by, "chunk_id", "left")


def metrics(docs: DataFrame, now_days: Column | None = None) -> DataFrame:
    """doc_id, token_len, readability (words a sentence), link_density (share of characters in links), dup_ratio, and
    age_days if ``docs`` has day (days since the epoch)."""
    text = F.coalesce("text", F.lit(""))
    links = F.aggregate(F.regexp_extract_all(text, F.lit(r"(?i)https?://[^\s\")]+"), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))
    ends = F.greatest(F.lit(1), F.size(F.regexp_extract_all(text, F.lit(r"[.!?]+(\s|$)"), F.lit(0))))
    age = [(now_days - F.col("day")).alias("age_days")] if now_days is not None else []
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    dup = F.when(F.size(lines) > 0, 1 - F.size(F.array_distinct(lines)) / F.size(lines)).otherwise(0.0)
    return docs.select("doc_id", T.token_count(text).alias("token_len"), (T.token_count(text) / ends).alias("readability"), F.when(F.length(text) > 0, links / F.length(text)).otherwise(0.0).alias("link_density"), dup.alias("dup_ratio"), *age)


def promoted(chunks: DataFrame, recent_days: int | None = None, min_quality: float | None = None, min_density: float | None = None) -> DataFrame:
    """Adds promote: all chunks if no limit is given, else those that are recent, good, used or central enough (columns
    age_days, quality, used, density; a null doesn't promote)."""
    rules = [F.col(c) <= x if c == "age_days" else F.col(c) >= x for c, x in (("age_days", recent_days), ("quality", min_quality), ("density", min_density)) if x is not None]
    if not rules:
        return chunks.withColumn("promote", F.lit(True))
    if "used" in chunks.columns:
        rules.append(F.col("used") > 0)
    hit = F.lit(False)
    for rule in rules:
        hit = hit | F.coalesce(rule, F.lit(False))
    return chunks.withColumn("promote", hit)


_GEAR = np.random.default_rng(7919).integers(0, 1 << 63, 256, dtype=np.uint64)


def cut_points(data: bytes, average: int, least: int, most: int) -> list[int]:
    """Ends of content-defined fragments: a hash of the last 32 bytes falls below a mask; sizes stay within bounds."""
    b = np.frombuffer(data, np.uint8)
    h = np.zeros(len(b), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(32, len(b))):
            h[k:] += _GEAR[b[: len(b) - k]] << np.uint64(k) if k else _GEAR[b]
    bits = max(1, average.bit_length() - 1)
    hits = np.flatnonzero((h >> np.uint64(32)) & np.uint64((1 << bits) - 1) == 0) + 1
    out, at = [], 0
    while at < len(b):
        i = int(np.searchsorted(hits, at + least))
        end = int(hits[i]) if i < len(hits) else len(b)
        at = min(end, at + most, len(b))
        out.append(at)
    return out


def fragments(files: DataFrame, average_kb: int = 128) -> DataFrame:
    """checksum, idx, start, frag_cid, content: content-defined chunks of every file; in order they are the file."""
    import hashlib

    average = average_kb * 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for checksum, data in zip(b.column(0).to_pylist(), b.column(1)):
                data = data.as_py() or b""
                at, rows = 0, []
                for k, end in enumerate(cut_points(data, average, average // 4, average * 4)):
                    rows.append((checksum, k, at, hashlib.sha256(data[at:end]).hexdigest(), data[at:end]))
                    at = end
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()))], names=["checksum", "idx", "start", "frag_cid", "content"])

    return files.select("checksum", "content").mapInArrow(run, FRAGMENT)
