"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: lower-case A-Z, words are runs of other than ASCII white space, shingles of ``words_per_shingle`` words
(repeats count; a shorter text is one shingle), XXH64 with seed 42, and a bit is set if it is set in over half of
the hashes.  A text without words (null, empty, only white space) has fingerprint zero and links like any other.

Linking: to each bit position belongs a non-zero vector of GF(2)^(r+1), to each non-zero vector v of that space a
mask that keeps the positions whose vector is not orthogonal to v.  The differing positions of two fingerprints
within radius r span at most r dimensions, so some v is orthogonal to all of them and the pair agrees on all that
v's mask keeps: no pair is missed.  2^(r+1) - 1 tables suffice (15 for r = 3).

Skew: equal fingerprints are one node from the start, so copies never meet in a bucket.  A bucket over
``hot_bucket`` nodes is dealt out again by a second covering family over the bits its mask left free; as the nodes
are distinct, what remains free (14 bits for r = 3) bounds those buckets whatever the corpus.  A bucket emits a
forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.batches import values
from gleanery.llm.common import checkpoint, connected_components, id_text
from gleanery.operators import minhash
from gleanery.operators.joins import by_keys, free_name

RADIUS = 3
HOT_BUCKET = 2048


def simhash64(text: bytes, width: int = 3, digest=xxhash.xxh64_digest) -> int:
    words = text.lower().split()  # of bytes: A-Z only, and exactly \x20 \x09-\x0D
    n = len(words)
    if n <= width:
        return int.from_bytes(digest(b" ".join(words), 42), "big") if n else 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = (ends[: n - width + 1] - np.fromiter(map(len, words[: n - width + 1]), np.int64) - 1).tolist()
    hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())])
    m = n - width + 1
    bits = np.zeros(64, np.int64)
    grid = np.frombuffer(hashes, np.uint8).reshape(m, 8)
    for at in range(0, m, 4096):
        bits += np.unpackbits(grid[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > m).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((simhash64(t, width) for t in values(b.column(1).cast(pa.binary()))), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def _vectors(n: int, radius: int) -> list[int]:
    return [i % (2 ** (radius + 1) - 1) + 1 for i in range(n)]


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """A mask over the given bit positions for every table."""
    of = list(zip(positions, _vectors(len(positions), radius)))
    return [sum(1 << p for p, x in of if (x & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fp: np.ndarray, node: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges that join exactly what links of at most ``radius`` bits join within one bucket."""
    if len(fp) == 2:
        if (int(fp[0]) ^ int(fp[1])).bit_count() <= radius:
            yield int(node[0]), int(node[1])
        return
    left_fp, left = fp, node
    while len(left):
        todo = [(left_fp[0], left[0])]
        left_fp, left = left_fp[1:], left[1:]
        while todo and len(left):
            x, at = todo.pop()
            near = np.bitwise_count(left_fp ^ x) <= radius
            if near.any():
                for y, other in zip(left_fp[near], left[near]):
                    yield int(at), int(other)
                    todo.append((y, other))
                left_fp, left = left_fp[~near], left[~near]


def _link(keys: list[str], limit: int | None, radius: int):
    """Over rows sorted by ``keys``: edges of each bucket, or the rows of a bucket over ``limit`` as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keys)
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("t", pa.int32())])
        a: list[int] = []
        b: list[int] = []
        t: list[int] = []
        held: list[np.ndarray] = []  # the open bucket: rows of keys, fp, node
        hot = None

        def close(rows: np.ndarray) -> None:
            if len(rows) > 1:
                for x, y in _forest(rows[:, k].view(np.uint64), rows[:, k + 1], radius):
                    a.append(x), b.append(y), t.append(0)

        def spill(rows: np.ndarray) -> None:  # a hot bucket: (fp, node, table)
            a.extend(rows[:, k].tolist()), b.extend(rows[:, k + 1].tolist()), t.extend(rows[:, 0].tolist())

        def out() -> Iterator[pa.RecordBatch]:
            if a:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(t, pa.int32())], schema=schema)
                a.clear(), b.clear(), t.clear()

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(k + 2)], axis=1)
            if not len(rows):
                continue
            cut = np.flatnonzero((rows[1:, :k] != rows[:-1, :k]).any(axis=1)) + 1
            parts = np.split(rows, cut) if len(cut) < 64 else None
            bounds = [0, *cut.tolist(), len(rows)]
            for i in range(len(bounds) - 1):
                lo, hi = bounds[i], bounds[i + 1]
                if i and hi - lo == 1 and i < len(bounds) - 2:  # alone in its bucket
                    if held:
                        close(np.concatenate(held)), held.clear()
                    hot = None
                    continue
                part = parts[i] if parts else rows[lo:hi]
                key = tuple(part[0, :k].tolist())
                if hot is not None and hot == key:
                    spill(part)
                    continue
                hot = None
                if held and tuple(held[0][0, :k].tolist()) != key:
                    close(np.concatenate(held)), held.clear()
                held.append(part)
                if limit is not None and sum(map(len, held)) > limit:
                    spill(np.concatenate(held)), held.clear()
                    hot = key
            yield from out()
        if held:
            close(np.concatenate(held))
        yield from out()

    return run


def links(nodes: DataFrame, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(a, b): edges over ``nodes`` (node, fp; fp distinct) whose components are those of all pairs within ``radius``."""
    masks = covering_masks(list(range(64)), radius)
    keyed = nodes.select("node", "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "key"))
    n = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    first = keyed.select("t", "key", "fp", "node").repartition(n, "t", "key").sortWithinPartitions("t", "key")
    first = checkpoint(first.select((F.col("t") + 1).alias("t"), "key", "fp", "node").mapInArrow(_link(["t", "key"], hot_bucket, radius), "a long, b long, t int"))
    hot = first.where("t > 0").select(F.col("t").alias("t"), F.col("a").alias("fp"), F.col("b").alias("node"))
    sub = [covering_masks([p for p in range(64) if not m >> p & 1], radius) for m in masks]
    # the second family's masks also keep what the first kept, so that the key alone names the bucket within its tables
    pick = F.array(*[F.array(*[F.lit(_signed(s | m)) for s in ss]) for m, ss in zip(masks, sub)])
    hot = hot.select("t", "fp", "node", F.posexplode(F.element_at(pick, F.col("t"))).alias("t2", "mask"))
    hot = hot.select("t", "t2", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "node")
    second = hot.repartition(n, "t", "t2", "key").sortWithinPartitions("t", "t2", "key").mapInArrow(_link(["t", "t2", "key"], None, radius), "a long, b long, t int")
    return first.where("t = 0").select("a", "b").union(second.select("a", "b"))


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id: one row per input row.

    Null text counts as empty (fingerprint zero).  Repeated rows are returned as often.  A row whose doc_id is null
    takes the component of its fingerprint, and null if no row with that fingerprint has an id.  An empty table
    gives an empty result.
    """
    fps = checkpoint(fingerprints(docs, width))
    nodes = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("node")))
    found = connected_components(links(nodes.where("node is not null"), radius, hot_bucket))
    reps = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(reps, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _prints(docs: DataFrame, width: int) -> DataFrame:
    """id, fp, same, n, sig: SimHash and MinHash of every row, texts being read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, same, n, sig = [], [], [], []
            for t in values(b.column(1)):
                h = minhash.shingle_hashes(t, width)
                fp.append(simhash64(t.encode("utf-8", "surrogatepass"), width)), same.append(xxhash.xxh3_128_digest(h.tobytes())), n.append(len(h)), sig.append(minhash.signature(h).tobytes())
            yield pa.record_batch([b.column(0), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(same, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())], names=["id", "fp", "same", "n", "sig"])

    return id_text(docs).mapInArrow(run, "id long, fp long, same binary, n long, sig binary")


def _similar_nodes(docs: DataFrame, width: int, similarity: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prints, nodes, twice).  A node is a distinct shingle set under its smallest id: (same, id, component).  Everything but
    the two ends works on nodes, so that copies, however many, are never a key of a join.  ``twice`` holds ids of
    several rows; the nodes of one id belong together."""
    prints = checkpoint(_prints(docs, width).where("id is not null"))
    nodes = checkpoint(minhash.distinct_sets(prints))
    alike = minhash.similar_links(nodes.where("n > 0").select("id", "n", "sig"), docs, similarity, bands, rows, width, save=checkpoint)
    of = checkpoint(prints.groupBy("same", "fp").agg(F.min("id").alias("id")).join(nodes.select("same", F.col("id").alias("node")), "same").select("node", "fp").distinct())
    leads = checkpoint(of.groupBy("fp").agg(F.min("node").alias("node")))
    close = links(leads, RADIUS)
    equal = of.join(leads.withColumnRenamed("node", "lead"), "fp").where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    twice = checkpoint(prints.groupBy("id").count().where("count > 1").select("id"))
    both = prints.join(twice, "id").select("id", "same").distinct().join(nodes.select("same", F.col("id").alias("b")), "same").where("id <> b").select(F.col("id").alias("a"), "b")
    found = connected_components(alike.union(close).union(equal).union(both))
    named = nodes.select("same", "id").join(found, F.col("id") == F.col("node"), "left").select("same", "id", F.coalesce("component", "id").alias("component"))
    return prints, checkpoint(named), twice


def similar_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, bands: int = 21, rows: int = 6) -> DataFrame:
    """doc_id, component_id: SimHash links over shingles of ``width`` words and, as three bits of 64 reach only the
    closest copies, the links of the shingle sets with a Jaccard similarity of ``similarity`` or more.

    The second kind comes from the library's banded MinHash search (a pair at 0.8 shares a band with probability
    0.998), whose groups are then searched exactly.  One row an id; rows without one are left out.  Null text counts
    as empty, and all texts without a word are alike.  The rows of a repeated id are one document.  An empty table
    gives an empty result.
    """
    prints, nodes, _ = _similar_nodes(docs, width, similarity, bands, rows)
    return prints.select("id", "same").join(nodes.select("same", "component"), "same").groupBy(F.col("id").alias("doc_id")).agg(F.min("component").alias("component_id"))


def deduplicated(docs: DataFrame, width: int = 5, similarity: float = 0.8, bands: int = 21, rows: int = 6) -> DataFrame:
    """The rows of ``docs``, all columns, of the smallest doc_id of each group (see ``similar_groups``).

    Rows without an id stay.  Of rows that repeat an id one stays (the one with the smallest text).  Null and empty texts
    are one group.  Columns may have any names.  An empty table gives an empty result.
    """
    prints, nodes, twice = _similar_nodes(docs, width, similarity, bands, rows)
    stay = nodes.select("component").distinct()  # of every group the smallest id
    gone = prints.select("id").distinct().join(stay, F.col("id") == F.col("component"), "left_anti")
    kept = by_keys(docs, gone, "doc_id", "left_anti", checkpoint)
    if twice.isEmpty():
        return kept
    nth = free_name(docs.columns, "_nth")
    repeated = by_keys(kept.where("doc_id is not null"), twice, "doc_id", "left_semi", checkpoint)
    one = repeated.withColumn(nth, F.row_number().over(Window.partitionBy(F.col("doc_id").cast("long")).orderBy("text"))).where(F.col(nth) == 1).drop(nth)
    return by_keys(kept, twice, "doc_id", "left_anti", checkpoint).unionByName(one)
