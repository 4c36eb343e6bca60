"""Graph enrichment: upserts, PageRank, label propagation, provenance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.joins import free_name

SMALL = 1_000_000  # edges that one task joins: 16 bytes each


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Of the rows of both with equal keys the one with the latest version; of equal versions a row of ``new`` goes before one
    of ``old``, and then the one whose columns are smallest, in order of name."""
    side, nth = free_name(old.columns, "_side"), free_name(old.columns, "_nth")
    w = Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last(), F.col(side).desc(), *sorted(set(old.columns) - {*keys, version}))
    both = old.withColumn(side, F.lit(0)).unionByName(new.withColumn(side, F.lit(1)))
    return both.withColumn(nth, F.row_number().over(w)).where(F.col(nth) == 1).drop(nth, side)


def repeated_keys(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """The keys, and n, that several nodes have: a graph whose keys are unique has no row.  A null is a key like any other."""
    return nodes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def personalised_pagerank(edges: DataFrame, seeds: DataFrame, rounds: int = 3, damping: float = 0.85, save=lambda df: df) -> DataFrame:
    """node, rank after a fixed number of rounds over (src, dst); rank of nodes without an edge out returns to the seeds."""
    e = save(edges.select("src", "dst"))
    deg = save(e.groupBy("src").agg(F.count(F.lit(1)).alias("deg")))
    n = seeds.count()
    base = seeds.select("node", F.lit(1.0 / max(1, n)).alias("s"))
    rank = base.select("node", F.col("s").alias("rank"))
    for _ in range(rounds):
        r = rank.join(deg, rank.node == deg.src, "left").select("node", "rank", "deg")
        lost = r.where("deg is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("lost"))
        flow = r.where("deg is not null").join(e, r.node == e.src).select(F.col("dst").alias("node"), (F.col("rank") / F.col("deg") * damping).alias("x"))
        back = base.join(F.broadcast(lost)).select("node", (F.col("s") * (1 - damping + damping * F.col("lost"))).alias("x"))
        rank = save(flow.union(back).groupBy("node").agg(F.sum("x").alias("rank")))
    return rank


def communities(edges: DataFrame, rounds: int = 5, save=lambda df: df) -> DataFrame:
    """node, label: synchronous label propagation, the most frequent label of the neighbours, ties to the smallest."""
    both = save(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    lab = both.select(F.col("src").alias("node")).distinct().withColumn("label", F.col("node"))
    for _ in range(rounds):
        votes = both.join(lab, both.dst == lab.node).groupBy("src", "label").agg(F.count(F.lit(1)).alias("n"))
        lab = save(votes.groupBy(F.col("src").alias("node")).agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label")))
    return lab


def provenance(chunks: DataFrame, extractions: DataFrame, blobs: DataFrame, sources: DataFrame) -> DataFrame:
    """chunk_id, norm_cid, blob_cid, source_id, uri: three equi-joins down the chain."""
    return chunks.join(extractions, "norm_cid").join(blobs, "blob_cid").join(sources, "source_id").select("chunk_id", "norm_cid", "blob_cid", "source_id", "uri")


def _smallest_reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, p) of all edges (a, b) of a bounded number."""
    edges = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
    if not edges:
        return
    ids, at = np.unique(np.concatenate([x for pair in edges for x in pair]), return_inverse=True)
    sizes = [len(x) for pair in edges for x in pair]
    pieces = np.split(at, np.cumsum(sizes)[:-1])
    a, b = np.concatenate(pieces[::2]), np.concatenate(pieces[1::2])
    up = np.arange(len(ids))
    while len(a):  # ids are sorted: the smaller index is the smaller id
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (up[up] != up).any():
            up = up[up]
        a, b = up[a], up[b]
        a, b = a[a != b], b[a != b]
    for lo in range(0, len(ids), 10_000):
        yield pa.record_batch([pa.array(ids[lo : lo + 10_000]), pa.array(ids[up[lo : lo + 10_000]])], names=["node", "p"])


def connected_components(edges: DataFrame, save=lambda df: df.checkpoint(), max_rounds: int = 60, small: int = SMALL) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has long columns (a, b); loops, repeats and either direction are fine, nulls are ignored.  Returns
    (node, component).

    Contraction: each node hooks onto its smallest neighbour, the resulting forest is flattened by pointer
    jumping, and the edges are rewritten to the roots.  Every root that still has an edge absorbs at least one
    other node a round, so the rounds are logarithmic in the size of the largest component whatever its shape;
    all steps are joins and partial aggregations, nothing is gathered per component.  Once the edges that are left have been
    counted and are ``small`` or fewer (16 MB), one task joins them at once and saves the many short rounds of the end.
    ``save`` materialises a frame (by default a checkpoint, whose folder the session must have).
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    e = save(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    levels: list[DataFrame] = []
    for _ in range(max_rounds):
        if (n := e.count()) <= small:
            if n:
                levels.append(save(e.coalesce(1).mapInArrow(_smallest_reachable, "node long, p long")))
            break
        both = e.union(e.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p")).select("node", F.least("node", "p").alias("p"))
        hook = save(hook)
        while True:  # flatten: depth halves each time
            up = hook.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            nxt = save(hook.join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("q"), "p"))
            moved = not nxt.where("q <> p").isEmpty()
            hook = nxt.select("node", F.col("q").alias("p"))
            if not moved:
                break
        levels.append(hook)
        ra = hook.select(F.col("node").alias("a"), F.col("p").alias("x"))
        rb = hook.select(F.col("node").alias("b"), F.col("p").alias("y"))
        e = e.join(ra, "a").join(rb, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        e = save(e)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if not levels:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = levels.pop()
    while levels:  # a root of one round is a node of the next, if it still had an edge
        up = found.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        found = levels.pop().join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("p"))
    return found.select("node", F.col("p").alias("component"))
