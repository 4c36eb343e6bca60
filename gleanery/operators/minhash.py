"""MinHash signatures, banded search and exact near-duplicate links over word shingles.

Two steps.  The first is coarse and may join too much: nodes (distinct shingle sets) that share a band of the signature are
joined by numbers alone, which gives groups that hold every pair of the banded search.  The second reads the texts of
groups of two or more, once, and finds in each group exactly what links of the wanted Jaccard similarity join.

Skew: a bucket with many members in one batch is joined there and sends one row on, so a bucket that a third of all nodes
share arrives with a few rows a batch.  A group over ``BLOCK`` members or ``SHINGLES`` shingles is cut into slices; a few
members are in every slice and so tie the slices together.  Those that are still apart from the group's largest
component then meet every other member in parts of bounded size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.batches import values
from gleanery.operators.joins import BROADCAST_ROWS

PERMS = 128
_A = np.random.default_rng(20240229).integers(1, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.default_rng(20240301).integers(0, 1 << 63, PERMS, dtype=np.uint64)
BLOCK = 1024  # members of a group, or of a bucket, that are worked on at once
SHINGLES = 1 << 20  # and their shingles, unless a single text has more
LOCAL = 16  # members of a bucket in one batch that go on as they are
HUBS = 16  # expected number of members that are in every slice of a group


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Distinct 64-bit hashes of the lower-cased word shingles; a shorter text is one shingle, an empty one has none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(width, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += w[i : i + n]
        h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(h: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the least of PERMS multiply-add permutations."""
    out = np.full(PERMS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 128):
            np.minimum(out, (h[at : at + 128, None] * _A + _B).min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def _id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """(id, same, n, sig): ``same`` is equal for equal shingle sets (128 bits), n the number of shingles, sig the
    signature as little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same, n, sig = [], [], []
            for t in values(b.column(1)):
                h = shingle_hashes(t, width)
                same.append(xxhash.xxh3_128_digest(h.tobytes())), n.append(len(h)), sig.append(signature(h).tobytes())
            yield pa.record_batch([b.column(0), pa.array(same, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())], names=["id", "same", "n", "sig"])

    return _id_text(docs, id_col, text_col).mapInArrow(run, "id long, same binary, n long, sig binary")


def distinct_sets(sig: DataFrame) -> DataFrame:
    """(same, id, n, sig): one row a shingle set, under its smallest id (grouped with map-side combine)."""
    return sig.where("id is not null").groupBy("same").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.min_by("sig", "id").alias("sig"))


# first step: groups by shared bands


def sketch(sig: np.ndarray) -> np.ndarray:
    """Rows of two 64-bit words: the lowest bit of each signature value.  Two texts differ in (1 - Jaccard) / 2 of them."""
    return np.packbits((sig & 1).astype(np.uint8), axis=1).view(np.uint64)


def sketch_cut(threshold: float) -> int:
    """Differing sketch bits that a pair at the threshold exceeds about once in 30,000 times (four deviations)."""
    p = (1 - threshold) / 2
    return math.ceil(PERMS * p + 4 * math.sqrt(PERMS * p * (1 - p)))


def band_keys(part: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of 32-bit numbers."""
    h = np.full(len(part), 0x2545F4914F6CDD1D, np.uint64)
    with np.errstate(over="ignore"):
        for c in range(part.shape[1]):
            h = (h ^ part[:, c].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
    return h


def sketch_forest(sk: np.ndarray, cut: int) -> list[tuple[int, int]]:
    """Edges that join exactly what sketches at a distance of at most ``cut`` join."""
    left = np.arange(len(sk))
    out = []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(sk[left] ^ sk[x]).sum(axis=1, dtype=np.int64) <= cut
            if near.any():
                todo += left[near].tolist()
                out += [(x, y) for y in left[near].tolist()]
                left = left[~near]
    return out


_KEYED = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("id", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("many", pa.bool_())])


def _deal(bands: int, rows: int) -> Callable:
    """A row a node and band.  A bucket with over ``LOCAL`` members in a batch sends its first one alone (``many``), and the
    edges to the others as rows of band -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(-1, PERMS)
            ids, sk = b.column(0).to_numpy(zero_copy_only=False), sketch(sig).view(np.int64)
            for band in range(bands):
                key = band_keys(sig[:, band * rows : (band + 1) * rows]).view(np.int64)
                _, first, back, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                many = count[back] > LOCAL
                rep = first[back]
                stay = ~many | (rep == np.arange(len(key)))
                gone = np.flatnonzero(~stay)
                for at, band_, key_ in ((np.flatnonzero(stay), band, key), (gone, -1, ids[rep])):
                    if len(at):
                        columns = [np.full(len(at), band_, np.int32), key_[at], ids[at], sk[at, 0], sk[at, 1], many[at]]
                        yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], schema=_KEYED)

    return run


def _join_buckets(cut: int) -> Callable:
    """(a, b) of rows sorted by band and key: edges of a bucket's sketches; of a bucket over ``BLOCK`` rows, or one that
    was joined in part before, edges from the first member to all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # the last bucket: band, key, id, s1, s2, many
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []

        def close(rows: np.ndarray) -> None:
            if len(rows) > BLOCK or rows[:, 5].any():
                a.append(np.full(len(rows) - 1, rows[0, 2])), b.append(rows[1:, 2])
            elif edges := sketch_forest(np.ascontiguousarray(rows[:, 3:5]).view(np.uint64), cut):
                at = np.array(edges)
                a.append(rows[at[:, 0], 2]), b.append(rows[at[:, 1], 2])

        def out() -> Iterator[pa.RecordBatch]:
            if a:
                yield pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                a.clear(), b.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)], axis=1)
            ready = rows[rows[:, 0] < 0]
            if len(ready):
                a.append(ready[:, 1]), b.append(ready[:, 2])
                rows = rows[len(ready) :]  # band -1 sorts first
            if held is not None:
                rows = np.concatenate((held, rows))
            if len(rows):
                start = np.concatenate(([0], np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1))
                size = np.diff(np.append(start, len(rows)))
                held = rows[start[-1] :]
                start, size = start[:-1], size[:-1]
                two = start[(size == 2)]
                if len(two):
                    x, y = rows[two], rows[two + 1]
                    near = (np.bitwise_count((x[:, 3:5] ^ y[:, 3:5]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= cut) | (x[:, 5] | y[:, 5]).astype(bool)
                    a.append(x[near, 2]), b.append(y[near, 2])
                for lo, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
                    close(rows[lo : lo + n])
                if len(held) > BLOCK:
                    close(held)
                    held = held[:1].copy()
                    held[0, 5] = 1  # whatever follows is joined to it
            yield from out()
        if held is not None and len(held) > 1:
            close(held)
        yield from out()

    return run


def bucket_edges(nodes: DataFrame, bands: int, rows: int, threshold: float) -> DataFrame:
    """(a, b): edges whose components hold every pair of ``nodes`` (id, sig) that shares a band of ``rows`` signature values
    and whose sketches are within ``sketch_cut(threshold)``."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.select("id", "sig").mapInArrow(_deal(bands, rows), "band int, key long, id long, s1 long, s2 long, many boolean")
    return dealt.repartition(n, "band", "key").sortWithinPartitions("band", "key", "id").mapInArrow(_join_buckets(sketch_cut(threshold)), "a long, b long")


# second step: exact links within a group


class Overlaps:
    """Sizes of the intersections of one set with all of a narrowing choice of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets])
        flat, code = np.unique(np.concatenate(sets), return_inverse=True)
        self.codes, self.code = len(flat), code
        self.of = np.repeat(np.arange(len(sets)), self.n)
        self.at = np.concatenate(([0], np.cumsum(self.n)))
        self.narrow(np.arange(len(sets)))

    def narrow(self, members: np.ndarray) -> None:
        keep = np.zeros(len(self.n), bool)
        keep[members] = True
        keep = keep[self.of]
        code = self.code[keep]
        self.posted = self.of[keep][np.argsort(code, kind="stable")]
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=self.codes))))

    def jaccard(self, x: int) -> np.ndarray:
        """With every set; 0 for those left out."""
        c = self.code[self.at[x] : self.at[x + 1]]
        lo = self.begin[c]
        n = self.begin[c + 1] - lo
        spots = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.posted[spots], minlength=len(self.n))
        return both / np.maximum(1, self.n[x] + self.n - both)


def exact_forest(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Edges that join exactly what pairs with a Jaccard of ``threshold`` or more join."""
    m = len(sets)
    if m < 2:
        return []
    if m == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if both / max(1, len(sets[0]) + len(sets[1]) - both) >= threshold else []
    index = Overlaps(sets)
    left = np.ones(m, bool)
    n = indexed = m
    out = []
    for seed in range(m):
        if not left[seed]:
            continue
        left[seed] = False
        n -= 1
        todo = [seed]
        while todo and n:
            x = todo.pop()
            near = np.flatnonzero((index.jaccard(x) >= threshold) & left)
            if len(near):
                left[near] = False
                n -= len(near)
                todo += near.tolist()
                out += [(x, y) for y in near.tolist()]
                if 2 * n < indexed:
                    index.narrow(np.flatnonzero(left))
                    indexed = n
    return out


def exact_ties(sets: list[np.ndarray], label: list[int], ask: list[bool], threshold: float) -> list[tuple[int, int]]:
    """The same between members of different labels, for pairs with at least one member in ``ask``."""
    up = {x: x for x in label}

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    if len(up) < 2 or not any(ask):
        return []
    index = Overlaps(sets)
    out = []
    for x in np.flatnonzero(ask).tolist():
        for y in np.flatnonzero(index.jaccard(x) >= threshold).tolist():
            p, q = find(label[x]), find(label[y])
            if p != q:
                up[p] = q
                out.append((x, y))
    return out


def _link_parts(width: int, threshold: float) -> Callable:
    """(a, b) of rows (comp, part, id, label, ask, text) sorted by comp and part; a null label is the member's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        ids: list[int] = []
        sets: list[np.ndarray] = []
        label: list[int | None] = []
        ask: list[bool] = []
        a: list[int] = []
        b: list[int] = []

        def close() -> None:
            if len(ids) > 1:
                for x, y in exact_forest(sets, threshold) if label[0] is None else exact_ties(sets, label, ask, threshold):
                    a.append(ids[x]), b.append(ids[y])
            ids.clear(), sets.clear(), label.clear(), ask.clear()

        for batch in batches:
            for comp, part, i, of, asks, text in zip(*(values(batch.column(c)) for c in range(6))):
                if (comp, part) != key:
                    close()
                    key = comp, part
                ids.append(i), sets.append(shingle_hashes(text, width)), label.append(of), ask.append(asks)
            if a:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a.clear(), b.clear()
        close()
        if a:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _linked(members: DataFrame, texts: DataFrame, width: int, threshold: float, save: Callable) -> DataFrame:
    """(a, b) of (comp, part, id, label, ask): each part's texts meet in one task."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = save(members.select("comp", "part", F.col("id").alias("_id"), "label", "ask"))
    if members.count() <= BROADCAST_ROWS:
        members = F.broadcast(members)
    rows = texts.join(members, F.col("id") == F.col("_id")).select("comp", "part", "id", "label", "ask", "text")
    return rows.repartition(n, "comp", "part").sortWithinPartitions("comp", "part", "id").mapInArrow(_link_parts(width, threshold), "a long, b long")


def _pieces(members: str, shingles: str, block: int, most: int) -> F.Column:
    """Into how many groups of about ``block`` members and ``most`` shingles a set of both sums is cut."""
    return F.greatest(F.lit(1), F.ceil(F.col(members) / F.lit(block)), F.ceil(F.col(shingles) / F.lit(most))).cast("long")


def _slices(parts: DataFrame, large: DataFrame) -> DataFrame:
    """(comp, part, id) of (id, comp, n): one part a group; a large group's members by hash, the hubs in every slice."""
    d = parts.join(large.select("comp", "members", "g"), "comp", "left")
    hub = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1 << 20)) < F.lit(HUBS << 20) / F.col("members")
    mine = F.when(F.col("g").isNull(), F.array(F.lit(0).cast("long"))).when(hub, F.expr("sequence(0L, g - 1)")).otherwise(F.array(F.expr("pmod(xxhash64(id), g)")))
    return d.select("comp", F.explode(mine).alias("part"), "id")


def _rest(members: DataFrame) -> DataFrame:
    """(comp, part, id, label, ask) of (id, comp, n, label): the members outside the largest component of a group, with
    every other member of it.  Those outside are cut into ``gu`` groups, those inside into ``gt``; a part is two groups."""
    half, most = max(1, BLOCK // 2), SHINGLES // 2
    sums = members.groupBy("comp", "label").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    of = sums.groupBy("comp").agg(F.sum("k").alias("k"), F.sum("s").alias("s"), F.max_by(F.struct("label", "k", "s"), F.struct("k", "label")).alias("top")).where("k > top.k")
    of = of.select("comp", F.col("top.label").alias("top"), (F.col("k") - F.col("top.k")).alias("ku"), (F.col("s") - F.col("top.s")).alias("su"), F.col("top.k").alias("kt"), F.col("top.s").alias("st"))
    of = of.select("comp", "top", _pieces("ku", "su", half, most).alias("gu"), _pieces("kt", "st", half, most).alias("gt"))
    d = members.join(of, "comp").withColumn("ask", F.col("label") != F.col("top"))
    d = d.withColumn("mine", F.when(F.col("ask"), F.expr("pmod(xxhash64(id), gu)")).otherwise(F.expr("gu + pmod(xxhash64(id), gt)")))
    d = d.withColumn("other", F.explode(F.when(F.col("ask"), F.expr("filter(sequence(0L, gu + gt - 1), x -> x <> mine)")).otherwise(F.expr("sequence(0L, gu - 1)"))))
    return d.select("comp", (F.least("mine", "other") * (F.col("gu") + F.col("gt")) + F.greatest("mine", "other")).alias("part"), "id", "label", "ask")


def similar_links(nodes: DataFrame, docs: DataFrame, threshold: float, bands: int, rows: int, width: int = 5, save: Callable = lambda df: df.checkpoint(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b): pairs with a Jaccard similarity of at least ``threshold``, not all of them, but enough that their components
    are those of all such pairs within the groups of ``bucket_edges``.

    ``nodes`` is (id, n, sig), a row a distinct shingle set; the texts of an id are those of ``docs``.
    """
    from gleanery.operators.graph import connected_components

    texts = _id_text(docs, id_col, text_col)
    coarse = connected_components(save(bucket_edges(nodes, bands, rows, threshold)), save).toDF("id", "comp")
    members = save(nodes.groupBy("id").agg(F.sum("n").alias("n")).join(coarse, "id").select("id", "comp", "n"))
    sums = members.groupBy("comp").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
    large = save(sums.withColumn("g", _pieces("members", "n", BLOCK, SHINGLES)).where("g > 1"))
    own = F.lit(None).cast("long")
    links = save(_linked(_slices(members, large).withColumns({"label": own, "ask": F.lit(True)}), texts, width, threshold, save))
    if large.isEmpty():
        return links
    big = save(members.join(large.select("comp"), "comp", "left_semi"))
    inner = links.join(big.select(F.col("id").alias("a")), "a", "left_semi")
    label = connected_components(inner, save).toDF("id", "label")
    big = save(big.join(label, "id", "left").select("id", "comp", "n", F.coalesce("label", "id").alias("label")))
    return links.union(save(_linked(_rest(big), texts, width, threshold, save)))


def near_dedupe_map(docs: DataFrame, threshold: float, bands: int, rows: int, width: int = 5, save: Callable = lambda df: df.checkpoint(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, canonical_id: the smallest id reachable over pairs with a Jaccard of ``threshold`` or more.

    Equal shingle sets are one node from the start (grouped with map-side combine), so copies never meet in a bucket; rows
    without an id are left out, texts without a word are alike.  Nothing is deleted: the map points alternates to the one that stays.
    """
    from gleanery.operators.graph import connected_components

    sig = save(signatures(docs, id_col, text_col, width).where("id is not null"))
    nodes = save(distinct_sets(sig))
    found = connected_components(similar_links(nodes.where("n > 0").select("id", "n", "sig"), docs, threshold, bands, rows, width, save, id_col, text_col), save)
    reps = nodes.join(found, nodes.id == found.node, "left").select("same", F.coalesce("component", "id").alias("canonical_id"))
    return sig.select("id", "same").join(reps, "same").groupBy(F.col("id").alias(id_col)).agg(F.min("canonical_id").alias("canonical_id"))
