"""Bag of words, K-means, silhouette and exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions import text as T


def first_seen(texts: DataFrame) -> DataFrame:
    """token, pos: of (pos, text), the first (text, token) position of every lower-cased token."""
    d = texts.select("pos", F.posexplode(T.tokens(F.lower("text"))).alias("at", "token"))
    return d.groupBy("token").agg(F.min(F.struct("pos", "at")).alias("first"))


def vocabulary(texts: DataFrame) -> DataFrame:
    """token, idx by first appearance.  Numbered in two levels: within ranges of the text position, then range by range,
    so that no single task sorts the vocabulary."""
    f = first_seen(texts)
    n = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lo, hi = texts.agg(F.coalesce(F.min("pos"), F.lit(0)), F.coalesce(F.max("pos"), F.lit(0))).first()
    f = f.withColumn("r", F.floor((F.col("first.pos") - lo) * n / (hi - lo + 1)))
    f = f.withColumn("k", F.row_number().over(Window.partitionBy("r").orderBy("first")))
    size = f.groupBy("r").agg(F.count(F.lit(1)).alias("c"))
    before = size.select("r", F.coalesce(F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))  # at most n rows
    return f.join(F.broadcast(before), "r").select("token", (F.col("k") - 1 + F.col("b")).cast("long").alias("idx"))


def bow(texts: DataFrame) -> DataFrame:
    """pos, token, cnt: sparse raw counts."""
    return texts.select("pos", F.explode(T.tokens(F.lower("text"))).alias("token")).groupBy("pos", "token").agg(F.count(F.lit(1)).alias("cnt"))


def bow_vectors(texts: DataFrame, most: int = 50_000) -> DataFrame:
    """id, vec of (pos, text): dense counts over the vocabulary, a zero vector for a text without tokens.  For vocabularies
    of up to ``most`` tokens; larger ones need ``embedded`` with hashed words, whose length is fixed."""
    words = vocabulary(texts)
    size = words.count()
    if size > most:
        raise ValueError(f"{size} tokens are too many for dense vectors")
    cells = bow(texts).join(words, "token").groupBy("pos").agg(F.map_from_entries(F.collect_list(F.struct("idx", F.col("cnt").cast("double")))).alias("m"))
    zero = F.coalesce("m", F.create_map().cast("map<bigint,double>"))
    places = F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")) if size else F.array().cast("array<bigint>")
    d = texts.select("pos").join(cells, "pos", "left").withColumn("m", zero)
    return d.select(F.col("pos").alias("id"), F.transform(places, lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0.0))).alias("vec"))


def cluster_texts(texts: DataFrame, k: int = 5, rounds: int = 10) -> DataFrame:
    """id, label of (pos, text): deterministic K-means over bags of words."""
    return kmeans(bow_vectors(texts), k, rounds)


def squared_distances(a: DataFrame, b: DataFrame) -> DataFrame:
    """pos_a, pos_b, sqdist of stated pairs (pos_a, pos_b) over sparse counts: |a|^2 + |b|^2 - 2ab."""
    norm = a.groupBy("pos").agg(F.sum(F.col("cnt") * F.col("cnt")).alias("q"))
    dot = b.join(a.withColumnsRenamed({"pos": "pos_a", "cnt": "ca"}), "pos_a").join(a.withColumnsRenamed({"pos": "pos_b", "cnt": "cb"}), ["pos_b", "token"]).groupBy("pos_a", "pos_b").agg(F.sum(F.col("ca") * F.col("cb")).alias("dot"))
    d = b.join(norm.withColumnsRenamed({"pos": "pos_a", "q": "qa"}), "pos_a", "left").join(norm.withColumnsRenamed({"pos": "pos_b", "q": "qb"}), "pos_b", "left").join(dot, ["pos_a", "pos_b"], "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    return d.select("pos_a", "pos_b", (z("qa") + z("qb") - 2 * z("dot")).cast("long").alias("sqdist"))


def _blocks(b: pa.RecordBatch, col: int) -> np.ndarray:
    """Vectors of one length as rows."""
    return b.column(col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)


def _block_pairs(queries: DataFrame, rows: DataFrame, block: int, row_block: int, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` over every pair of a block of ``queries`` and a block of ``rows`` (both id, vec, ...; a null vector is in none),
    one task a pair.  Blocks are dealt by the hash of the row and hold about ``block`` and ``row_block`` rows; queries are
    copied once a block of rows and rows once a block of queries, and nothing but the two counts reaches the driver."""
    q = queries.where("vec is not null").select(*[F.col(c).alias(c) for c in queries.columns])  # also where both are one frame
    r = rows.where("vec is not null")
    nq, nr = max(1, -(-queries.count() // block)), max(1, -(-rows.count() // row_block))  # reads no vector
    at = lambda n: F.pmod(F.xxhash64("id", "vec"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("qb", at(nq)).withColumn("rb", every(nr))
    r = r.withColumn("rb", at(nr)).withColumn("qb", every(nq))
    return q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb")).applyInArrow(run, schema)


def _matrix(t: pa.Table, column: str = "vec") -> np.ndarray:
    """The vectors of a block as rows."""
    v = t.column(column).combine_chunks()
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)


def kmeans(points: DataFrame, k: int, rounds: int = 10) -> DataFrame:
    """id, label of (id, vec): the first point, then the farthest from those chosen; exactly ``rounds`` assignments, ties to
    the first; an empty cluster keeps its centre.  Only k centres and k sums pass the driver."""
    pts = points.select(F.col("id").cast("long").alias("id"), "vec").cache()
    first = pts.orderBy("id").limit(1).collect()
    if not first:
        raise ValueError("no vectors")
    centres = [np.array(first[0].vec, np.float64)]

    def far(cs: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v = _blocks(b, 1)
                d = ((v[:, None, :] - cs[None]) ** 2).sum(-1).min(1)
                i = int(np.argmax(d))
                best = np.flatnonzero(d == d[i])
                i = int(best[np.argmin(b.column(0).to_numpy()[best])])
                yield pa.record_batch([pa.array([d[i]]), b.column(0).slice(i, 1), b.column(1).slice(i, 1)], names=["d", "id", "vec"])

        return run

    while len(centres) < k:
        row = pts.mapInArrow(far(np.array(centres)), "d double, id long, vec array<double>" if "double" in dict(pts.dtypes)["vec"] else "d double, id long, vec array<float>").orderBy(F.col("d").desc(), "id").first()
        centres.append(np.array(row.vec, np.float64))
    cs = np.array(centres)

    def assign(c: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lab = ((_blocks(b, 1)[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
                yield pa.record_batch([b.column(0), pa.array(lab.astype(np.int64))], names=["id", "label"])

        return run

    def sums(c: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros_like(c), np.zeros(len(c), np.int64)
            for b in batches:
                v = _blocks(b, 1)
                lab = ((v[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
                np.add.at(total, lab, v)
                n += np.bincount(lab, minlength=len(c))
            yield pa.record_batch([pa.array(np.arange(len(c))), pa.array(n), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["label", "n", "s"])

        return run

    for _ in range(rounds - 1):
        total, n = np.zeros_like(cs), np.zeros(len(cs))
        for r in pts.mapInArrow(sums(cs), "label long, n long, s array<double>").where("n > 0").toLocalIterator():
            total[r.label] += np.array(r.s)
            n[r.label] += r.n
        cs = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], cs)
    pts.unpersist()  # labels are read once, from the source
    return pts.mapInArrow(assign(cs), "id long, label long")


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _best(qi: np.ndarray, qv: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> pa.Table:
    """src, dst, score: for every query (qi, qv) the k rows of (ids, v) with the largest product, itself not counted."""
    src, dst, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    if len(qi) and len(ids):
        for lo in range(0, len(qi), 256):  # 32 MB of scores at a time
            for i, sim in zip(qi[lo : lo + 256], np.round(qv[lo : lo + 256] @ v.T, 6)):
                ok = np.flatnonzero(ids != i)
                if len(ok) > k:  # all that are as good as the k-th: ties are settled by id
                    ok = ok[sim[ok] >= np.partition(sim[ok], -k)[-k]]
                best = ok[np.lexsort((ids[ok], -sim[ok]))[:k]]
                src.append(np.full(len(best), i)), dst.append(ids[best]), score.append(sim[best])
    return pa.table({"src": np.concatenate(src), "dst": np.concatenate(dst), "score": np.concatenate(score)})


def knn(vectors: DataFrame, queries: DataFrame, k: int = 20, block: int = 16_384, row_block: int = 16_384) -> DataFrame:
    """src, dst, score, rank: for every query the k rows with the largest cosine, itself not counted, ties to the smaller
    id.  Exact.  Blocks of queries meet blocks of rows; each pair of blocks keeps k rows a query before they are shuffled
    again.  A null vector neither asks nor answers."""

    def run(q: pa.Table, r: pa.Table) -> pa.Table:
        unit = lambda t: _unit(_matrix(t)) if t.num_rows else np.zeros((0, 0))
        return _best(q.column("id").to_numpy(), unit(q), r.column("id").to_numpy(), unit(r), k)

    both = (d.select(F.col("id").cast("long").alias("id"), "vec") for d in (queries, vectors))
    out = _block_pairs(*both, block, row_block, run, "src long, dst long, score double")
    w = Window.partitionBy("src").orderBy(F.col("score").desc(), "dst")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def index_lists(vectors: DataFrame, lists: int = 64, sample: int = 20_000, seed: int = 42) -> np.ndarray:
    """Unit centres of an inverted-list index over (id, vec), fitted on the ``sample`` rows with the smallest hash of the id.
    No more centres than there are distinct vectors in the sample; none for an empty table."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    some = vectors.where("vec is not null").orderBy(F.xxhash64("id"), "id").limit(sample).select(array_to_vector(F.col("vec").cast("array<double>")).alias("features"))
    if some.isEmpty():
        return np.zeros((0, 0))
    centres = np.array(KMeans(k=max(2, lists), seed=seed, maxIter=10, distanceMeasure="cosine").fit(some).clusterCenters())
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def _nearest_lists(rows: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """id, unit, list: every row once for each of the ``probes`` lists whose centre is nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = _blocks(b, 1)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            best = np.argsort(-(v @ centres.T), axis=1, kind="stable")[:, :probes]
            at = np.repeat(np.arange(len(v)), best.shape[1])
            unit = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * v.shape[1]), pa.array(v[at].ravel()))
            yield pa.record_batch([b.column(0).take(pa.array(at)), unit, pa.array(best.ravel().astype(np.int64))], names=["id", "unit", "list"])

    return rows.where("vec is not null").select(F.col("id").cast("long").alias("id"), "vec").mapInArrow(run, "id long, unit array<double>, list long")


def indexed(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """id, unit, list: every row of (id, vec) in the list of its nearest centre; to be written by list and searched often.
    A null vector is in no list."""
    return _nearest_lists(vectors, centres, 1)


def search_index(index: DataFrame, queries: DataFrame, centres: np.ndarray, k: int = 20, probes: int = 16, block: int = 16_384, row_block: int = 16_384) -> DataFrame:
    """src, dst, score, rank like ``knn``, but only of the ``probes`` lists nearest to a query (all lists: exact); how many
    give the wanted recall depends on the vectors and has to be measured.  A list is dealt into blocks of about ``row_block``
    rows, its queries into blocks of ``block``; each pair of blocks is a task's matrix product, of which k rows a query are kept
    before anything is shuffled again.  The sizes of the lists pass the driver."""
    sizes = {r.list: r.n for r in index.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    nq = max(1, -(-queries.where("vec is not null").count() // block))  # reads no vector
    nr = F.element_at(F.create_map(*[F.lit(x) for at, n in sizes.items() for x in (at, max(1, -(-n // row_block)))]), F.col("list")) if sizes else F.lit(1)
    at = lambda n: F.pmod(F.xxhash64("id", "unit"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    q = _nearest_lists(queries, centres, probes).where(F.col("list").isin(list(sizes))).withColumn("qb", at(F.lit(nq))).withColumn("rb", every(nr))
    r = index.select("id", "unit", "list").withColumn("rb", at(nr)).withColumn("qb", every(F.lit(nq)))
    keys, tasks = ["list", "qb", "rb"], min(2 * nq * sum(-(-n // row_block) for n in sizes.values()) + 1, 4096)

    def run(q: pa.Table, r: pa.Table) -> pa.Table:
        unit = lambda t: _matrix(t, "unit") if t.num_rows else np.zeros((0, 0))
        return _best(q.column("id").to_numpy(), unit(q), r.column("id").to_numpy(), unit(r), k)

    near = q.repartition(tasks, *keys).groupBy(*keys).cogroup(r.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(run, "src long, dst long, score double")
    w = Window.partitionBy("src").orderBy(F.col("score").desc(), "dst")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _distance_sums(a: np.ndarray, a_from: np.ndarray, b: np.ndarray, b_from: np.ndarray, tile: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Sums of Euclidean distances from every row of ``a`` to each group of ``b`` and from every row of ``b`` to each group
    of ``a``; ``*_from`` are the rows where the groups start.  Each distance is computed once, as the product of rows that hold
    their squares, too; where that would cancel, from the differences."""
    x, y = a - b.mean(0), b - b.mean(0)
    aa, bb = (x * x).sum(1), (y * y).sum(1)
    left, right = np.hstack([x, aa[:, None], np.ones((len(a), 1))]), np.vstack([-2 * y.T, np.ones((1, len(b))), bb[None]])
    to_b, to_a = np.empty((len(a), len(b_from))), np.zeros((len(a_from), len(b)))
    for lo in range(0, len(a), tile):
        d = left[lo : lo + tile] @ right
        near = np.flatnonzero(d < 1e-4 * (aa[lo : lo + tile, None] + bb.max()))
        np.sqrt(np.maximum(d, 0, out=d), out=d)
        for k in range(0, len(near), 16_384):
            i, j = np.divmod(near[k : k + 16_384], len(b))
            d[i, j] = np.sqrt(((a[lo + i] - b[j]) ** 2).sum(1))
        to_b[lo : lo + tile] = np.add.reduceat(d, b_from, axis=1)
        first, last = np.searchsorted(a_from, [lo, lo + len(d) - 1], "right") - 1
        to_a[first : last + 1] += np.add.reduceat(d, np.maximum(a_from[first : last + 1] - lo, 0), axis=0)
    return to_b, to_a


def silhouette(points: DataFrame, block: int = 4096, row_block: int = 16_384) -> DataFrame:
    """id, label, silhouette of (id, vec, label): exact Euclidean; a cluster of one has 0.

    Blocks of points meet blocks of points, each two of them once and in one task; a pair of blocks adds up distances per point
    and label, both ways.  A block holds ``block`` rows or, where there are eight blocks of that size, up to
    ``row_block``; only ``block`` where over 1024 labels would make the sums of a pair large.
    """
    p = points.select(F.col("id").cast("long").alias("id"), "vec", F.col("label").cast("long").alias("label"))
    r = p.where("vec is not null")
    rows, labels = r.agg(F.count(F.lit(1)), F.count_distinct("label")).first()  # reads no vector
    n = max(1, -(-rows // (row_block if labels <= 1024 else block)), min(8, -(-rows // block)))

    def run(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        t = t.sort_by("label")
        sides = [t.filter(pc.equal(t.column("at"), x)) for x in ({i: 0, j: 0} if i != j else (i,))]
        ids, vecs = [x.column("id").to_numpy() for x in sides], [_matrix(x) for x in sides]
        groups = [np.unique(x.column("label").to_numpy(), return_index=True, return_counts=True) for x in sides]
        out = {"id": [np.empty(0, np.int64)], "other": [np.empty(0, np.int64)], "s": [np.empty(0)], "n": [np.empty(0, np.int64)]}
        if all(map(len, ids)):
            to_b, to_a = _distance_sums(vecs[0], groups[0][1], vecs[-1], groups[-1][1])
            for x, (labels, _, size), sums in ((ids[0], groups[-1], to_b), (ids[-1], groups[0], to_a.T))[: len(sides)]:
                for k, v in (("id", np.repeat(x, len(labels))), ("other", np.tile(labels, len(x))), ("s", sums.ravel()), ("n", np.tile(size, len(x)))):
                    out[k].append(v.astype(out[k][0].dtype))
        return pa.table({k: np.concatenate(v) for k, v in out.items()})

    at = F.pmod(F.xxhash64("id", "vec"), F.lit(n)).cast("int")
    r = r.withColumn("at", at).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select("id", "vec", "label", "at", F.least("at", "k").alias("i"), F.greatest("at", "k").alias("j"))
    # partitions by number: what is small to read is long to compute, so none are put together
    out = r.repartition(min(n * (n + 1), 4096), "i", "j").groupBy("i", "j").applyInArrow(run, "id long, other long, s double, n long")
    d = out.groupBy("id", "other").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).join(p.select("id", "label"), "id")
    own = F.col("other") == F.col("label")
    ab = d.groupBy("id", "label").agg(F.max(F.when(own & (F.col("n") > 1), F.col("s") / (F.col("n") - 1))).alias("a"), F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"))
    return ab.select("id", "label", F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0)).alias("silhouette"))


def choose_best_k(points: DataFrame, k_min: int = 2, k_max: int = 10) -> int:
    """The k with the best mean silhouette of ``kmeans``; ties to the smaller."""
    best, best_k = float("-inf"), k_min
    for k in range(k_min, k_max + 1):
        labelled = points.join(kmeans(points, k), "id")
        score = silhouette(labelled).agg(F.avg("silhouette")).first()[0]
        if score is not None and score > best:
            best, best_k = score, k
    return best_k


Embedder = Callable[[list[str]], np.ndarray]


def hashed_words(dim: int = 64) -> Embedder:
    """An embedder without a model: word counts hashed to ``dim`` signed places, unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        import xxhash

        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            h = np.fromiter((xxhash.xxh64_intdigest(w) for w in t.lower().split()), np.uint64)
            np.add.at(out[i], (h % np.uint64(dim)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0).astype(np.float32))
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return embed


def mean_pool(tokens: np.ndarray) -> np.ndarray:
    """The mean of token vectors; a single vector is its own mean."""
    return tokens if tokens.ndim == 1 else tokens.mean(axis=0)


def embedded(texts: DataFrame, make: Callable[[], Embedder], id_col: str = "id", text_col: str = "text", batch: int = 128) -> DataFrame:
    """id, embedding: ``make`` builds the embedder once a task (a model is loaded there, not on the driver), which gets
    ``batch`` texts at a time; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = make()
        for b in batches:
            for lo in range(0, b.num_rows, batch):
                v = np.asarray(embed(b.column(1).slice(lo, batch).to_pylist()), np.float32)
                yield pa.record_batch([b.column(0).slice(lo, batch), pa.array(list(v), pa.list_(pa.float32()))], names=["id", "embedding"])

    d = texts.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return d.mapInArrow(run, f"id {dict(d.dtypes)['id']}, embedding array<float>")


def ml_kmeans(points: DataFrame, k: int, seed: int = 42, rounds: int = 20) -> DataFrame:
    """id, label of (id, vec) by Spark ML's K-means with its parallel k-means++ start."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    d = points.select("id", array_to_vector(F.col("vec").cast("array<double>")).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=rounds, initMode="k-means||").fit(d)
    return model.transform(d).select("id", F.col("prediction").cast("long").alias("label"))


def cluster_terms(texts: DataFrame, top: int = 3) -> DataFrame:
    """label, nth, token, weight of (label, text): class-based tf-idf, tf * ln(1 + A / f) with f a token's count in all
    clusters and A the mean number of tokens a cluster; ties to the smaller token."""
    tf = texts.select("label", F.explode(T.tokens(F.lower(F.coalesce("text", F.lit(""))))).alias("token")).groupBy("label", "token").agg(F.count(F.lit(1)).alias("tf"))
    f = tf.groupBy("token").agg(F.sum("tf").alias("f"))
    mean = tf.agg((F.sum("tf") / F.count_distinct("label")).alias("a"))
    w = tf.join(f, "token").join(F.broadcast(mean)).select("label", "token", (F.col("tf") * F.log(1 + F.col("a") / F.col("f"))).alias("weight"))
    nth = F.row_number().over(Window.partitionBy("label").orderBy(F.col("weight").desc(), "token"))
    return w.withColumn("nth", nth).where(F.col("nth") <= top).select("label", F.col("nth").cast("long").alias("nth"), "token", "weight")


def inspected(members: DataFrame, n: int = 5) -> DataFrame:
    """label, size, previews of (label, pos, text): the first ``n`` texts of each cluster by position, cut for display."""
    d = members.select("label", "pos", T.preview(F.coalesce("text", F.lit(""))).alias("shown"))
    size = d.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    head = d.withColumn("nth", F.row_number().over(Window.partitionBy("label").orderBy("pos"))).where(F.col("nth") <= n)
    head = head.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("nth", "shown"))).alias("h"))
    return size.join(head, "label").select("label", "size", F.col("h.shown").alias("previews"))


def first_code_line(code: F.Column) -> F.Column:
    """What a snippet's preview shows: the first line of the stripped code; empty for a blank one."""
    return F.coalesce(F.get(F.split(T.strip(code), "\n"), 0), F.lit(""))
