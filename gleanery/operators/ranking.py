"""Retrieval ranking: BM25, fusion, reranking, diversification, context."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.functions.batches import parts


def rrf(rankings: DataFrame, k: int = 60, weights: dict[int, float] | None = None, n_lists: int | None = None) -> DataFrame:
    """doc, score from (list_id, doc, rank): sum of weight / (k + rank), weight 1 / lists unless given."""
    if weights:
        w = F.element_at(F.create_map(*[F.lit(x) for p in weights.items() for x in p]), F.col("list_id"))
    else:
        n = n_lists or rankings.select("list_id").distinct().count()
        w = F.lit(1.0 / max(1, n))
    return rankings.groupBy("doc").agg(F.sum(w / (F.col("rank") + F.lit(float(k)))).alias("score"))


def rrf_ranked(rankings: DataFrame, k: int = 60, weights: dict[int, float] | None = None, n_lists: int | None = None) -> DataFrame:
    """doc, score, place: ``rrf`` in order, ties by where a document first appears (list, then rank).  For fused pools: the
    places are numbered in one task."""
    first = rankings.groupBy("doc").agg(F.min(F.struct("list_id", "rank")).alias("first"))
    d = rrf(rankings, k, weights, n_lists).join(first, "doc")
    return d.select("doc", "score", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("score").desc(), "first")).cast("long").alias("place"))


def z_fusion(scores: DataFrame, n_lists: int) -> DataFrame:
    """doc, score from (list_id, doc, score): mean over the lists of the z-score; a document that a non-empty list lacks
    gets that list's lowest.  Missing ones are added as a correction of sums, not by documents x lists."""
    s = scores.groupBy("list_id").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("sd0"), F.min("score").alias("lo"))
    s = s.select("list_id", "m", F.when(F.col("sd0") != 0, F.col("sd0")).otherwise(1.0).alias("sd"), "lo").withColumn("floor", (F.col("lo") - F.col("m")) / F.col("sd"))
    total = s.agg(F.coalesce(F.sum("floor"), F.lit(0.0)).alias("all_floors"))
    z = scores.join(F.broadcast(s), "list_id").select("doc", ((F.col("score") - F.col("m")) / F.col("sd") - F.col("floor")).alias("over"))
    return z.groupBy("doc").agg(F.sum("over").alias("over")).join(F.broadcast(total)).select("doc", ((F.col("over") + F.col("all_floors")) / n_lists).alias("score"))


def _equals(term: str):
    return lambda t: t == F.lit(term)


def bm25(docs: DataFrame, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """doc_id, bm25 of the documents with at least one query term; only the query's terms leave the scan."""
    terms = sorted({q.lower() for q in query})
    toks = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    # split once; what is counted for each term are the few tokens that are some term
    def counts(rows: DataFrame) -> DataFrame:
        r = rows.select("doc_id", toks.alias("toks")).select("doc_id", F.size("toks").alias("len"), F.filter("toks", lambda t: t.isin(terms)).alias("hits"))
        return r.select("doc_id", "len", "hits", *[F.size(F.filter("hits", _equals(q))).alias(f"tf{i}") for i, q in enumerate(terms)])

    d = counts(docs)
    st = d.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("avgdl"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    idf = lambda i: F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
    part = lambda i: idf(i) * F.col(f"tf{i}") * (k1 + 1) / (F.col(f"tf{i}") + k1 * (1 - b + b * F.col("len") / F.col("avgdl")))
    score = sum((part(i) for i in range(1, len(terms))), part(0))
    # a text without the bytes of any term is not split a second time
    low = F.lower("text")
    some = counts(docs.where(reduce(or_, [F.contains(low, F.lit(q)) for q in terms]))).where(F.size("hits") > 0)
    return some.join(F.broadcast(st)).select("doc_id", score.alias("bm25"))


def mmr_no_similarity(cands: DataFrame, k: int = 10, lam: float = 0.7, cap: int = 2) -> DataFrame:
    """MMR with similarity 0 is a plain window: rank within a document up to ``cap``, score over -1, the first k."""
    order = [F.col("score").desc(), "pos"]
    d = cands.where(F.lit(lam) * F.col("score") > -1)
    d = d.withColumn("c", F.row_number().over(Window.partitionBy("query_id", "doc_uid").orderBy(*order))).where(F.col("c") <= cap)
    return d.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k).drop("c")


def mmr(cands: DataFrame, k: int = 10, lam: float = 0.7, cap: int = 2, sim: Callable[[pd.Series, pd.Series], float] | None = None) -> DataFrame:
    """query_id, chunk_id, rank by greedy maximal marginal relevance; candidates are (query_id, doc_uid, chunk_id, score,
    embedding, pos).  ``sim``: similarity of two candidates (rows), by default the cosine of their embeddings, where one
    without an embedding is similar to none.  A query's candidates are one group (a retrieved list)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "pos"], ascending=[False, True], kind="stable").reset_index(drop=True)
        if sim is None:
            none = np.zeros(next((len(x) for x in pdf.embedding if x is not None), 1))
            v = np.array([none if x is None else x for x in pdf.embedding], np.float64)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            to = lambda i: v @ v[i]
        else:
            to = lambda i: np.array([sim(row, pdf.loc[i]) for _, row in pdf.iterrows()])
        rel, near = pdf.score.to_numpy(), np.full(len(pdf), -np.inf)
        free, used, out = np.ones(len(pdf), bool), {}, []
        while len(out) < k and free.any():
            sc = np.where(free, lam * rel - (1 - lam) * (near if out else 0.0), -np.inf)
            i = int(np.argmax(sc))
            if sc[i] <= -1:
                break
            out.append(i)
            free[i] = False
            d = pdf.doc_uid[i]
            used[d] = used.get(d, 0) + 1
            if used[d] >= cap:
                free &= (pdf.doc_uid != d).to_numpy()
            near = np.maximum(near, to(i))
        got = pdf.loc[out, ["query_id", "chunk_id"]].copy()
        got["rank"] = range(1, len(out) + 1)
        return got

    kind = dict(cands.dtypes)
    return cands.groupBy("query_id").applyInPandas(run, f"query_id {kind['query_id']}, chunk_id {kind['chunk_id']}, rank long")


def context_envelope(docs: DataFrame, boundary: str = "-----8<-----") -> DataFrame:
    """One row with the prompt block of (rank, doc_uid, chunk_id, text); texts are not escaped.  For a bounded top-k."""
    one = F.concat(F.lit('<doc id="'), F.col("doc_uid"), F.lit('" chunk="'), F.col("chunk_id"), F.lit('" title="" source="" ts="">\n<pre>\n'), F.coalesce("text", F.lit("")), F.lit(f"\n</pre>\n</doc>\n{boundary}"))
    body = F.transform(F.sort_array(F.collect_list(F.struct("rank", one.alias("x")))), lambda s: s["x"])
    return docs.agg(F.array_join(F.concat(F.array(F.lit("[CONTEXT-BLOCK v1]")), body, F.array(F.lit("END OF CONTEXT-BLOCK"))), "\n").alias("context"))


def reranked(features: DataFrame) -> DataFrame:
    return features.withColumn("rerank", T.rerank_score(*[F.col(c) for c in ("cross", "dense_sim", "bm25", "authority", "length", "recency_days")]))


def inverted_index(docs: DataFrame, fields: tuple[str, ...] = ("text",)) -> DataFrame:
    """term, doc_id, field, tf: postings of the named fields.  A document's terms are counted in its row, so postings are not
    shuffled; only rows whose doc_id repeats are counted together, by a shuffle."""
    toks = lambda c: F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in parts(b):
                terms = p.column(1).flatten().dictionary_encode()
                of, n = len(terms.dictionary), np.asarray(pc.list_value_length(p.column(1)))
                cell, tf = np.unique(np.repeat(np.arange(len(n), dtype=np.int64), n) * of + terms.indices.to_numpy(), return_counts=True)
                at, term = np.divmod(cell, max(of, 1))
                yield pa.record_batch([terms.dictionary.take(pa.array(term)), p.column(0).take(pa.array(at)), pa.array(tf.astype(np.int64))], names=["term", "doc_id", "tf"])

    def postings(rows: DataFrame) -> DataFrame:
        kind = rows.schema["doc_id"].dataType.simpleString()
        each = [rows.select("doc_id", toks(c).alias("t")).mapInArrow(count, f"term string, doc_id {kind}, tf long").select("term", "doc_id", F.lit(c).alias("field"), "tf") for c in fields]
        return reduce(DataFrame.union, each)

    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return postings(docs)
    is_again = F.col("doc_id").eqNullSafe(F.col("_again"))
    some = postings(docs.join(again, is_again, "left_semi")).groupBy("term", "doc_id", "field").agg(F.sum("tf").alias("tf"))
    return postings(docs.join(again, is_again, "left_anti")).union(some)


# fixed values: what an answer in a mode must do (the other modes have no policy)
POLICIES = {
    "A": "POLICY: SYNTHESIZE\nRULES:\n- Integrate facts from multiple sources; prefer primary + recent.\n- Each non-obvious sentence ends with a citation.\n- Include version/date numbers explicitly.",
    "B": "POLICY: CONTRAST\nRULES:\n- List positions A vs B with evidence tables (source, date, authority).\n- Decide which is stronger and why (recency, primary source, consistency).\n- Cite every claim; if unresolved, state what would resolve it.",
    "C": "POLICY: REPORT_ONLY\nRULES:\n- Do not generalize beyond quoted evidence.\n- Output three sections: (1) What we found (verbatim, brief) (2) Limits (why insufficient) (3) Next search plan (terms/sources/windows).\n- Every bullet ends with a citation [D<ID>:C<chunk>].",
}


def policy(mode: F.Column, texts: dict[str, str] = POLICIES) -> F.Column:
    """The policy text of an answer mode; null if it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for p in texts.items() for x in p]), mode)


def hybrid_search(chunks: DataFrame, query: list[str], query_vector: list[float], pool: int = 100, k: int = 10, lam: float = 0.7, cap: int = 2) -> DataFrame:
    """rank, doc_uid, chunk_id, score, text: lexical and dense retrieval, fused, reranked, diversified.

    ``chunks`` is (doc_uid, chunk_id, text, embedding) and, if known, authority and recency_days.  A chunk without an
    embedding is found by its words only.  Both retrievers keep
    the ``pool`` best (a top-k per task before anything is shuffled), ranks are fused, the pool is scored by
    ``rerank_score`` with the fused score as the cross feature, and MMR picks k.  Only the pool carries texts.
    """
    have = set(chunks.columns)
    lex = bm25(chunks.select(F.col("chunk_id").alias("doc_id"), "text"), query).orderBy(F.col("bm25").desc(), "doc_id").limit(pool)
    q = [float(x) for x in query_vector]
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    v = F.col("embedding").cast("array<double>")
    qv = F.array(*[F.lit(x) for x in q])
    dot = F.aggregate(F.zip_with(v, qv, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    dense = chunks.where("embedding is not null").select(F.col("chunk_id").alias("doc_id"), (dot / F.greatest(norm(v) * norm(qv), F.lit(1e-12))).alias("dense_sim")).orderBy(F.col("dense_sim").desc(), "doc_id").limit(pool)
    ranked = lambda d, c, i: d.select(F.lit(i).alias("list_id"), F.col("doc_id").alias("doc"), F.row_number().over(Window.partitionBy(F.lit(i)).orderBy(F.col(c).desc(), "doc_id")).alias("rank"))  # noqa: E731  of a pool
    fused = rrf(ranked(lex, "bm25", 0).union(ranked(dense, "dense_sim", 1)), n_lists=2)
    rows = fused.join(lex, fused.doc == lex.doc_id, "left").drop("doc_id").join(dense.withColumnRenamed("doc_id", "_d"), F.col("doc") == F.col("_d"), "left")
    rows = chunks.join(F.broadcast(rows), F.col("chunk_id") == F.col("doc"))  # at most two pools
    zero = F.lit(None).cast("double")
    feature = lambda c: F.col(c).cast("double") if c in have else zero
    score = T.rerank_score(F.col("score"), F.col("dense_sim"), F.col("bm25"), feature("authority"), F.length("text") / 10_000.0, feature("recency_days"))
    rows = rows.select(F.lit("q").alias("query_id"), "doc_uid", "chunk_id", score.alias("score"), "embedding", "text", F.col("chunk_id").alias("pos"))
    best = mmr(rows.drop("text"), k, lam, cap)
    return best.join(rows, ["query_id", "chunk_id"]).select("rank", "doc_uid", "chunk_id", "score", "text")


def ranking_quality(runs: DataFrame, k: int = 10) -> DataFrame:
    """query_id, ndcg, mrr of (query_id, rank, gain) with every judged document of a query in it (null rank: not found)."""
    gain = F.pow(F.lit(2.0), F.col("gain")) - 1
    ideal = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("gain").desc()))
    d = runs.withColumn("best", ideal)
    at = lambda r: F.sum(F.when(F.col(r) <= k, gain / F.log2(F.col(r) + 1)))
    q = d.groupBy("query_id").agg(at("rank").alias("dcg"), at("best").alias("idcg"), F.min(F.when(F.col("gain") > 0, F.col("rank"))).alias("first"))
    return q.select("query_id", F.coalesce(F.col("dcg") / F.nullif(F.col("idcg"), F.lit(0.0)), F.lit(0.0)).alias("ndcg"), F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("mrr"))
