"""Queries against their SQL where texts are empty, null or blank."""

import shutil

import duckdb
import numpy as np
import pytest

from gleanery.operators import chat, ranking, vectors
from gleanery.plans import queries as q
from gleanery.plans import roundtrips
from gleanery.sources import files

ODD = ["doc_catalog", "zones_written", "dataset_card", "card_written", "lake_chunks"]


@pytest.fixture(scope="module")
def odd(sf, tmp_path_factory):
    """The smallest data with empty, null, blank and single-spaced documents more, two of which end in a space."""
    at = tmp_path_factory.mktemp("odd") / "sf"
    shutil.copytree(sf, at)
    (at / "documents.parquet").chmod(0o644)
    texts = "CASE i % 4 WHEN 0 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN repeat('w ', 600 + i - 3) END"
    duckdb.sql(f"COPY (SELECT * FROM '{sf}/documents.parquet' UNION ALL SELECT 900000 + i, {texts}, 'en', 'odd', 0 FROM range(44) r(i)) TO '{at}/documents.parquet'")
    return str(at)


@pytest.mark.parametrize("name", ODD)
def test_odd_texts(spark, odd, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{odd}/documents.parquet'")
    got = q.queries()[name](spark, odd)
    cols = sorted(got.columns)
    want = con.sql("SELECT " + ", ".join(cols) + f" FROM ({q.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(want, key=str)


def test_deep_conversation_is_whole(spark):
    n = 10_050
    schema = "conv_id string, node_id string, parent_id string, create_time double, children array<string>, role string, recipient string, author_name string"
    nodes = spark.createDataFrame([("c", str(i), str(i - 1) if i else None, float(i), [str(i + 1)] if i < n - 1 else [], "user", None, None) for i in range(n)], schema)
    got = chat.ordered_turns(nodes).orderBy("seq").collect()
    assert [(r.node_id, r.depth, r.role) for r in got] == [(str(i), i, "user") for i in range(n)]


def test_distance_sums_both_ways():
    """Groups over tiles' borders, copies and near copies far from the origin."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(150, 5)) + 1000, rng.normal(size=(90, 5)) + 1000
    b[:40], b[40:50] = a[:40], a[40:50] + 1e-7
    a_from, b_from = np.array([0, 3, 64, 100]), np.array([0, 1, 60])
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    to_b, to_a = vectors._distance_sums(a, a_from, b, b_from)
    assert np.allclose(to_b, np.add.reduceat(d, b_from, axis=1), rtol=1e-12, atol=0) and np.allclose(to_a, np.add.reduceat(d, a_from, axis=0), rtol=1e-12, atol=0)


def test_silhouette_of_copies_is_exact(spark):
    """Copies of one point are 0 apart, in one block or in two, and each pair of blocks is dealt once."""
    rows = [(i, [1000.1, 0.3 + (i % 2 if i > 40 else 0)], i % 2) for i in range(60)]
    d = spark.createDataFrame(rows, "id long, vec array<double>, label long")
    v, lab = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    dist = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    for blocks in ((), (7, 11)):
        got = vectors.silhouette(d, *blocks)
        assert "FlatMapCoGroups" not in got._jdf.queryExecution().optimizedPlan().toString()
        for r in got.collect():
            a, b = dist[r.id, lab == r.label].sum() / ((lab == r.label).sum() - 1), dist[r.id, lab != r.label].mean()
            assert abs(r.silhouette - (b - a) / max(a, b)) < 1e-12


def test_index_search_in_blocks(spark):
    """Lists and queries in several blocks give what one block gives, and no pair of rows is a row of the plan."""
    rng = np.random.default_rng(2)
    d = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(300)] + [(999, None)], "id long, vec array<double>")
    centres = vectors.index_lists(d, 5, 200)
    index, q = vectors.indexed(d, centres), d.where("id % 3 = 0")
    found = [vectors.search_index(index, q, centres, 7, probes=len(centres), **b) for b in ({}, {"block": 30, "row_block": 20})]
    assert "Join" not in found[0]._jdf.queryExecution().optimizedPlan().toString()
    want = sorted(map(tuple, vectors.knn(d, q, 7).collect()))
    assert sorted(map(tuple, found[0].collect())) == sorted(map(tuple, found[1].collect())) == want and len(want) == 700


def test_exports_are_as_many_files_as_the_turns_ask_for(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    at = roundtrips._exports(spark, sf, turns.count() // 3)
    found = files.list_files(spark, at, ".json")
    assert 1 < len(found) <= 4 < turns.select("conv_id").distinct().count()
    assert files.conversation_nodes(spark, f"{at}/*").select("conv_id", "node_id").distinct().count() == turns.count()


def test_postings_without_a_shuffle_and_of_repeated_ids(spark):
    rows = [(1, "b a b", "x"), (2, "", None), (3, None, "É x-x"), (4, " ., ", "x")]
    shape = "doc_id long, text string, title string"
    want = [("a", 1, "text", 1), ("b", 1, "text", 2), ("x", 1, "title", 1), ("x", 3, "title", 2), ("x", 4, "title", 1), ("é", 3, "title", 1)]
    got = ranking.inverted_index(spark.createDataFrame(rows, shape), ("text", "title"))
    assert sorted(map(tuple, got.collect())) == want and "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()
    more = spark.createDataFrame([*rows, (1, "b c", None), (None, "n", None), (None, "n n", None)], shape)
    want = [w for w in want if w[0] != "b"] + [("b", 1, "text", 3), ("c", 1, "text", 1), ("n", None, "text", 3)]
    assert sorted(map(tuple, ranking.inverted_index(more, ("text", "title")).collect()), key=str) == sorted(want, key=str)
    assert ranking.inverted_index(spark.createDataFrame([], shape)).count() == 0
