import itertools
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators import chat, graph, mining, minhash, ranking, vectors
from gleanery.sources import files


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_norm_text(spark):
    assert one(spark, "a\n\n\n\nb ", T.norm_text) == "a\n\nb"
    assert one(spark, "é", T.norm_text) == "é"
    assert one(spark, None, T.norm_text) is None


def test_token_count_and_urls(spark):
    assert one(spark, "", T.token_count) == 1
    assert one(spark, " a  b\tc ", T.token_count) == 3
    assert one(spark, "(see https://x.y/a)", T.urls) == ["https://x.y/a"]


def test_epoch_iso(spark):
    assert one(spark, 0.5, T.epoch_iso, "double") == "1970-01-01T00:00:00.500000+00:00"
    assert one(spark, 60.0, T.epoch_iso, "double") == "1970-01-01T00:01:00+00:00"


def packed(spark, texts, least=120, most=900):
    return [[tuple(c) for c in r.c] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", mining.packed(F.col("t"), least, most).alias("c")).orderBy("i").collect()]


def test_packer(spark):
    two = "a b"
    got = packed(spark, ["\n\n".join([two] * 3), "a b c d e", "", None, " \n\n\t"], 2, 3)
    assert [[c for _, _, c in g] for g in got] == [[two] * 3, ["a b c d e"], [], [], []]


def test_packer_offsets(spark):
    """A chunk is as long as its stripped text, whatever stands at its ends."""
    assert packed(spark, ["  alpha beta  \n\ngamma"], 1, 2) == [[(0, 10, "alpha beta"), (12, 17, "gamma")]]
    assert packed(spark, ["\n \n a b \n\n c d e f \n\n g"], 3, 4) == [[(2, 16, "a b \n\n c d e f"), (18, 19, "g")]]


def test_packer_keeps_every_token(spark):
    rnd = random.Random(1)
    texts = ["\n\n".join(" ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(1, 12))) for _ in range(100)]
    assert [" ".join(c for _, _, c in g).split() for g in packed(spark, texts, 5, 12)] == [t.split() for t in texts]


def test_windows_lose_no_text(spark):
    from gleanery.operators import lake

    text = " ".join(["x" * 30] * 1000)
    got = mining.token_windows(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("idx", "part").collect()
    assert max(len(r.text) for r in got) == 8000 and "".join(r.text for r in got if r.idx == 0) == " ".join(["x" * 30] * 800)
    chunks = lake.window_chunks(spark.createDataFrame([("n", text), ("m", "")], "norm_cid string, text string")).collect()
    assert all(text[r.span_start : r.span_end] == r.text and len(r.text) <= 8000 for r in chunks) and {i for r in chunks for i in range(r.span_start, r.span_end)} == set(range(len(text)))


def test_quality_gate_keeps_rows(spark):
    d = spark.createDataFrame([(1, "a\na"), (1, "b"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.dup_ratio) for r in mining.quality_gate(d).collect()) == [(0, 0.0), (1, 0.0), (1, 0.5)]


def test_extractors_and_find(spark):
    from gleanery.operators import lake

    d = spark.createDataFrame([("a/x", b"1"), ("a/y", b"2"), ("a/x", None), ("a/z", b"3")], "mime string, content binary")
    got = lake.extracted(d, {"a/x": lambda b: b.decode() * 2, "a/z": lambda b: 1 / 0}).collect()
    assert [r.text for r in got] == ["11", None, None, None]
    c = spark.createDataFrame([("id-1", "My Title"), ("TITLE", None), ("x", "y")], "conv_id string, title string")
    assert {r.conv_id for r in chat.find_conversations(c, "title").collect()} == {"id-1", "TITLE"}
    assert [tuple(r) for r in graph.repeated_keys(c, ["title"]).collect()] == []


def test_mmr_with_own_similarity(spark):
    rows = [("q", f"d{i}", i, 1.0 - i / 10, i) for i in range(4)]
    d = spark.createDataFrame(rows, "query_id string, doc_uid string, chunk_id int, score double, pos int")
    got = ranking.mmr(d, k=3, lam=0.5, sim=lambda a, b: float(a.chunk_id // 2 == b.chunk_id // 2)).orderBy("rank").collect()
    assert [r.chunk_id for r in got] == [0, 2, 1]


def test_zones(spark):
    d = spark.createDataFrame([(1, "you idiot 123-45-6789"), (2, "fine"), (3, ""), (4, None), (5, "éidiot")], "doc_id long, text string")
    got = {r.doc_id: (r.zone, r.risk_tags) for r in mining.catalog(d).collect()}
    assert got[1] == ("red_quarantine", ["toxicity", "pii"]) and got[2] == ("silver_normalized", []) and got[3] == got[4] == ("red_quarantine", ["non_text"]) and got[5][0] == "silver_normalized"


def test_lexicon_search_is_the_pattern(spark):
    """What the byte search lets through and what the pattern alone finds are the same, also where only folding helps."""
    texts = ["", None, "x-y", "123-45-6789", "STUPID", "\u017ftupid", "\u212aill", "\u0130diot", "\u0131diot", "killer", "how to  make a bomb", "How To Make A Bomb!", "préidiot", "hate_", "c2 server"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = {k: F.coalesce(F.col("t").rlike(rf"(?iu){T._EDGE_L}({p}){T._EDGE_R}"), F.lit(False)).cast("double") for k, p in T.LEXICON.items()}
    rows = d.select("t", *[v.alias(k) for k, v in T.safety_scores(F.col("t")).items()], *[v.alias(f"{k}_plain") for k, v in plain.items()]).collect()
    assert all(r[k] == r[f"{k}_plain"] for r in rows for k in T.LEXICON) and sum(r[k] for r in rows for k in T.LEXICON) >= 6


def test_rrf_and_z(spark):
    r = spark.createDataFrame([(0, "a", 1), (0, "b", 2), (1, "b", 1)], "list_id int, doc string, rank int")
    got = {x.doc: x.score for x in ranking.rrf(r).collect()}
    assert got["b"] == pytest.approx(0.5 / 62 + 0.5 / 61) and got["a"] == pytest.approx(0.5 / 61)
    z = spark.createDataFrame([(0, "a", 1.0), (0, "b", 3.0)], "list_id int, doc string, score double")
    assert {x.doc: x.score for x in ranking.z_fusion(z, 2).collect()} == {"a": -0.5, "b": 0.5}


def test_rerank_recency(spark):
    d = spark.createDataFrame([(0.0, None), (0.0, 0.0)], "cross double, recency double").select(T.rerank_score(F.col("cross"), *[F.lit(None).cast("double")] * 4, F.col("recency")).alias("s"))
    assert len({round(r.s, 12) for r in d.collect()}) == 1


def test_modes(spark):
    cases = [((0.7, 0.8, 2, 0.6, 0, False), "A"), ((0.7, 0.3, 2, 0.5, 0, False), "B"), ((0.7, 0.5, 2, 0.3, 0, False), "D"), ((0.2, 0.5, 0, 0.5, 0, False), "C"), ((0.0, 0.0, 0, 0.0, 0.0, True), "G")]
    d = spark.createDataFrame([tuple(map(float, c[:5])) + (c[5],) for c, _ in cases], "a double, b double, c double, d double, e double, f boolean")
    assert [r.m for r in d.select(T.answer_mode(*[F.col(x) for x in "abcdef"]).alias("m")).collect()] == [m for _, m in cases]


def test_mmr(spark):
    c = spark.createDataFrame([("q", "d1", i, s, [1.0, float(i)], i) for i, s in enumerate([3.0, 2.0, 1.5])] + [("q", "d2", 9, -2.0, [0.0, 1.0], 9)], "query_id string, doc_uid string, chunk_id long, score double, embedding array<double>, pos long")
    assert [r.chunk_id for r in ranking.mmr_no_similarity(c).orderBy("rank").collect()] == [0, 1]
    assert {r.chunk_id for r in ranking.mmr(c).collect()} == {0, 1}


def test_tree(spark):
    n = [("c", "r", None, None), ("c", "a", "r", 2.0), ("c", "b", "r", 1.0), ("c", "n", "r", None), ("c", "x", "b", 5.0), ("c", "lost", "gone", 1.0)]
    got = chat.tree_order(spark.createDataFrame(n, "conv_id string, node_id string, parent_id string, create_time double")).orderBy("seq").collect()
    assert [(r.node_id, r.depth) for r in got] == [("r", 0), ("b", 1), ("x", 2), ("a", 1), ("n", 1)]


def turns(spark, *t):
    return spark.createDataFrame([(1, i, r, x) for i, (r, x) in enumerate(t)], "conv_id long, turn long, role string, text string")


def test_segments(spark):
    got = chat.sft_segments(turns(spark, ("user", "u"), ("assistant", "a"), ("user", "u"), ("assistant", "a"))).orderBy("start_seq").collect()
    assert [(r.start_seq, r.end_seq) for r in got] == [(0, 3), (2, 3)]


def test_pairs(spark):
    a = chat.preference_pairs(turns(spark, ("user", "u"), ("assistant", "a1"), ("user", "No, wrong"), ("assistant", "a2"))).collect()
    assert [(r.signal, r.rejected, r.chosen) for r in a] == [("user_correction", "a1", "a2")]
    b = chat.preference_pairs(turns(spark, ("user", "u"), ("assistant", "a1"), ("user", "ok"), ("user", "no"), ("assistant", "a2"))).collect()
    assert b == []
    c = chat.preference_pairs(turns(spark, ("assistant", "Sorry …"), ("assistant", "a2"))).collect()
    assert [(r.signal, r.prompt_end) for r in c] == [("apology_followup", 0)]


def test_code_spans(spark):
    m = spark.createDataFrame([(0, "x\n```python\nprint(1)\n```"), (1, "plain"), (2, None)], "message_index long, text string")
    got = chat.code_spans(m, ["message_index"]).collect()
    assert [(r.message_index, r.start, r.end, r.code) for r in got] == [(0, 12, 21, "print(1)\n")]


def test_kmeans(spark):
    d = spark.createDataFrame([(i, [x]) for i, x in enumerate([0.0, 0.1, 10.0, 10.1])], "id long, vec array<double>")
    assert [r.label for r in vectors.kmeans(d, 2).orderBy("id").collect()] == [0, 0, 1, 1]
    assert vectors.choose_best_k(d, 2, 3) == 2


def near_pairs(docs, threshold=0.8):
    sets = [set(minhash.shingle_hashes(t, 5).tolist()) for t in docs]
    return {(i, j) for i, j in itertools.combinations(range(len(docs)), 2) if threshold <= len(sets[i] & sets[j]) / max(1, len(sets[i] | sets[j]))}


def components(n, pairs):
    label = list(range(n))
    for i, j in pairs:
        x, y = sorted((label[i], label[j]))
        label = [x if v == y else v for v in label]
    return label


def similar(spark, docs):
    """Components and links of the library for a list of texts."""
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    nodes = minhash.distinct_sets(minhash.signatures(d)).select("id", "n", "sig")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in minhash.similar_links(nodes, d, 0.8, 21, 6).collect()}
    return got, components(len(docs), got)


def edited(rnd, words, edits):
    w = list(words)
    for at in rnd.sample(range(len(w)), edits):
        w[at] = f"q{rnd.randrange(10**9)}"
    return w


def test_minhash_against_brute_force(spark):
    rnd = random.Random(3)
    base = [[rnd.choice("abcdefghij") + str(rnd.randint(0, 99)) for _ in range(120)] for _ in range(12)]
    docs = [" ".join(x) for t in base for x in (t, edited(rnd, t, 1), edited(rnd, t, 2), edited(rnd, t, 6))]
    want = near_pairs(docs)
    got, comp = similar(spark, docs)
    assert got <= want and comp == components(len(docs), want)
    d = spark.createDataFrame([*enumerate(docs), (None, docs[0]), (1, docs[1]), (100, None), (101, " ")], "doc_id long, text string")
    assert dict(minhash.near_dedupe_map(d, 0.8, 21, 6).collect()) == {**dict(enumerate(components(len(docs), want))), 100: 100, 101: 100}
    assert minhash.near_dedupe_map(d.limit(0), 0.8, 21, 6).count() == 0


def test_minhash_forests_brute_force():
    rng = np.random.default_rng(3)
    sk = rng.integers(0, 1 << 63, (4, 2), dtype=np.uint64)[rng.integers(0, 4, 60)]
    for i in range(60):
        for bit in rng.integers(0, 60, rng.integers(0, 12)):
            sk[i, bit % 2] ^= np.uint64(1) << np.uint64(bit)
    dist = np.bitwise_count(sk[:, None] ^ sk[None]).sum(axis=2, dtype=int)
    for t in (0, 5, 10, 20):
        assert components(60, minhash.sketch_forest(sk, t)) == components(60, [(i, j) for i in range(60) for j in range(i) if dist[i, j] <= t])
    sets = [np.unique(rng.integers(0, 14, 9).astype(np.uint64)) for _ in range(80)]
    jac = {(i, j): len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) for i, j in itertools.combinations(range(80), 2)}
    for t in (0.5, 0.8, 1.0):
        want = [p for p, x in jac.items() if x >= t]
        assert components(80, minhash.exact_forest(sets, t)) == components(80, want)
        label = components(80, [p for p in want if sum(p) % 3 == 0])
        top = max(set(label), key=label.count)
        ties = minhash.exact_ties(sets, label, [x != top for x in label], t)
        assert components(80, [*ties, *((i, j) for i, j in jac if label[i] == label[j])]) == components(80, [*want, *((i, j) for i, j in jac if label[i] == label[j])])


@pytest.mark.parametrize("block", [24, 2048])
def test_minhash_links_in_mixed_buckets(spark, monkeypatch, block):
    """Documents that share a long passage fall into common buckets; the pairs among them that are alike must be found."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rnd = random.Random(8)
    shared = [f"s{rnd.randrange(10**6)}" for _ in range(150)]
    docs = []
    for k in range(60):
        own = [f"w{k}x{i}" for i in range(50)]
        docs += [" ".join(shared + own), " ".join([*shared, *own[:40], *(f"v{k}x{i}" for i in range(4)), *own[44:]])]
    got, comp = similar(spark, docs)
    want = components(len(docs), near_pairs(docs))
    assert sum(x == y for x, y in zip(comp, want)) >= 119 and got <= near_pairs(docs)


@pytest.mark.parametrize("block", [30, 2048])
def test_minhash_dense_family(spark, monkeypatch, block):
    """Hundreds of edited copies of one text, alike to some of the others only: all that is within reach is joined, whether the
    group is looked at whole or in slices."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    docs = [" ".join(edited(rnd, base, 2 + k % 9)) for k in range(400)] + [" ".join(edited(rnd, base, 40)) for _ in range(5)]
    pairs = near_pairs(docs)
    want = components(len(docs), pairs)
    got, comp = similar(spark, docs)
    assert got <= pairs
    removed = lambda c: sum(x != i for i, x in enumerate(c))
    assert removed(want) > 250 and removed(comp) >= 0.99 * removed(want)


def test_minhash_common_bucket_is_joined_before_the_shuffle(spark):
    """A bucket with many members in a batch sends one row on."""
    rows = np.full((500, minhash.PERMS), 7, "<u4")
    rows[:, 6:] = np.random.default_rng(1).integers(0, 1 << 32, (500, minhash.PERMS - 6))
    batch = pa.record_batch([pa.array(range(500), pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "sig"])
    out = pa.Table.from_batches(minhash._deal(21, 6)([batch])).to_pandas()
    assert len(out[out.band == 0]) == 1 and bool(out[out.band == 0].many.all()) and sorted(out[out.band == -1].id) == list(range(1, 500)) and len(out[out.band == 1]) == 500
    joined = list(minhash._join_buckets(27)(pa.Table.from_pandas(out.sort_values(["band", "key", "id"]), schema=minhash._KEYED).to_batches()))
    assert {(x, y) for t in joined for x, y in zip(t.column(0).to_pylist(), t.column(1).to_pylist())} >= {(0, i) for i in range(1, 500)}


def test_pagerank_sums_to_one(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 3)], "src long, dst long")
    r = graph.personalised_pagerank(e, spark.createDataFrame([(1,)], "node long"), 5).agg(F.sum("rank")).first()[0]
    assert r == pytest.approx(1.0)


def test_upsert(spark):
    a, b = (spark.createDataFrame(x, "id long, v long, t long") for x in ([(1, 1, 1), (2, 1, 1)], [(1, 2, 2)]))
    assert {(r.id, r.v) for r in graph.upsert(a, b, ["id"], "t").collect()} == {(1, 2), (2, 1)}
    a, b = (spark.createDataFrame(x, "id long, v long, t long") for x in ([(1, 0, 1), (2, 9, None), (2, 8, None)], [(1, 7, 1), (1, 5, 1)]))  # ties
    assert {(r.id, r.v) for r in graph.upsert(a, b, ["id"], "t").collect()} == {(1, 5), (2, 8)}


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("Hello.\n\n\n\nWorld")
    (tmp_path / "in/b.html").write_bytes("<p>caf\xe9</p><script>x</script>".encode("latin-1"))
    scan = files.scan(spark, str(tmp_path / "in"))
    got = {r.path.rsplit("/", 1)[1]: (r.mime, r.text) for r in files.decoded(scan).collect()}
    assert got == {"a.txt": ("text/plain", "Hello.\n\nWorld"), "b.html": ("text/html", "café")}
    for _ in range(2):
        files.store_blobs(scan, str(tmp_path / "blobs"))
    assert spark.read.parquet(str(tmp_path / "blobs")).count() == 2


def test_chat_sources(spark, tmp_path):
    p = tmp_path / "p.jsonl"
    p.write_text('{"user": "u", "assistant": "a"}\nbad\n{"user": "x"}\n')
    assert [r.text for r in files.chat_pairs(spark, str(p)).collect()] == ["User: u\nAssistant: a"]
    with pytest.raises(Exception):
        files.chat_pairs(spark, str(p), strict=True).collect()
    m = tmp_path / "m.json"
    m.write_text(json.dumps({"messages": [{"content": "a"}, {"content": "b"}]}))
    assert [r.content for r in files.messages(spark, str(m)).orderBy("message_index").collect()] == ["a", "b"]
    c = tmp_path / "c.json"
    node = lambda i, up, t: {"id": i, "parent": up, "message": {"author": {"role": "user"}, "create_time": t, "content": {"content_type": "text", "parts": ["hi " + i, {"text": "x"}]}}, "children": ["k"] if i == "r" else []}
    c.write_text(json.dumps([{"conversation_id": "c1", "title": None, "mapping": {"r": node("r", None, 1.0), "k": node("k", "r", 2.0)}}]))
    n = files.conversation_nodes(spark, str(c))
    assert {(r.node_id, r.text) for r in n.collect()} == {("r", "hi r\nx"), ("k", "hi k\nx")}
    assert [r.node_id for r in chat.tree_order(n).orderBy("seq").collect()] == ["r", "k"]


def test_newest_version_and_manifest(spark):
    d = spark.createDataFrame([("Tools-9.10",), ("Tools-9.9",), ("Tools-10.1",)], "label string")
    assert files.newest_version(d).first().label == "Tools-10.1"
    r = files.repo_manifest(spark.createDataFrame([("/a/b/.git/config",), ("/a/b/.git/HEAD",), ("/x",)], "path string")).collect()
    assert len(r) == 1 and r[0].source == "/a/b" and r[0].dest.startswith("b_")


def test_knn_is_exact(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(60, 8))
    d = spark.createDataFrame([(i, v[i].tolist()) for i in range(60)], "id long, vec array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = {(r.src, r["rank"]): r.dst for r in vectors.knn(d, d.where("id < 3"), 4, block=2, row_block=9).collect()}
    for q in range(3):
        order = [i for i in np.argsort(-(u @ u[q])) if i != q][:4]
        assert [got[q, k + 1] for k in range(4)] == order


def test_stream(spark, tmp_path):
    from gleanery.streaming.routing import zone_stream

    spark.createDataFrame([(1, "nsfw"), (2, "ok")], "doc_id long, text string").write.parquet(str(tmp_path / "s"))
    q = zone_stream(spark.readStream.schema("doc_id long, text string").parquet(str(tmp_path / "s"))).writeStream.format("memory").queryName("zones").start()
    q.processAllAvailable(), q.stop()
    assert spark.sql("select count(*) from zones where quarantine").first()[0] == 1


def message(node, up, kids, role, content, t=None, **more):
    return {"id": node, "parent": up, "children": kids, "message": {"author": {"role": role, "name": more.pop("name", None)}, "create_time": t, "content": content, **more}}


def test_export_content(spark, tmp_path):
    """Parts of every kind, assets, links behind escapes, a child that no node describes, ids that are missing."""
    parts = [r"see https:\/\/x.y\/a".replace("\\/", "/"), {"content_type": "image_asset_pointer", "size_bytes": 5, "asset_pointer": "s://1"}, {"content_type": "t", "text": None}, {"text": {"k": 1}}, {"text": "end "}]
    av = {"content_type": "real_time_user_audio_video_asset_pointer", "audio_asset_pointer": {"asset_pointer": "s://2", "format": "wav"}}
    mapping = {
        "r": {"id": "r", "parent": None, "children": ["b", "a", "gone"], "message": None},
        "a": message("a", "r", [], "user", {"content_type": "multimodal_text", "parts": parts}, 0.0, metadata={"deep": [{"u": 'q "https://z.w/b" (https://z.w/c)'}]}),
        "b": message("b", "r", ["c"], "assistant", {"content_type": "code", "parts": ["run()"]}, 2.5, recipient="web", end_turn=False),
        "c": message("c", "b", [], "tool", {"content_type": "tool_result", "parts": [av]}, None, name="web"),
    }
    (tmp_path / "a.json").write_text(json.dumps({"title": "T", "mapping": mapping}))
    (tmp_path / "b.json").write_text("not json")
    (tmp_path / "c.json").write_text(json.dumps([{"mapping": {"x": message("x", None, [], "user", {"content_type": "other", "parts": ["no"]}, 1.5)}}]))
    turns = chat.ordered_turns(files.conversation_nodes(spark, str(tmp_path))).orderBy("conv_id", "seq").collect()
    t = {r.node_id: r for r in turns}
    assert [r.node_id for r in turns if r.conv_id == "T"] == ["r", "a", "b", "c", "gone"] and t["gone"].depth == 1 and t["gone"].role is None
    assert t["a"].text == 'see https://x.y/a\nNone\n{"k":1}\nend' and t["a"].part_types == ["str", "image_asset_pointer", "t", "dict", "dict"]
    assert t["a"].urls == ["https://x.y/a", "https://z.w/b", "https://z.w/c"]
    assert [tuple(x) for x in t["a"].assets] == [("image_asset_pointer", None, 5, "s://1")]
    assert [(x.content_type, x.asset_pointer) for x in t["c"].assets] == [("real_time_user_audio_video_asset_pointer", None), ("audio_asset_pointer", "s://2")]
    assert (t["b"].tool_call, t["b"].tool_name, t["b"].end_turn, t["b"].create_time_iso) == (True, "web", False, "1970-01-01T00:00:02.500000+00:00")
    assert (t["c"].tool_result, t["c"].tool_name) == (True, "web") and t["x"].text == "" and len(t["x"].conv_id) == 64


def test_training_sets(spark, tmp_path):
    from gleanery.plans.mine import training_sets

    say = lambda x: {"content_type": "text", "parts": [x]}
    chain = [("user", say("q"), {}), ("assistant", say("a1"), {}), ("user", say("No, wrong"), {}), ("assistant", {"content_type": "code", "parts": ["f()"]}, {"recipient": "web"}), ("tool", {"content_type": "tool_result", "parts": ["42 https://x.y"]}, {"name": "web"}), ("assistant", say("a2"), {}), ("critic", say("hm"), {})]
    ids = [f"n{i}" for i in range(len(chain))]
    mapping = {n: message(n, ids[i - 1] if i else None, ids[i + 1 : i + 2], r, c, float(i), **more) for i, (n, (r, c, more)) in enumerate(zip(ids, chain))}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.json").write_text(json.dumps([{"conversation_id": "c", "mapping": mapping}]))
    assert training_sets(spark, str(tmp_path / "in"), str(tmp_path / "out")) == {"sft": 2, "dpo_pairs": 1, "tool_traces": 2}
    lines = lambda name: [json.loads(x) for f in sorted((tmp_path / "out" / name).glob("part-*")) for x in f.read_text().splitlines()]
    sft = sorted(lines("sft"), key=lambda r: r["meta"]["start_seq"])
    assert sft[0]["meta"] == {"conv_id": "c", "start_seq": 0, "end_seq": 5, "has_tools": True}
    assert sft[0]["messages"][3] == {"role": "assistant", "tool_call": {"name": "web", "arguments": {"content_type": "code", "parts": ["f()"]}}}
    assert sft[0]["messages"][4] == {"role": "tool", "name": "web", "content": {"content_type": "tool_result", "parts": ["42 https://x.y"]}}
    assert [m["role"] for m in sft[1]["messages"]] == ["user", "assistant", "tool", "assistant"] and sft[1]["meta"]["end_seq"] == 6
    (pair,) = lines("dpo_pairs")
    assert (pair["rejected"], pair["chosen"], pair["signals"], pair["meta"]) == ("a1", "f()", {"user_correction": True}, {"rejected_seq": 1, "chosen_seq": 3, "conv_id": "c"})
    assert [m["content"] for m in pair["prompt_messages"]] == ["q", "a1", "No, wrong"]
    tools = sorted(lines("tool_traces"), key=lambda r: r["seq"])
    assert [(x["direction"], x["tool_name"], x["urls"]) for x in tools] == [("call", "web", []), ("result", "web", ["https://x.y"])]


def test_mine_dataset(spark, tmp_path):
    from gleanery.plans.mine import mine_dataset

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("A clean paragraph.\n\nAnother one.")
    (tmp_path / "in/b.txt").write_text("explicit nsfw words")
    (tmp_path / "in/c.txt").write_text("A clean paragraph.\n\nAnother one.")
    (tmp_path / "in/d.txt").write_text("")
    assert mine_dataset(spark, str(tmp_path / "in"), str(tmp_path / "out"), "ds", "2027-01-01") == {"quarantine_docs": 2, "clean_docs": 2}
    docs = {r.source_path.rsplit("/", 1)[1]: r for r in spark.read.parquet(str(tmp_path / "out/catalog/docs.parquet")).collect()}
    assert docs["a.txt"].doc_uid == docs["c.txt"].doc_uid and (docs["a.txt"].quarantine, docs["a.txt"].chunk_count) == (False, 1)
    assert docs["b.txt"].risk_tags == ["nsfw"] and docs["d.txt"].risk_tags == ["non_text"] and docs["d.txt"].chunk_count == 0
    chunks = spark.read.parquet(str(tmp_path / "out/catalog/chunks.parquet"))
    assert chunks.count() == 3 and chunks.select("chunk_id").distinct().count() == 2
    assert spark.read.parquet(str(tmp_path / "out/bronze_raw")).count() == 3
    assert spark.read.parquet(str(tmp_path / "out/red_quarantine/docs")).count() == 2 and spark.read.parquet(str(tmp_path / "out/silver_normalized/chunks")).count() == 2
    card = json.loads("".join(f.read_text() for f in (tmp_path / "out/catalog/ds.card").glob("part-*")))
    assert card["nsfw"] == "present" and card["pii"] == "unknown" and card["clean_docs"] == 2
    (tmp_path / "none").mkdir()
    assert mine_dataset(spark, str(tmp_path / "none"), str(tmp_path / "out2"), "ds", "2027-01-01") == {"quarantine_docs": 0, "clean_docs": 0}
    assert spark.read.parquet(str(tmp_path / "out2/catalog/chunks.parquet")).count() == 0


def test_lake_chain(spark):
    """The stages' ids repeat, every chunk can be traced, canonical chunks are unique, spans map back."""
    from gleanery.operators import lake

    f = spark.createDataFrame([("p1", "text/plain", 9, "h1"), ("p2", "text/plain", 9, "h1"), ("p3", "text/plain", 5, "h3")], "path string, mime string, bytes long, checksum string")
    src = lake.sources(f, 1_700_000_000_000, "CC0").union(lake.sources(f.where("path = 'p3'").withColumn("path", F.lit("p4")), 1_700_000_000_001, "MIT"))
    ext = lake.extractions(spark.createDataFrame([("h1", "ﬁne  text\u00a0here " * 900), ("h3", "a b"), ("h4", None)], "blob_cid string, text string"))
    norm = lake.normalized(ext).cache()
    chunks = lake.window_chunks(norm).cache()
    assert lake.blobs(src, "s").count() == 2 and src.select("source_id").distinct().count() == 4
    assert norm.orderBy(F.length("text")).first().text == "a b" and norm.where("text like 'fine text here fine%'").count() == 1
    assert {r.norm_hash for r in norm.collect()} == {r.norm_hash for r in lake.normalized(ext).collect()}
    assert chunks.join(norm.select("norm_cid", F.col("text").alias("whole")), "norm_cid").where("substring(whole, cast(span_start as int) + 1, cast(span_end - span_start as int)) <> text").count() == 0
    assert lake.orphans(chunks, norm, "norm_cid").count() == 0 and lake.orphans(norm, ext.limit(0), "ext_cid").count() == 2
    mapping = lake.dedupe_map(chunks)
    assert lake.canonical(chunks, mapping).select("canonical_chunk_id").distinct().count() == mapping.count() == chunks.select("text").distinct().count()
    assert {tuple(r.licenses) for r in lake.with_license(chunks, norm, ext, src).collect()} == {("CC0",), ("CC0", "MIT")}


def test_fragments_rebuild_files(spark):
    import hashlib

    from gleanery.operators import lake

    rng = np.random.default_rng(1)
    a = rng.bytes(300_000)
    b = a[:100_000] + b"inserted" + a[100_000:]
    d = spark.createDataFrame([(hashlib.sha256(x).hexdigest(), bytearray(x)) for x in (a, b, b"")], "checksum string, content binary")
    rows = lake.fragments(d, 16).orderBy("checksum", "idx").collect()
    for x in (a, b):
        mine = [r for r in rows if r.checksum == hashlib.sha256(x).hexdigest()]
        assert b"".join(bytes(r.content) for r in mine) == x and all(len(r.content) <= 64 * 1024 for r in mine)
    assert len({r.frag_cid for r in rows}) < len(rows) - 5  # most fragments are shared


def test_entity_mentions_brute_force(spark):
    from gleanery.operators import entities

    g = spark.createDataFrame([(1, "New York"), (2, "York"), (3, None), (4, "")], "entity_id int, name string")
    c = spark.createDataFrame([(7, "In new  york, york."), (8, None), (9, "")], "chunk_id long, text string")
    got = {(r.chunk_id, r.entity_id, r.offset_start, r.offset_end) for r in entities.mentions(c, g).collect()}
    assert got == {(7, 1, 3, 12), (7, 2, 8, 12), (7, 2, 14, 18)}


def test_simhash_brute_force(spark):
    from gleanery.operators import simhash

    docs = ["one two three four five six", "one two three four five seven", "", None, "x"]
    got = {r.doc_id: r.simhash64 for r in simhash.simhash64(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()}
    assert got[2] == got[3] == 0 and got[0] != got[4]
    for i, t in enumerate(docs[:2]):
        h = [int(x) for x in minhash.shingle_hashes(t, 3)]
        m = (1 << 64) - 1
        h = [(x ^ x >> 32) * 0xD6E8FEB86659FD93 & m for x in h]
        h = [x ^ x >> 32 for x in h]
        assert got[i] & m == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_catalog_and_config(spark, tmp_path):
    from gleanery.config import load_config
    from gleanery.operators import literature

    (tmp_path / "c.yaml").write_text("foo: 1\nitems:\n- {id: a, title: 'x|y', year: 2000, type: paper, tags: [dense, fusion], url: 'https://u'}\n")
    assert load_config(str(tmp_path / "c.yaml"))["foo"] == load_config(str(tmp_path / "c.yaml"), spark)["foo"] == 1
    c = literature.load_items(spark, str(tmp_path / "c.yaml"))
    assert literature.problems(c).count() == 0
    lines = [r.section for r in literature.report(c).orderBy("grp").collect()]
    assert len(lines) == len(literature.GROUPS) and "| a | x\\|y | 2000 | paper | [link](https://u) |\n" in lines[0] and lines[1].endswith("_(no entries yet)_\n")


def test_repositories(spark, tmp_path):
    for name, url in (("one", "git@host:team/one.git"), ("two", "https://else/two")):
        (tmp_path / name / ".git").mkdir(parents=True)
        (tmp_path / name / ".git/config").write_text(f'[core]\n\tbare = false\n[remote "origin"]\n\turl = {url}\n')
    got = files.repositories(spark, str(tmp_path), "team/").collect()
    assert [(r.source, r.origin) for r in got] == [(str(tmp_path / "one"), "git@host:team/one.git")] and got[0].dest.startswith("one_")
    assert files.repositories(spark, str(tmp_path)).count() == 2
    v = files.version_labels(spark.createDataFrame([("* Label: Tools for X-15.3",), ("no version",)], "value string")).collect()
    assert [(r.label, r.version) for r in v] == [("Tools for X-15.3", [15, 3])]


def test_run_log_and_placeholders(spark, tmp_path):
    d, seen = files.counted(spark.range(5), "n")
    d.write.format("noop").mode("overwrite").save()
    files.log_run(spark, str(tmp_path / "runs"), "r1", "normalize", {"recipe_v": "v1"}, {"outputs": seen.get["rows"]})
    files.log_run(spark, str(tmp_path / "runs"), "r2", "chunk", {})
    assert {(r.run_id, r.status) for r in spark.read.json(str(tmp_path / "runs")).collect()} == {("r1", "ok"), ("r2", "ok")}
    for _ in range(2):
        files.write_placeholder(spark, str(tmp_path / "p"), "a string, b long")
    assert spark.read.parquet(str(tmp_path / "p")).columns == ["a", "b"]


def test_messages_are_numbered_in_order(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("".join(json.dumps({"content": f"c{i}"}) + "\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert [r.content for r in files.messages(spark, str(tmp_path / "m.jsonl")).orderBy("message_index").collect()] == [f"c{i}" for i in range(2000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_hybrid_search(spark):
    rows = [(f"d{i % 3}", i, ("apple " if i in (2, 5) else "") + "other words", [1.0, 0.0] if i in (2, 7) else [0.0, 1.0]) for i in range(12)]
    c = spark.createDataFrame(rows, "doc_uid string, chunk_id long, text string, embedding array<double>")
    got = ranking.hybrid_search(c, ["apple"], [1.0, 0.0], pool=5, k=3).orderBy("rank").collect()
    assert got[0].chunk_id == 2 and len(got) == 3
    assert ranking.hybrid_search(c.limit(0), ["apple"], [1.0, 0.0]).count() == 0


def test_hybrid_search_finds_documents_without_a_vector(spark, sf):
    from gleanery.plans import queries

    rows = [(f"d{i}", i, ("apple " if i == 5 else "") + "other words", [1.0, 0.0] if i < 4 else None) for i in range(12)]
    c = spark.createDataFrame(rows, "doc_uid string, chunk_id long, text string, embedding array<double>")
    got = {r.chunk_id for r in ranking.hybrid_search(c, ["apple"], [1.0, 0.0], pool=20, k=12).collect()}
    assert got == {0, 1, 2, 3, 5}
    seen = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ranking, "hybrid_search", lambda chunks, *a: seen.append(chunks))
        queries.hybrid_search(spark, sf)
    assert seen[0].count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_ml_kmeans_and_embedder(spark):
    d = spark.createDataFrame([(i, [x, 0.0]) for i, x in enumerate([0.0, 0.1, 10.0, 10.1])], "id long, vec array<double>")
    lab = [r.label for r in vectors.ml_kmeans(d, 2).orderBy("id").collect()]
    assert lab[0] == lab[1] != lab[2] == lab[3]
    e = vectors.embedded(spark.createDataFrame([(1, "a b"), (2, "b a"), (3, None)], "id long, text string"), vectors.hashed_words).orderBy("id").collect()
    assert e[0].embedding == e[1].embedding and len(e[2].embedding) == 64 and vectors.mean_pool(np.array([[1.0, 2.0], [3.0, 4.0]])).tolist() == [2.0, 3.0]
    assert one(spark, "\n  x = 1\ny", vectors.first_code_line) == "x = 1" and one(spark, " \n", vectors.first_code_line) == ""


def test_cluster_texts(spark):
    """Two about cats, two about computers; equal snippets share a label."""
    pets = ["cats purr and sleep", "cats sleep and purr a lot", "computers compute with chips", "computers use chips to compute"]
    lab = [r.label for r in vectors.cluster_texts(spark.createDataFrame(list(enumerate(pets)), "pos long, text string"), 2).orderBy("id").collect()]
    assert lab[0] == lab[1] != lab[2] == lab[3]
    code = ["print(1)\nprint(2)", "print(1)\nprint(2)", "console.log('x')", None]
    lab = [r.label for r in vectors.cluster_texts(spark.createDataFrame(list(enumerate(code)), "pos long, text string"), 2).orderBy("id").collect()]
    assert lab[0] == lab[1] != lab[2]


def test_own_scorer_and_fused_order(spark):
    d = spark.createDataFrame([(1, "x"), (2, "xx"), (3, None)], "doc_id long, text string")
    got = mining.route_with(d, lambda t: {"nsfw": F.coalesce(F.length(t) / 2.0, F.lit(0.0)), "illicit": F.lit(0.4)}, {"nsfw": 1.0, "illicit": 0.35})
    assert [(r.zone, r.reasons) for r in got.orderBy("doc_id").collect()] == [("red_quarantine", ["illicit"]), ("red_quarantine", ["illicit", "nsfw"]), ("red_quarantine", ["illicit"])]
    assert {r.zone for r in mining.route_with(d, lambda t: {}, {}).collect()} == {"silver_normalized"}
    r = spark.createDataFrame([(0, "b", 1), (0, "a", 2), (1, "a", 1), (1, "b", 2), (1, "c", 3)], "list_id int, doc string, rank int")
    assert [x.doc for x in ranking.rrf_ranked(r).orderBy("place").collect()] == ["b", "a", "c"]


def test_epoch_times_do_not_depend_on_the_sessions_time_zone(spark):
    from datetime import datetime, timezone

    from gleanery.functions import text as T

    seconds = [0.0, -1.5, 1_604_210_400.0, 1_604_206_800.25, 1_583_649_000.123456, 1_699_999_999.999, None]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(seconds)], "i int, s double")
    was = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # these hours are in its changes of clocks
        got = {r.i: (r.a, r.b) for r in d.select("i", T.epoch_iso(F.col("s")).alias("a"), T.epoch_ms_iso(F.col("s")).alias("b")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    for i, x in enumerate(seconds):
        if x is None:
            assert got[i] == (None, "—")
        else:
            assert got[i][0] == datetime.fromtimestamp(x, timezone.utc).isoformat()
    assert got[1][1] == "1969-12-31T23:59:58.500Z" and got[5][1] == "2023-11-14T22:13:19.999Z"


def test_fragments_of_short_and_empty_files(spark):
    from gleanery.operators import lake

    d = spark.createDataFrame([("a", b"x"), ("b", b"y" * 31), ("c", b"z" * 5000), ("d", b""), ("e", None)], "checksum string, content binary")
    got = {}
    for r in sorted(lake.fragments(d, 1).collect(), key=lambda r: (r.checksum, r.idx)):
        got[r.checksum] = got.get(r.checksum, b"") + bytes(r.content)
    assert got == {"a": b"x", "b": b"y" * 31, "c": b"z" * 5000}


def test_index_search_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in base[i % 12] + 0.6 * rng.normal(size=16)]) for i in range(1500)]
    d = spark.createDataFrame(rows + [(9999, None)], "id long, vec array<double>")
    centres = vectors.index_lists(d, 12, 500)
    index, q = vectors.indexed(d, centres), d.where("id % 100 = 0")
    pairs = lambda df: {(r.src, r.dst) for r in df.collect()}
    want = pairs(vectors.knn(d.where("vec is not null"), q, 10))
    got = pairs(vectors.search_index(index, q, centres, 10, probes=4))
    assert index.count() == 1500 and len(got & want) >= 0.9 * len(want)
    assert pairs(vectors.search_index(index, q, centres, 10, probes=len(centres))) == want


def test_index_of_an_empty_table(spark):
    d = spark.createDataFrame([], "id long, vec array<double>")
    centres = vectors.index_lists(d)
    assert vectors.search_index(vectors.indexed(d, centres), d, centres).count() == 0


def test_registered_index_search_has_the_recall_it_states(spark, sf):
    from gleanery.plans import queries

    got, want = ({(r.src, r.dst) for r in queries.queries()[name](spark, sf).collect()} for name in ("index_search", "knn_edges"))
    assert len(got & want) >= 0.9 * len(want)


def test_scan_of_hidden_and_empty_files(spark, tmp_path):
    for name in (".env", ".git/config", "_notes/a b#1.txt", "sub/_x.txt", "k=1/_y=2.txt", "empty.txt", ".none", "plain.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name in ("empty.txt", ".none") else name.encode())
    names = lambda d: {r.path.split(tmp_path.name + "/", 1)[1]: bytes(r.content) for r in d.collect()}
    got = names(files.scan(spark, str(tmp_path), every=True))
    want = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    assert {k.replace("%20", " ").replace("%23", "#"): v for k, v in got.items()} == want and len(got) == 8
    assert files.scan(spark, str(tmp_path), every=True).count() == 8  # none of them twice
    assert set(names(files.scan(spark, str(tmp_path), include="*.txt", exclude="/_notes/", every=True))) == {"sub/_x.txt", "k=1/_y=2.txt", "empty.txt", "plain.txt"}


def test_silhouette_in_blocks_and_null_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist(), i % 3) for i in range(50)]
    schema = "id long, vec array<double>, label long"
    whole, cut = ({r.id: r.silhouette for r in vectors.silhouette(spark.createDataFrame(x, schema), *b).collect()} for x, b in ((rows, ()), (rows + [(99, None, 1)], (7, 11))))
    v, lab = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    dist = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    for i in range(50):
        a = dist[i, lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1)
        b = min(dist[i, lab == x].mean() for x in range(3) if x != lab[i])
        assert whole[i] == pytest.approx((b - a) / max(a, b)) == cut[i]
    assert vectors.silhouette(spark.createDataFrame([], schema)).count() == 0
    assert vectors.knn(spark.createDataFrame(rows[:1] + [(99, None, 1)], schema), spark.createDataFrame(rows[:1], schema)).count() == 0


def test_charsets(spark):
    d = spark.createDataFrame([("a", "plain"), ("b", "naïve")], "path string, text string")
    for name, text in (("utf-8", "naïve"), ("utf-16-le", "plain words"), ("utf-16-be", "plain words"), ("cp1252", "“naïve”"), ("latin-1", "naïve")):
        data = text.encode(name)
        assert files.detect_charset(data) == name and files.decode_bytes(data) == text
    assert files.detect_charset(b"") == files.detect_charset(b"a\0") == files.detect_charset(b"a\0b") == "utf-8"
    got = files.decoded(d.select("path", F.encode("text", "UTF-16BE").alias("content")), lambda _: "utf-16-be").collect()
    assert {(r.path, r.charset, r.text) for r in got} == {("a", "utf-16-be", "plain"), ("b", "utf-16-be", "naïve")}


def test_own_recogniser(spark):
    import re

    from gleanery.operators import entities

    d = spark.createDataFrame([(1, "Anna met Bob."), (2, None), (3, "nobody")], "chunk_id int, text string")
    make = lambda: lambda texts: [[(m.start(), m.end(), "PERSON") for m in re.finditer(r"[A-Z][a-z]+", t)] for t in texts]
    got = [tuple(r) for r in entities.recognised(d, make, batch=2).orderBy("offset_start").collect()]
    assert got == [(1, "PERSON", "Anna", 0, 4), (1, "PERSON", "Bob", 9, 12)]
    assert entities.recognised(d.limit(0), make).count() == 0


def test_nodes_in_the_order_of_their_files(spark, tmp_path):
    conv = lambda i: {"conversation_id": i, "mapping": {"n" + i: {"id": "n" + i}}}
    (tmp_path / "b.json").write_text(json.dumps([conv("1"), conv("0")]))
    (tmp_path / "a.json").write_text(json.dumps(conv("2")))
    d = files.conversation_nodes(spark, str(tmp_path), place=True)
    assert [r.conv_id for r in d.orderBy("file", "nth").collect()] == ["2", "1", "0"]
    assert d.drop("file", "nth").columns == files.conversation_nodes(spark, str(tmp_path)).columns
