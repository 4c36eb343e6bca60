"""Brute force, round trips, held-out accuracy and edge cases of the training-data operators."""

import gzip
import hashlib
import html as html_lib
import itertools
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
import zlib
from pyspark.sql import functions as F

import corpus_pipeline
from gleanery.llm import bytewords, decontaminate, exact_fingerprint, html_main, importance, language_id, packing, prefix_tree, queries, simhash_dedup, token_rollup, warc, wordbpe
from gleanery.operators import graph

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, "one", "en", "s", 3), (5, "one", "en", "s", 3), (5, "one", "en", "s", 3), (None, "one two three four", "fr", None, 1),
    (7, "\U0001f600 ÉCOLE é ﬁ <|endoftext|> \x00 x", "fr", "s", 1), (8, "word " * 30_000, "en", "s", 1), (9, "漢字 かな 12 kg", "ja", "s", 1),
]


CLASHES = "fp node fingerprint _n0 _s0 component_id row key _key _key0 _again _nth _nth0 _id h hash window length id same n sig a b comp part label ask item_id pos slots keep k importance".split()


def frame(spark, rows=ODD, shape=DOCS):
    """Rows with extra columns whose names the operators use themselves."""
    d = spark.createDataFrame(rows, shape)
    return d.withColumns({c: F.lit("x") for c in CLASHES})


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# connected components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 240)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    for small in (0, 20, 10**6):
        got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long"), small=small).collect()}
        assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


# 2


def brute_simhash(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("hot", [2, 2048])
def test_simhash(spark, sf, hot):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    rnd = random.Random(5)
    for i in range(60):  # a large group of near copies
        w = rows[0][1].split()
        w[rnd.randrange(len(w))] = f"edit{i}"
        rows.append((10_000 + i, " ".join(w)))
    rows += [(20_000, None), (20_001, "")]
    fp = {i: brute_simhash(t) for i, t in rows}
    label = {i: i for i in fp}
    for _ in range(len(fp)):
        before = dict(label)
        for a, b in itertools.combinations(fp, 2) if not _ else [p for p in pairs]:
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                label[a] = label[b] = min(label[a], label[b])
        if not _:
            pairs = [p for p in itertools.combinations(fp, 2) if (fp[p[0]] ^ fp[p[1]]).bit_count() <= 3]
        if label == before:
            break
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), hot_bucket=hot).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fp[i]:016x}", label[i]) for i in fp} and len(got) == len(rows)


def test_covering_masks_guarantee():
    masks = simhash_dedup.covering_masks(list(range(64)), 3)
    assert len(masks) == 15 and all(any(not m & d for m in masks) for d in (1 << a | 1 << b | 1 << c for a, b, c in itertools.combinations(range(64), 3)))


def test_simhash_odd(spark):
    got = simhash_dedup.near_duplicates(frame(spark)).collect()
    assert len(got) == len(ODD)
    by = [(r.doc_id, r.fingerprint, r.component_id) for r in got]
    assert {c for i, _, c in by if i in (1, 2, 3)} == {1} and {f for i, f, _ in by if i in (1, 2, 3)} == {"0" * 16} and {c for i, _, c in by if i in (4, 5)} == {4}
    assert simhash_dedup.near_duplicates(frame(spark).limit(0)).count() == 0


def test_pipeline_dedup_finds_similar(spark):
    rnd = random.Random(9)
    base = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(200)) for _ in range(15)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        w = t.split()
        for at in (20, 120):
            w[at] = "changed"
        rows.append((100 + i, " ".join(w)))  # Jaccard 0.90
        rows.append((200 + i, t))
        rows.append((300 + i, " ".join(w[:100] + [f"q{rnd.randrange(10**6)}" for _ in range(100)])))  # a shared passage
    rows += [(1000, "x y"), (1000, "x y"), (None, "x y")]
    kept = simhash_dedup.deduplicated(frame(spark, [(i, t, "en", "s", 1) for i, t in rows])).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted([*range(15), *range(300, 315), 1000])
    assert set(kept[0].asDict()) >= {"doc_id", "text", "lang", "source", "n_chars", "fp"}


def test_pipeline_dedup_of_a_dense_family(spark):
    """Hundreds of near copies of one text, few of which are within reach of each other: as many go as comparing all pairs says."""
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    texts = []
    for k in range(300):
        w = list(base)
        for at in rnd.sample(range(400), 2 + k % 9):
            w[at] = f"q{rnd.randrange(10**9)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"o{k}x{i}" for i in range(60)) for k in range(20)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            up[b] = a
    want = {i for i in range(len(texts)) if find(i) == i}
    got = {r.doc_id for r in simhash_dedup.deduplicated(frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])).collect()}
    assert set(range(300, 320)) <= got and len(want) < 150 and len(got - want) <= 0.02 * (320 - len(want))


# 4


def canonical(text):
    t = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(t.split())


def test_fingerprint_edits(spark):
    rows = [(i, t) for i, t in enumerate(["Ａ  b\n", "a B", "straße", "STRASSE", "café", "CAFÉ", "", "\U0001f600\U0001f600x", "long " * 500, "x"])] + [(50, None)]
    got = {r.doc_id: r for r in exact_fingerprint.fingerprint_edits(frame(spark, [(i, t, None, None, None) for i, t in rows])).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(order):
        t, nx = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nx[: len(t) // 2]
        r = got[i]
        assert r.copy_of == min(j for j, x in rows if canonical(x or "") == canonical(t))
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == float(canonical(t) == canonical(edited)) and r.near_next == float(canonical(t) == canonical(nx))
    same = lambda a, b: got[a].fingerprint == got[b].fingerprint
    assert same(0, 1) and same(2, 3) and same(4, 5) and same(6, 50) and not same(0, 2)


@pytest.mark.parametrize("buckets", [1, 7, 100])
def test_next_by_descending_id(spark, sf, buckets):
    d = table(spark, sf, "documents")
    ids = sorted((r.doc_id for r in d.select("doc_id").collect()), reverse=True)
    text = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    got = {r.doc_id: r.next_text for r in exact_fingerprint.with_next(d, buckets).collect()}
    assert got == {i: text[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}


def test_copy_groups(spark, monkeypatch):
    d = frame(spark, [(1, "A b", None, None, 1), (2, "a  B", None, None, 1), (3, "c", None, None, 1), (None, "C", None, None, 1)])
    want = {(1, 1), (2, 1), (3, 3), (None, 3)}
    assert {(r.doc_id, r.copy_of) for r in exact_fingerprint.copy_groups(d).collect()} == want
    monkeypatch.setattr(exact_fingerprint, "wide_hash", lambda c: F.lit("0"))  # all collide: bytes decide
    assert {(r.doc_id, r.copy_of) for r in exact_fingerprint.copy_groups(d).collect()} == want


def test_fingerprint_odd(spark):
    assert exact_fingerprint.fingerprint_edits(frame(spark)).count() == len(ODD)
    assert exact_fingerprint.fingerprint_edits(frame(spark).limit(0)).count() == 0


# 8 and the tokenizer


def test_word_bpe_is_exact():
    from tokenizers import Tokenizer

    whole, fast = Tokenizer.from_file(WORDS), wordbpe.WordBpe(WORDS, 50)
    rnd = random.Random(2)
    texts = ["", "It's  the dog's\nÜBER-naïve 3.14%… <|endoftext|> x", "ΑΣ İstanbul ß Straße", "á \x1c b\x85c\xa0d", "漢字 test's", "don't WE'LL!! ##x##", "l'été, ĳ ŉ"]
    texts += ["".join(rnd.choice("abcXYZ éÀß'.,!?12\n\t\xa0ſ„…") for _ in range(200)) for _ in range(200)]
    for t in texts:
        assert fast.encode(t).tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_packing_round_trip(spark, sf):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()] + [(9000, None), (9001, ""), (9002, "long word " * 6000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    p = packing.pack(d, WORDS, size=512, open_windows=8).toPandas().sort_values(["doc_id", "start"])
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        mine = p[p.doc_id == i]
        assert b"".join(mine.payload) == np.array(ids, "<u4").tobytes() and (mine.doc_tokens == len(ids)).all() and mine.start.tolist() == [0, *mine.length.cumsum().tolist()[:-1]]
    s = p.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id").length.cumsum() - s.length == s.offset).all()
    total = s.groupby("sequence_id").length.sum()
    assert total.max() <= 512 and total.sum() / (512 * len(total)) > 0.93


def test_packing_odd(spark):
    assert packing.pack(frame(spark), WORDS).select(F.count_distinct("doc_id")).first()[0] == 8
    assert packing.pack(frame(spark).limit(0), WORDS).count() == 0


# 1


def test_decontamination_slots(spark):
    q = "Alice has 12 apples and gives 5 kg of them to Bob Smith, then Alice buys 7 more; how many apples does Alice have?"
    p = "Carol has 30 apples and gives 9 lb of them to Dan, then Carol buys 70 more; how many apples does Carol have?"
    docs = [(1, f"We ask. {p} Yes."), (2, p.replace("Carol buys", "Erin buys").replace("does Carol", "does Frank")), (3, None), (4, ""), (5, f"Before. {q}"), (6, "nothing of the kind is said here at all by anyone"), (7, q[:40])]
    items = spark.createDataFrame([(0, q), (1, None), (2, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.verbatim) for r in decontaminate.contaminated(frame(spark, [(i, t, None, None, None) for i, t in docs]), items).collect()}
    assert got == {(1, 0, False), (5, 0, True)}
    left = decontaminate.decontaminated(frame(spark, [(i, t, None, None, None) for i, t in docs]), items)
    assert {r.doc_id for r in left.collect()} == {2, 3, 4, 6, 7}
    assert decontaminate.contaminated(frame(spark).limit(0), items.limit(0)).count() == 0
    assert decontaminate.decontaminated(frame(spark), items.limit(0)).count() == len(ODD)


PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def brute_template(text):
    """(literal, value, kind) of every template word, word by word."""
    out, opens = [], True
    for raw in text.split():
        word = raw.strip(PUNCT)
        ends = raw[-1] in '.!?:;"' or len(raw) > 1 and raw[-2] in ".!?"
        if word:
            low = word.lower()
            if word[0].isdigit() and all(c in "0123456789.,:/-'" for c in word):
                kind = "NUM"
            elif out and out[-1][2] == "NUM" and low in decontaminate.UNITS:
                kind = "UNIT"
            elif not opens and len(word) > 1 and word[0].isupper() and word[1].islower():
                kind = "NAME"
            else:
                kind = None
            if kind == "NAME" and out and out[-1][2] == "NAME":
                out[-1] = ("NAME", out[-1][1] + " " + low, "NAME")
            else:
                out.append((kind or low, low, kind))
        opens = ends
    return out


def brute_contaminated(text, item):
    d, q = brute_template(text), brute_template(item)
    size = min(8, len(q))
    if not size:
        return False
    hits = {}
    for i in range(len(d) - size + 1):
        for j in range(len(q) - size + 1):
            if [x[0] for x in d[i : i + size]] == [x[0] for x in q[j : j + size]] and 2 * sum(x[2] is not None for x in q[j : j + size]) <= size:
                hits.setdefault(i - j, set()).update(range(j, j + size))
    for diagonal, covered in hits.items():
        if len(covered) >= min(13, max(1, len(q) - 1)):
            meet = {(q[j][2], q[j][1], d[j + diagonal][1]) for j in covered if q[j][2]}
            if len({m[:2] for m in meet}) == len(meet) == len({(m[0], m[2]) for m in meet}):
                return True
    return False


def test_decontamination_of_slot_heavy_items(spark):
    """Windows of mostly numbers count as they stand; with other numbers they are no match."""
    short, table = "Compute 12 + 7 * 3 - 45 / 9.", "Add these now: 3 kg 14 kg 15 kg 92 kg 65 kg 35 kg 89 kg and 79 kg"
    items = spark.createDataFrame([(0, short), (1, table)], "item_id long, text string")
    docs = [(1, f"We ask. {short} Yes."), (2, f"Before. {table} after it"), (3, short.replace("45", "46")), (4, table.replace("15 kg 92", "16 kg 93"))]
    got = {(r.doc_id, r.item_id, r.verbatim) for r in decontaminate.contaminated(frame(spark, [(i, t, None, None, None) for i, t in docs]), items, slot_heavy=True).collect()}
    assert got == {(1, 0, True), (2, 1, True)}
    left = decontaminate.decontaminated(frame(spark, [(i, t, None, None, None) for i, t in docs]), items)
    assert {r.doc_id for r in left.collect()} == {3, 4}


def test_decontamination_brute_force(spark):
    rnd = random.Random(21)
    names, units, plain = ["Alice", "Bob", "Carol", "Dan"], ["kg", "lb", "km"], ["has", "apples", "and", "gives", "some", "to", "then", "buys", "more", "how", "many", "does", "take", "home"]

    def sentence(n):
        w = []
        while len(w) < n:
            w += rnd.choice([[rnd.choice(plain)]] * 4 + [[rnd.choice(names)], [str(rnd.randint(1, 9)), rnd.choice(units)], [str(rnd.randint(1, 9)) + rnd.choice(["", ".", ","])]])
        return " ".join(w) + "."

    items = [sentence(rnd.choice([5, 12, 20, 30])) for _ in range(40)]
    docs = []
    for _ in range(150):
        t = rnd.choice(items)
        for old, new in (("Alice", rnd.choice(names)), (rnd.choice("123456789"), rnd.choice("123456789")), (rnd.choice(units), rnd.choice(units)), (rnd.choice(plain), rnd.choice(plain))):
            if rnd.random() < 0.5:
                t = t.replace(old, new)
        docs.append(sentence(10) + " " + t + " " + sentence(8))
    want = {(i, j) for i, t in enumerate(docs) for j, q in enumerate(items) if brute_contaminated(t, q)}
    got = decontaminate.contaminated(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and 60 < len(want)


def test_decontamination_filter(spark):
    """The Bloom filter loses no hash, however full it is, and lets few others through."""
    h = np.random.default_rng(4).integers(0, 1 << 64, 30_000, dtype=np.uint64)
    held = decontaminate.bloom(spark.createDataFrame([(int(x),) for x in h[:10_000].view(np.int64)], "hash long"))
    assert held.nbytes == 8 << 20 and decontaminate.in_bloom(held, h[:10_000]).all() and decontaminate.in_bloom(held, h[10_000:]).sum() < 5


def test_hashes_of_long_texts_are_those_of_short_ones(monkeypatch):
    b = np.frombuffer((b"some words of " * 300 + b"x" * 900 + b" end ") * 3, np.uint8)
    want = bytewords.hashes(b, *bytewords.bounds(b))
    monkeypatch.setattr(bytewords, "CHUNK", 100)
    assert (bytewords.hashes(b, *bytewords.bounds(b)) == want).all() and len(want) == 3 * 902


def test_decontamination_finds_every_passage(spark, sf):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert want <= got and len(got - want) <= 2


# 6


def test_importance_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    train = labels.where("doc_id % 2 = 0")
    got = importance.resample(docs, train).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    assert got.keep[got.quality == 1].mean() > 0.98 and got.keep[got.quality == 0].mean() < 0.15
    kept = {r.doc_id for r in importance.resampled(docs, train).select("doc_id").collect()}
    assert kept == {r.doc_id for r in importance.resample(docs, train).where("keep").collect()}


def test_importance_brute_force(spark):
    rnd = random.Random(12)
    texts = [" ".join(rnd.choice(["good", "fine", "nice", "bad!!", "$$", "##"][3 * (i % 3 == 0) :][:3]) + str(rnd.randint(0, 3)) for _ in range(rnd.randint(1, 40))) for i in range(90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 90, 2)], "doc_id long, quality int")
    count = lambda ids: np.bincount(np.concatenate([importance.features(texts[i]) for i in ids]), minlength=importance.BUCKETS)
    target, raw = count([i for i in range(0, 90, 2) if i % 3]), count(range(90))
    p, q = target + importance.SMOOTHING, raw * (target.sum() / raw.sum()) + importance.SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    weight = {i: ratio[importance.features(t)].sum() for i, t in enumerate(texts)}
    for asked, k in ((None, sum(w > 0 for w in weight.values())), (0.5, 45), (7, 7)):
        got = {r.doc_id: r for r in importance.resample(docs, labels, k=asked).collect()}
        assert all(abs(got[i].importance - weight[i]) < 1e-9 and got[i].n_grams == len(importance.features(texts[i])) for i in weight)
        noise = {i: got[i].gumbel_key - weight[i] for i in weight}  # standard Gumbel
        assert abs(np.mean(list(noise.values())) - 0.5772) < 0.5 and 0.8 < np.std(list(noise.values())) < 1.8 and len(set(noise.values())) == 90
        assert {i for i in weight if got[i].keep} == set(sorted(weight, key=lambda i: -got[i].gumbel_key)[:k])


def test_importance_is_a_sample(spark):
    """At the default settings: seeds give different sets, and of texts of one kind the inclusion follows the weight."""
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(10)) for _ in range(400)]  # short: chance decides
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t.count("a") + t.count("b") > 2)) for i, t in enumerate(texts) if i % 2 == 0], "doc_id long, quality int")
    runs = [importance.resample(docs, labels, seed=s).orderBy("doc_id").toPandas() for s in range(6)]
    sets = [frozenset(r.doc_id[r.keep]) for r in runs]
    assert len(set(sets)) == 6 and len({len(s) for s in sets}) == 1
    share = np.mean([r.keep for r in runs], axis=0)
    thirds = np.array_split(share[np.argsort(runs[0].importance.to_numpy())], 3)
    assert 0 < thirds[0].mean() < thirds[1].mean() < thirds[2].mean() < 1 and thirds[0].mean() + 0.2 < thirds[2].mean()
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    one, two = ({r.doc_id for r in importance.resampled(docs, labels, seed=s).select("doc_id").collect()} for s in (1, 2))
    assert 0 < len(one ^ two) < 0.05 * len(one)


def test_kth_largest(spark):
    x = [random.Random(1).gauss(0, 1) for _ in range(3000)] + [5.0] * 50
    d = spark.createDataFrame([(v,) for v in x], "key double").repartition(3)
    for k in (1, 20, 60, 1500, 3049):
        assert importance.kth_largest(d, "key", k, gather=10) == sorted(x, reverse=True)[k - 1]
    assert importance.kth_largest(d, "key", 5000) == -np.inf


def test_importance_odd(spark):
    labels = spark.createDataFrame([(4, 1), (8, 0), (None, 1), (9, None)], "doc_id long, quality int")
    got = importance.resample(frame(spark), labels).toPandas()
    assert len(got) == len(ODD) and not got.keep[got.n_grams == 0].any()
    assert importance.resample(frame(spark).limit(0), labels.limit(0)).count() == 0
    assert importance.resampled(frame(spark), labels.limit(0)).count() == len(ODD) - 3


# 9


def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.held_out]
    assert (out.lang == out.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()


def test_language_ignores_quotes(spark):
    """A passage in another language that some documents quote doesn't make that language look like theirs."""
    rnd = random.Random(6)
    en = lambda n: " ".join(rnd.choice(["the", "with", "thing", "other", "which", "they", "have", "weather"]) for _ in range(n))
    es = lambda n: " ".join(rnd.choice(["que", "ciudad", "donde", "mañana", "para", "nosotros", "cuando"]) for _ in range(n))
    quote = en(60)
    rows = [(i, en(80) if i % 2 else es(200) + (" " + quote if i % 40 == 0 else ""), "en" if i % 2 else "es") for i in range(400)] + [(1000, quote, None)]
    got = {r.doc_id: r.lang_pred for r in language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {i: lang or "en" for i, _, lang in rows}


def test_language_popcounts_brute_force():
    texts = {"aa": ["the cat sat on the mat"] * 5, "bb": ["le chat est sur le tapis"] * 5}
    masks = np.zeros((1, language_id.SLOTS), np.uint64)
    for i, k in enumerate(sorted(texts)):
        for t in texts[k]:
            for s in language_id.slots_of(language_id.gram_hashes(t)):
                masks[0][s] |= np.uint64(1 << i)
    f = language_id.Filter(sorted(texts), masks)
    assert f.score("the mat") == ("aa", 1.0) and f.score("le tapis")[0] == "bb" and f.score("12 %%")[0] == "und" and f.score(None) == ("und", 0.0)


def test_language_brute_force(spark, sf):
    """The whole prediction against sets of n-grams as strings: no filter, so nothing to correct."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").toPandas()

    def grams(text):
        t = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or "")
        t = re.sub(" +", " ", t)
        t = f" {t.lstrip(' ')}  "
        return [t[i : i + 4] for i in range(len(t) - 3)] if t.strip() else []

    train = docs[docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 != 0) & docs.lang.notna()]
    have = {lang: Counter(g for t in d.text for g in set(grams(t))) for lang, d in train.groupby("lang")}
    size = train.lang.value_counts()
    share = {lang: {g: n / size[lang] for g, n in c.items() if n >= min(language_id.MIN_COUNT, -(-size[lang] // 10))} for lang, c in have.items()}
    most = Counter()
    for c in share.values():
        for g, x in c.items():
            most[g] = max(most[g], x)
    sets = {lang: {g for g, x in c.items() if x >= language_id.MIN_SHARE * most[g]} for lang, c in sorted(share.items())}
    got = {r.doc_id: r for r in language_id.language_id(spark.createDataFrame(docs)).collect()}
    for i, t in zip(docs.doc_id, docs.text):
        g = grams(t)
        score = {lang: sum(x in s for x in g) / len(g) for lang, s in sets.items()} if g else {}
        best = max(score.values(), default=0)
        assert got[i].lang_pred == "und" if not g else score[got[i].lang_pred] > best - 0.01
        assert abs(got[i].score - best) < 0.02


def test_language_beyond_one_word(spark):
    """More languages than a word has bits, most of them with few documents; a hot repeated id and ids that are null."""
    rnd = random.Random(3)
    letters = [chr(c) for c in range(0x561, 0x561 + 38)] + list("abcdefghijklmnopqrstuvwxyz")
    words = {f"l{k:03}": ["".join(rnd.choice(letters) for _ in range(5)) for _ in range(12)] for k in range(150)}
    text = lambda lang: " ".join(rnd.choice(words[lang]) for _ in range(30))
    rows = [(k * 10 + i, text(lang), lang) for k, lang in enumerate(words) for i in range(10)] + [(5, text("l000"), "l000")] * 300 + [(None, text("l001"), "l000")] * 50
    got = language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows) and all(r.lang_pred == f"l{r.doc_id // 10:03}" for r in got if r.doc_id is not None) and {r.lang_pred for r in got if r.doc_id is None} == {"l001"}


def test_known_language_reads_texts_alone(spark, sf):
    docs = table(spark, sf, "documents").unionByName(frame(spark), allowMissingColumns=True)
    got = language_id.in_known_language(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and re.search(r"ArrowEvalPython \[known\(text#\d+\)", plan), plan  # no row goes to Python and back
    model = language_id.fit(docs.where(~language_id.held_out()))
    want = [r for r in docs.collect() if (p := model.score(r.text))[0] != "und" and p[1] >= language_id.LEAST]
    assert got.schema == docs.schema and Counter(got.collect()) == Counter(want) and 0 < len(want) < docs.count()


def test_language_odd(spark):
    got = language_id.language_id(frame(spark)).collect()
    assert len(got) == len(ODD) and all(r.lang_pred == "und" for r in got if r.doc_id in (1, 2, 3))
    assert language_id.language_id(frame(spark).limit(0)).count() == 0
    none = language_id.language_id(frame(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}


# 7

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head><body><nav><a>Home</a></nav><header><h1>Site</h1></header>
<div class="cookie-notice"><p>We use cookies</p></div><article><h1>Title &amp; more</h1><p>One <b>bold</b> &eacute;t&#233;
 two.<br>three</p><div class="ad"><p>Buy this now</p></div><p>Four&nbsp;five.</p><form><input><label>Mail</label></form><section class="comments"><p>First! great great great</p></section></article>
<aside>Side bar words</aside><!-- <p>no</p> --><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert html_main.main_text(PAGE) == "Title & more\nOne bold été two. three\nFour five."
    assert html_main.main_text(PAGE[: PAGE.index("five.")]) == "Title & more\nOne bold été two. three\nFour"
    assert html_main.main_text(None) == html_main.main_text("") == html_main.main_text("<p><br>") == ""
    assert html_main.main_text("just words here") == "just words here"


def test_main_text_without_marks():
    """No article element, no telling class: link lists on either side stay out, lists and links of the content stay in."""
    p = '<p>Lorem ipsum dolor sit amet <a href="x">adipiscing elit</a> sed do eiusmod.</p>'
    links = "<ul>" + "".join(f'<li><a href="/{k}">Link {k}</a></li>' for k in range(8)) + "</ul>"
    page = f'<html><body><div id="t1">{links}</div><div id="x2"><h1>My title</h1>{p}<ul><li>item one</li><li>item two</li></ul>{p}</div><div id="x3">{links}</div></body></html>'
    line = "Lorem ipsum dolor sit amet adipiscing elit sed do eiusmod."
    assert html_main.main_text(page) == f"My title\n{line}\nitem one\nitem two\n{line}"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p title=it's>Hello world</p><p>Don't stop</p></article>", "Hello world\nDon't stop"),
        ('<article><h2 id="search">Search</h2><p>a b</p><h2 id="comments">Comments in code</h2><p class="alert">be careful</p></article>', "Search\na b\nComments in code\nbe careful"),
        ('<nav><a>x</a></nav><article><h1>One</h1><p>first part</p></article><div class="ad">buy</div><p>between</p><article><p>second</p></article><footer>f</footer>', "One\nfirst part\nsecond"),
        ('<article><p>x</p><div class="post-comments"><p>nice post</p></div><ul class=share><li>Tweet</ul><p>y</p></article>', "x\ny"),
        ('<article class="post"><p>one two</p></article><section class="comments"><article class="comment"><p>a reader says</p></article></section>', "one two"),
        ("<div class=ad>buy<article><p>after a tag that stays open</p></article>", "after a tag that stays open"),
        ("<form id=all><div><p>" + "word " * 30 + "</p></div></form>", "word " * 29 + "word"),
        ("<article><p>a<p>b<ul><li>c<li>d</ul>e<blockquote>q<footer>who</footer></blockquote></article>", "a\nb\nc\nd\ne\nq\nwho"),
        ("<div><a href=x>Home</a> <a>About</a></div><div><h1>A title</h1><p>" + "word " * 40 + "</p><p>Short one.</p></div><div>Sign up here <input></div><div>Copyright 2020</div>", "A title\n" + "word " * 39 + "word\nShort one."),
        ("<p " * 50_000, ""),
        ("<div>" * 20_000 + "deep", "deep"),
    ],
)
def test_main_text_cases(page, want):
    assert html_main.main_text(page) == want


def token_f1(got, want):
    a, b = Counter(got.split()), Counter(want.split())
    return 2 * (a & b).total() / max(1, a.total() + b.total())


def test_main_text_held_out(spark, sf):
    """Pages that weights were not fitted on: corpus pages with and without their marks, and each layout by weights from the
    others alone."""
    pages = table(spark, sf, "pages")
    w = html_main.fit(pages.where("page_id % 2 = 0"))
    scores = []
    for r in pages.where("page_id % 2 = 1").collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        want = html_main.main_text(f"<article>{article}</article>")
        assert html_main.main_text(r.html, w) == want and want.split() == html_lib.unescape(re.sub("<[^>]*>", " ", article)).split()
        scores.append(token_f1(html_main.main_text(re.sub("(</?)article>", r"\1div>", r.html), w), want))
    assert np.mean(scores) >= 0.97
    scores = []
    for k, line in enumerate(html_main.LAYOUTS):
        inside, outside = Counter(), Counter()
        for other in html_main.LAYOUTS[:k] + html_main.LAYOUTS[k + 1 :]:
            x, y = html_main.label_counts(*html_main._layout(other))
            inside += x
            outside += y
        page, spans = html_main._layout(line)
        at = [any(a <= m.start() < b for a, b in spans) for m in re.finditer(r"\bw\b(?![^<]*>)", page)]
        number = itertools.count()
        page = re.sub(r"\bw\b(?![^<]*>)", lambda m: ("in" if at[(i := next(number))] else "out") + str(i), page)
        got = html_main.main_text(page, html_main.weights(inside, outside))
        scores.append(token_f1(got, " ".join(f"in{i}" for i, x in enumerate(at) if x)))
    print(scores)
    assert np.mean(scores) >= 0.9


def test_best_region_brute_force():
    rnd = random.Random(4)
    for _ in range(200):
        s = [rnd.randint(-5, 5) for _ in range(rnd.randint(0, 12))]
        lo, hi = html_main.best_region(s)
        assert sum(s[lo:hi]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


def test_extract(spark):
    d = spark.createDataFrame([(1, "u", PAGE), (2, "v", None), (2, "v", ""), (None, None, "<p>x" * 20_000)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = html_main.extract(d).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in got) == [(0, 39_999), (1, len(html_main.main_text(PAGE))), (2, 0), (2, 0)]
    assert html_main.extract(d.limit(0)).count() == 0


# 10


def test_warc_round_trip(spark, tmp_path):
    long = "é" * 600
    d = spark.createDataFrame([(1, None, None), (None, "u\r\nx", "<p>\r\n\r\nWARC/1.1"), (2, "a", long), (2, "a", long), (1, "b", long), (7, "c", "short"), (8, "d", "short"), (None, "e", long)], "page_id long, url string, html string").withColumn("payload", F.lit(1))
    warc.write(d, str(tmp_path / "w"), row_bytes=300, part_rows=2)
    got = warc.read(spark, str(tmp_path / "w")).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to or 0) for r in got) == [(-1, "response", 0), (-1, "revisit", 2), (1, "response", 0), (1, "revisit", 2), (2, "response", 0), (2, "response", 0), (7, "response", 0), (8, "response", 0)]
    assert {r.payload for r in got if r.record_type == "response"} == {"", "<p>\r\n\r\nWARC/1.1", long, "short"}
    assert warc.archive(d.limit(0)).count() == 0
    parts = [f.read_bytes() for f in (tmp_path / "w").glob("part-*")]
    assert sum(gzip.decompress(b).count(b"WARC-Type:") for b in parts) == len(got)  # any reader of gzip can read a part
    records = [m for b in parts for m in warc.members(memoryview(b)) if m]
    assert len(records) == len(got) and all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in records)


def test_warc_long_payloads(spark, tmp_path):
    """Records of 16 MB and more, whose length fills the last byte of a member; parts are cut by bytes."""
    d = spark.range(3).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat(concat('é', id), 6000000)").alias("html")).coalesce(1)
    warc.write(d, str(tmp_path / "w"), row_bytes=1000, part_rows=1)
    assert sorted((r.page_id, r.payload_bytes) for r in warc.read(spark, str(tmp_path / "w"), payload=False).collect()) == [(i, 18_000_000) for i in range(3)]
    assert len(list((tmp_path / "w").glob("part-*"))) == 3


# 5


def test_prefix_tree(spark):
    x = queries.CONTROL
    convs = {1: [("system", "s"), ("user", "a"), ("assistant", "b")], 2: [("system", "s"), ("user", "a"), ("assistant", "c"), ("user", "d")], 3: [("system", "s"), ("user", "a")], 4: [("system", "s"), ("user", "a"), ("assistant", "b")], -1: [("user", x), ("assistant", x)], 9: [("as\\n\nsi<\\|t", "<\\\\|<|" + "y" * 9000), ("assistant", "")]}
    rows = [(c, i, r, t) for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("leaf", F.lit(1))
    got = {r.conv_id: r for r in prefix_tree.formatted_digests(d, BYTES).collect()}
    for c, ts in convs.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    nodes = prefix_tree.forest(d.repartition(1), BYTES)[0].toPandas()
    for _, tree in nodes.groupby("tree_id"):
        by = tree.set_index("node")
        for n, r in by.iterrows():
            spans, at, up = [], 0, r.parent
            while up == up and up is not None:
                a = by.loc[up]
                spans.append((a.stream_start, a.stream_start + len(a.token_ids)))
                at += len(a.token_ids)
                up = a.parent
            assert r.position_start == at and {i for s in r.ancestors for i in range(s["start"], s["end"])} == {i for a, b in spans for i in range(a, b)}


def test_prefix_tree_compares_turns():
    """Paths whose digests collide: role and text decide which turns are one."""
    rows = [(b"k" * 8, b"x" * 16, ["user"], ["one"]), (b"k" * 16, b"y" * 16, ["user", "user"], ["two", "more"]), (b"k" * 8 + b"l" * 8, b"z" * 16, ["user", "user"], ["two", "other"])]
    import unittest.mock as mock

    with mock.patch.object(prefix_tree, "TaskContext") as context:
        context.get.return_value.partitionId.return_value = 0
        batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["path", "leaf", "roles", "texts"])
        out = [r for b in prefix_tree._grow(BYTES)([batch]) for r in b.to_pylist()]
    t = prefix_tree.tokens(BYTES)
    assert [(r["tree_id"], r["depth"], t.text(r["token_ids"]).split("\n")[1].partition("<")[0]) for r in out] == [(0, 0, "one"), (1, 0, "two"), (1, 1, "more"), (1, 1, "other")]


def test_prefix_tree_of_long_texts(spark):
    d = spark.createDataFrame([(c, i, "assistant", f"turn {i} " * 20_000) for c in (1, 2) for i in range(3)], "conv_id long, turn long, role string, text string")
    assert [(r.n_turns, r.loss_chars) for r in prefix_tree.formatted_digests(d, BYTES).collect()] == [(3, 3 * 140_000)] * 2


def test_prefix_tree_odd(spark):
    shape = "conv_id long, turn long, role string, text string"
    d = spark.createDataFrame([(None, None, None, None), (None, None, None, None), (1, 0, "user", None)], shape)
    assert sorted((r.conv_id or 0, r.n_turns) for r in prefix_tree.formatted_digests(d, BYTES).collect()) == [(0, 2), (1, 1)]
    assert prefix_tree.formatted_digests(d.limit(0), BYTES).count() == 0


# 3


def test_rollup(spark, sf, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    docs = table(spark, sf, "documents")
    counts = token_rollup.count_tokens(docs, WORDS, "v1").cache()
    pdf = docs.toPandas()
    pdf["n_tokens"] = [len(whole.encode(t, add_special_tokens=False).ids) for t in pdf.text]
    r = token_rollup.Rollup(spark, str(tmp_path / "r"))
    total = lambda frame: {(a, b): (len(g), g.n_tokens.sum()) for (a, b), g in frame.groupby(["source", "lang"])}
    seen = lambda: {(x.source, x.lang): (x.n_docs, x.n_tokens) for x in r.totals().where("tokenizer_version = 'v1'").collect()}
    assert r.commit("a", token_rollup.inserts(counts)) and not r.commit("a", token_rollup.inserts(counts))
    assert seen() == total(pdf)
    assert r.commit("b", token_rollup.deletes(counts.where("doc_id < 20")))
    assert seen() == total(pdf[pdf.doc_id >= 20])
    r.compact()
    assert seen() == total(pdf[pdf.doc_id >= 20]) and not r.commit("a", token_rollup.inserts(counts))
    old = counts.where("doc_id >= 20")
    assert r.commit("c", token_rollup.revisions(old, old.withColumn("tokenizer_version", F.lit("v2")))) and seen() == {}
    r.compact()
    assert r.totals().where("tokenizer_version = 'v2'").agg(F.sum("n_docs")).first()[0] == (pdf.doc_id >= 20).sum()


def test_rollup_redoes_what_died(spark, tmp_path):
    r = token_rollup.Rollup(spark, str(tmp_path / "r"))
    c = token_rollup.inserts(token_rollup.count_tokens(frame(spark), WORDS, "v"))
    r.commit("x", c)
    marker = next((tmp_path / "r/deltas").glob("*/_SUCCESS"))
    marker.unlink()  # as if the commit had died
    assert r.totals().count() == 0 and r.commit("x", c)
    assert r.totals().agg(F.sum("n_docs")).first()[0] == len(ODD)
    e = token_rollup.Rollup(spark, str(tmp_path / "e"))
    e.commit("x", c.limit(0))
    assert e.totals().count() == 0


def test_rollup_compacts_itself(spark, tmp_path):
    r = token_rollup.Rollup(spark, str(tmp_path / "r"), compact_every=3)
    c = token_rollup.inserts(token_rollup.count_tokens(frame(spark), WORDS, "v")).cache()
    for i in range(7):
        assert r.commit(f"b{i}", c)
    assert not any(r.commit(f"b{i}", c) for i in range(7)) and r.totals().agg(F.sum("n_docs")).first()[0] == 7 * len(ODD)
    assert len(list((tmp_path / "r/snapshots").glob("0*"))) == 1 and len(list((tmp_path / "r/deltas").glob("*"))) == 1
    # a compaction that died after its snapshot: the folders it took in are still there, their markers are not
    (tmp_path / "r/done").rename(tmp_path / "kept")
    for batch in [x.batch for x in spark.read.parquet(str(next((tmp_path / "r/snapshots").glob("0*")))).where("batch is not null").collect()]:
        c.limit(0).groupBy(*token_rollup.KEYS).agg(*[F.sum(x).cast("long").alias(x) for x in token_rollup.SUMS]).write.parquet(str(tmp_path / f"r/deltas/{batch}"))
    assert not r.commit("b5", c) and r.totals().agg(F.sum("n_docs")).first()[0] == 7 * len(ODD)
    r.compact()
    assert r.totals().agg(F.sum("n_docs")).first()[0] == 7 * len(ODD) and not list((tmp_path / "r/deltas").glob("*"))


def test_rollup_query(spark, sf):
    """What is left of the query's history of batches is a plain recount."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    pdf = table(spark, sf, "documents").toPandas()
    pdf["t"] = [len(whole.encode(t, add_special_tokens=False).ids) for t in pdf.text]
    want = {(a, b, "word_bpe_49k", len(g), g.text.map(len).sum(), g.t.sum()) for (a, b), g in pdf.groupby(["source", "lang"], dropna=False)}
    none = lambda x: None if x != x else x
    assert {(r.source, r.lang, r.tokenizer_version, r.n_docs, r.n_chars, r.n_tokens) for r in queries.op3_token_rollup(spark, sf).collect()} == {(none(a), none(b), *x) for a, b, *x in want}


# the whole


def test_queries_against_sql(spark, sf):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    for name, sql in queries.oracle_sql().items():
        a, b = queries.queries()[name](spark, sf).toPandas(), con.sql(sql).df()
        cells = lambda d: sorted(tuple("-" if pd.isna(x) else str(int(x)) if isinstance(x, float) else str(x) for x in r) for r in d[sorted(d.columns)].astype(object).itertuples(index=False, name=None))
        assert sorted(a.columns) == sorted(b.columns) and cells(a) == cells(b), name


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    n = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        docs = out.cache()
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    texts = [r.text for r in docs.collect()]
    assert n * 0.5 < len(texts) < n and len(set(texts)) == len(texts) and not any(i in t for t in texts for i in items)
    packed = corpus_pipeline.run(spark, sf)
    assert packed.select(F.count_distinct("doc_id")).first()[0] == len(texts)


def test_pipeline_odd(spark, tmp_path):
    for name, d in {"labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"), "benchmark": spark.createDataFrame([], "item_id long, text string"), "documents": spark.createDataFrame(ODD, DOCS)}.items():
        d.write.parquet(str(tmp_path / f"{name}.parquet"))
    left = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert left and left <= {4, 5, 7, 8, 9, None}  # texts without words went, and copies
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), str(tmp_path)).count() == 0
