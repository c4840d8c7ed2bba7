"""Jaccard join, neighbours, classifier, components, pipeline."""

import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attesta.llm import components, jaccard, neighbours, quality


def sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(docs):
    own = [sets(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(docs)), 2):
        if own[i] and own[j]:
            both = len(own[i] & own[j])
            if 100 * both >= 75 * (len(own[i]) + len(own[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        least[find(i)] = min(k, least.get(find(i), k))
    return sorted((k, len(own[i]), least[find(i)] if own[i] else k) for i, (k, _) in enumerate(docs))


def near_copies(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmn")
    bases = [[word() for _ in range(rng.choice([3, 5, 8, 40, 90]))] for _ in range(12)]
    passage = [word() for _ in range(30)]
    docs = []
    for k in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            w += passage
        docs.append((k, rng.choice([" ", "\n", "\t "]).join(w)))
    return [*docs, (n, None), (n + 1, " \n"), (n + 2, ""), (n + 3, "One"), (n + 4, "one"), (5, docs[9][1])]


@pytest.mark.parametrize("slice_rows", [20_000, 5])
def test_jaccard(spark, slice_rows):
    docs = near_copies(slice_rows)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted(tuple(r) for r in jaccard.near_duplicates(df, slice_rows=slice_rows).collect())
    assert got == linked(docs)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("slice_rows", [1, 5])
def test_isolated_pairs_in_slices(spark, slice_rows):
    """Each shingle of a pair is in two documents only, so that with slices of one row the two never meet by chance."""
    docs = []
    for i in range(12):
        w = [f"w{i}x{j}" for j in range(60)]
        docs += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:30], "other", *w[31:]]))]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), slice_rows=slice_rows).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(k, k - k % 2) for k, _ in docs]


def test_pairs_that_are_refused_first(spark, monkeypatch):
    """With one pair told of two components at first, the one link that joins them is still found, and clashing ids are told apart."""
    monkeypatch.setattr(jaccard.Join.linked, "__defaults__", (1,))
    rng = random.Random(4)
    base = [f"w{j}" for j in range(40)]
    docs = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = f"v{i}"
        docs.append((i, " ".join(w)))
    real = jaccard.class_of
    few = lambda s: (real(s)[0] % 8, real(s)[1])  # noqa: E731  ids that clash; both go to the workers by value
    monkeypatch.setattr(jaccard, "class_of", few)
    monkeypatch.setattr(jaccard, "named", lambda s, clashing: few(s)[0] ^ few(s)[1] if few(s)[0] in clashing else few(s)[0])
    got = sorted(tuple(r) for r in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == linked(docs)


def test_jaccard_of_a_long_text(spark):
    words = [f"w{j * 7919 % 100_003}" for j in range(60_000)]
    docs = [(1, " ".join(words)), (2, " ".join([*words[:-500], "end"])), (3, " ".join(words[:30_000]))]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (3, 3)]


def test_bounds_never_refuse_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 60, rng.integers(1, 400)).astype(np.uint64))
        keep = rng.random(len(a)) < rng.choice([0.7, 0.8, 0.95])
        b = np.unique(np.concatenate((a[keep], rng.integers(0, 1 << 60, rng.integers(0, 40)).astype(np.uint64))))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        (x, fx), (y, fy) = jaccard.vectors_of(a), jaccard.vectors_of(b)
        x, y = (np.frombuffer(v, np.uint8) for v in (x, y))
        assert jaccard.fine_bound(fx, fy) >= both and np.minimum(x, y).sum(dtype=int) >= both
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert jaccard.allowed(x, np.int64(len(a)), y, np.int64(len(b)))
            tree = jaccard.CountTree(np.array([len(b)] * 40), np.tile(y, (40, 1)))
            assert len(tree.search(len(a), x)) == 40


@pytest.mark.parametrize("leaf", [2, 64])
def test_block_pairs(leaf):
    rng = np.random.default_rng(2)
    sizes = rng.integers(20, 40, 90)
    vectors = np.stack([np.bincount(rng.integers(0, 6, s), minlength=64) for s in sizes]).astype(np.uint8)
    roots = rng.integers(0, 5, 90)
    starts = np.array([0, 30, 31, 90])
    want = {
        (i, j) for a, b in itertools.pairwise(starts) for i, j in itertools.combinations(range(a, b), 2)
        if roots[i] != roots[j] and jaccard.allowed(vectors[i], sizes[i], vectors[j], sizes[j])
    }
    found, cut = jaccard.block_pairs(starts, sizes, vectors, roots, leaf=leaf)
    assert {tuple(sorted(p)) for p in found.tolist()} == want and not cut
    few, cut = jaccard.block_pairs(starts, sizes, vectors, roots, leaf=leaf, most=1)
    assert {tuple(sorted(p)) for p in few.tolist()} <= want and cut == (len(few) < len(found))
    best, more = jaccard.best_of_roots(found, sizes, vectors, roots, 2)
    of_roots = lambda p: tuple(sorted((roots[p[0]], roots[p[1]])))
    for p in {of_roots(p) for p in found}:
        own = [q for q in found if of_roots(q) == p]
        kept = [q for q in best if of_roots(q) == p]
        assert len(kept) == min(2, len(own)) and all(m == (len(own) > 2) for q, m in zip(best, more, strict=True) if of_roots(q) == p)
        assert max(jaccard.scores(np.array(own), sizes, vectors)) == max(jaccard.scores(np.array(kept), sizes, vectors))
    star = jaccard.star_pairs(starts, sizes, vectors)
    assert {tuple(p) for p in star.tolist()} and all(jaccard.allowed(vectors[i], sizes[i], vectors[j], sizes[j]) for i, j in star)


@pytest.mark.parametrize("part", [components.PART, 20])
def test_components(spark, part):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    root = {n: n for e in edges for n in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long"), part).collect()}
    assert got == {n: find(n) for n in root}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_copies_without_key(spark):
    words = [f"w{i}" for i in range(60)]
    docs = [(7, " ".join(words)), (None, " ".join([*words[:-1], "other"])), (8, "something else that has no copy at all")]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 7), (7, 7), (8, 8)]


def exact(rows, asked, k):
    out = []
    for q, x in asked:
        near = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(x))[:k]
        out += [(q, n + 1, i) for n, (_, i) in enumerate(near)]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(800)]
    rows += [(800 + i, rows[0][1]) for i in range(40)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, []), (2005, [1.0, 2.0]), rows[3]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("bucket", F.lit(1))
    asked = [r for r in rows if r[0] % 20 == 0]
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), part_rows=500).collect()
    want = {(q, i) for q, _, i in exact(rows, asked, 10)}
    found = {(r.query_id, r.vec_id) for r in got}
    assert len(found & want) / len(want) >= 0.9
    for r in got:
        assert abs(r.score - np.linalg.norm(np.array(dict(rows)[r.query_id]) - np.array(dict(rows)[r.vec_id]))) < 1e-12
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0] == list(range(800, 810))
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 800] == [0, *range(801, 810)]
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_of_far_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(rng.standard_normal((400, 16)))]
    rows += [(400 + i, (np.array(rows[i][1]) * 100).tolist()) for i in range(3)] + [(500, [1.0, 2.0]), (501, [3.0, 4.0]), (502, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id >= 400"), part_rows=150).collect()
    same = lambda q: [r for r in rows if len(r[1]) == len(q[1])]
    want = {(a, i) for q in rows[400:] for a, _, i in exact(same(q), [q], 10)}
    assert {(r.query_id, r.vec_id) for r in got} == want and len(got) == 32


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, table):
    path = f"/root/testdata/{table}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no such table")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(path).select("vec_id", "embedding").collect() if r.embedding]
    want = {(q, i) for q, _, i in exact_of(rows, 100)}
    got = {(r.query_id, r.vec_id) for r in neighbours.op5_neighbours(spark, f"/root/testdata/{table}").collect()}
    assert len(got) == len(want) and len(got & want) / len(want) >= 0.95


def exact_of(rows, step, k=10):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    for q in np.flatnonzero(ids % step == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[ids == ids[q]] = np.inf
        yield from ((int(ids[q]), n + 1, int(ids[i])) for n, i in enumerate(np.lexsort((ids, d))[:k]))


def test_ties_at_the_last_rank(spark):
    """Of distinct vectors at one distance the smaller ids are taken."""
    corners = [[0.0] * 8 for _ in range(16)]
    for i in range(16):
        corners[i][i // 2] = 1.0 if i % 2 else -1.0
    rows = [(100, [1e-9] + [0.0] * 7)] + [(i, c) for i, c in enumerate(corners)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), spark.createDataFrame([(100, [0.0, 1e-300] + [0.0] * 6)], "vec_id long, embedding array<double>"), k=5)
    assert [r.vec_id for r in got.orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_probes_reach_the_target(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = np.repeat(rng.standard_normal((60, 16)), 5, axis=0) + rng.standard_normal((300, 16)) * 0.6
    monkeypatch.setattr(neighbours, "SAMPLE_QUERIES", len(x))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    hashing = neighbours.hashing_for(df, len(x), 4)
    index, met = hashing.index(x), []
    for q in range(len(x)):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        probe = hashing.probe(x[q : q + 1])[0]
        met += [any(index[i, t] in set(keys.tolist()) for t, keys in enumerate(probe)) for i in np.argsort(d)[:4]]
    assert np.mean(met) >= neighbours.TARGET


def test_quality(spark):
    rng = random.Random(5)
    good = lambda: ". ".join(" ".join(rng.choice(["river", "stone", "the", "a", "walks", "softly", "under"]) for _ in range(9)) for _ in range(8)).capitalize()
    bad = lambda: " ".join([rng.choice(["buy", "now"])] * 60)
    docs = [(i, good() if i % 2 else bad()) for i in range(400)] + [(400, None), (401, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(9999, 1)], "doc_id long, quality int")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("vector", F.lit(1)).withColumn("label", F.lit(1))
    rows = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert len(rows) == 402 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    assert np.mean([rows[i].predicted == i % 2 for i in range(400)]) > 0.97
    assert rows[400].score == rows[401].score
    kept = quality.accepted(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, r in rows.items() if r.predicted}
    neutral = quality.classify(df, labels.limit(0)).collect()
    assert {r.score for r in neutral} == {0.5}
    assert quality.classify(df.limit(0), labels).count() == 0


def test_quality_of_few_labels(spark):
    good, bad = "The river walks softly, under a grey stone; {} birds follow it.", "BUY NOW!!! ### {} $$$ BUY"
    docs = spark.createDataFrame([(i, (good if i % 2 else bad).format(i)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    rows = quality.classify(docs, labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in rows)
    one_class = labels.where("quality = 0")
    assert {(r.score, r.predicted) for r in quality.classify(docs, one_class).collect()} == {(0.0, 0)}
    assert quality.accepted(docs, one_class).count() == docs.count()
    assert quality.accepted(docs, one_class).count() == 60
    moments = {c: (1.0, np.full(19, float(c)), np.full((19, 19), float(c))) for c in (0, 1)}
    scores = quality.Discriminant(moments).scores(np.array([[0.0] * 19, [1.0] * 19]))
    assert scores[0] < 0.5 < scores[1]


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = docs.limit(60)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    rows = some.collect()
    best = corpus_pipeline.keep_one_of_each(spark, some.union(some.limit(3)), sf_dir)
    assert best.columns == docs.columns
    want = sorted(k for k, _, c in linked([(r.doc_id, r.text) for r in rows]) if k == c)
    assert ids(best) == want
    lined = corpus_pipeline.drop_lines(spark, some, sf_dir)
    assert lined.columns == docs.columns and all(r.n_chars == len(r.text) for r in lined.collect())
    out = corpus_pipeline.tokens(spark, some, sf_dir)
    assert ids(out) == ids(some) and all(r.n_tokens == len(r.ids) for r in out.collect())
    odd = spark.createDataFrame([(1, None, None, None, None, 5), (None, "", "en", "s", 0, 5)], docs.schema.simpleString()[7:-1].replace(":", " ") + ", extra int")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, sf_dir).count() <= 2
        assert stage(spark, odd.limit(0), sf_dir).count() == 0
