import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def runs(text, orders):
    words = WORD.findall(low(text))
    return [" ".join(words[i : i + n]) for n in range(orders[0], orders[1] + 1) for i in range(len(words) - n + 1)], len(words)


def brute(docs, target, orders=(1, 1), buckets=R.BUCKETS, percent=10):
    place = lambda x: zlib.crc32(x.encode()) % buckets
    corpus, goal = (Counter(place(x) for _, text in rows for x in runs(text, orders)[0]) for rows in (docs, target))
    s, t = sum(corpus.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets))))
    out = []
    for key, text in docs:
        own, n = runs(text, orders)
        weight = sum(gain(place(x)) for x in own)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    open_ = sorted((r for r in out if r[5] >= R.LEAST_WORDS), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for i, r in enumerate(open_[: percent * len(open_) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    words = ["Alpha", "beta7", "ÄRGER", "straße", "x", "Zeta"] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(300)]
    docs += [(7, docs[7][1]), (None, docs[3][1]), (None, docs[5][1] + " " + "long tail " * 20), (400, None), (401, ""), (402, "a-b_c " * 4000), (-3, "w1 " * 25)]
    return docs, [(0, "alpha beta7 " * 30 + "straße w3 w4"), (1, None)]


@pytest.mark.parametrize(("orders", "percent"), [((1, 1), 10), ((1, 1), 100), ((1, 3), 30)])
def test_as_brute_force(spark, corpus, orders, percent):
    docs, target = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"rank": F.lit("other"), "key": F.lit(1)})
    t = spark.createDataFrame(target, "item_id long, text string")
    assert got(R.resample(d, t, orders=orders, percent=percent)) == brute(docs, target, orders, percent=percent)


def test_equal_rows_at_the_edge(spark):
    docs = [(1, "same words " * 20)] * 40 + [(2, "other words here " * 20)] * 10
    out = got(R.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")))
    assert sorted(r[4] for r in out if r[4]) == [1, 2, 3, 4, 5]
    assert {r[0] for r in out if r[4]} == {r[0] for r in brute(docs, []) if r[4]}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert got(R.resample(none, none)) == []


def test_selection_takes_the_kth_key(spark):
    rng = np.random.default_rng(2)
    rows = [(int(a), int(b)) for a, b in zip(rng.integers(-4, 4, 500), rng.integers(-(1 << 62), 1 << 62, 500), strict=True)] + [(0, 5)] * 30 + [((1 << 63) - 1, -(1 << 63)), (-(1 << 63), 0)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(4)
    for k in (1, 2, 77, 250, 270, len(rows) - 1, len(rows)):
        edge = R.kth(df, ["a", "b"], k, digit=5)
        want = sorted(rows)[k - 1]
        assert tuple(edge) == want[: len(edge)]
        assert df.where(R.up_to(["a", "b"], edge)).count() == sum(r <= want for r in rows)


def test_pieces_cut_between_words():
    raw = ("Wörter und " + "x" * 50 + " ende-A ").encode() * 20
    assert [w for p in R.pieces(raw, 16) for w in p] == raw.translate(R.FOLD).split()
    assert list(R.pieces(b"", 4)) == []
