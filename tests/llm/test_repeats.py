import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import anchors, repeats


def brute(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            seen.setdefault(t[s : s + length], []).append((i, s))
    cover = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                cover[i][s : s + length] = b"\1" * length
    out = []
    for t, c in zip(texts, cover, strict=True):
        kept = bytes(b for b, x in zip(t, c, strict=True) if not x)
        spans = sum(1 for i, x in enumerate(c) if x and (i == 0 or not c[i - 1]))
        out.append((len(t), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=40):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("ab cdé") for _ in range(k))
    passages = [word(rng.randrange(10, 60)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            kind = rng.randrange(4)
            if kind == 1:
                at = rng.randrange(len(p))
                p = p[:at] + "X" + p[at + 1 :]
            elif kind == 2:
                p = p[rng.randrange(5) : len(p) - rng.randrange(5)]
            parts += [p, word(rng.randrange(12))]
        texts.append("".join(parts))
    return [*texts, texts[0], texts[3], "a" * 90, "ab" * 60, "ab" * 60 + "c", "", None]


@pytest.mark.parametrize(("length", "k", "hot"), [(20, 10, 1000), (20, 7, 1000), (20, 10, 2), (33, 20, 1000)])
def test_equals_brute_force(spark, length, k, hot):
    texts = corpus(length + k + hot)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("cls", F.lit("x")).withColumn("a", F.lit(1))
    got = repeats.without_repeats(df, length=length, k=k, hot=hot, batch_bytes=500).orderBy("doc_id").collect()
    want = brute([(t or "").encode() for t in texts], length)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want


@pytest.mark.parametrize(("hot", "crowd"), [(50, 1 << 20), (400, 100), (50, 40), (3, 1)])
def test_one_anchor_with_most_surroundings(spark, hot, crowd):
    """A gram that stands in many texts amid other bytes: split by content, then by hashes where a half is shared as well."""
    rng = random.Random(hot)
    noise = lambda n: "".join(rng.choice("etaoin") for _ in range(n))
    gram, half = noise(24), noise(12)
    texts = [noise(rng.randrange(30)) + gram + noise(rng.randrange(30)) for _ in range(600)]
    texts += [noise(rng.randrange(9)) + gram + half + noise(rng.randrange(30)) for _ in range(150)]
    texts += [noise(rng.randrange(20)) + half + gram + rng.choice("etaoin") * rng.randrange(9) for _ in range(60)]
    texts += texts[:20] + [t[3:] + "x" for t in texts[600:640]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.without_repeats(df, length=40, k=20, hot=hot, crowd=crowd).orderBy("doc_id").collect()
    want = brute([t.encode() for t in texts], 40)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want
    assert sum(r.n_removed > 0 for r in got) > 60


def test_runs(spark):
    rng = random.Random(5)
    for _ in range(200):
        pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 6))]
        symbols = np.concatenate([[*(b + 1 for b in p), 0] for p in pieces])
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        piece = np.repeat(np.arange(len(pieces)), [len(p) + 1 for p in pieces])
        least = rng.randrange(1, 8)
        order, run = repeats.runs_with_common_prefix(symbols, piece, ends, least)
        text = [(pieces[piece[i]] + b"\0")[i - (ends[piece[i]] - len(pieces[piece[i]])) :] for i in range(len(symbols))]
        assert [text[i] for i in order] == sorted(text)
        for a, b, x, y in zip(order, order[1:], run, run[1:], strict=False):
            common = min(len(text[a]), len(text[b]), least)
            same = text[a][:common] == text[b][:common] and common == least and b"\0" not in text[a][:common]
            assert same == (x == y)


def test_copies_select_the_same_anchors():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 4, 60).astype(np.uint8)
    for _ in range(50):
        raw = np.concatenate((rng.integers(0, 4, rng.integers(0, 80)), shared, rng.integers(0, 4, rng.integers(0, 80)))).astype(np.uint8)
        at = anchors.anchors(anchors.Grams(raw), len(raw), 10, 30)
        start = next(i for i in range(len(raw)) if (raw[i : i + 60] == shared).all())
        inner = {int(a - start) for a in at if 20 <= a - start <= 30}
        alone = {int(a) for a in anchors.anchors(anchors.Grams(shared), 60, 10, 30) if 20 <= a <= 30}
        assert inner == alone
        assert all(any(s <= a <= s + 20 for a in at) for s in range(len(raw) - 29))


def test_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("texts", [
    ["xy" * 9 + "Q", "prefix " + "xy" * 9 + "R"], ["abcd" * 7 + "e" + "abcd" * 7], ["ab" * 25, "ab" * 25 + "c"], ["a" * 19, "a" * 20, "a" * 21],
    ["--" * 12 + "q" + "-" * 14, "z" + "-" * 13], ["x" * 30 + "y" * 30 + "x" * 25], ["=" * 24 + "title" + "=" * 24 + "body" + "=" * 18],
])
@pytest.mark.parametrize("k", [7, 10])
def test_periodic_texts(spark, texts, k):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.without_repeats(df, length=20, k=k).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute([t.encode() for t in texts], 20)


def test_production_length_with_periodic_and_long_texts(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = prose(90)
    texts = [prose(60) + "-" * rng.randrange(200, 700) + prose(40) for _ in range(12)]
    texts += [prose(30) + "ab| " * rng.randrange(40, 160) + prose(30) for _ in range(12)]
    texts += [prose(5) + shared[rng.randrange(40) :] + prose(9) for _ in range(5)] + [prose(30_000) + shared]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, shared), (None, shared)], "doc_id long, text string")
    got = repeats.without_repeats(df).collect()
    want = brute([t.encode() for t in [*texts, shared, shared]], repeats.LENGTH)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
