"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, in every operator; the pipeline stage by stage."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attesta.llm import bpe, chat, decontamination, jaccard, licenses, lines, neighbours, quality, repeats, sharding

from .test_lines import near
from .test_models import linked

LONG = " ".join(f"word{i * 7919 % 10_007}" for i in range(40_000))
TEXTS = [(1, "One plain text of a few words."), (1, "One plain text of a few words."), (2, None), (None, "a text without a key"), (None, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG + " and more"), (7, "x" * 50_000), (8, "mit"), (9, "под mit license é " * 3)]
CLASH = ("key", "id", "cls", "a", "n", "text_crc32", "label", "vector", "root", "near", "gone", "row", "nth", "token", "marks", "at", "h", "line", "record", "out", "d", "score", "shard", "bucket", "found", "value")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH]).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, 0) for k in range(10)] + [(None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


OPERATORS = {
    "sharding": lambda d, l: sharding.shard(d), "bpe": lambda d, l: bpe.encode_decode(d), "licenses": lambda d, l: licenses.scan(d), "jaccard": lambda d, l: jaccard.near_duplicates(d),
    "repeats": lambda d, l: repeats.without_repeats(d).drop("spans"), "decontamination": lambda d, l: decontamination.contamination(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "quality": lambda d, l: quality.classify(d, l), "lines": lambda d, l: lines.deduplicated(d).select("doc_id", "__lines.*"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(spark, docs, labels, name):
    run = OPERATORS[name]
    out = run(docs, labels)
    got = rows(out)
    assert len(got) == len(TEXTS) and len({r for r in got if r[0] == "1"}) <= (2 if name == "sharding" else 1)  # equal rows alike; slots differ
    assert rows(run(docs.select("doc_id", "text").repartition(1), labels)) == got  # neither extra columns nor partitions matter
    assert run(docs.limit(0), labels).count() == 0


def test_long_texts(docs):
    by = lambda df, *cols: {r.doc_id: tuple(r[c] for c in cols) for r in df.where("doc_id is not null").collect()}
    assert by(jaccard.near_duplicates(docs), "component_id")[6] == (5,)
    removed = by(repeats.without_repeats(docs), "n_bytes", "n_removed")
    assert removed[5] == (len(LONG), len(LONG)) and removed[6][1] >= len(LONG) and removed[7] == (50_000, 50_000)
    hit = by(decontamination.contamination(docs, docs.where("doc_id = 5").select(F.lit(1).alias("item_id"), "text")), "n_words", "n_hit", "contaminated")
    assert hit[5] == (40_000, 40_000, True) and hit[6] == (40_002, 40_000, True) and hit[2] == (0, 0, False)
    assert by(bpe.encode_decode(docs), "decoded_sha256")[5] == (hashlib.sha256(LONG.encode()).hexdigest(),)
    assert by(sharding.shard(docs), "size")[7] == (50_001,)
    assert by(lines.deduplicated(docs).select("doc_id", "__lines.*"), "kept")[6] == (LONG + " and more",)


def test_neighbours_with_clashing_names(spark):
    data = [(i, [float(i), 1.0, 0.5]) for i in range(30)] + [(3, [3.0, 1.0, 0.5]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    more = df.select("*", *[F.lit(1).alias(c) for c in ("id", "bucket", "part", "slice", "asker", "class", "rank", "score", "size")])
    ask = lambda d: rows(neighbours.nearest(d, d.where("vec_id % 10 = 0"), k=3).where("query_id is not null"))
    assert ask(more) == ask(df) and len(ask(df)) == 9


def test_chat_edges(spark):
    long = "word <|im_end|> " * 30_000
    said = [(1, 0, "user", long), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, None, None, "x"), (None, 0, "user", "no key"), (3, 0, "assistant", "")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").select("*", *[F.lit("y").alias(c) for c in ("turns", "record", "key", "out", "schema")])
    got = {r.conv_id: r for r in chat.format_chats(chat.records_of_rows(df), "conv_id", "record").collect()}
    assert set(got) == {1, 2, 3, None}
    assert chat.parse(got[1].formatted) == [("user", long), ("assistant", ""), ("assistant", "")]
    assert chat.format_chats(chat.records_of_rows(df.limit(0)), "conv_id", "record").count() == 0


def plain_scores(texts, labelled, shrinkage=quality.SHRINKAGE, temperature=quality.TEMPERATURE):
    """Quadratic discriminant analysis by the textbook: inverses and determinants."""
    x = np.array([quality.features((t or "").encode()) for t in texts], float)
    learn = np.array([i for i, _ in labelled])
    y = np.array([c for _, c in labelled])
    mean, spread = x[learn].mean(0), np.sqrt(np.maximum(x[learn].var(0), 1e-9))
    z = (x - mean) / spread
    density = []
    for c in (0, 1):
        own = z[learn[y == c]]
        cov = np.cov(own.T, bias=True)
        cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / len(cov), 1e-3) * np.eye(len(cov))
        d = z - own.mean(0)
        density.append(np.log(len(own) / len(learn)) - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1])
    return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / temperature, -30, 30)))


def corpus(seed=3, n=150):
    """Prose, junk, copies, repeated lines and benchmark passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiourstln") for _ in range(rng.randrange(2, 8)))
    prose = lambda k: " ".join(word() for _ in range(k))
    items = [prose(30) for _ in range(5)]
    common = [prose(14) for _ in range(4)]
    texts, good, long = [], [], []
    for i in range(n):
        kind = rng.randrange(8)
        if kind == 0 and long:
            words = list(rng.choice(long))  # two words far apart: no near line, a near document
            words[10 + i % 9], words[80 + i % 9] = word() + "qqqqqq", word() + "qqqqqq"
            texts.append(" ".join(words))
        elif kind == 4:
            long.append(prose(120).split(" "))
            texts.append(" ".join(long[-1]))
        elif kind == 1:
            texts.append(" ".join(rng.choice(["#$%", "!!", "|", "CLICK", "00"]) for _ in range(rng.randrange(30, 90))))
        else:
            parts = [prose(rng.randrange(20, 60)) + ".", prose(rng.randrange(10, 40))]
            if kind == 2:
                parts.append(rng.choice(items))
            if kind == 3:
                changed = rng.choice(common).split(" ")
                changed[3] = word()
                parts += [rng.choice(common), " ".join(changed)]
            rng.shuffle(parts)
            texts.append("\n".join(parts))
        good.append(int(kind != 1))
    return texts, good, items


def test_pipeline_stage_by_stage(spark, tmp_path):
    texts, good, items = corpus()
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(len(texts), None, "en", "s", None), (0, texts[0], "en", "s", len(texts[0]))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept, stages = {}, dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = now.collect()
    held = {r.doc_id for r in spark.range(len(docs)).where(quality.held_out(F.col("id"))).select(F.col("id").alias("doc_id")).collect()}
    at = [i for i, d in enumerate(docs) if d[0] < len(good) and d[0] not in held]
    scores = plain_scores([d[1] for d in docs], [(i, good[docs[i][0]]) for i in at])
    want = sorted((d[0], d[1] or "") for d, s in zip(docs, scores, strict=True) if s >= quality.THRESHOLD)
    assert sorted((r.doc_id, r.text or "") for r in kept["quality"]) == want and len(want) < len(docs)
    got = {r.doc_id: r.score for r in quality.classify(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    assert all(abs(got[d[0]] - s) < 1e-9 for d, s in zip(docs, scores, strict=True))

    alive = dict(want)
    first = {}
    for k, t in sorted(alive.items()):
        for n, line in enumerate(t.split("\n")):
            if len(line) >= lines.MIN_CHARS:
                first.setdefault(line, (k, n))
    lost = {line for line, place in first.items() if any(p < place and abs(len(o) - len(line)) <= 7 and o != line and near(o, line) for o, p in first.items())}
    left = {}
    for k, t in alive.items():
        parts = [x for n, x in enumerate(t.split("\n")) if len(x) < lines.MIN_CHARS or (x not in lost and first[x] == (k, n))]
        if "\n".join(parts).strip() or not t.strip():
            left[k] = "\n".join(parts)
    assert {r.doc_id: r.text or "" for r in kept["line dedup"]} == left and lost
    assert all(r.n_chars == len(r.text) for r in kept["line dedup"] if r.text is not None)

    groups = linked(sorted(left.items()))
    single = {k for k, _, root in groups if k == root}
    assert sorted(r.doc_id for r in kept["near duplicates"]) == sorted(single) and len(single) < len(left)

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    windows = {tuple(w[i : i + 13]) for w in map(words, items) for i in range(len(w) - 12)}

    def share(t):
        w = words(t)
        hit = {j for i in range(len(w) - 12) if tuple(w[i : i + 13]) in windows for j in range(i, i + 13)}
        return bool(hit) and 20 * len(hit) >= len(w)

    clean = {k for k in single if not share(left[k])}
    assert {r.doc_id for r in kept["decontamination"]} == clean and len(clean) < len(single)
    assert {r.doc_id for r in kept["bpe"]} == clean and all(r.n_tokens == len(r.ids) for r in kept["bpe"])
    assert all(r.decoded_sha256 == hashlib.sha256(left[r.doc_id].encode()).hexdigest() for r in kept["bpe"])
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, kept["bpe"])) and len(stages) == 5
    assert corpus_pipeline.run.__module__ == "corpus_pipeline"
