import hashlib
import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from attesta.operators import saved, search
from attesta.operators.constraints import ConstraintError


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "aeiou" for c in "lmnr"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.choice([2, 3, 5, 9, 30, 200]))), rng.choice([None, "side note", words[i % len(words)]])) for i in range(n)]


SCHEMA = "id long, title string, body string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(400), SCHEMA).cache()


def made(spark, docs, folder):
    return saved.Saved(spark, f"{folder}/index", ["title", "body"], 4, 16).create(search.Index.build(docs, "id", ["title", "body"]))


@pytest.fixture(scope="module")
def kept(spark, docs, tmp_path_factory):
    return made(spark, docs, tmp_path_factory.mktemp("kept"))


@pytest.fixture
def index(spark, kept, tmp_path):
    shutil.copytree(kept.path, f"{tmp_path}/index")
    return saved.Saved(spark, f"{tmp_path}/index", ["title", "body"], 4, 16)


def rows(df):
    return sorted((r.doc, round(r.score, 9), r.terms) for r in df.collect())


def marks(path):
    return {f"{d}/{f}": hashlib.sha256(open(f"{d}/{f}", "rb").read()).hexdigest() for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


ASKED = [("aal bam", {}), ("aal", {"prefix": True}), ("bamx note", {"fuzzy": 2}), ("aal bam car", {"combine": "AND"}), ("side", {"fields": ["body"]})]


def test_search_as_in_memory(docs, kept):
    whole = search.Index.build(docs, "id", ["title", "body"])
    for query, options in ASKED:
        assert rows(kept.search(query, **options)) == rows(search.search(whole, query, **options))
    assert rows(kept.search("zzz")) == [] == rows(kept.search(" "))


def test_only_the_terms_files_are_read(spark, kept):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    narrow, bounds = kept.narrowed("aal")
    own = spark.createDataFrame([("aal",)], "term string").select(saved.bucket_of("term", buckets=4)).first()[0]
    for df in (narrow.postings, bounds):
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())
        assert any(re.search(rf"bucket#\d+ (IN \({own}\)|= {own}\b)", f) for f in filters)


def test_additions_leave_files_alone(spark, docs, index):
    before = marks(index.path)
    new = spark.createDataFrame([(3, "aal aal bam", None), (9_000, "aal fresh words", "bam"), (5, None, None)], SCHEMA)
    index.add(new, "id")
    index.remove(spark.createDataFrame([(7,), (8,), (123456,)], "doc long"))
    after = marks(index.path)
    assert {k: after[k] for k in before} == before and len(after) > len(before)
    want = docs.where(~F.col("id").isin(3, 5, 7, 8, 9_000)).union(new)
    whole = search.Index.build(want, "id", ["title", "body"])
    for query, options in ASKED:
        assert rows(index.search(query, **options)) == rows(search.search(whole, query, **options))
    again = saved.Saved(spark, index.path, ["title", "body"], 4, 16)
    assert rows(again.search("fresh")) == rows(search.search(whole, "fresh")) and len(again.generations()) == 3
    assert [round(r.score, 9) for r in again.top("aal bam", 7).hits.collect()] == [round(r.score, 9) for r in search.ranked(search.search(whole, "aal bam"), 7).collect()]


def test_a_failed_addition_is_not_seen(spark, index, monkeypatch):
    want = rows(index.search("aal"))
    with monkeypatch.context() as m:
        m.setattr(index, "_commit", lambda g: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.add(spark.createDataFrame([(9_001, "aal", None)], SCHEMA), "id")
    assert rows(index.search("aal")) == want and len(index.generations()) == 1
    index.add(spark.createDataFrame([(9_002, "fresh", None)], SCHEMA), "id")
    assert [r[0] for r in rows(index.search("fresh"))] == [9_002] and 9_001 not in {r[0] for r in rows(index.search("aal"))}
    with pytest.raises(ConstraintError, match="meanwhile"):
        index._commit(index.generations()[-1])


def test_edges(spark, index):
    with pytest.raises(ConstraintError, match="holds an index"):
        index.create(None)
    with pytest.raises(ConstraintError, match="edits"):
        index.search("aal", fuzzy=7)
    with pytest.raises(ConstraintError, match="ids"):
        index.add(spark.createDataFrame([(1, "x", None), (1, "y", None)], SCHEMA), "id")


@pytest.mark.parametrize(("query", "most", "options"), [("aal", 3, {}), ("hor gan", 5, {}), ("aal bam", 10, {"boost": {"body": 3.0}}), ("aa", 4, {"prefix": True}), ("aal bam", 5, {"combine": "AND"}), ("note", 1000, {}), ("aal", 0, {})])
def test_top_is_the_full_ranking(docs, kept, query, most, options):
    whole = search.Index.build(docs, "id", ["title", "body"])
    got = kept.top(query, most, first=2, **options)
    full = search.ranked(search.search(whole, query, **options), most) if most else None
    key = lambda df: [(r.doc, round(r.score, 9)) for r in df.collect()]
    assert key(got.hits) == (key(full) if most else [])
    assert got.read <= got.blocks


def test_blocks_are_skipped(docs, kept):
    got = kept.top("aal", 3, first=2)
    assert 0 < got.read < got.blocks / 2


def test_equal_documents_tie(spark, tmp_path):
    """Documents of equal counts have equal scores, whatever order their matches are added in, so the earliest ones are the best."""
    filler = [(1_000 + i, f"aal bam {'car ' * (i % 3)}bar bem" if i % 2 else "bam cor", None) for i in range(60)]
    docs = spark.createDataFrame([(i, "car aal bam bar bem bam", "bam aal") for i in range(300)] + filler, SCHEMA)
    index = made(spark, docs, tmp_path)
    for query, options in [("aal bam car", {}), ("b", {"prefix": True}), ("bam", {"fuzzy": 1})]:
        hits = search.search(search.Index.build(docs, "id", ["title", "body"]), query, **options).where("doc < 300").cache()
        assert hits.select("score").distinct().count() == 1 and hits.count() == 300
        assert [r.doc for r in search.ranked(hits, 9).collect()] == list(range(9)) == [r.doc for r in index.top(query, 9, **options).hits.collect()]
