import random
import sys

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from attesta.llm import bpe


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(open(public_tokenizers.path(bpe.VOCABULARY), encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def texts(seed, n=400):
    rng = random.Random(seed)
    pools = ["abcdefghijklmnopqrstuvwxyz     ''", "aA  \n\t\r", "the of and ing tion ", "0123456789 .,;!?", "éèêç  ßü日本語한국어🙂 ", "=-*_#  ", "'sltrevemd "]
    for _ in range(n):
        pool = rng.choice(pools) + (chr(rng.randrange(32, 0x3000)) if rng.random() < 0.3 else "")
        yield "".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 5, 50, 400])))
    yield "a" * 5000
    yield "ab" * 3000 + " " * 700 + "x"
    yield " " * 500
    yield "日本語" * 900
    yield "x<|endoftext|><|endoftext|> y <|endoftext|"


def test_equals_the_library(merges, library):
    coder, decoder = bpe.Encoder(merges), bpe.Decoder(merges)
    for text in texts(1):
        ids = coder.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:80]
        assert decoder.feed(list(map(str, ids))) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_windows_do_not_matter(merges):
    whole = bpe.Encoder(merges)
    for window in (7, 64):
        narrow = bpe.Encoder(merges, window=window, memo=16)
        for text in texts(2, 150):
            assert narrow.encode(text) == whole.encode(text)


def test_transducer_is_exact_and_bounded(merges):
    rng = random.Random(3)
    assert 0 < merges.lookahead < 5000
    for alphabet in ("a", "ab", "the ingand", "=-"):
        data = "".join(rng.choice(alphabet) for _ in range(12 * merges.lookahead)).encode()
        machine, out = bpe.Transducer(merges), []
        for i in range(0, len(data), 13):
            out += machine.feed(data[i : i + 13])
            assert len(machine.held) < 5 * merges.lookahead
        assert out + machine.finish() == merges.merge(data)


def test_pre_tokens_on_every_code_point(merges, library):
    coder = bpe.Encoder(merges)
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for start in range(0, 0x20000, 64):
        text = "".join(f"a{c}1 {c}\n" for c in points[start : start + 64])
        assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids, start


def test_ids_that_are_no_text(merges, library):
    decoder, rng = bpe.Decoder(merges), random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(256) for _ in range(rng.randrange(12))]
        assert decoder.feed(list(map(str, ids))) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_columns(spark):
    shared = bpe.share(spark)
    df = spark.createDataFrame([(1, "the end"), (1, None), (2, "")], "doc_id long, text string")
    coded = df.select("doc_id", bpe.encode_column(shared)("text").alias("ids"))
    assert [r.t for r in coded.select(bpe.decode_column(shared)("ids").alias("t")).collect()] == ["the end", "", ""]
    rows = bpe.encode_decode(df.withColumn("n_tokens", df.doc_id)).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 2]
    assert bpe.encode_decode(df.limit(0)).count() == 0


def test_workers_forget_between_tasks(spark):
    """What a task has memoized goes with it; the vocabulary stays."""
    df = spark.range(40).select(F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" and more")).alias("text"))
    assert df.select(bpe.digests(bpe.share(spark))("text").alias("c")).agg(F.sum("c.n_tokens")).first()[0] > 40

    def held(batches):
        for _ in batches:
            from attesta.llm import bpe

            yield pa.RecordBatch.from_pydict({"n": [len(e.memo) + len(e.older) for e, _ in bpe._loaded.values()]})

    told = [r.n for r in spark.range(64, numPartitions=16).mapInArrow(held, "n long").collect()]
    assert told and not any(told)
