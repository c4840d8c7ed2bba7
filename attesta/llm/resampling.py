"""Target-distribution importance resampling: documents drawn in proportion to how much likelier a target makes their n-grams.

Each n-gram falls into one of ``buckets``. What the corpus and the target hold of each bucket gives its gain, the logarithm of
the smoothed ratio in thousandths; a document's weight is the sum of the gains of its n-grams, read from one array. With Gumbel
noise derived from the key the greatest scores are a draw without replacement. The k-th greatest composite key (score, then key)
is found exactly by distributed radix selection: rows are counted by the next DIGIT bits of the key's column where they lie, the digit
that holds the k-th row is the prefix of the next round, and no row is moved. Only the drawn rows are then dealt by range, sorted where
they arrive and ranked by the offset of their partition.

Null and empty texts have no features: weight 0. Texts are cut in pieces of PIECE bytes between words, so that memory does not grow
with a text. A null key draws noise as an empty one does and ranks after all others of its score; repeated rows take part
each, and of equal ones at the edge as many are drawn as the number asks for. Empty tables give an empty result or, for the target,
gains of an empty target. Other columns are not read. The key is a long.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import releasing, release, scratch, small_batches, stored, table
from .licenses import FOLD

BUCKETS, SEED = 10_000, 2024
LEAST_WORDS, PERCENT = 20, 10
#: Bits of a round of the selection: 2 ** DIGIT counts at most reach the driver.
DIGIT = 12
PIECE, KNOWN = 1 << 20, 200_000
_SIGN, LAST = 1 << 63, (1 << 63) - 1


def pieces(raw: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased A-Z, in lists of some ``size`` bytes."""
    at = 0
    while at < len(raw):
        end, part = at + size, raw[at : at + size].translate(FOLD)
        if end < len(raw) and (cut := part.rfind(b" ")) < 0:  # a word longer than a piece
            while end < len(raw) and FOLD[raw[end]] != 32:
                end += 1
            part = raw[at:end].translate(FOLD)
        elif end < len(raw):
            part, end = part[:cut], at + cut + 1
        yield part.split()
        at = end


def grams(raw: bytes, orders: tuple[int, int] = (1, 1)) -> Iterator[list[bytes]]:
    """All runs of orders[0] to orders[1] words, joined by a space, in lists."""
    before: list[bytes] = []
    for words in pieces(raw):
        run = before + words
        for n in range(orders[0], orders[1] + 1):
            own = run[max(0, len(before) - n + 1) :]
            yield own if n == 1 else [b" ".join(x) for x in zip(*(own[i:] for i in range(n)), strict=False)]
        before = run[len(run) - orders[1] + 1 :] if orders[1] > 1 else []


class Lookup(dict):
    """Values by n-gram, through its bucket; forgets all when KNOWN are held."""

    def __init__(self, values: list):
        super().__init__()
        self.values_of = values

    def __missing__(self, gram: bytes):
        if len(self) >= KNOWN:
            self.clear()
        value = self[gram] = self.values_of[zlib.crc32(gram) % len(self.values_of)]
        return value


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, orders: tuple[int, int] = (1, 1)) -> np.ndarray:
    """n-grams by bucket over all rows; each task brings one row for each bucket it met."""

    def count(batches):
        total, seen = np.zeros(buckets, np.int64), Counter()

        def settle():
            if seen:
                np.add.at(total, np.fromiter((zlib.crc32(x) % buckets for x in seen), np.int64, len(seen)), np.fromiter(seen.values(), np.int64, len(seen)))
                seen.clear()

        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()):
                for run in grams(raw.as_py() or b"", orders):
                    seen.update(run)
                    if len(seen) > KNOWN:
                        settle()
        settle()
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in df.select(text).mapInArrow(releasing(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one for each bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    buckets, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return [math.floor(1000 * math.log((float(b) + 1) * float(s + buckets) / ((float(a) + 1) * float(t + buckets)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)]


WEIGHED = "struct<n_words:bigint,n_features:bigint,weight:bigint>"


def weighed(spark: SparkSession, values: list[int], orders: tuple[int, int] = (1, 1)):
    """A UDF: text -> WEIGHED."""
    shared = spark.sparkContext.broadcast(values)

    @F.arrow_udf(WEIGHED)
    def run(texts: pa.Array) -> pa.Array:
        lookup, rows = Lookup(shared.value), []
        for raw in texts.cast(pa.binary()):
            text = raw.as_py() or b""
            own = [(len(x), sum(map(lookup.__getitem__, x))) for x in grams(text, orders)]
            n = sum(x for x, _ in own)
            rows.append((n if orders == (1, 1) else sum(map(len, pieces(text))), n, sum(x for _, x in own)))
        out = pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["n_words", "n_features", "weight"])
        release()
        return out

    return run


def noise(key: Column, seed: int = SEED) -> Column:
    """floor(1000 x Gumbel), from the key alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _unsigned(name: str) -> Column:
    return F.col(name).bitwiseXOR(F.lit(-_SIGN).cast("long"))


def kth(rows: DataFrame, keys: list[str], k: int, digit: int = DIGIT) -> list[int]:
    """The k-th least composite key (from 1) of ``rows``, by radix selection over the bits of the long columns ``keys``; shorter than ``keys``
    if all rows up to its last value are among the first k."""
    found: list[int] = []
    for name in keys:
        ends = rows.agg(F.min(name).alias("low"), F.max(name).alias("high")).first()
        low, high = ends.low + _SIGN, ends.high + _SIGN
        while low != high:
            shift = max(0, (low ^ high).bit_length() - digit)
            held = rows.where(F.col(name).between(low - _SIGN, high - _SIGN))
            digits = F.shiftrightunsigned(_unsigned(name), shift).bitwiseAND(F.lit((1 << digit) - 1).cast("long"))
            counts = held.groupBy(digits.alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).collect()
            for r in sorted(counts, key=lambda r: r.low):
                if k <= r.n:
                    low, high = r.low + _SIGN, r.high + _SIGN
                    if k == r.n:
                        return [*found, r.high]
                    break
                k -= r.n
        found.append(low - _SIGN)
        rows = rows.where(F.col(name) == found[-1])
    return found


def up_to(keys: list[str], edge: list[int]) -> Column:
    """Composite keys not greater than ``edge``."""
    out = F.col(keys[len(edge) - 1]) <= edge[-1]
    for name, value in reversed(list(zip(keys, edge[:-1], strict=False))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def ranked(rows: DataFrame, keys: list[str], name: str = "rank") -> DataFrame:
    """``rows``, read from a stored table, with their rank by ``keys``, from 1: dealt by range, sorted within partitions, numbered by the partition's offset. Equal rows are
    told apart by where they lie, so that many of them do not meet in one task."""
    spark = rows.sparkSession
    tie = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    dealt = rows.select("*", tie.alias("__tie")).repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie")
    own = F.monotonically_increasing_id()
    sorted_ = stored(dealt.drop("__tie").select("*", F.shiftright(own, 33).cast("int").alias("__part"), own.bitwiseAND(F.lit((1 << 33) - 1)).alias("__nth")), "ranked", outer=True)
    offsets, before = [], 0
    for r in sorted(sorted_.groupBy("__part").count().collect(), key=lambda r: r[0]):  # one for each partition
        offsets.append((r[0], before))
        before += r[1]
    offset = F.broadcast(spark.createDataFrame(offsets, "__part int, __offset long"))
    return sorted_.join(offset, "__part").withColumn(name, F.col("__offset") + F.col("__nth") + 1).drop("__part", "__nth", "__offset")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", orders: tuple[int, int] = (1, 1), buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_features, weight, score, rank): of the documents with ``least_words`` the ``percent`` with the greatest scores are ranked, the others' rank is
    null."""
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    values = gains(bucket_counts(own, "text", buckets, orders), bucket_counts(target, text, buckets, orders))
    found = own.select("key", weighed(spark, values, orders)("text").alias("w")).select("key", "w.*")
    with scratch(spark):
        score = F.col("weight") + noise(F.col("key"), seed)
        scored = stored(found.select("key", "n_features", "weight", score.alias("score"), (F.col("n_words") >= least_words).alias("open")), "scored", outer=True)
        keyed = scored.select("*", (-F.col("score")).alias("down"), F.coalesce("key", F.lit(LAST)).alias("up"))
        open_, keys = keyed.where("open"), ["down", "up"]
        k = open_.count() * percent // 100
        last = F.lit(None).cast("long").alias("rank")
        out = [F.col("key").alias(key), "n_features", "weight", "score"]
        if not k:
            return scored.select(*out, last)
        drawn = F.col("open") & up_to(keys, kth(open_, keys, k))
        first = ranked(keyed.where(drawn), keys)
        return keyed.where(~drawn).select(*out, last).unionByName(first.select(*out, F.when(F.col("rank") <= k, F.col("rank")).alias("rank")))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
