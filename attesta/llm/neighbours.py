"""Approximate nearest neighbours by multiprobe p-stable hashing (Euclidean distance).

Each of TABLES tables concatenates M hashes floor((a·v + b) / w) with normal a. A query visits, in each table, its own bucket and
perturbed ones, in the order of their estimated success: the sum of squared distances from the query's projections to
the boundaries that a perturbation crosses, enumerated least first from a heap. Candidates of all tables are merged and
reranked by exact distances in double precision.

M starts at half the logarithm of the number of vectors. The number of probes is calibrated: in a sample of at most SAMPLE vectors, at which
probe would a query's true neighbours be found? It is the TARGET quantile, and M falls until that needs at most PROBES
probes; if it does not with M = 1, all queries are compared with all classes. (Neighbours in the whole table are nearer than in the sample, so the target is a cautious one.) Every vector is indexed in every table.

Equal vectors are one class, indexed once; a class keeps its k + 1 smallest ids, since no query can need more of it, found
with a limit before the shuffle. So copies, however many, make no hot bucket. Buckets have no caps: buckets are dealt into
parts of about PART_ROWS rows, and if one bucket alone is larger, all parts are split by id into as many slices as it needs, each of which
gets the queries. Only ids and distances are shuffled after that, at most k + 1 for each query and part.

A query whose buckets hold fewer than k candidates, though there are more, or whose neighbours found lie further off than is usual in the
sample, is compared with all classes, in blocks of ASKERS queries by part.

Vectors that are null, empty, zero or hold null or non-finite components, and those without an id, take no part. Other columns are not read, so their names cannot
clash; a long vector takes its length times the tables in memory, in bounded parts. Vectors of different lengths never meet.
Repeated rows (same id, same vector) count once; an id with several vectors has each as a row. Fewer candidates give fewer
ranks, ties go to smaller ids, an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small_batches, stored, table

TABLES, PROBES, SAMPLE, SAMPLE_QUERIES, TARGET, SEED = 16, 320, 20_000, 160, 0.985, 20240607
#: Bucket width in units of the projections' standard deviation; index rows in a part.
WIDTH, PART_ROWS = 1.5, 40_000
#: The share of the sample whose last neighbours lie within what counts as usual.
USUAL = 0.95
#: Queries in a block of the exact search.
ASKERS = 1_000


class Hashing:
    def __init__(self, m: int, width: float, tables: int = TABLES, probes: int = PROBES):
        self.m, self.width, self.tables, self.probes, self.sure, self.reach = m, width, tables, probes, True, math.inf
        self._made: dict[int, tuple] = {}

    def lines(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if dim not in self._made:
            rng = np.random.default_rng([SEED, dim])
            self._made[dim] = rng.standard_normal((self.tables * self.m, dim)), rng.random(self.tables * self.m), rng.integers(1, 1 << 62, (self.tables * self.m,)) * 2 + 1
        return self._made[dim]

    def project(self, x: np.ndarray) -> np.ndarray:
        a, b, _ = self.lines(x.shape[1])
        return (x @ a.T / self.width + b).reshape(len(x), self.tables, self.m)

    def keys(self, cells: np.ndarray, dim: int, tables: np.ndarray) -> np.ndarray:
        """64-bit bucket keys; cells: (n, m) of the given tables."""
        mix = self.lines(dim)[2].reshape(self.tables, self.m)[tables].astype(np.uint64)
        h = (cells.astype(np.int64).astype(np.uint64) * mix).sum(1, dtype=np.uint64) + (tables.astype(np.uint64) + np.uint64(dim) * np.uint64(1009)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(29))).astype(np.int64)

    def index(self, x: np.ndarray) -> np.ndarray:
        cells = np.floor(self.project(x)).reshape(-1, self.m)
        return self.keys(cells, x.shape[1], np.tile(np.arange(self.tables), len(x))).reshape(len(x), self.tables)

    def probe(self, x: np.ndarray) -> list[list[np.ndarray]]:
        """For each query, by table, the keys of its buckets in the order of estimated success."""
        out = []
        for row in self.project(x):
            own = []
            for t in range(self.tables):
                base = np.floor(row[t])
                cells = base + self._perturbations(row[t] - base)
                own.append(self.keys(cells, x.shape[1], np.full(len(cells), t)))
            out.append(own)
        return out

    def _perturbations(self, inside: np.ndarray) -> np.ndarray:
        """The unperturbed cell and up to ``probes`` - 1 perturbations, least cost first; rows of -1, 0, 1."""
        steps = sorted([(d * d, i, -1) for i, d in enumerate(inside.tolist())] + [((1 - d) ** 2, i, 1) for i, d in enumerate(inside.tolist())])
        out, heap = [()], [(steps[0][0], (0,))]
        while heap and len(out) < self.probes:
            total, chosen = heapq.heappop(heap)
            last = chosen[-1]
            if last + 1 < len(steps):
                more = total + steps[last + 1][0]
                heapq.heappush(heap, (more - steps[last][0], (*chosen[:-1], last + 1)))
                heapq.heappush(heap, (more, (*chosen, last + 1)))
            if len({steps[i][1] for i in chosen}) == len(chosen):
                out.append(chosen)
        changes = np.zeros((len(out), self.m))
        for row, chosen in zip(changes, out, strict=True):
            for i in chosen:
                row[steps[i][1]] = steps[i][2]
        return changes


def _by_length(vectors: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each vector length."""
    sizes = np.array([len(v) for v in vectors], int)
    return [(at, np.array([vectors[i] for i in at], float)) for at in (np.flatnonzero(sizes == d) for d in np.unique(sizes))]


def hashing_for(classes: DataFrame, n: int, k: int, tables: int = TABLES, probes: int = PROBES, target: float = TARGET) -> Hashing:
    """M, w and the number of probes, from the number of classes and a bounded sample of vectors."""
    drawn = classes.select("vector") if n <= SAMPLE else classes.orderBy(F.xxhash64("id", "vector")).limit(SAMPLE).select("vector")
    groups = _by_length([r.vector for r in drawn.toLocalIterator()])
    if not groups:
        return Hashing(1, 1.0, tables, 1)
    x = max((g[1] for g in groups), key=len)
    rng = np.random.default_rng(SEED)
    width = WIDTH * max(float((x @ rng.standard_normal((x.shape[1], 32))).std(0).mean()), 1e-12)
    asked = rng.permutation(len(x))[:SAMPLE_QUERIES]
    near, last = [], []
    for q in asked:
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        near.append(np.argsort(d)[: min(k, len(x) - 1)])
        last += [math.sqrt(d[i]) for i in near[-1][-1:]]
    for m in range(max(1, min(round(math.log2(max(2, n)) / 2), 16)), 0, -1):
        hashing = Hashing(m, width, tables, probes)
        found = []
        for q, own in zip(asked, near, strict=True):
            if len(own):
                wanted, at = hashing.index(x[own]), np.full(len(own), probes + 1)
                for t, keys in enumerate(hashing.probe(x[q : q + 1])[0]):
                    place = {key: i for i, key in reversed(list(enumerate(keys.tolist())))}
                    at = np.minimum(at, [place.get(w, probes + 1) for w in wanted[:, t].tolist()])
                found.extend(at.tolist())
        need = int(np.quantile(found, target, method="higher")) if found else 0
        if need < probes or m == 1:
            hashing.probes, hashing.sure = min(probes, need + 1), need < probes
            hashing.reach = float(np.quantile(last, USUAL, method="lower")) * (1 + 1e-9) if last else math.inf
            return hashing


def _met(buckets: np.ndarray, ids: np.ndarray, vectors: np.ndarray, asked: list[tuple[int, np.ndarray, np.ndarray]], k: int):
    """(asker, class, score): the k nearest of each query among the vectors in its buckets; vectors and queries of one length."""
    order = np.argsort(buckets, kind="stable")
    sorted_buckets = buckets[order]
    for asker, q, own in asked:
        low, high = np.searchsorted(sorted_buckets, own), np.searchsorted(sorted_buckets, own, side="right")
        rows = [order[a:b] for a, b in zip(low, high, strict=True) if b > a]
        if not rows:
            continue
        rows = np.concatenate(rows)
        _, first = np.unique(ids[rows], return_index=True)
        rows = rows[first]
        score = np.sqrt(((vectors[rows] - q) ** 2).sum(1))
        if len(rows) > k:
            keep = score <= np.partition(score, k - 1)[k - 1]
            rows, score = rows[keep], score[keep]
        for i in np.lexsort((ids[rows], score))[:k]:
            yield asker, int(ids[rows[i]]), float(score[i])


def nearest(df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, part_rows: int = PART_ROWS, **options) -> DataFrame:
    """(query_id, rank, key, score): for each row of ``queries`` its k nearest rows of ``df`` found, other than those of its own id."""
    spark = df.sparkSession
    small_batches(spark, 2048)
    v = F.col("vector")
    usable = F.col("id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")).where(usable)
    asked = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")).where(usable)
    few = W.partitionBy("vector").orderBy("id")
    members = rows.select("id", "vector", F.dense_rank().over(few).alias("nth")).where(F.col("nth") <= k + 1).distinct()
    members = stored(members.select("id", "vector", "nth", F.min("id").over(W.partitionBy("vector")).alias("class")), "members")
    classes = members.where("nth = 1").select("id", "vector")
    asked = asked.distinct()
    askers = stored(asked.join(asked.groupBy("vector").agg(F.min("id").alias("asker")), "vector").select("id", "vector", "asker"), "askers")
    n = classes.count()
    hashing = hashing_for(classes, n, k, **options)
    kind = df.schema[vector].dataType.simpleString()

    def indexed(batches):
        for batch in batches:
            vectors, many = batch.column(1), hashing.tables
            keys = np.empty((len(batch), many), np.int64)
            for at, x in _by_length(vectors.to_pylist()):
                keys[at] = hashing.index(x)
            again = pa.array(np.repeat(np.arange(len(batch)), many))
            yield pa.record_batch([batch.column(0).take(again), vectors.take(again), pa.array(keys.ravel())], ["id", "vector", "bucket"])

    index = classes.mapInArrow(indexed, f"id long, vector {kind}, bucket long")
    largest = index.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    slices = max(1, math.ceil(largest / part_rows))
    parts = max(1, math.ceil(n * hashing.tables / part_rows / slices))

    def probed(batches):
        for batch in batches:
            out = []
            vectors = batch.column(1).to_pylist()
            for at, x in _by_length(vectors):
                for i, keys in zip(at, hashing.probe(x), strict=True):
                    keys = np.unique(np.concatenate(keys))
                    part = keys % parts
                    for p in np.unique(part):
                        out.extend((int(p), s, i, keys[part == p]) for s in range(slices))
            take = pa.array([o[2] for o in out], pa.int64())
            yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), batch.column(0).take(take), batch.column(1).take(take), pa.array([o[3] for o in out], pa.list_(pa.int64()))], ["part", "slice", "asker", "q", "buckets"])

    probes = askers.select("asker", "vector").dropDuplicates(["asker"]).mapInArrow(probed, f"part long, slice long, asker long, q {kind}, buckets array<bigint>")

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        buckets, ids = left["bucket"].to_numpy(), left["id"].to_numpy()
        asking = list(zip(right["asker"].to_pylist(), map(np.array, right["q"].to_pylist()), map(np.array, right["buckets"].to_pylist()), strict=True))
        if len(ids) and asking:
            for at, x in _by_length(left["vector"].to_pylist()):
                out.extend(_met(buckets[at], ids[at], x, [a for a in asking if len(a[1]) == x.shape[1]], k + 1))
        return pa.table({"asker": pa.array([o[0] for o in out], pa.int64()), "class": pa.array([o[1] for o in out], pa.int64()), "score": pa.array([o[2] for o in out], pa.float64())})

    dealt = index.select("id", "vector", "bucket", F.pmod("bucket", F.lit(parts)).alias("part"), F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice"))
    scored = dealt.groupBy("part", "slice").cogroup(probes.groupBy("part", "slice")).applyInArrow(met, "asker long, class long, score double")

    def best_of(scored: DataFrame) -> DataFrame:
        best = scored.groupBy("asker", "class").agg(F.min("score").alias("score"))
        return best.select("*", F.row_number().over(W.partitionBy("asker").orderBy("score", "class")).alias("n")).where(F.col("n") <= k + 1).select("asker", "class", "score")

    def pairs_of(best: DataFrame) -> DataFrame:
        found = best.join(members.select("class", F.col("id").alias("member")), "class")
        return askers.select(F.col("id").alias("query_id"), "asker").join(found, "asker").where("query_id <> member")

    best = stored(best_of(scored), "best")
    size = F.size("vector").alias("size")
    got = pairs_of(best).groupBy(F.col("query_id").alias("id"), "asker").agg(F.count(F.lit(1)).alias("got"), F.max("score").alias("worst"))
    short = askers.join(got, ["id", "asker"], "left").select("id", "asker", "vector", size, F.coalesce("got", F.lit(0)).alias("got"), "worst").where((F.col("got") < k) | (F.col("worst") > hashing.reach))
    own = members.groupBy("id", size).agg(F.count(F.lit(1)).alias("own"))
    total = members.groupBy(size).agg(F.count(F.lit(1)).alias("total"))
    short = short.join(own, ["id", "size"], "left").join(total, "size").where(F.col("got") < F.col("total") - F.coalesce("own", F.lit(0)))
    short = stored((short if hashing.sure else askers).select("asker", "vector").dropDuplicates(["asker"]), "short")
    many = short.count()
    if many:
        blocks, spans = math.ceil(many / ASKERS), math.ceil(n / part_rows)
        left = classes.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(spans)).alias("slice"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        right = short.select("asker", F.col("vector").alias("q"), F.pmod(F.xxhash64("asker"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(spans - 1))).alias("slice"))

        def compared(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            if len(left) and len(right):
                ids = left["id"].to_numpy()
                everywhere = np.zeros(1, np.int64)
                asking = [(asker, np.array(q, float), everywhere) for asker, q in zip(right["asker"].to_pylist(), right["q"].to_pylist(), strict=True)]
                for at, x in _by_length(left["vector"].to_pylist()):
                    out.extend(_met(np.zeros(len(at), np.int64), ids[at], x, [a for a in asking if len(a[1]) == x.shape[1]], k + 1))
            return pa.table({"asker": pa.array([o[0] for o in out], pa.int64()), "class": pa.array([o[1] for o in out], pa.int64()), "score": pa.array([o[2] for o in out], pa.float64())})

        exact = left.groupBy(F.col("block").cast("long"), F.col("slice").cast("long")).cogroup(right.groupBy(F.col("block").cast("long"), F.col("slice").cast("long"))).applyInArrow(compared, "asker long, class long, score double")
        best = best_of(best.union(exact))
    pairs = pairs_of(best).select("query_id", F.col("member").alias(key), "score")
    order = W.partitionBy("query_id").orderBy("score", key)
    return pairs.select("query_id", F.row_number().over(order).alias("rank"), key, "score").where(F.col("rank") <= k)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))
