"""N-gram Jaccard join with count-vector R-trees.

A document is its set of distinct 5-word shingles; two link when 100 * |A & B| >= 75 * |A | B|. Equal sets are one class. Each
class has a count vector: its shingles hashed into groups, and how many fall in each. No overlap is more than the sum of the
coordinates' minima, for two vectors or for a vector and the upper corner of an R-tree node.

The trees are local to blocks, so that the join is dealt over the cluster without loss. |A| shingles hold at most |A| // 4 that a partner lacks, so
linked classes share one of each other's first |A| // 4 + 1 shingles in any common order; a block is the classes that have one
shingle among their first. In the order, frequent shingles come last. They are found by counting within windows of
the scan; since they only order, what that count misses costs time, not links. Blocks over SLICE classes are cut in slices.

In a block, classes are packed into an R-tree by size (a block of up to LEAF classes is one leaf); the size bound and the overlap
bound of GROUPS coordinates give surviving pairs. Those are bounded again by finer vectors, of twice as many groups as
shingles or more, and the survivors verified on the whole sets. A star round comes first: in each block, in a drawn order, each class
meets the one with the largest bound among its LEAF neighbours, and of all its blocks the best pair is verified, so that groups of near
copies become few components in linear time. Then all blocks are searched for pairs that the bounds allow and that lie in different components: only
those can still change the result. Of two components one link is enough, so that a search verifies the few pairs of them with the
largest bounds, contracts, and as long as two components have pairs left, searches again among such for 16 times as many, with MIDDLE coordinates. The last search
leaves none out.
In a block of several slices the classes of its most common component lie in one slice each, all others in all. Components come from star contraction.

Null and empty texts, and texts of white space, have no shingles and stay alone (also if equal). Repeated rows are equal sets; rows with
one key and several texts count each text. Keys are integers; a null key is no one's representative unless alone. Sets are told apart
by 128 bits. A text takes a worker some 60 times its bytes, whatever its length. An empty table gives an empty result. Other columns are not read, so
their names cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, releasing, scratch, small_batches, stored, table
from .components import components
from .shingles import mixed, shingle_sets

WORDS, PERCENT, GROUPS, MIDDLE = 5, 75, 64, 256
#: Shingles counted together; the count in such a window, and in all, that makes a shingle frequent; so many are broadcast at most.
WINDOW, OFTEN, FREQUENT, ORDERED = 2_000_000, 2, 8, 500_000
#: Classes in a slice of a block; ids broadcast at most; fan-out of a tree; classes in a leaf; parts of a frequent shingle.
SLICE, BROADCAST_IDS, FAN, LEAF, SALTS = 20_000, 500_000, 16, 64, 64
#: Pairs of two components that the first search tells; what _blocks tells.
TOLD_FIRST, TOLD = 4, "u long, v long, ru long, rv long, score float, cut boolean, token long"


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - math.ceil(n * percent / 100) + 1


def fine_groups(n: int) -> int:
    return max(MIDDLE, 1 << max(0, 2 * n - 1).bit_length())


def vectors_of(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """The vector of GROUPS coordinates, a byte each, and the finer one, two coordinates in a byte; 255 and 15 stand for all above."""
    groups = fine_groups(len(shingles))
    fine = np.bincount((mixed(shingles) & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    packed = np.minimum(fine, 15).astype(np.uint8).reshape(-1, 2)
    return np.minimum(fine.reshape(-1, GROUPS).sum(0), 255).astype(np.uint8).tobytes(), (packed[:, 0] << 4 | packed[:, 1]).tobytes()


def unpacked(fine: bytes) -> np.ndarray:
    raw = np.frombuffer(fine, np.uint8)
    return np.stack((raw >> 4, raw & 15), 1).ravel()


def middle(fine: bytes) -> bytes:
    """The vector of MIDDLE coordinates, a byte each, of a finer one."""
    v = unpacked(fine).reshape(-1, MIDDLE)
    return np.where((v == 15).any(0), 255, np.minimum(v.sum(0, dtype=np.int64), 255)).astype(np.uint8).tobytes()


def fine_bound(a: bytes, b: bytes) -> int:
    """At least the overlap of two sets, from their finer vectors."""
    x, y = unpacked(a), unpacked(b)
    size = min(len(x), len(y))
    full = ((x == 15).reshape(-1, size).any(0) & (y == 15).reshape(-1, size).any(0)).any()
    return 1 << 60 if full else int(np.minimum(*(v.astype(np.int64).reshape(-1, size).sum(0) + (1 << 40) * (v == 15).reshape(-1, size).any(0) for v in (x, y))).sum())


def class_of(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set: its id, and the one that tells sets with clashing ids apart."""
    n, other = np.uint64(len(shingles)), np.bitwise_xor.reduce(mixed(shingles + np.uint64(len(shingles))), keepdims=True)
    total = shingles.sum(dtype=np.uint64, keepdims=True)
    squares = (mixed(shingles ^ np.uint64(0xA0761D6478BD642F)) * (shingles | np.uint64(1))).sum(dtype=np.uint64, keepdims=True)
    return tuple(int(mixed(h).view(np.int64)[0]) for h in (total * np.uint64(3) + other, squares + n))


def named(shingles: np.ndarray, clashing: frozenset[int]) -> int:
    name, other = class_of(shingles)
    return name ^ other if name in clashing else name


class CountTree:
    """An R-tree over count vectors, packed by size; nodes keep their upper corner and their least and largest size."""

    def __init__(self, sizes: np.ndarray, vectors: np.ndarray, percent: int = PERCENT, fan: int = FAN):
        self.percent = percent
        self.order = np.lexsort((vectors.argmax(1), sizes))
        self.levels = [(vectors[self.order], sizes[self.order], sizes[self.order])]
        self.fan = fan
        while len(self.levels[-1][0]) > fan:
            top, low, high = self.levels[-1]
            at = np.arange(0, len(top), fan)
            self.levels.append((np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def search(self, size: int, vector: np.ndarray) -> np.ndarray:
        """Rows that the bounds allow as partners of a set."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            # |A & B| >= p / (100 + p) * (|A| + |B|); sizes within the ratio
            at = at[(100 * high[at] >= self.percent * size) & (self.percent * low[at] <= 100 * size)]
            bound = np.minimum(top[at], vector).sum(1, dtype=np.int64)
            bound[((top[at] == 255) & (vector == 255)).any(1)] = 1 << 40
            at = at[(100 + self.percent) * np.minimum(bound, size) >= self.percent * (size + np.maximum(low[at], -(-self.percent * size // 100)))]
            if depth and len(at):
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def allowed(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether the bounds let sets of sizes n, m and vectors x, y link; broadcast over leading axes."""
    bound = np.minimum(x, y).sum(-1, dtype=np.int64)
    bound = np.where(((x == 255) & (y == 255)).any(-1), 1 << 40, bound)
    least, most = np.minimum(n, m), np.maximum(n, m)
    return (100 * least >= percent * most) & ((100 + percent) * np.minimum(bound, least) >= percent * (n + m))


def leaf_pairs(starts: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, roots: np.ndarray | None, percent: int, reach: int = LEAF) -> np.ndarray:
    """(i, j), i < j <= i + reach, of rows that the bounds allow, over many blocks at once; starts: where each block starts, and the end."""
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(sizes)) - 1  # rows after this one in its block
    out = [np.zeros((0, 2), np.int64)]
    for d in range(1, min(reach, int(np.diff(starts).max(initial=1)) - 1) + 1):
        i = np.flatnonzero(left >= d)
        j = i + d
        fits = 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
        if roots is not None:
            fits &= roots[i] != roots[j]
        i, j = i[fits], j[fits]
        fits = allowed(vectors[i], sizes[i], vectors[j], sizes[j], percent)
        out.append(np.stack((i[fits], j[fits]), 1))
    return np.concatenate(out)


def scores(pairs: np.ndarray, sizes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The overlap bound of each pair, for its sizes."""
    i, j = pairs[:, 0], pairs[:, 1]
    return np.minimum(vectors[i], vectors[j]).sum(1, dtype=np.int64) / (sizes[i] + sizes[j])


def star_pairs(starts: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """For each row the pair with the largest bound for its size, among its neighbours in its block."""
    found = leaf_pairs(starts, sizes, vectors, None, percent)
    if not len(found):
        return found
    score = scores(found, sizes, vectors)
    row, pair = np.concatenate((found[:, 0], found[:, 1])), np.tile(np.arange(len(found)), 2)
    order = np.lexsort((-score[pair], row))
    first = np.concatenate(([True], row[order][1:] != row[order][:-1]))
    return found[np.unique(pair[order][first])]


def best_of_roots(pairs: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, roots: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs between two roots the ``most`` with the largest bounds; and whether those two roots have others."""
    a, b = roots[pairs[:, 0]], roots[pairs[:, 1]]
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((-scores(pairs, sizes, vectors), b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    starts = np.flatnonzero(new)
    size = np.diff(np.concatenate((starts, [len(a)])))
    keep = np.arange(len(a)) - np.repeat(starts, size) < most
    return pairs[order[keep]], np.repeat(size > most, size)[keep]


def tree_pairs(sizes: np.ndarray, vectors: np.ndarray, roots: np.ndarray, percent: int, most: int = 1 << 40) -> tuple[np.ndarray, bool]:
    """(i, j) of different roots that the bounds allow, up to ``most`` for two roots and searching row; whether there are more.
    Rows of the most common root are only searched, not searching."""
    _, inverse, counts = np.unique(roots, return_inverse=True, return_counts=True)
    out, cut = [np.zeros((0, 2), np.int64)], False
    if len(counts) > 1:
        tree = CountTree(sizes, vectors, percent)
        for i in np.flatnonzero(inverse != counts.argmax()):
            found = tree.search(sizes[i], vectors[i])
            found = found[roots[found] != roots[i]]
            pairs = np.stack((found, np.full(len(found), i)), 1)
            if len(pairs) > most:
                pairs, more = best_of_roots(pairs, sizes, vectors, roots, most)
                cut |= bool(more.any())
            out.append(pairs)
    return np.concatenate(out), cut


def block_pairs(starts: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, roots: np.ndarray, percent: int = PERCENT, leaf: int = LEAF, most: int = 1 << 40) -> tuple[np.ndarray, bool]:
    """The pairs of rows of different roots in a block that the bounds allow, limited as in tree_pairs in blocks larger than a leaf."""
    size = np.diff(starts)
    at = np.flatnonzero(np.repeat(size <= leaf, size))
    cuts = np.concatenate(([0], np.cumsum(size[size <= leaf])))
    out, cut = [at[leaf_pairs(cuts, sizes[at], vectors[at], roots[at], percent, leaf)]], False
    for b in np.flatnonzero(size > leaf):
        a, z = starts[b], starts[b + 1]
        found, more = tree_pairs(sizes[a:z], vectors[a:z], roots[a:z], percent, most)
        out.append(found + a)
        cut |= more
    return np.concatenate(out), cut


def _texts(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column.cast(pa.binary())]


def _profiles(words: int):
    names = ["key", "n", "id", "alt", "vector", "fine"]

    def run(batches):
        waiting, size = [], 0

        def often():
            tokens, counts = np.unique(np.concatenate(waiting), return_counts=True)
            tokens, counts = tokens[counts >= OFTEN], counts[counts >= OFTEN]
            n = len(tokens)
            return pa.record_batch([pa.nulls(n, pa.int64()), pa.array(counts, pa.int32()), pa.array(tokens.view(np.int64)), *[pa.nulls(n, kind) for kind in (pa.int64(), pa.binary(), pa.binary())]], names)

        for batch in batches:
            n, ids, vectors = [], [], []
            for s in shingle_sets(_texts(batch.column(1)), words):
                n.append(len(s))
                ids.append(class_of(s))
                vectors.append(vectors_of(s))
                waiting.append(s)
                size += len(s)
                if size >= WINDOW:
                    yield often()
                    waiting, size = [], 0
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(n, pa.int32()), *[pa.array([x[i] for x in ids], pa.int64()) for i in (0, 1)], *[pa.array([v[i] for v in vectors], pa.binary()) for i in (0, 1)]], names)
        if size:
            yield often()

    return run


def _prefixes(words: int, percent: int, frequent, clashing: frozenset[int]):
    """Texts -> (token, salt, id) of their prefixes; frequent tokens are salted, by id, with 1 to SALTS; others have salt 0."""

    def run(batches):
        last, seen = frequent.value, set()
        for batch in batches:
            tokens, salts, ids, sizes = [], [], [], []
            for s in shingle_sets(_texts(batch.column(0)), words):
                name = named(s, clashing)
                if not len(s) or name in seen:  # copies in one task say the same
                    continue
                if len(seen) >= 1 << 19:
                    seen.clear()
                seen.add(name)
                k = prefix_size(len(s), percent)
                common = np.zeros(len(s), bool)
                if len(last):
                    common = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s
                order = np.argsort(common, kind="stable")[:k]
                tokens.append(s[order])
                salts.append(common[order] * (1 + name % SALTS))
                ids.append(name)
                sizes.append(len(order))
            if tokens:
                yield pa.record_batch([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(salts).astype(np.int32)), pa.array(np.repeat(np.array(ids, np.int64), sizes))], ["token", "salt", "id"])

    return run


def _shared(batches):
    """Of rows sorted by (token, salt, id), those whose token has several ids or is salted, once each."""
    held = tuple(np.zeros(0, np.int64) for _ in range(3))
    told = False  # the held row was given out
    for batch in batches:
        token, salt, name = (np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1]) | (name[1:] != name[:-1])
        token, salt, name = token[new], salt[new], name[new]
        if not len(token):
            continue
        same = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        out = np.concatenate((same, [False])) | np.concatenate(([False], same)) | (salt > 0)
        given = out.copy()
        if told:
            given[0] = False
        told = bool(out[-1]) or (told and len(token) == 1)
        held = token[-1:], salt[-1:], name[-1:]
        if given.any():
            yield pa.record_batch([pa.array(token[given]), pa.array(name[given])], ["token", "id"])


def _blocks(percent: int, most: int | None, rows: int = 1 << 16):
    """Rows sorted by (token, s, draw): pairs of whole blocks, as (u, v, ru, rv, score, cut, token), and the tokens that have to be
    looked at again, as rows with u null. most: pairs told of two roots; in a star round, none."""

    def pairs(held):
        token, s, sliced, name, size, vector, root = (np.concatenate([h[i] for h in held]) for i in range(7))
        size = size.astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero((token[1:] != token[:-1]) | (s[1:] != s[:-1])) + 1, [len(token)]))
        matrix = np.frombuffer(b"".join(vector), np.uint8).reshape(len(token), -1)
        if most is None:
            found = star_pairs(starts, size, matrix, percent)
            partly = starts[:-1][(np.diff(starts) > LEAF) | sliced[starts[:-1]].astype(bool)]
            again, cut = np.unique(np.concatenate((token[found[:, 0]], token[partly]))), np.zeros(len(found), bool)
        else:
            found, more = block_pairs(starts, size, matrix, root, percent, LEAF, most)
            again = np.unique(token[found[:, 0]])
            u, v = np.sort(name[found], 1).T
            order = np.lexsort((v, u))
            new = np.ones(len(u), bool)
            new[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
            found, cut = best_of_roots(found[order[new]], size, matrix, root, most)
            cut |= more
        u, v, ru, rv = name[found[:, 0]], name[found[:, 1]], root[found[:, 0]], root[found[:, 1]]
        n, none = len(again), lambda kind: pa.nulls(len(again), kind)
        cols = [np.minimum(u, v), np.maximum(u, v), np.minimum(ru, rv), np.maximum(ru, rv), scores(found, size, matrix).astype(np.float32), cut]
        kinds = [*[pa.int64()] * 4, pa.float32(), pa.bool_()]
        told = [pa.concat_arrays([pa.array(c, kind), none(kind)]) for c, kind in zip(cols, kinds, strict=True)]
        return pa.record_batch([*told, pa.array(np.concatenate((np.zeros(len(found), np.int64), again)), mask=np.arange(len(found) + n) < len(found))], [f.split()[0] for f in TOLD.split(", ")])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if count >= rows and len(cols[0]):
                end = [h[-1] for h in held[-1][:2]]
                other = (cols[0] != end[0]) | (cols[1] != end[1])
                cut = int(other.argmax()) if other.any() else len(other)
                held.append([c[:cut] for c in cols])
                cols = [c[cut:] for c in cols]
                if len(cols[0]):
                    yield pairs(held)
                    held, count = [], 0
            if len(cols[0]):
                held.append(cols)
                count += len(cols[0])
        if held:
            yield pairs(held)

    return run


def _middle():
    return F.arrow_udf(lambda fine: pa.array([middle(x.as_py()) for x in fine], pa.binary()), "binary")


def _bounded(percent: int):
    def run(a: pa.Array, n: pa.Array, b: pa.Array, m: pa.Array) -> pa.Array:
        each = zip(a.to_pylist(), n.to_pylist(), b.to_pylist(), m.to_pylist(), strict=True)
        return pa.array([(100 + percent) * fine_bound(x, y) >= percent * (i + j) for x, i, y, j in each])

    return F.arrow_udf(run, "boolean")


def _near(percent: int):
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out)

    return F.arrow_udf(run, "boolean")


class Join:
    """Tables of the join of one column, stored in the scope around."""

    def __init__(self, df: DataFrame, key: str, text: str, words: int = WORDS, percent: int = PERCENT, slice_rows: int = SLICE):
        self.spark, self.words, self.percent, self.slice_rows = df.sparkSession, words, percent, slice_rows
        small_batches(self.spark)
        self.rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
        told = stored(self.rows.mapInArrow(releasing(_profiles(words)), "key long, n int, id long, alt long, vector binary, fine binary"), "profiles")
        sets = told.where("vector is not null")
        clashes = sets.groupBy("id").agg(F.min("alt").alias("a"), F.max("alt").alias("b")).where("a <> b").select("id")
        self.clashing = frozenset(r.id for r in clashes.toLocalIterator())  # about n * n / 2 ** 65 of n sets: none, or a few
        name = F.when(F.col("id").isin(*self.clashing), F.col("id").bitwiseXOR(F.col("alt"))).otherwise(F.col("id")) if self.clashing else F.col("id")
        sets = sets.withColumn("id", name)
        self.members = stored(sets.select("key", "n", "id"), "members")
        self.classes = stored(sets.where("n > 0").groupBy("id").agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("vector").alias("vector"), F.first("fine").alias("fine")), "classes")
        frequent = told.where("vector is null").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "id").limit(ORDERED)
        last = np.sort(np.array([r.id for r in frequent.select("id").toLocalIterator()], np.int64).view(np.uint64))
        discard(told)
        prefixes = self.rows.select("text").mapInArrow(releasing(_prefixes(words, percent, self.spark.sparkContext.broadcast(last), self.clashing)), "token long, salt int, id long")
        self.shared = stored(prefixes.repartition("token", "salt").sortWithinPartitions("token", "salt", "id").mapInArrow(releasing(_shared), "token long, id long"), "shared")
        self.large = stored(self.shared.groupBy("token").count().where(F.col("count") > slice_rows).select("token", F.ceil(F.col("count") / slice_rows).cast("int").alias("k")), "large")
        self.any_large = bool(self.large.limit(1).count())

    def candidates(self, rows: DataFrame, roots: DataFrame | None, most: int | None) -> DataFrame:
        """What _blocks tells of ``rows`` (token, id, n, vector); a star round if ``most`` is none. In a sliced block, rows of its most
        common root lie in one slice each, all others in all slices."""
        if roots is None:
            rows = rows.withColumn("root", F.col("id"))
        else:
            known = roots.select(F.col("node").alias("id"), "root")
            rows = rows.join(F.broadcast(known) if known.count() <= BROADCAST_IDS else known, "id", "left").withColumn("root", F.coalesce("root", "id"))
        rows = rows.select("token", F.lit(0).alias("s"), F.lit(False).alias("sliced"), "id", "n", "vector", "root")
        if self.any_large:
            cut = rows.join(self.large, "token")
            own = F.pmod(F.xxhash64("id", "token"), "k").cast("int")
            if most is None:
                cut = cut.withColumn("s", own)
            else:
                common = cut.groupBy("token", "root").count().groupBy("token").agg(F.max_by("root", "count").alias("common"))
                slices = F.when(F.col("root") == F.col("common"), F.array(own)).otherwise(F.sequence(F.lit(0), F.col("k") - 1))
                cut = cut.join(common, "token").withColumn("s", F.explode(slices))
            rows = rows.join(self.large, "token", "left_anti").union(cut.withColumn("sliced", F.lit(True)).select(rows.columns))
        rows = rows.repartition("token", "s").sortWithinPartitions("token", "s", F.xxhash64("id", "token"))
        return stored(rows.mapInArrow(releasing(_blocks(self.percent, most)), TOLD), "told")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (u, v) that hold on the finer vectors, and then on the whole sets. Ids are broadcast only if they are few."""
        small = lambda df: F.broadcast(df) if df.count() <= BROADCAST_IDS else df
        of = lambda pairs: pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct()
        with scratch(self.spark):
            pairs = stored(pairs.select("u", "v"), "candidates")
            fine = stored(self.classes.select("id", "n", "fine", "rep").join(small(stored(of(pairs), "ids")), "id"), "fine")
            u, v = (fine.select(F.col("id").alias(i), F.col("n").alias(f"n_{i}"), F.col("fine").alias(f"fine_{i}")) for i in "uv")
            pairs = stored(pairs.join(u, "u").join(v, "v").where(_bounded(self.percent)("fine_u", "n_u", "fine_v", "n_v")).select("u", "v"), "bounded")
            ids = small(stored(of(pairs), "ids"))
            reps = stored(fine.select("id", "rep").join(ids, "id").select(F.col("rep").alias("key")).distinct(), "reps")
            words, clashing = self.words, self.clashing

            def sets(batches):
                for batch in batches:
                    found = [(named(s, clashing), s.tobytes()) for s in shingle_sets(_texts(batch.column(0)), words)]
                    yield pa.record_batch([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], ["id", "shingles"])

            asked = self.rows.join(small(reps), self.rows["key"].eqNullSafe(reps["key"]), "left_semi")  # null meets null
            known = stored(asked.select("text").mapInArrow(releasing(sets), "id long, shingles binary").join(ids, "id", "left_semi"), "sets").dropDuplicates(["id"])
            left, right = known.select(F.col("id").alias("u"), F.col("shingles").alias("a")), known.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
            return stored(pairs.join(left, "u").join(right, "v").where(_near(self.percent)("a", "b")).select("u", "v"), "links", outer=True)

    def linked(self, most: int = TOLD_FIRST) -> DataFrame:
        """(node, root) over class ids, for classes that have links."""
        told = self.candidates(self.shared.join(self.classes.select("id", "n", "vector"), "id"), None, None)
        best = told.where("u is not null").select("u", "v", "score")
        best = best.union(best.select("v", "u", "score")).groupBy("u").agg(F.max(F.struct("score", "v")).alias("of"))
        best = best.select(F.least("u", "of.v").alias("u"), F.greatest("u", "of.v").alias("v")).distinct()
        roots = components(self.links(best))
        # hints: one plan, whatever the size
        again = told.where("u is null").select("token").distinct().hint("merge")
        rows = stored(self.shared.join(again, "token", "left_semi").join(self.classes.select("id", "n", "vector").hint("merge"), "id"), "rows")
        discard(told, self.shared)
        sharper = False
        while True:
            told = self.candidates(rows, roots, most)
            pairs = told.where("u is not null").groupBy("u", "v", "ru", "rv").agg(F.max("score").alias("score"), F.max("cut").alias("cut"))
            pairs = stored(pairs.withColumn("nth", F.row_number().over(W.partitionBy("ru", "rv").orderBy(F.desc("score"), "u", "v"))), "pairs")
            new = self.links(pairs.where(F.col("nth") <= most).select("u", "v"))
            last, roots = roots, components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(new))
            cut = pairs.where((F.col("nth") > most) | F.col("cut"))
            open_ = stored(cut.select(F.col("ru").alias("root")).union(cut.select(F.col("rv").alias("root"))).distinct(), "open")
            if not open_.limit(1).count():
                return roots
            # only the classes of components that have pairs left can still meet
            ids = stored(last.join(open_, "root").select(F.col("node").alias("id")).union(open_.select(F.col("root").alias("id"))).distinct(), "ids")
            ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
            if not sharper:
                finer = self.classes.join(ids, "id", "left_semi").select("id", _middle()("fine").alias("vector"))
                rest = stored(rows.drop("vector").join(ids, "id", "left_semi").join(finer, "id").select(rows.columns), "rows")
            else:
                rest = stored(rows.join(ids, "id", "left_semi"), "rows")
            discard(rows, told, pairs, last, new)
            rows, most, sharper = rest, most * 16, True


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, n_shingles, component_id) for each row."""
    with scratch(df.sparkSession):
        join = Join(df, key, text, **options)
        named = join.members.join(join.linked().select(F.col("node").alias("id"), "root"), "id", "left").select("key", "n", F.coalesce("root", "id").alias("root"))
        alone, sets = named.where("n = 0"), named.where("n > 0")
        least = sets.groupBy("root").agg(F.min("key").alias("component_id"))
        out = sets.join(least, "root").select("key", "n", "component_id").union(alone.select("key", "n", F.col("key").alias("component_id")))
        return stored(out.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id"), "near-duplicates", outer=True)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
