import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from attesta.llm.sharding import HashTree, Increment, shard


def draw(key, salt, weight):
    bits = int(hashlib.md5(f"{key}|{salt}".encode()).hexdigest()[:13], 16)
    return -math.log((bits + 0.5) / 2**52) / weight


def weight(children):
    return sum(w if isinstance(w, (int, float)) else weight(w) for _, w in children)


def place(tree, key):
    tops = [(draw(key, r, weight(racks)), r, racks) for r, racks in tree.regions]
    tops += [(draw(key, f"{g.region}/{g.rack}/+{g.shard}", g.weight), None, g.shard) for g in tree.grown]
    _, r, racks = min(tops, key=lambda t: t[0])
    if r is None:
        return racks
    k, shards = min(racks, key=lambda x: draw(key, f"{r}/{x[0]}", weight(x[1])))
    return min(shards, key=lambda s: draw(key, f"{r}/{k}/{s[0]}", s[1]))[0]


def placed(spark, tree, n=3000):
    return {r.id: r.s for r in spark.range(n).select("id", tree.place(F.col("id")).alias("s")).collect()}


def test_equals_the_descent_by_hand(spark):
    for tree in (HashTree.build(16), HashTree.build(5, fan=3), HashTree.build(1), HashTree.build(16).grow().grow(2.0)):
        got = placed(spark, tree, 400)
        assert got == {k: place(tree, k) for k in got}


def test_growth_moves_keys_only_into_the_new_shard(spark):
    tree = HashTree.build(16)
    last = placed(spark, tree)
    for n in (17, 18, 19):
        tree = tree.grow()
        now = placed(spark, tree)
        moved = [k for k in now if now[k] != last[k]]
        assert {now[k] for k in moved} == {n - 1}
        assert 0.5 / n < len(moved) / len(now) < 1.6 / n
        last = now
    assert HashTree.build(19) == tree


def test_weights_confine_movement(spark):
    def tree(w):
        return HashTree((("a", (("x", ((0, 1.0), (1, 1.0))), ("y", ((2, 1.0),)))), ("b", (("z", ((3, w), (4, 1.0))), ("w", ((5, 1.0),))))))

    before, after = placed(spark, tree(1.0)), placed(spark, tree(2.0))
    region = lambda s: "a" if s < 3 else "b"
    for k in before:
        if before[k] != after[k]:
            assert region(after[k]) == "b"  # only region b gained weight
    counts = Counter(after.values())
    assert abs(counts[3] / 3000 - 2 / 7) < 0.05


def test_columns(spark):
    rows = [(i, f"text {i % 7}", 1) for i in range(500)] + [(7, None, 1), (7, None, 1), (None, "é", 1)]
    out = shard(spark.createDataFrame(rows, "doc_id long, text string, shard int"), buckets=8).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    one = next(r for r in out if r.doc_id == 3)
    assert (one.size, one.text_crc32, one.law) == (7, zlib.crc32(b"text 3"), "key")
    assert {(r.size, r.text_crc32) for r in out if r.doc_id == 7 and r.size == 1} == {(1, 0)}
    assert next(r for r in out if r.doc_id is None).size == 3
    assert shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_increment_is_immutable():
    assert HashTree.build(17).grown == (Increment(16, "r0", "k0", 1.0),)
