"""Sharding by a hierarchical weighted hash tree, with DataFrame functions only.

A tree has regions, racks and shards with weights; a region weighs what its racks weigh, a rack what its shards
weigh. A key descends level by level: each child c of a node draws ``-ln(u(key, c)) / weight(c)`` with a uniform hash
``u``, and the least draw wins. A draw depends on nothing but the key, the child and its weight, so a weight that
changes moves keys only into or out of the subtrees that hold it.

Growth is exact: a shard added later hangs in a rack of a region as an increment with a draw of its own, which takes part in
the draw of the region level, the way the least of two exponential clocks has the sum of their rates. A key that the
increment wins goes to the new shard, and every other key stays where it was: one more shard takes keys only into
itself. ``base`` shards are laid out as the tree, all further ones are increments.

The hash is the first 52 bits of an MD5 digest, so that every SQL engine can repeat it.

Law: ``key`` (key and shard count decide). Null keys hash as an empty string; equal keys share a shard; null texts
have size 1 and CRC 0. The slots of a shard count gapless from 0 in the order (bucket, key, CRC, size); rows that are equal in
all of these take neighbouring slots. An empty table gives an empty result. Other columns are not read, so their names cannot clash; long texts are
measured where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

#: Slots are counted within so many hash buckets of each shard; offsets have at most shards * BUCKETS rows.
BUCKETS = 1024
#: Offsets of at most so many rows (24 bytes each) are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
BITS, DIGITS = 52, 13


@dataclass(frozen=True)
class Increment:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


@dataclass(frozen=True)
class HashTree:
    """regions: {region: {rack: {shard: weight}}} as nested tuples of pairs; grown: shards added later, in order."""

    regions: tuple
    grown: tuple[Increment, ...] = ()

    @staticmethod
    def build(shards: int, fan: int = 2, base: int = 16) -> HashTree:
        """The first ``base`` shards in racks of ``fan`` and regions of ``fan`` racks; further ones are increments."""
        if shards < 1:
            raise ValueError("a tree needs a shard")
        ids, racks = list(range(min(shards, base))), []
        for i in range(0, len(ids), fan):
            racks.append((f"k{i // fan}", tuple((s, 1.0) for s in ids[i : i + fan])))
        tree = HashTree(tuple((f"r{i // fan}", tuple(racks[i : i + fan])) for i in range(0, len(racks), fan)))
        for _ in range(base, shards):
            tree = tree.grow()
        return tree

    def shards(self) -> list[int]:
        return [s for _, racks in self.regions for _, shards in racks for s, _ in shards] + [g.shard for g in self.grown]

    def grow(self, weight: float = 1.0) -> HashTree:
        """One more shard, in the first rack of the region with the least weight."""
        def load(region):
            return _weight(region[1]) + sum(g.weight for g in self.grown if g.region == region[0])

        least = min(self.regions, key=load)
        return HashTree(self.regions, (*self.grown, Increment(max(self.shards()) + 1, least[0], least[1][0][0], weight)))

    def place(self, key: Column) -> Column:
        """The shard of a key (int)."""
        key = F.coalesce(key.cast("string"), F.lit(""))
        contest = [_entry(key, f"{r}", _weight(racks), i) for i, (r, racks) in enumerate(self.regions)]
        contest += [_entry(key, f"{g.region}/{g.rack}/+{g.shard}", g.weight, len(self.regions) + j) for j, g in enumerate(self.grown)]
        region = _least(contest)
        out = None
        for i, (r, racks) in enumerate(self.regions):
            rack = _least([_entry(key, f"{r}/{k}", _weight(shards), j) for j, (k, shards) in enumerate(racks)])
            leaf = None
            for j, (k, shards) in enumerate(racks):
                shard = _least([_entry(key, f"{r}/{k}/{s}", w, s) for s, w in shards])
                leaf = F.when(rack == j, shard) if leaf is None else leaf.when(rack == j, shard)
            out = F.when(region == i, leaf) if out is None else out.when(region == i, leaf)
        for j, g in enumerate(self.grown):
            out = out.when(region == len(self.regions) + j, F.lit(g.shard))
        return out.cast("int")


def _weight(children) -> float:
    return sum(w if isinstance(w, (int, float)) else _weight(w) for _, w in children)


def uniform(key: Column, salt: str) -> Column:
    """(0, 1): the digest's first 52 bits."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{salt}"))), 1, DIGITS), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**BITS))


def _entry(key: Column, salt: str, weight: float, label: int) -> tuple[Column, int]:
    return -F.ln(uniform(key, salt)) / F.lit(float(weight)), label


def _least(entries: list[tuple[Column, int]]) -> Column:
    if len(entries) == 1:
        return F.lit(entries[0][1])
    return F.array_min(F.array(*[F.struct(d.alias("draw"), F.lit(i).alias("label")) for d, i in entries]))["label"]


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16, base: int = 16, buckets: int = BUCKETS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard): only digests of the text are shuffled, never the text."""
    tree = HashTree.build(shards, base=base)
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    placed = df.select(F.col(key), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"))
    placed = placed.select("*", tree.place(F.col(key)).alias("shard"), tree.grow().place(F.col(key)).alias("grown_shard"))
    own = F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("text_crc32").cast("string"), F.lit("slot"))
    placed = placed.select("*", F.pmod(F.conv(F.substring(F.md5(own), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int").alias("bucket"))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    if (shards + 1) * buckets <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    within = W.partitionBy("shard", "bucket").orderBy(key, "text_crc32", "size")
    numbered = placed.select("*", (F.row_number().over(within) - 1).alias("within"))
    return numbered.join(offsets, ["shard", "bucket"]).select(
        key, "size", "text_crc32", "law", "shard", (F.col("offset") + F.col("within")).cast("long").alias("slot"), "grown_shard"
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def oracle() -> str:
    def pick(entries):
        if len(entries) == 1:
            return entries[0][2]
        draws = ", ".join(f"-ln((('0x' || substr(md5(k || '|{salt}'), 1, {DIGITS}))::BIGINT::DOUBLE + 0.5) / {float(2**BITS)}) / {weight}" for salt, weight, _ in entries)
        return f"[{', '.join(label for _, _, label in entries)}][list_position([{draws}], list_min([{draws}]))]"

    def place(tree: HashTree) -> str:
        tops = []
        for r, racks in tree.regions:
            inner = pick([(f"{r}/{k}", _weight(shards), pick([(f"{r}/{k}/{s}", w, str(s)) for s, w in shards])) for k, shards in racks])
            tops.append((r, _weight(racks), inner))
        tops += [(f"{g.region}/{g.rack}/+{g.shard}", g.weight, str(g.shard)) for g in tree.grown]
        return pick(tops)

    tree = HashTree.build(16)
    return f"""
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(n))),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (
  SELECT doc_id, k, length(h) // 2 + 1 AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32
  FROM d, crc_table),
p AS (
  SELECT doc_id, size, text_crc32, 'key' AS law, {place(tree)} AS shard, {place(tree.grow())} AS grown_shard,
    ('0x' || substr(md5(k || '|' || text_crc32::VARCHAR || '|slot'), 1, 8))::BIGINT % {BUCKETS} AS bucket
  FROM s)
SELECT doc_id, size, text_crc32, law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot, grown_shard::INTEGER AS grown_shard
FROM p"""
