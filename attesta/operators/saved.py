"""A search index in a folder: postings bucketed by term, appended in generations, read only where a query's terms lie; top-k that skips
blocks of documents which cannot reach the k-th score.

    terms/        (term), dealt by range and sorted: a prefix is a range
    parts/        segments of terms for near ones, by (edits, bucket of the segment)
    postings/     (term, field, doc, tf, length, block), by (generation, bucket of the term)
    bounds/       (term, field, block, most, least): the greatest tf and the least length within the block, by the same partitions
    documents/    (doc, stored columns), by generation
    gone/         (doc): what a generation replaces or removes of earlier ones
    stats/        (field, sums of lengths and counts of the live documents), by generation
    committed/    one file for each generation, which names it, made last

An addition or removal writes a generation of its own and leaves every earlier file as it is; readers take only generations that are
committed, so that a failed addition is not seen. Postings of documents that a later generation replaces are left out as they are read,
and document frequencies are counted from the live postings of the asked terms, so they are exact without rewriting anything.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lookup, search
from .constraints import ConstraintError
from .search import Index

BUCKETS, MOST_EDITS = 64, search.MOST_FUZZY
#: Documents of a block of postings, about.
BLOCK = 1024


def bucket_of(*columns: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def blocked(index: Index, size: int = BLOCK) -> DataFrame:
    """The postings with ``length`` and ``block``: documents of like lengths lie together, so that a block's least length says much."""
    total = index.lengths.groupBy("doc").agg(F.sum("length").alias("total"))
    kind = F.floor(F.log2(F.col("total") + 1) * 4).cast("long")
    many = F.greatest(F.lit(1), F.ceil(F.col("n") / size)).cast("long")
    sized = total.withColumn("kind", kind)
    count = sized.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    blocks = sized.join(F.broadcast(count), "kind").select("doc", (F.col("kind") * (1 << 40) + F.pmod(F.xxhash64("doc"), many)).alias("block"))
    return index.postings.join(index.lengths, ["doc", "field"]).join(blocks, "doc").select("term", "field", "doc", "tf", "length", "block")


def bounds(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term", "field", "block").agg(F.max("tf").alias("most"), F.min("length").alias("least"))


def ceilings(index: Index, bounds: DataFrame, hits: DataFrame, boost: dict[str, float] | None = None) -> DataFrame:
    """(block, ceiling): no document of the block scores more. Each match counts with its block's greatest tf and least length, and with as many
    distinct asked terms as the block has."""
    weight = F.col("weight")
    for f, w in (boost or {}).items():
        weight = weight * F.when(F.col("field") == f, w).otherwise(1.0)
    each = bounds.join(hits, ["field", "term"]).join(F.broadcast(index.stats), "field")
    score = weight * search.bm25(F.col("most"), F.col("df"), F.col("docs"), F.col("least"), F.col("mean"))
    return each.groupBy("block").agg((F.sum(score) * F.count_distinct("asked") * (1 + 1e-9)).alias("ceiling"))


@dataclass
class Top:
    """The best documents, best first, and how many of the blocks that hold a match were read."""

    hits: DataFrame
    read: int
    blocks: int


def top(index: Index, bounds: DataFrame, query: str, most: int, first: int = 8, **options) -> Top:
    """As ranked(search(...), most). ``index`` has blocked postings. The blocks with the greatest ceilings are scored first; what they give for the
    k-th place leaves out all blocks below it. Options: combine, prefix, fuzzy, boost, fields."""
    terms = search.query_terms(query)
    hits = search.expanded(index, terms, options.get("prefix", False), options.get("fuzzy", False)) if terms else None
    if not terms or most < 1:
        return Top(search.search(index, "" if most < 1 else query), 0, 0)
    if options.get("fields"):
        hits = hits.where(F.col("field").isin(*options["fields"]))
    over = ceilings(index, bounds, hits, options.get("boost"))
    within = lambda blocks: replace(index, postings=index.postings.join(blocks, "block", "left_semi"))
    best = [r.block for r in over.orderBy(F.desc("ceiling"), "block").limit(first).collect()]
    early = search.ranked(search.search(replace(index, postings=index.postings.where(F.col("block").isin(best))), query, **options), most)
    least = [r.score for r in early.select("score").collect()]  # ``most`` at most
    edge = min(least) if len(least) == most else -math.inf
    reach = over.where(F.col("ceiling") >= edge)
    n = over.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("ceiling") >= edge).alias("read")).first()
    return Top(search.ranked(search.search(within(F.broadcast(reach.select("block")) if n["read"] <= 100_000 else reach.select("block")), query, **options), most), n["read"], n["all"])


class Saved:
    def __init__(self, spark: SparkSession, path: str, fields: list[str], buckets: int = BUCKETS, block: int = BLOCK):
        self.spark, self.path, self.fields, self.buckets, self.block = spark, path.rstrip("/"), list(fields), buckets, block

    def _files(self):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/committed")
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def generations(self) -> list[str]:
        """Names of the committed generations, in order."""
        at, files = self._files()
        return sorted(r[0] for r in self.spark.read.text(at.toString()).collect()) if files.exists(at) else []

    def _next(self, held: list[str]) -> str:
        """A name of its own, so that what a failed attempt has left is never taken for a later one's."""
        return f"{len(held):08d}-{uuid.uuid4().hex[:8]}"

    def _commit(self, generation: str) -> None:
        """The file of the number is made once only: of two that are added at the same time the second fails."""
        at, files = self._files()
        try:
            out = files.create(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, generation.split("-")[0]), False)
        except Exception as e:
            raise ConstraintError(f"generation {generation} was committed meanwhile") from e
        try:
            out.write(bytearray(generation.encode()))
        finally:
            out.close()

    def _read(self, name: str) -> DataFrame:
        """A table's rows of committed generations; its folders that a query leaves out are not opened."""
        return self.spark.read.parquet(f"{self.path}/{name}").where(F.col("generation").isin(self.generations()))

    def _write(self, rows: DataFrame, name: str, generation: str, *by: str) -> None:
        """Small tables without ``by`` hold the generation as a column, so that an empty one has a schema."""
        out = rows.withColumn("generation", F.lit(generation)).write.mode("append")
        (out.partitionBy("generation", *by) if by else out).parquet(f"{self.path}/{name}")

    def _put(self, index: Index, generation: str) -> None:
        own = bucket_of("term", buckets=self.buckets)
        spread = lambda df, *by: df.repartition(*by)
        postings = spread(blocked(index, self.block).withColumn("bucket", own), "bucket").sortWithinPartitions("bucket", "term", "block")
        self._write(postings, "postings", generation, "bucket")
        written = self.spark.read.parquet(f"{self.path}/postings").where(F.col("generation") == generation)
        self._write(spread(bounds(written).withColumn("bucket", own), "bucket").sortWithinPartitions("bucket", "term"), "bounds", generation, "bucket")
        terms = written.select("term").distinct()
        self._write(terms.repartitionByRange("term").sortWithinPartitions("term"), "terms", generation)
        rows = None
        for k in range(1, MOST_EDITS + 1):
            part = lookup.parts(terms, k)
            rows = part if rows is None else rows.unionByName(part)
        rows = rows.withColumn("bucket", bucket_of("edits", "size", "i", "part", buckets=self.buckets))
        self._write(spread(rows, "edits", "bucket").sortWithinPartitions("edits", "bucket", "size", "part"), "parts", generation, "edits", "bucket")
        self._write(index.documents, "documents", generation)

    def create(self, index: Index) -> Saved:
        if self.generations():
            raise ConstraintError(f"{self.path} holds an index")
        generation = self._next([])
        self._put(index, generation)
        self._write(index.documents.select("doc").limit(0), "gone", generation)
        docs = index.documents.agg(F.count(F.lit(1)).alias("docs"))
        sums = index.lengths.groupBy("field").agg(F.sum("length").alias("total"), F.count(F.lit(1)).alias("n"))
        self._write(sums.crossJoin(docs), "stats", generation)
        self._commit(generation)
        return self

    def _change(self, gone: DataFrame, new: Index | None) -> None:
        """One more generation: ``gone`` (doc) leave, ``new`` comes."""
        held = self.generations()
        generation = self._next(held)
        leaving = self.live("documents").select("doc").join(gone.select("doc").distinct(), "doc", "left_semi")
        if new:
            self._put(new, generation)
        self._write(leaving.repartition("doc"), "gone", generation)
        left = self.spark.read.parquet(f"{self.path}/gone").where(F.col("generation") == generation).select("doc")
        lengths = lambda df: df.select("doc", "field", "length").distinct()
        less = lengths(self.live("postings").join(left, "doc", "left_semi"))
        sums = lambda df, sign: df.groupBy("field").agg((sign * F.sum("length")).alias("total"), (sign * F.count(F.lit(1))).alias("n"))
        before = self.spark.read.parquet(f"{self.path}/stats").where(F.col("generation") == held[-1])
        docs = before.agg(F.max("docs").alias("docs")).crossJoin(left.agg(F.count(F.lit(1)).alias("less")))
        docs = docs.crossJoin(new.documents.agg(F.count(F.lit(1)).alias("more"))) if new else docs.withColumn("more", F.lit(0))
        both = before.select("field", "total", "n").unionByName(sums(less, -1))
        both = both.unionByName(sums(new.lengths, 1)) if new else both
        total = both.groupBy("field").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        self._write(total.crossJoin(docs.select((F.col("docs") - F.col("less") + F.col("more")).alias("docs"))), "stats", generation)
        self._commit(generation)

    def add(self, docs: DataFrame, key: str) -> None:
        """Adds documents; those of keys that are there are replaced."""
        stored = [c for c in self.spark.read.parquet(f"{self.path}/documents").columns if c not in ("doc", "generation")]
        new = Index.build(docs, key, self.fields, stored)
        self._change(new.documents, new)

    def remove(self, gone: DataFrame) -> None:
        """gone: (doc)"""
        self._change(gone, None)

    def live(self, name: str, where: Column | None = None) -> DataFrame:
        """Rows of a table with ``doc``, less those of documents that a later generation replaced or removed."""
        rows = self._read(name)
        rows = rows if where is None else rows.where(where)
        gone = self._read("gone").select(F.col("doc").alias("__doc"), F.col("generation").alias("__since"))
        return rows.join(gone, (F.col("doc") == F.col("__doc")) & (F.col("generation") < F.col("__since")), "left_anti").drop("generation")

    def near_or_like(self, query: str, prefix: bool | list[bool] = False, fuzzy: float | bool = False) -> DataFrame:
        """(term) that a query asks for, from the ranges and segments of the stored terms."""
        asked = search.asked_terms(search.query_terms(query), prefix, fuzzy)
        terms = self._read("terms").select("term")
        if not asked:
            return terms.limit(0)
        out = lookup.exact_or_prefix(terms, asked).select("term")
        unsure = [a for a in asked if a[3] > 0]
        if any(k > MOST_EDITS for *_, k in unsure):
            raise ConstraintError(f"over {MOST_EDITS} edits")
        if unsure:
            keys = lookup.asked_probes(self.spark, unsure).withColumn("bucket", bucket_of("edits", "size", "i", "part", buckets=self.buckets))
            folders = {(r.edits, r.bucket) for r in keys.select("edits", "bucket").distinct().collect()}
            held = self._read("parts").where(F.col("edits").isin(sorted({e for e, _ in folders})) & F.col("bucket").isin(sorted({b for _, b in folders})))
            out = out.union(lookup.near(held.drop("generation", "bucket"), unsure).select("term"))
        return out.distinct()

    def narrowed(self, query: str, prefix: bool | list[bool] = False, fuzzy: float | bool = False) -> tuple[Index, DataFrame]:
        """An index, and the bounds of its blocks, of only those buckets that hold terms of the query; for search(), suggest() and top()."""
        terms = self.near_or_like(query, prefix, fuzzy)
        own = sorted(r[0] for r in terms.select(bucket_of("term", buckets=self.buckets)).distinct().collect())  # buckets at most
        here = F.col("bucket").isin(own) if own else F.lit(False)
        postings = self.live("postings", here).drop("bucket").join(F.broadcast(terms) if len(own) < self.buckets else terms, "term", "left_semi")
        vocabulary = postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
        last = self.spark.read.parquet(f"{self.path}/stats").where(F.col("generation") == self.generations()[-1])
        stats = last.where("n > 0").select("field", (F.col("total") / F.col("n")).alias("mean"), "docs")
        lengths = postings.select("doc", "field", "length").distinct()
        held = self._read("bounds").where(here).groupBy("term", "field", "block").agg(F.max("most").alias("most"), F.min("least").alias("least"))
        return Index(postings, vocabulary, lengths, stats, self.live("documents"), tuple(self.fields)), held

    def search(self, query: str, **options) -> DataFrame:
        index, _ = self.narrowed(query, options.get("prefix", False), options.get("fuzzy", False))
        return search.search(index, query, **options)

    def top(self, query: str, most: int, first: int = 8, **options) -> Top:
        index, held = self.narrowed(query, options.get("prefix", False), options.get("fuzzy", False))
        return top(index, held, query, most, first, **options)
