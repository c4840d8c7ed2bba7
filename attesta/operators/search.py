"""Ranked text search over a postings table: BM25+, prefix and fuzzy expansion, boolean combination, suggestions.

The index is a DataFrame (doc, field, term, tf) with a vocabulary (field, term, df) and statistics (field, docs, mean length);
queries are joins, so that neither the index nor the query's matches pass through one machine. Scores follow the library defaults
noted below.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from . import lookup
from .constraints import require

# Tokenizer pattern, BM25+ constants, weights.
SEPARATOR = r"[\n\r\p{Z}\p{P}]"
K1, B, DELTA = 1.2, 0.7, 0.5
PREFIX_WEIGHT, FUZZY_WEIGHT, DECAY, DEFAULT_FUZZY, MOST_FUZZY = 0.375, 0.45, 0.3, 0.2, 6
LEAST_DIRT, DIRTY_SHARE = 20, 0.1


def tokenize(text: Column) -> Column:
    """Raw tokens, empty ones included."""
    return F.split(text, SEPARATOR, -1)


def query_terms(query: str) -> list[str]:
    """The terms of a query: cut and lower-cased as indexed texts are, empty ones left out."""
    cut = "".join("\n" if c in "\n\r" or unicodedata.category(c)[0] in "ZP" else c for c in query)
    return [t.lower() for t in cut.split("\n") if t]


@dataclass
class Index:
    postings: DataFrame
    vocabulary: DataFrame
    lengths: DataFrame
    stats: DataFrame
    documents: DataFrame
    fields: tuple[str, ...] = field(default_factory=tuple)
    gone: DataFrame | None = None

    @staticmethod
    def build(docs: DataFrame, key: str, fields: list[str], stored: list[str] | None = None) -> Index:
        """Field length: distinct raw tokens, before lower-casing; null fields are skipped. ``stored`` columns stay beside the
        documents. A null or repeated key is an error."""
        require(docs.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()), "missing or repeated ids")
        parts = [docs.select(F.col(key).alias("doc"), F.lit(f).alias("field"), tokenize(F.col(f)).alias("tokens")).where(F.col("tokens").isNotNull()) for f in fields]
        raw = parts[0]
        for p in parts[1:]:
            raw = raw.union(p)
        lengths = raw.select("doc", "field", F.size(F.array_distinct("tokens")).alias("length"))
        terms = raw.select("doc", "field", F.explode("tokens").alias("t")).select("doc", "field", F.lower("t").alias("term")).where("term <> ''")
        postings = terms.groupBy("doc", "field", "term").agg(F.count(F.lit(1)).alias("tf"))
        vocabulary = postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
        stats = lengths.groupBy("field").agg(F.avg("length").alias("mean")).crossJoin(docs.agg(F.count(F.lit(1)).alias("docs")))
        return Index(postings, vocabulary, lengths, stats, docs.select(F.col(key).alias("doc"), *(stored or [])), tuple(fields))

    def without(self, gone: DataFrame) -> Index:
        """Less the documents of ``gone`` (doc); statistics are counted anew."""
        keep = lambda df: df.join(gone, "doc", "left_anti")
        postings, lengths, documents = keep(self.postings), keep(self.lengths), keep(self.documents)
        stats = lengths.groupBy("field").agg(F.avg("length").alias("mean")).crossJoin(documents.agg(F.count(F.lit(1)).alias("docs")))
        return Index(postings, postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")), lengths, stats, documents, self.fields)

    def plus(self, docs: DataFrame, key: str) -> Index:
        """With the documents of ``docs``, which replace those of equal keys."""
        new = Index.build(docs, key, list(self.fields), self.documents.columns[1:])
        old = self.without(new.documents)
        postings, lengths, documents = (a.unionByName(b) for a, b in ((old.postings, new.postings), (old.lengths, new.lengths), (old.documents, new.documents)))
        stats = lengths.groupBy("field").agg(F.avg("length").alias("mean")).crossJoin(documents.agg(F.count(F.lit(1)).alias("docs")))
        return Index(postings, postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")), lengths, stats, documents, self.fields)

    def discard(self, gone: DataFrame) -> Index:
        """Without the documents of ``gone`` (doc) in results from now on; postings keep them until vacuum."""
        gone = gone.select("doc").distinct()
        return replace(self, gone=gone if self.gone is None else self.gone.union(gone).distinct())

    def live(self) -> Index:
        return self if self.gone is None else self.without(self.gone)

    def vacuum(self, least: int = LEAST_DIRT, share: float = DIRTY_SHARE) -> Index:
        """Purged of discarded documents, if they are many enough."""
        if self.gone is None:
            return self
        dirty, total = self.gone.count(), self.documents.count()
        return self.live() if dirty >= least and dirty >= share * total else self

    def has(self, key: object) -> bool:
        return self.stored_fields(key) is not None

    def stored_fields(self, key: object) -> Row | None:
        return self.live().documents.where(F.col("doc") == F.lit(key)).first()

    def counts(self) -> DataFrame:
        """One row: documents and distinct terms."""
        live = self.live()
        return live.documents.agg(F.count(F.lit(1)).alias("documents")).crossJoin(live.vocabulary.agg(F.count_distinct("term").alias("terms")))

    def save(self, path: str) -> None:
        for name in ("postings", "vocabulary", "lengths", "stats", "documents"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark, path: str, fields: list[str]) -> Index:
        return Index(*[spark.read.parquet(f"{path}/{n}") for n in ("postings", "vocabulary", "lengths", "stats", "documents")], tuple(fields))


def bm25(tf: Column, df: Column, docs: Column, length: Column, mean: Column, k: float = K1, b: float = B, d: float = DELTA) -> Column:
    idf = F.log(1 + (docs - df + 0.5) / (df + 0.5))
    return idf * (d + tf * (k + 1) / (tf + k * (1 - b + b * length / mean)))


def total(values: Column) -> Column:
    """Their sum over a group, added in order of size: equal values give an equal sum, in whatever order rows come, so that ties are ties. For groups of
    one document's matches."""
    return F.aggregate(F.sort_array(F.collect_list(values)), F.lit(0.0), lambda sum, x: sum + x)


def fuzzy_budget(size: int, fuzzy: float | bool) -> int:
    value = DEFAULT_FUZZY if fuzzy is True else float(fuzzy)
    return min(MOST_FUZZY, int(size * value + 0.5)) if value < 1 else int(value)


def asked_terms(terms: list[str], prefix: bool | list[bool] = False, fuzzy: float | bool = False) -> list[tuple[int, str, bool, int]]:
    """(q, term, whether it is a prefix, edits)"""
    flags = prefix if isinstance(prefix, list) else [prefix] * len(terms)
    return [(i, t, bool(p), fuzzy_budget(len(t), fuzzy) if fuzzy else 0) for i, (t, p) in enumerate(zip(terms, flags, strict=True))]


def weighted(found: DataFrame, near: DataFrame | None) -> DataFrame:
    """Exact terms weigh 1; a term found by prefix is not fuzzy too."""
    size, own = F.char_length("term"), F.char_length("asked")
    by_start = F.when(F.col("term") == F.col("asked"), 1.0).otherwise(PREFIX_WEIGHT * size / (size + DECAY * (size - own)))
    columns = [c for c in found.columns if c not in ("prefix", "edits")]
    out = found.select(*columns, by_start.alias("weight"))
    return out if near is None else out.unionByName(near.select(*columns, (FUZZY_WEIGHT * size / (size + F.col("distance"))).alias("weight")))


def expanded(index: Index, terms: list[str], prefix: bool | list[bool] = False, fuzzy: float | bool = False, by_bytes: bool = False) -> DataFrame:
    """(q, asked, field, term, df, weight): indexed terms for each query term. Prefixes are ranges of the vocabulary, near terms meet in an equi
    join on segments; see lookup."""
    asked, near = asked_terms(terms, prefix, fuzzy), None
    for edits in sorted({k for *_, k in asked if k > 0}):
        own = [a for a in asked if a[3] == edits]
        size = F.char_length("term")
        fitting = index.vocabulary.where(size.between(min(len(a[1]) for a in own) - edits, max(len(a[1]) for a in own) + edits))
        found = lookup.near(lookup.parts(fitting, edits), own, by_bytes)
        near = found if near is None else near.unionByName(found)
    return weighted(lookup.exact_or_prefix(index.vocabulary, asked), near).select("q", "asked", "field", "term", "df", "weight")


def _matched(index: Index, hits: DataFrame) -> DataFrame:
    met = index.postings.join(hits, ["field", "term"])
    met = met if "length" in index.postings.columns else met.join(index.lengths, ["doc", "field"])
    return met.join(F.broadcast(index.stats), "field")


def search(index: Index, query: str, combine: str = "OR", prefix: bool | list[bool] = False, fuzzy: float | bool = False, boost: dict[str, float] | None = None, fields: list[str] | None = None, boost_documents: DataFrame | None = None, where: Column | None = None, by_bytes: bool = False) -> DataFrame:
    """(doc, score, terms): score is the sum over matches times the number of distinct query terms that match.

    ``boost_documents`` (doc, boost) multiplies; 0 drops a document. ``where`` is a condition on the stored columns. ``by_bytes``: edits of near
    terms are of bytes instead of characters. The result has no order; see ``ranked``.
    """
    index, terms = index.live(), query_terms(query)
    spark = index.postings.sparkSession
    if not terms:
        return spark.createDataFrame([], f"doc {index.documents.schema['doc'].dataType.simpleString()}, score double, terms int")
    hits = expanded(index, terms, prefix, fuzzy, by_bytes)
    if fields:
        hits = hits.where(F.col("field").isin(*fields))
    weight = F.col("weight")
    for f, w in (boost or {}).items():
        weight = weight * F.when(F.col("field") == f, w).otherwise(1.0)
    scored = _matched(index, hits).select("doc", "q", "asked", (weight * bm25(F.col("tf"), F.col("df"), F.col("docs"), F.col("length"), F.col("mean"))).alias("s"))
    if boost_documents is not None:
        scored = scored.join(boost_documents.select("doc", F.col("boost").cast("double").alias("boost")), "doc", "left").where(F.coalesce("boost", F.lit(1.0)) != 0)
        scored = scored.select("doc", "q", "asked", (F.col("s") * F.coalesce("boost", F.lit(1.0))).alias("s"))
    by_term = scored.groupBy("doc", "q", "asked").agg(total(F.col("s")).alias("s"))
    if combine == "AND_NOT":
        out = by_term.where("q = 0").join(by_term.where("q > 0").select("doc"), "doc", "left_anti").groupBy("doc").agg(total(F.col("s")).alias("score"), F.lit(1).alias("terms"))
    else:
        distinct = F.size(F.collect_set("asked"))
        out = by_term.groupBy("doc").agg((total(F.col("s")) * distinct).alias("score"), distinct.alias("terms"), F.count(F.lit(1)).alias("n"))
        out = (out.where(F.col("n") == len(terms)) if combine == "AND" else out).drop("n")
    if where is not None:
        out = out.join(index.documents.where(where).select("doc"), "doc", "left_semi")
    return out


def ranked(hits: DataFrame, most: int | None = None) -> DataFrame:
    """Best first, ties by document; with ``most``, a top-k that is never sorted whole."""
    out = hits.orderBy(F.desc("score"), "doc")
    return out if most is None else out.limit(most)


def everything(index: Index) -> DataFrame:
    """The wildcard: each document once, with score 1."""
    return index.documents.select("doc", F.lit(1.0).alias("score"), F.lit(0).alias("terms"))


def combined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Trees of queries: OR adds scores, AND adds those of documents on both sides, AND_NOT takes away."""
    if how == "AND_NOT":
        return left.join(right.select("doc"), "doc", "left_anti")
    both = left.select("doc", "score").union(right.select("doc", "score")).groupBy("doc").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("n"))
    return (both.where("n = 2") if how == "AND" else both).drop("n")


def suggest(index: Index, query: str, fuzzy: float | bool = False) -> DataFrame:
    """(suggestion, score, n): all terms have to match, the last one as a prefix; documents are grouped by their matched terms."""
    index, terms = index.live(), query_terms(query)
    if not terms:
        return index.postings.sparkSession.createDataFrame([], "suggestion string, score double, n long")
    hits = expanded(index, terms, [False] * (len(terms) - 1) + [True], fuzzy)
    scored = _matched(index, hits).select("doc", "q", "asked", "term", (F.col("weight") * bm25(F.col("tf"), F.col("df"), F.col("docs"), F.col("length"), F.col("mean"))).alias("s"))
    docs = scored.groupBy("doc").agg(F.count_distinct("q").alias("n"), F.size(F.collect_set("asked")).alias("terms"), F.array_join(F.transform(F.sort_array(F.collect_set(F.struct("q", "term"))), lambda x: x["term"]), " ").alias("suggestion"), F.sum("s").alias("s")).where(F.col("n") == len(terms))
    return docs.groupBy("suggestion").agg(F.avg(F.col("s") * F.col("terms")).alias("score"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("score"), "suggestion")
