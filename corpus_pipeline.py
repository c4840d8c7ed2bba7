"""From raw documents to tokens: quality, line dedup, near duplicates, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of documents; the last one returns tokens.
Null and empty texts pass through all stages unless the classifier rejects them; an empty table gives an empty result. Of tied or repeated
rows one stays after the near-duplicate stage: that of the least doc_id. Texts are taken whole, whatever their length. Other
columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attesta.llm import bpe, decontamination, jaccard, lines, quality
from attesta.llm.common import discard, scratch, small_batches, stored, table


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat earlier ones go; a document that had text and loses all of it goes too."""
    told = free_name(docs, "lines")
    marked = lines.deduplicated(docs, into=told)
    kept = F.col(told)["kept"]
    lost = F.col("text").rlike(r"\S") & ~kept.rlike(r"\S") & (F.col(told)["near"] + F.col(told)["exact"] > 0)
    stay = marked.where(~F.coalesce(lost, F.lit(False)))
    new = {"text": kept, "n_chars": F.char_length(kept)}
    return stay.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id stays; of repeated rows, one. Texts are not shuffled, but
    those of repeated rows."""
    with scratch(spark):
        found = jaccard.near_duplicates(docs)
        least = stored(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id")).distinct(), "kept", outer=True)
        digest = F.xxhash64("text").alias("digest")
        again = stored(docs.select("doc_id", digest).groupBy("doc_id", "digest").count().where("count > 1"), "again", outer=True)
    stay = docs.join(least, docs["doc_id"].eqNullSafe(least["id"]), "left_semi")
    if not again.limit(1).count():
        return stay
    same = stay["doc_id"].eqNullSafe(again["doc_id"]) & F.xxhash64(stay["text"]).eqNullSafe(again["digest"])
    nth = free_name(docs, "nth")
    first = stay.join(again, same, "left_semi").withColumn(nth, F.row_number().over(W.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))))
    return stay.join(again, same, "left_anti").union(first.where(F.col(nth) == 1).drop(nth))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold enough of the benchmark go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids)"""
    small_batches(spark)
    coded = docs.select("doc_id", "lang", "source", bpe.digests(bpe.share(spark), True)(F.col("text")).alias("coded"))
    return coded.select("doc_id", "lang", "source", "coded.*")


STAGES = [("quality", keep_good), ("line dedup", drop_lines), ("near duplicates", keep_one_of_each), ("decontamination", keep_clean), ("bpe", tokens)]
#: The classifier, component search and tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"), outer=True)
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
