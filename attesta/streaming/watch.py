"""A watcher over a folder of listings: new, changed and vanished documents. No change is told apart from could-not-check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import ConstraintError

LISTING = "document_id string, title string, fetched_at timestamp"


def stream(spark: SparkSession, folder: str, lateness: str = "7 days") -> DataFrame:
    """First sight of each (document, title) within the lateness."""
    return spark.readStream.schema(LISTING).json(folder).withWatermark("fetched_at", lateness).dropDuplicatesWithinWatermark(["document_id", "title"])


def counted(spark: SparkSession, folder: str, window: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """Sightings by window of time, late ones included up to the lateness."""
    rows = spark.readStream.schema(LISTING).json(folder).withWatermark("fetched_at", lateness)
    return rows.groupBy(F.window("fetched_at", window).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


def difference(known: DataFrame, now: DataFrame) -> DataFrame:
    """(document_id, change): new, changed or gone."""
    k, n = known.select("document_id", F.col("title").alias("__old")), now.select("document_id", F.col("title").alias("__new"))
    both = k.join(n, "document_id", "full_outer")
    change = F.when(F.col("__old").isNull(), "new").when(F.col("__new").isNull(), "gone").when(F.col("__old") != F.col("__new"), "changed")
    return both.select("document_id", change.alias("change")).where("change is not null")


def checked(known: DataFrame, now: DataFrame, canary: str) -> DataFrame:
    """The difference, if the listing holds the canary document; else an error, not an empty difference."""
    if not now.where(F.col("document_id") == canary).limit(1).count():
        raise ConstraintError("the listing lacks its canary: could not check")
    return difference(known, now)


def run(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], None]):
    return stream(spark, folder).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle).start()
