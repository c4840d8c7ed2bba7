"""Intermediate tables of iterative operators, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession, name: str) -> str:
    """A folder that is not there yet, below spark.checkpoint.dir; only on one machine, where that is unset, a local one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        at = tempfile.mkdtemp(prefix="attesta-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def hadoop(spark: SparkSession, path: str):
    """A path and the file system that it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cut(df: DataFrame) -> DataFrame:
    """``df`` written and read again: its plan starts anew, and it outlives any executor. The files go when the driver's JVM ends."""
    spark = df.sparkSession
    path = folder(spark, "cut")
    df.write.parquet(path)
    at, files = hadoop(spark, path)
    files.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def cut_and_count(df: DataFrame, where: Column) -> tuple[DataFrame, int]:
    """cut(), and how many rows ``where`` holds for, counted as they are written."""
    seen = Observation()
    out = cut(df.observe(seen, F.count_if(where).alias("n")))
    return out, seen.get["n"]


def numbered(rows: DataFrame, by: list[str], name: str = "pos") -> DataFrame:
    """``rows`` with their place in the order ``by``, from 0. Two passes: sorted partitions of ranges are written, then numbered by the counts of those
    before. Equal rows are told apart by where they lie, so that many of them do not meet in one task."""
    spark, kept = rows.sparkSession, cut(rows)
    tie = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    dealt = kept.select("*", tie.alias("__tie")).repartitionByRange(*by, "__tie").sortWithinPartitions(*by, "__tie").drop("__tie")
    own = F.monotonically_increasing_id()
    sorted_ = cut(dealt.select("*", F.shiftright(own, 33).cast("int").alias("__part"), own.bitwiseAND(F.lit((1 << 33) - 1)).alias("__nth")))
    offsets, before = [], 0
    for r in sorted(sorted_.groupBy("__part").count().collect(), key=lambda r: r[0]):  # one for each partition
        offsets.append((r[0], before))
        before += r[1]
    offset = F.broadcast(spark.createDataFrame(offsets, "__part int, __offset long"))
    return sorted_.join(offset, "__part").withColumn(name, F.col("__offset") + F.col("__nth")).drop("__part", "__nth", "__offset")
