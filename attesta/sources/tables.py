"""Sources and sinks: CSV, JSON envelopes, blobs with sidecars; writes are guarded, and swapped in whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..operators.constraints import ConstraintError, require, require_no_shrink
from ..operators.storage import cut

RATES = T.StructType([T.StructField(c, T.StringType()) for c in ("kato", "kato_version", "name_ru", "name_kk", "rate", "base_rate", "valid_from", "valid_to", "decision_ref", "source_url", "kazakh_source_url", "extraction_method")])
KATO = T.StructType([T.StructField(c, T.StringType()) for c in ("kato", "kato_version", "level", "type_code", "name_ru", "name_kk")])
MIGRATIONS = T.StructType([T.StructField(c, T.StringType()) for c in ("retired_kato", "current_kato", "effective_from", "kato_version_from", "kato_version_to", "source_url", "note")])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All columns strings (codes keep leading zeros); a doubled quote is a quote; the header has to agree with the schema."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("multiLine", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, line_end: str = "\n") -> None:
    """One file, for small published tables."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("lineSep", line_end).option("escape", '"').option("quoteAll", False).csv(path)


def with_lines(df: DataFrame, first: int = 2) -> DataFrame:
    """Adds ``line``, the place in the file, for a table that one task reads (CSV with line breaks in fields is never split)."""
    return df.withColumn("line", F.monotonically_increasing_id() + first)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, value) of text files of any size: ``line`` counts from 1 within its file, whatever splits it is read in. Two passes: lines are counted by
    split, and numbered from the count of the splits before."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("__id"))
    splits = rows.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("__first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    met = rows.join(F.broadcast(splits.select("path", "start", "__first", before.alias("before"))), ["path", "start"])
    return met.select("path", (F.col("before") + F.col("__id") - F.col("__first") + 1).alias("line"), "value")


def read_csv_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As read_csv, with ``line``: the line of the file that holds the row. For files without line breaks in fields, which are split; blank lines are
    no rows. Every file starts with a header that has to agree with the schema."""
    lines = text_lines(spark, path)
    options = {"escape": '"', "mode": "FAILFAST"}
    names = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    # a byte order mark and a carriage return belong to the line's ends
    parsed = lines.select("path", "line", F.from_csv(F.regexp_replace("value", "^\ufeff|\r$", ""), names.simpleString()[7:-1].replace(":", " "), options).alias("r")).where(F.trim("value") != "")
    wrong = parsed.where(F.col("line") == 1).where(~F.to_json(F.array(*[F.col("r")[c] for c in names.names])).eqNullSafe(F.to_json(F.array(*[F.lit(c) for c in names.names]))))
    require(wrong.select("path"), "a header that disagrees")
    return parsed.where("line > 1").select(*[F.col("r")[c].alias(c) for c in names.names], "line")


def code_set(codes: DataFrame, column: str = "kato") -> DataFrame:
    return codes.select(F.trim(F.col(column)).alias("code")).where("code <> ''").distinct()


def at_level(codes: DataFrame, level: str) -> DataFrame:
    return codes.where(F.col("level") == level).select(F.trim("kato").alias("code"), strip(F.col("name_ru")).alias("name"))


def migrations(spark: SparkSession, path: str) -> DataFrame:
    """(retired, current, effective_from); an edge without a source is an error, a missing file has no edges."""
    try:
        rows = read_csv(spark, path, MIGRATIONS)
        require(rows.where(F.coalesce(F.trim("source_url"), F.lit("")) == "").select("retired_kato"), "migration without a source")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], MIGRATIONS)
    return rows.select(F.trim("retired_kato").alias("retired"), F.trim("current_kato").alias("current"), "effective_from")


def read_envelope(spark: SparkSession, path: str, field: str) -> DataFrame:
    """The rows of {..., field: [...]}; other top-level fields are dropped. A missing file or field is an error here; see ``optional``."""
    df = spark.read.option("multiLine", True).json(path)
    if field not in df.columns:
        raise ConstraintError(f"{path} has no {field}")
    return df.select(F.explode(field).alias("__row")).select("__row.*")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of objects; an object at the top is an error."""
    head = spark.read.text(path, wholetext=True).select(F.substring(F.ltrim("value"), 1, 1).alias("c")).where("c <> '['")
    require(head, f"{path} is no JSON list")
    return spark.read.option("multiLine", True).json(path)


def envelope_value(spark: SparkSession, path: str, field: str) -> str:
    rows = spark.read.option("multiLine", True).json(path)
    if field not in rows.columns:
        raise ConstraintError(f"{path} has no {field}")
    return rows.select(field).first()[0]


def optional(read, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table where the file is missing; other errors stay errors."""
    try:
        return read()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def published_ids(rates: DataFrame) -> DataFrame:
    """Document ids from the ends of the source URLs."""
    return rates.select(F.regexp_extract("source_url", r"/docs/([A-Za-z0-9]+)/?$", 1).alias("document_id")).where("document_id <> ''").distinct()


def last_wins(rows: DataFrame, key: str, pos: str) -> DataFrame:
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), pos).alias("__r")).select(key, "__r.*")


def blobs(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(name, content, sha256) of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("name"), "content", F.sha2("content", 256).alias("sha256"))


def verified_blobs(files: DataFrame, sidecars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blobs whose digest agrees with their sidecar (name, sha256), and the names to fetch again."""
    good = files.join(sidecars, ["name", "sha256"])
    again = files.select("name").union(sidecars.select("name")).distinct().join(good.select("name"), "name", "left_anti")
    return good, again


def swap_write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Written aside, then renamed: a failed write leaves what was there, and so does a failure between the renames, beside the new one."""
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.format(fmt).save(aside)
    jvm = spark.sparkContext._jvm
    at, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(aside)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{aside}.old")
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"cannot move {aside} to {path}")
    if had:
        fs.delete(old, True)


def split_write(results: DataFrame, confirmed_path: str, queue_path: str, key: str = "document_id", allow_shrink: bool = False) -> dict[str, int]:
    """Confirmed rows to one table, the others to another; refused if confirmed rows that exist would go. Returns counts by outcome. The two are swapped
    one after the other; publish.publish_split has both in one commit."""
    spark, results = results.sparkSession, cut(results)
    good = results.where("outcome = 'confirmed'")
    old = optional(lambda: spark.read.parquet(confirmed_path), spark, good.schema)
    require_no_shrink(old, results, key, allow_shrink)
    counts = {r.outcome: r["count"] for r in results.groupBy("outcome").count().collect()}
    swap_write(good, confirmed_path)
    swap_write(results.where("outcome <> 'confirmed'"), queue_path)
    return counts


def write_tasks(tasks: DataFrame, path: str, full: bool) -> None:
    """One folder per document; a full run replaces all, an explicit list of ids adds."""
    tasks.write.partitionBy("document_id").mode("overwrite" if full else "append").json(path)


EXTRACTED = "document_id string, outcome string, rate double"
VERDICTS = "document_id string, rate double, refused boolean, quoted_span string, refusal_reason string"


def oblast_names(codes: DataFrame) -> DataFrame:
    """(prefix, ru, kk) of the oblasts; of several with one prefix the last by code."""
    own = codes.where("level = 'oblast'").select(F.substring(F.trim("kato"), 1, 2).alias("prefix"), F.struct(strip(F.col("name_ru")).alias("ru"), strip(F.col("name_kk")).alias("kk")).alias("names"), "kato")
    return own.groupBy("prefix").agg(F.max_by("names", "kato").alias("names")).select("prefix", "names.ru", "names.kk")


def names_by_code(codes: DataFrame) -> DataFrame:
    """(code, name_ru, name_kk)"""
    return codes.select(F.trim("kato").alias("code"), "name_ru", "name_kk")


def parser_rates(extracted: DataFrame) -> DataFrame:
    """(document_id, rate) of what the readers confirmed."""
    return extracted.where("outcome = 'confirmed'").select("document_id", F.col("rate").cast("double").alias("rate"))


def queue_ids(queue: DataFrame) -> DataFrame:
    """(document_id), sorted, distinct, not empty."""
    return queue.select(F.trim("document_id").alias("document_id")).where("document_id <> ''").distinct().orderBy("document_id")


def unavailable_log(spark: SparkSession, path: str) -> DataFrame:
    """(document_id) of a JSON list of ids or of objects; a missing file has none."""
    rows = optional(lambda: read_list(spark, path), spark, T.StructType([T.StructField("document_id", T.StringType())]))
    return rows.select("document_id").distinct()


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """(kato, name_ru, name_kk, resolves_to) of a JSON list of four-element lists; a missing file has none."""
    lines = optional(lambda: spark.read.text(path, wholetext=True), spark, T.StructType([T.StructField("value", T.StringType())]))
    rows = lines.select(F.explode(F.from_json("value", "array<array<string>>")).alias("r"))
    return rows.select(*[F.get("r", F.lit(i)).alias(c) for i, c in enumerate(("kato", "name_ru", "name_kk", "resolves_to"))])


def read_through(files: DataFrame, sidecars: DataFrame, fetch) -> tuple[DataFrame, DataFrame]:
    """Verified blobs with those fetched anew: ``fetch`` takes the names (name) whose digest fails or that lack a part, and
    gives (name, content). The second table holds the sidecars to write."""
    good, again = verified_blobs(files, sidecars)
    new = fetch(again).select("name", "content", F.sha2("content", 256).alias("sha256"))
    return good.select("name", "content", "sha256").unionByName(new), new.select("name", "sha256")


def write_with_source(df: DataFrame, path: str, source: dict[str, object]) -> None:
    """A classifier and, beside it, where it came from, with counts by level and the digest of its codes."""
    import json

    write_csv(df, path)
    counts = {r.level: r.n for r in df.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    from ..operators.gate import fingerprint_chunked

    digest = fingerprint_chunked(df.select("kato", "level"), "kato", "level").first().fingerprint
    text = json.dumps({**source, "rows": sum(counts.values()), "by_level": dict(sorted(counts.items())), "codes_sha256": digest}, ensure_ascii=False, indent=2)
    write_text(df.sparkSession, f"{path.rstrip('/')}.source.json", text)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, through the file system that the path names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_rows_json(df: DataFrame, path: str, order: list[str]) -> None:
    """A small table as one pretty JSON list in a given order, nulls kept, letters as they are."""
    import json

    rows = [json.loads(r[0]) for r in df.orderBy(*order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).collect()]
    write_text(df.sparkSession, path, json.dumps(rows, ensure_ascii=False, indent=2))
