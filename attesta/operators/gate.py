"""Second-opinion gate: an independent verdict may veto or break a tie, and may never originate a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .constraints import LEAST, MOST, ConstraintError, require
from .storage import cut, numbered

# Fixed values.
AGREE, BLOCKED, FLAGGED, ESCALATED, WITHDRAWN, REFUSED, CANNOT_VERIFY = "agree", "blocked", "flagged", "escalated", "published_support_withdrawn", "refused", "cannot_verify"
#: Lines of a chunk of ``fingerprint_chunked``.
CHUNK = 4096
TASK_COLUMNS = ("document_id", "source_url", "text", "kazakh_text")


def blind(tasks: DataFrame) -> DataFrame:
    """The whitelist that a second reader may see: nothing the first one concluded."""
    return tasks.select(*TASK_COLUMNS)


def tasks_and_missing(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tasks for documents with text, and the ids of those without."""
    good = ~T.is_blank(F.col("text"))
    return blind(documents.where(good)), documents.where(~good).select("document_id").distinct()


def objection(rate: Column, refused: Column, span: Column, text: Column) -> Column:
    """The first structural objection to a verdict, or null."""
    digits = F.round(rate * 100).cast("int").cast("string")
    return (
        F.when(refused, None)
        .when(rate.isNull(), "no-rate")
        .when(~F.isnan(rate) & (rate > 1), "above-one")
        .when(F.isnan(rate) | ~rate.between(LEAST, MOST), "outside-band")
        .when(F.coalesce(span, F.lit("")) == "", "no-span")
        .when(text.isNull(), "no-text")
        .when(~text.contains(span), "span-not-in-text")
        .when(~span.contains(digits), "span-without-digits")
    )


def decide(refused: Column, model: Column, parser: Column, published: Column, unverifiable: Column, objects: Column) -> Column:
    same = model.cast("decimal(10,4)") == parser.cast("decimal(10,4)")
    return (
        F.when(unverifiable, CANNOT_VERIFY)
        .when(refused | objects.isNotNull(), REFUSED)
        .when(parser.isNull(), F.when(published, WITHDRAWN).otherwise(ESCALATED))
        .when(same, AGREE)
        .when(published, FLAGGED)
        .otherwise(BLOCKED)
    )


def compare(verdicts: DataFrame, parsed: DataFrame, published: DataFrame, tasks: DataFrame) -> DataFrame:
    """verdicts: (document_id, rate, refused, quoted_span); parsed: (document_id, rate); published: (document_id); tasks:
    (document_id, text). Gives (document_id, outcome, model_rate, parser_rate, reason)."""
    j = (
        verdicts.select("document_id", F.col("rate").cast("double").alias("model"), F.coalesce("refused", F.lit(False)).alias("refused"), "quoted_span")
        .join(parsed.select("document_id", F.col("rate").alias("parser")), "document_id", "left")
        .join(published.select("document_id", F.lit(True).alias("published")).distinct(), "document_id", "left")
        .join(tasks.select("document_id", "text"), "document_id", "left")
    )
    reason = objection(F.col("model"), F.col("refused"), F.col("quoted_span"), F.col("text"))
    unverifiable = ~F.col("refused") & F.col("model").isNotNull() & F.col("text").isNull()
    outcome = decide(F.col("refused"), F.col("model"), F.col("parser"), F.coalesce("published", F.lit(False)), unverifiable, reason)
    out = j.select("document_id", outcome.alias("outcome"), "model", "parser", reason.alias("reason"))
    told = ~F.col("outcome").isin(CANNOT_VERIFY, REFUSED)
    return out.select("document_id", "outcome", F.when(told, F.col("model")).alias("model_rate"), F.when(told, F.col("parser")).alias("parser_rate"), "reason")


def report(results: DataFrame, population: DataFrame) -> DataFrame:
    """Counts by outcome, and of those that no verdict covers."""
    counts = results.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    never = population.select("document_id").distinct().join(results, "document_id", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("no-verdict").alias("outcome"), "n")
    return counts.unionByName(never)


def merge_batches(batches: list[DataFrame], key: str = "document_id") -> DataFrame:
    """Disjoint union; an id in two batches is an error that names it."""
    if not batches:
        raise ConstraintError("no verdict batches")
    out = None
    for i, b in enumerate(batches):
        b = b.withColumn("__batch", F.lit(i))
        out = b if out is None else out.unionByName(b, allowMissingColumns=True)
    require(out.groupBy(key).agg(F.array_sort(F.collect_set("__batch")).alias("batches"), F.count(F.lit(1)).alias("n")).where("n > 1"), "id in several batches")
    return out.drop("__batch")


def fingerprint(pairs: DataFrame, key: str, value: str, most: int = 1_000_000) -> DataFrame:
    """sha256 of the sorted key=value lines: independent of order and partitioning. One row by definition; for published tables, which
    are small: more than ``most`` rows are an error. ``fingerprint_large`` has one for tables of any size."""
    if pairs.limit(most + 1).count() > most:
        raise ConstraintError(f"over {most} rows; see fingerprint_large")
    line = F.concat_ws("=", F.col(key).cast("string"), F.col(value).cast("string"))
    return pairs.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("fingerprint"))


def fingerprint_large(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """An order-free digest by sums of two hashes of the lines; constant memory."""
    line = F.concat_ws("=", F.col(key).cast("string"), F.col(value).cast("string"))
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return pairs.agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), total(F.xxhash64(line)), total(F.xxhash64(F.lit(1), line))), 256).alias("fingerprint"))


def fingerprint_chunked(pairs: DataFrame, key: str, value: str, chunk: int = CHUNK) -> DataFrame:
    """As ``fingerprint`` for up to ``chunk`` rows; beyond, the sorted lines are digested by chunks of as many, these digests again, until one is
    left. One value for any partitioning and number of rows; no task holds more than a chunk beside its sorted share."""
    line = F.concat_ws("=", F.col(key).cast("string"), F.col(value).cast("string"))
    level = numbered(pairs.select(line.alias("line")), ["line"])
    n = level.count()
    while True:
        own = F.sort_array(F.collect_list(F.struct("pos", "line")))
        level = level.groupBy(F.floor(F.col("pos") / chunk).alias("pos")).agg(F.sha2(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), 256).alias("line"))
        n = -(-n // chunk)
        if n <= 1:
            return level.agg(F.coalesce(F.max("line"), F.sha2(F.lit(""), 256)).alias("fingerprint"))
        level = cut(level)


def require_verified(results: DataFrame) -> None:
    require(results.where(F.col("outcome") == CANNOT_VERIFY), "cannot verify")


def population(confirmed: DataFrame, queued: DataFrame) -> DataFrame:
    """(document_id): all that were ever read, sorted."""
    return confirmed.select("document_id").union(queued.select("document_id")).distinct().orderBy("document_id")


def ingest(results: DataFrame, parsed: DataFrame, path: str, allow_shrink: bool = False) -> str:
    """Store the gate's results with the fingerprint of the parser rates they were held against; refused if a verdict cannot be verified or
    stored results would go. Returns the fingerprint."""
    from ..sources.tables import optional, swap_write
    from .constraints import require_no_shrink

    spark = results.sparkSession
    require_verified(results)
    old = optional(lambda: spark.read.parquet(path), spark, results.schema)
    require_no_shrink(old, results, "document_id", allow_shrink)
    mark = fingerprint_large(parsed, "document_id", "rate").first().fingerprint
    swap_write(results.withColumn("parser_fingerprint", F.lit(mark)), path)
    return mark


def stale(stored: DataFrame, parsed: DataFrame) -> bool:
    """Whether the stored results were held against other parser rates; results without a fingerprint are not stale."""
    if "parser_fingerprint" not in stored.columns:
        return False
    marks = [r[0] for r in stored.select("parser_fingerprint").distinct().limit(2).collect() if r[0]]
    return bool(marks) and marks != [fingerprint_large(parsed, "document_id", "rate").first().fingerprint]
