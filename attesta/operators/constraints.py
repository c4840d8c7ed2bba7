"""Row, reference and interval constraints: each violation is a row (line, rule, message)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

# Fixed values.
NULL_LIKE = ("none", "null", "nan")
LEAST, MOST = 0.02, 0.06
HOST = "https://adilet.zan.kz/"
REQUIRED = ("decision_ref", "source_url", "kazakh_source_url", "extraction_method", "kato_version")


class ConstraintError(ValueError):
    pass


def violations(df: DataFrame, keys: list[str], rules: Iterable[tuple[str, Column, Column | str]]) -> DataFrame:
    """All violated rules of each row, not only the first; a null condition is no violation."""
    entries = [F.when(bad, F.struct(F.lit(rule).alias("rule"), (F.lit(say) if isinstance(say, str) else say).alias("message"))) for rule, bad, say in rules]
    return df.select(*keys, F.explode(F.array_compact(F.array(*entries))).alias("v")).select(*keys, "v.rule", "v.message")


def is_null_like(value: Column) -> Column:
    return F.lower(T.strip(value)).isin(*NULL_LIKE)


def rate_rules(rate: Column) -> list[tuple[str, Column, Column | str]]:
    """No number; else a percentage; else outside the band. NaN is no fraction, and outside the band."""
    value = T.number(T.strip(rate))
    nan = F.isnan(value)
    percent = ~nan & (value > 1)
    return [
        ("rate-not-a-number", value.isNull(), F.concat(F.lit("no number: "), F.coalesce(rate, F.lit("")))),
        ("rate-percentage", percent, F.concat(F.lit("a percentage, not a fraction: "), rate)),
        ("rate-band", value.isNotNull() & ~percent & (nan | ~value.between(LEAST, MOST)), F.concat(F.lit("outside the band: "), rate)),
    ]


def row_violations(rates: DataFrame, line: str = "line") -> DataFrame:
    ref = T.strip(F.coalesce("decision_ref", F.lit("")))
    rules: list[tuple[str, Column, Column | str]] = [("kato-format", ~F.coalesce(T.strip(F.col("kato")), F.lit("")).rlike(r"^[0-9]{9}$"), "not nine digits")]
    rules += [(f"{c}-empty", T.is_blank(F.col(c)), f"{c} is empty") for c in REQUIRED]
    rules.append(("decision_ref-null-like", is_null_like(ref), "a null written as text"))
    rules.append(("decision_ref-no-citation", (ref != "") & ~is_null_like(ref) & ~(ref.contains("Решение") & ref.contains("№")), "no citation"))
    for c in ("source_url", "kazakh_source_url"):
        url = T.strip(F.coalesce(c, F.lit("")))
        rules.append((f"{c}-null-like", is_null_like(url), "a null written as text"))
        rules.append((f"{c}-host", (url != "") & ~is_null_like(url) & ~url.startswith(HOST), "another host"))
    return violations(rates, [line], rules + rate_rules(F.col("rate")))


def missing_references(rows: DataFrame, key: str, known: DataFrame, known_key: str | None = None, line: str = "line") -> DataFrame:
    k = known.select(F.trim(F.col(known_key or key)).alias("__k")).distinct()
    lost = rows.join(k, F.trim(F.col(key)) == F.col("__k"), "left_anti")
    return lost.select(line, F.lit("unknown-code").alias("rule"), F.concat(F.lit("unknown: "), F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("message"))


def overlaps(rows: DataFrame, keys: list[str], start: str = "valid_from", stop: str = "valid_to", line: str = "line", strict: bool = False) -> DataFrame:
    """Reversed intervals, and intervals (inclusive) of equal trimmed keys that overlap: with the one before in order of start, or, if strict, with
    any before (a long one can reach over its neighbour)."""
    reversed_ = rows.where(F.col(start) > F.col(stop)).select(line, F.lit("reversed").alias("rule"), F.lit("starts after its end").alias("message"))
    w = W.partitionBy(*[F.trim(F.col(k).cast("string")) for k in keys]).orderBy(start, line)
    last = F.max(stop).over(w.rowsBetween(W.unboundedPreceding, -1)) if strict else F.lag(stop).over(w)
    bad = rows.where(F.col(start) <= F.col(stop)).select(line, F.col(start).alias("__start"), last.alias("__last")).where("__start <= __last")
    return reversed_.unionByName(bad.select(line, F.lit("overlap").alias("rule"), F.lit("overlaps an earlier interval").alias("message")))


def overlapping_pairs(rows: DataFrame, keys: list[str], start: str = "valid_from", stop: str = "valid_to", line: str = "line") -> DataFrame:
    """(line, other): each pair of intervals (inclusive, of dates) of equal trimmed keys that overlap, once, the smaller line first. An interval joins by
    bins as wide as a power of two that holds its length, so that it lies in two of them at most; shorter ones look into the bins of
    every width there is. No key's rows have to meet in one task, and nothing is compared beyond neighbours in time. Null keys are no key."""
    own = [F.trim(F.col(k).cast("string")).alias(f"__k{i}") for i, k in enumerate(keys)]
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    good = rows.where(F.col(start) <= F.col(stop)).select(*own, F.col(line).alias("line"), day(start).alias("a"), day(stop).alias("b"))
    wide = F.ceil(F.log2(F.greatest(F.lit(1), F.col("b") - F.col("a") + 1))).cast("int")
    sized = good.select("*", wide.alias("w"))
    names = [f"__k{i}" for i in range(len(keys))]
    bins = lambda w: F.explode(F.sequence(F.floor(F.col("a") / F.pow(F.lit(2.0), w)).cast("long"), F.floor(F.col("b") / F.pow(F.lit(2.0), w)).cast("long")))
    longer = sized.select(*names, "line", "a", "b", "w", bins(F.col("w")).alias("bin"))
    widths = sized.groupBy().agg(F.sort_array(F.collect_set("w")).alias("all"))  # at most one for each bit of a date
    looking = sized.crossJoin(F.broadcast(widths)).select(*names, F.col("line").alias("o_line"), F.col("a").alias("o_a"), F.col("b").alias("o_b"), F.col("w").alias("o_w"), "a", "b", F.explode(F.filter("all", lambda w: w >= F.col("w"))).alias("w"))
    looking = looking.select(*names, "o_line", "o_a", "o_b", "o_w", "w", bins(F.col("w")).alias("bin"))
    met = longer.join(looking, [*names, "w", "bin"]).where((F.col("a") <= F.col("o_b")) & (F.col("o_a") <= F.col("b")) & ((F.col("o_w") < F.col("w")) | (F.col("o_line") < F.col("line"))))
    first = F.col("bin") == F.floor(F.greatest("a", "o_a") / F.pow(F.lit(2.0), F.col("w"))).cast("long")  # of the bins that both lie in
    return met.where(first).select(F.least("line", "o_line").alias("line"), F.greatest("line", "o_line").alias("other"))


def validate(rates: DataFrame, codes: DataFrame, migrations: DataFrame | None = None) -> DataFrame:
    """Every row, reference and interval violation of a rates table with a ``line`` column. codes: (kato); a retired code that
    ``migrations`` (retired, current) lead to one of them is known too."""
    if migrations is not None:
        from .temporal import resolvable

        codes = resolvable(codes.select(F.trim("kato").alias("code")), migrations).select(F.col("code").alias("kato"))
    return row_violations(rates).unionByName(missing_references(rates, "kato", codes)).unionByName(overlaps(rates, ["kato", "kato_version"]))


def validate_file(spark, path: str, codes: DataFrame, migrations: DataFrame | None = None) -> DataFrame:
    """The violations of a file; a missing file, or a header that differs, is the only one told then."""
    from ..sources.tables import RATES, read_csv, with_lines

    failure = lambda rule, say: spark.createDataFrame([(None, rule, say)], "line long, rule string, message string")
    try:
        head = spark.read.option("header", True).csv(path).columns
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return failure("file-missing", f"{path} is missing")
    if head != RATES.names:
        return failure("file-header", f"header {head}, expected {RATES.names}")
    found = validate(with_lines(read_csv(spark, path, RATES)), codes, migrations)
    return found.select(F.col("line").cast("long").alias("line"), "rule", "message")


def deferred() -> list[str]:
    """Checks that are known and not made: none; told all the same."""
    return []


def require(bad: DataFrame, what: str) -> None:
    """An action of its own before a write: a raise inside a projection can be optimised away."""
    rows = bad.limit(5).collect()
    if rows:
        raise ConstraintError(f"{what}: {[r.asDict() for r in rows]}")


def require_header(df: DataFrame, columns: list[str]) -> DataFrame:
    if df.columns != columns:
        raise ConstraintError(f"header {df.columns}, expected {columns}")
    return df


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    require(df.groupBy(*keys).count().where("count > 1"), "duplicate keys")
    return df


def require_single(df: DataFrame, column: str) -> str:
    values = [r[0] for r in df.select(T.strip(F.col(column))).distinct().limit(2).collect()]
    if len(values) != 1:
        raise ConstraintError(f"{column} has {len(values)} values, expected one")
    return values[0]


def require_no_shrink(existing: DataFrame, new: DataFrame, key: str, allow: bool = False) -> None:
    if not allow:
        require(existing.select(key).join(new.select(key), key, "left_anti"), "would shrink what was published")
