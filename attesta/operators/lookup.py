"""Lookup of indexed terms without a pass over the vocabulary for each asked term: ranges for prefixes, segments for near terms.

A term within k edits of an asked one keeps at least one of its k + 1 segments unchanged, at most k places away (pigeonhole). So terms are indexed by
(edits, length, segment number, segment), the asked term is cut into all substrings that can meet such a segment, and both meet in an equi
join; a bounded distance then verifies. This holds for any number of edits. Terms no longer than k have no segments: they are found by length alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = "edits int, size int, i int, part string"


def after(prefix: str) -> str | None:
    """The least string greater than all strings that start with ``prefix``, in code point order; null if there is none."""
    while prefix:
        c = ord(prefix[-1]) + 1
        if c <= 0x10FFFF:
            return prefix[:-1] + chr(0xE000 if 0xD800 <= c < 0xE000 else c)
        prefix = prefix[:-1]
    return None


def starts_with(term: Column, prefix: str) -> Column:
    """As a range, which a scan of sorted files can skip by."""
    end = after(prefix)
    return (term >= prefix) if end is None else (term >= prefix) & (term < end)


def cuts(size: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the edits + 1 segments of a term, the longer ones last; one empty segment if the term is too short."""
    if size <= edits:
        return [(0, 0)]
    short, longer = divmod(size, edits + 1)
    lengths = [short] * (edits + 1 - longer) + [short + 1] * longer
    return [(sum(lengths[:i]), n) for i, n in enumerate(lengths)]


def parts(terms: DataFrame, edits: int) -> DataFrame:
    """(*columns of ``terms``, edits, size, i, part): the segments of its column ``term``. See cuts()."""
    size, n = F.char_length("term"), edits + 1
    short, longer = F.floor(F.col("size") / n).cast("int"), F.col("size") % n
    split = F.col("size") > edits
    rows = terms.select("*", F.lit(edits).alias("edits"), size.alias("size")).select("*", F.explode(F.when(split, F.sequence(F.lit(0), F.lit(edits))).otherwise(F.array(F.lit(0)))).alias("i"))
    start = F.col("i") * short + F.greatest(F.lit(0), F.col("i") - (n - longer))
    length = short + (F.col("i") >= n - longer).cast("int")
    return rows.withColumn("part", F.when(split, F.col("term").substr(start + 1, length)).otherwise(""))


def probes(asked: str, edits: int) -> list[tuple[int, int, int, str]]:
    """The keys (edits, size, i, part) at least one of which every term within ``edits`` of ``asked`` has."""
    out = set()
    for size in range(max(1, len(asked) - edits), len(asked) + edits + 1):
        for i, (start, n) in enumerate(cuts(size, edits)):
            for s in range(max(0, start - edits), min(len(asked) - n, start + edits) + 1) if n else (0,):
                out.add((edits, size, i, asked[s : s + n]))
    return sorted(out)


def asked_probes(spark: SparkSession, asked: list[tuple[int, str, bool, int]]) -> DataFrame:
    """(q, asked, prefix, edits, size, i, part) of the asked terms (q, asked, prefix, edits) that may differ."""
    rows = [(q, a, p, *key) for q, a, p, k in asked if k > 0 for key in probes(a, k)]
    return spark.createDataFrame(rows, f"q int, asked string, prefix boolean, {PARTS}")


def exact_or_prefix(terms: DataFrame, asked: list[tuple[int, str, bool, int]]) -> DataFrame:
    """``terms`` with (q, asked, prefix, edits) for each asked term that it equals or, if that is a prefix, starts with."""
    term = F.col("term")
    ways = [starts_with(term, a) if p else term == a for _, a, p, _ in asked]
    wanted = ways[0]
    for w in ways[1:]:
        wanted |= w
    each = [F.when(w, F.struct(F.lit(q).alias("q"), F.lit(a).alias("asked"), F.lit(p).alias("prefix"), F.lit(k).alias("edits"))) for w, (q, a, p, k) in zip(ways, asked, strict=True)]
    return terms.where(wanted).select("*", F.explode(F.array_compact(F.array(*each))).alias("a")).select(*terms.columns, "a.*")


def bytewise(text: Column) -> Column:
    """A character for each byte of the text in UTF-8."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def near(parted: DataFrame, asked: list[tuple[int, str, bool, int]], by_bytes: bool = False) -> DataFrame:
    """The rows of ``parted`` (see parts) within the edits of an asked term, once for each, with (q, asked, prefix, edits, distance); those that
    exact_or_prefix finds are left out. ``by_bytes``: edits are of bytes in UTF-8, which are never fewer than those of characters, so that segments of characters
    lose none."""
    keep = [c for c in parted.columns if c not in ("edits", "size", "i", "part")]
    met = parted.join(F.broadcast(asked_probes(parted.sparkSession, asked)), ["edits", "size", "i", "part"])
    found = met.where((F.col("term") != F.col("asked")) & ~(F.col("prefix") & F.col("term").startswith(F.col("asked")))).select(*keep, "q", "asked", "prefix", "edits").distinct()
    most = max(k for *_, k in asked)
    a, b = (bytewise(F.col(c)) if by_bytes else F.col(c) for c in ("asked", "term"))
    return found.withColumn("distance", F.levenshtein(a, b, most)).where((F.col("distance") >= 0) & (F.col("distance") <= F.col("edits")))
