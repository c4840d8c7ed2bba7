"""Codes over time: levels from digit positions, chains of replaced codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import cut, cut_and_count

LEVELS = ("oblast", "district", "sub_district", "settlement")


def level_of(code: Column) -> Column:
    """From the zeros of AB CD EF HIJ, outermost first; null if it is not nine digits."""
    zero = lambda start, size: F.substring(code, start, size) == "0" * size
    district, sub, settlement = zero(3, 2), zero(5, 2), zero(7, 3)
    level = F.when(district & sub & settlement, LEVELS[0]).when(sub & settlement, LEVELS[1]).when(settlement, LEVELS[2]).otherwise(LEVELS[3])
    return F.when(code.rlike(r"^[0-9]{9}$"), level)


#: Joins of a round of pointer jumping, all with one table of pointers: after a round a pointer spans STEPS + 1 times what it did.
STEPS = 3


def _ends(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """edges: (code, to), one from each code, stored. (code, to, hops) for the chains that end, by jumping: after k rounds a row spans up to
    (STEPS + 1) ** k edges, so that a chain of any depth takes the logarithm of it in rounds, each written once. As long as chains that end are open, each round
    closes some; when none closes, the open codes lie on cycles or lead to one: once rows span all of them, (code, to) with ``to`` on a cycle."""
    jump, span, last = edges.select("code", "to", F.lit(1).cast("long").alias("hops")), 1, -1
    while True:
        ahead = jump.select(F.col("code").alias("to"), F.col("to").alias("__to"), F.col("hops").alias("__hops"))
        jumped = jump.select("code", "to", "hops")
        for _ in range(STEPS):
            joined = jumped.select("code", "to", "hops").join(ahead, "to", "left")
            jumped = joined.select("code", F.coalesce("__to", "to").alias("to"), (F.col("hops") + F.coalesce("__hops", F.lit(0))).alias("hops"), F.col("__to").isNotNull().alias("open"))
        jump, open_ = cut_and_count(jumped, F.col("open"))
        span *= STEPS + 1
        if not open_:
            return jump.select("code", "to", "hops"), None
        if open_ == last and span > open_:
            return jump.where("not open").select("code", "to", "hops"), jump.where("open").select("code", "to")
        last = open_


def _cycles(edges: DataFrame, left: DataFrame) -> DataFrame:
    """(code, hops): how many edges the codes in or before a cycle follow until one comes again. left: (code, to), ``to`` on a cycle."""
    on = cut(left.select(F.col("to").alias("code")).distinct())
    least = cut(edges.join(on, "code", "left_semi").select("code", "to", F.least("code", "to").alias("name")))
    changed = 1
    while changed:  # once no name falls, each is the least of its whole cycle
        ahead = least.select(F.col("code").alias("to"), F.col("to").alias("__to"), F.col("name").alias("__name"))
        further = least.select("code", "to", "name", F.col("name").alias("was"))
        for _ in range(STEPS):
            further = further.join(ahead, "to").select("code", F.col("__to").alias("to"), F.least("name", "__name").alias("name"), "was")
        least, changed = cut_and_count(further, F.col("name") < F.col("was"))
    size = least.groupBy("name").agg(F.count(F.lit(1)).alias("size"))
    around = cut(least.select("code", "name").join(size, "name").select("code", "size"))
    before = edges.join(left.select("code"), "code", "left_semi").join(on, "code", "left_anti")
    told, _ = _ends(cut(before))
    entered = told.join(around.withColumnRenamed("code", "to"), "to").select("code", (F.col("hops") + F.col("size")).alias("hops"))
    return around.select("code", F.col("size").alias("hops")).unionByName(entered)


def resolve(codes: DataFrame, current: DataFrame, edges: DataFrame, at: str | None = None) -> DataFrame:
    """codes: (code); current: (code); edges: (retired, current[, effective_from]). Gives (code, resolved, hops, status) with status
    ``current``, ``cycle`` or ``unknown``. ``at`` (a date) leaves out later edges. Chains may be of any depth and number;
    of several edges from one code the greatest target counts.
    """
    if at is not None:
        edges = edges.where(F.col("effective_from") <= F.lit(at))
    known = cut(current.select(F.trim("code").alias("code")).distinct())
    edges = edges.groupBy(F.trim("retired").alias("code")).agg(F.max(F.trim("current")).alias("to")).where("to is not null")
    edges = cut(edges.join(known, "code", "left_anti"))
    ends, left = _ends(edges)
    asked = codes.select(F.trim("code").alias("code")).distinct().join(ends, "code", "left")
    asked = asked.select("code", F.coalesce("to", "code").alias("to"), F.coalesce("hops", F.lit(0)).alias("hops"))
    asked = asked.join(known.select(F.col("code").alias("to"), F.lit(True).alias("__known")), "to", "left")
    status = F.when(F.col("__known"), "current").otherwise("unknown")
    out = asked.select("code", F.when(F.col("__known"), F.col("to")).alias("resolved"), F.col("hops").cast("int").alias("hops"), status.alias("status"))
    if left is None:
        return out
    around = _cycles(edges, left).select("code", F.col("hops").cast("int").alias("__hops"))
    out = out.join(around, "code", "left")
    cycle = F.col("__hops").isNotNull()
    return out.select("code", F.when(~cycle, F.col("resolved")).alias("resolved"), F.coalesce("__hops", "hops").alias("hops"), F.when(cycle, "cycle").otherwise(F.col("status")).alias("status"))


def _pieces(edges: DataFrame) -> DataFrame:
    """(code, since, until, to): of each code that has edges, over all dates, where it leads: to the greatest target of the edges that are in force by
    then, or nowhere (null). edges: (code, to, since); a null ``since`` is always in force."""
    first, last = F.lit("0000-00-00"), F.lit("9999-99-99")
    step = edges.groupBy("code", F.coalesce("since", first).alias("since")).agg(F.max("to").alias("to"))
    own = W.partitionBy("code").orderBy("since")
    reach = step.select("code", "since", F.coalesce(F.lead("since").over(own), last).alias("until"), F.max("to").over(own).alias("to"))
    before = step.groupBy("code").agg(F.min("since").alias("until")).where(F.col("until") > first).select("code", first.alias("since"), "until", F.lit(None).cast("string").alias("to"))
    return reach.unionByName(before)


def resolve_each(rows: DataFrame, current: DataFrame, edges: DataFrame) -> DataFrame:
    """rows: (code, at): each is resolved as of its own date (text, as effective_from), following only edges in force by then. Gives (code, at,
    resolved, hops, status), one for each distinct pair; hops is null on a cycle. Where an edge leads depends on the date, so pointers are doubled over pieces
    of time: a piece and the pieces of its target that meet it make the pieces of twice the span. A null date follows every edge."""
    known = cut(current.select(F.trim("code").alias("code")).distinct())
    named = edges.select(F.trim("retired").alias("code"), F.trim("current").alias("to"), F.col("effective_from").alias("since")).where("to is not null")
    piece = cut(_pieces(named.join(known, "code", "left_anti")).select("*", F.col("to").isNotNull().cast("long").alias("hops"), F.col("to").isNotNull().alias("open")))
    codes = piece.select("code").distinct().count()
    open_, span = codes, 1
    while open_ and span <= 2 * codes:
        ahead = piece.select(F.col("code").alias("to"), F.col("since").alias("__since"), F.col("until").alias("__until"), F.col("to").alias("__to"), F.col("hops").alias("__hops"), F.col("open").alias("__open"))
        going, ended = piece.where("open"), piece.where("not open")
        meet = (F.col("since") < F.col("__until")) & (F.col("__since") < F.col("until"))
        both = going.join(ahead.where("__to is not null"), "to").where(meet)
        further = both.select("code", F.greatest("since", "__since").alias("since"), F.least("until", "__until").alias("until"), F.col("__to").alias("to"), (F.col("hops") + F.col("__hops")).alias("hops"), F.col("__open").alias("open"))
        nowhere = going.join(ahead.where("__to is null"), "to").where(meet).select("code", F.greatest("since", "__since").alias("since"), F.least("until", "__until").alias("until"), "to", "hops", F.lit(False).alias("open"))
        at_end = going.join(ahead.select("to").distinct(), "to", "left_anti").select("code", "since", "until", "to", "hops", F.lit(False).alias("open"))
        piece, open_ = cut_and_count(ended.unionByName(further).unionByName(nowhere).unionByName(at_end), F.col("open"))
        span *= 2
    asked = rows.select(F.trim("code").alias("code"), F.col("at").alias("at")).distinct()
    day = F.coalesce("at", F.lit("9999-99-98"))
    met = asked.join(piece.withColumnRenamed("code", "__code"), (F.col("code") == F.col("__code")) & (F.col("since") <= day) & (day < F.col("until")), "left")
    end = F.coalesce("to", "code")
    told = met.select("code", "at", end.alias("to"), F.coalesce("hops", F.lit(0)).cast("int").alias("hops"), F.coalesce("open", F.lit(False)).alias("cycle"))
    told = told.join(known.select(F.col("code").alias("to"), F.lit(True).alias("__known")), "to", "left")
    good = F.coalesce("__known", F.lit(False)) & ~F.col("cycle")
    status = F.when(F.col("cycle"), "cycle").when(good, "current").otherwise("unknown")
    return told.select("code", "at", F.when(good, F.col("to")).alias("resolved"), F.when(~F.col("cycle"), F.col("hops")).alias("hops"), status.alias("status"))


def resolvable(current: DataFrame, edges: DataFrame, at: str | None = None) -> DataFrame:
    """(code): the current codes and all retired ones whose chain ends in one."""
    asked = current.select("code").union(edges.select(F.col("retired").alias("code")))
    return resolve(asked, current, edges, at).where("status = 'current'").select("code")


def require_resolved(resolved: DataFrame) -> DataFrame:
    """As given, or an error that names a code that is in a cycle or unknown."""
    bad = resolved.where("status <> 'current'").orderBy("code").limit(5).collect()
    if bad:
        raise LookupError("; ".join(f"{r.code}: {r.status}" for r in bad))
    return resolved


def migration_coverage(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count(F.lit(1)).alias("migrations")).withColumn("complete", F.lit(False))
