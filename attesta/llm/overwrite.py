"""Late-arrival partition overwrite: days of sorted files of exact sizes, of which only those that late rows touch are written again.

A layout holds the latest-arrived row of each id. Each day, sorted by (time, id), is cut into Parquet files of ``rows_per_file`` rows,
the last perhaps of fewer. Which row starts a file is an order statistic of the day: every K-th one. All of them are found at
once, exactly, in rounds of histograms: the interval around each open rank is cut into BINS, rows are counted by bin where they lie,
and the bins that hold an open rank are the intervals of the next round, by time first and, where all rows of an interval have one
time, by id. A round brings one row for each open rank to the driver, never the rows or the histogram. Rows are then routed by
binary search over the splitters, so that a day is dealt over as many tasks as it has files, sorted where they arrive and written
as they stream: one task writes whole files, in order, and Spark's bound on records of a file cuts exactly between them.

An overwrite replaces the folders of touched days by Spark's dynamic partition overwrite, which commits a day by renaming it; days that
lose all rows are deleted. Both can be repeated after a failure.

Nulls: a null time belongs to day -1 and sorts first; a null id is one id like any other, sorted first; a null arrival is the earliest of
its id, and late. Of rows of an id that arrived together the greatest by time and then the other columns stays; repeated rows are one.
An empty table has no files. Other columns are carried along, whatever their names, in their order; they have to be of types that
Spark can order. The number of files is bounded by rows / rows_per_file + days; their splitters are held in memory.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import releasing, scratch, shared_dir, small_batches, stored, table

DAY = 86_400_000_000
#: Bins of each interval of a round.
BINS = 4096
#: A task writes so many rows and files at most, or one file.
ROWS_PER_TASK, FILES_PER_TASK = 50_000, 8
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def named(name: str) -> Column:
    return F.col(f"`{name}`")


def free_name(taken: list[str], name: str) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def days_of(time: Column) -> Column:
    """Whole days since 1970, whatever the session's time zone if ``time`` has none."""
    return F.unix_date(time.cast("date")).cast("long")


def micros(time: Column, zoned: bool = False) -> Column:
    """Microseconds since 1970 of a timestamp without a zone, by its own clock."""
    if zoned:
        return F.unix_micros(time)
    clock = F.hour(time).cast("long") * 3_600_000_000 + F.minute(time).cast("long") * 60_000_000
    return days_of(time) * DAY + clock + (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("long")


def place(time: Column, zoned: bool = False) -> Column:
    """A long that sorts as (day, time) does, null times first within day -1."""
    at = micros(time, zoned)
    day = F.floor((at - F.pmod(at, F.lit(DAY))) / F.lit(DAY))
    return F.coalesce(day * (DAY + 1) + 1 + F.pmod(at, F.lit(DAY)), F.lit(-(DAY + 1)))


def day_at(at: int) -> int:
    return at // (DAY + 1)


def _before(at: np.ndarray, key: np.ndarray, ats: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How many of the sorted pairs (ats, keys) are not greater than each (at, key): binary search."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(ats), np.int64)
    for _ in range(len(ats).bit_length()):
        mid = (low + high) >> 1
        inside = low < high
        m = np.minimum(mid, len(ats) - 1)
        up = inside & ((ats[m] < at) | ((ats[m] == at) & (keys[m] <= key)))
        low, high = np.where(up, mid + 1, low), np.where(inside & ~up, mid, high)
    return low


@dataclass(frozen=True)
class Interval:
    """Rows whose place and id lie between these, the ``base``-th of their day and following; ``n`` of them."""

    base: int
    n: int
    low_at: int
    high_at: int
    low_id: int
    high_id: int

    @property
    def by_id(self) -> bool:
        return self.low_at == self.high_at

    def open_ranks(self, every: int) -> range:
        first = max(-(-self.base // every) * every, every)
        return range(first, self.base + self.n, every)


def _settled(x: Interval, every: int, found: dict[tuple[int, int], tuple[int, int]]) -> bool:
    """Notes the ranks that are certain; whether others are open."""
    ranks, day = x.open_ranks(every), day_at(x.low_at)
    if not x.by_id:
        return bool(ranks)
    if x.n > 1 and x.low_id == x.high_id:
        raise ValueError(f"several rows of day {day} have one time and id")
    known = {x.base: x.low_id, x.base + x.n - 1: x.high_id}
    found.update({(day, r): (x.low_at, known[r]) for r in ranks if r in known})
    return any(r not in known for r in ranks)


def splitters(keys: DataFrame, every: int, bins: int = BINS) -> tuple[dict[tuple[int, int], tuple[int, int]], int]:
    """keys: (at, id), ``at`` as place() gives it. The first (at, id) of each file by (day, file), and how many rounds it took."""
    stats = [F.count(F.lit(1)).alias("n"), F.min("at").alias("low_at"), F.max("at").alias("high_at"), F.min("id").alias("low_id"), F.max("id").alias("high_id")]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    open_, rounds = [], 0
    for r in keys.groupBy(F.floor(F.col("at") / (DAY + 1)).alias("day")).agg(*stats).collect():
        found[r.day, 0] = (r.day * (DAY + 1), LEAST)
        x = Interval(0, r.n, r.low_at, r.high_at, r.low_id, r.high_id)
        open_ += [x] * _settled(x, every, found)
    while open_:
        rounds += 1
        open_.sort(key=lambda x: (x.low_at, x.low_id if x.by_id else LEAST))
        counted = keys.select("at", "id", _binned(open_, bins)("at", "id").alias("p")).where("p.i is not null")
        counted = counted.groupBy("p.i", "p.b").agg(*stats)
        base = F.broadcast(keys.sparkSession.createDataFrame([(i, x.base) for i, x in enumerate(open_)], "i int, base long"))
        rank = F.col("base") + F.sum("n").over(W.partitionBy("i").orderBy("b")) - F.col("n")
        told = counted.join(base, "i").withColumn("rank", rank)
        first = F.greatest(F.ceil(F.col("rank") / every) * every, F.lit(every))
        held = [Interval(r["rank"], r.n, r.low_at, r.high_at, r.low_id, r.high_id) for r in told.where(first < F.col("rank") + F.col("n")).collect()]
        open_ = [x for x in held if _settled(x, every, found)]
    return {(day, rank // every): key for (day, rank), key in found.items()}, rounds


def _binned(open_: list[Interval], bins: int):
    """A UDF: (at, id) -> the interval that holds it and its bin there, or null."""
    by_id = np.array([x.by_id for x in open_])
    low_at, high_at = (np.array([getattr(x, c) for x in open_], np.int64) for c in ("low_at", "high_at"))
    low_id = np.array([x.low_id if x.by_id else LEAST for x in open_], np.int64)
    high_id = np.array([x.high_id if x.by_id else MOST for x in open_], np.int64)
    origin = np.where(by_id, low_id, low_at)
    width = np.array([-(-((x.high_id - x.low_id if x.by_id else x.high_at - x.low_at) + 1) // bins) for x in open_], np.uint64)

    @F.arrow_udf("struct<i:int,b:int>")
    def run(at: pa.Array, key: pa.Array) -> pa.Array:
        a, k = at.to_numpy(zero_copy_only=False), key.to_numpy(zero_copy_only=False)
        i = _before(a, k, low_at, low_id) - 1
        at_i = np.maximum(i, 0)
        inside = (i >= 0) & ((a < high_at[at_i]) | ((a == high_at[at_i]) & (k <= high_id[at_i])))
        x = np.where(by_id[at_i], k, a)
        b = (x.astype(np.uint64) - origin[at_i].astype(np.uint64)) // width[at_i]
        parts = [pa.array(i.astype(np.int32)), pa.array(np.where(inside, b, 0).astype(np.int32))]
        return pa.StructArray.from_arrays(parts, ["i", "b"], mask=pa.array(~inside))

    return run


def _routed(starts: list[tuple[int, int]]):
    """A UDF: (at, id) -> the file it belongs to."""
    ats, ids = np.array([s[0] for s in starts], np.int64), np.array([s[1] for s in starts], np.int64)

    @F.arrow_udf("int")
    def run(at: pa.Array, key: pa.Array) -> pa.Array:
        return pa.array((_before(at.to_numpy(zero_copy_only=False), key.to_numpy(zero_copy_only=False), ats, ids) - 1).astype(np.int32))

    return run


@dataclass(frozen=True)
class Layout:
    """Where and how: columns of the id, the time whose days are the partitions, and the arrival; the folder's partition is ``day``."""

    folder: str
    columns: tuple[str, ...]
    zoned: bool
    rows_per_file: int
    id: str = "sale_id"
    time: str = "sold_at"
    arrival: str = "arrived_at"

    @property
    def day(self) -> str:
        return free_name(list(self.columns), "day")

    def keys(self, rows: DataFrame) -> DataFrame:
        return rows.select(place(named(self.time), self.zoned).alias("at"), F.coalesce(named(self.id).cast("long"), F.lit(LEAST)).alias("id"))

    def write(self, rows: DataFrame) -> set[int]:
        """Each day of ``rows`` (one for each id) takes the place of what its folder holds; other days stay. Returns the days."""
        starts, _ = splitters(self.keys(rows), self.rows_per_file)
        if not starts:
            return set()
        small_batches(rows.sparkSession, 1 << 16)
        day, file = self.day, free_name([*self.columns, self.day], "file")
        each = max(1, min(FILES_PER_TASK, ROWS_PER_TASK // self.rows_per_file))
        at, key = place(named(self.time), self.zoned), F.coalesce(named(self.id).cast("long"), F.lit(LEAST))
        routed = rows.select(*map(named, self.columns), F.floor(at / (DAY + 1)).alias(day), F.floor(_routed(sorted(starts.values()))(at, key) / each).cast("int").alias(file))
        dealt = routed.repartitionById(-(-len(starts) // each), named(file)).sortWithinPartitions(named(day), named(self.time), named(self.id))
        out = dealt.select(*map(named, self.columns), named(day)).write.mode("overwrite").partitionBy(day)
        out.option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", self.rows_per_file).parquet(self.folder)
        return {d for d, _ in starts}

    def drop(self, spark: SparkSession, days: set[int]) -> None:
        """Days that have lost all rows."""
        for d in sorted(days):
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{self.day}={d}")
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def newest(df: DataFrame, id: str, arrival: str, start: Column) -> DataFrame:
    """(id, last, first): by id the latest-arrived row of all, and of those that ``start`` holds for, or null."""
    row = F.struct(named(arrival), *[named(c) for c in df.columns if c != arrival])
    return df.groupBy(named(id).alias("id")).agg(F.max(row).alias("last"), F.max(F.when(start, row)).alias("first"))


def overwrite(df: DataFrame, layout: Layout, start: Column, named_start: str) -> set[int]:
    """Write the layout of the rows that ``start`` holds for, then make it the layout of all rows. Returns the days that the second step
    wrote again or deleted: those where a kept late row stands, or stood what it replaces."""
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(layout.folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    kept = stored(newest(df, layout.id, layout.arrival, start), "kept")
    rows = lambda side: kept.where(F.col(side).isNotNull()).select(*[F.col(side)[c].alias(c) for c in layout.columns])
    day = lambda side: F.when(F.col(side).isNotNull(), F.coalesce(days_of(F.col(side)[layout.time]), F.lit(-1)))
    before = layout.write(rows("first"))
    late = kept.where(~F.coalesce(F.expr(named_start.format("last")), F.lit(False)))
    touched = {r[0] for r in late.select(F.explode(F.array(day("last"), day("first"))).alias("day")).where("day is not null").distinct().collect()}
    if touched:
        again = rows("last").where(F.coalesce(days_of(named(layout.time)), F.lit(-1)).isin(sorted(touched)))
        after = layout.write(again)
        layout.drop(spark, (before & touched) - after)
    return touched


FILE = "path string, n_rows long, rows_crc long, cents long, at long, id long, ids_sha256 string"


def _read_back(batches):
    """Rows sorted by (path, place in the file) -> one row for each file, in constant memory."""
    now, n, crc, cents, first, digest = None, 0, 0, 0, (0, 0), None
    done = lambda: pa.record_batch([[now], [n], [crc], [cents], [first[0]], [first[1]], [digest.hexdigest()]], pa.schema([("path", pa.string()), ("n_rows", pa.int64()), ("rows_crc", pa.int64()), ("cents", pa.int64()), ("at", pa.int64()), ("id", pa.int64()), ("ids_sha256", pa.string())]))
    for batch in batches:
        path, crcs, sums, at, ids = (batch.column(i) for i in (0, 1, 2, 3, 4))
        ends = np.flatnonzero(np.diff(pc.dictionary_encode(path).indices.to_numpy(zero_copy_only=False))) + 1
        for a, b in zip([0, *ends], [*ends, len(path)], strict=True):
            if a == b:
                continue
            name = path[int(a)].as_py()
            if name != now:
                if digest:
                    yield done()
                now, n, crc, cents, digest = name, 0, 0, 0, hashlib.sha256()
                first = (at[int(a)].as_py(), LEAST if ids[int(a)].as_py() is None else ids[int(a)].as_py())
            text = ",".join("" if x is None else str(x) for x in ids.slice(a, b - a).to_pylist())
            digest.update(("," * bool(n) + text).encode())
            n, crc, cents = n + int(b - a), crc + pc.sum(crcs.slice(a, b - a)).as_py(), cents + pc.sum(sums.slice(a, b - a)).as_py()
    if digest:
        yield done()


def files_of(spark: SparkSession, layout: Layout, schema: T.StructType, total: str = "total") -> DataFrame:
    """(day, file_no, n_rows, cents, rows_crc, path, columns, ids_sha256), read back from the files; each file's rows are streamed in order."""
    small_batches(spark, 1 << 14)
    whole = T.StructType([*schema.fields, T.StructField(layout.day, T.LongType())])
    rows = spark.read.schema(whole).parquet(layout.folder)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    line = F.concat_ws(":", text(named(layout.id)), text(micros(named(layout.time), layout.zoned)), text(micros(named(layout.arrival), layout.zoned)))
    cents = F.coalesce(F.floor(100 * named(total) + 0.5), F.lit(0)).cast("long")
    told = rows.select(F.col("_metadata.file_path").alias("path"), F.crc32(line).alias("crc"), cents.alias("cents"), place(named(layout.time), layout.zoned).alias("at"), named(layout.id).cast("long").alias("id"), F.col("_metadata.row_index").alias("nth"))
    each = told.repartition("path").sortWithinPartitions("path", "nth").drop("nth").mapInArrow(releasing(_read_back), FILE)
    day = F.floor(F.col("at") / (DAY + 1)).alias("day")
    file_no = (F.row_number().over(W.partitionBy(F.floor(F.col("at") / (DAY + 1))).orderBy("at", "id")) - 1).cast("long")
    return each.select(day, file_no.alias("file_no"), "n_rows", "cents", "rows_crc", "path", F.lit(",".join(layout.columns)).alias("columns"), "ids_sha256")


def op13_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "sales")
    zoned = isinstance(sales.schema["sold_at"].dataType, T.TimestampType)
    h, day = F.crc32(F.col("sale_id").cast("string").cast("binary")), F.coalesce(days_of(F.col("sold_at")), F.lit(-1))
    later = lambda c, days: F.col(c) + F.make_dt_interval(days.cast("int"))
    new = {"total": F.col("total") + 1, "sold_at": later("sold_at", h % 2), "arrived_at": later("arrived_at", 1 + h % 97)}
    copies = sales.where((h % 3 == 0) & (day % 10 == 0)).select(*[new.get(c, named(c)).cast(sales.schema[c].dataType).alias(c) for c in sales.columns])
    folder = f"{shared_dir(spark).rstrip('/')}/sales-{uuid.uuid4().hex}"
    layout = Layout(folder, tuple(sales.columns), zoned, 1 + sales.count() // 900)
    early = "{}arrived_at < timestamp_ntz'2024-03-01 00:00:00'"
    with scratch(spark):
        rows = sales.unionByName(copies)
        touched = overwrite(rows, layout, F.expr(early.format("")), early.format("{}."))
    return files_of(spark, layout, sales.schema).withColumn("rewritten", F.col("day").isin(sorted(touched)) if touched else F.lit(False))
