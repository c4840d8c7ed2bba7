import datetime as dt
import hashlib
import math
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from attesta.llm import overwrite as O

EPOCH, US = dt.datetime(1970, 1, 1), dt.timedelta(microseconds=1)
CUT = dt.datetime(2024, 3, 1)


def us(t):
    return None if t is None else (t - EPOCH) // US


def day(t):
    return -1 if t is None else us(t) // O.DAY


def brute(rows):
    """rows: (sale_id, total, sold_at, arrived_at). As the query returns them, without paths."""
    every = 1 + len(rows) // 900
    new = list(rows)
    for i, total, sold, arrived in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 3 == 0 and day(sold) % 10 == 0:
            later = lambda t, n: t and t + dt.timedelta(days=n)
            new.append((i, None if total is None else total + 1, later(sold, h % 2), later(arrived, 1 + h % 97)))

    def kept(rs):
        out = {}
        order = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in (us(r[3]), us(r[2]), r[1]))
        for r in rs:
            if r[0] not in out or order(r) > order(out[r[0]]):
                out[r[0]] = r
        return out

    early = lambda r: r[3] is not None and r[3] < CUT
    start, last = kept([r for r in new if early(r)]), kept(new)
    late = [r for r in last.values() if not early(r)]
    touched = {day(r[2]) for r in late} | {day(start[r[0]][2]) for r in late if r[0] in start}
    days = {}
    for r in last.values():
        days.setdefault(day(r[2]), []).append(r)
    text = lambda x: "" if x is None else str(x)
    out = []
    for d, own in days.items():
        own.sort(key=lambda r: ((r[2] is not None, us(r[2]) or 0), (r[0] is not None, r[0] or 0)))
        for k in range(0, len(own), every):
            f = own[k : k + every]
            cents = sum(math.floor(100 * r[1] + 0.5) for r in f if r[1] is not None)
            crc = sum(zlib.crc32(f"{text(r[0])}:{text(us(r[2]))}:{text(us(r[3]))}".encode()) for r in f)
            out.append((d, k // every, len(f), cents, crc, hashlib.sha256(",".join(text(r[0]) for r in f).encode()).hexdigest(), d in touched))
    return sorted(out)


@pytest.fixture(scope="module")
def sales():
    rng = np.random.default_rng(1)
    base, out = dt.datetime(2024, 1, 1), []
    for i in range(2600):
        hot = rng.random() < 0.3
        sold = base + dt.timedelta(days=20) if hot else base + dt.timedelta(seconds=int(rng.integers(0, 110 * 86400)))
        arrived = sold + dt.timedelta(seconds=int(rng.integers(0, 90_000)))
        out.append((i, float(rng.integers(0, 9999)) / 100, sold, arrived))
    out += [(3, 1.0, base, base + dt.timedelta(days=100)), (4, 2.0, base, out[4][3]), out[5], out[6], (9000, None, base, base), (9001, 3.0, None, base), (9002, 4.0, None, CUT), (9003, 5.0, base, None)]
    out += [(None, 6.0, base, base), (None, 7.0, CUT, CUT), (9004, 5.0, dt.datetime(1969, 12, 31, 5), base), (-8, 5.0, dt.datetime(1969, 12, 31, 5), base), (9005, 5.0, dt.datetime(1960, 1, 1), CUT)]
    # two sales whose only early row stands alone on a day that it leaves
    out += [(9100, 1.0, dt.datetime(2023, 5, 5), base), (9100, 1.0, CUT, CUT)]
    return out


def stored(tmp_path, rows):
    at = pa.timestamp("us")
    cols = {"sale_id": pa.int64(), "client_id": pa.int64(), "status": pa.string(), "total": pa.float64(), "sold_at": at, "arrived_at": at, "priority": pa.int32(), "day": pa.string()}
    values = {"sale_id": [r[0] for r in rows], "total": [r[1] for r in rows], "sold_at": [r[2] for r in rows], "arrived_at": [r[3] for r in rows]}
    pq.write_table(pa.table({c: pa.array(values.get(c, [None] * len(rows)), t) for c, t in cols.items()}), tmp_path / "sales.parquet")
    return str(tmp_path)


def test_as_brute_force(spark, tmp_path, sales):
    got = O.op13_overwrite(spark, stored(tmp_path, sales)).collect()
    assert sorted((r.day, r.file_no, r.n_rows, r.cents, r.rows_crc, r.ids_sha256, r.rewritten) for r in got) == brute(sales)
    paths = {r.path.removeprefix("file:").replace("//", "/") for r in got}
    folder = os.path.dirname(os.path.dirname(next(iter(paths))))
    there = {f"{d}/{f}" for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}
    assert there == paths
    assert all(pq.ParquetFile(p).schema_arrow.names == r.columns.split(",") for r in got[:5] for p in [r.path.removeprefix("file:")])
    order = [p for _, _, p in sorted((r.day, r.file_no, r.path) for r in got if r.day == 19743)]
    assert order == sorted(order)  # names follow the order


def test_untouched_files_stay(spark, tmp_path, sales):
    sf, marks = stored(tmp_path, sales), {}
    write = O.Layout.write

    def noted(self, rows):
        out = write(self, rows)
        if not marks:
            marks.update({f"{d}/{f}": hashlib.sha256(open(f"{d}/{f}", "rb").read()).hexdigest() for d, _, names in os.walk(self.folder.removeprefix("file:")) for f in names if f.endswith(".parquet")})
        return out

    O.Layout.write = noted
    try:
        got = O.op13_overwrite(spark, sf).collect()
    finally:
        O.Layout.write = write
    kept = [r.path.removeprefix("file:").replace("//", "/") for r in got if not r.rewritten]
    assert kept
    assert all(marks[p] == hashlib.sha256(open(p, "rb").read()).hexdigest() for p in kept)
    assert not [r for r in got if r.rewritten and r.path.removeprefix("file:").replace("//", "/") in marks]


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_splitters_are_order_statistics(spark, bins):
    rng = np.random.default_rng(3)
    keys = sorted({(int(a), int(b)) for a, b in zip(rng.choice([5, 6, 700, O.DAY - 1, O.DAY + 1, O.DAY + 90], 400), rng.integers(-(1 << 63), (1 << 63) - 1, 400, dtype=np.int64), strict=True)})
    got, rounds = O.splitters(spark.createDataFrame(keys, "at long, id long").repartition(3), 13, bins)
    want = {}
    for d in (0, 1):
        own = [k for k in keys if O.day_at(k[0]) == d]
        want |= {(d, i): k for i, k in enumerate(own[::13])}
        want[d, 0] = (d * (O.DAY + 1), O.LEAST)
    assert got == want and rounds >= 2


def test_equal_keys_are_refused(spark):
    with pytest.raises(ValueError, match="one time and id"):
        O.splitters(spark.createDataFrame([(1, 1)] * 9, "at long, id long"), 2)


def test_places_sort_as_days_and_times(spark):
    times = [None, dt.datetime(1969, 12, 31), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), EPOCH, dt.datetime(1900, 3, 1, 1), dt.datetime(2024, 2, 29, 12, 0, 0, 5)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").select("t", O.place(F.col("t")).alias("p"), O.micros(F.col("t")).alias("u"))
    rows = df.collect()
    assert all(r.u == us(r.t) for r in rows) and all(O.day_at(r.p) == day(r.t) for r in rows)
    assert [r.t for r in sorted(rows, key=lambda r: r.p)] == [times[4], None, times[1], times[2], times[3], times[5]]


def test_no_rows(spark, tmp_path):
    assert O.op13_overwrite(spark, stored(tmp_path, [])).collect() == []


def test_workers_import_what_they_compute_with():
    assert O.pc.__name__ == "pyarrow.compute"
