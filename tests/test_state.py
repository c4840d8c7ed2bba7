import json
import os

import pytest
from pyspark.sql import functions as F

from attesta.streaming import state

LISTING = "body string, document_id string, title string, fetched_at timestamp"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def drop(folder, name, rows):
    at = folder / "in" / f"{name}.json"
    at.write_text("\n".join(json.dumps({"body": b, "document_id": d, "title": t, "fetched_at": f"2024-{a}T00:00:00Z"}) for b, d, t, a in rows))
    os.utime(at, (n := 1e9 + len(os.listdir(folder / "in")), n))  # files are taken in this order


def run(spark, folder, **options):
    stream = spark.readStream.schema(LISTING).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    state.run_to_files(state.changes(stream, **options), f"{folder}/out", f"{folder}/check")
    return sorted((r.document_id, str(r["at"])[5:10], r.change) for r in spark.read.schema(state.CHANGES).parquet(f"{folder}/out").collect())


def test_restarts_and_late_files(spark, folder):
    drop(folder, "1", [("b", "x", "one", "01-01"), ("b", "y", "why", "01-01"), (None, "z", None, "01-01")])
    assert run(spark, folder) == [("x", "01-01", "new"), ("y", "01-01", "new"), ("z", "01-01", "new")]
    drop(folder, "2", [("b", "x", "two", "01-08"), ("b", "x", "two", "01-08")])
    run(spark, folder)
    drop(folder, "3", [("b", "x", "old", "01-04"), ("b", "y", "why", "01-07")])  # late, within the lateness: y was still there
    assert run(spark, folder) == [("x", "01-01", "new"), ("x", "01-08", "changed"), ("y", "01-01", "new"), ("z", "01-01", "new")]
    drop(folder, "4", [("b", "x", "two", "01-15"), ("b", "x", "two", "01-22"), ("b", "w", "w", "01-22")])
    drop(folder, "5", [("b", "x", "two", "01-29"), ("b", "w", "w", "01-29"), ("b", "y", "back", "01-29")])
    got = run(spark, folder)
    assert got == [("w", "01-22", "new"), ("x", "01-01", "new"), ("x", "01-08", "changed"), ("y", "01-01", "new"), ("y", "01-14", "gone"), ("y", "01-29", "new"), ("z", "01-01", "new"), ("z", "01-08", "gone")]
    assert run(spark, folder) == got  # nothing new


def test_alarms(spark, folder):
    listed, told = folder / "listed", folder / "told"
    listed.mkdir()
    told.mkdir()

    def more(at, name, rows, extra=None):
        (at / f"{name}.json").write_text("\n".join(json.dumps({"body": b, "at": f"2024-{t}T00:00:00Z", "fetched_at": f"2024-{t}T00:00:00Z"} | (extra or {})) for b, t in rows))

    def go():
        a = spark.readStream.schema("body string, fetched_at timestamp").json(str(listed))
        b = spark.readStream.schema(state.CHANGES).json(str(told))
        state.run_to_files(state.alarms(a, b, quiet="28 days"), f"{folder}/out", f"{folder}/check")
        return sorted((r.body, r.alarm, str(r["at"])[5:10]) for r in spark.read.schema(state.ALARMS).parquet(f"{folder}/out").collect())

    more(told, "1", [("a", "01-01"), ("b", "01-01"), ("c", "01-20")], {"document_id": "d", "change": "new"})
    more(listed, "1", [(x, t) for x in "abc" for t in ("01-01", "01-08")])
    assert go() == []
    more(listed, "2", [(x, t) for x in "ac" for t in ("01-15", "01-22", "01-29", "02-05")])
    go()
    more(told, "2", [("c", "02-10")], {"document_id": "e", "change": "changed"})
    more(listed, "3", [("c", "02-12"), ("a", "02-12"), ("c", "02-20")])
    assert go() == [("a", "no-change", "01-29"), ("b", "could-not-check", "01-29")]
    more(listed, "4", [("c", "03-20"), ("c", "03-05"), ("a", "03-20")])
    go()
    more(listed, "5", [("a", "03-21")])
    assert go() == [("a", "no-change", "01-29"), ("b", "could-not-check", "01-29"), ("c", "no-change", "03-09")]


def test_a_batch_gives_what_a_stream_gives(spark, folder):
    rows = [("b", f"d{i % 5}", f"t{i // 7 % 3}", f"{1 + i // 28:02}-{1 + i % 28:02}") for i in range(112)]
    drop(folder, "all", rows)
    whole = run(spark, folder)
    other = folder / "parts"
    (other / "in").mkdir(parents=True)
    for k in range(4):
        drop(other, str(k), rows[28 * k : 28 * k + 28])
    assert run(spark, other, lateness="1 day") == whole
    assert spark.read.parquet(f"{other}/out").where(F.col("change") == "new").count() >= 5


def test_documents_share_states(spark, folder):
    """A state for each document took 113 s for 150,000 orders; what is told does not depend on the groups."""
    told = []
    for groups in (1, 1 << 30):
        at = folder / str(groups)
        (at / "in").mkdir(parents=True)
        for k in range(4):
            rows = [(f"b{i % 3}", f"d{i % 8}", (None, "", "one")[i * 7 // 5 % 3], f"{1 + (i * (k + 3) // 20 + 2 * k) % 4:02}-{1 + (i * i + 5 * k) % 28:02}") for i in range(60)]
            drop(at, str(k), rows)
        told.append(run(spark, at, lateness="20 days", groups=groups))
        assert (spark.read.format("statestore").load(f"{at}/check").count() <= 1) == (groups == 1)
    assert told[0] == told[1]
    assert {"new", "changed", "gone"} == {c for *_, c in told[0]}
