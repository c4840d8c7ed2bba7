import os
import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import constraints, gate
from attesta.operators.constraints import ConstraintError
from attesta.sources import publish, tables

ROWS = "document_id string, outcome string"


def test_all_tables_or_none(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/p"
    a = spark.createDataFrame([("1", "confirmed"), ("2", "conflict"), ("3", None)], ROWS)
    assert publish.publish_split(a, root) == {"confirmed": 1, "conflict": 1, None: 1}
    p = publish.Publication(spark, root)
    assert (p.read("confirmed").count(), p.read("queue").count(), p.versions()) == (1, 2, [1])
    b = spark.createDataFrame([("1", "confirmed"), ("2", "confirmed")], ROWS)
    for name in ("_commit",):  # a failure after all tables are written, before the commit
        with monkeypatch.context() as m:
            m.setattr(publish.Publication, name, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                publish.publish_split(b, root)
    assert (p.read("confirmed").count(), p.read("queue").count(), p.versions()) == (1, 2, [1])
    publish.publish_split(b, root)
    assert (p.read("confirmed").count(), p.read("queue").count()) == (2, 0)
    assert (p.read("confirmed", 1).count(), p.read("queue", 1).count()) == (1, 2)
    with pytest.raises(ConstraintError, match="shrink"):
        publish.publish_split(a, root)
    assert p.versions() == [1, 2]
    publish.publish_split(a, root, allow_shrink=True)
    assert p.vacuum(keep=1) == [1, 2] and p.read("queue").count() == 2
    assert len(os.listdir(f"{root}/data")) == 1
    for bad in (lambda: p.read("nothing"), lambda: p.read("queue", 1)):
        with pytest.raises(ConstraintError):
            bad()


def test_of_two_at_a_time_one_fails(spark, tmp_path):
    p = publish.Publication(spark, f"{tmp_path}/p")
    held = p.versions()
    p.write({"t": spark.range(3)})
    with pytest.raises(ConstraintError, match="meanwhile"):
        p._commit(held, {"tables": {}})
    assert p.read("t").count() == 3


def test_gate_results(spark, tmp_path):
    parsed = spark.createDataFrame([("1", 0.04)], "document_id string, rate double")
    publish.publish_results(spark.createDataFrame([("1", "agree")], ROWS), parsed, f"{tmp_path}/g")
    with pytest.raises(ConstraintError, match="cannot verify"):
        publish.publish_results(spark.createDataFrame([("1", "cannot_verify")], ROWS), parsed, f"{tmp_path}/g")
    p = publish.Publication(spark, f"{tmp_path}/g")
    assert p.read("fingerprint").first()[0] == gate.fingerprint(parsed, "document_id", "rate").first()[0]


def test_a_blob_is_fetched_once(spark, tmp_path):
    log = f"{tmp_path}/log"
    os.mkdir(log)

    def fetch(names):
        def get(batches):
            for df in batches:
                for n in df["name"]:
                    with open(f"{log}/{n}", "a") as f:
                        f.write("x")
                yield df.assign(content=[None if n == "missing" else f"new {n}".encode() for n in df["name"]])

        return names.mapInPandas(get, "name string, content binary")

    times = lambda: {n: os.path.getsize(f"{log}/{n}") for n in os.listdir(log)}
    files = spark.createDataFrame([("good", bytearray(b"1")), ("bad", bytearray(b"2"))], "name string, content binary").withColumn("sha256", F.sha2("content", 256))
    cars = files.select("name", F.when(F.col("name") == "good", F.col("sha256")).otherwise("0" * 64).alias("sha256")).union(spark.createDataFrame([("lost", "1" * 64), ("missing", "2" * 64)], "name string, sha256 string"))
    ledger = publish.Ledger(spark, f"{tmp_path}/ledger")
    blobs, new = publish.read_through(files, cars, fetch, ledger)
    for _ in range(2):
        assert {(r.name, bytes(r.content)) for r in blobs.collect()} == {("good", b"1"), ("bad", b"new bad"), ("lost", b"new lost")}
        assert {r.name for r in new.collect()} == {"bad", "lost"}
    assert times() == {"bad": 1, "lost": 1, "missing": 1}
    good = cars.join(new.withColumnRenamed("sha256", "n"), "name", "left").select("name", F.coalesce("n", "sha256").alias("sha256"))
    publish.read_through(files, good, fetch, ledger)[0].count()
    assert times() == {"bad": 1, "lost": 1, "missing": 2}  # one that failed is tried by the next call
    publish.read_through(files, cars, fetch, ledger)[0].count()
    assert times()["bad"] == 2 and times()["lost"] == 2  # the sidecar asks for other bytes than the ledger's


def test_fingerprint_of_any_size(spark):
    rng = random.Random(1)
    rows = [(f"k{rng.randint(0, 300)}", rng.choice([None, "v", "w"])) for _ in range(500)] + [("same", "row")] * 300
    df = spark.createDataFrame(rows, "k string, v string")
    small = gate.fingerprint(df, "k", "v").first()[0]
    assert gate.fingerprint_chunked(df, "k", "v").first()[0] == small
    marks = {gate.fingerprint_chunked(d, "k", "v", 7).first()[0] for d in (df, df.repartition(5), df.orderBy(F.desc("v")).coalesce(1))}
    assert len(marks) == 1 and small not in marks
    assert gate.fingerprint_chunked(df.limit(799), "k", "v", 7).first()[0] not in marks
    assert gate.fingerprint_chunked(df.limit(0), "k", "v").first()[0] == gate.fingerprint(df.limit(0), "k", "v").first()[0]


def test_lines_of_files_that_are_split(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    for name, n in (("a", 3000), ("b", 1), ("c", 900)):
        (folder / f"{name}.csv").write_text("x,y\n" + "".join(f'"{name}, {i}",{i}\n' + ("\n" if i % 7 == 0 else "") for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    schema = tables.T.StructType([tables.T.StructField(c, tables.T.StringType()) for c in "xy"])
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        got = tables.read_csv_lines(spark, str(folder), schema)
        assert got.rdd.getNumPartitions() > 1
        rows = {(r.x, r.line) for r in got.collect()}
        splits = tables.text_lines(spark, str(folder)).select("path").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    want = {(r.split('"')[1], i) for f in folder.iterdir() for i, r in enumerate(f.read_text().split("\n"), 1) if r.startswith('"')}
    assert rows == want and splits == sum(len(f.read_text().split("\n")) - 1 for f in folder.iterdir())
    (folder / "d.csv").write_text("y,x\n1,2\n")
    with pytest.raises(ConstraintError, match="header"):
        tables.read_csv_lines(spark, str(folder), schema)


def test_overlapping_pairs(spark):
    rng = random.Random(2)
    day = lambda n: f"2020-{1 + n // 28 % 12:02}-{1 + n % 28:02}"
    rows = [(i, rng.choice(["hot"] * 6 + ["a", " b", "b ", None]), s, min(335, s + rng.choice([0, 1, 2, 5, 9, 300, -3]))) for i in range(160) for s in [rng.randint(3, 330)]]
    df = spark.createDataFrame([(i, k, day(a), day(b)) for i, k, a, b in rows], "line long, k string, valid_from string, valid_to string")
    pairs = constraints.overlapping_pairs(df, ["k"])
    got = [tuple(r) for r in pairs.collect()]
    ok = [(i, k and k.strip(), day(a), day(b)) for i, k, a, b in rows if k and a <= b]
    want = {(p[0], q[0]) for p in ok for q in ok if p[0] < q[0] and p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3]}
    assert len(got) == len(set(got)) and set(got) == want
    assert "Window" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert constraints.overlapping_pairs(df.limit(0), ["k"]).count() == 0
