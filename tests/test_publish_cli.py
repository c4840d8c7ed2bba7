"""Files, loaders, entry points: what needs a folder."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from attesta import __main__ as cli
from attesta.operators import constraints, discover, gate, report, search, temporal
from attesta.operators.constraints import ConstraintError
from attesta.sources import tables

KATO = "kato string, kato_version string, level string, type_code string, name_ru string, name_kk string"
ROW = ("101010000", "e", "имя", "аты", "0.03", "0.04", "2026-01-01", "2026-12-31", "Решение № 1", "https://adilet.zan.kz/rus/docs/A", "https://adilet.zan.kz/kaz/docs/A", "deterministic-readers")


def write_rates(spark, path, rows=(ROW,)):
    tables.write_csv(spark.createDataFrame(list(rows), tables.RATES), path)


def test_swap_keeps_the_old_table_when_the_new_one_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.swap_write(spark.range(3), path)
    tables.swap_write(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]
    with pytest.raises(Exception, match="wrong"):
        tables.swap_write(spark.range(2).select(F.raise_error(F.lit("wrong")).cast("string").alias("x")), path)
    assert spark.read.parquet(path).count() == 5


def test_validate_file(spark, tmp_path):
    codes = spark.createDataFrame([("101010000",)], "kato string")
    rules = lambda path: [r.rule for r in constraints.validate_file(spark, path, codes).collect()]
    write_rates(spark, f"{tmp_path}/good")
    assert rules(f"{tmp_path}/good") == [] and rules(f"{tmp_path}/none") == ["file-missing"]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    assert rules(f"{tmp_path}/bad.csv") == ["file-header"]
    rows = spark.createDataFrame([(2, " 100", "e", "2026-01-01", "2026-12-31"), (3, "100", "e", "2026-06-01", "2026-12-31")], "line long, kato string, kato_version string, valid_from string, valid_to string")
    assert [r.rule for r in constraints.overlaps(rows, ["kato", "kato_version"]).collect()] == ["overlap"]


def test_commands(spark, tmp_path, capsys):
    codes, moves = f"{tmp_path}/codes", f"{tmp_path}/moves.csv"
    tables.write_csv(spark.createDataFrame([("101010000", "e", "sub_district", "1", "а", "б")], KATO), codes)
    (tmp_path / "moves.csv").write_text("retired_kato,current_kato,effective_from,kato_version_from,kato_version_to,source_url,note\n999999999,101010000,,,,http://s,\n")
    write_rates(spark, f"{tmp_path}/rates", [ROW, ("999999999", *ROW[1:])])
    run = lambda *a: cli.main(list(a), spark)
    assert run("validate", f"{tmp_path}/rates", codes, "--migrations", moves) == 0
    assert run("validate", f"{tmp_path}/rates", codes) == 1 and "unknown-code" in capsys.readouterr().out
    assert run("validate", f"{tmp_path}/rates", f"{tmp_path}/nothing") == 2
    assert run("resolve", codes, "999999999", "--migrations", moves) == 0 and run("resolve", codes, "1") == 1
    spark.createDataFrame([("d1", "rus", "u", "text", "s")], "document_id string, lang string, url string, text string, sha256 string").write.parquet(f"{tmp_path}/docs")
    assert run("extract", f"{tmp_path}/docs", f"{tmp_path}/out") == 1
    assert spark.read.parquet(f"{tmp_path}/out/queue").first().reason == report.NO_SENTENCE
    with pytest.raises(SystemExit):
        run("unknown")


def test_artefacts(spark, tmp_path):
    rates = spark.createDataFrame([(*ROW, 2), (*ROW[:6], "2027-01-01", "2027-12-31", *ROW[8:], 3)], [*tables.RATES.names, "line"])
    years = report.by_year(rates, spark.createDataFrame([("100000000", "область")], "code string, name string"))
    body = report.payload(years, report.stamp(0)).first().json
    names = report.write_artefacts(spark, body, str(tmp_path), "https://x", "<head>{{HEAD}}</head>{{DATA}}{{ALIASES}}{{VIEW}}{{SEARCH}}", "n", {"rates": rates}, [["1", "</script>", "b", "2"]], "js()", b"<svg/>")
    assert names == sorted(["index.html", "llms.txt", "sitemap.xml", "robots.txt", "datapackage.json", "rates.json", "rates-2026.json", "rates-2027.json"])
    one = json.loads((tmp_path / "rates-2027.json").read_text())
    assert list(one["years"]) == ["2027"] and one["years"]["2027"]["rates"][0]["oblast"] == "область"
    page = (tmp_path / "index.html").read_text()
    assert "2026 · 2027" in page and "<\\/script>" in page and "data:image/svg+xml;base64," in page and page.endswith("js()")
    with pytest.raises(ConstraintError):
        report.write_artefacts(spark, body, str(tmp_path), "https://x", "{{DATA}}", "n", {"rates": rates}, vendored="</script>")
    assert report.data_uri(None) == "" and report.title([]).endswith("· КАТО")


def test_loaders(spark, tmp_path):
    (tmp_path / "a.json").write_text('[["1", "а", "б", "2"]]')
    (tmp_path / "u.json").write_text('[{"document_id": "x"}, {"document_id": "x"}]')
    assert tables.aliases(spark, f"{tmp_path}/a.json").first().resolves_to == "2" and tables.aliases(spark, f"{tmp_path}/no.json").count() == 0
    assert tables.unavailable_log(spark, f"{tmp_path}/u.json").count() == 1 and tables.unavailable_log(spark, f"{tmp_path}/no.json").count() == 0
    tables.write_with_source(spark.createDataFrame([("1", "e", "oblast", "0", "а", "б")], KATO), f"{tmp_path}/k", {"edition": "e"})
    assert json.loads((tmp_path / "k.source.json").read_text()) == {"edition": "e", "rows": 1, "by_level": {"oblast": 1}, "codes_sha256": hashlib.sha256(b"1=oblast").hexdigest()}
    tables.write_rows_json(spark.createDataFrame([("b", None), ("a", 1)], "k string, v int"), f"{tmp_path}/r.json", ["k"])
    assert json.loads((tmp_path / "r.json").read_text()) == [{"k": "a", "v": 1}, {"k": "b", "v": None}]
    files = spark.createDataFrame([("a", b"1"), ("b", b"2")], "name string, content binary").withColumn("sha256", F.sha2("content", 256))
    side = files.select("name", F.when(F.col("name") == "a", F.col("sha256")).otherwise("old").alias("sha256"))
    got, new = tables.read_through(files, side, lambda names: names.withColumn("content", F.lit(b"3")))
    assert {r.name: bytes(r.content) for r in got.collect()} == {"a": b"1", "b": b"3"} and [r.name for r in new.collect()] == ["b"]
    districts = spark.createDataFrame([("2", "в")], "code string, name string")
    assert {(r.code, r.resolves_to) for r in report.with_aliases(districts, tables.aliases(spark, f"{tmp_path}/a.json")).collect()} == {("2", "2"), ("1", "2")}


def test_gate_sink(spark, tmp_path):
    results = spark.createDataFrame([("a", "agree", 0.03), ("b", "blocked", 0.02)], "document_id string, outcome string, model_rate double")
    parsed = spark.createDataFrame([("a", 0.03)], "document_id string, rate double")
    path = f"{tmp_path}/g"
    gate.ingest(results, parsed, path)
    stored = spark.read.parquet(path)
    assert not gate.stale(stored, parsed) and gate.stale(stored, parsed.withColumn("rate", F.lit(0.02))) and not gate.stale(results, parsed)
    with pytest.raises(ConstraintError, match="shrink"):
        gate.ingest(results.where("document_id = 'a'"), parsed, path)
    with pytest.raises(ConstraintError, match="verify"):
        gate.ingest(results.withColumn("outcome", F.lit(gate.CANNOT_VERIFY)), parsed, path)
    with pytest.raises(ConstraintError, match="over 1 rows"):
        gate.fingerprint(results, "document_id", "outcome", 1)


def test_search_surface(spark):
    docs = spark.createDataFrame([(1, "red c++ «ставка»", "a"), (2, "red, fox", "b"), (3, "", "b")], "id long, title string, kind string")
    index = search.Index.build(docs, "id", ["title"], ["kind"])
    ids = lambda hits: [r.doc for r in search.ranked(hits).collect()]
    assert ids(search.search(index, "c++")) == [1] and ids(search.search(index, "«Ставка»!")) == [1]
    assert [r.suggestion for r in search.suggest(index, "red, fo").collect()] == ["red fox"]
    assert ids(search.search(index, "red", where=F.col("kind") == "b")) == [2]
    assert index.stored_fields(1).kind == "a" and not index.has(9) and index.counts().first().documents == 3
    once, twice = (search.search(index, q).orderBy("doc").collect() for q in ("red", "red red"))
    assert all(abs(b.score - 2 * a.score) < 1e-9 and b.terms == 1 for a, b in zip(once, twice, strict=True))
    for bad in (docs.union(docs.limit(1)), docs.withColumn("id", F.lit(None).cast("long"))):
        with pytest.raises(ConstraintError, match="ids"):
            search.Index.build(bad, "id", ["title"])


def test_chains(spark):
    rows = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("t3", "t2"), ("t2", "t1"), ("t1", "x"), ("s", "s"), ("lost", "nowhere")] + [(f"n{i}", f"n{i + 1}") for i in range(300)]
    edges = spark.createDataFrame(rows, "retired string, current string")
    codes = spark.createDataFrame([(c,) for c in ["a", "c", "x", "t3", "s", "lost", "n0", "unheard"]], "code string")
    got = {r.code: (r.resolved, r.hops, r.status) for r in temporal.resolve(codes, spark.createDataFrame([("c",), ("n300",)], "code string"), edges).collect()}
    assert got == {"a": ("c", 2, "current"), "c": ("c", 0, "current"), "x": (None, 3, "cycle"), "t3": (None, 6, "cycle"), "s": (None, 1, "cycle"), "lost": (None, 1, "unknown"), "n0": ("n300", 300, "current"), "unheard": (None, 0, "unknown")}


def test_bodies(spark):
    assert discover.bodies(spark).count() == 20 and constraints.deferred() == []
