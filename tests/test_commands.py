"""The command lines over a small site and folder, one after another as a user would run them."""

import json
from urllib.parse import unquote

from attesta import __main__ as cli
from attesta.operators import discover
from attesta.sources import documents, publish, tables
from tests.test_discover_report import page
from tests.test_search_sources import workbook

KATO = [("100000000", "e", "oblast", "0", "Озёрная область", "о"), ("101000000", "e", "district", "2", "Северный район", "с"), ("102000000", "e", "district", "2", "Южный район", "ю")]


def put(root, spark, url_column, html):
    """A page of the site, at the address that the library asks for."""
    url = spark.range(1).select(url_column).first()[0]
    path = root / unquote(url.removeprefix(f"file://{root}/"))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(html)


def test_enumerate_and_discover(spark, tmp_path, capsys):
    from pyspark.sql import functions as F

    base, out = f"file://{tmp_path}", f"{tmp_path}/enumerated"
    run = lambda *a: cli.main([*a, "--base", base, "--attempts", "1", "--rate", "1000"], spark)
    address = lambda body, year, n: discover.listing_url(base, F.lit(body), F.lit(year), F.lit(n))
    put(tmp_path, spark, address("152", 2026, 1), page([("A1", "a"), ("A2", "b")], 3))
    put(tmp_path, spark, address("152", 2026, 2), page([("A3", "c")], 3))
    assert run("enumerate", out, "--years", "2026", "--bodies", "152") == 0
    put(tmp_path, spark, F.lit(discover.search_url(base, "phrase")), page([("A1", "a"), ("X9", "x")], 2))
    found = f"{tmp_path}/found"
    assert run("discover", found, "phrase", "nothing", "--year", "2026") == 2  # the second phrase has no page: could not check
    for phrase in ("nothing", " ".join("О понижении ставки на 2026 год, a".split())):
        put(tmp_path, spark, F.lit(discover.search_url(base, phrase)), page([], 0))
    put(tmp_path, spark, F.lit(discover.search_url(base, "О понижении ставки на 2026 год, x")), page([], 0))
    assert run("discover", found, "phrase", "nothing", "--year", "2026") == 0
    assert sorted(r.document_id for r in spark.read.parquet(found).collect()) == ["A1", "X9"]
    capsys.readouterr()
    assert run("enumerate", out, "--years", "2026", "--bodies", "152", "153", "--found", found, "--sample", "5") == 1  # 153 has no listing
    told = capsys.readouterr().out
    assert "body=153" in told and "only_b|  1" in told
    held = publish.Publication(spark, out)
    assert {r.document_id: r.kind for r in held.read("documents").collect()} == {f"A{i}": "rate-decision" for i in (1, 2, 3)} and held.versions() == [1, 2]
    assert run("enumerate", out, "--years", "2026", "--bodies", "999") == 1


def test_classifier(spark, tmp_path):
    row = ["100000000", "10", "00", "00", "0000", "0", "о", "Озёрная область"]
    (tmp_path / "k.xlsx").write_bytes(workbook([documents.SHEET_HEADER, row]))
    assert cli.main(["classifier", f"{tmp_path}/k.xlsx", f"{tmp_path}/codes", "e"], spark) == 0
    assert tables.read_csv(spark, f"{tmp_path}/codes", tables.KATO).first().level == "oblast"
    source = json.loads((tmp_path / "codes.source.json").read_text())
    assert source["rows"] == 1 and source["by_level"] == {"oblast": 1} and len(source["workbook_sha256"]) == len(source["codes_sha256"]) == 64


def test_map_publish_build(spark, tmp_path, capsys):
    at = lambda name: f"{tmp_path}/{name}"
    run = lambda *a: cli.main(list(a), spark)
    tables.write_csv(spark.createDataFrame(KATO, tables.KATO), at("codes"))
    rows = [("D1", "confirmed", "Решение Северного районного маслихата Озёрной области № 1", "s", 0.03, 2026, "https://h/rus/docs/D1"), ("D2", "confirmed", "Решение Восточного районного маслихата Озёрной области № 2", "s", 0.02, 2026, "https://h/rus/docs/D2"), ("D3", "refused", None, None, None, None, None)]
    spark.createDataFrame(rows, "document_id string, outcome string, decision_ref string, sentence string, rate double, year int, source_url string").write.parquet(at("confirmed"))
    spark.createDataFrame([("D1", "Озёрная область", None), ("D2", "Озёрная область", None)], "document_id string, body string, title string").write.parquet(at("listed"))
    assert run("map", at("confirmed"), at("listed"), at("codes"), at("mapped")) == 1 and "document_id=D2" in capsys.readouterr().out
    assert run("publish", at("mapped"), at("codes"), at("rates"), "--base-rates", "2025=4") == 1 and not (tmp_path / "rates").exists()
    assert run("publish", at("mapped"), at("codes"), at("rates"), "--base-rates", "2026=4") == 0
    (r,) = tables.read_csv(spark, at("rates"), tables.RATES).collect()
    assert (r.kato, r.name_kk, r.rate, r.base_rate, r.kazakh_source_url) == ("101000000", "с", "0.03", "0.04", "https://adilet.zan.kz/kaz/docs/D1")
    (tmp_path / "t.html").write_text("<head>{{HEAD}}</head>{{DATA}}{{ALIASES}}{{VIEW}}{{SEARCH}}")
    assert run("build", at("rates"), at("codes"), at("t.html"), at("site"), "https://x") == 0
    one = json.loads((tmp_path / "site" / "rates-2026.json").read_text())["years"]["2026"]
    assert one["districts"] == 1 and one["rates"][0]["oblast"] == "Озёрная область"


def test_gate(spark, tmp_path, capsys):
    at = lambda name: f"{tmp_path}/{name}"
    run = lambda *a: cli.main(list(a), spark)
    spark.createDataFrame([("D1", "confirmed", 0.03), ("D2", "confirmed", 0.02)], "document_id string, outcome string, rate double").write.parquet(at("confirmed"))
    spark.createDataFrame([("Q1",)], "document_id string").write.parquet(at("queue"))
    spark.createDataFrame([(i, f"u/{i}", f"до {r} процентов", None) for i, r in (("D1", 3), ("D2", 2))], "document_id string, source_url string, text string, kazakh_text string").write.parquet(at("texts"))
    assert run("emit", at("texts"), at("tasks"), "--confirmed", at("confirmed"), "--queue", at("queue"), "--population", "all") == 1 and "document_id=Q1" in capsys.readouterr().out
    assert run("emit", at("texts"), at("tasks"), "--confirmed", at("confirmed")) == 0
    assert sorted(p.name for p in (tmp_path / "tasks").iterdir() if "=" in p.name) == ["document_id=D1", "document_id=D2"]
    (tmp_path / "b1.json").write_text('{"document_id": "D1", "rate": 0.03, "quoted_span": "до 3 процентов"}\n')
    (tmp_path / "b2.json").write_text('{"document_id": "D2", "rate": 0.03, "quoted_span": "до 2 процентов"}\n')
    assert run("ingest", at("confirmed"), at("tasks"), at("results"), at("b1.json"), at("b1.json")) == 1  # one id in two batches
    assert run("ingest", at("confirmed"), at("tasks"), at("results"), at("b1.json")) == 0
    assert run("ingest", at("confirmed"), at("tasks"), at("results"), at("b2.json")) == 1 and "refused" in capsys.readouterr().err  # D1 would go
    assert run("ingest", at("confirmed"), at("tasks"), at("results"), at("b1.json"), at("b2.json")) == 1
    assert {r.document_id: r.outcome for r in spark.read.parquet(at("results")).collect()} == {"D1": "agree", "D2": "refused"}
    assert run("report", at("results")) == 1
