import json

import pytest
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import discover, report
from attesta.operators.constraints import ConstraintError


def test_titles(spark):
    df = spark.createDataFrame([("О понижении размера ставки на 2026 год", "rate-decision", True), ("О признании утратившим силу решения о понижении ставки на 2026 год", "repeal", False), ("О понижении ставки на 2025 год", "other", False), ("О внесении изменений: понижение ставки 2026", "rate-decision", False)], "t string, want string, ok boolean")
    for r in df.select("want", "ok", discover.title_class(F.col("t"), 2026).alias("c"), discover.is_rate_decision(F.col("t"), 2026).alias("d")).collect():
        assert (r.c, r.d) == (r.want, r.ok)


def test_listing(spark):
    html = 'Найдено: 1 230 документов <a href="/rus/docs/G25A1" x>\n О понижении &laquo;размера&raquo; ставки &#1040;</a>'
    df = spark.createDataFrame([("p", html), ("q", "nothing")], "k string, h string")
    assert [tuple(r) for r in discover.links(df, "k", "h").collect()] == [("p", "G25A1", "О понижении «размера» ставки А")]
    assert {r.k: r.n for r in df.select("k", discover.total_stated(F.col("h")).alias("n")).collect()} == {"p": 1230, "q": 0}
    urls = [r[0] for r in spark.range(1, 3).orderBy("id").select(discover.listing_url("b", F.lit("x"), F.lit(2026), F.col("id"))).collect()]
    assert urls[0].endswith("pagesize=100") and urls[1] == urls[0] + "&page=2"


def test_frontier(spark):
    titles = {"seed": [("a", "one two")], "one two": [("b", "three")], "three": [("a", "one two")], "dry": [], "never": [("z", "z")]}
    catalogue = lambda p: spark.createDataFrame(titles.get(p, []), "document_id string, title string")
    assert discover.frontier(catalogue, ["seed", "dry"], lambda t: t != "") == {"a": "one two", "b": "three"}


ASKED = "body string, adopted_year int"


def page(ids, total):
    return f"Найдено: {total} документов " + " ".join(f'<a href="/rus/docs/{i}" x>О понижении ставки на 2026 год, {t}</a>' for i, t in ids)


def one_by_one(site, body, most):
    """A listing read page by page, as a reader with a loop would: {document: (title)}, failure."""
    found = {}
    for n in range(1, most + 1):
        ids, total, error = site.get((body, n), ([], 0, "no answer"))
        if error:
            return found, error
        before = len(found)
        found.update(ids)
        if len(found) == before or len(found) >= total:
            break
    return found, None


def test_paging(spark):
    site = {
        ("whole", 1): ([("A", "a"), ("B", "b")], 3, None), ("whole", 2): ([("C", "c")], 3, None),
        ("fails", 1): ([("A", "a"), ("B", "b")], 9, None), ("fails", 2): ([], 0, "gone"), ("fails", 3): ([("Z", "z")], 9, None),
        ("stalls", 1): ([("A", "a"), ("B", "b")], 9, None), ("stalls", 2): ([("A", "other"), ("B", "b")], 9, None), ("stalls", 3): ([("Z", "z")], 9, None),
        ("thin", 1): ([("A", "a"), ("B", "b"), ("C", "c")], 5, None), ("thin", 2): ([("C", "later"), ("D", "d")], 5, None), ("thin", 3): ([("E", "e")], 5, None),
        ("endless", 1): ([("N1", "a")], 99, None), ("endless", 2): ([("N2", "a")], 99, None), ("endless", 3): ([("N3", "a")], 99, None), ("endless", 4): ([("N4", "a")], 99, None), ("endless", 5): ([("N5", "a")], 99, None),
        ("empty", 1): ([], 0, None), ("down", 1): ([], 0, "down"), ("shrinks", 1): ([("A", "a"), ("B", "b")], 8, None), ("shrinks", 2): ([("C", "c")], 2, None), ("shrinks", 3): ([("D", "d")], 8, None),
    }
    pages = spark.createDataFrame([(b, n, None if e else page(ids, t), e) for (b, n), (ids, t, e) in site.items()], "body string, page int, html string, error string")
    asked = []

    def get(wanted):
        asked.append(wanted.count())
        return wanted.join(pages, ["body", "page"])

    names = sorted({b for b, _ in site}) + ["unheard"]
    found, failures = discover.pages_of(spark.createDataFrame([(b, 2026) for b in names], ASKED), get, most=4)
    got = {}
    for r in found.orderBy("page", "place").collect():
        got.setdefault(r.body, {})[r.document_id] = r.title.split(", ")[1]
    want = {b: one_by_one(site, b, 4) for b in names}
    assert got == {b: f for b, (f, _) in want.items() if f}
    assert {r.body: r.reason for r in failures.collect()} == {b: e for b, (_, e) in want.items() if e}
    assert asked[0] == len(names) and len(asked) == 3  # first pages, those that totals ask for, one more for the listing with repeats


def test_paging_nothing(spark):
    found, failures = discover.sweep(spark.createDataFrame([], "body string, name string, adopted_year int"), lambda asked: asked.withColumn("html", F.lit("")).withColumn("error", F.lit(None).cast("string")))
    assert found.count() == failures.count() == 0 and found.columns == ["document_id", "title", "body", "adopted_year", "kind"]


def test_fetched_by(spark):
    def get(url):
        if "1_2" in url:
            raise OSError("down")
        return page([("A", "a")], 1)

    listings = spark.createDataFrame([("1", "one", 2026), ("2", "two", 2026), ("3", "three", 2026), ("1", "one", 2025)], "body string, name string, adopted_year int")
    found, failures = discover.sweep(listings, discover.fetched_by(get, 2), "https://h")
    assert [(r.document_id, r.body, r.adopted_year, r.kind) for r in found.collect()] == [("A", "one", 2025, "rate-decision")]
    assert [tuple(r) for r in failures.collect()] == [("2", 2026, "down")]


def test_sample_and_comparison(spark):
    ids = spark.range(95).select(F.format_string("%03d", "id").alias("document_id"))
    assert [r.document_id for r in discover.systematic_sample(ids, "document_id", 10).orderBy("document_id").collect()] == [f"{i:03d}" for i in range(0, 90, 9)]
    got = {r.side: r.n for r in discover.compare_indexes(ids, ids.where("document_id >= '090'")).collect()}
    assert got == {"both": 5, "only_a": 90}


def test_coverage(spark):
    names = spark.createDataFrame([("1", "Прибрежный район"), ("2", "Степнинский район"), ("3", "Прибрежный Г.А.")], "code string, name string")
    docs = spark.createDataFrame([("a", "по Прибрежному району"), ("b", "иное")], "document_id string, title string")
    c = discover.candidates_by_roots(docs, "document_id", "title", names)
    row = discover.coverage(docs, c, names).first()
    assert (row.documents, row.with_candidates, row.with_none) == (2, 1, 1)
    assert row.districts_less_documents == 2 and row.districts_not_named == 1


def test_publish_refuses(spark):
    mapped = spark.createDataFrame([("d1", "mapped", "101010000", "а", None, 0.03, 2026, "Решение № 1", "u1"), ("d2", "unmapped", "1", "x", None, 0.03, 2026, None, None)], "document_id string, outcome string, kato string, name_ru string, name_kk string, rate double, year int, decision_ref string, source_url string")
    names = spark.createDataFrame([("101010000", "а2", "б")], "code string, name_ru string, name_kk string")
    urls = spark.createDataFrame([("d1", "k1")], "document_id string, kazakh_source_url string")
    row = report.publish(mapped, names, urls, "e1", "m", {2026: 4}).first()
    assert (row.name_ru, row.name_kk, row.rate, row.base_rate, row.valid_to) == ("а", "б", "0.03", "0.04", "2026-12-31")
    for broken in (mapped.withColumn("decision_ref", F.lit("None")), mapped.withColumn("year", F.lit(1999))):
        with pytest.raises(ConstraintError, match="cannot publish"):
            report.publish(broken, names, urls, "e1", "m", {2026: 4})


def test_reports(spark):
    rates = spark.createDataFrame([(2, "271000000", "а", "б", "0.03", "0.04", "2026-01-01", "r", "u", "deterministic-readers"), (3, "391000000", "в", "г", "0.02", "0.05", "2026-01-01", "r", "u", "hand")], "line int, kato string, name_ru string, name_kk string, rate string, base_rate string, valid_from string, decision_ref string, source_url string, extraction_method string")
    oblasts = spark.createDataFrame([("270000000", "Озёрная область")], "code string, name string")
    years = report.by_year(rates, oblasts)
    r = years.first()
    assert (r.year, r.base_rate, r.districts, r.machine_extracted, [x.oblast for x in r.rates]) == ("2026", 0.04, 2, 1, ["Озёрная область", ""])
    body = json.loads(report.payload(years, "2026-01-01T00:00:00Z").first().json)
    assert body["years"]["2026"]["districts"] == 2
    queue = spark.createDataFrame([("q1", "document is amended or repealed: x", 1), ("q2", "why", 2)], "document_id string, reason string, pos long")
    mapped = spark.createDataFrame([("m1", "unmapped-several-districts-matched", ["Дом"], 1), ("m2", "mapped", [], 2)], "document_id string, outcome string, candidates array<string>, pos long")
    refused = report.refused(queue, mapped)
    assert [(g.category, g.n) for g in report.grouped(refused, "category", "pos").collect()] == [("repealed", 1), ("other", 1), ("unmapped-several-districts-matched", 1)]
    districts = spark.createDataFrame([("271000000", "а", 1), ("1", "Дом", 2), ("2", "Дом", 3)], "code string, name string, pos int")
    absent = {r.code: [a.document_id for a in r.attribution] for r in report.absent(districts, rates, refused).collect()}
    assert absent == {"1": [], "2": ["m1"]}


def test_rendering(spark):
    assert report.rendered("{{a}}{{b}}", {"a": "{{b}}", "b": "1"}) == "{{b}}1"
    with pytest.raises(ConstraintError):
        report.rendered("", {}, "x</script>")
    assert report.stamp(0) == "1970-01-01T00:00:00Z"
    assert report.description(["2027", "2026"]) == "2026, 2027"
    assert report.page_view(["2026", "2027"], "2026-05-01")["future_note"] == ["2027"]
    assert report.sitemap(["a", "a&b", "a"]).count("<url>") == 2
    assert json.loads(report.datapackage("x", {"t": spark.range(1)}))["resources"][0]["schema"]["fields"] == [{"name": "id", "type": "integer"}]


def test_text_functions(spark):
    df = spark.createDataFrame([("  Ёлка,  дом-музей\t и ВОДА  ", "a b/c?d")], "t string, u string")
    t = F.col("t")
    r = df.select(T.squeeze(t).alias("s"), T.strip(t).alias("p"), T.tokens(t).alias("w"), T.url_quoted(F.col("u")).alias("u"), T.escaped(F.lit("<a&'\">")).alias("e"), T.script_safe(F.lit("</x")).alias("j"), T.is_blank(F.lit(" \t")).alias("b")).first()
    assert (r.s, r.p, r.w, r.u, r.e, r.j, r.b) == ("Ёлка, дом-музей и ВОДА", "Ёлка,  дом-музей\t и ВОДА", ["ёлка", "дом-музей", "и", "вода"], "a%20b/c%3Fd", "&lt;a&amp;&#x27;&quot;&gt;", "<\\/x", True)
