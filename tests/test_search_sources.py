import io
import math
import urllib.error
import zipfile

import pytest
from pyspark.sql import functions as F

from attesta.operators import search
from attesta.operators.constraints import ConstraintError
from attesta.sources import documents, tables
from attesta.streaming import watch

DOCS = [(1, "red apple pie", "sweet"), (2, "green apple", "sour apple"), (3, "red brick", None), (4, "", "applet")]


@pytest.fixture(scope="module")
def index(spark):
    return search.Index.build(spark.createDataFrame(DOCS, "id long, title string, body string"), "id", ["title", "body"])


def ids(df):
    return {r.doc for r in df.collect()}


def test_search(spark, index):
    assert ids(search.search(index, "apple")) == {1, 2}
    assert ids(search.search(index, "apple", prefix=True)) == {1, 2, 4}
    assert ids(search.search(index, "aple", fuzzy=0.3)) == {1, 2}
    assert ids(search.search(index, "red apple", combine="AND")) == {1}
    assert ids(search.search(index, "red apple", combine="AND_NOT")) == {3}
    assert ids(search.search(index, "apple", fields=["body"])) == {2}
    assert ids(search.everything(index)) == {1, 2, 3, 4}
    assert search.search(index, " ").count() == 0
    boosted = {r.doc: r.score for r in search.search(index, "apple", boost={"title": 2.0}).collect()}
    plain = {r.doc: r.score for r in search.search(index, "apple").collect()}
    assert math.isclose(boosted[1], 2 * plain[1])
    assert ids(search.combined(search.search(index, "red"), search.search(index, "apple"), "AND")) == {1}
    assert [r.suggestion for r in search.suggest(index, "red ap").collect()] == ["red apple"]


def test_score(index):
    # one match in one field of mean length 9/4 over the four titles: three, two, two and one distinct token
    got = {r.doc: r.score for r in search.search(index, "brick").collect()}
    mean = (3 + 2 + 2 + 1) / 4
    want = math.log(1 + (4 - 1 + 0.5) / 1.5) * (0.5 + 2.2 / (1 + 1.2 * (0.3 + 0.7 * 2 / mean)))
    assert math.isclose(got[3], want)


def test_index_changes(spark, index, tmp_path):
    assert ids(search.search(index.without(spark.createDataFrame([(1,)], "doc long")), "apple")) == {2}
    more = index.plus(spark.createDataFrame([(1, "pear", None), (9, "apple", None)], "id long, title string, body string"), "id")
    assert ids(search.search(more, "apple")) == {2, 9}
    index.save(str(tmp_path))
    assert ids(search.search(search.Index.load(spark, str(tmp_path), ["title", "body"]), "apple")) == {1, 2}


def test_csv(spark, tmp_path):
    rows = [("010000000", 'a "b"', "x,\ny", None), ("2", "", "z", "q")]
    df = spark.createDataFrame([(r[0], "e", r[1], r[2], r[3], None, None, None, None, None, None, None) for r in rows], tables.RATES)
    tables.write_csv(df, f"{tmp_path}/r", "\r\n")
    back = tables.read_csv(spark, f"{tmp_path}/r", tables.RATES)
    assert [(r.kato, r.name_ru) for r in back.orderBy("kato").collect()] == [("010000000", 'a "b"'), ("2", None)]
    assert [r.line for r in tables.with_lines(back).collect()] == [2, 3]
    assert tables.published_ids(spark.createDataFrame([("http://h/docs/A1/",), ("x",)], "source_url string")).first().document_id == "A1"


def test_json(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"method": "m", "rows": [{"id": "a"}, {"id": "b"}]}')
    (tmp_path / "l.json").write_text('[{"id": "a"}]')
    assert tables.read_envelope(spark, f"{tmp_path}/e.json", "rows").count() == 2
    assert tables.envelope_value(spark, f"{tmp_path}/e.json", "method") == "m"
    assert tables.read_list(spark, f"{tmp_path}/l.json").count() == 1
    for bad in (lambda: tables.read_list(spark, f"{tmp_path}/e.json"), lambda: tables.read_envelope(spark, f"{tmp_path}/e.json", "x")):
        with pytest.raises(ConstraintError):
            bad()
    assert tables.migrations(spark, f"{tmp_path}/none.csv").count() == 0


def test_split_write_guards(spark, tmp_path):
    a = spark.createDataFrame([("1", "confirmed"), ("2", "conflict")], "document_id string, outcome string")
    paths = f"{tmp_path}/good", f"{tmp_path}/queue"
    assert tables.split_write(a, *paths) == {"confirmed": 1, "conflict": 1}
    with pytest.raises(ConstraintError, match="shrink"):
        tables.split_write(a.where("document_id = '2'"), *paths)
    assert spark.read.parquet(paths[0]).count() == 1
    tables.split_write(a.where("document_id = '2'"), *paths, allow_shrink=True)
    assert spark.read.parquet(paths[0]).count() == 0


def test_blobs(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"x")
    (tmp_path / "b.pdf").write_bytes(b"y")
    files = tables.blobs(spark, str(tmp_path), "*.pdf")
    side = files.select("name", F.when(F.col("name") == "a", F.col("sha256")).otherwise("0").alias("sha256"))
    good, again = tables.verified_blobs(files, side)
    assert [r.name for r in good.collect()] == ["a"] and [r.name for r in again.collect()] == ["b"]


def workbook(rows):
    shared = sorted({c for r in rows for c in r})
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = f"<sst {ns}>" + "".join(f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r></si>" for s in shared) + "</sst>"
    sheet = f"<worksheet {ns}><sheetData>" + "".join("<row>" + "".join(f'<c t="s"><v>{shared.index(c)}</v></c>' for c in r) + "</row>" for r in rows) + "</sheetData></worksheet>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", strings)
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return out.getvalue()


def test_xlsx(spark, tmp_path):
    row = ["100000000", "10", "00", "00", "000", "0", "Қаз", "Рус", "1"]
    (tmp_path / "k.xlsx").write_bytes(workbook([documents.SHEET_HEADER, row]))
    spark.dataSource.register(documents.XlsxSource)
    for sheet in (documents.read_xlsx(spark, f"{tmp_path}/k.xlsx"), spark.read.format("xlsx").load(f"{tmp_path}/k.xlsx")):
        r = documents.classifier_rows(sheet, "e1").first()
        assert (r.kato, r.level, r.type_code, r.name_ru, r.name_kk) == ("100000000", "oblast", "0", "Рус", "Қаз")
    (tmp_path / "d.xlsx").write_bytes(workbook([documents.SHEET_HEADER, row, row]))
    with pytest.raises(ConstraintError):
        documents.classifier_rows(documents.read_xlsx(spark, f"{tmp_path}/d.xlsx"), "e1")
    (tmp_path / "h.xlsx").write_bytes(workbook([["x"], row]))
    with pytest.raises(ConstraintError):
        documents.classifier_rows(documents.read_xlsx(spark, f"{tmp_path}/h.xlsx"), "e1")


def test_page_text(spark):
    df = spark.createDataFrame([(b"a  b|c",), (None,)], "c binary")
    text = documents.page_text(lambda content: content.decode().split("|"))
    assert [r.t for r in df.select(text("c").alias("t")).collect()] == ["a b c", None]


def test_fetch():
    calls, slept = [], []

    def flaky(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("reset")
        return io.BytesIO(b"ok")

    assert documents.fetch("u", opener=flaky, sleep=slept.append) == b"ok" and slept == [2, 4]

    def refused(url, timeout):
        calls.append(url)
        raise urllib.error.HTTPError(url, 404, "no", {}, None)

    calls.clear()
    with pytest.raises(urllib.error.HTTPError):
        documents.fetch("u", opener=refused, sleep=slept.append)
    assert len(calls) == 1
    now, waits = [0.0], []
    throttle = documents.Throttle(2, lambda: now[0], waits.append)
    for _ in range(3):
        throttle.wait()
    assert waits == [0.5, 1.0]

    def moved(url, timeout):
        raise urllib.error.HTTPError(url, 302, "", {"Location": "http://x/a.pdf;jsessionid=1?b"}, None)

    assert documents.redirect_target("u", moved) == "http://x/a.pdf?b"


def test_watch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"document_id": "a", "title": "t", "fetched_at": "2026-01-01T00:00:00Z"}\n' * 2 + '{"document_id": "b", "title": "t", "fetched_at": "2026-01-01T00:00:00Z"}')
    seen = []
    q = watch.run(spark, f"{tmp_path}/in", f"{tmp_path}/cp", lambda df, _: seen.extend(r.document_id for r in df.collect()))
    q.awaitTermination(60)
    assert sorted(seen) == ["a", "b"]
    known = spark.createDataFrame([("a", "t"), ("b", "t"), ("c", "t")], "document_id string, title string")
    now = spark.createDataFrame([("a", "t"), ("b", "u"), ("d", "t")], "document_id string, title string")
    assert {r.document_id: r.change for r in watch.checked(known, now, "a").collect()} == {"b": "changed", "c": "gone", "d": "new"}
    with pytest.raises(ConstraintError, match="could not check"):
        watch.checked(known, now, "zz")
