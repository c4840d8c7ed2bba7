"""Queries that run the library's readers, resolution, reports, gate, discovery and search over texts and frames made from the driver tables: what
each row has to come to follows from its key, and that is what the SQL says."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import consensus, constraints, discover, gate, readers, report, resolve, search, temporal
from ..sources import tables
from .catalogue import _SEARCH, _EXACT, _TITLES, _rounded, _terms, _titles, query, read

# The texts are this library's own; shapes by key, modulo 12.
HEAD = "Решение Северного районного маслихата Озёрной области от 7 ноября 2025 года № 12-"
CLAUSE = "Понизить размер ставки при применении специального налогового режима на основе упрощенной декларации с {old} на {new} за налоговый период в 2026 году."
TAIL = " Настоящее решение вводится в действие с 1 января 2026 года."
KAZAKH = "мөлшерлемесін 4 (төрт) пайыздан {} пайызға төмендетілсін."
SUPERSEDED, TWICE, NONE, TRANSPORT, ABSENT, ORIGIN, RISE, WORD, OTHER_KAZAKH, RETAIL = range(2, 12)


def _clause(old: str, digit: Column, word: Column, clause: str = CLAUSE) -> Column:
    a, b = clause.format(old=old, new="|").split("|")
    return F.concat(F.lit(a), digit, F.lit(" ("), word, F.lit(") процента"), F.lit(b))


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document_id, k, text, kazakh_text, kazakh_error) for each order."""
    k = F.col("o_orderkey")
    n, shape = (2 + k % 2).cast("string"), k % 12
    word = lambda x: F.when(x == "2", "два").otherwise("три")
    kazakh = lambda x: F.concat(x, F.when(x == "2", " (екі)").otherwise(" (үш)"))
    other = F.when(n == "2", "3").otherwise("2")
    plain = _clause("4 (четырех) процентов", n, word(n))
    percent = F.concat(F.lit(CLAUSE.split("{old}")[0].removesuffix("с ") + "с 4% до "), n, F.lit("%" + CLAUSE.split("{new}")[1]))
    body = (
        F.when(shape == 1, percent)
        .when(shape == TWICE, F.concat_ws(" ", plain, plain))
        .when(shape == NONE, "Понизить размер ставки.")
        .when(shape == ORIGIN, _clause("5 (пяти) процентов", n, word(n)))
        .when(shape == RISE, _clause("3 (три) процентов", F.lit("4"), F.lit("четыре")))
        .when(shape == WORD, _clause("4 (четырех) процентов", n, word(other)))
        .when(shape == RETAIL, F.replace(plain, F.lit("упрощенной декларации"), F.lit("розничного налога")))
        .otherwise(plain)
    )
    text = F.concat(F.when(shape == SUPERSEDED, "Утратило силу. ").otherwise(""), F.lit(HEAD), k.cast("string"), F.lit(". "), body, F.lit(TAIL))
    a, b = KAZAKH.split("{}")
    other_text = F.concat(F.lit(a), kazakh(F.when(shape == OTHER_KAZAKH, other).otherwise(n)), F.lit(b))
    error = F.when(shape == TRANSPORT, "SSLError: x").when(shape == ABSENT, "HTTPError: HTTP Error 404: ")
    return read(spark, sf_dir, "orders").select(k.cast("string").alias("document_id"), k.alias("k"), text.alias("text"), F.when(error.isNull(), other_text).alias("kazakh_text"), error.alias("kazakh_error"))


def _told(results: DataFrame, *more: Column) -> DataFrame:
    values = F.array_join(F.transform("readings", lambda r: F.coalesce(r["rate_percent"].cast("string"), F.lit("-"))), ",")
    category = F.when(F.col("reason").isNotNull(), report.refusal_category(F.col("reason")))
    return results.select("document_id", "outcome", F.col("rate").cast("double").alias("rate"), category.alias("category"), "year", "year_source", "in_force_from", "terminal", "decision_ref", values.alias("told"), *more)


_DECIDED = f"""
SELECT o_orderkey::VARCHAR AS document_id, CASE WHEN s < 2 THEN 'confirmed' WHEN s < 5 THEN 'unparsed' ELSE 'conflict' END AS outcome, CASE WHEN s < 2 THEN n / 100.0 END::DOUBLE AS rate,
  CASE s WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'repealed' WHEN 3 THEN 'no-sentence' WHEN 4 THEN 'no-sentence' WHEN 6 THEN 'no-kazakh-text' WHEN 11 THEN 'other-regime' ELSE 'other' END AS category,
  2026 AS year, CASE WHEN s = 4 THEN 'in-force-date' ELSE 'tax-period' END AS year_source, CASE WHEN s NOT BETWEEN 2 AND 4 THEN '2026-01-01' END AS in_force_from,
  CASE WHEN s >= 2 THEN s = 11 END AS terminal, CASE WHEN s NOT BETWEEN 2 AND 4 THEN '{HEAD}' || o_orderkey END AS decision_ref,
  CASE WHEN s = 1 THEN n || ',-,' || n || ',' || n || ',-' WHEN s BETWEEN 2 AND 4 THEN n || '' WHEN s IN (5, 6) THEN n || ',' || n || ',' || n || ',-,-' WHEN s = 7 THEN n || ',' || n || ',-,' || n || ',-'
    WHEN s = 8 THEN '4,4,-,' || n || ',-' WHEN s = 9 THEN n || ',' || (5 - n) || ',' || n || ',' || n || ',-' WHEN s = 10 THEN n || ',' || n || ',' || n || ',' || (5 - n) || ',-' ELSE n || ',' || n || ',' || n || ',' || n || ',-' END AS told
FROM (SELECT o_orderkey, o_orderkey % 12 AS s, 2 + o_orderkey % 2 AS n FROM orders)"""


@query(_DECIDED)
def decisions_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five readers and the whole ladder over one decision per order."""
    return _told(consensus.classify(_decisions(spark, sf_dir)))


@query(_DECIDED.replace("FROM (SELECT", ", 'https://adilet.zan.kz/rus/docs/' || o_orderkey AS source_url, s IN (5, 6) AS lacks_kazakh FROM (SELECT"))
def decisions_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From ids, fetched files in two languages and failures to outcomes."""
    d = _decisions(spark, sf_dir)
    one = lambda lang, text: d.select("document_id", F.lit(lang).alias("lang"), F.lit("u").alias("url"), F.col(text).alias("text"), F.sha2(F.col(text), 256).alias("sha256")).where("text is not null")
    failures = d.where("kazakh_error is not null").select("document_id", F.lit("kaz").alias("lang"), F.col("kazakh_error").alias("error"))
    out = consensus.extract(d.select("document_id"), one("rus", "text").unionByName(one("kaz", "kazakh_text")), failures)
    return _told(out, F.col("source_url"), F.col("kazakh_pdf_sha256").isNull().alias("lacks_kazakh"))


@query("""
SELECT o_orderkey, CASE WHEN s = 3 THEN NULL ELSE 2024 + s END::INTEGER AS year, CASE s WHEN 0 THEN 'tax-period' WHEN 1 THEN 'in-force-date' WHEN 2 THEN 'retroactive-effect' WHEN 4 THEN 'caller-hint' END AS source
FROM (SELECT o_orderkey, o_orderkey % 5 AS s FROM orders)""")
def year_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year by its precedence: stated period, date in force, retroactive clause, the caller's hint, or none."""
    s = F.col("o_orderkey") % 5
    text = (
        F.when(s == 0, "за налоговый период в 2024 году. Вводится в действие с 1 января 2025 года")
        .when(s == 1, "Решение вводится в действие с 01.01.2025")
        .when(s == 2, "распространяется на правоотношения, возникшие с 1 января 2026 года. Вводится в действие с 5 марта 2027 года")
        .otherwise("на 2024 год, в 2025 году")
    )
    year = readers.year(text, F.when(s == 4, 2028))
    return read(spark, sf_dir, "orders").select("o_orderkey", year.alias("y")).select("o_orderkey", "y.year", "y.source")


# A classifier slice of this library's own.
OBLASTS = [("110000000", "Приозёрная область"), ("220000000", "Степнинская область"), ("330000000", "г. Светлоград")]
DISTRICTS = [("111000000", "Берёзовский район"), ("112000000", "Берёзовск Г.А."), ("221000000", "Тополевский район"), ("222000000", "Аксу Г.А.")]
_CASES = [
    ("Решение Тополевского районного маслихата Степнинской области", "Степнинская область", "О ставке"),
    ("Решение Тополевского районного маслихата Степнинской области", "Приозёрная область", "О ставке"),
    ("Решение Тополевского районного маслихата", "Степнинская область", "О ставке"),
    ("Решение Тополевского районного маслихата", None, "О ставке"),
    ("Решение маслихата города Светлоград", "г. Светлоград", "О ставке"),
    ("Решение маслихата Степнинской области", "Степнинская область", "О ставке в Тополевском районе"),
    ("Решение Тополевского районного маслихата Степнинской области", "Степнинская область", "О ставке в городе Аксу"),
    ("Решение Берёзовского районного маслихата Приозёрной области по Берёзовскому району", "Приозёрная область", "О ставке"),
]


def _dimension(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "code string, name string")


@query("""
SELECT o_orderkey::VARCHAR AS document_id, CASE s WHEN 1 THEN 'unmapped-oblast-sources-disagree' WHEN 3 THEN 'unmapped-no-issuing-body-recorded' WHEN 6 THEN 'unmapped-title-contradicts-citation' ELSE 'mapped' END AS outcome,
  CASE s WHEN 0 THEN '221000000' WHEN 2 THEN '221000000' WHEN 4 THEN '330000000' WHEN 5 THEN '221000000' WHEN 7 THEN '111000000' END AS code,
  CASE WHEN s = 2 THEN 'body-only' WHEN s NOT IN (1, 3) THEN 'both' END AS oblast_source, CASE s WHEN 4 THEN 'oblast-level' WHEN 5 THEN 'title' WHEN 0 THEN 'citation' WHEN 2 THEN 'citation' WHEN 7 THEN 'citation' END AS district_source
FROM (SELECT o_orderkey, o_orderkey % 8 AS s FROM orders)""")
def documents_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources for the oblast, blocking by code prefix, stems, kinds, title as fallback and veto."""
    k = F.col("o_orderkey")
    case = F.array(*[F.struct(*[F.lit(x).cast("string").alias(n) for x, n in zip(c, ("decision_ref", "body", "title"), strict=True)]) for c in _CASES])
    docs = read(spark, sf_dir, "orders").select(k.cast("string").alias("document_id"), F.get(case, (k % 8).cast("int")).alias("c")).select("document_id", "c.*", F.lit("ставка понижена").alias("sentence"))
    return resolve.map_documents(docs, _dimension(spark, OBLASTS), _dimension(spark, DISTRICTS)).select("document_id", "outcome", "code", "oblast_source", "district_source")


@query("""
SELECT o_orderkey, CASE s WHEN 0 THEN 'city' WHEN 1 THEN 'district' END AS title_kind, CASE s WHEN 0 THEN 'city' WHEN 1 THEN 'district' WHEN 2 THEN 'city' WHEN 3 THEN 'district' END AS body_kind,
  CASE s WHEN 0 THEN 'city' ELSE 'district' END AS candidate FROM (SELECT o_orderkey, o_orderkey % 5 AS s FROM orders)""")
def jurisdiction_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderkey") % 5
    told = [("городе Аксу, городской маслихат", "Аксу Г.А."), ("по району, районного маслихата", "Аксуский район"), ("маслихат города", "район"), ("маслихат Абайского района", "район"), ("городе Аксу и району: городского маслихата, районного маслихата", "район")]
    text, name = (F.get(F.array(*[F.lit(t[i]) for t in told]), s.cast("int")) for i in (0, 1))
    titled = F.when(s == 3, F.lit(None).cast("string")).otherwise(resolve.title_kind(text)["kind"])
    return read(spark, sf_dir, "orders").select("o_orderkey", titled.alias("title_kind"), resolve.body_kind(text)["kind"].alias("body_kind"), resolve.candidate_kind(name).alias("candidate"))


@query("""
WITH n AS (SELECT c_custkey AS k, c_custkey % 4 AS s FROM customer)
SELECT count(*) AS documents, sum((s < 3)::INT)::BIGINT AS with_candidates, sum((s IN (1, 2))::INT)::BIGINT AS with_one, sum((s = 0)::INT)::BIGINT AS with_several, sum((s = 3)::INT)::BIGINT AS with_none,
  4::BIGINT AS districts, 4::BIGINT AS district_names, (4 - (CASE WHEN bool_or(s = 0) THEN 2 ELSE 0 END + bool_or(s = 1)::INT))::BIGINT AS districts_not_named, (4 - sum((s < 3)::INT))::BIGINT AS districts_less_documents FROM n""")
def coverage_by_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = F.get(F.array(*[F.lit(t) for t in ("по Берёзовскому", "О ставке Тополевского", "Тополевский", "иное")]), (F.col("c_custkey") % 4).cast("int"))
    docs = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("document_id"), titles.alias("title"))
    names = _dimension(spark, DISTRICTS)
    return discover.coverage(docs, discover.candidates_by_roots(docs, "document_id", "title", names), names)


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN page_id * 1000 ELSE 0 END::INTEGER AS total, 'G' || page_id AS document_id, 'О понижении «ставки» № ' || page_id AS title FROM pages""")
def listing_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id").cast("string")
    total = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("<p>Найдено:&nbsp;<b>"), k, F.lit(" 000</b> документов</p>"))).otherwise("<p>Найдено <i>Найдено:</i> мало</p>")
    html = F.concat(total, F.lit('<a href="/rus/docs/G'), k, F.lit('" class="x">\n О понижении  &laquo;ставки&raquo; &#8470; '), k, F.lit("</a>"))
    pages = read(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return discover.links(pages, "page_id", "html").join(pages.select("page_id", discover.total_stated(F.col("html")).alias("total")), "page_id").select("page_id", "total", "document_id", "title")


_BODIES = ", ".join(f"('{k}', '{v}')" for k, v in discover.BODIES.items())


@query(f"""
WITH l AS (SELECT (151 + c_nationkey % 20)::VARCHAR AS body, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT body, name, year, p::INTEGER AS page, 'https://h/rus/search/docs/dt=' || year || '-&kv=%7C1_' || body || '&va=%D0%A0%D0%95%D0%A8&pagesize=100' || CASE WHEN p > 1 THEN '&page=' || p ELSE '' END AS url
FROM (SELECT body, year, unnest(range(1, (n + 99) // 100 + 1)) AS p FROM l) JOIN (VALUES {_BODIES}) b(body, name) USING (body)""")
def listing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The addresses of all pages of the listings that orders fall in, by the body of their customer's nation and by year."""
    listed = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    body = (151 + F.col("c_nationkey") % 20).cast("int").cast("string")
    n = listed.groupBy(body.alias("body"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    pages = n.select("body", "year", F.explode(F.sequence(F.lit(1), F.ceil(F.col("n") / discover.PAGE_SIZE).cast("int"))).alias("page"))
    url = discover.listing_url("https://h", F.col("body"), F.col("year"), F.col("page"))
    return pages.join(F.broadcast(discover.bodies(spark)), "body").select("body", "name", "year", "page", url.alias("url"))


#: Documents on a page of the listings that ``listing_swept`` reads; the page at which body 160 fails.
_ON_PAGE, _GONE = 10, 3


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(body, adopted_year, document_id, title, page, total): listings made from parts, a third of them listed by two bodies."""
    k = F.col("p_partkey")
    year = (2000 + F.floor(k / 1000)).cast("int")
    title = F.concat(F.when(k % 3 == 0, "О признании утратившим силу решения: ").otherwise("О понижении ставки на "), year.cast("string"), F.lit(" год &laquo;"), F.col("p_name"), F.lit("&raquo;"))
    bodies = F.when(k % 3 == 0, F.array(k % 20, (k + 7) % 20)).otherwise(F.array(k % 20))
    rows = read(spark, sf_dir, "part").select(F.explode(bodies).alias("b"), year.alias("adopted_year"), F.concat(F.lit("D"), k.cast("string")).alias("document_id"), title.alias("title"), k.alias("k"))
    own = W.partitionBy("body", "adopted_year")  # a listing: at most some hundred documents
    rows = rows.select((151 + F.col("b")).cast("int").cast("string").alias("body"), "adopted_year", "document_id", "title", "k")
    return rows.select("*", (1 + F.floor((F.row_number().over(own.orderBy("k")) - 1) / _ON_PAGE)).cast("int").alias("page"), F.count(F.lit(1)).over(own).alias("total")).drop("k")


@query(f"""
WITH b AS (SELECT * FROM (VALUES {_BODIES}) b(body, name)), p AS (SELECT p_partkey AS k, p_name, (2000 + p_partkey // 1000)::INTEGER AS year FROM part),
l AS (SELECT k, p_name, year, (151 + k % 20)::VARCHAR AS body FROM p UNION ALL SELECT k, p_name, year, (151 + (k + 7) % 20)::VARCHAR FROM p WHERE k % 3 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY body, year ORDER BY k) AS place FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY year, body) AS nth FROM n WHERE body <> '160' OR place <= {_ON_PAGE * (_GONE - 1)})
SELECT 'D' || k AS document_id, CASE WHEN k % 3 = 0 THEN 'О признании утратившим силу решения: ' ELSE 'О понижении ставки на ' END || year || ' год «' || p_name || '»' AS title, name AS body, year AS adopted_year,
CASE WHEN k % 3 = 0 THEN 'repeal' WHEN year = (SELECT max(year) FROM p) THEN 'rate-decision' ELSE 'other' END AS kind FROM f JOIN b USING (body) WHERE nth = 1""")
def listing_swept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sweep over the listings of all parts, read from their pages' markup, one body failing at its third page: each document once, in the first listing that had it."""
    rows = _listed(spark, sf_dir)
    link = F.concat(F.lit('<a href="/rus/docs/'), F.col("document_id"), F.lit('" class="x">'), F.col("title"), F.lit("</a>"))
    markup = rows.groupBy("body", "adopted_year", "page").agg(F.concat(F.lit("Найдено: "), F.max("total").cast("string"), F.lit(" документов "), F.array_join(F.sort_array(F.collect_list(link)), " ")).alias("html"))

    def get(asked: DataFrame) -> DataFrame:
        gone = (F.col("body") == "160") & (F.col("page") == _GONE)
        return asked.join(markup, ["body", "adopted_year", "page"], "left").select("body", "adopted_year", "page", "url", F.when(~gone, F.col("html")).alias("html"), F.when(gone, "gone").alias("error"))

    listings = rows.select("body", "adopted_year").distinct().join(F.broadcast(discover.bodies(spark)), "body")
    found, failures = discover.sweep(listings, get, "https://h")
    wrong = rows.where(f"body = '160' and page = {_GONE}").select("body", "adopted_year").distinct().exceptAll(failures.where("reason = 'gone'").select("body", "adopted_year"))
    constraints.require(wrong, "listings that failed and are not in the ledger")
    return found


@query("""
SELECT p_partkey, CASE s WHEN 0 THEN 'repeal' WHEN 1 THEN 'rate-decision' WHEN 2 THEN 'other' ELSE 'rate-decision' END AS class, s = 1 AS wanted FROM (SELECT p_partkey, p_partkey % 4 AS s FROM part)""")
def titles_classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = ("О признании утратившим силу решения о понижении ставки на 2026 год", "О понижении размера СТАВКИ на 2026 год", "О понижении ставки на 2025 год", "О внесении изменений: понижение, понижении ставки 2026")
    title = F.get(F.array(*[F.lit(t) for t in titles]), (F.col("p_partkey") % 4).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", discover.title_class(title, 2026).alias("class"), discover.is_rate_decision(title, 2026).alias("wanted"))


_REASONS = ["document is amended or repealed: 'Утратило силу'", report.NO_SENTENCE, "regime objected: x; word objected: y", "kazakh returned HTTP 404 — an answer", "word objected: y; regime objected: x", report.NO_SENTENCE + ".", "readers disagree: 2, 3"]


@query("""
WITH q AS (SELECT CASE s_suppkey % 7 WHEN 0 THEN 'repealed' WHEN 1 THEN 'no-sentence' WHEN 2 THEN 'other-regime' WHEN 3 THEN 'no-kazakh-text' ELSE 'other' END AS category, s_suppkey AS pos FROM supplier
  UNION ALL SELECT 'unmapped-' || (c_custkey % 3), c_custkey + (1::BIGINT << 40) FROM customer WHERE c_custkey % 3 > 0)
SELECT category, count(*) AS n, min(pos) AS first, CASE category WHEN 'repealed' THEN 'Решение утратило силу или было изменено' WHEN 'no-sentence' THEN 'Ни одно предложение решения не понижает ставку' WHEN 'other' THEN 'Иная причина, не входящая в основные категории выше'
  WHEN 'other-regime' THEN 'Решение регулирует другой специальный налоговый режим (например, розничный налог), а не упрощёнку'
  WHEN 'no-kazakh-text' THEN 'Текст решения на казахском языке не опубликован, поэтому ставку не удалось подтвердить двумя независимыми источниками' ELSE category END AS label FROM q GROUP BY 1""")
def refusals_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    reason = F.get(F.array(*[F.lit(r) for r in _REASONS]), (k % 7).cast("int"))
    queue = read(spark, sf_dir, "supplier").select(k.cast("string").alias("document_id"), reason.alias("reason"), k.alias("pos"))
    c = F.col("c_custkey")
    mapped = read(spark, sf_dir, "customer").select(c.cast("string").alias("document_id"), F.when(c % 3 == 0, "mapped").otherwise(F.concat(F.lit("unmapped-"), (c % 3).cast("string"))).alias("outcome"), F.lit(None).cast("array<string>").alias("candidates"), c.alias("pos"))
    return report.grouped(report.refused(queue, mapped), "category", "pos").select("category", "n", "first", report.refusal_label(F.col("category")).alias("label"))


@query("""
WITH d AS (SELECT lpad(n_nationkey::VARCHAR, 9, '0') AS code, 'name ' || (n_nationkey % 20) AS name, n_nationkey AS pos FROM nation), last AS (SELECT name, max(code) AS code FROM d GROUP BY 1),
t AS (SELECT code, string_agg(c, ',' ORDER BY c) AS told FROM (SELECT DISTINCT last.code, c_custkey::VARCHAR AS c FROM customer JOIN last ON name = 'name ' || (c_custkey % 23) WHERE c_custkey % 10 = 1) GROUP BY 1)
SELECT code, name, coalesce(told, '') AS told FROM d LEFT JOIN t USING (code) WHERE pos % 3 > 0""")
def absences(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("n_nationkey"), F.col("c_custkey")
    code = F.lpad(k.cast("string"), 9, "0")
    districts = read(spark, sf_dir, "nation").select(code.alias("code"), F.concat(F.lit("name "), (k % 20).cast("string")).alias("name"), k.alias("pos"))
    refused = read(spark, sf_dir, "customer").where(c % 10 == 1).select(c.cast("string").alias("document_id"), F.lit("x").alias("category"), F.array(F.concat(F.lit("name "), (c % 23).cast("string"))).alias("candidates"))
    out = report.absent(districts, districts.where("pos % 3 = 0").select(F.col("code").alias("kato")), refused)
    return out.select("code", "name", F.array_join(F.transform("attribution", lambda a: a["document_id"]), ",").alias("told"))


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rates table of one line per supplier, over two years."""
    k = F.col("s_suppkey")
    text = lambda head: F.concat(F.lit(head), k.cast("string"))
    year = (2026 + k % 2).cast("string")
    return read(spark, sf_dir, "supplier").select(
        F.lpad((k * 7 % 25 * 10_000_000 + k).cast("string"), 9, "0").alias("kato"), F.lit("edition-1").alias("kato_version"), text("имя ").alias("name_ru"), text("аты ").alias("name_kk"), F.format_string("%.2f", (k % 3 + 2) / 100).alias("rate"), F.lit("0.04").alias("base_rate"),
        F.concat(year, F.lit("-01-01")).alias("valid_from"), F.concat(year, F.lit("-12-31")).alias("valid_to"), text("Решение № ").alias("decision_ref"), text("https://adilet.zan.kz/rus/docs/D").alias("source_url"), text("https://adilet.zan.kz/kaz/docs/D").alias("kazakh_source_url"),
        F.when(k % 5 == 0, "by hand").otherwise(" deterministic-readers ").alias("extraction_method"), k.alias("line"),
    )


def _oblasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.concat(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("0000000")).alias("code"), F.col("n_name").alias("name"))


_RATES = "SELECT s_suppkey, lpad((s_suppkey * 7 % 25 * 10000000 + s_suppkey)::VARCHAR, 9, '0') AS kato, (2026 + s_suppkey % 2)::VARCHAR AS year, s_suppkey % 3 + 2 AS percent, s_suppkey % 5 > 0 AS machine FROM supplier"


@query(f"""
WITH r AS ({_RATES}), o AS (SELECT r.*, coalesce(n_name, '') AS oblast FROM r LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON n_nationkey = kato[1:2]::INT)
SELECT year, 0.04::DOUBLE AS base_rate, count(*) AS districts, 200 AS expected, false AS complete, sum(machine::INT)::BIGINT AS machine_extracted, md5(string_agg(kato || ':' || oblast || ':' || percent, ',' ORDER BY kato)) AS entries FROM o GROUP BY 1""")
def report_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = report.by_year(_published(spark, sf_dir), _oblasts(spark, sf_dir))
    entries = F.array_join(F.transform("rates", lambda r: F.concat_ws(":", r["kato"], r["oblast"], F.round(r["rate"] * 100).cast("int").cast("string"))), ",")
    return years.select("year", "base_rate", "districts", "expected", "complete", "machine_extracted", F.md5(entries).alias("entries"))


@query(f"""
WITH r AS ({_RATES}), n AS (SELECT count(*) AS n, sum(machine::INT) AS m, count(DISTINCT kato) AS d, sum((year = '2026')::INT) AS y FROM r)
SELECT '2026-01-02T03:04:05Z' AS generated_at, y::BIGINT AS districts_2026, d AS districts, CASE WHEN m < n THEN 'some' ELSE 'all' END AS about, '{report.TITLE}, 2026 · 2027 · КАТО' AS title, '2026, 2027' AS description, 5::BIGINT AS files FROM n""")
def report_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested report, and what is derived from it."""
    rates = _published(spark, sf_dir)
    years = report.by_year(rates, _oblasts(spark, sf_dir))
    names = ["2026", "2027"]
    about = report.provenance(F.col("rows"), F.col("machine_extracted"))
    body = report.payload(years, report.stamp(1767323045)).select(F.get_json_object("json", "$.generated_at").alias("generated_at"), F.get_json_object("json", "$.years.2026.districts").cast("long").alias("districts_2026"))
    told = report.verification(rates).select(F.when(about == report.ABOUT_SOME, "some").when(about == report.ABOUT_ALL, "all").alias("about"), F.lit(report.title(names)).alias("title"), F.lit(report.description(names)).alias("description"), F.lit(len(report.artefacts(names, "u"))).cast("long").alias("files"))
    return body.crossJoin(report.districts_counted(years)).crossJoin(told)


@query(f"""
WITH r AS ({_RATES}), s AS (SELECT s_suppkey AS line, s_suppkey % 11 AS s FROM r)
SELECT line, unnest(CASE s WHEN 1 THEN ['kato-format', 'unknown-code'] WHEN 2 THEN ['decision_ref-empty'] WHEN 3 THEN ['decision_ref-null-like'] WHEN 4 THEN ['decision_ref-no-citation'] WHEN 5 THEN ['source_url-host'] WHEN 6 THEN ['kazakh_source_url-null-like'] WHEN 7 THEN ['rate-percentage']
  WHEN 8 THEN ['rate-not-a-number'] WHEN 9 THEN ['reversed'] WHEN 10 THEN ['unknown-code'] ELSE [] END) AS rule FROM s""")
def rates_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of a rates file: rows, references through replaced codes, intervals."""
    s = F.col("line") % 11
    bad = {"kato": {1: F.concat(F.lit("1 "), F.col("line").cast("string"))}, "decision_ref": {2: " ", 3: "NaN", 4: "постановление"}, "source_url": {5: "https://other/rus"}, "kazakh_source_url": {6: " None "}, "rate": {7: "3", 8: "x"}, "valid_to": {9: "2001-01-01"}}
    rates = _published(spark, sf_dir)
    codes = rates.where(~s.isin(0, 1, 10)).select("kato")
    edges = rates.where(s == 0).select(F.col("kato").alias("retired"), F.concat(F.lit("new "), F.col("kato")).alias("current"))
    codes = codes.union(edges.select(F.col("current")))
    spoiled = [F.coalesce(*[F.when(s == k, v) for k, v in bad.get(c, {}).items()], F.col(c)).alias(c) if c in bad else F.col(c) for c in rates.columns]
    return constraints.validate(rates.select(*spoiled), codes, edges).select("line", "rule")


@query("SELECT p_partkey::VARCHAR AS code, CASE WHEN p_partkey > 0 THEN '1' END AS resolved, greatest(p_partkey - 1, 0)::INTEGER AS hops, CASE WHEN p_partkey > 0 THEN 'current' ELSE 'unknown' END AS status FROM part")
def chain_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chain through all codes."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select("p_partkey")
    edges = p.where(k > 1).select(k.cast("string").alias("retired"), (k - 1).cast("string").alias("current"))
    return temporal.resolve(p.select(k.cast("string").alias("code")), p.where(k == 1).select(k.cast("string").alias("code")), edges)


@query("SELECT count(*) AS migrations, false AS complete FROM part WHERE p_partkey > 1")
def migrations_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.migration_coverage(read(spark, sf_dir, "part").where("p_partkey > 1"))


@query("""
SELECT doc_id, sha256(array_to_string(list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '')[1:12], ' ')) AS head,
  sha256(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS escaped, sha256(replace('</script>' || text, '</', '<\\/')) AS script,
  md5(text) AS digest, sha256(text) AS sha, lang || '/a%20b%26c/' || source AS quoted FROM documents""")
def scalar_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    quoted = T.url_quoted(F.concat_ws("/", "lang", F.lit("a b&c"), "source"))
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(T.head_words(t), 256).alias("head"), F.sha2(T.escaped(t), 256).alias("escaped"), F.sha2(T.script_safe(F.concat(F.lit("</script>"), t)), 256).alias("script"), F.md5(t).alias("digest"), F.sha2(t, 256).alias("sha"), quoted.alias("quoted"))


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN true ELSE false END AS whole, CASE c_custkey % 3 WHEN 2 THEN 'на Абай' ELSE 'Аксу Абай' END AS stripped, CASE c_custkey % 3 WHEN 1 THEN '«А» & Б' ELSE 'x' END AS unescaped FROM customer""")
def names_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("c_custkey") % 3
    text = F.when(s == 0, "ставка, Аксу; город").when(s == 1, "ставка Аксуская").otherwise("Аксу-Аюлы")
    stripped = T.squeeze(resolve.without_oblast_phrase(F.when(s == 2, "на Мақаншы области Абай").otherwise("Аксу Степной области и области Абай")))
    html = F.when(s == 1, "&laquo;А&raquo; &amp; &#1041;").otherwise("x")
    return read(spark, sf_dir, "customer").select("c_custkey", T.has_word(text, F.lit("аксу")).alias("whole"), stripped.alias("stripped"), T.unescape_all(html).alias("unescaped"))


@query("""
SELECT doc_id::VARCHAR AS document_id FROM labels WHERE quality = 1 UNION SELECT doc_id::VARCHAR FROM documents WHERE n_chars % 5 = 0""")
def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda df: df.select(F.col("doc_id").cast("string").alias("document_id"))
    return gate.population(one(read(spark, sf_dir, "labels").where("quality = 1")), one(read(spark, sf_dir, "documents").where("n_chars % 5 = 0")))


@query("SELECT doc_id, quality, toxic FROM labels")
def batches_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict batches united; that two batches which share an id are refused is shown on the way."""
    l = read(spark, sf_dir, "labels")
    refused = False
    try:
        gate.merge_batches([l, l], "doc_id")
    except constraints.ConstraintError:
        refused = True
    out = gate.merge_batches([l.where(F.col("doc_id") % 3 == i) for i in range(3)], "doc_id")
    return out.where(F.lit(refused))


@query("""
SELECT 'same' AS "case", false AS refused UNION ALL SELECT 'fewer', true UNION ALL SELECT 'fewer, allowed', false UNION ALL SELECT 'nothing before', false""")
def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a new table that covers less is refused."""
    l = read(spark, sf_dir, "labels")
    cases = {"same": (l, l, False), "fewer": (l, l.where("quality = 1"), False), "fewer, allowed": (l, l.where("quality = 1"), True), "nothing before": (l.limit(0), l, False)}
    rows = []
    for name, (old, new, allow) in cases.items():
        try:
            constraints.require_no_shrink(old, new, "doc_id", allow)
            rows.append((name, False))
        except constraints.ConstraintError:
            rows.append((name, True))
    return spark.createDataFrame(rows, "case string, refused boolean")


@query("""
SELECT 'confirmed' AS kind, doc_id::VARCHAR AS id, quality::DOUBLE AS value FROM labels WHERE toxic = 0 UNION ALL SELECT DISTINCT 'queued', lang, NULL::DOUBLE FROM documents UNION ALL
SELECT DISTINCT 'published', 'D' || s_suppkey, NULL FROM supplier UNION ALL SELECT 'oblast', lpad(n_nationkey::VARCHAR, 2, '0') || n_name, NULL FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 'code', 'x' || p_size, NULL FROM part GROUP BY p_size""")
def loaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sources hand on: confirmed rates, queue ids, published ids, names by prefix, trimmed codes."""
    none = F.lit(None).cast("double")
    l = read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("document_id"), F.when(F.col("toxic") == 0, "confirmed").otherwise("conflict").alias("outcome"), F.col("quality").alias("rate"))
    queue = read(spark, sf_dir, "documents").select(F.concat(F.lit(" "), "lang").alias("document_id")).union(spark.createDataFrame([("  ",)], "document_id string"))
    o = _oblasts(spark, sf_dir).select(F.col("code").alias("kato"), F.lit("oblast").alias("level"), F.concat(F.lit(" "), "name", F.lit(" ")).alias("name_ru"), F.col("name").alias("name_kk"))
    parts = [
        tables.parser_rates(l).select(F.lit("confirmed").alias("kind"), F.col("document_id").alias("id"), F.col("rate").alias("value")),
        tables.queue_ids(queue).select(F.lit("queued"), "document_id", none),
        tables.published_ids(_published(spark, sf_dir)).select(F.lit("published"), "document_id", none),
        tables.oblast_names(o).select(F.lit("oblast"), F.concat("prefix", "ru"), none),
        tables.code_set(read(spark, sf_dir, "part").select(F.concat(F.lit(" x"), F.col("p_size").cast("string"), F.lit(" ")).alias("kato"))).select(F.lit("code"), "code", none),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


_OF = _SEARCH.format(expansion=_EXACT.format(terms=_terms("the", "of")))


@query(_OF + "SELECT doc, round(score, 6) AS score, terms FROM a")
def search_punctuated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query is cut as texts are: any punctuation and space separates."""
    return _rounded(search.search(_titles(spark, sf_dir), "«The», of!—"))


@query(_OF + ", w AS (SELECT doc, sum(s * (2 - q)) * count(*) AS score, count(*)::INTEGER AS terms FROM s GROUP BY 1) SELECT doc, round(score, 6) AS score, terms FROM w")
def search_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A term that is asked twice scores twice, and is one distinct term."""
    return _rounded(search.search(_titles(spark, sf_dir), "the the of"))


@query(_OF + "SELECT doc, round(score, 6) AS score, terms FROM a ORDER BY a.score DESC, doc LIMIT 10")
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(search.ranked(search.search(_titles(spark, sf_dir), "the of"), 10))


@query(_OF + "SELECT doc, round(score * (doc % 3), 6) AS score, terms FROM a WHERE doc % 3 > 0")
def search_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents boosted by a factor; 0 drops them."""
    index = _titles(spark, sf_dir)
    return _rounded(search.search(index, "the of", boost_documents=index.documents.select("doc", (F.col("doc") % 3).alias("boost"))))


@query(_OF + "SELECT doc, round(score, 6) AS score, terms FROM a JOIN pages ON page_id = doc WHERE contains(url, '/en/')")
def search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition on what is stored beside the documents."""
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc"), F.replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("&amp;"), F.lit("&")).alias("title"), "url")
    return _rounded(search.search(search.Index.build(pages, "doc", ["title"], ["url"]), "the of", where=F.col("url").contains("/en/")))


@query(_SEARCH.format(expansion=_EXACT.format(terms=_terms("the"))).replace(_TITLES, _TITLES + " WHERE page_id % 4 > 0") + "SELECT (SELECT count(*) FROM d) AS documents, (SELECT count(DISTINCT term) FROM p) AS terms, true AS purged, false AS found")
def index_discarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discarded documents are out of results and counts at once, and purged when there are enough of them."""
    whole = _titles(spark, sf_dir)
    index = whole.discard(whole.documents.where("doc % 4 = 0"))
    gone = whole.documents.where("doc % 4 = 0").agg(F.min("doc")).first()[0]
    purged = index.vacuum(least=1, share=0.01).gone is None and index.vacuum(least=10**9) is index
    return index.counts().withColumn("purged", F.lit(purged)).withColumn("found", F.lit(gone is not None and index.has(gone)))


@query("SELECT page_id::VARCHAR AS document_id, CASE WHEN page_id % 5 = 0 THEN 'new' WHEN page_id % 5 = 1 THEN 'gone' ELSE 'changed' END AS change FROM pages WHERE page_id % 5 < 3")
def listing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, changed and vanished documents between two listings, of which the new one holds its canary."""
    from ..streaming import watch

    k = F.col("page_id")
    one = lambda keep, title: read(spark, sf_dir, "pages").where(keep).select(k.cast("string").alias("document_id"), title.alias("title"))
    canary = spark.createDataFrame([("canary", "x")], "document_id string, title string")
    return watch.checked(one(k % 5 != 0, F.col("url")).union(canary), one(k % 5 != 1, F.when(k % 5 == 2, "other").otherwise(F.col("url"))).union(canary), "canary")


@query(None)
def published_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, bytes) of the data package's resources and the listed files of a report."""
    rates = _published(spark, sf_dir)
    package = json.loads(report.datapackage("rates", {"rates": rates.select(*report.FIELDS)}))
    rows = [(r["path"], len(r["schema"]["fields"])) for r in package["resources"]] + [(a["name"], 0) for a in report.artefacts(["2026", "2027"], "u")]
    return spark.createDataFrame(rows, "name string, fields int")
