"""Publishing and reporting: required-field projections, nested reports by year, refusals, absences, artefacts."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .constraints import NULL_LIKE, ConstraintError, require

FIELDS = ("kato", "kato_version", "name_ru", "name_kk", "rate", "base_rate", "valid_from", "valid_to", "decision_ref", "source_url", "kazakh_source_url", "extraction_method")
# Refusal categories, by how a reason starts, and the one that is a whole sentence; their labels; null-like methods.
REFUSALS = (("document is amended or repealed:", "repealed"), ("regime objected:", "other-regime"), ("kazakh returned HTTP 404", "no-kazakh-text"))
NO_SENTENCE = "no single sentence lowers a rate — none matched, or several did"
LABELS = {
    "no-sentence": "Ни одно предложение решения не понижает ставку",
    "other-regime": "Решение регулирует другой специальный налоговый режим (например, розничный налог), а не упрощёнку",
    "repealed": "Решение утратило силу или было изменено",
    "no-kazakh-text": "Текст решения на казахском языке не опубликован, поэтому ставку не удалось подтвердить двумя независимыми источниками",
    "unmapped-no-district-matched": "Ставка в решении подтверждена, но район или город, к которому оно относится, определить не удалось",
    "unmapped-jurisdiction-type-not-stated": "Ставка в решении подтверждена, но неясно, к какой из двух одноимённых территорий оно относится",
    "other": "Иная причина, не входящая в основные категории выше",
}
ABOUT_ALL = "Ставки извлечены из решений маслихатов программой, по одному и тому же правилу. Прежде чем полагаться на ставку, откройте решение по ссылке рядом с ней."
ABOUT_SOME = "Часть ставок получена методом, который здесь не описан. Смотрите extraction_method в data/rates.csv для каждой строки."
TITLE = "Ставка налога по упрощённой декларации (упрощёнка) по районам Казахстана"


def missing_citation(value: Column) -> Column:
    return T.is_blank(value) | F.lower(T.strip(value)).isin(*NULL_LIKE)


def publish(mapped: DataFrame, names: DataFrame, urls: DataFrame, edition: str, method: str, base_rates: dict[int, int]) -> DataFrame:
    """The published table from mapped documents; a missing citation, name or base rate stops all of it, before any write."""
    rows = (
        mapped.where("outcome = 'mapped'")
        .join(names.select(F.col("code").alias("kato"), F.col("name_ru").alias("__ru"), F.col("name_kk").alias("__kk")), "kato", "left")
        .join(urls.select("document_id", "kazakh_source_url"), "document_id", "left")
    )
    base = T.lookup(base_rates)[F.col("year").cast("int")]
    rows = rows.select(
        "kato", F.lit(edition).alias("kato_version"), F.coalesce("name_ru", "__ru").alias("name_ru"), F.coalesce("name_kk", "__kk").alias("name_kk"),
        F.format_string("%.2f", F.col("rate").cast("double")).alias("rate"), F.format_string("%.2f", base / 100).alias("base_rate"), base.isNull().alias("__no_base"),
        F.concat(F.col("year").cast("string"), F.lit("-01-01")).alias("valid_from"), F.concat(F.col("year").cast("string"), F.lit("-12-31")).alias("valid_to"),
        "decision_ref", "source_url", "kazakh_source_url", F.lit(method).alias("extraction_method"),
    )
    lacking = F.col("__no_base") | F.col("name_ru").isNull() | F.col("name_kk").isNull()
    for c in ("decision_ref", "source_url", "kazakh_source_url"):
        lacking = lacking | missing_citation(F.col(c))
    require(rows.where(lacking).select("kato", "decision_ref", "source_url", "kazakh_source_url"), "cannot publish")
    return rows.select(*FIELDS).orderBy("kato", "kato_version", "valid_from")


def by_year(rates: DataFrame, oblasts: DataFrame, expected: int = 200) -> DataFrame:
    """(year, base_rate, rates, districts, expected, complete, machine_extracted): base_rate of the first line, rates by code."""
    named = rates.join(F.broadcast(oblasts.select(F.substring("code", 1, 2).alias("__p"), F.col("name").alias("oblast"))), F.substring("kato", 1, 2) == F.col("__p"), "left")
    entry = F.struct("kato", "name_ru", "name_kk", F.coalesce("oblast", F.lit("")).alias("oblast"), T.number(F.col("rate")).alias("rate"), "decision_ref", "source_url")
    return named.groupBy(F.substring("valid_from", 1, 4).alias("year")).agg(
        F.min_by(T.number(F.col("base_rate")), "line").alias("base_rate"), F.sort_array(F.collect_list(entry)).alias("rates"), F.count(F.lit(1)).alias("districts"),
        F.lit(expected).alias("expected"), F.lit(False).alias("complete"), F.count_if(T.strip(F.col("extraction_method")) == "deterministic-readers").alias("machine_extracted"),
    )


def payload(years: DataFrame, stamp: str) -> DataFrame:
    """One row: the nested report as JSON, nulls kept. What a reader downloads, hence small; by ``by_year`` a year's rates are one row."""
    body = F.map_from_entries(F.sort_array(F.collect_list(F.struct("year", F.struct("base_rate", "rates", "districts", "expected", "complete").alias("of")))))
    return years.agg(F.to_json(F.struct(F.lit(stamp).alias("generated_at"), body.alias("years")), {"ignoreNullFields": "false"}).alias("json"))


def refusal_category(reason: Column) -> Column:
    out = F.when(reason == NO_SENTENCE, "no-sentence")
    for start, name in REFUSALS:
        out = out.when(reason.startswith(start), name)
    return out.otherwise("other")


def refusal_label(category: Column) -> Column:
    """The label of a category; one without is its own."""
    return F.coalesce(T.lookup(LABELS)[category], category)


def refused(queue: DataFrame, mapped: DataFrame) -> DataFrame:
    """(document_id, category, candidates, pos) of both refusal sources; none is dropped."""
    none = F.array().cast("array<string>")
    a = queue.select("document_id", refusal_category(F.col("reason")).alias("category"), none.alias("candidates"), "pos")
    b = mapped.where("outcome is not null and outcome <> 'mapped'").select("document_id", F.col("outcome").alias("category"), F.coalesce("candidates", none).alias("candidates"), F.col("pos") + (1 << 40))
    return a.union(b)


def grouped(rows: DataFrame, by: str, pos: str) -> DataFrame:
    """(by, n, first): most first, ties by first appearance."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("first")).orderBy(F.desc("n"), "first")


def absent(districts: DataFrame, rates: DataFrame, refusals: DataFrame) -> DataFrame:
    """Districts without a rate, with the refused documents that named them (an empty list if none did). A name that several codes carry counts for the last."""
    missing = districts.join(rates.select(F.col("kato").alias("code")).distinct(), "code", "left_anti")
    last = districts.groupBy("name").agg(F.max_by("code", "pos").alias("code"))
    told = refusals.select("document_id", "category", F.explode("candidates").alias("name")).join(last, "name").groupBy("code").agg(F.sort_array(F.collect_set(F.struct("document_id", "category"))).alias("attribution"))
    out = missing.join(told, "code", "left")
    return out.select("code", "name", F.coalesce("attribution", F.array().cast("array<struct<document_id:string,category:string>>")).alias("attribution")).orderBy("code")


def verification(rates: DataFrame) -> DataFrame:
    """One row: how many rates there are, and how many a program extracted."""
    return rates.agg(F.count(F.lit(1)).alias("rows"), F.count_if(T.strip(F.col("extraction_method")) == "deterministic-readers").alias("machine_extracted"))


def provenance(rows: Column, machine: Column) -> Column:
    """How the rates got here, counted rather than declared; nothing to say of no rates."""
    return F.when(rows == 0, "").when(machine < rows, ABOUT_SOME).otherwise(ABOUT_ALL)


def districts_counted(years: DataFrame) -> DataFrame:
    """One row: distinct codes over all years, not the sum of the years' counts."""
    return years.select(F.explode("rates").alias("r")).agg(F.count_distinct("r.kato").alias("districts"))


def with_aliases(districts: DataFrame, aliases: DataFrame) -> DataFrame:
    """(code, name, resolves_to) of what can be searched: districts, and places that another one's decision covers. Names may repeat; an
    alias has no rate of its own."""
    own = districts.select("code", "name", F.col("code").alias("resolves_to"))
    return own.unionByName(aliases.select(F.col("kato").alias("code"), F.col("name_ru").alias("name"), "resolves_to"))


def artefacts(years: list[str], base_url: str) -> list[dict[str, str]]:
    files = [("rates.csv", "text/csv"), ("rates.json", "application/json"), ("datapackage.json", "application/json"), *[(f"rates-{y}.json", "application/json") for y in sorted(years)]]
    return [{"name": n, "url": f"{base_url}/{n}", "href": n, "format": f, "title": n.split(".")[0]} for n, f in files]


def page_view(years: list[str], stamp: str) -> dict[str, object]:
    now = stamp[:4]
    ahead = [y for y in sorted(years) if y > now]
    return {"years": sorted(years), "current_year": now, "future_note": ahead if len(years) > 1 else []}


def description(years: list[str]) -> str:
    years = sorted(years)
    return "" if not years else years[0] if len(years) == 1 else f"{years[0]}, {years[-1]}"


def title(years: list[str]) -> str:
    """Built from the years that are there."""
    return TITLE + (", " + " · ".join(sorted(years)) if years else "") + " · КАТО"


def datapackage(name: str, tables: dict[str, DataFrame]) -> str:
    kinds = {"string": "string", "int": "integer", "bigint": "integer", "double": "number", "boolean": "boolean", "date": "date"}
    return json.dumps({"name": name, "profile": "tabular-data-package", "resources": [{"name": t, "path": f"{t}.csv", "schema": {"fields": [{"name": c, "type": kinds.get(k, "any")} for c, k in df.dtypes]}} for t, df in tables.items()]}, ensure_ascii=False, indent=2)


def jsonld(name: str, years: list[str], base_url: str) -> dict[str, object]:
    return {"@context": "https://schema.org", "@type": "Dataset", "name": name, "url": base_url, "temporalCoverage": f"{min(years)}-01-01/{max(years)}-12-31"}


def website(name: str, base_url: str) -> dict[str, object]:
    return {"@context": "https://schema.org", "@type": "WebSite", "name": name, "url": base_url, "inLanguage": ["ru", "kk"]}


def data_uri(content: bytes | None, kind: str = "image/svg+xml") -> str:
    """A file within a page; nothing if there is no file."""
    import base64

    return f"data:{kind};base64,{base64.b64encode(content).decode()}" if content else ""


def head(years: list[str], base_url: str, icon: bytes | None = None) -> str:
    """The head of the index page; all that is inserted is escaped, for text or for a script."""
    safe = lambda value: json.dumps(value, ensure_ascii=False).replace("</", "<\\/")
    parts = [f"<title>{html.escape(title(years))}</title>", f'<meta name="description" content="{html.escape(description(years))}">', f'<link rel="canonical" href="{html.escape(base_url)}/">']
    if icon:
        parts.append(f'<link rel="icon" href="{data_uri(icon)}">')
    parts += [f'<script type="application/ld+json">{safe(x)}</script>' for x in ((jsonld(TITLE, years, base_url),) if years else ()) + (website(TITLE, base_url),)]
    return "\n".join(parts)


def index_page(template: str, payload_json: str, view: dict[str, object], aliases: list[list[str]], base_url: str, vendored: str = "", icon: bytes | None = None) -> str:
    """The lookup page with its data inlined, in one pass over {{DATA}}, {{VIEW}}, {{ALIASES}}, {{SEARCH}} and {{HEAD}}."""
    safe = lambda text: text.replace("</", "<\\/")
    values = {"DATA": safe(payload_json), "VIEW": safe(json.dumps(view, ensure_ascii=False)), "ALIASES": safe(json.dumps(aliases, ensure_ascii=False)), "SEARCH": vendored, "HEAD": head(view["years"], base_url, icon)}
    return rendered(template, values, vendored)


def write_artefacts(spark, payload_json: str, folder: str, base_url: str, template: str, name: str, tables: dict[str, DataFrame], aliases: list[list[str]] = (), vendored: str = "", icon: bytes | None = None) -> list[str]:
    """All published files from one report, which is what a reader downloads: the names written. A year's file is the report with that
    year alone. Everything is made before anything is written."""
    from ..sources.tables import write_text

    body = json.loads(payload_json)
    years = sorted(body["years"])
    listed = artefacts(years, base_url)
    files = {"index.html": index_page(template, payload_json, page_view(years, body["generated_at"]), [list(a) for a in aliases], base_url, vendored, icon)}
    files["llms.txt"] = llms_txt(title(years), description(years), listed)
    files["sitemap.xml"] = sitemap([f"{base_url}/", *[a["url"] for a in listed]])
    files["robots.txt"] = robots(f"{base_url}/sitemap.xml")
    files["datapackage.json"] = datapackage(name, tables)
    files["rates.json"] = json.dumps(body, ensure_ascii=False, indent=2)
    for y in years:
        files[f"rates-{y}.json"] = json.dumps({**body, "years": {y: body["years"][y]}}, ensure_ascii=False, indent=2)
    for file, text in files.items():
        write_text(spark, f"{folder.rstrip('/')}/{file}", text)
    return sorted(files)


def sitemap(urls: list[str]) -> str:
    return '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n' + "".join(f"<url><loc>{html.escape(u)}</loc></url>\n" for u in dict.fromkeys(urls)) + "</urlset>\n"


def robots(sitemap_url: str) -> str:
    return f"User-agent: *\nAllow: /\nSitemap: {sitemap_url}\n"


def llms_txt(title: str, about: str, files: list[dict[str, str]]) -> str:
    return f"# {title}\n\n> {about}\n\n" + "".join(f"- [{f['name']}]({f['url']})\n" for f in files)


def rendered(template: str, values: dict[str, str], vendored: str = "") -> str:
    """One pass over the template, so that inserted text is never searched again; vendored code that could close a script is refused."""
    import re

    if "</" in vendored:
        raise ConstraintError("vendored code could close its script element")
    return re.sub(r"\{\{(\w+)\}\}", lambda m: values[m[1]], template)


def stamp(epoch: int) -> str:
    from datetime import UTC, datetime

    return datetime.fromtimestamp(epoch, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
