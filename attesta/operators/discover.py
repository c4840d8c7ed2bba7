"""Discovery: title classes, frontier search, paging, comparison of two indexes, systematic samples."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .storage import cut

# Fixed values.
WANTED, UNWANTED, REPEALED = ("понижени", "ставки"), ("утративш", "утратил", "внесении изменени"), ("утративш", "утратил")
DRY_ROUNDS, PAGE_SIZE, MOST_PAGES = 2, 100, 30
LINK = r'/rus/docs/([A-Z0-9]+)"[^>]*>\s*([^<]{20,300})'
TOTAL = r"Найдено:\s*([\d ]+)\s*документ"
FORM = "РЕШ"
BODIES = {
    "151": "город Астана", "152": "Акмолинская область", "153": "Актюбинская область", "154": "Алматинская область", "155": "г. Алматы",
    "156": "Атырауская область", "157": "Восточно-Казахстанская область", "158": "Жамбылская область", "159": "Западно-Казахстанская область",
    "160": "Карагандинская область", "161": "Кызылординская область", "162": "Костанайская область", "163": "Мангистауская область",
    "164": "Павлодарская область", "165": "Северо-Казахстанская область", "166": "Туркестанская область", "167": "г. Шымкент",
    "168": "область Абай", "169": "область Ұлытау", "170": "область Жетісу",
}


def any_of(text: Column, words: Iterable[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def all_of(text: Column, words: Iterable[str]) -> Column:
    out = F.lit(True)
    for w in words:
        out = out & text.contains(w)
    return out


def is_rate_decision(title: Column, year: int, wanted=WANTED, unwanted=UNWANTED) -> Column:
    low = F.lower(title)
    return ~any_of(low, unwanted) & all_of(low, wanted) & title.contains(str(year))


def title_class(title: Column, year: int, wanted=WANTED, repealed=REPEALED) -> Column:
    """An ordered case: a repeal first."""
    low = F.lower(title)
    return F.when(any_of(low, repealed), "repeal").when(all_of(low, wanted) & title.contains(str(year)), "rate-decision").otherwise("other")


def raw_links(html: Column, pattern: str = LINK) -> Column:
    """Array of (document_id, title): hrefs and their texts as they stand."""
    return F.arrays_zip(T.all_found(html, pattern, 1).alias("document_id"), T.all_found(html, pattern, 2).alias("title"))


def plain_title(raw: Column) -> Column:
    return T.squeeze(T.unescape_all(T.without_tags(raw)))


def links(pages: DataFrame, key: str, html: str, pattern: str = LINK) -> DataFrame:
    """(key, document_id, title): hrefs and their unescaped texts."""
    return pages.select(key, F.explode(raw_links(F.col(html), pattern)).alias("p")).select(key, "p.document_id", plain_title(F.col("p")["title"]).alias("title"))


def total_stated(html: Column) -> Column:
    text = T.squeeze(T.unescape_all(T.without_tags(html)))
    return F.coalesce(F.regexp_replace(T.found(text, TOTAL, 1), " ", "").try_cast("int"), F.lit(0))


def listing_url(base: Column | str, body: Column, year: Column, page: Column) -> Column:
    """The page number is left out on the first page."""
    base = F.lit(base) if isinstance(base, str) else base
    further = F.when(page > 1, F.concat(F.lit("&page="), page.cast("string"))).otherwise("")
    return F.concat(base, F.lit("/rus/search/docs/dt="), year.cast("string"), F.lit(f"-&kv={quote('|')}1_"), body, F.lit(f"&va={quote(FORM)}&pagesize={PAGE_SIZE}"), further)


def search_url(base: str, phrase: str) -> str:
    return f"{base}/rus/search/docs/{quote(phrase)}"


def bodies(spark: SparkSession) -> DataFrame:
    """(body, name): the issuing bodies of the listing's facet."""
    return spark.createDataFrame(sorted(BODIES.items()), "body string, name string")


def frontier(catalogue: Callable[[str], DataFrame], seeds: list[str], accept: Callable[[Column], Column], dry_rounds: int = DRY_ROUNDS, words: int = 12) -> dict[str, str]:
    """Breadth-first phrase search (id -> title): each new accepted title gives a further phrase; ends with the queue, or after
    dry rounds. ``catalogue`` answers a phrase with (document_id, title); a page, hence few rows."""
    queue, seen, found, dry = list(seeds), set(), {}, 0
    while queue and dry < dry_rounds:
        phrase = queue.pop(0)
        if phrase in seen:
            continue
        seen.add(phrase)
        rows = catalogue(phrase).where(accept(F.col("title"))).orderBy("document_id").limit(PAGE_SIZE).collect()
        new = [r for r in rows if r.document_id not in found]
        dry = 0 if new else dry + 1
        for r in new:
            found[r.document_id] = r.title
            queue.append(" ".join(r.title.split()[:words]))
    return found


LISTING = ["body", "adopted_year"]


def fetched_by(get: Callable[[str], str], parts: int = 8) -> Callable[[DataFrame], DataFrame]:
    """Makes a function url -> html, which may raise OSError, into one of frames, as ``pages_of`` and ``sweep`` take it: run in ``parts`` tasks, so that a
    throttle made inside ``get`` is one for each of them."""

    def run(batches):
        for batch in batches:
            rows = []
            for asked in batch.to_pylist():
                try:
                    rows.append({**asked, "html": get(asked["url"]), "error": None})
                except OSError as e:
                    rows.append({**asked, "html": None, "error": str(e) or type(e).__name__})
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    SCHEMA = pa.schema([("body", pa.string()), ("adopted_year", pa.int32()), ("page", pa.int32()), ("url", pa.string()), ("html", pa.string()), ("error", pa.string())])
    return lambda asked: asked.repartition(parts, "url").mapInArrow(run, "body string, adopted_year int, page int, url string, html string, error string")


def _standing(pages: DataFrame, most: int) -> DataFrame:
    """(body, adopted_year, stop, held, got, total, reason): for each listing the page at which reading it page by page would end, if that was fetched, how
    many documents the pages up to there hold, how many the first page, the total last stated and why it failed, if it did."""
    documents = pages.select(*LISTING, "page", F.explode("rows").alias("r")).groupBy(*LISTING, "r.document_id").agg(F.min("page").alias("page"))
    new = documents.groupBy(*LISTING, "page").agg(F.count(F.lit(1)).alias("new"))
    own = W.partitionBy(*LISTING).orderBy("page")  # at most ``most`` rows
    told = pages.select(*LISTING, "page", "total", "error").join(new, [*LISTING, "page"], "left").withColumn("new", F.coalesce("new", F.lit(0)))
    told = told.withColumn("held", F.sum("new").over(own))
    ends = F.col("error").isNotNull() | (F.col("new") == 0) | (F.col("held") >= F.col("total")) | (F.col("page") >= most)
    whole = told.groupBy(*LISTING).agg(
        F.min(F.when(ends, F.col("page"))).alias("stop"), F.max("page").alias("last"), F.max("held").alias("held"), F.max_by("total", "page").alias("total"), F.max(F.when(F.col("page") == 1, F.col("new"))).alias("got"), F.collect_list(F.when(F.col("error").isNotNull(), F.struct("page", "error"))).alias("errors")
    )
    failed = F.filter("errors", lambda e: e["page"] == F.col("stop"))
    return whole.select(*LISTING, "stop", "last", "held", "total", "got", F.get(failed, F.lit(0))["error"].alias("reason"))


def pages_of(listings: DataFrame, get: Callable[[DataFrame], DataFrame], base: str = "", most: int = MOST_PAGES) -> tuple[DataFrame, DataFrame]:
    """Reads listings (body, adopted_year) to their ends: (body, adopted_year, page, place, document_id, title), and the ledger (body, adopted_year, reason) of those
    that failed part way. ``get`` takes (body, adopted_year, page, url) and gives these with (html, error).

    A listing ends with a page that fails (what came before is kept), adds nothing, or brings as many documents as are stated, or is the last allowed one. All first
    pages are fetched in one job, then of all open listings as many pages as the stated total asks for, judged by what the first page held: two or three jobs, not one request
    after another. Pages are stored as they come and never fetched again; those beyond a listing's end are not used. A page without html and without an error failed too."""
    left, held = listings.select(*LISTING).distinct().select("*", F.lit(1).alias("first"), F.lit(1).alias("until")), None
    while True:
        asked = left.select(*LISTING, F.explode(F.sequence("first", "until")).alias("page"))
        answers = get(asked.select("*", listing_url(base, F.col("body"), F.col("adopted_year"), F.col("page")).alias("url")))
        answers = asked.join(answers.select(*LISTING, "page", "html", "error"), [*LISTING, "page"], "left")
        html, error = F.coalesce("html", F.lit("")), F.coalesce("error", F.when(F.col("html").isNull(), "no answer"))
        came = cut(answers.select(*LISTING, "page", error.alias("error"), raw_links(html).alias("rows"), total_stated(html).alias("total")))
        held = came if held is None else held.unionByName(came)
        standing = cut(_standing(held, most))
        open_ = standing.where("stop is null")
        further = F.ceil((F.col("total") - F.col("held")) / F.col("got")).cast("int")
        left = open_.select(*LISTING, (F.col("last") + 1).alias("first"), F.least(F.col("last") + F.greatest(further, F.lit(1)), F.lit(most)).alias("until"))
        if not open_.limit(1).count():
            break
    used = held.join(standing.select(*LISTING, "stop"), LISTING).where((F.col("page") <= F.col("stop")) & F.col("error").isNull())
    found = used.select(*LISTING, "page", F.posexplode("rows").alias("place", "r")).select(*LISTING, "page", "place", "r.document_id", plain_title(F.col("r")["title"]).alias("title"))
    return found, standing.where("reason is not null").select(*LISTING, "reason")


def sweep(listings: DataFrame, get: Callable[[DataFrame], DataFrame], base: str = "", most: int = MOST_PAGES) -> tuple[DataFrame, DataFrame]:
    """listings: (body, name, adopted_year), read by ``pages_of``. Gives (document_id, title, body, adopted_year, kind), ``body`` being the name, each document in the first
    listing by year and body that had it, with the title that this listing gave last; and the ledger (body, adopted_year, reason): no failure is taken for an
    empty listing."""
    found, failures = pages_of(listings, get, base, most)
    one = found.groupBy(*LISTING, "document_id").agg(F.max_by("title", F.struct("page", "place")).alias("title"))
    kept = one.groupBy("document_id").agg(F.min_by(F.struct(*LISTING, "title"), F.struct("adopted_year", "body")).alias("r")).select("document_id", "r.*")
    last = listings.agg(F.max("adopted_year")).first()[0]
    named = kept.join(listings.select(*LISTING, "name").distinct(), LISTING)
    kind = title_class(F.col("title"), last) if last is not None else F.lit(None).cast("string")
    return named.select("document_id", "title", F.col("name").alias("body"), "adopted_year", kind.alias("kind")), failures


def first_wins(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in order."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def compare_indexes(a: DataFrame, b: DataFrame, key: str = "document_id") -> DataFrame:
    """(side, n): how many ids are in both, or in one only."""
    both = a.select(key).distinct().withColumn("__a", F.lit(1)).join(b.select(key).distinct().withColumn("__b", F.lit(1)), key, "full_outer")
    side = F.when(F.col("__a").isNull(), "only_b").when(F.col("__b").isNull(), "only_a").otherwise("both")
    return both.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b).withColumn("side", F.lit("only_a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_b")))


def systematic_sample(rows: DataFrame, key: str, size: int = 40) -> DataFrame:
    """Every n-th row in order of key, ``size`` at most: reproducible, not random. Ranks are counted over ranges, not in one task."""
    spark = rows.sparkSession
    n = rows.count()
    step = max(1, n // size)
    parts = rows.repartitionByRange(key).select(key, F.spark_partition_id().alias("__part"))
    counts = parts.groupBy("__part").count()
    offset = counts.select("__part", (F.sum("count").over(W.orderBy("__part")) - F.col("count")).alias("__before"))
    ranked = parts.join(F.broadcast(offset), "__part").select(key, (F.col("__before") + F.row_number().over(W.partitionBy("__part").orderBy(key)) - 1).alias("__rank"))
    picked = ranked.where((F.col("__rank") % step == 0) & (F.col("__rank") < step * size)).select(key)
    return rows.join(F.broadcast(picked), key, "left_semi") if n else spark.createDataFrame([], rows.schema)


def candidates_by_roots(docs: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """(key, codes): names that share a root with a title; candidates only, never a mapping."""
    left = docs.select(key, F.explode(T.roots(F.col(text))).alias("root"))
    right = names.select("code", F.explode(T.roots(F.col("name"))).alias("root"))
    return left.join(right, "root").groupBy(key).agg(F.sort_array(F.collect_set("code")).alias("codes"))


def coverage(documents: DataFrame, candidates: DataFrame, districts: DataFrame, key: str = "document_id") -> DataFrame:
    """One row of counters. ``districts_less_documents`` subtracts documents from districts, as published; beside it the count of districts
    that no document names."""
    size = F.size("codes")
    counted = documents.select(key).join(candidates, key, "left").agg(
        F.count(F.lit(1)).alias("documents"), F.count("codes").alias("with_candidates"), F.count_if(size == 1).alias("with_one"), F.count_if(size > 1).alias("with_several"), F.count_if(F.col("codes").isNull()).alias("with_none")
    )
    named = candidates.select(F.explode("codes").alias("code")).distinct()
    d = districts.agg(F.count(F.lit(1)).alias("districts"), F.count_distinct("name").alias("district_names"))
    missing = districts.join(named, "code", "left_anti").agg(F.count(F.lit(1)).alias("districts_not_named"))
    return counted.crossJoin(d).crossJoin(missing).withColumn("districts_less_documents", F.col("districts") - F.col("with_candidates"))
