"""Queries over what the library keeps between runs: a saved index, state of a stream, publications, ledgers, numbered lines; and over joins by
time. Each works on a whole driver table; folders are new ones below the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import constraints, gate, saved, search, temporal
from ..operators.storage import folder
from ..sources import publish, tables
from ..streaming import state
from .catalogue import _ALL, _EXACT, _SEARCH, _TITLES, _rounded, _terms, _titles, query, read

# DuckDB's distance is of bytes: a letter beyond ASCII, which no asked term has, counts as one.
_NEAR = " UNION ALL SELECT q, term, df, 0.45 * length(term) / (length(term) + levenshtein(regexp_replace(term, '[^\\x00-\\x7F]', '#', 'g'), asked)) FROM v JOIN (VALUES {terms}) a(q, asked) ON levenshtein(regexp_replace(term, '[^\\x00-\\x7F]', '#', 'g'), asked) BETWEEN 1 AND {edits}"


@query(_SEARCH.format(expansion=_EXACT.format(terms=_terms("theronandin", "ouent")) + _NEAR.format(terms=_terms("theronandin", "ouent"), edits=6)) + _ALL)
def fuzzy_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six edits, by segments of the vocabulary."""
    return _rounded(search.search(_titles(spark, sf_dir), "theronandin ouent", fuzzy=6))


_CHANGED = _TITLES.replace("SELECT page_id AS doc, replace(", "SELECT page_id AS doc, CASE WHEN page_id % 5 = 0 THEN 'of the ' ELSE '' END || replace(") + " WHERE page_id % 7 > 0"
_STARTS = " UNION ALL SELECT q, term, df, 0.375 * length(term) / (length(term) + 0.3 * (length(term) - length(asked))) FROM v JOIN (VALUES {terms}) a(q, asked) ON starts_with(term, asked) AND term <> asked"


@query(_SEARCH.replace(_TITLES, _CHANGED).format(expansion=_EXACT.format(terms=_terms("of", "ther")) + _STARTS.format(terms=_terms("of", "ther"))) + _ALL)
def saved_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index saved from some of the titles, to which the others and changed ones are added and from which some are removed, opened again and searched."""
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc"), F.replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("&amp;"), F.lit("&")).alias("title"))
    path = folder(spark, "index")
    index = saved.Saved(spark, path, ["title"], buckets=16).create(search.Index.build(pages.where("doc % 4 > 0"), "doc", ["title"]))
    changed = F.when(F.col("doc") % 5 == 0, F.concat(F.lit("of the "), "title")).otherwise(F.col("title"))
    index.add(pages.where("doc % 4 = 0 OR doc % 5 = 0").select("doc", changed.alias("title")), "doc")
    index.remove(pages.where("doc % 7 = 0").select("doc"))
    return _rounded(saved.Saved(spark, path, ["title"], buckets=16).search("of ther", prefix=True))


@query(_SEARCH.format(expansion=_EXACT.format(terms=_terms("the", "of", "with"))) + "SELECT doc, round(score, 6) AS score, terms FROM a ORDER BY a.score DESC, doc LIMIT 25")
def search_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 best, of which blocks that cannot hold one are not scored."""
    index = _titles(spark, sf_dir)
    index.postings = saved.blocked(index, 64)
    return _rounded(saved.top(index, saved.bounds(index.postings), "the of with", 25).hits)


@query("""
WITH r AS (SELECT DISTINCT o_orderpriority AS body, o_custkey::VARCHAR AS document_id, o_orderstatus AS title, o_orderdate::TIMESTAMP AS ts FROM orders),
s AS (SELECT *, lag(title) OVER w AS before, lag(ts) OVER w AS last, lead(ts) OVER w AS next FROM r WINDOW w AS (PARTITION BY body, document_id ORDER BY ts, title)),
m AS (SELECT max(o_orderdate)::TIMESTAMP AS most FROM orders)
SELECT body, document_id, 'new' AS change, ts AS "at" FROM s WHERE last IS NULL OR ts > last + INTERVAL 180 DAY
UNION ALL SELECT body, document_id, 'changed', ts FROM s WHERE ts <= last + INTERVAL 180 DAY AND title <> before
UNION ALL SELECT body, document_id, 'gone', ts + INTERVAL 180 DAY FROM s, m WHERE next > ts + INTERVAL 180 DAY OR (next IS NULL AND ts + INTERVAL 180 DAY < most - INTERVAL 7 DAY)""")
def watched_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer by priority as sightings of a document: state by key, timers of event time."""
    path = f"{sf_dir}/orders.parquet"
    rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")  # a pattern, as the table may be one file
    seen = rows.select(F.col("o_orderpriority").alias("body"), F.col("o_custkey").cast("string").alias("document_id"), F.col("o_orderstatus").alias("title"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"))
    out = folder(spark, "watched")
    state.run_to_files(state.changes(seen, period="180 days"), f"{out}/changes", f"{out}/checkpoint")
    return spark.read.schema(state.CHANGES).parquet(f"{out}/changes")


@query("""
WITH r AS (SELECT 1 AS version, o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'confirmed' ELSE 'conflict' END AS outcome FROM orders WHERE o_orderkey % 3 > 0
  UNION ALL SELECT 2, o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_orderkey % 3 = 0 THEN 'confirmed' ELSE 'unparsed' END FROM orders)
SELECT version::INTEGER AS version, CASE outcome WHEN 'confirmed' THEN 'confirmed' ELSE 'queue' END AS name, outcome, count(*) AS n, sum(k)::BIGINT AS keys FROM r GROUP BY 1, 2, 3""")
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables published in one commit, twice; both versions read by their manifests."""
    o, root = read(spark, sf_dir, "orders"), folder(spark, "published")
    good = F.col("o_orderstatus") == "F"
    first = o.where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("document_id"), F.when(good, "confirmed").otherwise("conflict").alias("outcome"))
    second = o.select(F.col("o_orderkey").alias("document_id"), F.when(good | (F.col("o_orderkey") % 3 == 0), "confirmed").otherwise("unparsed").alias("outcome"))
    publish.publish_split(first, root)
    publish.publish_split(second, root)
    p, out = publish.Publication(spark, root), None
    for version in p.versions():
        for name in ("confirmed", "queue"):
            part = p.read(name, version).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("document_id").alias("keys")).select(F.lit(version).alias("version"), F.lit(name).alias("name"), "outcome", "n", "keys")
            out = part if out is None else out.union(part)
    return out


@query("SELECT page_id::VARCHAR AS name, sha256(html) AS sha256, strlen(html) AS bytes, page_id % 3 > 0 AS fetched FROM pages")
def fetched_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which a third lies in the cache with a right digest, a third with a wrong one and a third not at all, read through a ledger."""
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("name"), F.col("html").cast("binary").alias("content"), (F.col("page_id") % 3).alias("m"))
    files = pages.where("m < 2").select("name", F.when(F.col("m") == 0, F.col("content")).otherwise(F.lit("broken").cast("binary")).alias("content")).withColumn("sha256", F.sha2("content", 256))
    cars = pages.select("name", F.sha2("content", 256).alias("sha256"))
    blobs, new = publish.read_through(files, cars, lambda names: pages.join(names, "name", "left_semi").select("name", "content"), publish.Ledger(spark, folder(spark, "ledger")))
    return blobs.join(new.select("name", F.lit(True).alias("new")), "name", "left").select("name", "sha256", F.octet_length("content").cast("long").alias("bytes"), F.coalesce("new", F.lit(False)).alias("fetched"))


@query(f"""
WITH l AS (SELECT o_orderkey::VARCHAR || '=' || o_orderstatus AS line FROM orders),
c AS (SELECT line, (row_number() OVER (ORDER BY encode(line)) - 1) // {gate.CHUNK} AS chunk FROM l),
d AS (SELECT chunk, sha256(string_agg(line, chr(10) ORDER BY encode(line))) AS line FROM c GROUP BY 1),
e AS (SELECT chunk // {gate.CHUNK} AS chunk, CASE WHEN (SELECT count(*) FROM d) > 1 THEN sha256(string_agg(line, chr(10) ORDER BY chunk)) ELSE max(line) END AS line FROM d GROUP BY 1)
SELECT line AS fingerprint FROM e""")
def fingerprint_of_any_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.fingerprint_chunked(read(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority, o_orderkey % 4 AS file, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) + 1 AS line FROM orders")
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of CSV files with the line that each stands on, whatever splits the files are read in."""
    out, o = folder(spark, "lines"), read(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey"), "o_orderpriority", (F.col("o_orderkey") % 4).alias("m"))
    rows.repartition(4, "m").sortWithinPartitions("m", "o_orderkey").write.partitionBy("m").option("header", True).csv(out)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("o_orderkey", "o_orderpriority")])
    return tables.read_csv_lines(spark, f"{out}/m=*", schema).select("o_orderkey", "o_orderpriority", (F.col("o_orderkey").cast("long") % 4).alias("file"), "line")


@query("""
WITH r AS (SELECT o_orderkey AS line, o_custkey AS k, o_orderdate::DATE AS a, o_orderdate::DATE + CASE o_orderstatus WHEN 'F' THEN 10 WHEN 'O' THEN 45 ELSE 200 END::INTEGER AS b FROM orders)
SELECT p.line, q.line AS other FROM r p JOIN r q ON p.k = q.k AND p.line < q.line AND p.a <= q.b AND q.a <= p.b""")
def overlapping_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer whose intervals overlap, both named."""
    day = F.col("o_orderdate").cast("date")
    days = F.when(F.col("o_orderstatus") == "F", 10).when(F.col("o_orderstatus") == "O", 45).otherwise(200)
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line"), "o_custkey", day.alias("valid_from"), F.date_add(day, days).alias("valid_to"))
    return constraints.overlapping_pairs(rows, ["o_custkey"])


@query("""
WITH RECURSIVE e AS (SELECT p_partkey AS code, p_partkey // 2 AS target, (2000 + p_partkey % 5)::VARCHAR || '-01-01' AS since FROM part WHERE p_partkey % 7 > 0
  UNION ALL SELECT p_partkey, p_partkey // 2 + 1, '2003-06-01' FROM part WHERE p_partkey % 11 = 0 AND p_partkey > 20),
k AS (SELECT p_partkey AS code FROM part WHERE p_partkey % 13 = 0),
a AS (SELECT p_partkey AS code, d AS ts FROM part, (VALUES ('2001-05-05'), ('2003-12-31')) v(d)),
x AS (SELECT code, target, since FROM e WHERE code NOT IN (SELECT code FROM k)),
s AS (SELECT code, d AS ts, max(target) AS target FROM x, (VALUES ('2001-05-05'), ('2003-12-31')) v(d) WHERE since <= d GROUP BY 1, 2),
w AS (SELECT code, ts, code AS here, 0 AS hops FROM a UNION ALL SELECT w.code, w.ts, s.target, w.hops + 1 FROM w JOIN s ON s.code = w.here AND s.ts = w.ts WHERE w.hops < 60),
f AS (SELECT code, ts, max(hops) AS hops, arg_max(here, hops) AS here FROM w GROUP BY 1, 2)
SELECT code::VARCHAR AS code, ts AS "at", CASE WHEN here IN (SELECT code FROM k) THEN here::VARCHAR END AS resolved, CASE WHEN hops < 60 THEN hops END::INTEGER AS hops,
  CASE WHEN hops = 60 THEN 'cycle' WHEN here IN (SELECT code FROM k) THEN 'current' ELSE 'unknown' END AS status FROM f""")
def resolved_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each code at two dates, through the replacements in force by then; a greatest target is greatest as text of equal length."""
    k = F.col("p_partkey")
    code = lambda c: F.lpad(c.cast("string"), 12, "0")
    part = read(spark, sf_dir, "part")
    half = F.floor(k / 2)
    edges = part.where(k % 7 > 0).select(code(k).alias("retired"), code(half).alias("current"), F.concat((2000 + k % 5).cast("string"), F.lit("-01-01")).alias("effective_from"))
    edges = edges.union(part.where((k % 11 == 0) & (k > 20)).select(code(k), code(half + 1), F.lit("2003-06-01")))
    rows = part.select(code(k).alias("code"), F.explode(F.array(F.lit("2001-05-05"), F.lit("2003-12-31"))).alias("at"))
    out = temporal.resolve_each(rows, part.where(k % 13 == 0).select(code(k).alias("code")), edges)
    plain = lambda c: F.col(c).cast("long").cast("string").alias(c)
    return out.select(plain("code"), "at", plain("resolved"), "hops", "status")
