"""python -m attesta COMMAND ...: thin entry points. Exit codes: 0 all good, 1 refusals or violations were told, 2 could not check."""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import consensus, constraints, discover, gate, temporal
from .operators import report as report_
from .operators import resolve as resolve_
from .operators.storage import cut
from .sources import documents, publish, tables


def _told(rows: DataFrame, limit: int = 20) -> int:
    """Print the first rows and how many there are; 1 if there are any."""
    n = rows.count()
    for r in rows.limit(limit).collect():
        print(" ".join(f"{k}={v}" for k, v in r.asDict().items()))
    print(f"{n} rows")
    return int(n > 0)


def _edges(spark: SparkSession, path: str | None) -> DataFrame:
    return tables.migrations(spark, path) if path else spark.createDataFrame([], "retired string, current string, effective_from string")


def validate(spark: SparkSession, args) -> int:
    for check in constraints.deferred():
        print(f"deferred: {check}")
    codes = tables.read_csv(spark, args.codes, tables.KATO).select("kato")
    return _told(constraints.validate_file(spark, args.rates, codes, _edges(spark, args.migrations)))


def resolve(spark: SparkSession, args) -> int:
    codes = spark.createDataFrame([(c,) for c in args.code], "code string")
    current = tables.code_set(tables.read_csv(spark, args.codes, tables.KATO))
    found = temporal.resolve(codes, current, _edges(spark, args.migrations)).orderBy("code")
    found.show(truncate=False)
    return int(found.where("status <> 'current'").limit(1).count() > 0)


def extract(spark: SparkSession, args) -> int:
    documents, failures = spark.read.parquet(args.documents), spark.read.parquet(args.failures) if args.failures else spark.createDataFrame([], "document_id string, lang string, error string")
    results = consensus.extract(documents.select("document_id").distinct(), documents, failures)
    counts = tables.split_write(results.where("outcome is not null"), f"{args.out}/confirmed", f"{args.out}/queue", allow_shrink=args.allow_shrink)
    print(counts)
    return int(any(n for k, n in counts.items() if k != consensus.CONFIRMED))


def report(spark: SparkSession, args) -> int:
    results = spark.read.parquet(args.results)
    results.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).orderBy("outcome").show()
    return int(results.where(F.col("outcome") != gate.AGREE).limit(1).count() > 0)


def _getter(args):
    """url -> html, throttled within its task."""

    def get(url: str) -> str:
        throttle = get.__dict__.setdefault("throttle", documents.Throttle(args.rate))
        return documents.fetch(url, attempts=args.attempts, throttle=throttle).decode("utf-8", "replace")

    return get


def _counted(rows: DataFrame, by: str) -> None:
    rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(by).show(truncate=False)


def enumerate_(spark: SparkSession, args) -> int:
    """The listings of all bodies and years; beside what phrase search found, if that is given."""
    asked = discover.bodies(spark)
    if args.bodies:
        unknown = sorted(set(args.bodies) - set(discover.BODIES))
        if unknown:
            raise constraints.ConstraintError(f"unknown bodies {unknown}")
        asked = asked.where(F.col("body").isin(args.bodies))
    listings = asked.crossJoin(F.broadcast(spark.createDataFrame([(y,) for y in args.years], "adopted_year int")))
    found, failures = discover.sweep(listings, discover.fetched_by(_getter(args), args.parts), args.base)
    publish.Publication(spark, args.out).write({"documents": found, "failures": failures}, "enumerate")
    told = publish.Publication(spark, args.out)
    _counted(told.read("documents"), "kind")
    if args.found:
        discover.compare_indexes(told.read("documents"), spark.read.parquet(args.found)).orderBy("side").show()
    if args.sample:
        discover.systematic_sample(told.read("documents").where("kind = 'other'"), "document_id", args.sample).orderBy("document_id").show(args.sample, truncate=False)
    return _told(told.read("failures").orderBy("adopted_year", "body"))


def search(spark: SparkSession, args) -> int:
    """Breadth-first phrase search for one year's decisions."""
    get = discover.fetched_by(_getter(args), 1)

    def catalogue(phrase: str) -> DataFrame:
        asked = spark.createDataFrame([("", args.year, 1, discover.search_url(args.base, phrase))], "body string, adopted_year int, page int, url string")
        answer = cut(get(asked))
        if answer.where("error is not null").limit(1).count():
            raise OSError(f"{phrase}: {answer.first().error}")
        return discover.links(answer, "page", "html").select("document_id", "title")

    found = discover.frontier(catalogue, args.seeds, lambda title: discover.is_rate_decision(title, args.year))
    tables.swap_write(spark.createDataFrame(sorted(found.items()), "document_id string, title string"), args.out)
    print(f"{len(found)} documents; a district without one is not known to have kept the base rate")
    return 0


def classifier(spark: SparkSession, args) -> int:
    """The classifier from its workbook, and beside it where it came from."""
    rows = cut(documents.classifier_rows(documents.read_xlsx(spark, args.workbook), args.edition))
    digest = tables.blobs(spark, args.workbook, "*.xlsx").first().sha256
    tables.write_with_source(rows, args.out, {"workbook_url": args.workbook, "kato_version": args.edition, "workbook_sha256": digest})
    _counted(rows, "level")
    return 0


def map_(spark: SparkSession, args) -> int:
    """Confirmed decisions to districts, by their text and the body and title under which they are listed."""
    confirmed = spark.read.parquet(args.confirmed).where("outcome = 'confirmed'")
    listed = spark.read.parquet(args.listed).select("document_id", "body", "title").dropDuplicates(["document_id"])
    codes = tables.read_csv(spark, args.codes, tables.KATO)
    docs = confirmed.select("document_id", "decision_ref", "sentence", "rate", "year", "source_url").join(listed, "document_id", "left")
    mapped = resolve_.map_documents(docs, tables.at_level(codes, "oblast"), tables.at_level(codes, "district"))
    told = docs.select("document_id", "decision_ref", "rate", "year", "source_url").join(mapped, "document_id").withColumnRenamed("code", "kato").withColumnRenamed("name", "name_ru")
    tables.swap_write(told.withColumn("name_kk", F.lit(None).cast("string")), args.out)
    told = spark.read.parquet(args.out)
    _counted(told, "outcome")
    return _told(told.where(F.col("outcome") != resolve_.MAPPED).select("outcome", "document_id", "decision_ref", "candidates").orderBy("document_id"), args.show)


def publish_(spark: SparkSession, args) -> int:
    """The rates table from mapped decisions; anything missing stops all of it."""
    mapped = spark.read.parquet(args.mapped)
    edition = constraints.require_single(tables.read_csv(spark, args.codes, tables.KATO), "kato_version")
    urls = mapped.select("document_id", F.concat(F.lit(f"{args.base}/kaz/docs/"), F.col("document_id")).alias("kazakh_source_url")).distinct()
    base_rates = {int(y): int(r) for y, r in (pair.split("=") for pair in args.base_rates)}
    rates = cut(report_.publish(mapped, tables.names_by_code(tables.read_csv(spark, args.codes, tables.KATO)), urls, edition, args.method, base_rates))
    tables.write_csv(rates.orderBy("kato", "kato_version", "valid_from"), args.out)
    print(f"{rates.count()} rows")
    return 0


def emit(spark: SparkSession, args) -> int:
    """Blind tasks for the second reader, of a population or of named documents."""
    texts, ids = spark.read.parquet(args.texts), args.ids
    if ids:
        wanted = spark.createDataFrame([(i,) for i in ids], "document_id string")
    else:
        held = {"confirmed": [args.confirmed], "queued": [args.queue], "all": [args.confirmed, args.queue]}[args.population]
        wanted = reduce(DataFrame.union, [spark.read.parquet(p).select("document_id") for p in held]).distinct()
    tasks, missing = gate.tasks_and_missing(wanted.join(texts, "document_id", "left").withColumn("text", F.coalesce("text", F.lit(""))))
    tables.write_tasks(tasks, args.out, full=not ids)
    return _told(missing.orderBy("document_id"))


def ingest(spark: SparkSession, args) -> int:
    """Batches of verdicts merged, held against the parser's rates, and stored with the fingerprint of these."""
    verdicts = gate.merge_batches([spark.read.schema(tables.VERDICTS).json(p) for p in args.verdicts])
    confirmed, tasks = spark.read.parquet(args.confirmed), spark.read.schema("document_id string, text string").json(args.tasks)
    parsed = tables.parser_rates(confirmed)
    results = cut(gate.compare(verdicts, parsed, parsed, tasks))
    print(gate.ingest(results, parsed, args.out, args.allow_shrink))
    return int(results.where(F.col("outcome") != gate.AGREE).limit(1).count() > 0)


def build(spark: SparkSession, args) -> int:
    """The published files from the rates table and a page template."""
    codes = tables.read_csv(spark, args.codes, tables.KATO)
    rates = tables.read_csv_lines(spark, args.rates, tables.RATES)
    body = report_.payload(report_.by_year(rates, tables.at_level(codes, "oblast")), report_.stamp(args.epoch)).first().json
    template = spark.read.text(args.template, wholetext=True).first()[0]
    aliases = [list(r) for r in tables.aliases(spark, args.aliases).collect()] if args.aliases else []  # written by hand into the page
    for name in report_.write_artefacts(spark, body, args.out, args.site, template, "rates", {"rates": rates.select(*report_.FIELDS)}, aliases):
        print(name)
    return 0


#: Options: a name is a positional argument, + takes several, ! is a switch, = has a default of its type.
WEB = ("--base=https://adilet.zan.kz", "--rate=1.0", "--attempts=3")
COMMANDS = {
    "validate": (validate, "rates", "codes", "--migrations"), "resolve": (resolve, "codes", "code+", "--migrations"), "extract": (extract, "documents", "out", "--failures", "--allow-shrink!"),
    "report": (report, "results"), "enumerate": (enumerate_, "out", "--years+int", "--bodies+", "--found", "--sample=0", "--parts=4", *WEB), "discover": (search, "out", "seeds+", "--year=2026", *WEB),
    "classifier": (classifier, "workbook", "out", "edition"), "map": (map_, "confirmed", "listed", "codes", "out", "--show=8"), "publish": (publish_, "mapped", "codes", "out", "--base-rates+", "--method=deterministic-readers", "--base=https://adilet.zan.kz"),
    "emit": (emit, "texts", "out", "--confirmed", "--queue", "--population=confirmed", "--ids+"), "ingest": (ingest, "confirmed", "tasks", "out", "verdicts+", "--allow-shrink!"),
    "build": (build, "rates", "codes", "template", "out", "site", "--aliases", "--epoch=0"),
}


def _option(parser: argparse.ArgumentParser, text: str) -> None:
    if text.endswith("!"):
        parser.add_argument(text[:-1], action="store_true")
    elif "=" in text:
        name, default = text.split("=", 1)
        kind = int if default.isdigit() else float if default.replace(".", "", 1).isdigit() else str
        parser.add_argument(name, default=kind(default), type=kind)
    elif "+" in text:
        name, kind = text.split("+")
        parser.add_argument(name, nargs="+", type=int if kind else str, **({"default": []} if name.startswith("-") else {}))
    else:
        parser.add_argument(text)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="attesta")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (run, *options) in COMMANDS.items():
        command = sub.add_parser(name, help=run.__doc__)
        command.set_defaults(run=run)
        for text in options:
            _option(command, text)
    args = parser.parse_args(argv)
    try:
        return args.run(spark or SparkSession.builder.getOrCreate(), args)
    except (constraints.ConstraintError, LookupError) as e:
        print(f"refused: {e}", file=sys.stderr)
        return 1
    except OSError as e:
        print(f"could not check: {e}", file=sys.stderr)
        return 2
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        print(f"could not check: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
