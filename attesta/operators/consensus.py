"""Quorum over independent readings. Refuse, never guess: no outcome but ``confirmed`` carries a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import readers as R

CONFIRMED, CONFLICT, UNPARSED = "confirmed", "conflict", "unparsed"
# Markers of texts that no longer stand, and the lawful band.
SUPERSEDED = ("Утратил силу", "Утратило силу", "Утратила силу", "внесены изменения", "Внесены изменения")
LEAST, MOST = 0.02, 0.06
NO_SENTENCE = "no single sentence lowers a rate — none matched, or several did"


def values(readings: Column, field: str = "value") -> Column:
    return F.array_distinct(F.filter(F.transform(readings, lambda r: r[field]), lambda v: v.isNotNull()))


def sources(readings: Column, source_of: dict[str, str], field: str = "value", name: str = "reader") -> Column:
    """Distinct sources of the readings that have a value: two readers of one source are one witness."""
    own = T.lookup(source_of)
    return F.array_distinct(F.transform(F.filter(readings, lambda r: r[field].isNotNull()), lambda r: own[r[name]]))


def quorum(readings: Column, source_of: dict[str, str], least: int = 2, field: str = "value") -> Column:
    """Struct (outcome, value, reason) of an array of (reader, value, kind)."""
    of = lambda kind: F.size(F.filter(readings, lambda r: r["kind"] == kind))
    found, told = values(readings, field), sources(readings, source_of, field)
    reason = (
        F.when(of(R.UNAVAILABLE) > 0, "unavailable")
        .when(of(R.SUBSTANTIVE) > 0, "objection")
        .when(F.size(found) == 0, "no-reading")
        .when(F.size(found) > 1, "disagree")
        .when(F.size(told) < least, "single-source")
    )
    outcome = F.when(reason.isin("unavailable", "objection", "disagree"), CONFLICT).when(reason.isNotNull(), UNPARSED).otherwise(CONFIRMED)
    return F.struct(outcome.alias("outcome"), F.when(reason.isNull(), F.get(found, F.lit(0))).alias("value"), reason.alias("reason"))


def classify(df: DataFrame, text: str = "text", kazakh_text: str = "kazakh_text", kazakh_error: str = "kazakh_error", year_hint: str | None = None) -> DataFrame:
    """Adds outcome, rate, reason, terminal, readings, sentence, year, year_source, decision_ref and in_force_from.

    The ladder's order is its meaning: a text that no longer stands, no single sentence, an unavailable witness, an objection, no
    value, several values, too few sources, outside the band, confirmed.
    """
    t = F.col(text)
    marker = F.array_compact(F.array(*[F.when(t.contains(m), F.lit(m)) for m in SUPERSEDED]))
    year = R.year(t, F.col(year_hint) if year_hint else None, F.col("__force"))
    step = df.select("*", R.in_force(t).alias("__force")).select("*", marker.alias("__superseded"), R.rate_sentence(t).alias("sentence"), year.alias("__year"), R.kazakh(F.col(kazakh_text), F.col(kazakh_error)).alias("__kazakh"))
    s, y = F.col("sentence"), F.col("__year")["year"]
    early = (F.size("__superseded") > 0) | s.isNull()
    all_readings = F.array(R.digit(s), R.word(s), R.transition(s, y), F.col("__kazakh"), R.regime(s))
    step = step.select("*", y.alias("year"), F.col("__year")["source"].alias("year_source"), F.when(early, F.array("__kazakh")).otherwise(all_readings).alias("readings"))
    r = F.col("readings")
    kinds = lambda kind: F.filter(r, lambda x: x["kind"] == kind)
    found, told = values(r, "rate_percent"), sources(r, R.SOURCES, "rate_percent")
    percent = F.get(found, F.lit(0))
    rate = (percent / 100).cast("decimal(4,2)")
    absent, objections = kinds(R.UNAVAILABLE), kinds(R.SUBSTANTIVE)
    detail = F.get(absent, F.lit(0))["detail"]
    reason = (
        F.when(F.size("__superseded") > 0, F.concat(F.lit("document is amended or repealed: '"), F.get("__superseded", F.lit(0)), F.lit("'")))
        .when(s.isNull(), NO_SENTENCE)
        .when((F.size(absent) > 0) & detail.contains("HTTPError: HTTP Error 404"), F.concat(F.lit("kazakh returned HTTP 404 — an answer: no copy in the other language may be published. ("), detail, F.lit(")")))
        .when(F.size(absent) > 0, F.concat(F.lit("kazakh could not be fetched — a failure of transport, no disagreement. ("), detail, F.lit(")")))
        .when(F.size(objections) > 0, F.array_join(F.transform(objections, lambda x: F.concat_ws(" objected: ", x["reader"], x["detail"])), "; "))
        .when(F.size(found) == 0, "no reader produced a rate")
        .when(F.size(found) > 1, F.concat(F.lit("readers disagree: "), F.array_join(F.sort_array(found).cast("array<string>"), ", ")))
        .when(F.size(told) < 2, F.concat(F.lit("only one independent source: "), F.array_join(told, ", ")))
        .when(~rate.between(LEAST, MOST), F.concat(F.lit("outside the lawful band: "), rate.cast("string")))
    )
    conflict = ~early & ((F.size(absent) > 0) | (F.size(objections) > 0) | (F.size(found) > 1) | ((F.size(told) >= 2) & ~rate.between(LEAST, MOST)))
    step = step.select("*", reason.alias("reason"), conflict.alias("__conflict"), early.alias("__early"), rate.alias("__rate"))
    outcome = F.when(F.col("reason").isNull(), CONFIRMED).when(F.col("__conflict"), CONFLICT).otherwise(UNPARSED)
    only_regime = F.forall(objections, lambda x: x["reader"] == "regime") & (F.size(objections) > 0) & (F.size(absent) == 0)
    out = step.select(
        "*", outcome.alias("outcome"), F.when(F.col("reason").isNull(), F.col("__rate")).alias("rate"),
        F.when(F.col("reason").isNotNull(), ~F.col("__early") & only_regime).alias("terminal"),
        F.when(~F.col("__early"), R.decision_ref(t)).alias("decision_ref"), F.when(~F.col("__early"), F.col("__force")).alias("in_force_from"),
    )
    return out.drop("__superseded", "__year", "__kazakh", "__conflict", "__early", "__rate", "__force")


def extract(ids: DataFrame, documents: DataFrame, failures: DataFrame, base: str = "https://adilet.zan.kz") -> DataFrame:
    """The outcome of each asked document: ids (document_id), documents (document_id, lang, url, text, sha256) in rus and kaz, failures
    (document_id, lang, error). A failure of the other language is an unavailable witness, never a fallback; a document without its
    own text has the outcome null and its failure as reason."""
    own = lambda lang, names: documents.where(F.col("lang") == lang).select("document_id", *[F.col(a).alias(b) for a, b in names.items()])
    failed = lambda lang, name: failures.where(F.col("lang") == lang).groupBy("document_id").agg(F.min("error").alias(name))
    told = ids.select("document_id").distinct().join(own("rus", {"url": "pdf_url", "text": "text", "sha256": "pdf_sha256"}), "document_id", "left")
    told = told.join(own("kaz", {"url": "kazakh_pdf_url", "text": "kazakh_text", "sha256": "kazakh_pdf_sha256"}), "document_id", "left")
    told = told.join(failed("rus", "__error"), "document_id", "left").join(failed("kaz", "kazakh_error"), "document_id", "left")
    told = told.withColumn("source_url", F.concat(F.lit(f"{base}/rus/docs/"), F.col("document_id")))
    lost = F.col("text").isNull()
    out = classify(told)
    return out.withColumn("outcome", F.when(~lost, F.col("outcome"))).withColumn("reason", F.when(lost, F.coalesce("__error", F.lit("not fetched"))).otherwise(F.col("reason"))).drop("__error", "text", "kazakh_text")
