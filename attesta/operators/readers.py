"""Independent readers of one fact, each a struct of (reader, rate_percent, detail, kind).

A kind tells silence from objection: ``read`` has a value, ``no-match`` found nothing, ``substantive`` objects, and ``unavailable`` had no
input. Patterns and tables below are fixed values of the published texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

READ, NO_MATCH, SUBSTANTIVE, UNAVAILABLE = "read", "no-match", "substantive", "unavailable"
# Fixed values.
BASE_RATES = {2026: 4, 2027: 4}
NUMERALS = {"один": 1, "одного": 1, "два": 2, "двух": 2, "две": 2, "три": 3, "трех": 3, "трёх": 3, "четыре": 4, "четырех": 4, "четырёх": 4, "пять": 5, "пяти": 5, "шесть": 6, "шести": 6}
KAZAKH_NUMERALS = {"екі": 2, "үш": 3, "төрт": 4}
TO, FROM = r"(?:на|до)", r"(?:с|в\s+размере)"
KAZAKH_PAIR = r"(?U)(\d+)\s*(?:\(\s*([^()]{1,15}?)\s*\))?\s*(?:пайыз\S*|%\S*)[^.\d]{0,24}?\s*(\d+)\s*(?:\(\s*([^()]{1,15}?)\s*\))?\s*(?:пайыз|%)"
RETAIL, SIMPLIFIED, REGIME = r"(?U)розничн\w*\s+налог\w*", r"(?U)упрощ(?:е|ё)нн\w*\s+деклараци\w*", r"(?U)специальн\w*\s+налогов\w*\s+режим\w*"
YEAR_PATTERNS = (r"(?U)за налоговый период в (\d{4}) году", r"(?U)\bна (\d{4}) год\b", r"(?U)\bв (\d{4}) году\b")
IN_FORCE = r"в(?:водит(?:ь)?ся\s+в\s+действие|ступает\s+в\s+силу)\s+с\s+"
RETROACTIVE = r"распространяется\s+(?:свое\s+действие\s+)?на\s+правоотношени\w*,?\s+возникш\w*\s+с\s+"
DECISION = r"(?U)(Решение(?: маслихата)?(?:[^.]|\.(?=\s?[А-ЯЁ]))*?от \d{1,2} \w+ \d{4} года № [\w]+(?:[-/]\s?[\w]+)*)"
SOURCES = {"digit": "russian-numeral", "transition": "russian-numeral", "word": "russian-word", "kazakh": "kazakh-file", "regime": "regime-check"}


def reading(reader: str, value: Column | None, detail: Column | str, kind: str) -> Column:
    value = F.lit(None).cast("int") if value is None else value.cast("int")
    return F.struct(F.lit(reader).alias("reader"), value.alias("rate_percent"), (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"), F.lit(kind).alias("kind"))


def _groups(match: Column, pattern: str, n: int) -> list[Column]:
    """The groups of what a pattern that looks at nothing beyond its match matched; null where it is null."""
    return [F.regexp_extract(match, pattern, g) for g in range(1, n + 1)]


def rate_sentence(text: Column) -> Column:
    """The one sentence that moves a rate, or null if there are none or several."""
    moves = F.filter(
        T.sentences(text),
        lambda s: (s.contains("процент") | s.contains("%")) & s.rlike(rf"(?U)\b{FROM}\s*\d") & s.rlike(rf"(?U)\b{TO}\s+\d"),
    )
    return T.let(moves, lambda m: F.when(F.size(m) == 1, T.strip(F.get(m, F.lit(0)))))


def digit(sentence: Column) -> Column:
    """The numeral after the preposition of the new rate."""
    pattern = rf"(?U)\b{TO}\s+(\d+)\s*(?:\(|%|процент)"
    found = T.let(T.found(sentence, pattern), lambda m: F.struct(m.alias("m"), _groups(m, pattern, 1)[0].try_cast("int").alias("value")))
    return T.let(found, lambda x: F.when(x["value"].isNotNull(), reading("digit", x["value"], T.strip(x["m"]), READ)).otherwise(reading("digit", None, "no numeral after the preposition", NO_MATCH)))


def word(sentence: Column) -> Column:
    """The last spelled numeral in parentheses before the unit, through its own table."""
    all_words = T.all_found(sentence, r"(?U)\(\s*([А-Яа-яЁё]+)\s*\)\s*процент", 1)
    last = F.lower(F.try_element_at(all_words, F.lit(-1)))

    def told(x: Column) -> Column:
        last, value = x["last"], x["value"]
        return (
            F.when(last.isNull(), reading("word", None, "no spelled numeral", NO_MATCH))
            .when(value.isNull(), reading("word", None, F.concat(F.lit("unknown numeral "), last), SUBSTANTIVE))
            .otherwise(reading("word", value, F.concat(F.lit("("), last, F.lit(") процент")), READ))
        )

    return T.let(T.let(last, lambda x: F.struct(x.alias("last"), T.lookup(NUMERALS)[x].alias("value"))), told)


def transition(sentence: Column, year: Column) -> Column:
    """The movement from the old rate to the new one: downwards, and from the year's base."""
    unit = r"\s*(?:\(|%|процент)"
    pattern = rf"(?U)\b{FROM}\s+(\d+){unit}.*?\b{TO}\s+(\d+){unit}"
    base = T.lookup(BASE_RATES)[year.cast("int")]

    def told(x: Column) -> Column:
        old, new, base = x["old"], x["new"], x["base"]
        move = F.concat_ws(" -> ", old, new)
        return (
            F.when(old.isNull(), reading("transition", None, "no pair of old and new rate", NO_MATCH))
            .when(new >= old, reading("transition", None, F.concat(F.lit("not a reduction: "), move), SUBSTANTIVE))
            .when(base.isNull(), reading("transition", None, "no base known for the year, so the origin cannot be checked", SUBSTANTIVE))
            .when(old != base, reading("transition", None, F.concat(F.lit("does not start from the base: "), move), SUBSTANTIVE))
            .otherwise(reading("transition", new, T.strip(x["m"]), READ))
        )

    def numbers(m: Column) -> Column:
        old, new = (g.try_cast("int") for g in _groups(m, pattern, 2))
        return F.struct(m.alias("m"), old.alias("old"), new.alias("new"), base.alias("base"))

    return T.let(T.let(T.found(sentence, pattern), numbers), told)


def kazakh(text: Column, error: Column) -> Column:
    """The pair of rates in the other language's file; its numerals have to agree with its digits."""

    def spelled(word_: Column, value: Column, digits: Column):
        return word_.isNotNull() & value.isNull(), word_.isNotNull() & (value != digits), word_

    def told(x: Column) -> Column:
        old, new = x["old"], x["new"]
        out = (
            F.when(error.isNotNull(), reading("kazakh", None, error, UNAVAILABLE))
            .when(text.isNull(), reading("kazakh", None, "no text in the other language", UNAVAILABLE))
            .when(old.isNull(), reading("kazakh", None, "no pair of rates in the other language", NO_MATCH))
            .when(new >= old, reading("kazakh", None, F.concat(F.lit("not a reduction: "), F.concat_ws(" -> ", old, new)), SUBSTANTIVE))
        )
        for word_, digits in (("new_word", new), ("old_word", old)):
            unknown, differs, said = spelled(x[word_], T.lookup(KAZAKH_NUMERALS)[x[word_]], digits)
            out = out.when(unknown, reading("kazakh", None, F.concat(F.lit("unknown numeral "), said), SUBSTANTIVE))
            out = out.when(differs, reading("kazakh", None, F.concat(F.lit("digit contradicts "), said), SUBSTANTIVE))
        return out.otherwise(reading("kazakh", new, T.strip(x["m"]), READ))

    def numbers(m: Column) -> Column:
        old, old_word, new, new_word = _groups(m, KAZAKH_PAIR, 4)
        plain = lambda w: F.nullif(F.lower(T.strip(w)), F.lit(""))
        return F.struct(m.alias("m"), old.try_cast("int").alias("old"), new.try_cast("int").alias("new"), plain(old_word).alias("old_word"), plain(new_word).alias("new_word"))

    return T.let(T.let(T.found(text, KAZAKH_PAIR), numbers), told)


def regime(sentence: Column) -> Column:
    """Never gives a value; objects if the sentence governs another regime, or one that cannot be told."""
    retail, simplified, marker = (sentence.rlike(p) for p in (RETAIL, SIMPLIFIED, REGIME))
    return (
        F.when(retail & simplified, reading("regime", None, "names both regimes", SUBSTANTIVE))
        .when(retail, reading("regime", None, "governs the retail regime", SUBSTANTIVE))
        .when(marker & ~simplified, reading("regime", None, "names a regime that cannot be told", SUBSTANTIVE))
        .when(simplified, reading("regime", None, "governs the simplified regime", NO_MATCH))
        .otherwise(reading("regime", None, "names no regime", NO_MATCH))
    )


def in_force(text: Column) -> Column:
    return T.only(T.dates(text, IN_FORCE))


def _january(date: Column) -> Column:
    return F.when(date.endswith("-01-01"), F.substring(date, 1, 4).cast("int"))


def year(text: Column, hint: Column | None = None, force: Column | None = None) -> Column:
    """Struct (year, source): the first of the stated period, the date in force, the retroactive clause, the caller's hint. ``force``: the date in
    force, where it is known already."""
    stated = T.only(F.concat(*[T.all_found(text, p, 1) for p in YEAR_PATTERNS])).cast("int")
    force = T.let(in_force(text) if force is None else force, _january)
    steps = [("tax-period", stated), ("in-force-date", force), ("retroactive-effect", T.let(T.only(T.dates(text, RETROACTIVE)), _january)), ("caller-hint", F.lit(None).cast("int") if hint is None else hint.cast("int"))]

    def first(x: Column) -> Column:
        source = F.lit(None).cast("string")
        for name, _ in reversed(steps):
            source = F.when(x[name].isNotNull(), F.lit(name)).otherwise(source)
        return F.struct(F.coalesce(*[x[name] for name, _ in steps]).alias("year"), source.alias("source"))

    return T.let(F.struct(*[v.alias(name) for name, v in steps]), first)


def decision_ref(text: Column) -> Column:
    return T.strip(T.found(text, DECISION, 1))
