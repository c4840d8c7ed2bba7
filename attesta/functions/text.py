"""Column expressions over text. Patterns carry (?U) or explicit classes: plain \\w, \\s and case folding are ASCII in Java."""

from __future__ import annotations

import html as entities
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of the published texts, words that carry no identity, months.
CYRILLIC = "[А-Яа-яЁёӘәҒғҚқҢңӨөҰұҮүҺһІі]"
WORD = f"{CYRILLIC}+(?:-{CYRILLIC}+)*"
#: The same whole word, taken without trying its beginnings: for patterns in which no letter or hyphen can follow it.
WHOLE_WORD = f"(?<!{CYRILLIC}){CYRILLIC}++(?:-{CYRILLIC}++)*+"
STOPWORDS = ("решение", "маслихата", "область", "области", "районного", "район", "городского", "сельского", "казахстан", "республики")
MONTHS = {"января": "01", "февраля": "02", "марта": "03", "апреля": "04", "мая": "05", "июня": "06", "июля": "07", "августа": "08", "сентября": "09", "октября": "10", "ноября": "11", "декабря": "12"}
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#x27;": "'", "&nbsp;": " ", "&laquo;": "«", "&raquo;": "»", "&amp;": "&"}


def lookup(values: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space, of any script, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Runs of white space become a space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """First match or null (never an empty string for no match)."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def all_found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.array().cast("array<string>"))


def only(values: Column) -> Column:
    """The one distinct element, or null: an ambiguous source is a silent one."""
    return let(F.array_distinct(values), lambda distinct: F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0))))


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.]) ")


def tokens(text: Column, pattern: str = WORD) -> Column:
    return all_found(F.lower(text), WHOLE_WORD if pattern == WORD else pattern)


def prefixes(text: Column, size: int = 5, least: int = 5, pattern: str = WORD, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """Distinct beginnings of the words that have at least ``least`` characters, without those of stop words."""
    letter = pattern.removesuffix("+")
    if letter.startswith("[") and letter.endswith("]") and "]" not in letter[:-1] and size >= least:  # a class of letters: the pattern itself cuts
        cut = F.array_distinct(all_found(F.lower(text), f"({letter}{{{least},{size}}}){letter}*+", 1))
    else:
        return prefixes_of(tokens(text, pattern), size, least, stopwords)
    return F.array_except(cut, F.array(*[F.lit(s[:size]) for s in dict.fromkeys(stopwords)]).cast("array<string>"))


def prefixes_of(words: Column, size: int = 5, least: int = 5, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """The same of words that are told apart already."""
    long = F.filter(words, lambda w: F.char_length(w) >= least)
    cut = F.array_distinct(F.transform(long, lambda w: F.substring(w, 1, size)))
    return F.array_except(cut, F.array(*[F.lit(s[:size]) for s in dict.fromkeys(stopwords)]).cast("array<string>"))


def stems(text: Column, least: int = 5) -> Column:
    return prefixes(text, 5, least)


def roots(text: Column) -> Column:
    """Six characters; plain Cyrillic, no stop words."""
    return prefixes(text, 6, 5, "[а-яё]+", ())


def head_words(text: Column, n: int = 12) -> Column:
    return F.array_join(F.slice(F.split(strip(text), r"(?U)\s+"), 1, n), " ")


def span(text: Column, pattern: str) -> Column:
    """Struct of start (from 1) and stop (exclusive) of the first match, or null."""
    at = F.regexp_instr(text, F.lit(pattern))
    return F.when(at > 0, F.struct(at.alias("start"), (at + F.char_length(F.regexp_extract(text, pattern, 0))).alias("stop")))


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def has_word(text: Column, word: Column) -> Column:
    """Whole-word membership, for names too short to have a stem."""
    return F.array_contains(tokens(text), F.lower(word))


def unescaped(text: Column) -> Column:
    """The common entities; each once, the ampersand last. ``unescape_all`` has all of them."""
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), text)


def unescape_all(text: Column) -> Column:
    """Every named and numeric entity, by batches (no built-in function has them)."""
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else entities.unescape(x) for x in column.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(text)


def escaped(text: Column) -> Column:
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), pairs, text)


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", " ")


def url_quoted(text: Column) -> Column:
    """Percent encoding that keeps slashes (url_encode alone is form encoding)."""
    return F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def without_session(url: Column) -> Column:
    return F.regexp_replace(url, r";jsessionid=[^?&]*", "")


def script_safe(json: Column) -> Column:
    return F.replace(json, F.lit("</"), F.lit("<\\/"))


def number(text: Column, kind: str = "double") -> Column:
    return F.trim(text).try_cast(kind)


def dates(text: Column, marker: str) -> Column:
    """Distinct ISO dates after a marker, as DD.MM.YYYY or D <month> YYYY года; a date that goes on as a registry footnote is no
    date of the text's own."""
    footnote = r"(?!\s*в\s+соответствии\s+с\s+пунктом\s+\d+\s+настоящего\s+решения)"
    numeric = rf"{marker}(\d{{2}})\.(\d{{2}})\.(\d{{4}})"
    spelled = rf"{marker}(\d{{1,2}})\s+(\w+)\s+(\d{{4}})\s+года"
    month = lookup(MONTHS)

    def parts(pattern: str, date: Callable[[Column, Column, Column], Column]) -> Column:
        # the text is read once for each form, its groups from what matched
        whole = all_found(text, rf"(?iuU){pattern}{footnote}")
        return F.transform(whole, lambda x: date(*[F.regexp_extract(x, rf"(?iuU)^{pattern}$", g) for g in (1, 2, 3)]))

    a = parts(numeric, lambda d, m, y: F.concat_ws("-", y, m, d))
    b = parts(spelled, lambda d, m, y: let(month[F.lower(m)], lambda n: F.when(n.isNotNull(), F.concat_ws("-", y, n, F.lpad(d, 2, "0")))))
    return F.array_compact(F.array_distinct(F.concat(a, b)))
