"""Entity resolution in a hierarchical classifier: two sources for the upper level, blocking by code prefix, stem matching, a title as
fallback and veto. A name resolves only if exactly one candidate is left; every refusal keeps its reason and candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Outcomes and phrase patterns.
MAPPED = "mapped"
NO_DISTRICT, SEVERAL = "unmapped-no-district-matched", "unmapped-several-districts-matched"
OBLAST_DISAGREE, NO_BODY = "unmapped-oblast-sources-disagree", "unmapped-no-issuing-body-recorded"
NO_OBLAST, NO_OBLAST_FROM_BODY = "unmapped-no-oblast-named-by-either-source", "unmapped-body-names-no-oblast"
KIND_UNKNOWN, KIND_DISAGREE = "unmapped-jurisdiction-type-not-stated", "unmapped-jurisdiction-sources-disagree"
TITLE_CONTRADICTS = "unmapped-title-contradicts-citation"
TITLE_CITY, TITLE_DISTRICT = r"(?U)\bгород[аеу]?\b\s*[А-ЯЁӘҒҚҢӨҰҮҺІ]", r"(?U)\bрайон[аеу]\b"
BODY_CITY, BODY_DISTRICT = r"(?U)городско\w*\s+маслихат", r"(?U)районно\w*\s+маслихат"
BODY_CITY_OF, BODY_DISTRICT_OF = r"(?U)маслихат\w*\s+город[ае]\b", r"(?U)маслихат\w*\s+\w+\s+район[ае]\b"
BEFORE, AFTER = rf"(?U)({T.WHOLE_WORD})\s++област\w*+", rf"(?U)област\w*\s+({T.WORD})"


def candidate_kind(name: Column) -> Column:
    return F.when(name.contains("Г.А.") | F.ltrim(name).startswith("г."), "city").otherwise("district")


def without_oblast_phrase(text: Column) -> Column:
    """First the form with the name before the noun, then the form after it, in this order."""
    return F.regexp_replace(F.regexp_replace(text, BEFORE, " "), AFTER, " ")


def kind_of(text: Column, city: list[str], district: list[str]) -> Column:
    """Struct (kind, span) if exactly one of the two kinds is stated, else null; earlier patterns are preferred."""
    a, b = (F.coalesce(*[T.span(text, p) for p in patterns]) for patterns in (city, district))
    return F.when(a.isNotNull() & b.isNull(), F.struct(F.lit("city").alias("kind"), a.alias("span"))).when(a.isNull() & b.isNotNull(), F.struct(F.lit("district").alias("kind"), b.alias("span")))


def title_kind(text: Column) -> Column:
    return kind_of(text, [TITLE_CITY], [TITLE_DISTRICT])


def body_kind(text: Column) -> Column:
    return kind_of(text, [BODY_CITY, BODY_CITY_OF], [BODY_DISTRICT, BODY_DISTRICT_OF])


def _codes(stems: Column, names: Column) -> Column:
    """The codes of those ``names`` (structs of code and marks) that share a stem."""
    return T.let(stems, lambda s: F.array_distinct(F.transform(F.filter(names, lambda n: F.arrays_overlap(n["marks"], s)), lambda n: n["code"])))


def exactly_one(stems: Column, names: Column) -> Column:
    """The code of the one name that shares a stem, else null."""
    return T.let(_codes(stems, names), lambda c: F.when(F.size(c) == 1, F.get(c, F.lit(0))))


def oblast_names(oblasts: DataFrame) -> DataFrame:
    """One row, to be broadcast: the names of oblasts (__plain), and of cities of that rank as they stand (__towns) and without their mark (__cities)."""
    town = F.col("name").startswith("г.")
    told = lambda where, name: F.collect_list(F.when(where & F.col("code").isNotNull(), F.struct("code", T.stems(name, 4).alias("marks"))))
    name = F.col("name")
    return oblasts.agg(told(~town, name).alias("__plain"), told(town, name).alias("__towns"), told(town, F.regexp_replace(name, r"^г\.", "")).alias("__cities"))


def oblast_from_body(body: Column) -> Column:
    """A body that says «област…» is matched with oblasts, any other with cities of that rank. Needs the columns of oblast_names."""
    return exactly_one(T.stems(body, 4), F.when(F.lower(body).contains("област"), F.col("__plain")).otherwise(F.col("__towns")))


def oblast_from_text(text: Column) -> Column:
    """The names next to the noun; only if none of them is an oblast, the cities named anywhere. Needs the columns of oblast_names."""
    named = F.transform(F.concat(T.all_found(text, BEFORE, 1), T.all_found(text, AFTER, 1)), lambda w: F.substring(F.lower(w), 1, 5))
    cities = exactly_one(T.stems(text, 4), F.col("__cities"))
    return T.let(_codes(named, F.col("__plain")), lambda c: F.when(F.size(c) == 1, F.get(c, F.lit(0))).when(F.coalesce(F.size(c) <= 0, F.lit(True)), cities))


def _by_prefix(districts: DataFrame) -> DataFrame:
    """(__prefix, __districts): the names of each oblast, to be broadcast."""
    stems = T.stems(F.col("name"))
    whole = F.transform(F.filter(T.tokens(F.col("name")), lambda w: F.char_length(w) >= 2), lambda w: F.concat(F.lit("="), w))
    marks = F.when(F.size(stems) > 0, stems).otherwise(whole)
    return districts.select(F.substring("code", 1, 2).alias("__prefix"), F.struct("code", "name", marks.alias("marks")).alias("d")).groupBy("__prefix").agg(F.collect_list("d").alias("__districts"))


def _districts(docs: DataFrame, text: Column, p: str) -> DataFrame:
    """``docs`` (with __districts) and the columns outcome, code, name and candidates, named after ``p``."""
    marks = T.let(without_oblast_phrase(text), lambda x: T.let(T.tokens(x), lambda t: F.array_union(T.prefixes_of(t), F.transform(t, lambda w: F.concat(F.lit("="), w)))))
    met = T.let(marks, lambda m: F.transform(F.filter("__districts", lambda n: F.arrays_overlap(n["marks"], m)), lambda n: F.struct(n["code"].alias("code"), n["name"].alias("name"))))
    found = F.coalesce(F.sort_array(F.array_distinct(met)), F.array().cast("array<struct<code:string,name:string>>"))
    out = docs.withColumn(f"{p}found", found)
    found, a, b = (F.col(f"{p}{c}") for c in ("found", "a", "b"))
    out = out.withColumns({f"{p}a": F.when(F.size(found) > 1, title_kind(text)), f"{p}b": F.when(F.size(found) > 1, body_kind(text))})
    out = out.withColumn(f"{p}same", F.filter(found, lambda c: candidate_kind(c["name"]) == a["kind"]))
    n, same = F.size(found), F.col(f"{p}same")
    outcome = (
        F.when(n == 0, NO_DISTRICT)
        .when(n == 1, MAPPED)
        .when(a.isNull() | b.isNull(), KIND_UNKNOWN)
        .when(T.overlap(a["span"], b["span"]), KIND_UNKNOWN)
        .when(a["kind"] != b["kind"], KIND_DISAGREE)
        .when(F.size(same) == 1, MAPPED)
        .otherwise(SEVERAL)
    )
    out = out.withColumn(f"{p}outcome", outcome)
    narrow = F.when((n > 1) & F.col(f"{p}outcome").isin(MAPPED, SEVERAL) & (F.size(same) > 0), same).otherwise(found)
    out = out.withColumn(f"{p}left", narrow)
    one = F.when(F.col(f"{p}outcome") == MAPPED, F.get(f"{p}left", F.lit(0)))
    return out.withColumns({f"{p}code": one["code"], f"{p}name": one["name"], f"{p}candidates": F.transform(f"{p}left", lambda c: c["name"])})


def district_in_oblast(docs: DataFrame, key: str, text: str, oblast: str, districts: DataFrame) -> DataFrame:
    """(key, outcome, code, name, candidates) for each document with an oblast code.

    districts: (code, name), a small table. Candidates share the code prefix and a stem with the text, less its oblast phrase (a name
    without a stem must be a whole word of it). Several are narrowed by kind only if title and issuing body state the same
    kind by different words. Documents meet the names of their oblast where they lie: nothing but the dimension moves.
    """
    told = docs.select(key, F.col(text).alias("__text"), F.substring(oblast, 1, 2).alias("__prefix")).join(F.broadcast(_by_prefix(districts)), "__prefix", "left")
    names = ("outcome", "code", "name", "candidates")
    return _districts(told, F.col("__text"), "__c_").select(key, *[F.col(f"__c_{n}").alias(n) for n in names])


def map_documents(docs: DataFrame, oblasts: DataFrame, districts: DataFrame, key: str = "document_id") -> DataFrame:
    """docs: (key, decision_ref, sentence, body, title). Adds oblast_code, oblast_source, outcome, code, name, district_source and
    candidates. Dimensions are small tables: (code, name); they are broadcast, and documents are not shuffled."""
    docs = docs.withColumn("__text", F.concat_ws(" ", "decision_ref", "sentence")).crossJoin(F.broadcast(oblast_names(oblasts)))
    docs = docs.withColumns({"__body": oblast_from_body(F.col("body")), "__said": oblast_from_text(F.col("__text"))}).drop("__plain", "__towns", "__cities")
    body, said = F.col("__body"), F.col("__said")
    refusal = (
        F.when(F.col("body").isNull(), NO_BODY)
        .when(said.isNull() & body.isNull(), NO_OBLAST)
        .when(said.isNotNull() & body.isNull(), NO_OBLAST_FROM_BODY)
        .when(said != body, OBLAST_DISAGREE)
    )
    docs = docs.withColumn("__refusal", refusal).withColumn("oblast_code", F.when(refusal.isNull(), body)).withColumn("oblast_source", F.when(refusal.isNull(), F.when(said.isNull(), "body-only").otherwise("both")))
    whole = oblasts.select(F.col("code").alias("oblast_code"), F.col("name").alias("oblast_name"))
    out = docs.join(F.broadcast(whole), "oblast_code", "left")
    out = out.withColumn("__prefix", F.substring("oblast_code", 1, 2)).join(F.broadcast(_by_prefix(districts)), "__prefix", "left")
    known = F.col("oblast_code").isNotNull()
    out = _districts(_districts(out, F.when(known, F.col("__text")), "__c_"), F.when(known, F.col("title")), "__t_")
    top = known & F.col("__districts").isNull()
    cited = lambda name: F.when(known, F.col(f"__c_{name}"))
    title_ok = known & F.col("title").isNotNull() & (F.col("__t_outcome") == MAPPED)
    veto = (cited("outcome") == MAPPED) & title_ok & (F.col("__c_code") != F.col("__t_code"))
    fallback = (cited("outcome") == NO_DISTRICT) & title_ok
    pick = lambda name, level: F.when(F.col("__refusal").isNotNull() | F.coalesce(veto, F.lit(False)), None).when(top, level).when(fallback, F.col(f"__t_{name}")).otherwise(cited(name))
    outcome = F.when(F.col("__refusal").isNotNull(), F.col("__refusal")).when(top, MAPPED).when(veto, TITLE_CONTRADICTS).when(fallback, MAPPED).otherwise(cited("outcome"))
    source = F.when(outcome != MAPPED, None).when(top, "oblast-level").when(fallback, "title").otherwise("citation")
    empty = F.array().cast("array<string>")
    candidates = F.when(top, empty).when(veto, F.concat("__c_candidates", "__t_candidates")).when(fallback, F.col("__t_candidates")).otherwise(F.coalesce(cited("candidates"), empty))
    return out.select(key, "oblast_code", "oblast_name", "oblast_source", outcome.alias("outcome"), pick("code", F.col("oblast_code")).alias("code"), pick("name", F.col("oblast_name")).alias("name"), source.alias("district_source"), candidates.alias("candidates"))


def match_names(texts: DataFrame, key: str, marks: Column, names: DataFrame, name_key: str, name_marks: Column) -> DataFrame:
    """(key, outcome, match, n): one, several or no names that share a mark with a text. Names meet texts once for each set of marks,
    so that repeated names do not multiply."""
    keys = names.where(F.col(name_key).isNotNull()).select(name_key, name_marks.alias("marks")).groupBy(name_key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("marks")))).alias("marks"))
    sets = keys.groupBy("marks").agg(F.count(F.lit(1)).alias("n"), F.min(name_key).alias("match")).withColumn("mark", F.explode("marks"))
    met = texts.select(key, F.explode(marks).alias("mark")).join(sets, "mark").select(key, "marks", "n", "match").distinct()
    hits = met.groupBy(key).agg(F.sum("n").alias("n"), F.min("match").alias("match"))
    out = texts.select(key).join(hits, key, "left")
    n = F.coalesce("n", F.lit(0))
    return out.select(key, F.when(n == 0, "none").when(n == 1, "one").otherwise("several").alias("outcome"), F.when(n == 1, F.col("match")).alias("match"), n.alias("n"))
