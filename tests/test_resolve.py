import pytest

from attesta.operators import resolve, temporal
from attesta.plans import catalogue

OBLASTS = [("270000000", "Озёрная область"), ("390000000", "Степнинская область"), ("710000000", "г.Столичный")]
DISTRICTS = [("271000000", "Прибрежный Г.А."), ("271400000", "Прибрежный район"), ("391000000", "Степнинский район"), ("392000000", "Луговской район"), ("393000000", "Аксу Г.А."), ("394000000", "Луговской Г.А.")]
BODY27, BODY39, BODY71 = "Государственные органы Озёрной области", "Маслихаты Степнинской области", "Органы города Столичный"

# id: (reference, body, title, outcome, code, source)
CASES = {
    "agree": ("Решение маслихата Луговского района Степнинской области", BODY39, None, resolve.KIND_UNKNOWN, None, None),
    "district named as oblast": ("Решение Степнинского районного маслихата Степнинской области", BODY39, None, resolve.MAPPED, "391000000", "citation"),
    "sources differ": ("Решение Степнинского районного маслихата Степнинской области", BODY27, None, resolve.OBLAST_DISAGREE, None, None),
    "no body": ("Решение Степнинского районного маслихата Степнинской области", None, None, resolve.NO_BODY, None, None),
    "body silent": ("Решение Степнинского районного маслихата Степнинской области", "Прочие", None, resolve.NO_OBLAST_FROM_BODY, None, None),
    "neither": ("Решение", "Прочие", None, resolve.NO_OBLAST, None, None),
    "body only": ("Решение Степнинского районного маслихата", BODY39, None, resolve.MAPPED, "391000000", "citation"),
    "city without districts": ("Решение маслихата Столичного", BODY71, None, resolve.MAPPED, "710000000", "oblast-level"),
    "short name": ("Решение маслихата Аксу Степнинской области", BODY39, None, resolve.MAPPED, "393000000", "citation"),
    "two clues": ("Решение Луговского районного маслихата Степнинской области о ставке по Луговскому району", BODY39, None, resolve.KIND_UNKNOWN, None, None),
    "title veto": ("Решение Степнинского районного маслихата Степнинской области", BODY39, "О ставке по Аксу", resolve.TITLE_CONTRADICTS, None, None),
    "title fallback": ("Решение маслихата Степнинской области", BODY39, "О ставке по Аксу", resolve.MAPPED, "393000000", "title"),
}


@pytest.fixture(scope="module")
def mapped(spark):
    docs = spark.createDataFrame([(k, c[0], None, c[1], c[2]) for k, c in CASES.items()], "document_id string, decision_ref string, sentence string, body string, title string")
    names = "code string, name string"
    return {r.document_id: r for r in resolve.map_documents(docs, spark.createDataFrame(OBLASTS, names), spark.createDataFrame(DISTRICTS, names)).collect()}


@pytest.mark.parametrize("name", [c for c in CASES if c != "two clues"])
def test_ladder(mapped, name):
    r, (_, _, _, outcome, code, source) = mapped[name], CASES[name]
    assert (r.outcome, r.code, r.district_source) == (outcome, code, source)


def test_refusals_keep_candidates(mapped):
    assert sorted(mapped["agree"].candidates) == ["Луговской Г.А.", "Луговской район"]
    assert mapped["title veto"].candidates == ["Степнинский район", "Аксу Г.А."]


def test_two_kinds_narrow(spark):
    docs = spark.createDataFrame([("a", "Решение городского маслихата Луговской о размере по городу Луговской", "390000000")], "id string, t string, o string")
    r = resolve.district_in_oblast(docs, "id", "t", "o", spark.createDataFrame(DISTRICTS, "code string, name string")).first()
    assert (r.outcome, r.code) == (resolve.MAPPED, "394000000")


def test_chains(spark):
    codes = spark.createDataFrame([(c,) for c in ("101010000", "632810000", "630000000", "111111111", "999999999", " 750000000 ")], "code string")
    current = spark.createDataFrame([("101010000",), ("750000000",)], "code string")
    edges = spark.createDataFrame([("632810000", "101010000", "2020-01-01"), ("630000000", "632810000", "2024-01-01"), ("111111111", "222222222", ""), ("222222222", "111111111", "")], "retired string, current string, effective_from string")
    got = {r.code: (r.resolved, r.hops, r.status) for r in temporal.resolve(codes, current, edges).collect()}
    assert got["101010000"] == ("101010000", 0, "current") and got["750000000"] == ("750000000", 0, "current")
    assert got["632810000"] == ("101010000", 1, "current") and got["630000000"] == ("101010000", 2, "current")
    assert got["111111111"][2] == "cycle" and got["999999999"] == (None, 0, "unknown")
    late = {r.code: r.status for r in temporal.resolve(codes, current, edges, at="2021-01-01").collect()}
    assert late["630000000"] == "unknown"
    with pytest.raises(LookupError, match="111111111: cycle"):
        temporal.require_resolved(temporal.resolve(codes, current, edges))


def test_levels(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("100000000", "oblast"), ("101000000", "district"), ("101010000", "sub_district"), ("103230100", "settlement"), ("12", None)], "c string, want string")
    assert all(r.got == r.want for r in df.select("want", temporal.level_of(F.col("c")).alias("got")).collect())


def test_block_theta_match_reads_whole_tables(spark, tmp_path):
    docs = [(1, "a Bolt here", 11), (2, "a ring " + "x " * 1000, 2007), (3, "one gear", None), (4, "nothing of it", 13), (5, None, None), (6, "blue plate, blue", 16)]
    parts = [(7, "red bolt"), (150, "blue bolt"), (151, "blue bolt"), (900, "old ring"), (901, "cold gear"), (902, "hot gear"), (903, None), (904, "blue plate")]
    spark.createDataFrame(docs, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.doc_id: (r.outcome, r.match, r.n) for r in catalogue.block_theta_match(spark, str(tmp_path)).collect()}
    assert got == {1: ("several", None, 3), 2: ("one", 900, 1), 3: ("several", None, 2), 4: ("none", None, 0), 5: ("none", None, 0), 6: ("several", None, 3)}


def test_documents_are_not_shuffled(spark):
    """Dimensions are broadcast: no exchange deals documents by their key."""
    names = "code string, name string"
    docs = spark.createDataFrame([("a", "r", "s", "b", "t")], "document_id string, decision_ref string, sentence string, body string, title string")
    out = resolve.map_documents(docs, spark.createDataFrame(OBLASTS, names), spark.createDataFrame(DISTRICTS, names))
    assert "hashpartitioning(document_id" not in out._jdf.queryExecution().executedPlan().toString()
