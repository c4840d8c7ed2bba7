"""Readers and the consensus ladder on synthetic decisions: each rung with all earlier rungs satisfied."""

import pytest

from attesta.operators import consensus

HEAD = "Решение Северного районного маслихата Озёрной области от 7 ноября 2025 года № 12-3/ IV. "
CLAUSE = "Понизить размер ставки при применении специального налогового режима на основе упрощенной декларации с 4 (четырех) процентов на 3 (три) процента за налоговый период в 2026 году."
TAIL = " Настоящее решение вводится в действие с 1 января 2026 года."
KAZAKH = "мөлшерлемесін 4 (төрт) пайыздан 3 (үш) пайызға төмендетілсін."


def doc(clause=CLAUSE, head=HEAD, tail=TAIL):
    return head + clause + tail


CASES = {
    "plain": (doc(), KAZAKH, None, "confirmed", None),
    "digits only": (doc(CLAUSE.replace("4 (четырех) процентов", "4%").replace("3 (три) процента", "3%").replace(" на 3", " до 3")), KAZAKH, None, "confirmed", None),
    "inner space": (doc(CLAUSE.replace("(три)", "( три)")), KAZAKH, None, "confirmed", None),
    "superseded": ("Утратило силу. " + doc(), KAZAKH, None, "unparsed", "document is amended or repealed:"),
    "two clauses": (doc(CLAUSE + " " + CLAUSE), KAZAKH, None, "unparsed", "no single sentence"),
    "none": (doc("Понизить размер ставки."), KAZAKH, None, "unparsed", "no single sentence"),
    "transport": (doc(), None, "SSLError: x", "conflict", "kazakh could not be fetched"),
    "not published": (doc(), None, "HTTPError: HTTP Error 404: ", "conflict", "kazakh returned HTTP 404"),
    "missing": (doc(), None, None, "conflict", "kazakh could not be fetched"),
    "origin": (doc(CLAUSE.replace("4 (четырех)", "5 (пяти)")), KAZAKH, None, "conflict", "transition objected"),
    "rise": (doc(CLAUSE.replace("4 (четырех) процентов на 3 (три)", "3 (три) процентов на 4 (четыре)")), KAZAKH, None, "conflict", "transition objected"),
    "unknown word": (doc(CLAUSE.replace("(три)", "(трижды)")), KAZAKH, None, "conflict", "word objected"),
    "retail": (doc(CLAUSE.replace("упрощенной декларации", "розничного налога")), KAZAKH, None, "conflict", "regime objected"),
    "both regimes": (doc(CLAUSE.replace("упрощенной", "розничного налога и упрощенной")), KAZAKH, None, "conflict", "regime objected"),
    "other regime": (doc(CLAUSE.replace("на основе упрощенной декларации", "для крестьян")), KAZAKH, None, "conflict", "regime objected"),
    "word differs": (doc(CLAUSE.replace("(три)", "(два)")), KAZAKH, None, "conflict", "readers disagree: 2, 3"),
    "kazakh differs": (doc(), KAZAKH.replace("3 (үш)", "2 (екі)"), None, "conflict", "readers disagree: 2, 3"),
    "kazakh word": (doc(), KAZAKH.replace("(үш)", "(екі)"), None, "conflict", "kazakh objected"),
    "kazakh silent": (doc(), "мәтін", None, "confirmed", None),
    "one source": (doc(CLAUSE.replace(" (три)", "").replace(" (четырех)", "")), "мәтін", None, "unparsed", "only one independent source"),
}


@pytest.fixture(scope="module")
def results(spark):
    rows = [(name, c[0], c[1], c[2]) for name, c in CASES.items()]
    df = spark.createDataFrame(rows, "id string, text string, kazakh_text string, kazakh_error string")
    return {r.id: r for r in consensus.classify(df).collect()}


@pytest.mark.parametrize("name", CASES)
def test_ladder(results, name):
    r, (_, _, _, outcome, reason) = results[name], CASES[name]
    assert r.outcome == outcome
    assert (r.reason is None) if reason is None else r.reason.startswith(reason)
    assert (r.rate is not None) == (outcome == "confirmed")


def test_details(results):
    r = results["plain"]
    assert (str(r.rate), r.year, r.year_source, r.in_force_from) == ("0.03", 2026, "tax-period", "2026-01-01")
    assert [x.rate_percent for x in r.readings] == [3, 3, 3, 3, None]
    assert r.decision_ref == HEAD[: HEAD.index(". ")].strip()
    assert results["retail"].terminal is True and results["origin"].terminal is False and results["plain"].terminal is None


def test_years(spark):
    texts = {
        "tax-period": "ставка за налоговый период в 2027 году.",
        "in-force-date": "решение вводится в действие с 01.01.2026.",
        "retroactive-effect": "и распространяется на правоотношения, возникшие с 1 января 2026 года.",
        "none": "на 2026 год и на 2027 год.",
        "footnote": "вводится в действие с 01.01.2026 в соответствии с пунктом 2 настоящего решения",
        "spring": "вступает в силу с 1 марта 2026 года.",
    }
    from pyspark.sql import functions as F

    from attesta.operators.readers import year

    df = spark.createDataFrame(list(texts.items()), "id string, t string")
    got = {r.id: (r.y.year, r.y.source) for r in df.select("id", year(F.col("t")).alias("y")).collect()}
    assert got == {"tax-period": (2027, "tax-period"), "in-force-date": (2026, "in-force-date"), "retroactive-effect": (2026, "retroactive-effect"), "none": (None, None), "footnote": (None, None), "spring": (None, None)}


def test_each_pattern_reads_a_text_once(spark):
    """Three stated periods, two forms of two dates: a form took three passes, and each value was computed wherever it was named."""
    out = consensus.classify(spark.createDataFrame([("a", "b", None)], "text string, kazakh_text string, kazakh_error string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(text#") == 7
