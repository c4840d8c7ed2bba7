import pytest
from pyspark.sql import functions as F

from attesta.operators import constraints as C
from attesta.operators import gate

GOOD = {"line": 2, "kato": "101010000", "kato_version": "e1", "name_ru": "а", "name_kk": "б", "rate": "0.03", "base_rate": "0.04", "valid_from": "2026-01-01", "valid_to": "2026-12-31", "decision_ref": "Решение № 1", "source_url": f"{C.HOST}rus/docs/A1", "kazakh_source_url": f"{C.HOST}kaz/docs/A1", "extraction_method": "deterministic-readers"}
SCHEMA = "line long, " + ", ".join(f"{k} string" for k in GOOD if k != "line")

BAD = {
    "kato-format": {"kato": "10101000"}, "decision_ref-empty": {"decision_ref": " \t "}, "decision_ref-null-like": {"decision_ref": "None"}, "decision_ref-no-citation": {"decision_ref": "решение 1"},
    "source_url-host": {"source_url": "http://x/"}, "kazakh_source_url-null-like": {"kazakh_source_url": "nan"}, "rate-not-a-number": {"rate": "3%"}, "rate-percentage": {"rate": "3"}, "rate-band": {"rate": "NaN"},
}


def rows(spark, dicts):
    return spark.createDataFrame([tuple(({**GOOD, **d})[k] for k in GOOD) for d in dicts], SCHEMA)


def test_a_good_row_has_no_violation(spark):
    codes = spark.createDataFrame([("101010000",)], "kato string")
    assert C.validate(rows(spark, [{}]), codes).collect() == []


@pytest.mark.parametrize("rule", BAD)
def test_rules(spark, rule):
    assert rule in [r.rule for r in C.row_violations(rows(spark, [BAD[rule]])).collect()]


def test_all_violations_of_a_row(spark):
    got = {r.rule for r in C.row_violations(rows(spark, [{"kato": "x", "rate": "0.5", "source_url": ""}])).collect()}
    assert got == {"kato-format", "rate-band", "source_url-empty"}


def test_intervals(spark):
    df = spark.createDataFrame([(1, "a", "2026-01-01", "2026-12-31"), (2, "a", "2026-02-01", "2026-03-01"), (3, "a", "2026-06-01", "2026-07-01"), (4, "b", "2026-01-01", "2026-01-31"), (5, "b", "2026-01-31", "2026-02-01"), (6, "c", "2026-02-01", "2026-01-01")], "line int, k string, valid_from string, valid_to string")
    assert sorted((r.line, r.rule) for r in C.overlaps(df, ["k"]).collect()) == [(2, "overlap"), (5, "overlap"), (6, "reversed")]
    assert sorted((r.line, r.rule) for r in C.overlaps(df, ["k"], strict=True).collect()) == [(2, "overlap"), (3, "overlap"), (5, "overlap"), (6, "reversed")]


def test_guards(spark):
    old, new = (spark.createDataFrame([(x,) for x in xs], "id string") for xs in ("ab", "ac"))
    with pytest.raises(C.ConstraintError, match="shrink"):
        C.require_no_shrink(old, new, "id")
    C.require_no_shrink(old, new, "id", allow=True)
    with pytest.raises(C.ConstraintError):
        C.require_unique(old.union(old), ["id"])
    with pytest.raises(C.ConstraintError):
        C.require_single(old, "id")
    with pytest.raises(C.ConstraintError):
        C.require_header(old, ["x"])


# id: (model rate, refused, span, text, parser rate, published, outcome)
POLICY = {
    "agree": (0.03, False, "на 3 процента", "ставка на 3 процента", 0.03, True, gate.AGREE),
    "blocked": (0.02, False, "на 2 процента", "ставка на 2 процента", 0.03, False, gate.BLOCKED),
    "flagged": (0.02, False, "на 2 процента", "ставка на 2 процента", 0.03, True, gate.FLAGGED),
    "escalated": (0.02, False, "на 2 процента", "ставка на 2 процента", None, False, gate.ESCALATED),
    "withdrawn": (0.02, False, "на 2 процента", "ставка на 2 процента", None, True, gate.WITHDRAWN),
    "refused": (None, True, None, None, 0.03, True, gate.REFUSED),
    "no text": (0.02, False, "на 2", None, 0.02, True, gate.CANNOT_VERIFY),
    "made up": (0.02, False, "на 2 рубля", "ставка на 2 процента", 0.02, True, gate.REFUSED),
    "no digits": (0.02, False, "ставка", "ставка на 2 процента", 0.02, True, gate.REFUSED),
    "percent": (3.0, False, "3", "3", 0.03, True, gate.REFUSED),
    "band": (0.5, False, "50", "50", 0.03, True, gate.REFUSED),
    "silent": (None, False, None, "x", 0.03, True, gate.REFUSED),
}


def test_gate_policy(spark):
    v = spark.createDataFrame([(k, c[0], c[1], c[2]) for k, c in POLICY.items()], "document_id string, rate double, refused boolean, quoted_span string")
    parsed = spark.createDataFrame([(k, c[4]) for k, c in POLICY.items()], "document_id string, rate double")
    published = spark.createDataFrame([(k,) for k, c in POLICY.items() if c[5]], "document_id string")
    tasks = spark.createDataFrame([(k, c[3]) for k, c in POLICY.items() if c[3]], "document_id string, text string")
    results = gate.compare(v, parsed, published, tasks)
    assert {r.document_id: r.outcome for r in results.collect()} == {k: c[6] for k, c in POLICY.items()}
    with pytest.raises(C.ConstraintError):
        gate.require_verified(results)
    counts = {r.outcome: r.n for r in gate.report(results, v.union(v.withColumn("document_id", F.lit("new")))).collect()}
    assert counts["no-verdict"] == 1 and counts["agree"] == 1


def test_blinding_and_batches(spark):
    tasks = spark.createDataFrame([("a", "u", "t", None, 0.03), ("b", "u", " ", None, 0.03)], "document_id string, source_url string, text string, kazakh_text string, rate double")
    good, missing = gate.tasks_and_missing(tasks)
    assert good.columns == list(gate.TASK_COLUMNS) and [r.document_id for r in missing.collect()] == ["b"]
    with pytest.raises(C.ConstraintError, match="several batches"):
        gate.merge_batches([tasks, tasks])
    assert gate.merge_batches([tasks.limit(1), tasks.where("document_id = 'b'")]).count() == 2


def test_fingerprints(spark):
    a = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for f in (gate.fingerprint, gate.fingerprint_large):
        assert f(a, "k", "v").first() == f(a.orderBy(F.desc("k")).repartition(3), "k", "v").first()
        assert f(a, "k", "v").first() != f(a.withColumn("v", F.lit(1)), "k", "v").first()
