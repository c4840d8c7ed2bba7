import random

import pytest

from attesta.operators import temporal


def brute(code, at, known, edges):
    seen, hops = set(), 0
    while code not in known:
        if code in seen:
            return None, None, "cycle"
        seen.add(code)
        to = [t for f, t, since in edges if f == code and (since is None or at is None or since <= at)]
        if not to:
            return None, hops, "unknown"
        code, hops = max(to), hops + 1
    return code, hops, "current"


@pytest.mark.parametrize("seed", range(4))
def test_each_row_as_of_its_own_date(spark, seed):
    rng = random.Random(seed)
    codes = [f"c{i:02}" for i in range(30)]
    dates = ["2019-05-01", "2020-01-01", "2021-06-30", "2023-01-01"]
    edges = [(rng.choice(codes), rng.choice(codes), rng.choice([None, *dates])) for _ in range(25 + 10 * seed)]
    known = set(rng.sample(codes, 5))
    rows = [(rng.choice([*codes, "zz", "c01 "]), rng.choice([None, "2018-01-01", "2020-01-01", "2022-02-02", "2024-01-01"])) for _ in range(80)]
    got = temporal.resolve_each(spark.createDataFrame(rows, "code string, at string"), spark.createDataFrame([(k,) for k in known], "code string"), spark.createDataFrame(edges, "retired string, current string, effective_from string"))
    want = {(c.strip(), a): brute(c.strip(), a, known, edges) for c, a in rows}
    assert {(r.code, r.at): (r.resolved, r.hops, r.status) for r in got.collect()} == want


def test_one_code_at_two_dates(spark):
    edges = spark.createDataFrame([("a", "b", "2020-01-01"), ("b", "c", "2022-01-01")], "retired string, current string, effective_from string")
    current = spark.createDataFrame([("c",), ("b2",)], "code string")
    got = temporal.resolve_each(spark.createDataFrame([("a", "2021-01-01"), ("a", "2022-01-01"), ("a", "2019-01-01")], "code string, at string"), current, edges)
    assert {(r.at, r.resolved, r.hops, r.status) for r in got.collect()} == {("2021-01-01", None, 1, "unknown"), ("2022-01-01", "c", 2, "current"), ("2019-01-01", None, 0, "unknown")}


def test_a_long_chain_and_no_edges(spark):
    n = 200
    chain = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}", "2020-01-01") for i in range(n)], "retired string, current string, effective_from string")
    got = temporal.resolve_each(spark.createDataFrame([("0000", "2021-01-01"), ("0000", "2019-01-01")], "code string, at string"), spark.createDataFrame([(f"{n:04}",)], "code string"), chain)
    assert {(r.resolved, r.hops) for r in got.collect()} == {(f"{n:04}", n), (None, 0)}
    none = temporal.resolve_each(spark.createDataFrame([("x", None)], "code string, at string"), spark.createDataFrame([("x",)], "code string"), chain.limit(0))
    assert [tuple(r) for r in none.collect()] == [("x", None, "x", 0, "current")]
