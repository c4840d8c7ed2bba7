import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attesta.operators import lookup, search


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@given(st.text("abé", max_size=14), st.text("abé", min_size=1, max_size=14), st.integers(1, 6))
@settings(max_examples=400, deadline=None)
def test_segments_lose_no_near_term(asked, term, edits):
    if asked and distance(asked, term) <= edits:
        keys = {(edits, len(term), i, term[s : s + n]) for i, (s, n) in enumerate(lookup.cuts(len(term), edits))}
        assert keys & set(lookup.probes(asked, edits))


@given(st.text(min_size=1, max_size=4).filter(lambda x: not any(0xD800 <= ord(c) < 0xE000 for c in x)), st.text(max_size=3).filter(lambda x: not any(0xD800 <= ord(c) < 0xE000 for c in x)))
def test_ranges_hold_what_starts_so(prefix, rest):
    end = lookup.after(prefix)
    assert prefix <= prefix + rest and (end is None or prefix + rest < end)
    assert end is None or not end.startswith(prefix)


@pytest.fixture(scope="module")
def words():
    rng = random.Random(4)
    return sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 12))) for _ in range(600)})


@pytest.fixture(scope="module")
def index(spark, words):
    return search.Index.build(spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, t string"), "id", ["t"])


@pytest.mark.parametrize(("terms", "prefix", "fuzzy"), [(["abca", "b"], True, False), (["abcab", "cabbage"], False, 2), (["acbacbaé", "ab"], [False, True], 6), (["abc"], True, 0.9), (["abcabc", "abc"], False, 0.5)])
def test_as_a_pass_over_all_terms(index, words, terms, prefix, fuzzy):
    got = sorted((r.q, r.term, round(r.weight, 9)) for r in search.expanded(index, terms, prefix, fuzzy).collect())
    want = []
    for q, a, p, k in search.asked_terms(terms, prefix, fuzzy):
        for w in words:
            d = distance(a, w)
            if w == a:
                want.append((q, w, 1.0))
            elif p and w.startswith(a):
                want.append((q, w, round(0.375 * len(w) / (len(w) + 0.3 * (len(w) - len(a))), 9)))
            elif 0 < d <= k:
                want.append((q, w, round(0.45 * len(w) / (len(w) + d), 9)))
    assert got == sorted(want)


def test_plan_has_no_nested_loop(index):
    plan = search.expanded(index, ["abcab", "cab"], [False, True], 2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_parts_are_the_cuts(spark, words):
    for edits in (1, 3, 6):
        got = {(r.term, r["size"], r.i, r.part) for r in lookup.parts(spark.createDataFrame([(w,) for w in words], "term string"), edits).collect()}
        assert got == {(w, len(w), i, w[s : s + n]) for w in words for i, (s, n) in enumerate(lookup.cuts(len(w), edits))}
    assert lookup.parts(spark.createDataFrame([], "term string"), 2).select(F.sum("i")).first()[0] is None


def test_edits_of_bytes(index, words):
    """fuzzy_search told (725, 3.675143) at sf0.1, a near term by characters, which its SQL does not have."""
    got = sorted((r.term, round(r.weight, 9)) for r in search.expanded(index, ["abcéa"], fuzzy=2, by_bytes=True).collect() if r.term != "abcéa")
    apart = {w: distance("abcéa".encode(), w.encode()) for w in words}
    assert got == sorted((w, round(0.45 * len(w) / (len(w) + d), 9)) for w, d in apart.items() if 1 <= d <= 2)
    assert any(distance("abcéa", w) <= 2 < d for w, d in apart.items())
