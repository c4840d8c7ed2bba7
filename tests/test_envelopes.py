import json
import random

import pytest
from pyspark.sql import types as T

from attesta.operators.constraints import ConstraintError
from attesta.sources import envelopes

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("more", T.ArrayType(T.StructType([T.StructField("a", T.StringType())])))])


def made(rng, n):
    odd = ['plain', 'brace } and { inside', 'quote " and \\ backslash', '"rows": [{', 'line\nbreak', "ü" * 30, "", "]}" * 5, "\\"]
    return [{"id": i, "title": rng.choice(odd), "more": [{"a": rng.choice(odd)} for _ in range(rng.randint(0, 3))]} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", ["700b", "128m"])
def test_objects_of_split_files(spark, tmp_path, indent, size):
    rng = random.Random(3)
    rows, other, tail = made(rng, 120), made(rng, 40), made(rng, 3)
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.json").write_text(json.dumps({"method": "m } [", "none": [], "rows": rows, "numbers": [1, [2, {"x": 1}]], "n\u00e4 \"x": other}, indent=indent, ensure_ascii=indent is None))
    (tmp_path / "e" / "b.json").write_text(json.dumps({"meta": {"rows": [{"id": -1}]}, "rows": tail}, indent=indent))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        got = envelopes.read_large_envelope(spark, f"{tmp_path}/e", "rows", SCHEMA)
        found = sorted((r.asDict(True) for r in got.collect()), key=str)
        named = envelopes.read_large_envelope(spark, f"{tmp_path}/e/a.json", "n\u00e4 \"x", SCHEMA) if indent is None else None
        assert found == sorted(rows + tail, key=str)
        assert named is None or sorted((r.asDict(True) for r in named.collect()), key=str) == sorted(other, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_missing_and_empty(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"rows": []}')
    assert envelopes.read_large_envelope(spark, f"{tmp_path}/a.json", "rows", SCHEMA).count() == 0
    with pytest.raises(ConstraintError, match="no"):
        envelopes.read_large_envelope(spark, f"{tmp_path}/a.json", "other", SCHEMA)
