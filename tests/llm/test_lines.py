import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from attesta.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, n):
    line = list(line)
    for _ in range(n):
        at = rng.randrange(len(line) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            line.insert(at, rng.choice("abé"))
        elif at < len(line):
            line[at : at + 1] = [] if kind == 1 else rng.choice("xyz")
    return "".join(line)


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 5])
def test_banded_distance(spark, edits):
    rng, rows = random.Random(edits), []
    for _ in range(400):
        a = "".join(rng.choice("abcé") for _ in range(rng.choice([rng.randrange(14), rng.randrange(60)])))
        b = edited(rng, a, rng.randrange(6)) if rng.random() < 0.8 else "".join(rng.choice("abcé") for _ in range(len(a) + rng.randrange(-3, 4)))
        rows.append(tuple(sorted((a, b), key=len)))
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    df = df.select("a", "b", lines.distance(a, b, edits).alias("whole"), lines.trimmed(a, b).alias("t"), lines.apart(a, b, F.lit(edits), edits).alias("apart"))
    trims = 0
    for r in df.select("*", lines.distance(F.col("t.a"), F.col("t.b"), edits).alias("cut")).collect():
        want = distance(r.a, r.b)
        assert (r.whole == want and r.cut == want and not r.apart) if want <= edits else min(r.whole, r.cut) > edits, r
        assert not (r.t.a and r.t.b) or (r.t.a[0] != r.t.b[0] and r.t.a[-1] != r.t.b[-1])
        trims += len(r.t.a) < len(r.a)
    assert trims > 200


def brute(docs, edits, min_chars):
    seen, out = [], {}
    for key, text in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        kept, exact, near = [], 0, 0
        for line in text.split("\n"):
            if len(line) >= min_chars:
                if any(abs(len(o) - len(line)) <= edits and 0 < distance(o, line) <= edits for o in seen_first(seen, line)):
                    near += 1
                elif line in seen:
                    exact += 1
                else:
                    kept.append(line)
                seen.append(line)
            else:
                kept.append(line)
        out[key] = (exact, near, "\n".join(kept))
    return out


def seen_first(seen, line):
    """Other lines that first occur before the first occurrence of this one."""
    return set(seen[: seen.index(line)] if line in seen else seen)


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_equals_brute_force(spark, edits):
    rng = random.Random(10 + edits)
    pool = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(3, 30))) for _ in range(25)]
    docs = []
    for key in range(60):
        part = [edited(rng, rng.choice(pool), rng.choice([0, 0, 0, 1, 2, 3])).replace("\n", " ") for _ in range(rng.randrange(5))]
        docs.append((key, "\n".join(part)))
    docs += [(60, None), (61, ""), (62, "\n\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line", F.lit(1)).withColumn("key", F.lit(2))
    got = {r.doc_id: (r["__lines"].exact, r["__lines"].near, r["__lines"].kept) for r in lines.deduplicated(df, edits=edits, min_chars=5).collect()}
    want = brute(docs, edits, 5)
    assert got.pop(60) == (0, 0, None)
    assert got == want


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "a line that is long"), (1, "a line that is long"), (None, "a line that is lung")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r["__lines"].kept) for r in lines.deduplicated(df).collect()) == [(0, "a line that is lung"), (1, ""), (1, "")]
    assert lines.deduplicated(df.limit(0)).count() == 0


def test_query(spark, tmp_path):
    text = "the same line of text\nshort\nanother line of text"
    spark.createDataFrame([(1, text), (2, "the same line of text\nanother line of test")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in lines.op9_line_dedup(spark, str(tmp_path)).collect()}
    assert (rows[1].n_lines, rows[1].n_exact, rows[1].n_near, rows[1].kept_sha256) == (3, 0, 0, hashlib.sha256(text.encode()).hexdigest())
    assert (rows[2].n_exact, rows[2].n_near, rows[2].kept_sha256) == (1, 1, hashlib.sha256(b"").hexdigest())


def near(a, b):
    """By the definition: within the edits of the shorter one, or one stretch, if the first or last segment is shared."""
    a, b = sorted((a, b), key=len)
    of = len(a) - len(a) % (8 if len(a) < 64 else 16)
    reach = next(e for at, e in reversed(lines.REACH) if of >= at)
    size = of // (lines.EDITS + 1)
    if distance(a, b) <= lines.EDITS:
        return True
    front = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    back = next((i for i, (x, y) in enumerate(zip(a[front:][::-1], b[front:][::-1])) if x != y), len(a) - front)
    return len(b) - front - back <= reach and (a[:size] == b[:size] or a[len(a) - size :] == b[len(b) - size :])


def test_replaced_words(spark):
    """By brute force; a replaced word is found."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 6)))
    pool = [[word() for _ in range(rng.randrange(3, 60))] for _ in range(12)]
    docs = []
    for key in range(60):
        part = []
        for _ in range(3):
            words = list(rng.choice(pool))
            words[rng.randrange(len(words))] = word()
            part.append(edited(rng, " ".join(words), rng.choice([0, 0, 0, 1, 1])))
        docs.append((key, "\n".join(part)))
    first, goes = {}, {}
    for key, text in docs:
        for at, line in enumerate(text.split("\n")):
            if len(line) >= lines.MIN_CHARS:
                first.setdefault(line, (key, at))
    for line, at in first.items():
        goes[line] = any(earlier < at and other != line and near(other, line) for other, earlier in first.items() if abs(len(other) - len(line)) <= 7)
    want = {key: sum(goes.get(line, False) for line in text.split("\n")) for key, text in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r["__lines"].near for r in lines.deduplicated(df).collect()} == want
    assert sum(want.values()) > 15


def test_clashing_names_and_long_texts(spark):
    long = "\n".join(f"line number {i * 7919 % 100_003} of a long text" for i in range(20_000))
    rows = [(1, long, "x", 1), (2, "y" * 300_000 + "\n" + long[:2_000], "x", 2), (3, "y" * 299_999 + "zz", "x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, near string, gone long").withColumn("key", F.lit(1)).withColumn("row", F.lit(2)).withColumn("__key", F.lit(3))
    got = {r.doc_id: r for r in lines.deduplicated(df, edits=0, into="of").collect()}
    assert got[1]["of"].kept == long and got[2]["of"].exact > 50 and got[3]["of"].kept == rows[2][1] and got[3].gone == 3 and got[3]["row"] == 2
    near = {r.doc_id: r["__lines"].near for r in lines.deduplicated(df.where("doc_id > 1")).collect()}
    assert near[3] == 1
    with pytest.raises(ValueError, match="has a column"):
        lines.deduplicated(df, into="GONE")


def test_query_replaced_word(spark, tmp_path):
    text = "some words before ouerly {} ou thinstsh ershshor and some words after"
    spark.createDataFrame([(1, text.format("of")), (2, text.format("a")), (3, text.format("hadno")), (4, text.format("entirely"))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_near for r in lines.op9_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 1, 3: 1, 4: 0}


@pytest.mark.parametrize("hot", [2, 16])
def test_many_variants_of_a_line(spark, monkeypatch, hot):
    """Hot buckets: the earliest line first; by brute force. Some variants are near others only."""
    monkeypatch.setattr(lines, "HOT", hot)
    rng = random.Random(hot)
    base = "the quick brown foxes jump over {} lazy dogs and the {} cats, again and again, until {} all sleep"
    docs = [(k, base.format(rng.choice(["many", "some", "few", f"n{k}"]), rng.choice(["old", f"x{k}", "fat", "red"]), rng.choice(["they", "they", f"m{k}"]))) for k in range(120)]
    rng.shuffle(docs)
    first = {}
    for k, t in sorted(docs):
        first.setdefault(t, (k, 0))
    want = {k: int(any(p < first[t] and o != t and near(o, t) for o, p in first.items())) for k, t in docs}
    got = {r.doc_id: r["__lines"].near for r in lines.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and 20 < sum(want.values()) < 120


def test_the_distance_decides(spark, monkeypatch):
    """At the registered parameters the bit-parallel distance accepts every line that goes as near, and refuses others that reach it."""
    rows, real = [], lines.stored

    def stored(df, name, **options):
        out = real(df, name, **options)
        if name == "both":
            rows.extend(out.collect())
        return out

    monkeypatch.setattr(lines, "stored", stored)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 7)))
    base = [" ".join(word() for _ in range(12)) for _ in range(20)]
    docs = [(i, b) for i, b in enumerate(base)]
    docs += [(100 + i, b[:30] + "x" + b[31:]) for i, b in enumerate(base)]  # one edit
    docs += [(200 + i, b[:40] + "zq" + b[42:]) for i, b in enumerate(base)]  # one stretch
    docs += [(300 + i, b[:41] + "y" + b[42:51] + "y" + b[52:]) for i, b in enumerate(base)]  # two edits, too far from each other
    out = {r.doc_id: r["__lines"].near for r in lines.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(out[100 + i] == 1 and out[200 + i] == 1 and out[300 + i] == 0 for i in range(20))
    told = [distance(r.a, r.b) <= (max(r.reach, r.edits) if len(r.b) <= r.reach else r.edits) for r in rows]
    assert sum(told) >= 40 and told.count(False) > 0


def test_variants_at_different_places_make_few_pairs(spark, monkeypatch):
    """Long variants of a line that is itself not the earliest: by brute force, and pairs only of those that differ at close places."""
    pairs, real = [], lines.stored

    def stored(df, name, **options):
        out = real(df, name, **options)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(lines, "stored", stored)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(64)]
    changed = [(k, 34 + k % 30) for k in range(90)]
    docs = [(k, " ".join([*words[:at], f"x{k:04}", *words[at + 1 :]])) for k, at in changed] + [(60.5, " ".join(words))]
    docs = [(int(2 * k), text) for k, text in docs]
    want = {k: int(any(p < k and near(o, t) for p, o in docs)) for k, t in docs}
    got = {r.doc_id: r["__lines"].near for r in lines.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want and sum(want.values()) == 61
    assert sum(pairs) < 600, pairs


def test_stores_no_texts_of_lines_without_pairs(spark, monkeypatch):
    """Disk: what is kept of a line that meets no other is of a fixed size, whatever its length; lines that meet keep their result."""
    sizes, real = {}, lines.stored

    def stored(df, name, **options):
        out = real(df, name, **options)
        sizes[name] = max(sizes.get(name, 0), sum(f.stat().st_size for f in Path(out._stored_at).glob("*.parquet")))
        return out

    monkeypatch.setattr(lines, "stored", stored)
    rng = random.Random(11)
    docs = [(i, "\n".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß 0123456789", k=2_000)) for _ in range(10))) for i in range(200)]
    first = docs[7][1].split("\n")[3]
    docs += [(1_000, first[:900] + "#" + first[901:]), (1_001, first), (None, first[:300] + "#" + first[301:])]
    got = {r.doc_id: (r["__lines"].near, r["__lines"].exact) for r in lines.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {k: v for k, v in got.items() if v != (0, 0)} == {7: (1, 0), 1_000: (1, 0), 1_001: (1, 0)}
    assert max(sizes.values()) < sum(len(text) for _, text in docs) / 4, sizes


def test_finer_outlines_let_near_lines_meet(spark):
    """Lines that differ in one stretch anywhere, of bytes or wider letters, are alike; most lines of bytes that differ at two places (by two bits a part: nine in sixteen) are not."""
    rng, rows = random.Random(5), []
    steps, far = lines.by_class(lines.EDITS), lines.by_class(lines.REACH)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    for i in range(600):
        letters = "abcdefgh " if i % 2 else rng.choice(["abcdefgh ", "abcé ", "жщыü "])
        base = text(rng.randrange(112, 560), letters)
        at = rng.choice([0, len(base), rng.randrange(len(base))])
        out = rng.randrange(min(8, len(base) - at + 1))
        other = base[:at] + text(rng.randrange(8), letters) + base[at + out :]
        if i % 2:
            places = rng.sample(range(0, len(base) - 40, 40), 2)
            other = "".join("x" if k in places else c for k, c in enumerate(base))
        rows += [(i, side, line, min(len(base), len(other))) for side, line in zip("uv", sorted((base, other), key=len))]
    df = spark.createDataFrame(rows, "i int, side string, line string, shorter int")
    of = lines.length_class(F.col("shorter"))
    halves = [lines._fine(of, front, half, steps, far, True).alias(f"f{side}{half}") for side, front in (("s", True), ("t", False)) for half in (0, 1)]
    fine = df.select("i", "side", *halves, lines._least_parts(of, F.col("shorter"), steps, far, True).alias("least")).cache()
    named = lambda side: fine.where(F.col("side") == side).select("i", *[F.col(c).alias(c + side) for c in ("fs0", "fs1", "ft0", "ft1", "least")])
    alike = {r.i: r.alike for r in named("u").join(named("v"), "i").select("i", lines._finely_alike().alias("alike")).collect()}
    assert all(alike[i] for i in range(0, 600, 2)) and sum(alike[i] for i in range(1, 600, 2)) < 200
