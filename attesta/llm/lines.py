"""Line dedup by a segment-partition edit join, with DataFrame functions only.

An occurrence of a line goes if an earlier occurrence (by key, then line number) of another line is near; repeated lines are at
distance 0. Two lines are near within ``edits`` insertions, deletions or substitutions; and also if they share their first or their last
segment and differ in one stretch only, of at most ``reach`` characters in either: so a replaced word is found. Both are
numbers, or numbers by length class of the shorter line. Lines shorter than ``min_chars`` characters, blank ones included, always stay.

Lines are classed by length, in steps of STEP. A line of a class with e edits gives e + 1 index rows, one for each segment: the first
half of the segments lies at fixed places from the start, the other half at fixed places from the end. Of two lines within the
distance one half has no more edits than segments less one, and so a segment i, counted from the outer end, that is unchanged after exactly i
edits: it lies in the longer line at most i characters off. So each line gives probe rows for its own class and, where a line of
the next lower one may be near, for that. Rows meet on a hash of (class, segment, substring). The join's condition also compares lengths and, so that groups of lines which share a segment and nothing else
make no pairs, counts of frequent letters, of which an edit changes at most two by one; or, if all near lines differ in one stretch of no
more than an eighth, hashes of eighths of the line, laid from the start and from the end: the first ones and the last ones that two such lines
share are six or more. The pairs' common ends are cut off. A rest that is short enough is
one stretch; what counts of letters, or parts that have to be found at their places, tell apart is left out; the others are verified by a banded
bit-parallel edit distance: one band of 2 * edits + 2 bits in a long, a step for each character. One near earlier line is enough for a line to
go: in a bucket of over HOT lines the earliest meets the others first, and two lines that go because of such do not meet, so that
variants of one line make pairs in proportion to their number. Lines of such buckets are told apart by finer outlines too, of 32 or 64 parts:
variants that differ from a common line at different places then make no pairs, unless the places are close.

Equal lines meet once: the join runs on distinct lines, and every join on hot lines is one that can be split. What is shuffled and stored of a line
are hashes, outlines and its first place; texts of lines that stand in pairs or in hot buckets are read again where they lie (shuffled by hash, if they are
over BROADCAST_IDS). Texts are shuffled once, at the end, with the numbers of the lines that go.

Null texts stay null and have no lines. A text of which no line is left becomes empty; an empty table gives an empty result. Rows with equal keys
count as one document: their equal lines at equal places are one occurrence, and all of them lose what one loses. A null key sorts
first. Ties cannot be: two occurrences differ in key or number. Long texts take memory for their lines, long lines for the steps of their distance.
Extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, scratch, stored, table

#: Edits that lines allow; (length, characters) of the stretch for lines of that many characters or more.
EDITS, REACH, MIN_CHARS = 1, ((0, 1), (24, 2), (32, 3), (40, 4), (56, 6), (80, 7)), 10
Edits = int | tuple[tuple[int, int], ...]
#: Ids are broadcast if they are at most so many; lines of a bucket beyond which its earliest one is tried first.
BROADCAST_IDS, HOT = 200_000, 16
#: Letters that are counted for the join's condition, and bits for a count, a length and a number of edits.
LETTERS, BITS, LENGTH_BITS, EDITS_BITS = "etaonris", 6, 5, 4
#: Characters that are counted in what pairs differ in.
COUNTED = "abcdefghijklmnopqrstuvwxyz ,.áàäçéèêíïñóöúüß"
#: Length classes are multiples of STEP, from LONG characters on of 2 * STEP; two lines within the distance are in one or in neighbouring classes.
STEP, LONG = 8, 64
#: Common ends of two lines are cut off before their distance is taken, up to 2 ** TRIM - 1 characters of each.
TRIM = 24


def occurrences(df: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(key, at, line)"""
    lines = df.select(F.col(key).alias("key"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "line"))
    return lines.where(F.char_length("line") >= min_chars)


def _hashes() -> list[Column]:
    """Two hashes name a line; the first one alone in pairs."""
    return [F.xxhash64("line").alias("id"), F.xxhash64(F.lit(7), F.col("line")).alias("b")]


def length_class(length: Column) -> Column:
    return F.when(length < LONG, length - length % STEP).otherwise(length - length % (2 * STEP))


def by_class(edits: Edits) -> tuple[tuple[int, int], ...]:
    """Edits as (least length, edits), in order."""
    steps = ((0, edits),) if isinstance(edits, int) else tuple(sorted(edits))
    allowed = [e for _, e in steps]
    if steps[0][0] > 0 or any(at % STEP or (at > LONG and at % (2 * STEP)) for at, _ in steps) or allowed != sorted(allowed) or not 0 <= allowed[0] <= allowed[-1] < STEP:
        raise ValueError(f"edits must start at 0, change with length classes, not fall, and be less than {STEP}: {edits}")
    return steps


def edits_for(length: Column, steps: tuple[tuple[int, int], ...]) -> Column:
    return reduce(lambda out, step: F.when(length >= step[0], step[1]).otherwise(out), steps[1:], F.lit(steps[0][1]))


def _segments(edits: int) -> list[tuple[bool, int]]:
    """(whether it is counted from the start, number) of the segments: of both halves together, one has fewer edits than segments."""
    front = (edits + 2) // 2
    return [(True, i) for i in range(front)] + [(False, i) for i in range(edits + 1 - front)]


def _windows(of: Column, edits: Column, most: int, name: str) -> list[Column]:
    """For each segment of a line (columns line, n) in the length class ``of``, that class allowing ``edits``: where it starts and its
    length (null if the class has no such segment), and the characters that it and its shifts cover."""
    out = []
    for k, (front, i) in enumerate(_all_segments(most)):
        own = F.floor((edits + 2) / 2) if front else F.floor((edits + 1) / 2)
        start, stop = (F.floor(of * j / (edits + 1)).cast("int") for j in (i, i + 1))
        at = F.when(own > i, start if front else F.col("n") - stop)
        out += [at.alias(f"{name}{k}_at"), (stop - start).alias(f"{name}{k}_size")]
        low = F.greatest(at - i, F.lit(0))
        out.append(F.substring(F.col("line"), low + 1, at + (stop - start) + i - low).alias(f"{name}{k}"))
    return out


def _all_segments(most: int) -> list[tuple[bool, int]]:
    return [(True, i) for i in range((most + 2) // 2)] + [(False, i) for i in range((most + 1) // 2)]


def _buckets(of: Column, most: int, name: str) -> list[Column]:
    """Hashes of (class, segment, substring), or null, from the columns of _windows: one for each segment and shift, named as _names tells."""
    out = []
    for k, (front, i) in enumerate(_all_segments(most)):
        at, size, window = (F.col(f"{name}{k}{x}") for x in ("_at", "_size", ""))
        for shift in range(-i, i + 1):
            fits = (at + shift >= 0) & (at + shift + size <= F.col("n"))
            part = F.substring(window, at + shift - F.greatest(at - i, F.lit(0)) + 1, size) if i else window
            out.append(F.when(fits, F.xxhash64(of, F.lit(i if front else -1 - i), part)).alias(f"{name}{k}_{shift + i}"))
    return out


def _names(most: int, name: str, shifts: bool) -> list[str]:
    """Names of the hashes in a table of lines: of all shifts, or of the segments at their own places."""
    return [f"{name}{k}_{shift}" for k, (_, i) in enumerate(_all_segments(most)) for shift in (range(2 * i + 1) if shifts else (i,))]


def _outline(of: Column, front: bool) -> Column:
    """Eight bytes, hashes of bytes of the line: as many eighths of the class's length, from the start or from the end. A line has at least
    as many bytes beside a stretch as characters, so that the bound on eighths holds for bytes too."""
    raw, out = F.col("line").cast("binary"), F.lit(0).cast("long")
    size = (of / 8).cast("int")
    for k in range(8):
        at = size * k if front else F.octet_length("line") - size * (k + 1)
        out = out.bitwiseOR(F.shiftleft(F.xxhash64(F.substring(raw, at + 1, size)).bitwiseAND(F.lit(255)), 56 - 8 * k))
    return out


def _fine(of: Column, front: bool, half: int, steps: tuple[tuple[int, int], ...], reach: tuple[tuple[int, int], ...], always: bool) -> Column:
    """As _outline, but hashes of two bits of as many parts as _parts tells, which cover the longest lines that the class meets; 32 parts of them, the first
    ones or (``half`` is 1) the others. Zero where there are none."""
    raw, parts = F.col("line").cast("binary"), _parts(of, steps, reach, always)

    def outline(n: int) -> Column:
        size = _size(of, n)

        def step(out: Column, k: Column) -> Column:
            at = size * k if front else F.octet_length("line") - size * (k + 1)
            return F.shiftleft(out, 2).bitwiseOR(F.xxhash64(F.substring(raw, F.greatest(at, F.lit(0)) + 1, size)).bitwiseAND(F.lit(3)))

        return F.aggregate(F.sequence(F.lit(32 * half), F.lit(32 * half + 31)), F.lit(0).cast("long"), step)

    few = F.lit(0).cast("long") if half else F.when(parts == 32, outline(32)).otherwise(F.lit(0).cast("long"))
    return F.when(parts == 64, outline(64)).otherwise(few)


def _size(of: Column, parts: Column | int) -> Column:
    """Of a part of a finer outline, in bytes."""
    return F.floor((of + 3 * STEP) / parts).cast("int") + 1


def _parts(of: Column, steps: tuple[tuple[int, int], ...], reach: tuple[tuple[int, int], ...], always: bool) -> Column:
    """Into how many parts the finer outlines of a class are cut; zero: none."""
    stretch = F.greatest(edits_for(of, reach), edits_for(of, steps))
    return F.when(~_outlined(of, steps, reach, always), 0).when(stretch * 32 <= of, 64).when(stretch * 16 <= of, 32).otherwise(0)


def _least_parts(of: Column, n: Column, steps: tuple[tuple[int, int], ...], reach: tuple[tuple[int, int], ...], always: bool) -> Column:
    """How many parts a line of n characters, at least, shares with a line as long or longer that differs from it in one stretch only, from the start and from
    the end together: all bytes beside the stretch, of which at either end less than a part is lost."""
    parts, stretch = _parts(of, steps, reach, always), F.greatest(edits_for(of, reach), edits_for(of, steps))
    size = _size(of, F.greatest(parts, F.lit(1)))
    return F.least(parts, F.floor((n - stretch - size + 1) / size).cast("int"))


def _same_parts(side: str) -> Column:
    """How many leading parts of the finer outlines from one side the rows u and v share."""

    def same(half: int) -> Column:
        x = F.col(f"f{side}{half}u").bitwiseXOR(F.col(f"f{side}{half}v"))
        return F.when(x == 0, 32).otherwise(F.floor((64 - F.char_length(F.bin(x))) / 2))

    first = same(0)
    return first + F.when(first == 32, same(1)).otherwise(0)


def _finely_alike() -> Column:
    """Whether finer outlines let a probing line v differ from u in one stretch only."""
    return (F.col("leastu") <= 0) | (_same_parts("s") + _same_parts("t") >= F.col("leastu"))


def _told(lines: DataFrame, steps: tuple[tuple[int, int], ...], far: tuple[tuple[int, int], ...], min_chars: int) -> DataFrame:
    """(key, at, id, b) of occurrences (key, at, line), and all that the joins by bucket need of a line, in place of its text: marks, outlines in its own class
    (o_s, o_t) and in the next lower one where a line of that may be near (l_s, l_t), hashes of the segments in both."""
    most, n = steps[-1][1], F.char_length("line")
    always = _always_outlined(steps, far, min_chars)
    lower = length_class(F.greatest(F.col("n") - edits_for(F.col("n"), far), F.lit(0)))
    numbers = lines.select("key", "at", "line", n.alias("n")).select("*", length_class(F.col("n")).alias("own"), lower.alias("least"))
    lettered = None if always else ~(_outlined(F.col("own"), steps, far, False) & _outlined(F.col("least"), steps, far, False))
    marks = _marks(F.col("line"), F.col("n"), edits_for(F.col("n"), far), lettered).alias("marks")
    classes = numbers.select("*", *_hashes(), marks, F.when(F.col("least") < F.col("own"), F.col("least")).alias("lower"))
    outlines = [c for x, of in (("o", "own"), ("l", "lower")) for c in _outlines(F.col(of), _outlined(F.col(of), steps, far, always), x)]
    windows = [c for x, of in (("o", "own"), ("l", "lower")) for c in _windows(F.col(of), edits_for(F.col(of), steps), most, x)]
    cut = classes.select("key", "at", "id", "b", "n", "own", "lower", "marks", *outlines, *windows)
    return cut.select("key", "at", "id", "b", "marks", "o_s", "o_t", "l_s", "l_t", *_buckets(F.col("own"), most, "o"), *_buckets(F.col("lower"), most, "l"))


def _buckets_of(each: DataFrame, most: int, probe: bool) -> DataFrame:
    """(bucket, id) of the index or probe rows of lines."""
    names = _names(most, "o", probe) + (_names(most, "l", True) if probe else [])
    return each.select("id", F.explode(F.array(*names)).alias("bucket")).where("bucket is not null")


def _rows(each: DataFrame, most: int, probe: bool, name: str, fine: bool = False) -> DataFrame:
    """(bucket, id, marks, outlines from the start and from the end), named after ``name``, of the index or probe rows of lines; with
    ``fine`` also the halves of the finer outlines and how many of their parts are shared at least."""
    more = ("fs0", "fs1", "ft0", "ft1", "least") if fine else ()
    of = [("o", b) for b in _names(most, "o", probe)] + [("l", b) for b in _names(most, "l", True) if probe]
    rows = [F.struct(F.col(b).alias("bucket"), *[F.col(f"{x}_{c}").alias(c) for c in ("s", "t", *more)]) for x, b in of]
    told = each.select("id", "marks", F.inline(F.array(*rows))).where("bucket is not null")
    return told.select("bucket", F.col("id").alias(name), F.col("marks").alias(f"m{name}"), *[F.col(c).alias(f"{c}{name}") for c in ("s", "t", *more)])


def _with_fine(each: DataFrame, texts: DataFrame, steps: tuple[tuple[int, int], ...], far: tuple[tuple[int, int], ...], min_chars: int) -> DataFrame:
    """Lines with the finer outlines in both classes, and how many of their parts near lines share at least."""
    always = _always_outlined(steps, far, min_chars)
    n = F.char_length("line")
    lower = length_class(F.greatest(n - edits_for(n, far), F.lit(0)))
    classes = texts.select("id", "h", "line", length_class(n).alias("own"), lower.alias("least")).select("*", F.when(F.col("least") < F.col("own"), F.col("least")).alias("lower"))
    make = {f"f{side}{half}": lambda of, front=front, half=half: _fine(of, front, half, steps, far, always) for side, front in (("s", True), ("t", False)) for half in (0, 1)}
    make["least"] = lambda of: _least_parts(of, n, steps, far, always)
    fine = classes.select(F.col("id").alias("of"), F.col("h.b").alias("of_b"), *[f(F.col(of)).alias(f"{x}_{c}") for x, of in (("o", "own"), ("l", "lower")) for c, f in make.items()])
    return each.join(fine, (each["id"] == fine["of"]) & (each["b"] == fine["of_b"])).drop("of", "of_b")


def _always_outlined(steps: tuple[tuple[int, int], ...], reach: tuple[tuple[int, int], ...], min_chars: int) -> bool:
    """Whether _outlined holds for all classes."""
    return steps[-1][1] <= 1 and min_chars > STEP and all(e * 8 <= max(at, STEP) for at, e in (*steps, *reach))


def _outlined(of: Column, steps: tuple[tuple[int, int], ...], reach: tuple[tuple[int, int], ...], always: bool) -> Column:
    """Whether near lines of a class differ in one stretch, no longer than an eighth."""
    if always:
        return F.lit(True)
    return F.lit(steps[-1][1] <= 1) & (of > 0) & (F.greatest(edits_for(of, reach), edits_for(of, steps)) * 8 <= of)


def _outlines(of: Column, outlined: Column, name: str) -> list[Column]:
    """Both outlines; zeros, which tell nothing apart, where they have no bound."""
    return [F.when(outlined & of.isNotNull(), _outline(of, front)).otherwise(F.lit(0).cast("long")).alias(f"{name}_{side}") for front, side in ((True, "s"), (False, "t"))]


def _same_eighths(a: Column, b: Column) -> Column:
    """How many leading bytes two outlines share."""
    x = a.bitwiseXOR(b)
    return reduce(lambda n, k: n + F.when(F.shiftrightunsigned(x, 64 - 8 * k) == 0, 1).otherwise(0), range(1, 9), F.lit(0))


def _marks(line: Column, n: Column, edits: Column, lettered: Column | None) -> Column:
    """Length, edits and, of lines that need them, counts of the letters, each modulo its bits, packed."""
    out = n.bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)).cast("long").bitwiseOR(F.shiftleft(edits.cast("long"), LENGTH_BITS))
    if lettered is None:
        return out
    letters = F.lit(0).cast("long")
    for i, c in enumerate(LETTERS):
        count = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c)))).bitwiseAND(F.lit((1 << BITS) - 1)).cast("long")
        letters = letters.bitwiseOR(F.shiftleft(count, LENGTH_BITS + EDITS_BITS + BITS * i))
    return F.when(lettered, out.bitwiseOR(letters)).otherwise(out)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _apart(a: Column, b: Column) -> Column:
    """At most the sum of the counts' differences."""
    out = F.lit(0).cast("long")
    for i in range(len(LETTERS)):
        at = LENGTH_BITS + EDITS_BITS + BITS * i
        d = F.abs(F.shiftright(a, at).bitwiseAND(F.lit((1 << BITS) - 1)) - F.shiftright(b, at).bitwiseAND(F.lit((1 << BITS) - 1)))
        out = out + F.least(d, F.lit(1 << BITS) - d)
    return out


def _may_be_near(u: Column, mu: Column, v: Column, mv: Column) -> Column:
    """Whether lengths and letters, or outlines, let the probing line v be near u, which is shorter, or as long and less."""
    longer = (mv - mu).bitwiseAND(F.lit((1 << LENGTH_BITS) - 1))
    edits = F.shiftright(mu, LENGTH_BITS).bitwiseAND(F.lit((1 << EDITS_BITS) - 1))
    outlined = (F.col("su") != 0) | (F.col("tu") != 0)
    alike = F.when(outlined, _same_eighths(F.col("su"), F.col("sv")) + _same_eighths(F.col("tu"), F.col("tv")) >= 6).otherwise(_apart(mu, mv) <= 2 * edits)
    return (longer <= edits) & ((longer > 0) | (u < v)) & alike


def _alike(mu: Column, mv: Column) -> Column:
    """The same of two lines in any order."""
    low = F.lit((1 << LENGTH_BITS) - 1)
    eu, ev = (F.shiftright(m, LENGTH_BITS).bitwiseAND(F.lit((1 << EDITS_BITS) - 1)) for m in (mu, mv))
    sizes = ((mv - mu).bitwiseAND(low) <= eu) | ((mu - mv).bitwiseAND(low) <= ev)
    outlined = (F.col("su") != 0) | (F.col("tu") != 0)
    same = _same_eighths(F.col("su"), F.col("sv")) + _same_eighths(F.col("tu"), F.col("tv")) >= 6
    return sizes & F.when(outlined, same).otherwise(_apart(mu, mv) <= 2 * F.greatest(eu, ev))


def _common(a: Column, b: Column, front: bool) -> Column:
    """How many leading (or last) characters two texts share, up to 2 ** TRIM - 1: found by bisection."""
    part = F.left if front else F.right
    out, least = F.lit(0), F.least(F.char_length(a), F.char_length(b))

    def longer(step: int):
        def of(s: Column) -> Column:
            x = s["x"] + step
            return F.when((x <= s["most"]) & (part(a, x) == part(b, x)), x).otherwise(s["x"])

        return of

    for k in range(TRIM - 1, -1, -1):
        out = _let(F.struct(out.alias("x"), least.alias("most")), longer(1 << k))
    return out


def distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance where it is at most ``edits``, else a larger number: a is the shorter text, or as long.

    Bit k of the band at column j stands for row j + edits + 1 - width + k; the carry beyond the band is cut off, and out
    of the band rows cost more than is allowed. Before both texts stand the same edits + 1 characters, so that the band starts inside.
    The tracked value, on the band's lowest diagonal, never falls, and no value of a column is less than it by more than 2 * edits + 1;
    later, in the last row, each step takes at most one off. So steps end their work where it is more than 3 * edits + 1.
    """
    width = 2 * edits + 2
    full, top = (1 << width) - 1, width - 1
    word = lambda x: F.lit(x).cast("long")
    same = F.lit("\n" * (edits + 1))
    a, b = F.concat(same, a), F.concat(same, b)
    m, n = F.char_length(a), F.char_length(b)

    def step(state: Column, j: Column) -> Column:
        at = lambda k: F.get(state["s"], j + (edits + 1 - width + k))
        same = _let(F.get(state["t"], j), lambda c: reduce(lambda p, q: p.bitwiseOR(q), [F.when(at(k) == c, word(1 << k)).otherwise(word(0)) for k in range(width)]))
        bit = lambda w, i: F.call_function("shiftright", w, i).bitwiseAND(word(1))
        vp, vn = state["vp"], state["vn"]
        along = lambda x: (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(word(full))
        d0 = _let(same, along)

        def rest(d0: Column) -> Column:
            hp = vn.bitwiseOR(d0.bitwiseOR(vp).bitwiseXOR(word(full)))
            return F.struct(d0.alias("d0"), hp.alias("hp"), d0.bitwiseAND(vp).alias("hn"), F.shiftright(d0, 1).alias("right"))

        def out(h: Column) -> Column:
            row = (F.lit(top - 1) - (j - (state["m"] - edits))).cast("int")
            down = F.when(row >= 0, bit(h["hp"], F.greatest(row, F.lit(0))) - bit(h["hn"], F.greatest(row, F.lit(0)))).otherwise(word(0))
            return F.struct(
                state["s"].alias("s"), state["t"].alias("t"), state["m"].alias("m"),
                h["hn"].bitwiseOR(h["right"].bitwiseOR(h["hp"]).bitwiseXOR(word(full))).alias("vp"), h["right"].bitwiseAND(h["hp"]).alias("vn"),
                (state["d"] + F.when(j < state["m"] - edits, word(1) - bit(h["d0"], F.lit(top))).otherwise(down)).alias("d"),
            )

        return F.when(state["d"] > 3 * edits + 1, state).otherwise(_let(_let(d0, rest), out))

    start = F.struct(F.split(a, "").alias("s"), F.split(b, "").alias("t"), m.alias("m"), word(full & ~((1 << (width - edits - 1)) - 1)).alias("vp"), word(0).alias("vn"), word(edits).alias("d"))
    counted = F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda state: F.when(state["d"] > 3 * edits + 1, word(edits + 1)).otherwise(state["d"]))
    return F.when(n - m <= edits, counted).otherwise(word(edits + 1))


def trimmed(a: Column, b: Column) -> Column:
    """Struct (a, b) of two texts without the characters that both start or end with: what is left has the same edit distance."""

    def rest(s: Column) -> Column:
        whole = F.struct(s["a"].alias("a"), s["b"].alias("b"), _common(s["a"], s["b"], False).alias("back"))
        return _let(whole, lambda s: F.struct(*(F.left(s[x], F.char_length(s[x]) - s["back"]).alias(x) for x in "ab")))

    def front(s: Column) -> Column:
        whole = F.struct(s["a"].alias("a"), s["b"].alias("b"), _common(s["a"], s["b"], True).alias("front"))
        return _let(whole, lambda s: F.struct(*(F.substring(s[x], s["front"] + 1, F.char_length(s[x])).alias(x) for x in "ab")))

    return _let(_let(F.struct(a.alias("a"), b.alias("b")), front), rest)


def apart(a: Column, b: Column, edits: Column, most: int) -> Column:
    """Whether counts of letters, of which an edit changes at most two by one, or disjoint parts of ``a`` that are not in ``b`` at their
    places, of which an edit spoils at most one, show more than ``edits``. Short texts have no parts."""
    many = 2 * most + 2

    def of(s: Column) -> Column:
        a, b, size = s["a"], s["b"], s["size"]
        near = lambda k: F.substring(b, F.greatest(size * k - most, F.lit(0)) + 1, size + 2 * most)
        lost = F.filter(F.sequence(F.lit(0), F.lit(many - 1)), lambda k: ~near(k).contains(F.substring(a, size * k + 1, size)))
        without = lambda x, c: F.char_length(x) - F.char_length(F.replace(x, c))
        differ = F.aggregate(F.split(F.lit(COUNTED), ""), F.lit(0), lambda n, c: n + F.abs(without(a, c) - without(b, c)))
        return ((size >= 3) & (F.size(lost) > s["edits"])) | (differ > 2 * s["edits"])

    return _let(F.struct(a.alias("a"), b.alias("b"), edits.alias("edits"), F.floor(F.char_length(a) / many).cast("int").alias("size")), of)


def _later(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], steps: tuple[tuple[int, int], ...], far: tuple[tuple[int, int], ...]) -> DataFrame:
    """(id, h) of the later line of each pair (u, v) that is near. texts: ids -> (id, line, h, first)."""
    with scratch(pairs.sparkSession):
        ids = stored(pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct(), "ids")
        known = stored(texts(ids), "texts")
        left, right = (known.select(F.col("id").alias(i), *[F.col(c).alias(f"{c}_{i}") for c in ("line", "h", "first")]) for i in ("u", "v"))
        swap, u_later = F.char_length("line_u") <= F.char_length("line_v"), F.col("first_u") > F.col("first_v")
        shorter, longer = F.when(swap, F.col("line_u")).otherwise(F.col("line_v")), F.when(swap, F.col("line_v")).otherwise(F.col("line_u"))
        later = F.when(u_later, F.struct(F.col("u").alias("id"), F.col("h_u").alias("h"))).otherwise(F.struct(F.col("v").alias("id"), F.col("h_v").alias("h")))
        both = pairs.join(left, "u").join(right, "v").select(later.alias("later"), shorter.alias("a"), longer.alias("b"))
        of = length_class(F.char_length("a"))
        size = F.floor(of / (edits_for(of, steps) + 1)).cast("int")
        ends = (F.left("a", size) == F.left("b", size)) | (F.right("a", size) == F.right("b", size))
        both = both.select("later", edits_for(of, steps).alias("edits"), F.when(ends, edits_for(of, far)).otherwise(-1).alias("reach"), trimmed(F.col("a"), F.col("b")).alias("t"))
        both = stored(both.select("later.id", "later.h", "edits", "reach", "t.a", "t.b"), "both")
        # every pair is decided by the distance; one stretch is allowed more edits, and others are first tried by their letters and parts
        stretch = F.char_length("b") <= F.col("reach")
        rest = both.where(stretch | ~apart(F.col("a"), F.col("b"), F.col("edits"), steps[-1][1]))
        allowed = F.when(stretch, F.greatest("reach", "edits")).otherwise(F.col("edits"))
        near = rest.where(distance(F.col("a"), F.col("b"), max(steps[-1][1], far[-1][1])) <= allowed)
        return stored(near.select("id", "h").distinct(), "later", outer=True)


def near_lines(df: DataFrame, key: str = "doc_id", text: str = "text", edits: Edits = EDITS, min_chars: int = MIN_CHARS, reach: Edits | None = None) -> tuple[DataFrame, DataFrame]:
    """All occurrences (key, at, h), and (h, first, near) for the distinct lines that lose occurrences; stored in the scope around."""
    lines = occurrences(df, key, text, min_chars)
    h = F.struct(F.col("id").alias("a"), "b").alias("h")
    found = stored(lines.select("key", "at", *_hashes()).select("key", "at", h), "lines", outer=True)
    with scratch(df.sparkSession):
        steps, far = by_class(edits), by_class(reach if reach is not None else REACH if edits == EDITS else edits)
        most, place = steps[-1][1], F.struct("key", "at")
        told = _told(lines, steps, far, min_chars)
        of_line = [F.first(c).alias(c) for c in told.columns if c not in ("key", "at", "id", "b")]
        # by two hashes, without texts: a text is read again where it lies, if a pair asks for it
        each = stored(told.groupBy("id", "b").agg(F.min(place).alias("first"), (F.min(place) != F.max(place)).alias("many"), *of_line), "distinct-lines")
        small = lambda df: F.broadcast(df) if df.count() <= BROADCAST_IDS else df

        def texts(ids: DataFrame) -> DataFrame:
            asked = stored(each.join(small(ids), "id", "left_semi").select("id", F.col("b").alias("other"), "first"), "asked")
            read = lines.select("key", "at", "line", *_hashes()).join(small(asked), "id").where((F.col("b") == F.col("other")) & place.eqNullSafe(F.col("first")))
            return read.select("id", "line", h, "first").distinct()  # rows with equal keys

        index, probe = _rows(each, most, False, "u"), _rows(each, most, True, "v")
        # a bucket of many lines: its earliest one meets the others first, and those that go because of it need not meet one another
        hot = stored(_buckets_of(each, most, False).groupBy("bucket").count().where(F.col("count") > HOT).select("bucket"), "hot")
        fits = lambda probe, index: (probe["bucket"] == index["bucket"]) & (F.col("u") != F.col("v")) & _may_be_near(F.col("u"), F.col("mu"), F.col("v"), F.col("mv"))
        settled = None
        if hot.limit(1).count():
            met = stored(_buckets_of(each, most, True).join(small(hot), "bucket", "left_semi").select("id").distinct(), "hot-ids")
            crowd = stored(_with_fine(each.join(small(met), "id", "left_semi"), texts(met), steps, far, min_chars), "hot-lines")
            many, tried = (_rows(crowd, most, probing, name, True).join(small(hot), "bucket", "left_semi") for probing, name in ((False, "u"), (True, "v")))
            heads = many.join(crowd.select(F.col("id").alias("u"), "first"), "u").groupBy("bucket").agg(F.min(F.struct("first", "u", "mu", "su", "tu")).alias("head"))
            heads = stored(heads.select("bucket", "head.u", "head.mu", "head.su", "head.tu"), "heads")
            met = tried.join(small(heads), "bucket").where((F.col("u") != F.col("v")) & _alike(F.col("mu"), F.col("mv"))).select("u", "v").distinct()
            settled = _later(stored(met, "met"), texts, steps, far)
            gone = small(settled.select("id").distinct())
            many = many.join(gone.select(F.col("id").alias("u"), F.lit(True).alias("u_goes")), "u", "left")
            tried = tried.join(gone.select(F.col("id").alias("v"), F.lit(True).alias("v_goes")), "v", "left")
            crowded = tried.join(many, fits(tried, many) & _finely_alike() & (F.col("u_goes").isNull() | F.col("v_goes").isNull())).select("u", "v")
            index = index.join(small(hot), "bucket", "left_anti")
        pairs = probe.join(index, fits(probe, index)).select("u", "v")
        pairs = (pairs if settled is None else pairs.union(crowded)).distinct()
        later = _later(stored(pairs, "pairs"), texts, steps, far).select("h")
        later = (later if settled is None else later.union(settled.select("h"))).distinct()
        lossy = each.select(h, "first", "many").join(later.withColumn("near", F.lit(True)), "h", "left").where("near or many")
        return found, stored(lossy.select("h", "first", F.coalesce("near", F.lit(False)).alias("near")), "lossy", outer=True)


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", into: str = "__lines", **options) -> DataFrame:
    """The rows of ``df`` with the struct column ``into`` (near, exact: how many lines go; kept: the remaining text), whose name
    must be free."""
    if into.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the table has a column {into}")
    with scratch(df.sparkSession):
        found, lossy = near_lines(df, key, text, **options)
        goes = found.join(lossy, "h").where(F.col("near") | (F.struct("key", "at") != F.col("first")))
        gone = goes.groupBy("key").agg(F.collect_set("at").alias("gone"), F.collect_set(F.when(F.col("near"), F.col("at"))).alias("near"))
        gone = stored(gone.select(F.col("key"), F.col("gone"), F.size("near").alias("near")), "gone", outer=True)
    rows = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))
    joined = rows.join(gone.hint("merge"), rows["row"][key].eqNullSafe(gone["key"]), "left")  # one plan, whatever the size

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    kept = F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(_let(F.split(F.col("row")[text], "\n", -1), rest))
    parts = F.struct(F.coalesce("near", F.lit(0)).cast("long").alias("near"), F.coalesce(F.size("gone") - F.col("near"), F.lit(0)).cast("long").alias("exact"), kept.alias("kept"))
    whole = joined.select("row", parts.alias("parts"))
    return whole.select("row.*", whole["parts"].alias(into))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_exact and n_near (lines that go), kept_sha256 (of the remaining text; null for a null text)."""
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1).cast("long")
    return out.select("doc_id", n.alias("n_lines"), F.col("__lines")["exact"].alias("n_exact"), F.col("__lines")["near"].alias("n_near"), F.sha2(F.col("__lines")["kept"], 256).alias("kept_sha256"))
