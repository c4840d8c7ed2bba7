"""Suffix-array dedup: removal of byte strings of ``LENGTH`` bytes that also start elsewhere.

Anchors. Every string of LENGTH bytes holds a K-byte gram that is least among its grams, and all its copies hold the same one at the
same place; so only texts around equal anchors are compared. Anchors whose whole surroundings (all strings of that length
that hold them) are equal repeat outright. Where equal anchors have several surroundings, one window of each goes on. A window is trimmed
to what another of its anchor's windows shares on the left, and on the right. A trimmed window that another one holds whole repeats
outright, with that part of the other; so do equal ones; what is left enters the suffix structure.

Threshold-bounded interval expansion. The windows of a batch are concatenated, with a separator of its own after each. From the
suffix array comes the Burrows-Wheeler transform; intervals of suffixes that start with a common string are extended backwards,
breadth first, level by level. The first interval of level l to end at a boundary between neighbouring suffixes shows that they
have l bytes in common, so that common prefixes come in increasing order. The expansion stops at LENGTH: boundaries still open
then separate suffixes with LENGTH bytes in common. Those runs of suffixes that have two origins start repeated strings.

Equal texts are one class and repeat outright; anchors of one text with equal surroundings are told once, with the ranges they
cover, so that periodic text makes no hot anchor; windows are dealt by anchor. An anchor with over HOT surroundings is split by content: a
shared string reaches at least half of what it has beyond the gram to one side, so windows are dealt by the half on their right, and again by the
half on their left, and whatever two of them share they meet in one of these. Only parts that still have over HOT windows, all with one half in
common, are compared by 128-bit hashes of all their strings, summed over the cluster. So no structure holds more than HOT windows, or BATCH_BYTES of
several anchors. Anchors with over CROWD rows are counted by partial sums and joined back; at most one in CROWD rows is such an anchor, which bounds what
is broadcast of them.
Texts are shuffled twice: to cut windows, and to remove what is marked.

Null and empty texts have no bytes, texts shorter than LENGTH nothing to remove, an empty table gives an empty result. Rows are judged
by their text alone: equal rows alike, whatever their keys, null and repeated ones included. Texts are told apart by 128-bit hashes. A text takes a worker some 40 times
its bytes, whatever its length. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .anchors import Grams, anchors
from .common import releasing, scratch, small_batches, stored, table

LENGTH, K = 400, 200
#: Bytes of windows in one suffix structure; windows of one anchor, or part of one, that a task compares: 6 MB of text, some 0.5 GB of arrays.
BATCH_BYTES, HOT = 1 << 20, 10_000
#: Rows of one anchor that may meet in a task to be counted.
CROWD = 1 << 20


def suffix_array(symbols: np.ndarray, piece: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of all suffixes of pieces; symbol 0 ends a piece, and ends sort by piece. Prefix doubling from seven packed symbols."""
    n, pieces = len(symbols), len(ends)
    at = np.arange(n)
    rest = ends[piece] - at  # symbols before the end of the piece
    key = np.zeros(n, np.int64)
    for j in range(7):
        key <<= 9
        part = key[: max(0, n - j)]
        part += np.where(rest[: max(0, n - j)] >= j, symbols[j:], 0)
    rank, size = _ranked(key), 7
    longest = int(rest.max(initial=0)) + 1
    while True:
        second = piece.astype(np.int64)
        inside = rest >= size
        second[inside] = rank[at[inside] + size] + pieces
        rank = _ranked(rank * (n + pieces) + second)
        if size > longest:  # every end was in sight
            break
        size *= 2
    order = np.empty(n, np.int64)
    order[rank] = at
    return order


def _ranked(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
    return rank


def runs_with_common_prefix(symbols: np.ndarray, piece: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and for each suffix in it the number of its run of suffixes that share ``least`` symbols."""
    order = suffix_array(symbols, piece, ends)
    n, pieces = len(order), len(ends)
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    bwt = symbols[order - 1].astype(np.int16)  # before the first symbol stands the last separator
    step = back[order - 1]  # the row of the suffix that is one symbol longer
    by = np.argsort(bwt, kind="stable")
    same = bwt[by[1:]] == bwt[by[:-1]]
    before, after = np.full(n, -1), np.full(n, n)
    before[by[1:][same]], after[by[:-1][same]] = by[:-1][same], by[1:][same]
    known = np.zeros(n + 1, bool)  # boundaries whose common prefix is shorter than least
    known[: pieces + 1] = known[n] = True
    low, high = np.array([0]), np.array([n])
    for level in range(least):
        size = high - low
        which = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        real = bwt[rows] > 0
        first = real & (before[rows] < low[which])
        last = real & (after[rows] >= high[which])
        new_low, new_high = (np.sort(which[m] * n + step[rows[m]]) for m in (first, last))  # by interval, then symbol
        new_low, new_high = new_low % n, new_high % n + 1
        fresh = ~known[new_high]
        high, one = np.unique(new_high[fresh], return_index=True)
        low = new_low[fresh][one]
        known[high] = True
        if level == 0:  # each separator is a string of its own
            low, high = np.concatenate((np.arange(pieces), low)), np.concatenate((np.arange(pieces) + 1, high))
        if not len(low):
            break
    return order, np.cumsum(known[:n])


def _common(contexts: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many leading bytes rows i and j share."""
    differ = contexts[i] != contexts[j]
    both = np.where(differ.any(1), differ.argmax(1), contexts.shape[1])
    return np.minimum(both, np.minimum(lengths[i], lengths[j]))


def _shared(contexts: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each row, how many leading bytes another row of its group shares (-1 if it is alone); its neighbours in order of contexts."""
    tagged = np.concatenate((group.astype(">u4").view(np.uint8).reshape(-1, 4), contexts, np.full((len(contexts), 1), 1, np.uint8)), axis=1)
    order = np.argsort(np.ascontiguousarray(tagged).view(f"S{tagged.shape[1]}").ravel(), kind="stable")
    both = np.where(group[order][1:] == group[order][:-1], _common(contexts, lengths, order[1:], order[:-1]), -1)
    out, before, after = np.full(len(contexts), -1), np.arange(len(contexts)), np.arange(len(contexts))
    out[order[1:]], before[order[1:]] = both, order[:-1]
    out[order[:-1]], after[order[:-1]] = np.maximum(out[order[:-1]], both), order[1:]
    return out, [before, after]


def _contained(group: np.ndarray, reach: list[np.ndarray], neighbours: list[np.ndarray], padded: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
    """For each row a row of its group with a longer trimmed window that holds its own whole, at the same place; else -1. Tried are
    its neighbours in both orders, and the row of the group with the longest window."""
    total, rows, out = reach[0] + reach[1], np.arange(len(group)), np.full(len(group), -1)
    by = np.lexsort((total, group))
    last = by[np.concatenate((np.flatnonzero(group[by][1:] != group[by][:-1]), [len(by) - 1]))]
    longest = last[np.searchsorted(group[last], group)]
    for other in (longest, *neighbours):
        i = rows[(out < 0) & (group[other] == group) & (total[other] > total)]
        j = other[i]
        whole = (_common(padded[0], sizes[0], i, j) >= reach[0][i]) & (_common(padded[1], sizes[1], i, j) >= reach[1][i])
        out[i[whole]] = j[whole]
    return out


def repeated(group: np.ndarray, text: np.ndarray, place: np.ndarray, lefts: list[bytes], grams: list[bytes], rights: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(text, start, stop) of repeated strings in windows left + gram + right around anchors; ``place`` is where the gram starts."""
    if len(group) < 2:
        return []
    k = len(grams[0])
    widest = length - k
    sizes = [np.array([len(x) for x in side]) for side in (lefts, rights)]
    padded = [np.frombuffer(b"".join(x.ljust(widest, b"\0") for x in side), np.uint8).reshape(-1, widest) for side in ([x[::-1] for x in lefts], rights)]
    (left, near), (right, more) = (_shared(c, s, group) for c, s in zip(padded, sizes, strict=True))
    reach, starts = [left, right], place - left
    holder = _contained(group, reach, near + more, padded, sizes)
    enough = (left >= 0) & (right >= 0) & (left + right >= widest)
    held = np.flatnonzero(enough & (holder >= 0))
    # a window inside another repeats outright, there and here, and the other stands for it
    whole = left[held] + k + right[held]
    out = list(zip(text[held].tolist(), starts[held].tolist(), (starts[held] + whole).tolist(), strict=True))
    there = place[holder[held]] - left[held]
    out += zip(text[holder[held]].tolist(), there.tolist(), (there + whole).tolist(), strict=True)
    # by content, then by place: in periodic text several anchors have windows that trim to one place
    found: dict[tuple[int, bytes], dict[tuple[int, int], int]] = {}
    for i in np.flatnonzero(enough & (holder < 0)):
        trimmed = lefts[i][sizes[0][i] - reach[0][i] :] + grams[i] + rights[i][: reach[1][i]]
        found.setdefault((int(group[i]), trimmed), {}).setdefault((int(text[i]), int(starts[i])), i)
    pieces, origins = [], []
    for (_, trimmed), places in found.items():
        if len(places) > 1:
            out += [(t, start, start + len(trimmed)) for t, start in places]
        pieces.append(trimmed)
        origins.append(list(places.values()))
    if not pieces:
        return out
    many = np.array([len(r) > 1 for r in origins])
    sizes_ = np.array([len(p) + 1 for p in pieces])
    symbols = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.cumsum(sizes_) - 1
    symbols[ends] = 0
    piece = np.repeat(np.arange(len(pieces)), sizes_)
    order, run = runs_with_common_prefix(symbols, piece, ends, length)
    heads = np.concatenate(([0], np.flatnonzero(run[1:] != run[:-1]) + 1))
    owner = np.array([r[0] for r in origins])[piece]
    offset = np.arange(len(symbols)) - (ends - sizes_ + 1)[piece]
    absolute = starts[owner] + offset
    # the origin of a string: its text and place; strings of several rows have several
    names, text_no = np.unique(text[owner], return_inverse=True)
    origin = np.where(many[piece], -1 - np.arange(len(symbols)), text_no * (int(absolute.max()) + 1) + absolute)[order]
    least, most = np.minimum.reduceat(origin, heads), np.maximum.reduceat(origin, heads)
    hit = np.repeat(least != most, np.diff(np.concatenate((heads, [len(order)]))))
    start = np.sort(order[hit & ~many[piece][order]])
    if len(start):
        begins = np.concatenate(([True], (start[1:] != start[:-1] + 1) | (piece[start[1:]] != piece[start[:-1]])))
        first, last = start[begins], start[np.concatenate((begins[1:], [True]))]
        out += [(int(text[owner[a]]), int(absolute[a]), int(absolute[b]) + length) for a, b in zip(first, last, strict=True)]
    return out


def _anchored(length: int, k: int):
    """(cls, text) -> (a, c, cls, pos, twin, stop): anchors with hashes of their gram and of their surroundings. Of anchors with
    equal surroundings in one text the first stands for all, as a twin; what they all cover comes as rows with a stop."""
    names = ["a", "c", "cls", "pos", "twin", "stop"]

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            out = []
            for row, (name, raw) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True)):
                if name in seen:  # copies in one task say the same
                    continue
                if len(seen) > 1 << 19:
                    seen.clear()
                seen.add(name)
                raw = raw.as_py()
                grams = Grams(np.frombuffer(raw, np.uint8))
                at = anchors(grams, len(raw), k, length)
                low, high = np.maximum(at - (length - k), 0), np.minimum(at + length, len(raw))
                around = grams.of(low, high) ^ ((at - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                of = grams.of(at, at + k)
                first, twin, spans = _twins(of, around, low, high, length)
                n = len(first)
                out.append((of[first], around[first], np.full(n, row), at[first], twin, np.full(n, -1)))
                if len(spans):
                    same, zero = np.full(len(spans), row), np.zeros(len(spans), np.uint64)
                    out.append((spans[:, 0].astype(np.uint64) + of[0], zero, same, spans[:, 0], zero.astype(bool), spans[:, 1]))
            if out:
                a, c, rows, pos, twin, stop = (np.concatenate([o[i] for o in out]) for i in range(6))
                cols = [pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), batch.column(0).take(pa.array(rows)), pa.array(pos.astype(np.int32)), pa.array(twin), pa.array(stop.astype(np.int32))]
                yield pa.record_batch(cols, names)

    return run


def _twins(a: np.ndarray, c: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's anchors the first of each (a, c); whether there are more of it; and the ranges that those with more cover."""
    order = np.lexsort((np.arange(len(a)), c, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (c[order][1:] != c[order][:-1])
    starts = np.flatnonzero(new)
    size = np.diff(np.concatenate((starts, [len(a)])))
    many = np.sort(order[np.repeat(size > 1, size)])
    many = many[high[many] - low[many] >= length]
    if len(many):
        cut = np.concatenate(([True], low[many][1:] > high[many][:-1]))  # both ends rise with the place
        spans = np.stack((low[many][cut], high[many][np.concatenate((cut[1:], [True]))]), 1)
    else:
        spans = np.zeros((0, 2), np.int64)
    return order[starts], size > 1, spans


def _windows(length: int, k: int):
    """(cls, text, places) -> (a, hot, cls, pos, left, gram, right)"""

    def run(batches):
        for batch in batches:
            rows = []
            for name, raw, places in zip(batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                name, raw = name.as_py(), raw.as_py()
                for p in places.as_py():
                    at = p["pos"]
                    rows.append((p["a"], p["hot"], name, at, raw[max(0, at - (length - k)) : at], raw[at : at + k], raw[at + k : at + length]))
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["a", "hot", "cls", "pos", "left", "gram", "right"]
            for start in range(0, len(rows), 4096):
                part = rows[start : start + 4096]
                yield pa.record_batch([pa.array([r[i] for r in part], kind) for i, kind in enumerate(kinds)], names)

    return run


def _halves(length: int, k: int):
    """Windows of hot anchors -> the same, dealt by anchor and the half on the right, and by anchor and the half on the left."""
    half = (length - k + 1) // 2

    def run(batches):
        for batch in batches:
            a, _, _, left, gram, right = (batch.column(i).to_pylist() for i in range(6))
            for side, parts in ((b"r", [r[:half] for r in right]), (b"l", [x[-half:] for x in left])):
                at = [i for i, part in enumerate(parts) if len(part) == half]
                of = [hashlib.blake2b(side + a[i].to_bytes(8, "big", signed=True) + gram[i] + parts[i], digest_size=8).digest() for i in at]
                take = batch.take(pa.array(at, pa.int64()))
                yield pa.record_batch([pa.array([int.from_bytes(d, "big", signed=True) for d in of], pa.int64()), *take.columns[1:]], batch.schema.names)

    return run


def _marks(length: int, batch_bytes: int):
    """Windows sorted by anchor -> (cls, start, stop), in batches of whole anchors."""

    def told(parts):
        cols = [pa.chunked_array([p.column(i) for p in parts]) for i in range(6)]
        group = np.unique(cols[0].to_numpy(), return_inverse=True)[1]
        texts = cols[1].combine_chunks().dictionary_encode()
        found = repeated(group, texts.indices.to_numpy().astype(np.int64), cols[2].to_numpy().astype(np.int64), *[c.to_pylist() for c in cols[3:]], length)
        found = sorted(set(found))
        cls, start, stop = (pa.array([f[i] for f in found], pa.int64()) for i in range(3))
        return pa.record_batch([texts.dictionary.take(cls), start, stop], ["cls", "start", "stop"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            a = batch.column(0).to_numpy()
            start = 0
            for cut in [*(np.flatnonzero(a[1:] != a[:-1]) + 1), len(a)]:
                if held and size >= batch_bytes and start < len(a) and held[-1].column(0)[-1].as_py() != a[start]:
                    yield told(held)
                    held, size = [], 0
                part = batch.slice(start, cut - start)
                if len(part):
                    held.append(part)
                    size += len(part) * (3 * length // 2)
                start = cut
        if held:
            yield told(held)

    return run


def _strings(length: int):
    """Windows -> (128-bit hash, cls, start) of all their strings of ``length`` bytes."""

    def run(batches):
        for batch in batches:
            for cls, pos, left, gram, right in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                raw = left + gram + right
                h = [hashlib.blake2b(raw[i : i + length], digest_size=16).digest() for i in range(len(raw) - length + 1)]
                if h:
                    yield pa.record_batch([pa.array(h, pa.binary()), pa.array([cls] * len(h), pa.binary()), pa.array(pos - len(left) + np.arange(len(h)))], ["h", "cls", "start"])

    return run


def _removed(length: int):
    """A UDF: (text, marks) -> what is removed and what is kept."""

    def run(texts: pa.Array, marks: pa.Array) -> pa.Array:
        rows = []
        for raw, spans in zip(texts.cast(pa.binary()), marks, strict=True):
            raw = raw.as_py() or b""
            n = len(raw)
            ranges = [(s["start"], min(s["stop"], n)) for s in spans.as_py() or ()]
            kept, spans_, removed, at = hashlib.sha256(), [], 0, 0
            for a, b in sorted(r for r in ranges if r[1] - r[0] >= length):
                if spans_ and a <= spans_[-1][1]:
                    spans_[-1][1] = max(b, spans_[-1][1])
                else:
                    spans_.append([a, b])
            for a, b in spans_:
                kept.update(raw[at:a])
                removed, at = removed + b - a, b
            kept.update(raw[at:])
            rows.append({"n_bytes": n, "n_removed": removed, "n_spans": len(spans_), "kept_sha256": kept.hexdigest(), "spans": [{"start": a, "stop": b} for a, b in spans_]})
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.array(rows, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", span)]))

    return F.arrow_udf(run, "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,spans:array<struct<start:bigint,stop:bigint>>>")


def _judged(rows: DataFrame, hot: int) -> DataFrame:
    """(a, c, cls, pos, stop) -> (a, cls, pos, stop, outright, asked, hot): whether an anchor's surroundings repeat outright, whether its window is the one
    of its surroundings that is asked for, and whether the anchor has over ``hot`` surroundings."""
    same, of = W.partitionBy("a", "c"), W.partitionBy("a")
    rows = rows.repartition("a").distinct()  # copies in several tasks; the one exchange serves the windows too
    rows = rows.select("*", (F.count(F.lit(1)).over(same) > 1).alias("twins"), F.row_number().over(same.orderBy("cls", "pos")).alias("nth"))
    rows = rows.select("*", F.sum(F.when((F.col("nth") == 1) & (F.col("stop") < 0), 1).otherwise(0)).over(of).alias("kinds"))
    return rows.select("a", "cls", "pos", "stop", ((F.col("stop") < 0) & F.col("twins")).alias("outright"), ((F.col("stop") < 0) & (F.col("nth") == 1) & (F.col("kinds") > 1)).alias("asked"), (F.col("kinds") > hot).alias("hot"))


def _judged_by_sums(rows: DataFrame, hot: int) -> DataFrame:
    """As _judged, for anchors whose rows should not meet in one task; there are few such anchors."""
    place = F.struct("cls", "pos")
    rows = rows.distinct()
    same = rows.where("stop < 0").groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    kinds = same.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"))
    rows = rows.join(same, ["a", "c"], "left").join(F.broadcast(kinds), "a", "left")
    told, kinds = F.col("stop") < 0, F.coalesce("kinds", F.lit(0))
    return rows.select("a", "cls", "pos", "stop", (told & (F.coalesce("n", F.lit(0)) > 1)).alias("outright"), (told & place.eqNullSafe(F.col("first")) & (kinds > 1)).alias("asked"), (kinds > hot).alias("hot"))


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = K, hot: int = HOT, batch_bytes: int = BATCH_BYTES, crowd: int = CROWD) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans) for each row; spans are byte ranges that go."""
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(F.col(key).alias("key"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("cls"), F.col(text).alias("text"))
    long = docs.where(F.octet_length("text") >= length)
    with scratch(spark):
        copies = stored(long.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("rep")), "copies")
        rows = long.select("cls", "text").mapInArrow(releasing(_anchored(length, k)), "a long, c long, cls binary, pos int, twin boolean, stop int")
        rows = stored(rows.drop("twin"), "found")
        crowded = stored(rows.groupBy("a").count().where(F.col("count") > crowd).select("a"), "crowded")
        if crowded.limit(1).count():
            few, many = rows.join(F.broadcast(crowded), "a", "left_anti"), rows.join(F.broadcast(crowded), "a", "left_semi")
            rows = _judged(few, hot).union(_judged_by_sums(many, hot))
        else:
            rows = _judged(rows, hot)
        shared = stored(rows.where("stop >= 0 or outright or asked"), "anchors")
        asked = shared.where("asked").groupBy("cls").agg(F.collect_list(F.struct("a", "pos", "hot")).alias("places")).join(copies.select("cls", "rep"), "cls")
        cut = long.join(asked, (long["cls"] == asked["cls"]) & long["key"].eqNullSafe(asked["rep"])).select(long["cls"], "text", "places")
        windows = cut.mapInArrow(releasing(_windows(length, k)), "a long, hot boolean, cls binary, pos int, left binary, gram binary, right binary")
        any_hot = bool(shared.where("hot").limit(1).count())
        if any_hot:
            windows = stored(windows, "windows")
            halves = stored(windows.where("hot").drop("hot").mapInArrow(releasing(_halves(length, k)), "a long, cls binary, pos int, left binary, gram binary, right binary"), "halves")
            halves = halves.join(halves.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "a")
            usual = windows.where("not hot").drop("hot").union(halves.where(F.col("n") <= hot).drop("n"))
        else:
            usual = windows
        marks = usual.select("a", "cls", "pos", "left", "gram", "right").repartition("a").sortWithinPartitions("a").mapInArrow(releasing(_marks(length, batch_bytes)), "cls binary, start long, stop long")
        if any_hot:
            strings = stored(halves.where(F.col("n") > hot).select("cls", "pos", "left", "gram", "right").mapInArrow(_strings(length), "h binary, cls binary, start long").distinct(), "strings")
            often = strings.groupBy("h").count().where("count > 1").select("h")
            marks = marks.union(strings.join(often, "h").select("cls", "start", (F.col("start") + length).alias("stop")))
        marks = marks.union(copies.where("n > 1").select("cls", F.lit(0).cast("long"), F.lit(1 << 40)))
        marks = marks.union(shared.where("stop >= 0").select("cls", F.col("pos").cast("long"), F.col("stop").cast("long")))
        marks = marks.union(shared.where("outright").select("cls", F.greatest(F.col("pos") - (length - k), F.lit(0)).cast("long"), (F.col("pos") + length).cast("long")))
        spans = stored(marks.groupBy("cls").agg(F.collect_set(F.struct("start", "stop")).alias("marks")), "marks", outer=True)
    told = docs.join(spans, "cls", "left")
    return told.select(F.col("key").alias(key), _removed(length)("text", "marks").alias("r")).select(key, "r.*")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("spans")
