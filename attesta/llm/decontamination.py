"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

An item's windows are its runs of WINDOW consecutive words (the whole item, if it has fewer). A window is treated as the set
of its SHINGLE-word shingles (of the whole window, if it is shorter) and has to be contained whole, so by the
prefix filter one shingle has to be joined: the rarest, counted over all documents. Wherever a document holds that shingle, the
length bound (as many words must stand before and after as the window has) and the positional bound (the shingle's
offset fixes where the window starts) leave one place, and the words there are compared exactly.

Two passes over the documents, nothing of them shuffled but counts of benchmark shingles. Items are packed into blocks of at
most BLOCK_BYTES, each broadcast; several blocks are joined one after another and their hits united per document. A benchmark of more
than BROADCAST_BYTES is not broadcast: its windows and the documents' shingles meet in a shuffle join by shingle (see ``_joined``), by the same
prefix filter and the same bounds, so that nothing of it goes through the driver or stays in a worker.

Words are what remains between ASCII characters that are no letters or digits, lower-cased A-Z; null and empty texts have none,
and items without words are ignored. Repeated rows of documents are judged one by one, repeated items count once for
each item_id. An empty benchmark leaves all documents clean. A null item_id is the item "None"; keys of documents are only handed on. Other
columns are not read, so their names cannot clash. A text takes a worker some 50 times its bytes, whatever its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import releasing, scratch, small_batches, stored, table
from .licenses import words_of

WINDOW, SHINGLE = 13, 5
#: Benchmark text in one broadcast block.
BLOCK_BYTES = 16 << 20
#: Benchmark text, of all blocks, that is broadcast at all.
BROADCAST_BYTES = 16 << 20


class Index:
    """The windows of a block of items over a vocabulary of their words."""

    def __init__(self, items: list[tuple[object, bytes]], window: int = WINDOW, shingle: int = SHINGLE):
        texts = [(i, words_of(t)) for i, t in items]
        self.vocabulary = {w: n + 1 for n, w in enumerate(dict.fromkeys(w for _, words in texts for w in words))}
        self.items: list[object] = []
        self.windows: dict[int, list[tuple[int, list[int]]]] = {}  # by length: (item, word ids)
        for item, words in texts:
            if words:
                ids, size = [self.vocabulary[w] for w in words], min(window, len(words))
                self.windows.setdefault(size, []).extend((len(self.items), ids[s : s + size]) for s in range(len(ids) - size + 1))
                self.items.append(item)
        self.shingle = shingle
        self.tables = {}
        for size, rows in self.windows.items():
            owner, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.int64)
            self.tables[size] = owner, matrix, np.stack([hashes(matrix[:, o : o + min(shingle, size)]) for o in range(size - min(shingle, size) + 1)], 1)
        self.lengths = sorted({min(shingle, s) for s in self.tables})
        self.known = {n: np.unique(np.concatenate([t[2].ravel() for s, t in self.tables.items() if min(shingle, s) == n])) for n in self.lengths}
        self.prefix: dict[int, tuple] = {}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Choose each window's rarest shingle; counts by (shingle length, place in known)."""
        for size, (_, _, shingles) in self.tables.items():
            n = min(self.shingle, size)
            place = np.searchsorted(self.known[n], shingles)
            count = np.array([counts.get((n, p), 0) for p in range(len(self.known[n]))], np.int64)[place]
            offset = np.lexsort((place, count), axis=1)[:, 0]
            first = place[np.arange(len(place)), offset]
            by = np.argsort(first, kind="stable")
            self.prefix[size] = by, offset, np.searchsorted(first[by], np.arange(len(self.known[n]) + 1))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of texts, each with a 0 after it; where each text starts."""
        parts, starts, total = [], [0], 0
        get = self.vocabulary.get
        for text in texts:
            words = words_of(text)
            ids = np.zeros(len(words) + 1, np.int64)
            ids[:-1] = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
            parts.append(ids)
            total += len(ids)
            starts.append(total)
        return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(starts)

    def seeds(self, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the benchmark's n-word shingles, and which they are."""
        if len(ids) < n or n not in self.known:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids > 0
        whole = known[: len(ids) - n + 1].copy()
        for j in range(1, n):
            whole &= known[j : len(ids) - n + 1 + j]
        at = np.flatnonzero(whole)
        h = hashes(ids[at[:, None] + np.arange(n)])
        place = np.searchsorted(self.known[n], h)
        hit = self.known[n][np.minimum(place, len(self.known[n]) - 1)] == h
        return at[hit], place[hit]

    def count(self, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
        ids, _ = self.encode(texts)
        for n in self.lengths:
            values, counts = np.unique(self.seeds(ids, n)[1], return_counts=True)
            yield from ((n, int(v), int(c)) for v, c in zip(values, counts, strict=True))

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
        """Per text: number of words; per hit: (text, item, first word, length)."""
        ids, starts = self.encode(texts)
        sizes, found = np.diff(starts) - 1, []
        for size, (owner, matrix, _) in self.tables.items():
            at, which = self.seeds(ids, min(self.shingle, size))
            by, offset, bounds = self.prefix[size]
            many = bounds[which + 1] - bounds[which]
            at, which = np.repeat(at, many), np.repeat(which, many)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            row = by[bounds[which] + nth]
            start = at - offset[row]
            text = np.searchsorted(starts, at, side="right") - 1
            fits = (start >= starts[text]) & (start + size <= starts[text + 1] - 1)
            start, row, text = start[fits], row[fits], text[fits]
            same = (ids[start[:, None] + np.arange(size)] == matrix[row]).all(1)
            found += [np.stack([text[same], owner[row[same]], start[same] - starts[text[same]], np.full(same.sum(), size)], 1)]
        return sizes, starts, np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)


def hashes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        out = (out ^ rows[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column.cast(pa.binary())]


def blocks_of(benchmark: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    block, size = [], 0
    for row in benchmark.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null").orderBy("k", "t").toLocalIterator():
        raw = row.t.encode()
        if block and size + len(raw) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.k, raw))
        size += len(raw)
    yield block


def _built(documents: DataFrame, text: str, items: list[tuple[object, bytes]], window: int, shingle: int):
    """The broadcast index of a block, its shingles ordered by rarity in the documents."""
    index = Index(items, window, shingle)
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def count(batches):
        for batch in batches:
            rows = list(shared.value.count(_texts(batch.column(0))))
            yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["n", "place", "times"])

    counted = documents.select(F.col(text).alias("t")).mapInArrow(count, "n long, place long, times long")
    index.order({(r.n, r.place): r.times for r in counted.groupBy("n", "place").agg(F.sum("times").alias("times")).collect()})
    return documents.sparkSession.sparkContext.broadcast(index)


RESULT = "struct<n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string,contaminated:boolean>"


def _judged(sizes: np.ndarray, hits: np.ndarray, items: list[object]) -> pa.Array:
    n = len(sizes)
    n_hit, names = np.zeros(n, np.int64), [[] for _ in range(n)]
    bounds = np.searchsorted(hits[:, 0], np.arange(n + 1))
    for t in np.unique(hits[:, 0]):
        own = hits[bounds[t] : bounds[t + 1]]
        edge = np.zeros(sizes[t] + 1, np.int64)
        np.add.at(edge, own[:, 2], 1)
        np.add.at(edge, own[:, 2] + own[:, 3], -1)
        n_hit[t] = np.count_nonzero(np.cumsum(edge)[:-1])
        names[t] = sorted({str(items[i]) for i in np.unique(own[:, 1])})
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(n_hit), pa.array([len(x) for x in names], pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]), pa.array((n_hit > 0) & (20 * n_hit >= sizes))],
        ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def judge(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES):
    """A column expression over ``text`` of ``documents``: RESULT."""
    small_batches(documents.sparkSession)
    indexes = [_built(documents, text, block, window, shingle) for block in blocks_of(benchmark, item_key, item_text, block_bytes)]

    @F.arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        texts, found, items = _texts(column), [], []
        for shared in indexes:
            sizes, _, hits = shared.value.hits(texts)
            hits = hits.copy()
            hits[:, 1] += len(items)
            items += shared.value.items
            found.append(hits)
        hits = np.concatenate(found)
        return _judged(sizes, hits[np.argsort(hits[:, 0], kind="stable")], items)

    return run(F.col(text))


def _hashed(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of texts, how many each has, and one hash a word."""
    words = [words_of(t) for t in texts]
    known = {w: int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in set().union(*words)}
    sizes = np.array([len(w) for w in words], np.int64)
    return words, sizes, np.fromiter((known[w] for own in words for w in own), np.uint64, int(sizes.sum()))


def _runs(sizes: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, hash) of all runs of ``n`` words that lie within a text."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(pos + n <= sizes[text])
    return text[at], pos[at], (hashes(values[at[:, None] + np.arange(n)]) ^ np.uint64(n)).view(np.int64)


def _item_windows(window: int, shingle: int):
    """(item, text) -> (wid, item, words, n, hs): windows with their identity, words, shingle length and the hashes of their shingles."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0), _texts(batch.column(1)), strict=True):
                words, sizes, values = _hashed([text])
                size = min(window, len(words[0]))
                if not size:
                    continue
                n = min(shingle, size)
                hs = _runs(sizes, values, n)[2]
                rows = [b" ".join(words[0][s : s + size]) for s in range(len(words[0]) - size + 1)]
                for start in range(0, len(rows), 4096):
                    part = rows[start : start + 4096]
                    own = [hs[s : s + size - n + 1] for s in range(start, start + len(part))]
                    wid = [hashlib.blake2b(r, digest_size=16).digest() for r in part]
                    yield pa.record_batch([pa.array(wid), pa.array([item.as_py()] * len(part), pa.string()), pa.array(part), pa.array([n] * len(part), pa.int32()), pa.array(own, pa.list_(pa.int64()))], ["wid", "item", "words", "n", "hs"])

    return run


def _shingle_counts(lengths: list[int]):
    """(cls, text) -> (h, times), summed by batch."""

    def run(batches):
        for batch in batches:
            _, sizes, values = _hashed(_texts(batch.column(1)))
            for n in lengths:
                h, times = np.unique(_runs(sizes, values, n)[2], return_counts=True)
                yield pa.record_batch([pa.array(h), pa.array(times.astype(np.int64))], ["h", "times"])

    return run


def _shingle_places(lengths: list[int]):
    """(cls, text) -> (h, cls, pos); equal texts of one batch once."""

    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows = list({name: i for i, name in enumerate(names) if name is not None}.values())
            take = batch.take(pa.array(rows, pa.int64()))
            _, sizes, values = _hashed(_texts(take.column(1)))
            for n in lengths:
                text, pos, h = _runs(sizes, values, n)
                yield pa.record_batch([pa.array(h), take.column(0).take(pa.array(text)), pa.array(pos.astype(np.int32))], ["h", "cls", "pos"])

    return run


VERIFIED = "struct<n_words:bigint,n_hit:bigint,wids:array<binary>>"


def _verified(texts: pa.Array, places: pa.Array) -> pa.Array:
    rows = []
    for text, asked in zip(_texts(texts), places, strict=True):
        words, wids = words_of(text), set()
        edge = np.zeros(len(words) + 1, np.int64)
        for p in asked.as_py() or ():
            size = p["words"].count(b" ") + 1
            if b" ".join(words[p["start"] : p["start"] + size]) == p["words"]:
                edge[p["start"]] += 1
                edge[p["start"] + size] -= 1
                wids.add(p["wid"])
        rows.append({"n_words": len(words), "n_hit": int(np.count_nonzero(np.cumsum(edge)[:-1])), "wids": list(wids)})
    return pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("wids", pa.list_(pa.binary()))]))


def _joined(documents: DataFrame, benchmark: DataFrame, key: str, text: str, item_key: str, item_text: str, window: int, shingle: int) -> DataFrame:
    """contamination() for a benchmark of any size. A document is known by its text's 128-bit hash. Shingles of documents are counted, by batch first;
    a window whose rarest shingle no document holds is dropped; the places of the others' rarest shingles are joined and bounded, the words
    there compared where the text lies. Shuffled: a row a document word for the counts and one for the places, and texts once."""
    spark = documents.sparkSession
    docs = documents.select(F.col(key).alias("key"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("cls"), F.col(text).alias("text"))
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.coalesce(F.col(item_key).cast("string"), F.lit("None")), F.col(item_text))
    with scratch(spark):
        windows = stored(items.mapInArrow(releasing(_item_windows(window, shingle)), "wid binary, item string, words binary, n int, hs array<bigint>"), "windows")
        lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most as many as a shingle has words
        of = windows.dropDuplicates(["wid"]).select("wid", "words", F.posexplode("hs").alias("offset", "h"))
        texts = docs.select("cls", "text")
        counts = texts.mapInArrow(releasing(_shingle_counts(lengths)), "h long, times long").groupBy("h").agg(F.sum("times").alias("times"))
        rarest = of.join(counts, "h", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "h", "offset")).alias("r"), F.first("words").alias("words"))
        prefix = stored(rarest.where("r.times > 0").select("wid", "words", "r.h", "r.offset"), "prefix")
        met = texts.mapInArrow(releasing(_shingle_places(lengths)), "h long, cls binary, pos int").join(prefix, "h").where("pos >= offset")
        asked = met.groupBy("cls").agg(F.collect_set(F.struct((F.col("pos") - F.col("offset")).alias("start"), "wid", "words")).alias("places"))
        told = docs.join(asked, "cls", "left").select("key", "cls", F.arrow_udf(_verified, VERIFIED)("text", "places").alias("v")).select("key", "cls", "v.*")
        told = stored(told, "told", outer=True)
        found = told.select("cls", F.explode("wids").alias("wid")).distinct().join(windows.select("wid", "item").distinct(), "wid")
        named = stored(found.groupBy("cls").agg(F.array_sort(F.collect_set("item")).alias("items")), "named", outer=True)
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = told.join(named, "cls", "left")
    digest = F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256")
    bad = ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")
    return out.select(F.col("key").alias(key), "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), digest, bad)


def broadcastable(benchmark: DataFrame, item_text: str = "text", most: int = BROADCAST_BYTES) -> bool:
    return (benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0) <= most


def contamination(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated)."""
    if not broadcastable(benchmark, item_text, broadcast_bytes):
        small_batches(documents.sparkSession)
        return _joined(documents, benchmark, key, text, item_key, item_text, window, shingle)
    found = judge(documents, benchmark, text, item_key, item_text, window, shingle, block_bytes)
    return documents.select(F.col(key), found.alias("found")).select(key, "found.*")


def clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``documents`` without the contaminated ones; with a benchmark that is not broadcast, by the hash of their text."""
    if broadcastable(benchmark, most=broadcast_bytes):
        return documents.where(~judge(documents, benchmark, text)["contaminated"])
    digest = F.unhex(F.md5(F.col(text).cast("binary")))
    judged = contamination(documents.select(digest.alias("cls"), F.col(text).alias("text")), benchmark, "cls", broadcast_bytes=broadcast_bytes)
    bad = judged.where("contaminated").select("cls").distinct()
    return documents.join(bad, digest == bad["cls"], "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
