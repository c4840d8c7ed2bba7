"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text gives a vector of statistics (lengths, shares of characters, repetition of words and lines), transformed to be
nearer to normal and standardised. Each class has a mean and a covariance, shrunk towards a multiple of the identity. A
score is the logistic function of the log-density difference: half the difference of the squared Mahalanobis
distances and log-determinants, both from Cholesky factors that are computed once and broadcast with the
model, plus the log prior ratio, divided by a temperature.

Fitting needs only counts, sums and sums of products per class, which are summed where the rows lie: all labelled rows take
part, no sample is drawn, and the driver receives the sums. Rows whose crc32(key as text) mod FOLDS is 0 are
held out.

Null and empty texts have the statistics of an empty text, and a score like any other. Labels other than 0 and 1, and
labels of unknown documents, are ignored; a document with contradicting labels counts for each. A class without
labelled rows, or an empty table, gives the neutral model: every score is the share of label 1 (0.5 without labels), predicted follows it as always, and accepted() keeps every document.
Repeated rows are scored alike, null keys as well (they count as held out). Other columns are not read by classify and stay in accepted. A
text takes a worker some 100 times its bytes, whatever its length.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, small_batches, stored, table

FOLDS = 5
SHRINKAGE, TEMPERATURE, THRESHOLD = 0.05, 3.0, 0.3

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_KEEP = {name: bytes(set(range(256)) - set(chars)) for name, chars in {"upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "stop": b".,;:'\"?-", "odd": b"!#$%&*+/<=>@\\^_`{|}~[]()", "line": b"\n", "high": bytes(range(128, 256))}.items()}
FEATURES = ("chars", "words", "word_chars", "distinct", "top", "again", "upper", "digit", "stop", "odd", "high", "lines", "line_distinct", "line_words", "pair_distinct", "short", "long", "odd_end", "marks")


def features(raw: bytes) -> list[float]:
    """Transformed statistics of a text."""
    n = len(raw) or 1
    share = {k: len(raw.translate(None, drop)) / n for k, drop in _KEEP.items()}
    words = raw.split()
    w = len(words) or 1
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    letters = share["upper"] + share["lower"] or 1.0
    root = w**0.5
    sizes = list(map(len, words))
    again = sum(map(bytes.__eq__, words, words[1:])) / w
    odd_end = sum(x[-1] in b"!#$%&*|" for x in words) / w
    return [
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(sum(sizes) / w), (len(seen) / w - 1) * root**0.5, np.sqrt(max(seen.values(), default=0) / w), np.sqrt(again),
        np.sqrt(share["upper"] / letters), np.sqrt(share["digit"]), np.sqrt(share["stop"]), np.sqrt(share["odd"]), np.sqrt(share["high"]), np.sqrt(share["line"]),
        len(set(lines)) / (len(lines) or 1), np.log1p(w / (len(lines) or 1)), len(set(zip(words, words[1:], strict=False))) / w, np.sqrt(sum(s <= 3 for s in sizes) / w), np.sqrt(sum(s >= 12 for s in sizes) / w),
        np.sqrt(odd_end), np.sqrt(sum(x[-1] in b".,;:?" for x in words) / w),
    ]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([features(x.as_py() or b"") for x in column.cast(pa.binary())], float).reshape(-1, len(FEATURES))


class Discriminant:
    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE, temperature: float = TEMPERATURE):
        """moments: by class, the count, sums and sums of products."""
        counts = {c: m[0] for c, m in moments.items()}
        total = sum(counts.values())
        self.neutral = None
        if not (counts.get(0) and counts.get(1)):
            self.neutral = counts.get(1, 0) / total if total else 0.5
            return
        mean = sum(m[1] for m in moments.values()) / total
        spread = np.sqrt(np.maximum(np.diag(sum(m[2] for m in moments.values())) / total - mean**2, 1e-9))
        self.mean, self.spread, self.temperature, self.parts = mean, spread, temperature, []
        for c in (0, 1):
            n, s, p = moments[c]
            own = s / n
            covariance = (p / n - np.outer(own, own)) / np.outer(spread, spread)
            size = len(own)
            covariance = (1 - shrinkage) * covariance + shrinkage * max(np.trace(covariance) / size, 1e-3) * np.eye(size)
            factor = np.linalg.cholesky(covariance)
            self.parts.append(((own - mean) / spread, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), np.log(n / total)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.neutral is not None:
            return np.full(len(x), float(self.neutral))
        z = (x - self.mean) / self.spread
        density = [prior - 0.5 * (((z - own) @ inverse.T) ** 2).sum(1) - 0.5 * logdet for own, inverse, logdet, prior in self.parts]
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / self.temperature, -30, 30)))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % FOLDS == 0


def statistics(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def run(column: pa.Array) -> pa.Array:
        out = pa.array(list(_matrix(column)), pa.list_(pa.float64()))
        release()
        return out

    return run(text)


def fit(vectors: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", **options) -> Discriminant:
    """vectors: (key, vector)."""
    learn = labels.select(F.col(key), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col(key)))
    rows = vectors.select(key, "vector").join(learn, key).select("label", "vector")

    def moments(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(FEATURES))
            y = np.array(batch.column(0).to_pylist(), int)
            for c in np.unique(y):
                own = x[y == c]
                add = [len(own), own.sum(0), own.T @ own]
                sums[c] = [a + b for a, b in zip(sums[c], add, strict=True)] if c in sums else add
        if sums:
            flat = np.array([np.concatenate(([v[0]], v[1], v[2].ravel())) for v in sums.values()], float)
            each = flat.shape[1]
            yield pa.record_batch([pa.array(np.repeat(np.array(list(sums), np.int32), each)), pa.array(np.tile(np.arange(each, dtype=np.int32), len(sums))), pa.array(flat.ravel())], ["label", "at", "value"])

    size = len(FEATURES)
    told = rows.mapInArrow(moments, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    total: dict[int, np.ndarray] = {}
    for r in told.collect():  # a count, sums and sums of products for two classes
        total.setdefault(r.label, np.zeros(1 + size + size * size))[r.at] = r.value
    return Discriminant({c: (v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for c, v in total.items()}, **options)


def scored(spark: SparkSession, model: Discriminant):
    """A UDF: statistics -> score."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(np.array(column.to_pylist(), float).reshape(-1, len(FEATURES))), pa.float64())

    return run


def classify(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD, **options) -> DataFrame:
    """(key, held_out, score, predicted): one pass over the texts; their vectors are kept in the shared folder."""
    small_batches(documents.sparkSession)
    vectors = stored(documents.select(F.col(key), statistics(F.col(text)).alias("vector")), "quality")
    model = fit(vectors, labels, key, label, **options)
    out = vectors.select(key, held_out(F.col(key)).alias("held_out"), scored(documents.sparkSession, model)("vector").alias("score"))
    return out.select("*", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``documents`` that the classifier accepts, with all their columns; texts are read twice rather than shuffled."""
    small_batches(documents.sparkSession)
    model = fit(documents.select(F.col(key), statistics(F.col(text)).alias("vector")), labels, key, label, **options)
    if model.neutral is not None:
        return documents
    return documents.where(scored(documents.sparkSession, model)(statistics(F.col(text))) >= threshold)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
