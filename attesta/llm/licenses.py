"""License scan: fuzzy search for short notices.

Words are what remains between ASCII characters that are no letters or digits, lower-cased A-Z. Base labels come from
phrases whose words stand consecutively. The method adds labels of its own: a notice of n characters may differ
in k = n // 10 edits, so that of k + 1 pieces one occurs unchanged (pigeonhole). Exact occurrences of pieces give
candidate windows; the regex library's bounded-error matching verifies them and reports spans and edits. No other
place can match, so the seeds lose nothing.

Null and empty texts have no words, no labels and score 0. Rows are independent; repeated rows, clashing extra
columns and empty tables need no care. Long texts cost time in proportion to their length.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

# The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices that are searched with errors.
NOTICES = {
    "under the mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "apache license version 2": "apache-2",
    "under the apache license version 2 0": "apache-2",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "under the gnu general public license": "gpl",
    "under the gnu lesser general public license": "lgpl",
    "under the mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "under the bsd license": "bsd",
    "all rights reserved": "all-rights-reserved",
}
CHARS_PER_EDIT = 10
#: Every ASCII byte that is no letter or digit becomes a space, A-Z become a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


class Notice:
    def __init__(self, phrase: str, label: str, chars_per_edit: int = CHARS_PER_EDIT):
        self.text, self.label = phrase.encode(), label
        self.edits = len(self.text) // chars_per_edit
        cuts = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.seeds = [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.pattern = regex.compile(b"(?e)(?:%s){e<=%d}" % (regex.escape(self.text), self.edits))

    def spans(self, line: bytes) -> list[tuple[int, int, int]]:
        """(start, end, edits) in the folded line."""
        windows: list[list[int]] = []
        found = []
        for seed, offset in self.seeds:
            at = line.find(seed)
            while at >= 0:
                found.append(at - offset)
                at = line.find(seed, at + 1)
        for start in sorted(found):
            a, b = max(0, start - self.edits), min(len(line), start + len(self.text) + self.edits)
            if windows and a <= windows[-1][1]:
                windows[-1][1] = max(b, windows[-1][1])
            else:
                windows.append([a, b])
        return [(m.start(), m.end(), sum(m.fuzzy_counts)) for a, b in windows for m in self.pattern.finditer(line, a, b)]


class Scanner:
    def __init__(self, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT):
        """notices: any number of them, from a table as notices_of() reads it."""
        self.base = [(b" %s " % p.encode(), label) for p, label in base.items()]
        self.notices = [Notice(p, label, chars_per_edit) for p, label in notices.items()]

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, int, int]]]:
        """Number of words; base places (word, label); spans (label, first word, last word, edits, characters of the notice)."""
        words = words_of(raw)
        line = b" %s " % b" ".join(words)
        places, spans = [], []
        for phrase, label in self.base:
            at, before, word = line.find(phrase), 0, 0
            while at >= 0:
                word += line.count(b" ", before, at)
                places.append((word, label))
                before, at = at, line.find(phrase, at + 1)
        for notice in self.notices:
            for start, end, edits in notice.spans(line):
                first, last = line.count(b" ", 0, start + 1) - 1, line.count(b" ", 0, end) - 1
                spans.append((notice.label, max(first, 0), max(first, min(last, len(words) - 1)), edits, len(notice.text)))
        return len(words), places, spans

    def score(self, places, spans) -> float:
        """1 for a base place, else the share of the best span's notice that is unchanged."""
        return 1.0 if places else max((1 - edits / size for *_, edits, size in spans), default=0.0)


SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64()), ("chars", pa.int64())])
RESULT = "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,score:double,spans:array<struct<label:string,first_word:bigint,last_word:bigint,edits:bigint,chars:bigint>>>"


def scanned(scanner_args: tuple = ()):
    """A UDF: text -> RESULT."""

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        scanner, rows = Scanner(*scanner_args), []
        for raw in texts.cast(pa.binary()):
            n, places, spans = scanner.scan(raw.as_py() or b"")
            base = {label for _, label in places}
            rows.append({
                "n_words": n, "n_base": len(places), "first_word": min(places)[0] if places else None, "last_word": max(places)[0] if places else None,
                "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {s[0] for s in spans})),
                "score": scanner.score(places, spans),
                "spans": [dict(zip(("label", "first_word", "last_word", "edits", "chars"), s, strict=True)) for s in spans],
            })
        kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(SPAN))])
        return pa.array(rows, kind)

    return run


def notices_of(rows: DataFrame, phrase: str = "phrase", label: str = "label", most: int = 100_000) -> dict[str, str]:
    """Notices from a table, folded as texts are; of two labels for one phrase the lesser stays. They go into every worker, so over ``most`` are an error."""
    own = rows.select(F.col(phrase).alias("p"), F.col(label).alias("l")).where("p is not null and l is not null").limit(most + 1).collect()
    if len(own) > most:
        raise ValueError(f"over {most} notices")
    out: dict[str, str] = {}
    for r in sorted(own, key=lambda r: r.l, reverse=True):
        if text := b" ".join(words_of(r.p.encode())).decode():
            out[text] = r.l
    return out


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", scanner_args: tuple = ()) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)."""
    small_batches(df.sparkSession)
    found = df.select(F.col(key), scanned(scanner_args)(F.col(text)).alias("found"))
    return found.select(key, *[F.col("found")[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")])


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")
