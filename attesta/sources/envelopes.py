"""Lists inside JSON envelopes of any size: {"method": ..., "rows": [{...}, ...], ...} read in splits, one row for each object.

Spark's text source cuts files at closing braces, so that a piece is never longer than the text between two of them, and hands pieces to
tasks by splits of the file. What a piece means depends on what stands before it: whether a string is open, how deep it lies, under which
top-level name. Three passes settle that without any task reading more than its split:

1. each split tells, for both cases (it starts inside a string or not), whether it ends inside one, and how its depth changes;
2. from these, added up in order (a row for each split), each split knows its start; it gives the objects that lie in it whole, the first and
   last fragments of those that do not, and the last top-level name that it has seen;
3. fragments of one object, few and short, are put together, and rows take their name from the split before if their own has none.

Objects are parsed with a given schema; an object that is no JSON is an error. Lists at the top have the name null. Lists of other things than
objects, and lists further inside, are part of what holds them. Escapes split by a piece's end cannot occur: a brace is never part of one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.constraints import ConstraintError, require
from ..operators.storage import cut

TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """((path, start), pieces): the pieces of one split in their order; long splits come in several parts."""
    for b in batches:
        key, pieces = None, []
        for path, start, value in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if (path, start) != key:
                if pieces:
                    yield key, pieces
                key, pieces = (path, start), []
            pieces.append(value + "}")
        if pieces:
            yield key, pieces


def _ends(batches):
    """(path, start, inside, ends_inside, delta) of each part of a split, in order of ``part``."""
    out, last, part = [], None, 0
    for (path, start), pieces in _splits(batches):
        part = part + 1 if (path, start) == last else 0
        last = (path, start)
        for inside in (False, True):
            open_, depth = inside, 0
            for piece in pieces:
                for m in TOKEN.finditer(piece):
                    c = m[0]
                    if c == '"':
                        open_ = not open_
                    elif not open_ and c in "{[":
                        depth += 1
                    elif not open_ and c in "}]":
                        depth -= 1
            out.append({"path": path, "start": start, "part": part, "inside": inside, "ends_inside": open_, "delta": depth})
        if len(out) >= 512:
            yield pa.RecordBatch.from_pylist(out)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out)


class _Reader:
    """Goes through a split's pieces from a known start and gives (kind, name, text): whole objects, ``tail`` of one that began before,
    ``head`` of one that ends later; (name) is null until the split has a top-level name."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth, self.name, self.named = inside, depth, None, False
        self.text: list[str] = []
        self.whole = depth < 3  # an object that is open at the start is no whole one
        self.string: list[str] | None = None

    def feed(self, piece: str) -> Iterator[tuple[str, str | None, str]]:
        at = 0
        for m in TOKEN.finditer(piece):
            c = m[0]
            if c[0] == "\\":
                continue
            if c == '"':
                self.inside = not self.inside
                if self.depth == 1:  # the last string before a list is its name
                    if self.inside:
                        self.string = [piece[m.end() :]]
                        self.from_ = m.end()
                    elif self.string is not None:
                        self.name, self.named = json.loads('"' + piece[self.from_ : m.start()] + '"'), True
                        self.string = None
            elif not self.inside and c in "{[":
                self.depth += 1
                if self.depth == 3 and c == "{":
                    at = m.start()
                    self.whole, self.text = True, []
            elif not self.inside and c in "}]":
                self.depth -= 1
                if self.depth == 2 and c == "}":
                    self.text.append(piece[at : m.end()])
                    yield ("whole" if self.whole else "tail", self.name if self.named else None, "".join(self.text))
                    self.text, at = [], m.end()
                    self.whole = True
        if self.depth >= 3:
            self.text.append(piece[at:])


def _objects(starts: dict[tuple[str, int], tuple[bool, int]]):
    def run(batches):
        reader, last, seq, out = None, None, 0, []
        row = lambda kind, name, text: out.append({"path": last[0], "start": last[1], "seq": seq, "kind": kind, "name": name, "text": text})

        def end():
            if reader is None:
                return
            if reader.depth >= 3 and reader.text:
                row("head" if reader.whole else "middle", reader.name if reader.named else None, "".join(reader.text))
            row("name", reader.name if reader.named else None, "")

        for key, pieces in _splits(batches):
            if key != last:
                end()
                inside, depth = starts.get(key, (False, 0))
                reader, last, seq = _Reader(inside, depth), key, 0
            for piece in pieces:
                for told in reader.feed(piece):
                    row(*told)
                    seq += 1
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out, schema=_ROW)
                out.clear()
        end()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_ROW)

    return run


_ROW = pa.schema([("path", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("kind", pa.string()), ("name", pa.string()), ("text", pa.string())])


def objects(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, text): each object of the lists that stand at the second level of JSON files, with the top-level name of its list."""
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    told: dict[tuple[str, int], list] = {}
    for r in pieces.mapInArrow(_ends, "path string, start long, part long, inside boolean, ends_inside boolean, delta long").orderBy("path", "start", "part").collect():  # two for each part of a split
        told.setdefault((r.path, r.start), []).append(r)
    starts, before = {}, None
    for key in sorted(told):
        inside, depth = (False, 0) if before is None or before != key[0] else (inside, depth)
        before = key[0]
        starts[key] = (inside, depth)
        for part in sorted({r.part for r in told[key]}):
            own = next(r for r in told[key] if r.part == part and r.inside == inside)
            inside, depth = own.ends_inside, depth + own.delta
    rows = cut(pieces.mapInArrow(_objects(starts), "path string, start long, seq long, kind string, name string, text string"))
    own = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    names = rows.where("kind = 'name'").select("path", "start", F.last("name", True).over(own).alias("before"))
    named = rows.where("kind <> 'name'").join(F.broadcast(names), ["path", "start"]).select("path", "start", "kind", F.coalesce("name", "before").alias("name"), "text")
    begun = F.sum(F.when(F.col("kind") == "head", 1).otherwise(0)).over(W.partitionBy("path").orderBy("start", F.when(F.col("kind") == "tail", 0).when(F.col("kind") == "middle", 1).otherwise(2)))
    parts = named.where("kind <> 'whole'").select("*", begun.alias("nth"))  # at most two for each split
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", F.when(F.col("kind") == "tail", 0).otherwise(1).alias("k"), "text"))), lambda x: x["text"]), "")
    stitched = parts.groupBy("path", "nth").agg(F.min_by("name", F.struct("start", F.col("kind") != "head")).alias("name"), whole.alias("text"))
    return named.where("kind = 'whole'").select("path", "name", "text").unionByName(stitched.select("path", "name", "text"))


def read_large_envelope(spark: SparkSession, path: str, field: str, schema: T.StructType) -> DataFrame:
    """The rows of {..., field: [...]}, as tables.read_envelope with a schema, for files of any size. A field that is nowhere is an error."""
    found = objects(spark, path).where(F.col("name") == field)
    if not found.limit(1).count() and not spark.read.text(path).where(F.col("value").contains(json.dumps(field))).limit(1).count():
        raise ConstraintError(f"{path} has no {field}")
    parsed = found.select(F.from_json("text", schema).alias("r"), "text")
    require(parsed.where(F.col("r").isNull()).select("text"), "no JSON")
    return parsed.select("r.*")
