"""Publication of several tables in one commit: versions written aside, a manifest that names them, made last.

    <root>/data/<attempt>/<table>/     Parquet, never changed once written
    <root>/manifests/<number>.json     {"tables": {name: {"path", "rows"}}, "note": ...}; the greatest number is what is published

A manifest takes its number by a file that can be made only once, is written aside and renamed: so a publication is there whole or not at all, and
of two at the same time one fails and can be tried again. Tables that a publication does not name stay as they were. Readers take all tables
from one manifest.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import ConstraintError, require_no_shrink
from ..operators.storage import cut, hadoop


class Publication:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        at, files = hadoop(self.spark, f"{self.root}/manifests")
        names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """Of a version, or the last one; empty if nothing was published."""
        held = self.versions()
        if version is None and not held:
            return {"tables": {}}
        if version is not None and version not in held:
            raise ConstraintError(f"{self.root} has no version {version}")
        rows = self.spark.read.text(f"{self.root}/manifests/{held[-1] if version is None else version:08d}.json", wholetext=True)
        return json.loads(rows.first()[0])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        tables = self.manifest(version)["tables"]
        if name not in tables:
            raise ConstraintError(f"{self.root} has no table {name}")
        return self.spark.read.parquet(f"{self.root}/{tables[name]['path']}")

    def write(self, tables: dict[str, DataFrame], note: str = "", keys: dict[str, str] | None = None, allow_shrink: bool = False) -> int:
        """Publishes all of ``tables`` or none; returns the version. ``keys`` names, for guarded tables, the column whose published values may not
        go."""
        held, before, attempt = self.versions(), self.manifest(), uuid.uuid4().hex
        stored = {}
        for name, df in tables.items():
            path = f"data/{attempt}/{name}"
            df.write.parquet(f"{self.root}/{path}")
            new = self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")
            if keys and name in keys and name in before["tables"]:
                require_no_shrink(self.spark.read.parquet(f"{self.root}/{before['tables'][name]['path']}"), new, keys[name], allow_shrink)
            stored[name] = {"path": path, "rows": new.count()}
        return self._commit(held, {"tables": before["tables"] | stored, "note": note})

    def _commit(self, held: list[int], manifest: dict) -> int:
        """``held``: the versions that the manifest was made from."""
        from .tables import write_text

        at, files = hadoop(self.spark, f"{self.root}/manifests")
        files.mkdirs(at)
        taken = [int(m[1]) for f in files.listStatus(at) if (m := re.match(r"(\d+)\.(json|lock)$", f.getPath().getName()))]
        version = max(taken, default=0) + 1
        lock, _ = hadoop(self.spark, f"{self.root}/manifests/{version:08d}.lock")
        if self.versions() != held or not files.createNewFile(lock) or self.versions() != held:
            raise ConstraintError(f"{self.root} was published to meanwhile")
        aside = f"{self.root}/manifests/.{uuid.uuid4().hex}"
        write_text(self.spark, aside, json.dumps(manifest, ensure_ascii=False, sort_keys=True))
        new, _ = hadoop(self.spark, aside)
        target, _ = hadoop(self.spark, f"{self.root}/manifests/{version:08d}.json")
        if not files.rename(new, target):
            raise OSError(f"cannot rename {aside}")
        return version

    def vacuum(self, keep: int = 2) -> list[int]:
        """Deletes all but the last versions, and data that no version left names. Returns what went."""
        gone = self.versions()[:-keep]
        left = {t["path"].split("/")[1] for v in self.versions()[-keep:] for t in self.manifest(v)["tables"].values()}
        for v in gone:
            at, files = hadoop(self.spark, f"{self.root}/manifests/{v:08d}.json")
            files.delete(at, False)
        at, files = hadoop(self.spark, f"{self.root}/data")
        for f in files.listStatus(at) if files.exists(at) else []:
            if f.getPath().getName() not in left:
                files.delete(f.getPath(), True)
        return gone


def publish_split(results: DataFrame, root: str, key: str = "document_id", allow_shrink: bool = False) -> dict[str, int]:
    """Confirmed rows and the queue of all others, in one commit; refused if confirmed rows that exist would go. Returns counts by outcome."""
    rows = cut(results)
    counts = {r.outcome: r["count"] for r in rows.groupBy("outcome").count().collect()}
    good = F.coalesce(F.col("outcome") == "confirmed", F.lit(False))
    Publication(results.sparkSession, root).write({"confirmed": rows.where(good), "queue": rows.where(~good)}, "split", {"confirmed": key}, allow_shrink)
    return counts


def publish_results(results: DataFrame, parsed: DataFrame, root: str, allow_shrink: bool = False) -> int:
    """The gate's results, the parser rates they were held against and the fingerprint of these, in one commit."""
    from ..operators.gate import fingerprint_chunked, require_verified

    require_verified(results)
    mark = fingerprint_chunked(parsed, "document_id", "rate")
    return Publication(results.sparkSession, root).write({"results": results, "parsed": parsed, "fingerprint": mark}, "gate", {"results": "document_id"}, allow_shrink)


class Ledger:
    """What was ever fetched, by name: a folder of Parquet parts that are committed with the job that fetched them. Whoever asks reads the
    parts; a plan that is computed again, or read by two results, fetches nothing again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    SCHEMA = "name string, content binary, sha256 string, round int"

    def _rounds(self) -> DataFrame:
        at, files = hadoop(self.spark, self.path)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path) if files.exists(at) else self.spark.createDataFrame([], self.SCHEMA)

    def blobs(self) -> DataFrame:
        """(name, content, sha256), of names fetched more than once the last; those that could not be fetched (null content) are left out."""
        last = self._rounds().groupBy("name").agg(F.max("round").alias("round"))
        return self._rounds().join(last, ["name", "round"]).where("content is not null").select("name", "content", "sha256")

    def fetch(self, names: DataFrame, fetch, again: bool = False) -> DataFrame:
        """blobs() of ``names`` (name). Those that are not there yet, or all with ``again``, are fetched first, once: ``fetch`` takes names and gives
        (name, content); null content is one that failed, to be tried by the next call."""
        names = cut(names.select("name").distinct())
        wanted = names if again else names.join(self.blobs().select("name"), "name", "left_anti")
        wanted = cut(wanted)
        if wanted.limit(1).count():
            nth = (self._rounds().agg(F.max("round")).first()[0] or 0) + 1
            rows = fetch(wanted).select("name", "content", F.sha2("content", 256).alias("sha256"), F.lit(nth).alias("round"))
            rows.write.mode("append").parquet(self.path)
        return self.blobs().join(names, "name", "left_semi")


def read_through(files: DataFrame, sidecars: DataFrame, fetch, ledger: Ledger) -> tuple[DataFrame, DataFrame]:
    """Verified blobs with those fetched anew, as tables.read_through, and the sidecars to write; each wanted name is fetched once, by the
    ledger. A name whose digest fails is fetched again even if the ledger has it, unless the ledger's digest is what its sidecar asks for."""
    from .tables import verified_blobs

    good, again = verified_blobs(files, sidecars)
    again = cut(again)
    held = ledger.blobs().select("name", "sha256")
    stale = again.join(held, "name").join(sidecars.select("name", F.col("sha256").alias("wanted")), "name").where("sha256 <> wanted").select("name")
    ledger.fetch(stale, fetch, again=True)
    new = ledger.fetch(again, fetch)
    return good.select("name", "content", "sha256").unionByName(new), new.select("name", "sha256")
