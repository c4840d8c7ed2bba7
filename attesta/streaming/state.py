"""Watching with state: what is new, changed, gone or back in listings that come as files, and bodies that say nothing for weeks.

State is held by group of documents, and by body, in Spark's state store: a query can be stopped and started on its checkpoint between any two files. Rows within
the lateness are put in their place in time; a document not seen for ``period`` is gone from that day on, told by a timer of event time, whether or not
rows of it come again. ``alarms`` tells apart a body that was listed and did not change from one that could not be checked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHANGES = "body string, document_id string, change string, at timestamp"
ALARMS = "body string, alarm string, at timestamp"
#: Groups that documents are dealt into.
GROUPS = 1024
_UTC = "UTC"
_KNOWN = pa.schema([("body", pa.string()), ("document_id", pa.string()), ("title", pa.string()), ("seen", pa.int64()), ("due", pa.int64())])


def _micros(times: pd.Series) -> list[int]:
    return [int(t.value // 1000) for t in pd.to_datetime(times)]


def _stamp(us: int) -> pd.Timestamp:
    return pd.Timestamp(us * 1000)


def _codes(values: pd.Series, ordered: bool = False) -> np.ndarray:
    """Numbers from 0 for distinct values, -1 for null; in their order, if asked for."""
    return pd.factorize(values, sort=ordered)[0].astype("int64")


def _listed(known: pd.DataFrame, rows: pd.DataFrame, gap: int, watermark: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(CHANGES with ``at`` in microseconds, what is known afterwards). known: (body, document_id, title, seen, due), a document once, due: the
    millisecond after which it is gone; rows: (body, document_id, title, seen) in any order."""
    known, rows = known.assign(fresh=False), rows.assign(due=0, fresh=True)
    each = pd.concat([known, rows], ignore_index=True) if len(known) and len(rows) else rows if len(rows) else known
    document = _codes(each["document_id"])
    document += _codes(each["body"]) * (document.max(initial=0) + 1)
    seen, fresh, title = each["seen"].to_numpy("int64"), each["fresh"].to_numpy(bool), _codes(each["title"], True)
    order = np.lexsort((title, seen, fresh, document))  # what is known comes first, a null title before others
    each, document, seen, fresh, title = each.iloc[order], document[order], seen[order], fresh[order], title[order]
    first = np.append(True, document[1:] != document[:-1])[: len(each)]
    start = np.flatnonzero(first)
    of = np.cumsum(first) - 1
    listed = np.bincount(of[fresh], minlength=len(start)) > 0
    # a row older than the last sight only shows that the document was there
    stays = ~fresh | fresh[start][of] | (seen >= seen[start][of])
    each, seen, fresh, title, of = each[stays], seen[stays], fresh[stays], title[stays], of[stays]
    first = np.append(True, of[1:] != of[:-1])[: len(each)]
    last = np.append(first[1:], True)[: len(each)]
    away = np.append(0, seen[1:] - seen[:-1])[: len(each)] > gap
    other = np.append(True, title[1:] != title[:-1])[: len(each)]
    left = each[last].assign(fresh=listed)
    left["due"] = np.where(listed, np.maximum((left["seen"] + gap) // 1000 + 1, watermark + 1), left["due"])
    over = ~left["fresh"] & (left["due"] < watermark)
    told = [(first & fresh, "new", seen), (~first & away, "new", seen), (~first & away, "gone", np.append(0, seen[:-1])[: len(each)] + gap), (~first & ~away & other, "changed", seen)]
    parts = [each.loc[which, ["body", "document_id"]].assign(change=change, at=at[which]) for which, change, at in told if which.any()]
    if over.any():
        parts.append(left.loc[over, ["body", "document_id"]].assign(change="gone", at=left.loc[over, "seen"] + gap))
    return pd.concat(parts) if parts else pd.DataFrame(), left.loc[~over, _KNOWN.names]


def changes(listings: DataFrame, period: str = "7 days", lateness: str = "7 days", groups: int = GROUPS) -> DataFrame:
    """listings: a stream of (body, document_id, title, fetched_at). CHANGES: ``new`` at first sight, ``changed`` when the title differs from the one
    before it in time, ``gone`` at ``period`` after the last sight, then ``new`` again. A row older than the state's last sight only shows that the document
    was there: it changes nothing. Repeated rows change nothing.

    Documents are dealt by a hash into ``groups``, which share a state and a timer and are compared at once: a call for each document would cost
    most of the time. The number is fixed for a checkpoint; a group's state, some 50 bytes a document, is written anew when a row or a timer meets it."""
    gap = int(pd.Timedelta(period).value // 1000)

    def step(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = pa.ipc.open_stream(bytes(state.get[0])).read_pandas() if state.exists else _KNOWN.empty_table().to_pandas()
        rows = [] if state.hasTimedOut else [f.assign(seen=pd.to_datetime(f["fetched_at"]).to_numpy("datetime64[us]").astype("int64"))[["body", "document_id", "title", "seen"]] for f in frames]
        out, left = _listed(known, pd.concat(rows, ignore_index=True) if rows else known.head(0).drop(columns="due"), gap, state.getCurrentWatermarkMs())
        if len(left):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _KNOWN) as writer:
                writer.write_table(pa.Table.from_pandas(left, _KNOWN, preserve_index=False))
            state.update((sink.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(int(left["due"].min()))
        elif state.exists:
            state.remove()
        if len(out):
            yield out.assign(at=out["at"].to_numpy("datetime64[us]"))

    known = listings.where(F.col("document_id").isNotNull() & F.col("fetched_at").isNotNull())
    keyed = known.select(F.coalesce("body", F.lit("")).alias("body"), "document_id", "title", "fetched_at").withWatermark("fetched_at", lateness)
    dealt = keyed.withColumn("__group", F.pmod(F.xxhash64("body", "document_id"), F.lit(groups)).cast("int"))
    return dealt.groupBy("__group").applyInPandasWithState(step, CHANGES, "known binary", "append", GroupStateTimeout.EventTimeTimeout)


def alarms(listed: DataFrame, told: DataFrame, quiet: str = "28 days", lateness: str = "7 days", period: str = "7 days") -> DataFrame:
    """listed: a stream of (body, fetched_at), one row for each listing that was read; told: a stream of CHANGES. ALARMS: ``no-change`` when a body's last
    change is ``quiet`` ago although it was listed within ``period`` before that moment, ``could-not-check`` when it was not. An alarm is told
    once until the next change."""
    still, near = (int(pd.Timedelta(x).value // 1000) for x in (quiet, period))

    def step(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (body,) = key
        changed, seen, done = state.get if state.exists else (None, None, False)
        if state.hasTimedOut:
            at = changed + still
            state.update((changed, seen, True))
            yield pd.DataFrame({"body": [body], "alarm": ["no-change" if seen is not None and seen >= at - near else "could-not-check"], "at": [_stamp(at)]})
            return
        for f in frames:
            for at, is_change in zip(_micros(f["at"]), f["is_change"], strict=True):
                if is_change and (changed is None or at > changed):
                    changed, done = at, False
                elif not is_change:
                    seen = at if seen is None else max(seen, at)
                    changed = at if changed is None else changed  # quiet counts from the first listing
        state.update((changed, seen, done))
        if not done and changed is not None:
            state.setTimeoutTimestamp(max((changed + still) // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    body = F.coalesce("body", F.lit("")).alias("body")
    both = listed.select(body, F.col("fetched_at").alias("at"), F.lit(False).alias("is_change")).union(told.select(body, "at", F.lit(True).alias("is_change")))
    keyed = both.where("at is not null").withWatermark("at", lateness)
    return keyed.groupBy("body").applyInPandasWithState(step, ALARMS, "changed long, seen long, done boolean", "append", GroupStateTimeout.EventTimeTimeout)


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Takes what there is, appends it to Parquet files exactly once, and ends; the next call goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
