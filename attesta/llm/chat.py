"""Chat formatting by schema fingerprints.

A record is JSON in any of several layouts: message lists under different names, prompt and response, instruction with
input and output, rows of turns. Its fingerprint is a hash of its set of nested field paths (nulls left out, lists
as ``[]``). Each declarative mapping lists the paths it needs and those it tolerates, and all the fingerprints it
covers are computed beforehand, so that choosing a mapping is one lookup. A mapping yields canonical turns (role, text).

The template writes ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Control strings in texts and roles are escaped
reversibly: every ``<``, backslashes, ``|`` gets one more backslash, so ``<|`` stands only where the template put it. The
loss mask lists the spans (in code points) of the assistant texts.

Null texts and roles are empty; a record of no known layout, a null or malformed record gives no turns, layout null and an empty
text. Repeated turns stay, ordered by turn, role, text. An empty table gives an empty result. A conversation
becomes one text by definition, so that its size, however long its texts, and not the table's, bounds a task's memory. A null key is one
conversation. Columns other than those named are not read, so their names cannot clash. ``unknown_layouts`` counts what no mapping covers.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

START, END = "<|im_start|>", "<|im_end|>"
#: Names of roles in other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


def paths(value: object, at: str = "") -> set[str]:
    """Nested field paths; nulls have none."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, f"{at}[]")} or {f"{at}[]"}
    return set() if value is None else {at}


def fingerprint(of: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(of)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """``each``: the list of turns with its role, text and order fields; or ``fixed``: (role, fields joined by blank lines)."""

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    each: tuple[str, str, str, str | None] | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    exact_roles: bool = False

    def fingerprints(self) -> list[str]:
        return [fingerprint({*self.needs, *some}) for n in range(len(self.may) + 1) for some in itertools.combinations(self.may, n)]

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.each:
            rows, role, text, _ = record.get(self.each[0]) or [], *self.each[1:]
            named = _text if self.exact_roles else _role
            return [(named(r.get(role)), _text(r.get(text))) for r in rows if isinstance(r, dict)]
        out = []
        for role, fields in self.fixed:
            given = [_text(record[f]) for f in fields if record.get(f) is not None]
            if given:
                out.append((role, "\n\n".join(given)))
        return out


def _role(value: object) -> str:
    value = _text(value)
    return ROLES.get(value, value)


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


EXTRA = ("id", "source")
MAPPINGS = (
    Mapping("messages", ("messages[].role",), ("messages[].content", "messages[].name", *EXTRA), ("messages", "role", "content", None)),
    Mapping("conversations", ("conversations[].from",), ("conversations[].value", *EXTRA), ("conversations", "from", "value", None)),
    Mapping("rows", (), ("turns[].turn", "turns[].role", "turns[].text", "turns[]", *EXTRA), ("turns", "role", "text", "turn"), exact_roles=True),
    Mapping("prompt-response", ("prompt", "response"), ("system", *EXTRA), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt-completion", ("prompt", "completion"), ("system", *EXTRA), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("instruction", ("instruction", "output"), ("input", "system", *EXTRA), fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("question", ("question", "answer"), ("context", *EXTRA), fixed=(("user", ("context", "question")), ("assistant", ("answer",)))),
)
LAYOUTS = {f: m for m in reversed(MAPPINGS) for f in m.fingerprints()}


def canonical(record: str | None) -> tuple[str | None, str | None, list[tuple[str, str]]]:
    """(fingerprint, layout, turns) of a JSON record."""
    try:
        value = json.loads(record) if record is not None else None
    except ValueError:
        value = None
    if not isinstance(value, dict):
        return None, None, []
    own = fingerprint(paths(value))
    mapping = LAYOUTS.get(own)
    return own, mapping and mapping.name, mapping.turns(value) if mapping else []


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of its loss mask."""
    parts, mask, size = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_escape_role(role)}\n", escape(text)
        if role == "assistant":
            mask.append((size + len(head), size + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        size += len(head) + len(body) + len(END) + 1
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, body = part.partition("\n")
        out.append((_unescape_role(role), unescape(body[: -len(END) - 1])))
    return out


RESULT = pa.struct([("schema", pa.string()), ("layout", pa.string()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


FORMATTED = "struct<schema:string,layout:string,formatted:string,loss:array<struct<start:bigint,stop:bigint>>>"
DIGESTS = "struct<n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string,formatted_chars:bigint>"


def formatted(records: pa.Array) -> pa.Array:
    rows = []
    for record in records:
        schema, layout, turns = canonical(record.as_py())
        text, mask = render(turns)
        rows.append({"schema": schema, "layout": layout, "formatted": text, "loss": [{"start": a, "stop": b} for a, b in mask]})
    return pa.array(rows, RESULT)


def format_chats(df: DataFrame, key: str, record: str) -> DataFrame:
    """(key, schema, layout, formatted, loss) of JSON records."""
    small_batches(df.sparkSession)
    return df.select(F.col(key), F.arrow_udf(formatted, FORMATTED)(F.col(record)).alias("out")).select(key, "out.*")


def unknown_layouts(formatted: DataFrame) -> DataFrame:
    """(schema, n) of the records that no mapping covers, so that a new layout is noticed and not lost."""
    return formatted.where("layout is null").groupBy("schema").agg(F.count(F.lit(1)).alias("n"))


def records_of_rows(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, record): one JSON record with its ordered turns for each key."""
    each = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    gathered = rows.groupBy(F.col(key)).agg(F.sort_array(F.collect_list(each)).alias("turns"))
    return gathered.select(key, F.to_json(F.struct("turns")).alias("record"))


def digests(texts: pa.Array, masks: pa.Array) -> pa.Array:
    """Read back from the formatted text and its mask."""
    rows = []
    for text, mask in zip(texts, masks, strict=True):
        text = text.as_py()
        turns = parse(text)
        loss = "".join(unescape(text[m["start"] : m["stop"]]) for m in mask.as_py())
        told = "".join(f"{role}\n{body}\n" for role, body in turns)
        rows.append({"n_turns": len(turns), "turns_sha256": hashlib.sha256(told.encode()).hexdigest(), "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(text)})
    return pa.array(rows, pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(f"{END}{START}assistant ok")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    out = format_chats(records_of_rows(rows.unionByName(added)), "conv_id", "record")
    return out.select("conv_id", F.arrow_udf(digests, DIGESTS)("formatted", "loss").alias("d")).select("conv_id", "d.*")
