"""BPE encoding and decoding by a bounded-lookahead streaming transducer.

Sufficient lookahead. Take the merge runs over a text u and over u + v. They differ only right of a frontier, which
starts at the end of u and moves left past a token L only when one of the runs merges (L, R) with an R that starts at the
frontier. Ranks rise from move to move, and the next R starts with the L just passed: it has L on the left
spine of its derivation. So the bytes that v can change before the end of u are at most the longest chain of rules with rising
ranks, each chained to a later rule whose right part has the former's left part on its left spine, weighing the
left parts' lengths. ``Merges.lookahead`` computes that chain once for a merge list. A token that ends this many bytes
before what has been read is stable, and can be emitted; merging restarts at its end. Merge lists in which a token
is used before it is made have no such bound; they are refused.

The transducer holds a few lookaheads of bytes however long a piece between pre-token boundaries is; texts are read in
windows of WINDOW characters, cut only where a non-space meets a space (always a boundary). Short pieces are answered from a
bounded memo of the transducer's results.

Decoding feeds the tokens' bytes, block by block, to an incremental UTF-8 state machine that keeps at most an incomplete
character; malformed bytes become U+FFFD.

Null and empty texts have no tokens and decode to an empty text. Control strings of the vocabulary (special tokens)
inside texts are encoded as such, as the public library does by default. Rows are independent: repeated rows and
keys, clashing extra columns and empty tables need no care.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, small_batches, table

# The public byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+".replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
# The same classes within Latin-1, for the faster standard regex module.
LETTERS, NUMBERS, SPACES = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
VOCABULARY = "byte_bpe_50k.json"
#: Characters of a text that are split at a time; pieces memoized; the longest memoized piece.
WINDOW, MEMO, MEMO_CHARS = 1 << 16, 3 << 16, 48
#: A vocabulary file is broadcast; it has at most so many bytes.
VOCABULARY_BYTES = 64 << 20
BLOCK = 4096


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """A byte-level merge list with its vocabulary and sufficient lookahead."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        symbol = byte_symbols()
        vocab = spec["model"]["vocab"]
        raw = {t: bytes(symbol[c] for c in t) for t in vocab if all(c in symbol for c in t)}
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.bytes_of = {i: raw.get(t, t.encode()) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.byte_id = [0] * 256
        for token, value in raw.items():
            if len(value) == 1:
                self.byte_id[value[0]] = vocab[token]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, int] = {}
        parts: dict[int, tuple[int, int]] = {}
        rules = []
        for r, rule in enumerate(spec["model"]["merges"]):
            a, b = rule.split(" ") if isinstance(rule, str) else rule
            a, b, c = vocab[a], vocab[b], vocab[a + b]
            if made.get(a, -1) >= r or made.get(b, -1) >= r or c in made:
                raise ValueError("a merge list must make each token once, before it is used")
            made[c], parts[c] = r, (a, b)
            self.rank[a, b] = (r, c)
            rules.append((a, b))
        self.rank_of = {pair: r for pair, (r, _) in self.rank.items()}
        self.made = [c for _, c in sorted(self.rank.values())]
        self.lookahead = self._lookahead(rules, parts)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _lookahead(self, rules: list[tuple[int, int]], parts: dict[int, tuple[int, int]]) -> int:
        longest: dict[int, int] = {}  # by token: the longest chain whose first right part has it on its left spine
        most = 0
        for a, b in reversed(rules):
            chain = len(self.bytes_of[a]) + longest.get(a, 0)
            most = max(most, chain)
            while True:
                if longest.get(b, 0) < chain:
                    longest[b] = chain
                if b not in parts:
                    break
                b = parts[b][0]
        return most + max(map(len, self.bytes_of.values()))

    def merge(self, piece: bytes) -> list[int]:
        """All merges over one piece."""
        ids = [self.byte_id[b] for b in piece]
        if len(ids) > 64:
            return self._merge_long(ids)
        rank, made, none = self.rank_of.get, self.made, len(self.made)
        ranks = [rank(p, none) for p in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i : i + 2] = (made[best],)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.rank[p], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank]
        heap = [(r, i, a, b, c) for r, c, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, c = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = c, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (hit := self.rank.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (hit[0], left, ids[left], ids[right], hit[1]))
        return [x for x in ids if x >= 0]


class Transducer:
    """Bytes of one piece in, stable tokens out; keeps less than 5 lookaheads of bytes."""

    def __init__(self, merges: Merges):
        self.merges, self.held = merges, b""

    def feed(self, data: bytes) -> Iterator[int]:
        ahead = self.merges.lookahead
        for start in range(0, len(data), ahead):
            self.held += data[start : start + ahead]
            if len(self.held) >= 4 * ahead:
                limit, end = len(self.held) - ahead, 0
                for token in self.merges.merge(self.held):
                    if end + (size := len(self.merges.bytes_of[token])) > limit:
                        break
                    end += size
                    yield token
                self.held = self.held[end:]

    def finish(self) -> list[int]:
        out, self.held = self.merges.merge(self.held), b""
        return out


class Encoder:
    def __init__(self, merges: Merges, window: int = WINDOW, memo: int = MEMO):
        self.merges, self.window, self.memo_size = merges, window, memo
        self.memo: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.pieces, self.latin = regex.compile(PATTERN), re.compile(LATIN_PATTERN)
        self.space = regex.compile(r"\p{White_Space}")
        self.cut = regex.compile(r"(?r)(?<=\P{White_Space})(?=\p{White_Space})")
        self.runs = [regex.compile(x) for x in (r"\p{L}+", r"\p{N}+", r"[^\p{White_Space}\p{L}\p{N}]+")]

    def forget(self) -> None:
        self.memo, self.older = {}, {}

    def piece(self, text: str) -> str:
        """The ids of a whole piece, comma-joined."""
        out = self.older.get(text)
        if out is None:
            machine = Transducer(self.merges)
            data = text.encode()
            if len(data) <= self.merges.lookahead:
                machine.held, ids = data, []  # nothing can be stable yet
            else:
                ids = list(machine.feed(data))
            out = ",".join(map(str, ids + machine.finish()))
        if len(text) <= MEMO_CHARS:
            if len(self.memo) >= self.memo_size:
                self.memo, self.older = {}, self.memo
            self.memo[text] = out
        return out

    def blocks(self, text: str) -> Iterator[str]:
        """Comma-joined ids of a text, block by block."""
        split = self.merges.special_split
        for part in split.split(text) if split and split.search(text) else (text,):
            if part in self.merges.special:
                yield str(self.merges.special[part])
            elif part:
                yield from self._ordinary(part)

    def _ordinary(self, text: str) -> Iterator[str]:
        at, n = 0, len(text)
        piece, find = self.piece, self.pieces.findall
        try:
            text.encode("latin-1")
            find = self.latin.findall
        except UnicodeEncodeError:
            pass
        while at < n:
            end = min(n, at + self.window)
            if end < n:
                found = self.cut.search(text, at + 1, end)
                if not found:
                    at = yield from self._unbroken(text, at)
                    continue
                end = found.start()
            memo = self.memo
            yield ",".join([memo.get(x) or piece(x) for x in find(text, at, end)])
            at = end

    def _unbroken(self, text: str, at: int) -> Iterator[str]:
        """One piece, which may be longer than any window; returns where it ends."""
        n, step = len(text), self.window
        machine = Transducer(self.merges)
        if self.space.match(text, at) and not (text[at] == " " and at + 1 < n and not self.space.match(text, at + 1)):
            end = at  # a run of spaces: all but the last, if a word follows
            while end < n and self.space.match(text, end):
                end += 1
            if end < n and end - at > 1:
                end -= 1
        else:
            first = self.pieces.match(text, at, min(n, at + step))
            end = first.end()
            if end == at + step:  # may go on
                run = next(r for r in self.runs if r.match(text, end - 1))
                while end < n and (more := run.match(text, end, min(n, end + step))):
                    end = more.end()
        for start in range(at, end, step):
            if ids := list(machine.feed(text[start : min(end, start + step)].encode())):
                yield ",".join(map(str, ids))
        if ids := machine.finish():
            yield ",".join(map(str, ids))
        return end

    def encode(self, text: str) -> list[int]:
        return [int(x) for block in self.blocks(text) for x in block.split(",")]


class Decoder:
    """Ids in, text out: an incremental byte-to-text state machine."""

    def __init__(self, merges: Merges):
        self.bytes_of = {str(i): b for i, b in merges.bytes_of.items()}
        self.reset()

    def reset(self) -> None:
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[str]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        out = self.state.decode(b"", True)
        self.reset()
        return out


_loaded: dict[int, tuple[Encoder, Decoder]] = {}


def _coders(shared) -> tuple[Encoder, Decoder]:
    if shared.id not in _loaded:
        merges = Merges(shared.value)
        _loaded.clear()
        _loaded[shared.id] = Encoder(merges), Decoder(merges)
    return _loaded[shared.id]


class _Shared:
    def __init__(self, broadcast, key: int):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self) -> str:
        return self.broadcast.value


def share(spark: SparkSession, path: str | None = None) -> _Shared:
    """Broadcast a vocabulary file (its size is checked)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if len(text) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is too large to broadcast")
    return _Shared(spark.sparkContext.broadcast(text), hash(text))


RESULT = {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string()), "ids": ("array<int>", pa.list_(pa.int32()))}


def digests(shared, ids_too: bool = False):
    """A UDF: text -> (n_tokens, ids_sha256, decoded_sha256), and the ids; texts stream through in blocks."""
    names = [n for n in RESULT if n != "ids" or ids_too]

    def coded(encoder: Encoder, decoder: Decoder, texts: pa.Array) -> pa.Array:
        out = {n: [] for n in names}
        for text in texts:
            ids_sha, text_sha, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []
            for block in encoder.blocks(text.as_py() or ""):
                ids_sha.update(("," + block if n else block).encode())
                ids = block.split(",")
                n += len(ids)
                text_sha.update(decoder.feed(ids).encode())
                if ids_too:
                    kept.append(np.array(ids, np.int32))
            text_sha.update(decoder.finish().encode())
            for name, value in zip(names, (n, ids_sha.hexdigest(), text_sha.hexdigest(), np.concatenate([np.zeros(0, np.int32), *kept])), strict=False):
                out[name].append(value)
        return pa.StructArray.from_arrays([pa.array(out[n], RESULT[n][1]) for n in names], names)

    @F.arrow_udf(f"struct<{','.join(f'{n}:{RESULT[n][0]}' for n in names)}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = _coders(shared)
        try:
            for texts in batches:
                yield coded(encoder, decoder, texts)
        finally:  # workers live on between tasks, beside the executor's heap
            encoder.forget()
            release()

    return run


def encode_column(shared):
    """A UDF: text -> array of ids."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        encoder, _ = _coders(shared)
        return pa.array([encoder.encode(t.as_py() or "") for t in texts], pa.list_(pa.int32()))

    return run


def decode_column(shared):
    """A UDF: array of ids -> text; null for null, U+FFFD for bytes that are no text."""

    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        _, decoder = _coders(shared)
        out = []
        for row in rows:
            ids = row.as_py()
            out.append(None if ids is None else "".join(decoder.feed([str(i) for i in ids[s : s + BLOCK]]) for s in range(0, len(ids), BLOCK)) + decoder.finish())
        return pa.array(out, pa.string())

    return run


def encode_decode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256)."""
    small_batches(df.sparkSession)
    coded = df.select(F.col(key), digests(share(df.sparkSession, path))(F.col(text)).alias("coded"))
    return coded.select(key, "coded.n_tokens", "coded.ids_sha256", "coded.decoded_sha256")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))
