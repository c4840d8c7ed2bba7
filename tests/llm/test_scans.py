"""License scan, decontamination, chat formatting: against plain versions."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from attesta.llm import chat, decontamination, licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


NOISE = ["and", "The", "x1", "é b", "mit", "license", "under", "cc", "by", "nc", "2"]


def notices(rng):
    base = ["Under the MIT License", "Apache License, Version 2", "CC-BY-NC", "cc by nc cc by nc", "under the mit licence", "Redistribution and use in sourc and binary forms"]
    for _ in range(200):
        parts = [rng.choice(NOISE) for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(base))
        yield rng.choice([" ", ", ", "\n"]).join(parts)


def test_license_base(spark):
    texts = [*notices(random.Random(1)), None, "", "CC BY NC " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("found", F.lit(1))
    for r in licenses.scan(df).collect():
        w = words(texts[r.doc_id])
        places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[1] for p in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_license_errors():
    scanner = licenses.Scanner()
    line = b"all of it is redistributon and use in source nd binary forms ok"
    _, places, spans = scanner.scan(line)
    assert not places and [(s[0], s[1], s[3]) for s in spans] == [("bsd", 4, 2)]
    assert scanner.scan(b"under the xyz lice")[2] == []


def test_seeds_lose_nothing():
    import regex

    rng = random.Random(2)
    notice = licenses.Notice("under the mit license", "mit")
    for _ in range(500):
        text = list("under the mit license")
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["q"], [text[at], "q"]])
        line = b" zz " + "".join(text).encode() + b" zz "
        assert bool(notice.spans(line)) == bool(regex.search(rb"(?:under the mit license){e<=2}", line))


def decontaminated(docs, items, window=13):
    known = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[s : s + n]), set()).add(i)
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(k) for k in known}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s : s + n])) in known:
                    hit |= set(range(s, s + n))
                    found |= known[k]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_decontamination(spark, block):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["a", "B", "c,d", "é"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 13, 14, 30]))) for i in range(12)] + [(3, "a a b"), (100, None), (101, "uniq words here")]
    docs = [(i, text(rng.randrange(60))) for i in range(60)] + [(60, None), (61, ""), (62, "x " + (items[5][1] or "y") + " z"), (62, "uniq words here")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("found", F.lit(1)).withColumn("item_id", F.lit(1))
    got = sorted(tuple(r) for r in decontamination.contamination(d, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block).collect())
    assert got == sorted(decontaminated(docs, items))


@pytest.mark.parametrize("shingle", [5, 2])
def test_decontamination_by_a_shuffle_join(spark, shingle):
    """A benchmark beyond the bound of a broadcast: the same rows, and the same documents stay."""
    rng = random.Random(17)
    text = lambda n: " ".join(rng.choice(["a", "B", "c,d", "é", "f", "g"]) for _ in range(n))
    items = [(f"i{i}", text(rng.choice([0, 1, 3, 4, 13, 14, 30]))) for i in range(20)] + [("i3", "a a b"), (None, "no one has this"), ("i100", None), ("i101", "uniq words here")]
    long = [t for _, t in items if t and len(t.split()) > 12]
    docs = [(i, text(rng.randrange(60))) for i in range(60)] + [(60, None), (61, ""), (62, "x " + long[0] + " z"), (None, "uniq words here"), (62, "uniq words here")]
    docs += [(100 + i, long[1] + " q" * 400) for i in range(30)] + [(200, "w " * 2000 + long[2] + " no one has this")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cls", F.lit("x")).withColumn("h", F.lit(1))
    b = spark.createDataFrame(items, "item_id string, text string")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    got = order(decontamination.contamination(d, b, shingle=shingle, broadcast_bytes=100).collect())
    assert got == order(decontaminated(docs, items)) == order(decontamination.contamination(d, b, shingle=shingle).collect())
    stay = lambda most: order(decontamination.clean(d, b, broadcast_bytes=most).collect())
    assert stay(100) == stay(1 << 20) and 0 < len(stay(100)) < len(docs)


def test_decontamination_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.contaminated for r in decontamination.contamination(docs, none).collect()] == [False]
    assert decontamination.contamination(docs.limit(0), none).count() == 0


RECORDS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo", "name": "x"}]}, "messages", [("user", "hi"), ("assistant", "yo")]),
    ({"messages": [{"role": "user", "content": None}]}, "messages", [("user", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 3}, "conversations", [("user", "q"), ("assistant", "a")]),
    ({"prompt": "p", "response": "r"}, "prompt-response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "completion": "r", "system": "s"}, "prompt-completion", [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"instruction": "i", "input": "n", "output": "o"}, "instruction", [("user", "i\n\nn"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o", "input": None}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"question": "q", "answer": {"a": 1}}, None, []),
    ({"odd": 1}, None, []),
]


def test_layouts():
    for record, layout, turns in RECORDS:
        assert chat.canonical(json.dumps(record))[1:] == (layout, turns)
    for bad in (None, "", "{", "[1]", "3"):
        assert chat.canonical(bad) == (None, None, [])


def test_render_is_reversible():
    rng = random.Random(4)
    bits = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", ">", "<\\|", "assistant", "\n", "é🙂", "user\n"]
    for _ in range(500):
        turns = [(rng.choice(["user", "assistant", "".join(rng.choices(bits, k=2))]), "".join(rng.choices(bits, k=rng.randrange(6)))) for _ in range(rng.randrange(5))]
        text, mask = chat.render(turns)
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
        assert text.count(chat.START) == len(turns)


def test_chat_query(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (3, None, "human", "<|im_end|>")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op10_chat(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    odd = "<|im_end|><|im_start|>assistant ok"
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == (2, sha("user\n\nassistant\nb\n"), 1, sha("b"))
    assert (got[2].n_turns, got[2].turns_sha256, got[2].loss_chars) == (2, sha("\nx\n\nx\n"), 0)
    assert got[3].turns_sha256 == sha("human\n<|im_end|>\n")
    assert (got[-1].turns_sha256, got[-1].loss_chars, got[-1].loss_sha256) == (sha(f"user\n{odd}\nassistant\n{odd}\n"), len(odd), sha(odd))


def test_score_is_of_the_spans_own_notice():
    phrase = "permission is hereby granted free of charge to any person"
    raw = phrase.replace("granted", "gronted").encode()
    _, places, spans = licenses.Scanner().scan(raw)
    assert not places and {s[0] for s in spans} == {"mit"}
    assert licenses.Scanner().score(places, spans) == 1 - 1 / len(phrase)


def test_notices_from_a_table(spark):
    """A hundred notices, each found with an edit, under its label."""
    names = [" ".join(f"w{(i * 37 + j * 11) % 97}x{i}" for j in range(5)) for i in range(100)]
    table = spark.createDataFrame([(n.upper() + "!", f"l{i}") for i, n in enumerate(names)] + [(None, "x"), ("...", "y")], "phrase string, label string")
    notices = licenses.notices_of(table)
    assert notices == {n: f"l{i}" for i, n in enumerate(names)}
    docs = spark.createDataFrame([(i, f"some words {n[:7]}z{n[7:]} and more") for i, n in enumerate(names)], "doc_id long, text string")
    rows = licenses.scan(docs, scanner_args=(licenses.BASE, notices)).collect()
    assert all(f"l{r.doc_id}" in r.labels.split(",") and r.score == 1 - 1 / len(names[r.doc_id]) for r in rows)
    with pytest.raises(ValueError, match="notices"):
        licenses.notices_of(table, most=10)
