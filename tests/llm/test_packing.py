"""Tiered packing against the tokenizer itself and the rules of windows and steps."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftline.llm import packing, queries

SF = "/root/testdata/sf0.001"
PATH = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = [
    "", " ", "\t\n\x0b\x0c\r", "Don't STOP, it's 100% 'sure'... we'll x's.", "a1b22c333 4_5-6.7",
    "éá ≠ a≠ 1̸ x̸y", "ÀÖØÞß ÷×ª º µ Ünïcödé naïve", "İstanbul ΣΑΣ ſ K",
    "<|endoftext|> <|startoftext|>x<|endoftext|>", "A<|EndOfText|>b <| |>", "日本語、テキスト。１２３",
    "a b c　d​e\x1cf\x1dg\x85h", "🙂🙂 ok🙂ok ½²③", "''s'''t'real 'll'd", "x\x00y\x7fz",
    "ab̧́c, Å", "don’t “quote”…end—dash", "#hash @at a@b.c http://x.y/?z=1&w='q'",
]


def reference(texts):
    library = Tokenizer.from_file(PATH)
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def split(texts):
    with open(PATH, encoding="utf-8") as file:
        tokenizer = packing.WordTokenizer(file.read())
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    ids, first = tokenizer.ids(np.frombuffer(b"".join(data), np.uint8), offsets)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


def test_ids_are_those_of_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()
    texts = ODD + [r["text"] for r in docs]
    assert split(texts) == reference(texts)


def test_ids_of_random_texts():
    rng = random.Random(4)
    letters = [*"aAbsStTzZ09'.,-<|> \n=", "é", "É", "÷", "ß", "ÿ", "́", "̸", "日", "²", " ", "’"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(6000)]
    assert split(texts) == reference(texts)


@pytest.mark.parametrize("seed", range(4))
def test_every_window_is_full(seed):
    rng = random.Random(seed)
    packer = packing.Packer((8, 16, 32, 64))
    want, got = {}, defaultdict(list)
    windows = []
    for doc in range(500):
        n = rng.choice([1, 2, 7, 8, 30, 64, 65, 200, rng.randint(1, 120)])
        want[doc] = list(range(n))
        windows += packer.add(packing.Part(doc, n, 0, np.arange(n)))
        if doc % 100 == 99:
            windows += packer.full_windows()
            assert packer.total < 64
    assert {sum(map(len, w)) for w in windows} <= {8, 16, 32, 64}
    last = list(packer.last_windows())
    assert all(sum(map(len, w)).bit_count() == 1 for w in last) and len(last) < 8
    for part in (p for w in [*windows, *last] for p in w):
        got[part.doc_id] += [(part.start, part.ids.tolist())]
    joined = {d: [x for _, ids in sorted(parts) for x in ids] for d, parts in got.items()}
    assert joined == want
    # Documents that fit a window are rarely cut.
    whole = sum(len(parts) == 1 for d, parts in got.items() if len(want[d]) < 64)
    assert whole > 0.7 * sum(len(w) < 64 for w in want.values())


def check(rows, texts):
    """``texts``: (doc_id, text) of all documents, equal ones repeated."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], r["size"], r["step"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_sequence.values():
        parts.sort()
        ends = np.cumsum([0, *(p[1] for p in parts)]).tolist()
        assert [p[0] for p in parts] == ends[:-1] and {p[2] for p in parts} == {ends[-1]}
        assert ends[-1] <= 2048 and ends[-1].bit_count() == 1
    ids = [[*x, 1] for x in reference([t or "" for _, t in texts])]
    want = defaultdict(list)
    for (doc_id, _), x in zip(texts, ids, strict=True):
        want[doc_id].append(x)
    assert set(want) == set(by_doc)
    for doc_id, lists in want.items():
        parts = by_doc[doc_id]
        assert sum(r["length"] for r in parts) == sum(map(len, lists))
        if len(lists) > 1:
            continue
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(lists[0])
            part = np.array(lists[0][at : at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(lists[0])


def test_query_on_odd_rows(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)]
    rows += [(100, None, "x", "y"), (101, "word " * 9000, "x", "y"), (None, "no id", "x", "y")]
    rows += [rows[3], rows[3], (None, "no id", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size string, task string")
    check(packing.packed_digest(df, PATH).collect(), [r[:2] for r in rows])
    assert packing.packed_digest(df.limit(0), PATH).count() == 0


def test_levels_of_rests(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 2)
    texts = [(i, f"text {i} " * (i % 90)) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(9)
    windows = packing.pack_windows(df, PATH, 1).collect()
    assert len({w["sequence_id"] >> 58 for w in windows}) > 2
    # The real output: ids of every part.
    got = defaultdict(list)
    for p in (p for w in windows for p in w["parts"]):
        got[p["doc_id"]].append((p["start"], p["ids"]))
    joined = {d: [x for _, ids in sorted(parts) for x in ids] for d, parts in got.items()}
    ids = reference([t for _, t in texts])
    assert joined == {d: [*x, 1] for (d, _), x in zip(texts, ids, strict=True)}


def test_balanced_steps(spark):
    rng = random.Random(1)
    rows = [(i, 2 ** rng.choice([6, 8, 8, 11]), rng.randrange(1, 10**6)) for i in range(3000)]
    df = spark.createDataFrame(rows, "sequence_id long, size long, cost long").repartition(5)
    steps = defaultdict(list)
    for r in packing.with_steps(df, step_tokens=8192).collect():
        steps[r["step"]].append(r)
    assert sorted(steps) == list(range(len(steps)))
    for size in (64, 256, 2048):
        mine = [s for s in steps.values() if s[0]["size"] == size]
        assert all(r["size"] == size for s in mine for r in s)
        counts = {len(s) for s in mine}
        assert max(counts) - min(counts) <= 1 and max(counts) * size <= 8192
        if min(counts) > 20:
            costs = [sum(r["cost"] for r in s) / len(s) for s in mine]
            assert max(costs) < 1.2 * min(costs)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.QUERIES["op11_tiered_packing"](spark, SF).collect()
    check(rows, [tuple(r) for r in docs])
