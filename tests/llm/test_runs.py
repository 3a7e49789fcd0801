"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import queries, runs
from weftline.llm.textops import pieces

from .brute import words

SF = "/root/testdata/sf0.001"


def all_runs(w: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)  # periods ascend: the smallest one stays
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def damaged(doc_id: int | None, text: str | None) -> list[str]:
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digest(doc_id: int | None, text: str | None) -> tuple:
    w = damaged(doc_id, text)
    found = all_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = (None,) * 4
    if found:
        s, n, q = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def repetitive(rng: random.Random) -> list[str]:
    n = rng.choice([0, 1, 23, 24, 30, 80, 200, 400])
    letters = rng.choice([1, 2, 2, 3, 8, 50])
    w = [str(rng.randrange(letters)) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 30 else 0):
        a = rng.randrange(n - 25)
        p = rng.randrange(1, max(2, (n - a) // 3))
        for i in range(a, min(n, a + rng.randrange(2 * p, 4 * p + 10))):
            w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize(("least", "times"), [(24, 3), (1, 3), (30, 5)])
def test_runs_of_many_texts_together(least, times):
    rng = random.Random(7)
    texts = [repetitive(rng) for _ in range(250)]
    found = 0
    for piece in pieces(pa.array([" ".join(w) for w in texts])):
        done = runs.runs_of_piece(piece, None, least, times)
        doc = np.searchsorted(piece.first, done.begin, "right") - 1
        got = [[] for _ in texts]
        for d, s, e, q in zip(doc, done.begin, done.end, done.period, strict=True):
            got[d].append((int(s - piece.first[d]), int(e - s), int(q)))
        assert got == [all_runs(w, least, times) for w in texts]
        found += len(done.begin)
    assert found > 15


@pytest.mark.parametrize("size", [1, 2, 8, 64])
@pytest.mark.parametrize("scale", [1, 10**6])
def test_transform_gives_exact_matches(size, scale):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, 2, 500) * scale
    blocks = np.arange(0, 500 - 2 * size + 1, size)
    begin, distance = runs.block_seeds(ids, blocks, size)
    want = [
        (b, d)
        for b in blocks
        for d in range(size, 2 * size)
        if b + d + size <= 500 and (ids[b : b + size] == ids[b + d : b + d + size]).all()
    ]
    assert sorted(zip(begin, distance, strict=True)) == want


def test_inverse_transform():
    rng = np.random.default_rng(1)
    for prime, generator in runs.PRIMES:
        rows = rng.integers(0, prime, (3, 32)).astype(np.uint64)
        back = runs.inverse_ntt(runs.ntt(rows, prime, generator), prime, generator)
        assert (back == rows).all()


def test_long_texts():
    period = [f"w{i}" for i in range(40_000)]
    texts = [" ".join(["a"] * 200_000), " ".join(["x", *period * 3, "y"])]
    done = [runs.runs_of_piece(piece) for piece in pieces(pa.array(texts))]
    found = [(x.begin.tolist(), (x.end - x.begin).tolist(), x.period.tolist()) for x in done]
    assert found == [([0], [200_000], [1]), ([1], [120_000], [40_000])]


def test_query_on_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, " \n".join(repetitive(rng)), "x") for i in range(150)]
    rows += [(200, None, "x"), (201, "", "x"), (202, " \t\x0b", "x"), (None, "a " * 40, "x")]
    rows += [rows[3], rows[3], (None, None, None), (-5, "é ü " * 30, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, period string")
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in runs.run_digest(df).collect()), key=key)
    assert got == sorted((digest(i, t) for i, t, _ in rows), key=key)
    assert runs.run_digest(df.limit(0)).count() == 0


def test_operator_keeps_columns(spark):
    rows = [(1, "k " + "a b c " * 10 + "end", "r"), (2, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {r["row"]["doc_id"]: r for r in runs.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(1, 30, 3)]
    assert got[1]["collapsed"] == "k a b c end" and got[1]["row"]["runs"] == "r"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == ""


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert got == {digest(r["doc_id"], r["text"]) for r in docs}
