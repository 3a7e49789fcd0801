"""What a Python worker of the pipeline holds while it works and after a task."""

from __future__ import annotations

import os
import subprocess
import sys
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import decontaminate, ngram_join, quality_trees, textops

TEXT = " ".join(f"word{k % 977}x{k}" for k in range(3_000))


def batch() -> pa.RecordBatch:
    rows = 100
    names = ["text", "row_file", "row_no"]
    return pa.record_batch([pa.array([TEXT] * rows), *[pa.array(range(rows), pa.int64())] * 2], names=names)


def document_grams():
    bits = np.zeros(decontaminate.BITMAP_BITS // 64, np.uint64)
    return decontaminate._document_grams(3, [3], SimpleNamespace(value=bits))


def features():
    def run(batches):
        for b in batches:
            yield quality_trees.document_features(b.column(0))

    return run


def first_columns():
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return ngram_join._first_columns(5, 80, SimpleNamespace(value=none))


@pytest.mark.parametrize("work", [document_grams, features, first_columns])
def test_memory_of_a_worker(work):
    textops._POWERS.clear()
    given = batch()
    run = textops.tidy(work())
    tracemalloc.start()
    try:
        for _ in run(iter([given])):
            pass
        left, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 24e6, f"{peak / 1e6:.0f} MB"
    assert left < 1e6 and not textops._POWERS, f"{left / 1e6:.0f} MB"


def test_pieces_of_any_size_say_the_same():
    given = pa.array([TEXT, None, "", "One two", TEXT * 40])
    parts = [
        np.concatenate([p.word_hashes() for p in textops.pieces(given, size=size)])
        for size in (1, 1 << 12, textops.SMALL_PIECE, textops.PIECE_BYTES)
    ]
    assert all(np.array_equal(parts[0], p) for p in parts)


THREADS = """
import os
import numpy as np, public_tokenizers
from weftline.llm.token_files import Tokenizer

threads = lambda: len(os.listdir("/proc/self/task"))
with open(str(public_tokenizers.path("byte_bpe_50k.json")), encoding="utf-8") as file:
    tokenizer = Tokenizer(file.read())
data = " ".join(f"word{k}" for k in range(3000)).encode()
before = threads()
ids, _ = tokenizer.ids(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
whole = tokenizer.library.encode(data.decode(), add_special_tokens=False).ids
assert ids.tolist() == whole and ids.dtype == np.uint16
print(threads() - before)
"""


def test_a_task_splits_texts_in_its_own_thread():
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    env["PYTHONPATH"] = os.pathsep.join(sys.path)
    ran = subprocess.run([sys.executable, "-c", THREADS], env=env, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    assert ran.stdout.split() == ["0"]
