"""Rows are told apart by their file's whole path: tables of several files of one name, as a
partitioned writer makes them, give the results of one file."""

from __future__ import annotations

import random

import pytest

from weftline.llm import decontaminate, mixing, ngram_join, repeats
from weftline.llm.common import with_row_id

SCHEMA = "doc_id long, text string, lang string, source string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def layouts(spark, tmp_path_factory):
    """The same documents as one file, and as two files of one name."""
    rng = random.Random(11)
    texts = [words(rng, rng.randint(40, 90)) for _ in range(40)]
    texts[7] = texts[30]
    texts[21] = words(rng, 20) + " " + texts[5] + " " + words(rng, 4)
    rows = [(i, t, "ab"[i % 2], "xyz"[i % 3]) for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("layouts")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/one")
    for day in "ab":
        part = [r for r in rows if r[2] == day]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{folder}/tmp-{day}")
        [file] = (folder / f"tmp-{day}").glob("part-*.parquet")
        target = folder / "two" / f"day={day}"
        target.mkdir(parents=True)
        (target / "part-0.parquet").write_bytes(file.read_bytes())
    one = spark.read.parquet(f"{folder}/one")
    return one, spark.read.parquet(f"{folder}/two").drop("day"), texts


def test_ids_are_distinct(layouts):
    _, two, texts = layouts
    assert with_row_id(two).select("row_file", "row_no").distinct().count() == len(texts)


@pytest.mark.parametrize("operator", ["repeats", "links", "kept", "leaks", "mix", "digest"])
def test_layouts_give_the_same(spark, layouts, operator):
    one, two, texts = layouts
    rows = [(1, " ".join(texts[12].split()[:25]))]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    run = {
        "repeats": repeats.remove_repeats,
        "links": ngram_join.jaccard_components,
        "kept": ngram_join.keep_one,
        "leaks": lambda docs: decontaminate.without_leaks(docs, benchmark),
        "mix": mixing.mixed_corpus,
        "digest": mixing.mix_documents,
    }[operator]
    a, b = (sorted(map(tuple, run(docs).collect()), key=str) for docs in (one, two))
    assert a == b and a
