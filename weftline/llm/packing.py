"""Packing documents into training windows of several lengths.

Windows come in tiers, powers of two up to the longest context. A document longer than that
fills windows by itself; what remains goes to the shortest tier that holds it. Each tier is
packed from the longest down: a piece opens a window, gaps are filled with the longest pieces of
shorter tiers that fit, and the last gap with the head of one that does not, whose rest goes
back to its tier. So every window but the last is full.

A task packs its own documents, group after group, and leaves less than one longest window.
These rests are packed again, those of ``FAN`` tasks together, level by level. The last rest of
all is cut into full windows of ever shorter lengths. No step moves the ids of finished windows.

Training steps are groups of windows of one length: windows are ranked by their attention cost
and dealt to the steps forth and back, so that steps of a tier have equally many windows, give
or take one, and near-equal costs.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import ship, stored
from weftline.llm.textops import LOWER, text_buffers

TIERS = (64, 128, 256, 512, 1024, 2048)
#: Tokens of a training step.
STEP_TOKENS = 1 << 19
#: Tasks whose rests are packed together.
FAN = 64
#: Ids that are packed together, and bytes of text that are split together.
GROUP_IDS = 1 << 20
TEXT_BYTES = 4 << 20
#: Pieces of words whose ids a task keeps. Any beyond are split anew.
CACHE_WORDS = 200_000

_BLANK, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)


def _classes() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = _BLANK
    out[0x21:0x7F] = _SIGN
    out[0x30:0x3A] = _DIGIT
    out[0x41:0x5B] = out[0x61:0x7B] = _LETTER
    out[0x27] = _OTHER  # an apostrophe may begin a piece of its own kind
    return out


_CLASS = _classes()
_WORD = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def byte_letters() -> dict[int, int]:
    """Byte-level letters: visible bytes stand for themselves, others follow from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + k for k, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops blanks and lower-cases, each different piece
    of a word split once.

    Its pre-tokenizer always parts letters, single digits and other signs. Cut there, between
    ASCII characters and the letters from U+00C0 to U+00FF, pieces are split on their own with
    the same result. Pieces of such letters alone need no normalizing and go to the model at
    once; all others take the library's whole way, and so do texts that hold an added token.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.model = self.library.model
        self.letters = byte_letters()
        self.known: dict[bytes, bytes] = {}
        added = json.loads(definition).get("added_tokens") or []
        self.added = [t["content"].encode() for t in added]

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        decoded = [t.decode("utf-8", "replace") for t in texts]
        found = self.library.encode_batch_fast(decoded, add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in found]

    def _split(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        others = []
        for i, word in enumerate(words):
            if _WORD.fullmatch(word):
                text = word.decode().lower().encode() if not word.isascii() else word
                letters = text.decode("latin-1").translate(self.letters)
                out[i] = b"".join(
                    t.id.to_bytes(2, "little") for t in self.model.tokenize(letters)
                )
            else:
                others.append(i)
        for i, ids in zip(others, self._whole([words[i] for i in others]), strict=True):
            out[i] = ids
        return out

    @staticmethod
    def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which bytes are no blanks, and which of them begin a piece."""
        kind = _CLASS[data]
        pair = np.flatnonzero(data[:-1] == 0xC3)
        pair = pair[(data[pair + 1] != 0x97) & (data[pair + 1] != 0xB7)]
        kind[pair] = kind[pair + 1] = _LETTER
        inside = kind != _BLANK
        begin = inside.copy()
        a, b = kind[:-1], kind[1:]
        plain = (a < _OTHER) & (b < _OTHER)
        begin[1:] &= (a == _BLANK) | (plain & ((a != b) | (a == _DIGIT)))
        return inside, begin

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i + 1]]``, and each text's first id."""
        n = len(offsets) - 1
        special = {}
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, "right")) - 1
                special[i] = raw[offsets[i] : offsets[i + 1]]
                at = raw.find(token, at + 1)
        inside, begin = self.cuts(data) if len(data) else (np.zeros(0, bool),) * 2
        for i in special:
            inside[offsets[i] : offsets[i + 1]] = False
        begin &= inside
        heads = offsets[:-1][np.diff(offsets) > 0]
        begin[heads] |= inside[heads]
        kept = LOWER[data[inside]]
        place = np.cumsum(np.r_[0, inside])
        bounds = np.r_[place[:-1][begin], len(kept)].astype(np.int64)
        parts = pa.Array.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(kept)]
        ).dictionary_encode()
        index = parts.indices.to_numpy()
        words = parts.dictionary.to_pylist()
        found = [self.known.get(w) for w in words]
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self._split([words[i] for i in new]), strict=True):
            found[i] = ids
            if len(self.known) < CACHE_WORDS:
                self.known[words[i]] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
        start = np.cumsum(np.r_[0, sizes])
        flat = np.frombuffer(b"".join(found), "<u2")
        # Lay the pieces' ids out in text order.
        size = sizes[index]
        at = np.cumsum(np.r_[0, size])
        ids = flat[np.repeat(start[index] - at[:-1], size) + np.arange(at[-1])]
        first = at[np.searchsorted(bounds[:-1], place[offsets])]
        if special:
            lists = [ids[first[i] : first[i + 1]] for i in range(n)]
            for i, whole in zip(special, self._whole(list(special.values())), strict=True):
                lists[i] = np.frombuffer(whole, "<u2")
            first = np.cumsum([0, *map(len, lists)])
            ids = np.concatenate(lists)
        return ids, first


@dataclass
class Part:
    """Ids of a document that stand together."""

    doc_id: int | None
    doc_tokens: int
    start: int
    ids: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def cut(self, at: int) -> tuple[Part, Part]:
        head = Part(self.doc_id, self.doc_tokens, self.start, self.ids[:at])
        return head, Part(self.doc_id, self.doc_tokens, self.start + at, self.ids[at:])


class Packer:
    """Packs parts into full windows and keeps the rest for the next group."""

    def __init__(self, tiers: Sequence[int]) -> None:
        self.tiers = sorted(tiers)
        if any(t & (t - 1) or t < 1 for t in self.tiers):
            raise ValueError("tiers must be powers of two")
        self.longest = self.tiers[-1]
        self.sizes: list[int] = []  # of the waiting parts, ascending
        self.waiting: dict[int, list[Part]] = {}
        self.total = 0

    def add(self, part: Part) -> Iterator[list[Part]]:
        """Take a part; whole windows of a long one come back at once."""
        while len(part) >= self.longest:
            head, part = part.cut(self.longest)
            yield [head]
        if len(part):
            self._put(part)

    def _put(self, part: Part) -> None:
        insort(self.sizes, len(part))
        self.waiting.setdefault(len(part), []).append(part)
        self.total += len(part)

    def _take(self, at: int) -> Part:
        size = self.sizes.pop(at)
        self.total -= size
        return self.waiting[size].pop()

    def full_windows(self) -> Iterator[list[Part]]:
        """Full windows, from the longest tier down; less than one longest window stays."""
        for tier in reversed(self.tiers):
            shortest = tier // 2 if tier > self.tiers[0] else 0
            while tier <= self.total:
                longest = bisect_right(self.sizes, tier) - 1
                if longest < 0 or self.sizes[longest] <= shortest:
                    break
                window = [self._take(longest)]
                gap = tier - len(window[0])
                while gap:
                    fits = bisect_right(self.sizes, gap) - 1
                    if fits >= 0:
                        window.append(self._take(fits))
                    else:  # the shortest part that is longer gives its head
                        head, rest = self._take(bisect_left(self.sizes, gap)).cut(gap)
                        window.append(head)
                        self._put(rest)
                    gap -= len(window[-1])
                yield window

    def last_windows(self) -> Iterator[list[Part]]:
        """All that is left, in full windows of any power of two."""
        yield from self.full_windows()
        size = self.longest
        while self.total:
            while size > self.total:
                size //= 2
            window, gap = [], size
            while gap:
                part = self._take(-1)
                if len(part) > gap:
                    part, rest = part.cut(gap)
                    self._put(rest)
                window.append(part)
                gap -= len(part)
            yield window

    def rest(self) -> list[Part]:
        return [p for parts in self.waiting.values() for p in parts]


_PART = (
    "doc_id:bigint,start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint,"
    "offset:bigint,ids:array<int>"
)
_WINDOW_TYPE = (
    f"sequence_id long, size long, cost long, parts array<struct<{_PART}>>, "
    "task long, doc_id long, doc_tokens long, start long, ids binary"
)
_PARTS = pa.list_(
    pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
               ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("offset", pa.int64()),
               ("ids", pa.list_(pa.int32()))])
)
_WINDOWS = pa.schema(
    [("sequence_id", pa.int64()), ("size", pa.int64()), ("cost", pa.int64()), ("parts", _PARTS),
     ("task", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()),
     ("start", pa.int64()), ("ids", pa.binary())]
)


def _window_row(number: int, window: list[Part], with_ids: bool) -> dict:
    parts, offset = [], 0
    for p in window:
        crc = zlib.crc32(p.ids.astype("<u4").tobytes())
        ids = p.ids.tolist() if with_ids else None
        parts.append((p.doc_id, p.start, len(p), crc, p.doc_tokens, offset, ids))
        offset += len(p)
    cost = sum(len(p) ** 2 for p in window)
    return {"sequence_id": number, "size": offset, "cost": cost, "parts": parts}


def _rest_row(task: int, part: Part) -> dict:
    row = {"task": task, "doc_id": part.doc_id, "doc_tokens": part.doc_tokens}
    return row | {"start": part.start, "ids": part.ids.astype("<u2").tobytes()}


def _to_batch(rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([r.get(f.name) for r in rows], f.type) for f in _WINDOWS]
    return pa.record_batch(columns, schema=_WINDOWS)


def _numbers(level: int, task: int) -> Iterator[int]:
    """Window numbers of a task of a level of the tree."""
    first = (level << 58) + (task << 26)
    yield from range(first, first + (1 << 26))
    raise ValueError("a task has too many windows")


def _pack_documents(definition, tiers: Sequence[int], end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        tokenizer, packer = WordTokenizer(definition.value), Packer(tiers)
        numbers = _numbers(0, task)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            offsets, data = text_buffers(batch.column(1))
            i, n = 0, len(doc_ids)
            while i < n:
                j = int(np.searchsorted(offsets, offsets[i] + TEXT_BYTES, "right")) - 1
                j = min(n, max(j, i + 1))
                part = data[offsets[i] : offsets[j]]
                ids, first = tokenizer.ids(part, offsets[i : j + 1] - offsets[i])
                windows = []
                for k in range(j - i):
                    own = np.append(ids[first[k] : first[k + 1]], np.uint16(end_id))
                    windows += packer.add(Part(doc_ids[i + k], len(own), 0, own))
                    if packer.total > GROUP_IDS:
                        windows += packer.full_windows()
                if windows:
                    yield _to_batch([_window_row(next(numbers), w, with_ids) for w in windows])
                i = j
        rows = [_window_row(next(numbers), w, with_ids) for w in packer.full_windows()]
        rows += [_rest_row(task, p) for p in packer.rest()]
        if rows:
            yield _to_batch(rows)

    return run


def _pack_rests(level: int, tiers: Sequence[int], last: bool, with_ids: bool):
    """The rests of some tasks of the level below, as one group."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        task = key[0].as_py()
        packer, numbers = Packer(tiers), _numbers(level, task)
        # The same order whenever the task is run.
        table = table.sort_by([(c, "ascending") for c in ("task", "doc_id", "start", "ids")])
        for row in table.to_pylist():
            ids = np.frombuffer(row["ids"], "<u2")
            list(packer.add(Part(row["doc_id"], row["doc_tokens"], row["start"], ids)))
        windows = packer.last_windows() if last else packer.full_windows()
        rows = [_window_row(next(numbers), w, with_ids) for w in windows]
        rows += [_rest_row(task, p) for p in packer.rest()] if not last else []
        return pa.Table.from_batches([_to_batch(rows)], _WINDOWS)

    return run


def pack_windows(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    tiers: Sequence[int] = TIERS,
    with_ids: bool = True,
) -> DataFrame:
    """Windows of all ids of ``docs`` (doc_id, text), each text ended by ``end_id``.

    Returns ``sequence_id, size, cost, parts``: ``size`` is a power of two and the window's
    number of ids, ``cost`` the sum of its parts' squared lengths, and ``parts`` lists (doc_id,
    start, length, ids_crc32, doc_tokens, offset, ids) in order; ``ids`` is null unless
    ``with_ids``. A null or empty text is its end id alone, a null doc_id stays null, and
    repeated rows are documents each. An empty table gives no windows.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    tiers = tuple(tiers)
    packed = rows.mapInArrow(_pack_documents(definition, tiers, end_id, with_ids), _WINDOW_TYPE)
    names = ["sequence_id", "size", "cost", "parts"]
    done = []
    level = 0
    while True:
        packed = stored(packed, "windows")
        done.append(packed.where("sequence_id is not null").select(*names))
        rests = packed.where("sequence_id is null")
        most = rests.agg(F.max("task")).first()[0]
        if most is None:
            break
        level += 1
        group = F.floor(F.col("task") / FAN).cast("long").alias("group")
        run = _pack_rests(level, tiers, most < FAN, with_ids)
        packed = rests.groupBy(group).applyInArrow(run, _WINDOW_TYPE)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def with_steps(windows: DataFrame, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Add ``step``: windows of one size that are trained on together.

    A step has ``step_tokens`` tokens, or as many fewer as make all steps of its size equal.
    Steps are numbered from 0 over all sizes, the shortest first.
    """
    order = ["size", "cost", "sequence_id"]
    ranked = windows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = stored(
        ranked.withColumn("_at", F.monotonically_increasing_id()).withColumn(
            "_part", F.spark_partition_id()
        ),
        "ranked-windows",
    )
    # One row for each size in each partition: far fewer than windows.
    counts = ranked.groupBy("size", "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    before = Window.partitionBy("size").orderBy("_part")
    counts = counts.withColumn(
        "_before", F.sum("_n").over(before) - F.col("_n")
    ).withColumn("_all", F.sum("_n").over(Window.partitionBy("size")))
    each = F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("size")))
    sizes = counts.groupBy("size").agg(F.sum("_n").alias("_all"))
    sizes = sizes.withColumn("_steps", F.ceil(F.col("_all") / each)).drop("_all")
    # One row for each tier.
    tiers = Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_base", F.coalesce(F.sum("_steps").over(tiers), F.lit(0)))
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    turn, place = F.floor(rank / F.col("_steps")), rank % F.col("_steps")
    step = F.when(turn % 2 == 0, place).otherwise(F.col("_steps") - 1 - place)
    return (
        ranked.join(counts, ["size", "_part"])
        .join(sizes, "size")
        .withColumn("step", (F.col("_base") + step).cast("long"))
        .drop("_at", "_part", "_n", "_first", "_before", "_all", "_steps", "_base")
    )


def packed_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """The contract's row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``, with the window's ``size`` and its training ``step``."""
    windows = with_steps(pack_windows(docs, tokenizer_path, end_id, with_ids=False))
    rows = windows.select("sequence_id", "size", "step", F.explode("parts").alias("p"))
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    return rows.select(*[f"p.{n}" for n in names], "sequence_id", "p.offset", "size", "step")


ship(__name__)
