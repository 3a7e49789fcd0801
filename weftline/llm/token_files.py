"""Token-id files: documents to ids, ids to compressed blocks, and back.

Documents are range-partitioned by doc_id and each task codes its part, in order, into
segments. A segment has a table of its documents and ids and checksummed blocks of up to
``BLOCK_IDS`` ids, of which up to ``SEGMENT_BLOCKS`` are coded as one group
(:mod:`weftline.llm.id_coder`):

``WTOK2`` | documents u32 | ids u64 | block ids u32 | blocks of a group u32 | CRC-32 of all
that follows before the payload u32 | doc_id i64, is null u8 and ids u64 of each document |
words u32 and CRC-32 of the ids u32 of each block | payload: each block's 32-bit words. All
little-endian.

Files are lines of Spark's text writer, which commits them as a whole per task, with a line
feed after each segment.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from weftline.llm.common import new_path, ship, stored
from weftline.llm.files import FilePack, open_file, pack_files
from weftline.llm.id_coder import decode_blocks, encode_blocks
from weftline.llm.packing import byte_letters
from weftline.llm.textops import release_memory, text_buffers, tidy

MAGIC = b"WTOK2"
END_ID = 0
BLOCK_IDS = 1024
#: Blocks that are coded together, those of a segment. A longer document is a segment of its own,
#: with several such groups.
SEGMENT_BLOCKS = 4096
#: A short segment has shorter blocks, down to this, so that many are still coded side by side.
LEAST_BLOCK_IDS = 256
#: Bytes of files that one task decodes, which takes far longer than reading them.
READ_BYTES = 8 << 20
#: Bytes of text that are split into ids together, and words given to the tokenizer at once.
TEXT_BYTES = 4 << 20
WORDS_AT_ONCE = 20_000
#: Words whose ids a worker keeps. Any word beyond is split anew.
CACHE_WORDS = 400_000
_HEAD = "<5sIQIII"
_HEAD_BYTES = struct.calcsize(_HEAD)
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("ids", "<u8")])
_BLOCK = np.dtype([("words", "<u4"), ("crc", "<u4")])


_LETTER, _DIGIT, _SIGN, _OTHER = range(4)


def _classes() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    out[0x21:0x7F] = _SIGN
    out[0x30:0x3A] = _DIGIT
    out[0x41:0x5B] = out[0x61:0x7B] = _LETTER
    out[0x27] = _OTHER  # an apostrophe may begin a piece of its own kind
    return out


_CLASS = _classes()
#: The byte-level letter of each byte. Words are joined by line feeds, which stay.
_LETTERS = np.arange(256, dtype="<u4")
for _byte, _letter in byte_letters().items():
    _LETTERS[_byte] = _letter
_LETTERS[0x0A] = 0x0A


class Tokenizer:
    """Ids of whole texts, each different piece of a word split once.

    The byte-level pre-tokenizer always starts a new piece at a single blank between two
    characters that are no white space, around such a line feed, and where letters, digits and
    other signs meet. Cut there, the parts of a text are split on their own with the same
    result, and the same part occurs often. Parts that are surely one piece go to the model at
    once, all others take the library's whole way.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer as Library

        # A task has one core: threads of the library's own cost more CPU than they save.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Library.from_str(definition)
        self.model = self.library.model
        added = self.library.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added]
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each byte, and whether a part can begin there.

        Blanks and line feeds count whose neighbours are surely no white space: printable ASCII
        characters, two-byte characters except those that begin with C2 and, after the blank,
        what begins neither with C2 nor with E1 to E3. Letters are ASCII's and those from U+00C0
        to U+00FF, digits and signs ASCII's without the apostrophe.
        """
        kind, edge = _CLASS[data], np.zeros(len(data) + 1, bool)
        pair = np.flatnonzero(data[:-1] == 0xC3)
        pair = pair[(data[pair + 1] != 0x97) & (data[pair + 1] != 0xB7)]
        kind[pair] = kind[pair + 1] = _LETTER
        a, b = kind[:-1], kind[1:]
        edge[1:-1] = (a != b) & (np.maximum(a, b) < _OTHER)
        at = np.flatnonzero((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) + 1
        lead, before, after = data[np.maximum(at - 2, 0)], data[at - 1], data[at + 1]
        high = (after >= 0x80) & (after != 0xC2) & ((after < 0xE1) | (after > 0xE3))
        sure = high | ((after > 0x20) & (after < 0x7F))
        high = (at > 1) & (before >= 0x80) & (lead > 0xC2) & (lead < 0xE0)
        at = at[sure & (high | ((before > 0x20) & (before < 0x7F)))]
        edge[at] = True
        edge[at[data[at] == 0x0A] + 1] = True
        return kind, edge

    def _pieces(self, words: list[bytes]) -> list[bytes]:
        """The ids of words that are one piece each."""
        if not words:
            return []
        letters = _LETTERS[np.frombuffer(b"\n".join(words), np.uint8)].tobytes()
        tokenize, ids, ends = self.model.tokenize, [], [0]
        for word in letters.decode("utf-32-le").split("\n"):
            ids += [t.id for t in tokenize(word)]
            ends.append(2 * len(ids))
        flat = array("H", ids).tobytes()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def _split(self, words: list[bytes], whole: np.ndarray) -> list[bytes]:
        """The 16-bit ids of each word, as bytes, which take a third of a small array's room;
        ``whole`` tells which words are one piece."""
        if whole.all():
            return self._pieces(words)
        out = [b""] * len(words)
        places = np.flatnonzero(whole).tolist()
        for i, ids in zip(places, self._pieces([words[i] for i in places]), strict=True):
            out[i] = ids
        places = np.flatnonzero(~whole).tolist()
        for k in range(0, len(places), WORDS_AT_ONCE):
            part = places[k : k + WORDS_AT_ONCE]
            texts = [words[i].decode() for i in part]
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            for i, e in zip(part, found, strict=True):
                out[i] = array("H", e.ids).tobytes()
        return out

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i + 1]]``, and each text's first id."""
        kind, edge = self.cuts(data)
        raw = data.tobytes() if self.added else b""
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                edge[at + 1 : at + len(token)] = False
                kind[at : at + len(token)] = _OTHER
                at = raw.find(token, at + 1)
        edge[offsets] = True
        bounds = np.flatnonzero(edge)
        if len(bounds) < 2:
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        parts = pa.Array.from_buffers(
            pa.large_binary(),
            len(bounds) - 1,
            [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
        ).dictionary_encode()
        index = parts.indices.to_numpy()
        _, ends, joined = parts.dictionary.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(parts.dictionary) + 1].tolist()
        raw = joined.to_pybytes()
        words = [raw[a:b] for a, b in zip(ends, ends[1:])]
        # One piece: signs of one class, but for a blank before them.
        others = np.add.reduceat(kind == _OTHER, bounds[:-1], dtype=np.int32)
        head = data[bounds[:-1]] == 0x20
        whole = np.zeros(len(words), bool)
        whole[index] = (others == head) & (np.diff(bounds) > head)
        found = list(map(self.known.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        fresh = [words[i] for i in new]
        split = self._split(fresh, whole[new])
        for i, ids in zip(new, split, strict=True):
            found[i] = ids
        self.known.update(islice(zip(fresh, split), CACHE_WORDS - len(self.known)))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
        begin = np.cumsum(np.r_[0, sizes])
        flat = np.frombuffer(b"".join(found), np.uint16)
        # Lay the parts' ids out in text order.
        size = sizes[index]
        place = np.cumsum(np.r_[0, size])
        source = np.repeat(begin[index] - place[:-1], size)
        source += np.arange(place[-1])
        return flat[source], place[np.searchsorted(bounds, offsets)]


def with_end(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to each text."""
    out = np.full(len(ids) + len(first) - 1, END_ID, np.uint16)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out[np.arange(len(ids)) + doc] = ids
    return out, first + np.arange(len(first))


def pack_segment(docs: np.ndarray, ids: np.ndarray) -> bytes:
    size = min(BLOCK_IDS, max(LEAST_BLOCK_IDS, -(-len(ids) // SEGMENT_BLOCKS)))
    group = SEGMENT_BLOCKS * size
    table = np.zeros(-(-len(ids) // size), _BLOCK)
    payload: list[bytes] = []
    for a in range(0, len(ids), group):
        payload += [w.astype("<u4").tobytes() for w in encode_blocks(ids[a : a + group], size)]
    for i, words in enumerate(payload):
        part = ids[i * size : (i + 1) * size]
        table[i] = (len(words) // 4, zlib.crc32(part.astype("<u2").tobytes()))
    body = docs.tobytes() + table.tobytes()
    head = struct.pack(_HEAD, MAGIC, len(docs), len(ids), size, SEGMENT_BLOCKS, zlib.crc32(body))
    return b"".join([head, body, *payload])


def read_segments(file) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(documents, ids) of each segment. Torn or changed data raises ``ValueError``."""
    while head := file.read(_HEAD_BYTES):
        if len(head) < _HEAD_BYTES or head[:5] != MAGIC:
            raise ValueError("no token segment")
        _, n_docs, n_ids, size, group, crc = struct.unpack(_HEAD, head)
        n_blocks = -(-n_ids // size)
        body = file.read(n_docs * _DOC.itemsize + n_blocks * _BLOCK.itemsize)
        if zlib.crc32(body) != crc:
            raise ValueError("damaged segment table")
        docs = np.frombuffer(body, _DOC, n_docs)
        table = np.frombuffer(body, _BLOCK, n_blocks, n_docs * _DOC.itemsize)
        ids = np.zeros(n_ids, np.uint16)
        # All blocks but the last are full.
        for a in range(0, n_blocks, group):
            part = table[a : a + group]
            payload = file.read(4 * int(part["words"].sum()))
            if len(payload) != 4 * int(part["words"].sum()):
                raise ValueError("torn segment")
            words = np.split(np.frombuffer(payload, "<u4"), np.cumsum(part["words"])[:-1])
            stop = min(n_ids, (a + len(part)) * size)
            ids[a * size : stop] = decode_blocks(words, size, stop - a * size)
            for k, crc in enumerate(part["crc"]):
                block = ids[(a + k) * size : min(stop, (a + k + 1) * size)]
                if zlib.crc32(block.astype("<u2").tobytes()) != crc:
                    raise ValueError(f"block {a + k} of a segment is damaged")
        if file.read(1) not in (b"\n", b""):
            raise ValueError("no end of segment")
        yield docs, ids


def _segments(shared):
    """Ordered (doc_id, text) rows to segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker's tasks share the tokenizer and its words, until one does without the broadcast.
        kept = shared.value
        if "tokenizer" not in kept:
            kept["tokenizer"] = Tokenizer(kept["definition"])
        tokenizer = kept["tokenizer"]
        docs: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def full() -> pa.RecordBatch:
            segment = pack_segment(np.concatenate(docs), np.concatenate(ids))
            docs.clear()
            ids.clear()
            release_memory()
            return pa.record_batch([pa.array([segment], pa.binary())], names=["segment"])

        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            keys = batch.column(0)
            null = np.array(keys.is_null())
            keys = keys.fill_null(0).to_numpy()
            i, n = 0, len(offsets) - 1
            while i < n:
                j = int(np.searchsorted(offsets, offsets[i] + TEXT_BYTES, "right")) - 1
                j = min(n, max(j, i + 1))
                part = data[offsets[i] : offsets[j]]
                found, first = with_end(*tokenizer.ids(part, offsets[i : j + 1] - offsets[i]))
                at = 0
                while at < j - i:
                    # As many documents as the segment has room for, one at least.
                    room = SEGMENT_BLOCKS * BLOCK_IDS - held
                    to = int(np.searchsorted(first, first[at] + room, "right")) - 1
                    if to <= at and held:
                        yield full()
                        held = 0
                        continue
                    to = min(j - i, max(to, at + 1))
                    table = np.zeros(to - at, _DOC)
                    table["doc_id"] = keys[i + at : i + to]
                    table["null"] = null[i + at : i + to]
                    table["ids"] = np.diff(first[at : to + 1])
                    docs.append(table)
                    ids.append(found[first[at] : first[to]])
                    held += len(ids[-1])
                    at = to
                i = j
        if docs:
            yield full()

    return run


def write_tokens(docs: DataFrame, path: str, definition: str) -> None:
    """Write the ids of ``docs`` (doc_id, text) to files below ``path``.

    Files and the documents in them are in ascending order of doc_id, null first; rows of one
    doc_id are ordered by a hash of their text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"definition": definition})
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    segments = ordered.select("doc_id", "text").mapInArrow(tidy(_segments(shared)), "segment binary")
    segments.select(F.col("segment").cast("string").alias("value")).write.text(path, lineSep="\n")


_INDEX = pa.schema(
    [("file", pa.string()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
     ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]
)


class TokenReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.with_ids = options.get("ids", "false") == "true"

    def partitions(self) -> list[InputPartition]:
        return pack_files(self.path, READ_BYTES)

    def read(self, partition: FilePack) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            at = 0
            with open_file(self.path, path) as file:
                for docs, ids in read_segments(file):
                    ends = np.cumsum(np.r_[0, docs["ids"].astype(np.int64)])
                    wide = ids.astype("<u4")
                    crc = [zlib.crc32(wide[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                    n = len(docs)
                    lists = pa.nulls(n, pa.list_(pa.int32()))
                    if self.with_ids:
                        lists = pa.ListArray.from_arrays(
                            pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))
                        )
                    yield pa.record_batch(
                        [
                            pa.array([path.rpartition("/")[2]] * n, pa.string()),
                            pa.array(at + ends[:-1]),
                            pa.array(docs["doc_id"], mask=docs["null"].astype(bool)),
                            pa.array(np.diff(ends)),
                            pa.array(crc, pa.int64()),
                            lists,
                        ],
                        schema=_INDEX,
                    )
                    at += int(ends[-1])
                    release_memory()


class TokenSource(DataSource):
    """``format("weft_tokens")`` with ``path`` and, for the ids themselves, ``ids=true``."""

    @classmethod
    def name(cls) -> str:
        return "weft_tokens"

    def schema(self) -> str:
        return "file string, at long, doc_id long, n_tokens long, ids_crc32 long, ids array<int>"

    def reader(self, schema) -> TokenReader:
        return TokenReader(dict(self.options))


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Documents of the files below ``path``, all blocks decoded and checked: ``file``, ``at``
    (ids before it in the file), ``doc_id``, ``n_tokens``, ``ids_crc32`` and ``ids`` (else
    null)."""
    spark.dataSource.register(TokenSource)
    reader = spark.read.format("weft_tokens").option("path", path)
    return reader.option("ids", str(ids).lower()).load()


def token_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all documents as token files in the shared folder and return from them
    ``doc_id, start, n_tokens, ids_crc32``.

    A null or empty text has the end id alone. Repeated doc_ids are documents each.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    path = new_path(spark, "tokens")
    write_tokens(docs, path, definition)
    # One row per document without its ids, kept as the files' totals are needed first.
    rows = stored(read_tokens(spark, path).drop("ids"), "token-index")
    # By number: names have five digits at least, and a sixth sorts before them.
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    order = Window.orderBy(part, "file").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # one row per file
    before = before.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return rows.join(before, "file").select(
        "doc_id",
        (F.col("before") + F.col("at")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


ship(__name__)
