"""Repair of conversations: cheapest edits to turns, found by search from both ends.

A repaired conversation reads ``(s?(ua)+)?`` in its roles' initials: an optional system turn,
then user and assistant in turn. Every row is kept, given another role or deleted, and empty
turns can be inserted. The edits of a conversation are paths in a lattice whose nodes are
(rows done, what stands last) and whose steps are edits; :func:`cheapest` runs Dijkstra's
search from both ends at once.

Rows are sorted by (conversation, turn) over range partitions, so that a conversation of any
length spreads over many tasks, and are worked on in chunks of bounded size. A conversation in
one chunk is done there. For a longer one each chunk gives the cost of its best edits between
every two states, and their order among each other; a pass over these few numbers picks the
states at the chunks' edges, and each chunk then gives its part of the result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import ship, stored

#: What stands last: nothing, the system turn, a user's turn, an assistant's turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after another turn of an initial.
FOLLOWS = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
LEGAL = {"su", "ua", "au"}
ENDS = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A chunk has at most so many rows and, unless one row alone is longer, characters.
CHUNK_ROWS = 256
CHUNK_CHARS = 1 << 20

#: A step of the lattice: (from level, from state, to level, to state, cost, audit).
Step = tuple[int, int, int, int, int, str]


def cheapest(
    steps: Iterable[Step], source: tuple[int, int], targets: Iterable[tuple[int, int]]
) -> tuple[int, str] | None:
    """Cost and audit of the cheapest path, of equals the one with the least audit.

    Both heaps are ordered by cost, then by level, as steps without cost go up a level: when a
    node is taken, all its steps of equal cost have been seen. The searches meet when their
    least costs add up to more than the best crossing; every crossing of that cost is finished,
    and the least concatenated audit of them counts. Two audits of equal cost that lead to one
    node are never prefixes of each other, since the longer would have more inserts.
    """
    onward: dict[tuple[int, int], list] = {}
    backward: dict[tuple[int, int], list] = {}
    for i, p, j, q, cost, audit in steps:
        onward.setdefault((i, p), []).append(((j, q), cost, audit))
        backward.setdefault((j, q), []).append(((i, p), cost, audit))
    ends = set(targets)
    labels: tuple[dict, dict] = ({source: (0, "")}, {t: (0, "") for t in ends})
    heaps = ([(0, source[0], source)], [(0, -t[0], t) for t in ends])
    taken: tuple[set, set] = (set(), set())
    best = None
    for heap in heaps:
        heapq.heapify(heap)
    while heaps[0] or heaps[1]:
        # A search without nodes left has taken all that it can reach.
        least = [heap[0][0] if heap else 0 for heap in heaps]
        if best is not None and sum(least) > best:
            break
        side = 0 if heaps[0] and (least[0] <= least[1] or not heaps[1]) else 1
        _, _, node = heapq.heappop(heaps[side])
        if node in taken[side]:
            continue
        taken[side].add(node)
        cost, audit = labels[side][node]
        if node in labels[1 - side]:
            whole = cost + labels[1 - side][node][0]
            best = whole if best is None else min(best, whole)
        for to, more, edit in (backward if side else onward).get(node, ()):
            label = (cost + more, edit + audit if side else audit + edit)
            known = labels[side].get(to)
            if known is None or label < known:
                if known is None or label[0] < known[0]:
                    heapq.heappush(heaps[side], (label[0], -to[0] if side else to[0], to))
                labels[side][to] = label
    if best is None:
        return None
    # Crossings: nodes that both searches have settled, or steps between two such nodes.
    settled = taken[1] | ends
    found = []
    for node in taken[0]:
        cost, audit = labels[0][node]
        if node in settled and cost + labels[1][node][0] == best:
            found.append(audit + labels[1][node][1])
        for to, more, edit in onward.get(node, ()):
            if to in settled and cost + more + labels[1][to][0] == best:
                found.append(audit + edit + labels[1][to][1])
    return best, min(found)


@dataclass
class Turn:
    """A row of a conversation: its first fault, and how many equal rows follow it."""

    role: str
    text: str
    fault: str | None
    again: int = 0

    @property
    def initial(self) -> str:
        return self.role[:1]


def row_steps(turns: list[Turn], inserts_at_end: bool) -> Iterator[Step]:
    """The lattice of some rows. Equal rows after a row are duplicates and go with it."""
    for i, turn in enumerate(turns):
        rest, gone = DELETE * turn.again, "D" * turn.again
        kept = TRUNCATED if turn.fault == "truncated" else 0
        for state in range(4):
            yield i, state, i + 1, state, DELETE + rest, "D" + gone
            if turn.fault in ("blank", "duplicate"):
                continue
            to = FOLLOWS.get((state, turn.initial))
            if to is not None:
                yield i, state, i + 1, to, kept + rest, "K" + gone
            for initial in "ua":
                to = FOLLOWS.get((state, initial))
                if to is not None and initial != turn.initial:
                    yield i, state, i + 1, to, REROLE + kept + rest, "R" + gone
    for i in range(len(turns) + inserts_at_end):
        for (state, initial), to in FOLLOWS.items():
            if initial != "s":
                yield i, state, i, to, INSERT, "I"


def apply_edits(turns: list[Turn], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows that an audit makes from a state on."""
    rows = ((t, k) for t in turns for k in range(t.again + 1))
    for edit in audit:
        if edit == "I":
            state = USER if state != USER else ASSISTANT
            yield NAMES[state], ""
            continue
        turn, _ = next(rows)
        if edit == "K":
            state = FOLLOWS[state, turn.initial]
            yield turn.role, turn.text
        elif edit == "R":
            state = USER if state != USER else ASSISTANT
            yield NAMES[state], turn.text


@dataclass
class Chunk:
    """Rows of one conversation that stand together, and whether its ends are those of it."""

    conv: str
    first_of_all: bool = False
    last_of_all: bool = False
    turns: list[Turn] = field(default_factory=list)
    size: int = 0

    def counts(self) -> dict[str, int]:
        out = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        before = None
        for turn in self.turns:
            if turn.fault:
                out[turn.fault] += 1
            out["blank" if turn.fault == "blank" else "duplicate"] += turn.again
            if before is not None:
                out["illegal"] += before + turn.initial not in LEGAL
            out["illegal"] += turn.again * (2 * turn.initial not in LEGAL)
            before = turn.initial
        return out


_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_CHUNKS = pa.schema(
    [("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("whole", pa.bool_()),
     ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
     ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
     ("cost", pa.int64()), ("audit", pa.string()), ("sha256", pa.string()), ("lines", _LINES),
     ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())),
     ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()),
                                   ("fault", pa.string()), ("again", pa.int64())])))]
)
_CHUNKS_TYPE = (
    "conv string, part int, chunk int, whole boolean, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string, cost long, audit string, "
    "sha256 string, lines array<struct<role:string,text:string>>, costs array<long>, "
    "ranks array<int>, turns array<struct<role:string,text:string,fault:string,again:long>>"
)
#: Nodes of the reduction tree that one task puts together.
FAN = 256
#: Turns that must still be inserted behind a last state, in order.
MISSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _text_of(lines: Iterable[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in lines)


def _matrix(steps: list[Step], n: int) -> dict[str, list[int]]:
    """Costs of the best paths from each state to each (-1: none), and their order by audit."""
    costs, ranks = [], []
    for state in range(4):
        found = [cheapest(steps, (0, state), [(n, to)]) for to in range(4)]
        audits = sorted(f[1] for f in found if f)
        costs += [f[0] if f else -1 for f in found]
        ranks += [audits.index(f[1]) if f else -1 for f in found]
    return {"costs": costs, "ranks": ranks}


def _chunk_row(chunk: Chunk, part: int, number: int, keep: bool) -> dict:
    row = dict.fromkeys(_CHUNKS.names) | chunk.counts()
    row |= {"conv": chunk.conv, "part": part, "chunk": number}
    row |= {"first": chunk.turns[0].initial, "last": chunk.turns[-1].initial}
    row["whole"] = chunk.first_of_all and chunk.last_of_all
    n = len(chunk.turns)
    if row["whole"]:
        steps = row_steps(chunk.turns, True)
        row["cost"], row["audit"] = cheapest(steps, (0, START), [(n, t) for t in ENDS])
        lines = list(apply_edits(chunk.turns, row["audit"], START))
        row["sha256"] = hashlib.sha256(_text_of(lines).encode()).hexdigest()
        if keep:
            row["lines"] = lines
        return row
    row |= _matrix(list(row_steps(chunk.turns, False)), n)
    row["turns"] = [(t.role, t.text, t.fault, t.again) for t in chunk.turns]
    return row


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([r[name] for r in rows], kind) for name, kind in zip(schema.names, schema.types)]
    return pa.record_batch(columns, schema=schema)


def _chunks(keep: bool):
    """Sorted rows of one range partition to chunks.

    The first and the last conversation of a partition may go on in its neighbours.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        chunk: Chunk | None = None
        mark, number, held = None, 0, 0
        out: list[dict] = []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in _SORTED]
            for conv, is_mark, key, role, text, fault, n in zip(*columns, strict=True):
                if is_mark:
                    mark = (conv, role, key)
                    continue
                if mark != (conv, role, key) and fault != "blank":
                    fault = "duplicate"
                mark = None  # of equal texts only the first is not a duplicate
                if chunk is None or chunk.conv != conv:
                    begins = chunk is not None or part == 0
                    if chunk is not None:
                        chunk.last_of_all = True
                        out.append(_chunk_row(chunk, part, number, keep))
                        held += chunk.size
                    chunk, number = Chunk(conv, begins), 0
                elif len(chunk.turns) >= CHUNK_ROWS or chunk.size + len(text) > CHUNK_CHARS:
                    out.append(_chunk_row(chunk, part, number, keep))
                    held += chunk.size
                    chunk, number = Chunk(conv), number + 1
                chunk.turns.append(Turn(role, text, fault, n - 1))
                chunk.size += len(role) + len(text)
                if len(out) >= 1000 or held > CHUNK_CHARS:
                    yield _batch(out, _CHUNKS)
                    out, held = [], 0
        if chunk is not None:
            out.append(_chunk_row(chunk, part, number, keep))
        if out:
            yield _batch(out, _CHUNKS)

    return run


#: What the sorted rows have: a mark stands before the first of equal texts.
_SORTED = ("conv", "is_mark", "key", "role", "text", "fault", "n")


def _faults(text: Column) -> Column:
    """The fault of a text by itself: blank, truncated or null."""
    trimmed = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return (
        F.when(trimmed == "", "blank")
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise(F.lit(None).cast("string"))
    )


def chunk_table(rows: DataFrame, keep: bool) -> DataFrame:
    """Chunks of the conversations in ``rows`` (conv, turn, role, text, n), stored.

    Equal rows are counted before they are moved, so that many of them are one row. The first
    of equal texts is found by a partial aggregation and sorted in beside its row, so no key,
    not even a conversation with most of the rows, is bound to one task.
    """
    key = ["conv", "turn", "role", "text"]
    base = rows.groupBy(*key).agg(F.sum("n").alias("n"))
    base = base.withColumn("key", F.unhex(F.sha2("text", 256)))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # nulls first
    marks = base.groupBy("conv", "role", "key").agg(F.min(at).alias("at"))
    none = F.lit(None).cast("string")
    both = base.select(
        "conv", "turn", "role", "key", F.lit(False).alias("is_mark"), "text",
        _faults(F.col("text")).alias("fault"), "n",
    ).unionByName(
        marks.select(
            "conv", F.col("at.turn").alias("turn"), "role", "key", F.lit(True).alias("is_mark"),
            none.alias("text"), none.alias("fault"), F.lit(None).cast("long").alias("n"),
        )
    )
    order = ["conv", "turn", "role", "key"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = both.repartitionByRange(parts, *order)
    ordered = ordered.sortWithinPartitions(*order, F.col("is_mark").desc())
    return stored(
        ordered.select(*_SORTED).mapInArrow(_chunks(keep), _CHUNKS_TYPE), "conversation-chunks"
    )


def _node_steps(costs: list, ranks: list) -> list[Step]:
    """Nodes as steps between their edges; a path's audit is its order at every node.

    From one state each rank leads to another state, so the first difference of two paths is
    at a node that both enter in one state, where ranks are the order of the audits.
    """
    return [
        (i, p, i + 1, q, int(c[4 * p + q]), chr(48 + r[4 * p + q]))
        for i, (c, r) in enumerate(zip(costs, ranks, strict=True))
        for p in range(4)
        for q in range(4)
        if c[4 * p + q] >= 0
    ]


def _reduce(nodes):
    """Some nodes in order to one."""
    nodes = nodes.sort_values(["part", "chunk"])
    steps = _node_steps(list(nodes["costs"]), list(nodes["ranks"]))
    row = nodes.iloc[:1][["conv", "up_part", "up_chunk"]].copy()
    for name, values in _matrix(steps, len(nodes)).items():
        row[name] = [values]
    return row


def _descend(nodes):
    """The states at each node's edges, from those of the node above."""
    nodes = nodes.sort_values(["part", "chunk"])
    ranks = list(nodes["ranks"])
    steps = _node_steps(list(nodes["costs"]), ranks)
    state, to = int(nodes["from_state"].iloc[0]), int(nodes["to_state"].iloc[0])
    _, path = cheapest(steps, (0, state), [(len(nodes), to)])
    edges = [state]
    for rank, letter in zip(ranks, path, strict=True):
        edges.append(list(rank[4 * edges[-1] : 4 * edges[-1] + 4]).index(ord(letter) - 48))
    out = nodes[["conv", "part", "chunk"]].copy()
    out["from_state"], out["to_state"] = edges[:-1], edges[1:]
    return out


def edge_states(chunks: DataFrame) -> DataFrame:
    """The states at the edges of each chunk of long conversations, on their cheapest paths.

    A reduction tree of at most ``FAN`` nodes a task: first the chunks of one part, then parts.
    Back down, each task picks the states between its own nodes.
    """
    node_type = "conv string, up_part int, up_chunk int, costs array<long>, ranks array<int>"
    state_type = "conv string, part int, chunk int, from_state int, to_state int"
    levels = []
    nodes = stored(chunks.select("conv", "part", "chunk", "costs", "ranks"), "conversation-nodes")
    while True:
        most = nodes.agg(F.max("part"), F.max("chunk")).first()
        if not any(most):  # one node each, or none at all
            break
        up_part, up_chunk = F.col("part"), F.floor(F.col("chunk") / FAN)
        if not most[1]:
            up_part, up_chunk = F.floor(F.col("part") / FAN), F.col("chunk")
        nodes = nodes.withColumns(
            {"up_part": up_part.cast("int"), "up_chunk": up_chunk.cast("int")}
        )
        levels.append(nodes)
        above = nodes.groupBy("conv", "up_part", "up_chunk").applyInPandas(_reduce, node_type)
        above = above.withColumnsRenamed({"up_part": "part", "up_chunk": "chunk"})
        nodes = stored(above, "conversation-nodes")
    # At the top a path begins with nothing and may end with inserted turns.
    ends = [F.lit(INSERT * len(MISSING[q])) + F.element_at("costs", q + 1) for q in range(4)]
    best = F.array_min(
        F.array(
            *[
                F.when(
                    F.element_at("costs", q + 1) >= 0,
                    F.struct(
                        ends[q].alias("cost"),
                        F.element_at("ranks", q + 1).alias("rank"),
                        F.lit(q).alias("to_state"),
                    ),
                )
                for q in range(4)
            ]
        )
    )
    states = nodes.select(
        "conv", "part", "chunk", F.lit(START).alias("from_state"), best["to_state"].alias("to_state")
    )
    for children in reversed(levels):
        up = states.select(
            "conv", F.col("part").alias("up_part"), F.col("chunk").alias("up_chunk"),
            "from_state", "to_state",
        )
        joined = children.join(up, ["conv", "up_part", "up_chunk"])
        states = stored(
            joined.groupBy("conv", "up_part", "up_chunk").applyInPandas(_descend, state_type),
            "conversation-states",
        )
    return states


_PART_TYPE = (
    "conv string, part int, chunk int, blank long, duplicate long, truncated long, "
    "illegal long, first string, last string, cost long, audit string, to_state int, "
    "lines array<struct<role:string,text:string>>"
)
_PARTS = pa.schema(
    [("conv", pa.string()), ("part", pa.int32()), ("chunk", pa.int32()), ("blank", pa.int64()),
     ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
     ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
     ("to_state", pa.int32()), ("lines", _LINES)]
)


def _finish_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the states at their edges to their part of the result."""
    for batch in batches:
        for row in batch.to_pylist():
            turns = [Turn(**t) for t in row["turns"]]
            steps = row_steps(turns, False)
            begin, end = (0, row["from_state"]), (len(turns), row["to_state"])
            row["cost"], row["audit"] = cheapest(steps, begin, [end])
            row["lines"] = list(apply_edits(turns, row["audit"], row["from_state"]))
            yield _batch([row], _PARTS)


_LONG_TYPE = (
    "conv string, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, sha256 string"
)
_LONG = pa.schema(
    [("conv", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()),
     ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
     ("audit", pa.string()), ("sha256", pa.string())]
)


def _join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts of long conversations to a row each; texts only pass through the hash."""
    whole: dict | None = None

    def done() -> pa.RecordBatch:
        missing = MISSING[whole["to_state"]]
        whole["cost"] += INSERT * len(missing)
        whole["audits"].append("I" * len(missing))
        for state in missing:
            add(NAMES[state], "")
        row = whole | {"audit": "".join(whole["audits"]), "sha256": whole["hash"].hexdigest()}
        return _batch([row], _LONG)

    def add(role: str, text: str) -> None:
        line = f"{role}:{text}" if whole["empty"] else f"\n{role}:{text}"
        whole["empty"] = False
        whole["hash"].update(line.encode())

    for batch in batches:
        for row in batch.to_pylist():
            if whole is None or whole["conv"] != row["conv"]:
                if whole is not None:
                    yield done()
                whole = {n: row[n] for n in ("conv", "blank", "duplicate", "truncated", "illegal", "cost")}
                whole |= {"audits": [], "hash": hashlib.sha256(), "empty": True}
            else:
                for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    whole[name] += row[name]
                whole["illegal"] += whole["last"] + row["first"] not in LEGAL
            whole |= {"last": row["last"], "to_state": row["to_state"]}
            whole["audits"].append(row["audit"])
            for line in row["lines"]:
                add(line["role"], line["text"])
    if whole is not None:
        yield done()


def _prepared(df: DataFrame, conv: str) -> DataFrame:
    """Nulls as one space in texts and roles; a null conversation is one of its own."""
    space = F.lit(" ")
    return df.select(
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.lit(1).cast("long").alias("n"),
    )


def _long_parts(chunks: DataFrame) -> DataFrame:
    """The finished parts of conversations that have several chunks, stored."""
    open_chunks = chunks.where(~F.col("whole"))
    states = edge_states(open_chunks)
    rows = open_chunks.drop("cost", "audit", "lines").join(states, ["conv", "part", "chunk"])
    return stored(rows.mapInArrow(_finish_chunks, _PART_TYPE), "conversation-parts")


def _summed(chunks: DataFrame, parts: DataFrame) -> DataFrame:
    """One row per conversation that has rows."""
    names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256"]
    ordered = parts.repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    long = ordered.mapInArrow(_join_chunks, _LONG_TYPE)
    return chunks.where("whole").select(*names).unionByName(long)


def repair_conversations(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cheapest repair of the conversations in ``df`` (conv_id, turn, role, text).

    Returns a table of conversations (``conv_id, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``) and one of repaired turns (``conv_id, part, chunk, line, role,
    text``; the numbers put them in order). Rows of one turn are ordered by role, then by a
    hash of their text. A null role or text is one space, a null turn comes first and a null
    conv_id is one conversation. A role that is empty or has another initial than s, u and a
    cannot be kept. Other columns are not read; an empty table gives empty tables.
    """
    chunks = chunk_table(_prepared(df, "conv_id"), keep=True)
    parts = _long_parts(chunks)
    line = ["conv", "part", "chunk", F.posexplode("lines").alias("line", "turn")]
    # Turns inserted behind a long conversation's last chunk.
    last = F.struct("part", "chunk", "to_state")
    behind = parts.groupBy("conv").agg(F.max(last).alias("at"))
    inserted = F.when(F.col("at.to_state") == SYSTEM, F.array(F.lit("user"), F.lit("assistant")))
    inserted = inserted.when(F.col("at.to_state") == USER, F.array(F.lit("assistant")))
    behind = behind.select(
        "conv", "at.part", (F.col("at.chunk") + 1).alias("chunk"),
        F.posexplode(inserted).alias("line", "role"), F.lit("").alias("text"),
    )
    turns = chunks.where("whole").select(*line).unionByName(parts.select(*line))
    turns = turns.select("conv", "part", "chunk", "line", "turn.role", "turn.text")
    turns = turns.unionByName(behind)
    done = _summed(chunks, parts).withColumnRenamed("sha256", "repaired_sha256")
    return tuple(
        t.select(_conv_id().alias("conv_id"), *[c for c in t.columns if c != "conv"])
        for t in (done, turns)
    )


def _conv_id() -> Column:
    return F.when(F.col("conv") != "", F.col("conv")).cast("long")


def damaged(df: DataFrame) -> DataFrame:
    """The contract's damage, by a checksum of ``conv_id:turn``; nulls are one space."""
    space = F.lit(" ")
    label = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    harm = F.crc32(F.encode(label, "UTF-8")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    text = F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text)
    return df.where(harm != 0).select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(harm == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.when(harm == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def repair_digest(df: DataFrame) -> DataFrame:
    """The contract's row per original conversation, after its damage.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    Odd rows are read as :func:`repair_conversations` does.
    """
    rows = damaged(df)
    chunks = chunk_table(rows, keep=False)
    done = _summed(chunks, _long_parts(chunks))
    # Turns once per conversation before they are counted.
    turns = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    convs = df.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"))
    out = convs.distinct().join(gaps, "conv", "left").join(done, "conv", "left")
    zero = F.lit(0).cast("long")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        _conv_id().alias("conv_id"),
        *[F.coalesce(n, zero).alias(n) for n in names],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


ship(__name__)
