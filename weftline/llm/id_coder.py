"""Adaptive context-mixing range coder for token ids, many blocks at once.

The blocks of a group advance together, an id at a time, and learn one model, which begins
empty with each group: each numpy operation handles one step of all blocks, and what one has
seen helps the others. For every id three orders predict:

* order 2 and order 1 remember which id last followed the last two ids and the last one, with
  a count of how often that held. The surer one names the first candidate, the other one, if
  it differs, the second;
* order 0 counts how often an id came in the group. It also gives the distribution of ids that
  no candidate names.

The probability that the first candidate is right mixes what each order has learned about
its own reliability: a weighted sum in the logistic domain, whose weights follow the errors.
It depends on how sure the orders are and on nothing else, so the mix is worked out for all
such contexts at once, again and again, from what was counted in them since the last time.
All of it is integer arithmetic, so that any machine decodes what another one coded.

The arithmetic coder keeps a 64-bit range and moves 32 bits at a time, at most once an id; a
carry goes into the words before.
"""

from __future__ import annotations

import math

import numpy as np

from weftline.llm.common import ship

U64, I64, U32, U16 = np.uint64, np.int64, np.uint32, np.uint16
#: A range below this gets another word.
LEAST = U64(1 << 32)
WORD, LOW_WORD = U64(32), U64(2**32 - 1)
#: Slots of the order-2 memory; order 1 has one for each id.
SLOTS_2, IDS = 1 << 18, 1 << 16
MOST_SURE = 15
#: Bits of the choice between the candidates, and of the distribution of other ids.
CHOICE_BITS, ID_BITS = 12, 20
SHIFT_CHOICE, SHIFT_ID = U64(CHOICE_BITS), U64(ID_BITS)
#: Contexts: how sure order 2 and order 1 are, whether they agree, how frequent the first
#: candidate is.
CONTEXTS = (16, 16, 2, 16)
#: The model is worked out again after as many steps as there were before, at most these.
MOST_STEPS = 128
#: Counts behind a reliability are halved beyond this.
MOST_COUNT = 1 << 20
#: Bound and rate of the mixing weights.
MOST_WEIGHT, RATE = 200_000, 24

#: ln(p / (1 - p)) of a 12-bit probability in 8-bit fixed point, and back.
STRETCH = np.array(
    [round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], dtype=I64
)
SQUASH = np.array(
    [min(4000, max(16, round(4096 / (1 + math.exp(-(x - 2048) / 256))))) for x in range(4096)],
    dtype=I64,
)
#: What a prediction's count gains, at 2 * count + 1 if it was right, else at 2 * count. A wrong
#: one with a count below 2 gives way.
_GAIN = np.array(
    [g for k in range(16) for g in ((k >> 1) - k, min(k + 1, MOST_SURE) - k)], dtype=np.int32
)


class _Encoder:
    """32-bit words of many blocks."""

    def __init__(self, blocks: int, size: int) -> None:
        self.low = np.zeros(blocks, U64)
        self.range = np.full(blocks, U64(2**64 - 1))
        # A step gives one word at most, the end two.
        self.width = size + 2
        self.out = np.zeros(blocks * self.width, U32)
        self.begin = np.arange(blocks, dtype=I64) * self.width
        self.at = self.begin.copy()

    def _carry(self, rows: np.ndarray) -> None:
        at = self.at[rows]
        while len(at):
            at = at - 1
            self.out[at] += U32(1)
            at = at[self.out[at] == 0]

    def step(self, n: int, begin: np.ndarray, rng: np.ndarray) -> None:
        """Narrow the first ``n`` blocks to ``rng`` from ``begin`` on."""
        low = self.low[:n]
        low += begin
        over = np.flatnonzero(low < begin)
        if len(over):
            self._carry(over)
        todo = np.flatnonzero(rng < LEAST)
        if len(todo):
            lo, at = low[todo], self.at[todo]
            self.out[at] = lo >> WORD
            self.at[todo] = at + 1
            low[todo] = lo << WORD
            rng[todo] <<= WORD
        self.range[:n] = rng

    def finish(self) -> list[np.ndarray]:
        for _ in range(2):
            self.out[self.at] = self.low >> WORD
            self.at += 1
            self.low <<= WORD
        return [self.out[a:b] for a, b in zip(self.begin, self.at)]


class _Decoder:
    """``ahead`` is how far each block's code lies above its range's lower end."""

    def __init__(self, words: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, words), I64, len(words))
        if len(words) and sizes.min() < 2:
            raise ValueError("torn block")
        self.words = np.concatenate([*words, np.zeros(2, U32)]).astype(U64)
        self.at = np.cumsum(sizes) - sizes
        self.ahead = (self.words[self.at] << WORD) | self.words[self.at + 1]
        self.at += 2
        self.range = np.full(len(words), U64(2**64 - 1))

    def step(self, n: int, ahead: np.ndarray, rng: np.ndarray) -> None:
        todo = np.flatnonzero(rng < LEAST)
        if len(todo):
            at = self.at[todo]
            # Damaged words may ask for more than there are; the checksum finds out.
            ahead[todo] = (ahead[todo] << WORD) | self.words.take(at, mode="clip")
            self.at[todo] = at + 1
            rng[todo] <<= WORD
        self.ahead[:n] = ahead
        self.range[:n] = rng


class _Model:
    """What all blocks of a group have learned."""

    def __init__(self, decoding: bool) -> None:
        # An id << 4 | how sure it is.
        self.two, self.one = np.zeros(SLOTS_2, np.int32), np.zeros(IDS, np.int32)
        self.decoding = decoding
        self.seen = np.zeros(IDS, I64)
        self.others = np.zeros(IDS, I64)
        # Right predictions and all, by what order 2, 1 and 0 say, and of second candidates.
        self.right = [np.ones(s, I64) for s in ((16, 2), (16, 2), 16, 16)]
        self.all = [np.full(s, 4, I64) for s in ((16, 2), (16, 2), 16, 16)]
        self.weights = np.full((16, 3), 24000, I64)  # by how sure order 2 is
        self._mix()
        self._order0()

    def _inputs(self) -> list[np.ndarray]:
        """What orders 2, 1 and 0 say in each context, in the logistic domain."""
        x2, x1, x0 = (
            STRETCH[(4095 * r) // n] for r, n in zip(self.right[:3], self.all[:3])
        )
        return [x2[:, None, :, None], x1[None, :, :, None], x0[None, None, None, :]]

    def _mix(self) -> None:
        w = self.weights[:, :, None, None, None]
        dot = sum(w[:, k] * x for k, x in enumerate(self._inputs()))
        self.p = SQUASH[np.clip((dot >> 16) + 2048, 0, 4095)]
        second = (4095 * self.right[3]) // self.all[3]
        part = np.maximum(((4096 - self.p) * second[None, :, None, None]) >> 12, 1)
        part[:, 0] = 0  # order 1 knows nothing
        part[:, :, 1] = 0  # or agrees
        # Lower ends and widths of the choices, at 4 * context + choice.
        edges = np.stack([np.zeros_like(self.p), self.p, self.p + part], -1)
        widths = np.diff(edges, axis=-1, append=1 << CHOICE_BITS)
        spare = [(0, 0)] * 4 + [(0, 1)]
        self.edge = np.pad(edges, spare).ravel().astype(U64)
        self.width = np.pad(widths, spare).ravel().astype(U64)

    def _order0(self) -> None:
        free = (1 << ID_BITS) - IDS
        freq = 1 + (self.others * free) // max(1, int(self.others.sum()))
        freq[int(freq.argmax())] += (1 << ID_BITS) - int(freq.sum())
        # Where the ids' shares begin, and how wide they are.
        self.share = (((np.cumsum(freq) - freq) << 32) | freq).astype(U64)
        if self.decoding:
            self.ids = np.repeat(np.arange(IDS, dtype=U16), freq)
        share = (self.seen << 16) // max(1, int(self.seen.sum()))
        self.often = np.minimum(np.frexp(share.astype(float))[1], 15).astype(I64)

    def learn(self, keys: np.ndarray, ids: np.ndarray, others: np.ndarray) -> None:
        """``keys`` are 4 * context + choice of the steps since the last time, ``ids`` their ids
        and ``others`` those that no candidate named."""
        counts = np.bincount(keys, minlength=4 * math.prod(CONTEXTS)).reshape(*CONTEXTS, 4)
        n, hits = counts.sum(-1), counts[..., 0]
        # The weights follow the errors of what was predicted.
        error = (hits << CHOICE_BITS) - n * self.p
        total = np.maximum(n.sum((1, 2, 3)), 1)
        for k, x in enumerate(self._inputs()):
            self.weights[:, k] += RATE * (error * x).sum((1, 2, 3)) // (total << 4)
        np.clip(self.weights, -MOST_WEIGHT, MOST_WEIGHT, out=self.weights)
        missed = n - hits
        missed[:, :, 1] = 0
        new = [(hits.sum((1, 3)), n.sum((1, 3))), (hits.sum((0, 3)), n.sum((0, 3)))]
        new += [(hits.sum((0, 1, 2)), n.sum((0, 1, 2)))]
        new += [(counts[..., 1].sum((0, 2, 3)), missed.sum((0, 2, 3)))]
        for k, (r, m) in enumerate(new):
            self.right[k] += r
            self.all[k] += m
            many = self.all[k] > MOST_COUNT
            self.right[k][many] >>= 1
            self.all[k][many] >>= 1
        self.seen += np.bincount(ids, minlength=IDS)
        self.others += np.bincount(others, minlength=IDS)
        self._mix()
        self._order0()


def _run(blocks: int, size: int, last: int, ids: np.ndarray | None, words) -> np.ndarray | list:
    """Code ``ids`` (size x blocks), or decode ``words``, in one and the same walk.

    The last block has ``last`` ids, all others ``size``.
    """
    coder = _Encoder(blocks, size) if ids is not None else _Decoder(words)
    out = ids if ids is not None else np.zeros((size, blocks), U16)
    model = _Model(ids is None)
    two, one = model.two, model.one
    prev, before = np.zeros(blocks, I64), np.zeros(blocks, I64)
    keys: list[np.ndarray] = []
    others: list[np.ndarray] = []
    learned = 0
    for t in range(size):
        n = blocks if t < last else blocks - 1
        if not n:
            break
        a = prev[:n]
        at2 = (((a * 40503) ^ (before[:n] * 60493)) >> 5) & (SLOTS_2 - 1)
        held1, held2 = one[a], two[at2]
        wide1, wide2 = held1.astype(I64), held2.astype(I64)
        s1, s2, c1, c2 = wide1 & 15, wide2 & 15, wide1 >> 4, wide2 >> 4
        first = np.where(s2 > 0, c2, c1)
        known1 = s1 > 0
        key = (s2 << 4) | s1
        key <<= 1
        key |= (c1 == first) & known1
        key <<= 4
        key |= model.often[first]
        key <<= 2
        unit = coder.range[:n] >> SHIFT_CHOICE
        if ids is not None:
            x = ids[t, :n].astype(I64)
            right1 = c1 == x
            over1 = x != first
            over2 = over1 > (right1 & known1)
        else:
            ahead = coder.ahead[:n]
            over1 = ahead >= unit * model.edge[key + 1]
            over2 = ahead >= unit * model.edge[key + 2]
            x = np.where(over1, c1, first)
        key += over1
        key += over2
        keys.append(key)
        begin, rng = unit * model.edge[key], unit * model.width[key]

        rest = np.flatnonzero(over2)
        if ids is not None:
            if len(rest):
                value = x[rest]
                others.append(value)
                share, step = model.share[value], rng[rest] >> SHIFT_ID
                begin[rest] += step * (share >> WORD)
                rng[rest] = step * (share & LOW_WORD)
            coder.step(n, begin, rng)
        else:
            ahead = ahead - begin
            if len(rest):
                far, step = ahead[rest], rng[rest] >> SHIFT_ID
                value = model.ids.take((far // step).view(I64), mode="clip").astype(I64)
                x[rest] = value
                others.append(value)
                share = model.share[value]
                ahead[rest] = far - step * (share >> WORD)
                rng[rest] = step * (share & LOW_WORD)
            coder.step(n, ahead, rng)
            out[t, :n] = x
            right1 = c1 == x

        # Of blocks with the same context, the last one is remembered.
        fresh = (x.astype(np.int32) << 4) | 1
        s1 <<= 1
        s1 += right1
        one[a] = np.where(right1 | (s1 > 3), held1 + _GAIN[s1], fresh)
        right2 = c2 == x
        s2 <<= 1
        s2 += right2
        two[at2] = np.where(right2 | (s2 > 3), held2 + _GAIN[s2], fresh)
        before, prev = a, x
        if len(keys) >= min(MOST_STEPS, max(1, learned)):
            new = out[learned : t + 1].ravel() if n == blocks else out[learned : t + 1, :n].ravel()
            model.learn(np.concatenate(keys), new, np.concatenate([*others, np.zeros(0, I64)]))
            learned = t + 1
            keys.clear()
            others.clear()
    return coder.finish() if ids is not None else out


def encode_blocks(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """Cut ids below 65,536 into blocks of ``size`` (the last may be shorter) and code them, as
    one group, to 32-bit words each."""
    if not len(ids):
        return []
    blocks = -(-len(ids) // size)
    size = min(size, len(ids))
    padded = np.zeros(blocks * size, U16)
    padded[: len(ids)] = ids
    table = np.ascontiguousarray(padded.reshape(blocks, size).T)
    return _run(blocks, size, len(ids) - (blocks - 1) * size, table, None)


def decode_blocks(words: list[np.ndarray], size: int, count: int) -> np.ndarray:
    """The ``count`` ids of the blocks of one group."""
    if not count:
        return np.zeros(0, U16)
    size = min(size, count)
    last = count - (len(words) - 1) * size
    table = _run(len(words), size, last, None, words)
    return np.ascontiguousarray(table.T).ravel()[:count]


ship(__name__)
