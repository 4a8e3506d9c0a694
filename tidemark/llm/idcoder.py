"""Adaptive context-mixing range coder for token ids, in independent checksummed blocks.

A block's ids are cut into lanes of equal length that are coded in step, one id of each lane at a time, with
one model; so every step is a handful of array operations.  The model starts empty in each block.
* Order 2 and order 1 each predict one id, the last that followed the same two ids or id, with a confidence.
* Order 0 is the adaptive frequency of all ids, renewed whenever a block has grown by a third.
* The two confidences choose a row of adaptive counts that mix the three: so much for the order-2 id, so
  much for the order-1 id, and the rest for order 0.
One interval of the mixture codes one id in a carry-less range coder (64-bit low end, 16-bit words).
All arithmetic is on integers, so a block decodes alike on any machine.

Block layout (little-endian): ``TMRC``, unsigned 32-bit version, ids, lanes, CRC-32 of the ids (as unsigned
32-bit integers), CRC-32 of all that follows; each lane's number of words (unsigned 32-bit); the words, lane after lane.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION = b"TMRC", 1
HEAD = struct.Struct("<4sIIIII")
LANES, LEAST_STEPS = 8192, 64
MIX_BITS, ID_BITS, CONTEXT_BITS = 12, 20, 18
SURE = 7                                            # highest confidence
SYMBOLS = 1 << 16
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 40)
_16, _48 = np.uint64(16), np.uint64(48)
_TOTAL = np.uint64(MIX_BITS + ID_BITS)


def lanes_of(n: int) -> int:
    return max(1, min(LANES, n // LEAST_STEPS))


# change of a packed guess by (right, confidence): one more up to SURE, or one fewer
_STEP = np.array([-(1 << 16)] * 8 + [1 << 16] * SURE + [0], dtype=np.int32)


class Model:
    """Predictions and mixture; encoder and decoder update it alike."""

    def __init__(self, lanes: int):
        self.one = np.zeros(SYMBOLS, dtype=np.int32)                    # id | confidence << 16
        self.two = np.zeros(1 << CONTEXT_BITS, dtype=np.int32)
        self.last = np.zeros(lanes, dtype=np.int32)
        self.before = np.zeros(lanes, dtype=np.int32)
        rows = 2 * (SURE + 1) ** 2
        self.mix = np.ones((rows, 3), dtype=np.int64)
        self.mix[:, 2] = 4
        self.count = np.zeros(SYMBOLS, dtype=np.int64)
        self.seen, self.renew, self.held = 0, 0, []
        self._renew(True)

    def _renew(self, slots: bool) -> None:
        """Order-0 frequencies that sum up to 2**ID_BITS, each at least 1."""
        if self.held:
            self.count += np.bincount(np.concatenate(self.held), minlength=SYMBOLS)
        self.held = []
        spare, total = (1 << ID_BITS) - SYMBOLS, max(1, int(self.count.sum()))
        self.freq = 1 + self.count * spare // total
        self.freq[int(np.argmax(self.count))] += (1 << ID_BITS) - int(self.freq.sum())
        self.cum = np.cumsum(self.freq) - self.freq
        self.freq, self.cum = self.freq.astype(np.uint64), self.cum.astype(np.uint64)
        self.slots = np.repeat(np.arange(SYMBOLS, dtype=np.uint16), self.freq.astype(np.int64)) if slots else None
        self.renew = max(LANES // 4, self.seen + self.seen // 3)

    def predict(self, k: int) -> None:
        """For the first k lanes: guesses of orders 2 and 1 and the row of the mixture; and the mixture itself."""
        last, before = self.last[:k], self.before[:k]
        self.spot = ((last.view(np.uint32) * np.uint32(0x9E3779B1) ^ before.view(np.uint32) * np.uint32(0x85EBCA6B))
                     >> np.uint32(32 - CONTEXT_BITS)).astype(np.intp)
        self.at = last.astype(np.intp)
        self.g2, self.g1 = self.two[self.spot], self.one[self.at]
        self.p2, self.p1 = self.g2 & 0xFFFF, self.g1 & 0xFFFF
        self.n2, self.n1 = self.g2 >> 16, self.g1 >> 16
        self.row = ((self.n2 << 4) + (self.n1 << 1) + (self.p2 == self.p1)).astype(np.intp)
        width = self.mix * ((1 << MIX_BITS) - 3) // self.mix.sum(axis=1, keepdims=True) + 1
        width[:, 2] = (1 << MIX_BITS) - width[:, 0] - width[:, 1]
        # by row and choice: where its part of the mixture begins, its width, and both with all of order 0
        begin = np.cumsum(width, axis=1) - width
        self.begin1, self.begin2 = begin[:, 1].astype(np.uint32), begin[:, 2].astype(np.uint32)
        self.width = width.astype(np.uint64).ravel()
        self.begin_all = begin.astype(np.uint64).ravel() << np.uint64(ID_BITS)
        self.width_all = self.width << np.uint64(ID_BITS)

    def interval(self, ids: np.ndarray, choice: np.ndarray, at0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and width of each id's interval among 2**(MIX_BITS + ID_BITS); ``choice``: row * 3 + by; ``at0``: lanes
        of order 0."""
        begin, width = self.begin_all[choice], self.width_all[choice]
        own, part = ids[at0], self.width[choice[at0]]
        begin[at0] += part * self.cum.take(own)
        width[at0] = part * self.freq.take(own)
        return begin, width

    def learn(self, ids: np.ndarray, choice: np.ndarray, slots: bool) -> None:
        """Of lanes that share a context the last one's update stays."""
        k = len(ids)
        self.mix += np.bincount(choice, minlength=self.mix.size).reshape(self.mix.shape)
        self.mix = np.where(self.mix.sum(axis=1, keepdims=True) > 1 << 16, (self.mix + 1) >> 1, self.mix)
        fresh = ids | 1 << 16
        for table, spot, guess, sure, packed in ((self.two, self.spot, self.p2, self.n2, self.g2),
                                                 (self.one, self.at, self.p1, self.n1, self.g1)):
            right = guess == ids
            table[spot] = np.where(right | (sure > 1), packed + _STEP.take(right * 8 + sure), fresh)
        self.before[:k] = self.last[:k]
        self.last[:k] = ids
        self.held.append(ids)
        self.seen += k
        if self.seen >= self.renew:
            self._renew(slots)


def _settle(low: np.ndarray, size: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
    """The lanes (of all, or ``among`` some) whose top word is certain or whose interval is too small, which
    is then cut to fit."""
    own_low, own_size = (low, size) if among is None else (low[among], size[among])
    certain = (own_low ^ (own_low + own_size)) < TOP
    small = own_size < BOTTOM
    on = np.flatnonzero(certain | small)
    cut = np.flatnonzero(small & ~certain)
    if among is not None:
        on, cut = among[on], among[cut]
    if len(cut):
        size[cut] = (np.uint64(0) - low[cut]) & (BOTTOM - np.uint64(1))
    return on


def _lane_lengths(n: int, lanes: int) -> tuple[int, int]:
    """Steps, and the lanes that code an id in the last one (all do in those before)."""
    steps = -(-n // lanes)
    return steps, n - lanes * (steps - 1)


def _by_step(ids: np.ndarray, lanes: int) -> np.ndarray:
    """Row s: the s-th id of each lane.  The first ``full`` lanes have an id in each step, the others one fewer."""
    steps, full = _lane_lengths(len(ids), lanes)
    out = np.zeros((steps, lanes), dtype=np.uint16)
    out[:, :full] = ids[:full * steps].reshape(full, steps).T
    out[:steps - 1, full:] = ids[full * steps:].reshape(lanes - full, steps - 1).T
    return out


def _by_lane(rows: np.ndarray, n: int) -> np.ndarray:
    """The ids, lane after lane, of ``_by_step``'s rows."""
    steps, full = _lane_lengths(n, rows.shape[1])
    return np.concatenate([rows[:, :full].T.ravel(), rows[:steps - 1, full:].T.ravel()])


def encode(ids: np.ndarray) -> bytes:
    """A block of the ids (unsigned 16-bit values)."""
    n = len(ids)
    check = zlib.crc32(ids.astype("<u4").tobytes())
    if not n:
        return HEAD.pack(MAGIC, VERSION, 0, 0, check, zlib.crc32(b""))
    lanes = lanes_of(n)
    steps, full = _lane_lengths(n, lanes)
    rows = _by_step(ids, lanes)
    model = Model(lanes)
    low = np.zeros(lanes, dtype=np.uint64)
    size = np.full(lanes, np.iinfo(np.uint64).max, dtype=np.uint64)
    out_lane, out_word = [], []
    for s in range(steps):
        k = lanes if s + 1 < steps else full
        x = rows[s, :k].astype(np.int32)
        model.predict(k)
        two = x == model.p2
        zero = ~two & (x != model.p1)
        choice = model.row * 3 + (1 - two + zero)
        cum, width = model.interval(x, choice, np.flatnonzero(zero))
        unit = size[:k] >> _TOTAL
        low[:k] += unit * cum
        size[:k] = unit * width
        model.learn(x, choice, False)
        at = _settle(low, size)
        while len(at):
            out_lane.append(at)
            out_word.append((low[at] >> _48).astype(np.uint16))
            low[at] <<= _16
            size[at] <<= _16
            at = _settle(low, size, at)
    for _ in range(4):
        out_lane.append(np.arange(lanes))
        out_word.append((low >> _48).astype(np.uint16))
        low <<= _16
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane.astype(np.uint16), kind="stable")
    body = np.bincount(lane, minlength=lanes).astype("<u4").tobytes() + word[order].astype("<u2").tobytes()
    return HEAD.pack(MAGIC, VERSION, n, lanes, check, zlib.crc32(body)) + body


def decode(block: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError if the block is damaged."""
    if len(block) < HEAD.size:
        raise ValueError("block cut short")
    magic, version, n, lanes, check, body_check = HEAD.unpack_from(block)
    body = memoryview(block)[HEAD.size:]
    if magic != MAGIC or version != VERSION or zlib.crc32(body) != body_check:
        raise ValueError("damaged block")
    if not n:
        return np.zeros(0, dtype=np.uint16)
    count = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    words = np.append(np.frombuffer(body, "<u2", offset=4 * lanes).astype(np.uint64), np.uint64(0))
    at = np.cumsum(count) - count
    steps, full = _lane_lengths(n, lanes)
    model = Model(lanes)
    model._renew(True)
    low = np.zeros(lanes, dtype=np.uint64)
    size = np.full(lanes, np.iinfo(np.uint64).max, dtype=np.uint64)
    code = np.zeros(lanes, dtype=np.uint64)
    for _ in range(4):
        code = code << _16 | words[at]
        at += 1
    rows = np.zeros((steps, lanes), dtype=np.uint16)
    most = np.uint64((1 << (MIX_BITS + ID_BITS)) - 1)
    for s in range(steps):
        k = lanes if s + 1 < steps else full
        model.predict(k)
        unit = size[:k] >> _TOTAL
        v = np.minimum((code[:k] - low[:k]) // unit, most).astype(np.uint32)
        part, row = v >> np.uint32(ID_BITS), model.row
        two, zero = part < model.begin1[row], part >= model.begin2[row]
        choice = row * 3 + (1 - two + zero)
        x = np.where(two, model.p2, model.p1)
        at0 = np.flatnonzero(zero)
        mine = choice[at0]
        x[at0] = model.slots.take((v[at0] - model.begin_all[mine].astype(np.uint32)) // model.width[mine].astype(np.uint32))
        cum, width = model.interval(x, choice, at0)
        low[:k] += unit * cum
        size[:k] = unit * width
        model.learn(x, choice, True)
        rows[s, :k] = x
        on = _settle(low, size)
        while len(on):
            code[on] = code[on] << _16 | words[at[on]]
            at[on] += 1
            low[on] <<= _16
            size[on] <<= _16
            on = _settle(low, size, on)
    out = _by_lane(rows, n)
    if zlib.crc32(out.astype("<u4").tobytes()) != check:
        raise ValueError("ids fail their checksum")
    return out
