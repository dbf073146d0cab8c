"""A context-mixing range coder for token ids.

Ids are cut into blocks; a block starts from the same state whatever lies before it, and
carries its own length and checksum. Blocks are coded side by side, one id of each at a
time, so that each step is a handful of numpy operations on all of them.

Three models predict the next id. Order 2 and order 1 remember, in hashed tables, the id
that last followed the last two ids or the last one, with a confidence. Order 0 keeps all
ids ranked: an id that it codes changes places with the id at a quarter of its rank. What is coded
first is a class: the id is order 2's, or order 1's, or lies in one of the rank ranges of
order 0, each four times as wide as the one before. Each model has its own distribution of
the classes, for its present confidence; their mixture, with weights that follow how well
each foretold the classes so far (online EM), drives the range coder. Distributions and
weights change between spans of steps (short ones first), so that a step looks its mixture up; the
tables and ranks change with every id. Within its range, an id's rank is coded evenly. All of it is integer
arithmetic (and single divisions of doubles), the same on every machine.

The coder is a carry-less range coder: 64-bit low, 32-bit words out.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK_IDS = 4_096
LANES = 1_792  # blocks that are coded side by side
MAGIC = b"TIDS\x02\x00\x00\x00"
_TABLE = 12  # bits of the order 1 and order 2 tables
_TOTAL = 14  # bits of a frequency
_ONE = 1 << 15  # a probability, or all weights, of 1
_COLUMNS = 16  # of a row of cumulated frequencies: 0, at most 15 classes, what no value reaches
_CONTEXTS = 32  # confidence of order 1 (4) and order 2 (4), whether they agree (2)
_SEEN = 8  # what a class counts each time
_LONGEST = 1_024  # steps between two changes of the distributions
_WINDOW = 32  # steps that the encoder prepares together
_HALF = np.uint64(32)
_LOW = np.uint64((1 << 32) - 1)
_BOTTOM = np.uint64(1 << 32)  # the range is kept at or above this


def _spans(steps: int):
    """Steps between which distributions and weights stay as they are: short ones first."""
    at, end = 0, 16
    while at < steps:
        yield at, min(end, steps)
        at, end = end, end + min(end, _LONGEST)


class _Lanes:
    """The state of blocks that are coded side by side."""

    def __init__(self, lanes: int, vocabulary: int, coding: bool):
        # classes: order 2's id, order 1's id, then the rank ranges
        first, bits, edge = [0, 0], [0, 0], 0
        while edge < vocabulary:
            room = (vocabulary - edge - 1).bit_length()
            last = len(bits) == _COLUMNS - 2
            first.append(edge)
            bits.append(room if last else min(room, 2 * len(bits) - 2))
            edge = vocabulary if last else edge + (1 << bits[-1])
        self.first, self.bits = np.array(first), np.array(bits, np.uint64)
        self.classes = len(bits)
        self.split = max(bits) > 32 - _TOTAL  # class and place don't fit into one step
        self.vocabulary = vocabulary
        kind = np.uint16 if vocabulary <= 1 << 16 else np.int32
        self.at_rank = np.tile(np.arange(vocabulary, dtype=kind), lanes)
        self.rank_of = self.at_rank.copy() if coding else None  # decoding never asks for an id's rank
        # order 1's entries, then order 2's: 4 * id + confidence; nothing seen: no id
        self.seen = np.full(2 * lanes << _TABLE, -4, np.int32)
        self.lane = np.arange(lanes)
        self.tables = (np.arange(2 * lanes) << _TABLE).reshape(2, lanes)
        self.ranks = self.lane * vocabulary
        self.counts = [np.full((lanes, n, self.classes), _SEEN // 2, np.int32) for n in (1, 4, 8)]
        self.weights = np.full((3, lanes), _ONE // 3, np.int32)
        self.weights[0] += _ONE - self.weights.sum(axis=0)
        self.row = np.full((lanes * _CONTEXTS, _COLUMNS), (1 << 16) - 1, np.uint16)
        self.row[:, 0] = 0
        self._mix()

    def keep(self, lanes: int) -> None:
        """Go on with the first lanes only: the others' blocks have ended."""
        self.lane, self.ranks, self.tables = self.lane[:lanes], self.ranks[:lanes], self.tables[:, :lanes]
        self.counts = [c[:lanes] for c in self.counts]
        self.shares = [s[:lanes] for s in self.shares]
        self.weights, self.row = self.weights[:, :lanes], self.row[:lanes * _CONTEXTS]

    def _mix(self) -> None:
        """The models' distributions, and their mixture for every lane and context."""
        sums = [np.cumsum(c, axis=2, dtype=np.int32) for c in self.counts]
        sums = [(s << 15) // s[:, :, -1:] for s in sums]
        self.shares = [np.diff(s, axis=2, prepend=np.int32(0)) for s in sums]
        zero, one, two = (s * w[:, None, None] for s, w in zip(sums, self.weights, strict=True))
        mixed = (zero + one)[:, :, None] + two[:, None]
        mixed >>= 16
        mixed *= (1 << _TOTAL) - self.classes
        mixed >>= _TOTAL
        mixed += np.arange(1, self.classes + 1, dtype=np.int32)
        self.row[:, 1:self.classes + 1] = mixed.reshape(-1, self.classes)

    def slots(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Places of the order 1 and order 2 entries (2 x lanes; of several steps if given)."""
        key = np.empty((*last.shape[:-1], 2, last.shape[-1]), np.int32)
        np.multiply(last, 40503, out=key[..., 0, :])
        np.multiply(last, 20014, out=key[..., 1, :])
        key[..., 1, :] += before * 61681
        key >>= 4
        key &= (1 << _TABLE) - 1
        return key + self.tables

    def follow(self, slots: np.ndarray, entries: np.ndarray, hit: np.ndarray, ids: np.ndarray) -> None:
        """Take ids into the order 1 and order 2 tables (``slots`` flat): a wrong entry loses
        confidence, and its place once it has little left."""
        ids = ids << 2
        ids |= 1
        kept = entries - 1
        kept |= hit.view(np.int8) * np.int8(3)
        self.seen[slots] = np.where(hit | ((entries & 2) > 0), kept, ids).reshape(-1)

    def move(self, rows: np.ndarray, rank: np.ndarray, coded: np.ndarray) -> None:
        """Take ids that order 0 coded to a quarter of their ranks."""
        base, front = self.ranks[rows], rank >> 2
        ahead = base + front
        other = self.at_rank[ahead]
        self.at_rank[ahead], self.at_rank[base + rank] = coded, other
        if self.rank_of is not None:
            self.rank_of[base + other], self.rank_of[base + coded] = rank, front

    def learn(self, at: np.ndarray) -> None:
        """Take a span's places in ``row`` (steps x lanes) into distributions and weights."""
        lanes = len(self.lane)
        seen = np.bincount(at.reshape(-1), minlength=self.row.size).reshape(lanes, 4, 8, _COLUMNS)[..., :self.classes].astype(np.int32)
        told = np.diff(self.row[:, :self.classes + 1]).reshape(seen.shape)
        part = (seen * float(1 << 30) / told).astype(np.int64)
        weights = self.weights.astype(np.int64)
        for i, (part_of, seen_of) in enumerate(zip(_margins(part), _margins(seen), strict=True)):
            # online EM: each weight goes half the way to its model's part in what was foretold
            part_of *= self.shares[i]
            weights[i] += (part_of.reshape(lanes, -1).sum(axis=1) * weights[i] >> 31) // len(at)
            self.counts[i] -= self.counts[i] >> 3
            self.counts[i] += _SEEN * seen_of
        weights = np.maximum(weights >> 1, 512)
        weights = (weights << 15) // weights.sum(axis=0)
        weights[0] += _ONE - weights.sum(axis=0)
        self.weights = weights.astype(np.int32)
        self._mix()


def _margins(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over lanes x contexts of order 1 x contexts of order 2 x classes, for order 0, 1 and 2."""
    two = cells[:, 0] + cells[:, 1] + cells[:, 2] + cells[:, 3]
    one = cells
    while (n := one.shape[2] // 2):  # longer rows for numpy than in a sum over the axis
        one = one[:, :, :n] + one[:, :, n:]
    one = one[:, :, 0]
    return one.sum(axis=1, keepdims=True, dtype=cells.dtype), one, two


def _context(entries: np.ndarray, guess: np.ndarray) -> np.ndarray:
    sure = entries & 3
    context = sure[..., 0, :] * 8
    context += sure[..., 1, :] * 2
    context += guess[..., 0, :] == guess[..., 1, :]
    return context


def _shift(low: np.ndarray, wide: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Moves the upper half of ``low`` out where the range has become small, and gives it. A range that still
    reaches over the words' border is cut at it: no carry ever runs into written words."""
    own = low[rows]
    rest = own & _LOW
    wide[rows] = np.minimum(wide[rows], _BOTTOM - rest) << _HALF
    low[rows] = rest << _HALF
    return own >> _HALF


def _going(lengths: list[int]) -> list[int]:
    """How many of the blocks, longest first, are longer than each step."""
    return np.searchsorted(-np.array(lengths), -np.arange(lengths[0])).tolist()


def _encode_side_by_side(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """``blocks``, longest first, to their words."""
    n, steps = len(blocks), len(blocks[0])
    ids = np.zeros((2 + steps, n), np.int32)  # two that come before
    for i, b in enumerate(blocks):
        ids[2:2 + len(b), i] = b
    every_going = _going([len(b) for b in blocks])
    model = _Lanes(n, vocabulary, True)
    class_of = np.repeat(np.arange(2, model.classes, dtype=np.uint8), np.diff(np.append(model.first[2:], vocabulary)))
    room = steps * (1 + model.split) + 2
    out = np.zeros(n * room, np.uint32)
    end = np.arange(n) * room
    low, wide = np.zeros(n, np.uint64), np.full(n, ~np.uint64(0))

    def put(going: int) -> None:
        rows = (wide[:going] < _BOTTOM).nonzero()[0]
        at = end[rows]
        out[at] = _shift(low, wide, rows)
        end[rows] = at + 1

    for first, past in _spans(steps):
        if every_going[first] < len(model.lane):
            model.keep(every_going[first])
        places = np.zeros((past - first, len(model.lane)), np.int32)
        for a in range(first, past, _WINDOW):
            b = min(past, a + _WINDOW)
            going = every_going[a:b]
            if going[0] < len(model.lane):
                model.keep(going[0])
            lanes, table = len(model.lane), model.row.reshape(-1)
            rank = np.zeros((b - a, lanes), np.int64)
            entries = np.full((b - a, 2, lanes), -4, np.int32)
            own = ids[2 + a:2 + b, :lanes]
            slots = model.slots(ids[1 + a:1 + b, :lanes], ids[a:b, :lanes])
            key = own + model.ranks
            for t in range(b - a):
                k = going[t]
                if k < len(model.lane):
                    model.keep(k)
                coded, at = own[t, :k], slots[t, :, :k].reshape(-1)
                found = model.seen[at].reshape(2, k)
                hit = (found >> 2) == coded
                entries[t, :, :k] = found
                model.follow(at, found, hit, coded)
                rows = (~(hit[0] | hit[1])).nonzero()[0]
                ranks = model.rank_of[key[t, rows]].astype(np.int64)
                rank[t, rows] = ranks
                model.move(rows, ranks, coded[rows])
            # the rest needs no step by step: all entries and ranks are known
            guess = entries >> 2
            context = _context(entries, guess)
            hit = guess == own[:, None]
            found = class_of[rank]
            found[hit[:, 0]] = 1
            found[hit[:, 1]] = 0
            at = (np.arange(lanes) * _CONTEXTS + context) * _COLUMNS + found
            places[a - first:b - first, :lanes] = at
            below = table[at].astype(np.uint64)
            share = table[at + 1] - below
            bits = model.bits[found]
            place = (rank - model.first[found]).astype(np.uint64)
            for t in range(b - a):
                k = going[t]
                lo, hi = low[:k], wide[:k]
                hi >>= np.uint64(_TOTAL)
                lo += hi * below[t, :k]
                hi *= share[t, :k]
                if model.split:
                    put(k)
                hi >>= bits[t, :k]
                lo += hi * place[t, :k]
                put(k)
        if past < steps:
            model.learn(places[:, :len(model.lane)])
    for half in (_HALF, np.uint64(0)):
        out[end] = (low >> half) & _LOW
        end += 1
    return [out[i * room:end[i]].astype("<u4").tobytes() for i in range(n)]


def _decode_side_by_side(words: list[bytes], lengths: list[int], vocabulary: int) -> list[np.ndarray]:
    """The blocks back, given their words and lengths, longest first."""
    n, steps = len(words), lengths[0]
    size = np.array([len(w) // 4 for w in words])
    room = int(size.max()) + 4
    given = np.zeros((n, room), np.uint64)  # zeros behind the end
    for i, w in enumerate(words):
        given[i, :size[i]] = np.frombuffer(w, "<u4")
    given = given.reshape(-1)
    at = np.arange(n) * room
    limit = at + room - 1
    ahead = given[at] << _HALF | given[at + 1]  # the code's distance from low
    at += 2
    model = _Lanes(n, vocabulary, False)
    out = np.zeros((steps, n), np.int32)
    low, wide = np.zeros(n, np.uint64), np.full(n, ~np.uint64(0))
    going = _going(lengths)
    highest = np.uint64((1 << _TOTAL) - 1)
    most = (np.uint64(1) << model.bits) - np.uint64(1)
    last = before = np.zeros(n, np.int32)

    def take(going: int) -> None:
        rows = (wide[:going] < _BOTTOM).nonzero()[0]
        _shift(low, wide, rows)
        places = at[rows]
        ahead[rows] = ahead[rows] << _HALF | given[np.minimum(places, limit[rows])]
        at[rows] = places + 1

    for a, b in _spans(steps):
        places = np.zeros((b - a, len(model.lane)), np.int32)
        for t in range(a, b):
            k = going[t]
            if k < len(model.lane):
                model.keep(k)
            slots = model.slots(last[:k], before[:k]).reshape(-1)
            entries = model.seen[slots].reshape(2, k)
            guess = entries >> 2
            at_row = model.lane * _CONTEXTS + _context(entries, guess)
            row = model.row.take(at_row, axis=0)
            lo, hi, code = low[:k], wide[:k], ahead[:k]
            hi >>= np.uint64(_TOTAL)
            value = np.minimum(code // hi, highest).astype(np.uint16)
            # a byte for each column at or below the value
            met = np.bitwise_count((row <= value[:, None]).view(np.uint64))
            found = np.minimum(met[:, 0] + met[:, 1] - 1, model.classes - 1).astype(np.int64)
            places[t - a, :k] = at_row * _COLUMNS + found
            column = model.lane * _COLUMNS + found
            flat = row.reshape(-1)
            below = flat[column].astype(np.uint64)
            share = flat[column + 1] - below
            below *= hi
            lo += below
            code -= below
            hi *= share
            if model.split:
                take(k)
            hi >>= model.bits[found]
            place = np.minimum(code // hi, most[found])
            step = hi * place
            lo += step
            code -= step
            take(k)
            own = np.where(found == 0, guess[1], guess[0])
            rows = (found > 1).nonzero()[0]
            rank = np.minimum(model.first[found[rows]] + place[rows].astype(np.int64), vocabulary - 1)
            coded = model.at_rank[model.ranks[rows] + rank]
            own[rows] = coded
            out[t, :k] = own
            model.move(rows, rank, coded)
            model.follow(slots, entries, guess == own, own)
            last, before = own, last
        if b < steps:
            k = len(model.lane)
            model.learn(places[:, :k])
    return [out[:k, i].astype(np.int64) for i, k in enumerate(lengths)]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode(ids: np.ndarray, vocabulary: int, block_ids: int = BLOCK_IDS) -> bytes:
    """Ids (0 to vocabulary - 1) as bytes: magic, vocabulary, number of blocks; of each
    block its ids, its words and the crc32 of its ids; the crc32 of all this; then the
    words (all little-endian)."""
    ids = np.asarray(ids)
    if len(ids) and not 0 <= ids.min() <= ids.max() < vocabulary:
        raise ValueError("an id is outside the vocabulary")
    blocks = [ids[i:i + block_ids] for i in range(0, len(ids), block_ids)]
    words: list[bytes] = []
    for i in range(0, len(blocks), LANES):
        words += _encode_side_by_side(blocks[i:i + LANES], vocabulary)
    table = np.array([(len(b), len(w) // 4, _crc(b)) for b, w in zip(blocks, words, strict=True)], "<u4").reshape(-1, 3)
    head = MAGIC + np.array([vocabulary, len(blocks)], "<u4").tobytes() + table.tobytes()
    return b"".join([head, zlib.crc32(head).to_bytes(4, "little"), *words])


def decode(data: bytes) -> np.ndarray:
    """The ids of ``encode``; ValueError if a checksum doesn't hold."""
    if len(data) < 16 or data[:8] != MAGIC:
        raise ValueError("not a block file of token ids")
    vocabulary, n = np.frombuffer(data, "<u4", 2, 8).tolist()
    first = 20 + 12 * n
    if len(data) < first or zlib.crc32(data[:first - 4]) != int.from_bytes(data[first - 4:first], "little"):
        raise ValueError("the table of blocks is damaged")
    table = np.frombuffer(data, "<u4", 3 * n, 16).reshape(n, 3).astype(np.int64)
    start = first + np.append(0, np.cumsum(4 * table[:, 1]))
    if start[-1] != len(data):
        raise ValueError("the blocks' lengths don't add up")
    found: list[np.ndarray] = []
    for i in range(0, n, LANES):
        some = range(i, min(n, i + LANES))
        found += _decode_side_by_side([data[start[j]:start[j + 1]] for j in some], table[list(some), 0].tolist(), vocabulary)
    for j, block in enumerate(found):
        if _crc(block) != table[j, 2]:
            raise ValueError(f"block {j} is damaged")
    return np.concatenate(found) if found else np.zeros(0, np.int64)
