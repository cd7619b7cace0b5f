"""Language-model scores by online logistic context mixing.

A text is a sequence of symbols: its lower-cased words in order and one end. A
symbol is coded bit by bit, by a code that is short for frequent words (a
dictionary transform ahead of a bit-wise mixer); words outside the dictionary
are an escape and are then spelled, every byte, by a second such code. Each bit has
several predictors: what the code's node says by itself; within the group of
documents that the words before speak for; after the previous word and after the
previous two, both hashed; and what followed when the same two words last stood in
the same text. A gate, set by how sure the hashed contexts are, picks the mixing
weights, which are learnt online: each bit of all training rows is predicted by the
bits before it. An adaptive map refines the mix.

Counts of words and contexts are gathered from all training rows on the
executors. Slots of the hashed contexts and dictionary words are bound in number; for
the base score frequent words' counts are broadcast, in a number that is bound too,
and all others meet their documents in a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .scratch import WIDE, Scratch

MOST_GROUPS = 8
GROUPED = 1 << 16  #: hashed words by which groups are told apart
CODED = 1 << 18  #: dictionary words at most
DISCOUNT = 0.5  #: taken from a dictionary word's count; what is seen once stands for what is not seen
FREQUENT = 1 << 20  #: words whose counts are broadcast
WORD_BITS, BYTE_BITS = (21, 21), (17, 18, 19, 19)  #: logs of the slots of each hashed context
SPELLED = (1, 2, 3, 5)  #: bytes before, within the word, of each context of a spelled byte
STEP, LEARN_STEP = 1 << 13, 1 << 11  #: symbols mixed at a time
CHUNK = 1 << 12  #: slots that travel together
_WIDTHS = (np.uint8, np.uint16, np.uint32)  #: of counts that travel; the least that holds a chunk's
SLICED = 1 << 20  #: characters that are read and learnt at a time, one text at least
SHARD = 8_000_000  #: training tokens that one learner sees, about; their number depends on the texts alone
RATE, MAP_RATE, DELTA = 0.15, 0.02, 0.05
LEVELS = 15  #: of a stretched prediction, to one
SURE, BUCKETS = (0.04, 2.5, 4.0), 24
FINE, MOST = 2048, 15  #: levels of a mix when scoring; a mix at most
GATES = 2 * (len(SURE) + 1) ** 2  #: the last bit is set where there is a match
LEAST = 1e-5
END_OF_WORD = 256
_NODE, _START, _CLOSE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)


@dataclass
class Code:
    """A prefix code: for each symbol its path of nodes and bits."""

    start: np.ndarray  #: of each symbol's path, one entry more than symbols
    nodes: np.ndarray
    bits: np.ndarray
    key: np.ndarray  #: the bits of a symbol from the top of 32

    @property
    def n_nodes(self) -> int:
        return len(self.start) - 2

    def tallies(self, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Zeros and ones at each node, for counts of symbols."""
        own = np.repeat(count.astype(np.float64), np.diff(self.start))
        return tuple(np.bincount(self.nodes[self.bits == b], weights=own[self.bits == b], minlength=self.n_nodes) for b in (0, 1))


def code_of(count: np.ndarray) -> Code:
    """The code of least expected length for counts of two symbols or more; rare ones are rounded up, so that no path exceeds 31 bits."""
    n = len(count)
    weight = np.maximum(count, max(1, int(count.sum()) >> 18)).astype(np.int64)
    order = np.argsort(weight, kind="stable")
    leaves, inner = weight[order].tolist(), []
    parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.uint8)
    i = j = 0
    for k in range(n - 1):
        total = 0
        for b in (0, 1):
            if j >= len(inner) or (i < n and leaves[i] <= inner[j]):
                child, total, i = order[i], total + leaves[i], i + 1
            else:
                child, total, j = n + j, total + inner[j], j + 1
            parent[child], side[child] = n + k, b
        inner.append(total)
    root, at, size = 2 * n - 2, np.arange(n), np.zeros(n, np.int64)
    while (at != root).any():
        size += at != root
        at = np.where(at == root, root, parent[at])
    start = np.concatenate([[0], np.cumsum(size)])
    nodes, bits, key = np.zeros(start[-1], np.int32), np.zeros(start[-1], np.uint8), np.zeros(n, np.uint64)
    live, at, place = np.arange(n), np.arange(n), size - 1
    while len(live):
        nodes[start[live] + place[live]], bits[start[live] + place[live]] = parent[at] - n, side[at]
        key[live] |= side[at].astype(np.uint64) << (31 - place[live]).astype(np.uint64)
        place[live] -= 1
        at = parent[at]
        live, at = live[place[live] >= 0], at[place[live] >= 0]
    return Code(start, nodes, bits, key.astype(np.uint32))


@dataclass
class Mixer:
    """The predictors of one code's bits and how they are mixed.

    Inputs are what the node says within a group, two hashed contexts or more, a match, and a constant.
    """

    code: Code
    odds: np.ndarray  #: of each node within each group: groups x nodes
    slot_bits: tuple
    weights: np.ndarray  #: inputs x gates
    map: np.ndarray  #: gates x buckets
    known: np.ndarray | None = None  #: level of each slot's stretched prediction
    costs: np.ndarray | None = None  #: log10 of a bit, by gate, fine level of the mix, and bit
    pairs: np.ndarray | None = None  #: for two contexts, by their levels: their part of the mix, and the weight of the group's part

    @property
    def inputs(self) -> int:
        return 3 + len(self.slot_bits)

    @property
    def first(self) -> list[int]:
        return np.concatenate([[0], np.cumsum([1 << b for b in self.slot_bits])]).tolist()

    def settle(self, n0: np.ndarray, n1: np.ndarray) -> None:
        """Makes the tables of scoring from the counts of zeros and ones of each slot."""
        self.known = _level(np.log((n1 + np.float32(DELTA)) / (n0 + np.float32(DELTA))))
        self.weights = self.weights.astype(np.float32)
        p = _refined(self.map, np.repeat(np.arange(GATES), FINE), np.tile(_FINE, GATES))
        self.costs = np.log10(np.stack([1 - p, p], 1)).astype(np.float32).ravel()
        if len(self.slot_bits) == 2:
            one, two = np.divmod(np.arange(1 << 16), 256)
            gate = _GATE[one] * (2 * len(SURE) + 2) + _GATE[two] * 2
            w = self.weights
            self.pairs = np.stack([w[1][gate] * _STRETCH[one] + w[2][gate] * _STRETCH[two] + w[-1][gate], w[0][gate]], 1).astype(np.float32).view(np.complex64).ravel()


def _level(x: np.ndarray) -> np.ndarray:
    return np.clip(x * np.float32(LEVELS) + np.float32(128.5), 1, 255).astype(np.uint8)


_STRETCH = ((np.arange(256) - 128) / LEVELS).astype(np.float32)  #: of each level
_GATE = sum((np.abs(_STRETCH) > v).astype(np.int64) for v in SURE)  #: how sure each level is
_TURNS = np.arange(LEARN_STEP * 16) & 3  #: sums of a gate go by turns to four places: most bits have the same gate, and each would wait for the one before
_EDGES = [(np.uint8(at[0]), np.uint8(at[-1] - at[0])) for k in range(len(SURE)) if len(at := np.flatnonzero(_GATE <= k))]  #: first level that is no surer than so much, and levels from there to the last
_BOUNDS = [np.float32(min(at for at in (np.flatnonzero(_GATE > k) - 128.5) / LEVELS if at > 0)) for k in range(len(SURE))]  #: the least stretched prediction that is surer
_FINE = ((np.arange(FINE) - FINE // 2) * (2 * MOST / FINE)).astype(np.float32)


def _stretched(level: np.ndarray) -> np.ndarray:
    """_STRETCH of each level."""
    out = level.astype(np.float32)
    out -= np.float32(128)
    out /= np.float32(LEVELS)
    return out


def _sure(level: np.ndarray) -> np.ndarray:
    """_GATE of each level."""
    return sum((level - lo > span).view(np.uint8) for lo, span in _EDGES)


def _sure_of(x: np.ndarray) -> np.ndarray:
    """The same for stretched predictions that have no level yet."""
    x = np.abs(x)
    return sum((x >= bound).view(np.uint8) for bound in _BOUNDS)


def _cell(gate: np.ndarray, dot: np.ndarray) -> np.ndarray:
    """The map's cell of a mix."""
    place = dot * np.float32(1.5)
    place += np.float32(12)
    np.clip(place, 0, BUCKETS - 1, out=place)
    return gate * BUCKETS + place.astype(np.int64)


def _refined(table: np.ndarray, gate: np.ndarray, dot: np.ndarray):
    """The refined mix."""
    mixed = 1 / (1 + np.exp(-dot))
    return np.clip(0.5 * mixed + 0.5 * _at(table.ravel(), _cell(gate, dot)), LEAST, 1 - LEAST)


def fresh(by_group: np.ndarray, slot_bits: tuple) -> Mixer:
    """A mixer of a code for symbols' counts by group (groups x symbols); a group's own counts lean on all."""
    count = by_group.sum(0)
    code = code_of(count)
    zeros, ones = code.tallies(np.maximum(count, 0.25))
    share = ones / (zeros + ones)
    odds = []
    for own in by_group:
        a, b = code.tallies(own)
        odds.append(np.log((b + 2 * share) / (a + 2 * (1 - share))))
    weights = np.zeros((3 + len(slot_bits), GATES))
    weights[0], weights[1:-1] = 0.9, 0.1
    return Mixer(code, np.array(odds, np.float32), slot_bits, weights, np.tile(1 / (1 + np.exp(-((np.arange(BUCKETS) + 0.5) / 1.5 - 8))), (GATES, 1)))


@dataclass
class Stream:
    """Symbols in order, with their contexts' hashes, groups, and the symbol that a match expects (-1 for none)."""

    symbol: np.ndarray
    contexts: list[np.ndarray]
    group: np.ndarray
    expected: np.ndarray
    copies: np.ndarray | None = None  #: how often each symbol counts, where not once


@dataclass
class Lanes:
    """The bits of the symbols lo to hi, and what predicts them."""

    lo: int
    hi: int
    n: np.ndarray  #: bits of each symbol
    bit: np.ndarray
    slots: list[np.ndarray]
    own: np.ndarray  #: what the node says within the group
    matched: np.ndarray  #: bits that a match foretells
    match: np.ndarray  #: 1 or -1 for each of those


def _at(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    """table[place] without checks."""
    return np.take(table, place, mode="clip")


def _lanes(m: Mixer, s: Stream, step: int = STEP):
    code, first, every = m.code, m.first, m.odds.ravel()
    size = np.diff(code.start)
    for lo in range(0, len(s.symbol), step):
        hi = min(lo + step, len(s.symbol))
        symbol = s.symbol[lo:hi]
        n = _at(size, symbol)
        edge = np.cumsum(n) - n
        total = int(n.sum())
        at = np.repeat(_at(code.start, symbol) - edge, n)
        at += np.arange(total)
        node, bit = _at(code.nodes, at), _at(code.bits, at)
        own = _at(every, np.repeat(s.group[lo:hi].astype(np.int64) * m.odds.shape[1], n) + node)
        hashed = node.astype(np.uint64) * _NODE
        slots = [((np.repeat(c[lo:hi], n) + hashed) >> np.uint64(64 - b)).view(np.int64) + f for c, b, f in zip(s.contexts, m.slot_bits, first)]
        told = np.flatnonzero(s.expected[lo:hi] >= 0)
        key = code.key[s.expected[lo:hi][told]]
        apart = (key ^ code.key[symbol[told]]).astype(np.float64)
        same = np.where(apart > 0, 32 - np.floor(np.log2(np.maximum(apart, 1))), 32).astype(np.int64)
        same = np.minimum(same, n[told])  # bits up to the first that differs, that one too
        depth = np.arange(int(same.sum())) - np.repeat(np.cumsum(same) - same, same)
        matched = np.repeat(edge[told], same) + depth
        match = 2 * (np.repeat(key, same) >> (31 - depth).astype(np.uint32) & 1).astype(np.float32) - 1
        yield Lanes(lo, hi, n, bit, slots, own, matched, match)


def _gates(one: np.ndarray, two: np.ndarray, matched: np.ndarray) -> np.ndarray:
    """The gate of each bit, by how sure the first and the last hashed context are and whether there is a match."""
    gate = one * np.uint8(2 * len(SURE) + 2) + two * np.uint8(2)
    gate[matched] += np.uint8(1)
    return gate.astype(np.int64)


def _mix(m: Mixer, l: Lanes, gate: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
    """The mix of the stretched predictions."""
    w = m.weights.astype(np.float32, copy=False)
    dot = _at(w[0], gate) * l.own + _at(w[-1], gate)
    for k, own in enumerate(x, 1):
        dot += _at(w[k], gate) * own
    dot[l.matched] += w[-2][gate[l.matched]] * l.match
    return np.clip(dot, -MOST, MOST - 0.1, out=dot)


def _costs(m: Mixer, s: Stream) -> np.ndarray:
    """log10 probability of each symbol."""
    out = np.zeros(len(s.symbol))
    scale, middle = np.float32(FINE / (2 * MOST)), np.float32(FINE // 2 + 0.5)
    for l in _lanes(m, s):
        levels = [_at(m.known, slot) for slot in l.slots]
        gate = _gates(_sure(levels[0]), _sure(levels[-1]), l.matched)
        if m.pairs is None:
            dot = _mix(m, l, gate, [_stretched(v) for v in levels])
        else:
            part = _at(m.pairs, levels[0].astype(np.int64) << 8 | levels[1])
            dot = part.imag * l.own
            dot += part.real
            if len(l.matched):  # these go through the gates of a match
                some = Lanes(l.lo, l.hi, l.n, l.bit, l.slots, l.own[l.matched], np.arange(len(l.matched)), l.match)
                dot[l.matched] = _mix(m, some, gate[l.matched], [_stretched(v[l.matched]) for v in levels])
            np.clip(dot, -MOST, MOST - 0.1, out=dot)
        dot *= scale
        dot += middle
        place = gate * FINE + dot.astype(np.int64) << 1 | l.bit
        out[l.lo : l.hi] = np.add.reduceat(_at(m.costs, place), np.cumsum(l.n) - l.n)
    return out


class _Learner:
    """Weights and map of a mixer, learnt online, and the counts of its slots.

    A bit is predicted by the counts of the bits before it. As a task holds but a part of all rows, it predicts
    by a table that is smaller by so much, and as crowded in the end as that of all rows.
    """

    def __init__(self, m: Mixer, tasks: int):
        self.m = Mixer(m.code, m.odds, m.slot_bits, m.weights.copy(), m.map.copy())
        self.total = np.zeros(2 * m.first[-1], np.uint32)
        self.shift = min(max(0, (tasks - 1).bit_length()), min(m.slot_bits) - 8)
        self.near = [np.zeros(2 << (b - self.shift), np.float32) for b in m.slot_bits]  # zeros and ones by turns
        self.power, self.used = np.full(m.weights.shape, 1e-4), np.zeros(GATES)

    def learn(self, s: Stream) -> None:
        m, delta, one = self.m, np.float32(DELTA), np.float32(1)
        for l in _lanes(m, s, LEARN_STEP):
            places, x = [], []
            for slot, f, near in zip(l.slots, m.first, self.near):
                at = slot - f
                at >>= self.shift
                n = _at(near.view(np.complex64), at).view(np.float32)  # both counts at once
                n += delta
                x.append(np.log(n[1::2] / n[::2]))
                at <<= 1
                at |= l.bit
                places.append(at)
            self._teach(l, x)
            copies = np.uint32(1) if s.copies is None else np.repeat(s.copies[l.lo : l.hi].astype(np.uint32), l.n)
            for slot, near, at in zip(l.slots, self.near, places):
                np.add.at(near, at, one)
                slot <<= 1
                slot |= l.bit
                np.add.at(self.total, slot, copies)

    def _teach(self, l: Lanes, x: list[np.ndarray]) -> None:
        m = self.m
        gate = _gates(_sure_of(x[0]), _sure_of(x[-1]), l.matched)
        dot = _mix(m, l, gate, x)
        cell = _cell(gate, dot)
        np.exp(np.negative(dot, out=dot), out=dot)
        dot += np.float32(1)
        error = l.bit - np.reciprocal(dot, out=dot)
        lane = gate << 2
        lane |= _TURNS[: len(lane)] if len(lane) <= len(_TURNS) else np.arange(len(lane)) & 3
        added = lambda weights: np.bincount(lane, weights=weights, minlength=4 * GATES).reshape(GATES, 4).sum(1)
        slope = [added(error * v) for v in (l.own, *x)]
        slope.append(np.bincount(gate[l.matched], weights=error[l.matched] * l.match, minlength=GATES))
        slope.append(added(error))
        cell <<= 1
        cell |= l.bit
        zeros, ones = np.bincount(cell, minlength=2 * GATES * BUCKETS).reshape(-1, 2).T
        hits = zeros + ones
        n = hits.reshape(GATES, BUCKETS).sum(1)
        slope = np.stack(slope) / np.maximum(n, 1)
        self.power += slope**2
        m.weights = m.weights + RATE * slope / np.sqrt(self.power) * (n > 0)
        flat = m.map.ravel()
        m.map = (flat + (1 - (1 - MAP_RATE) ** hits) * (ones / np.maximum(hits, 1) - flat) * (hits > 0)).reshape(GATES, BUCKETS)
        self.used += n

    def counts(self, level: int):
        """The counts of all slots so far, CHUNK slots a row; they begin anew."""
        for k in range(0, len(self.total), 2 * CHUNK):
            part = self.total[k : k + 2 * CHUNK]
            if part.any():
                most = int(part.max())
                blob = part.astype(_WIDTHS[(most > 0xFF) + (most > 0xFFFF)]).tobytes()
                yield _row(level, chunk=pa.array([k // (2 * CHUNK)], pa.int32()), counts=pa.array([blob], pa.binary()))
                part[:] = 0

    def mixing(self, level: int) -> pa.RecordBatch:
        some = np.flatnonzero(self.used)
        return _row(
            level, gate=pa.array(some.astype(np.int32)), n=pa.array(self.used[some]),
            weights=pa.array(self.m.weights.T[some].tolist(), pa.list_(pa.float64())), map=pa.array(self.m.map[some].tolist(), pa.list_(pa.float64())),
        )


_GATHERED = {"chunk": pa.int32(), "counts": pa.binary(), "gate": pa.int32(), "n": pa.float64(), "weights": pa.list_(pa.float64()), "map": pa.list_(pa.float64())}


def _row(level: int, **columns: pa.Array) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.record_batch([pa.array(np.full(n, level, np.int32)), *[columns.get(c, pa.nulls(n, t)) for c, t in _GATHERED.items()]], names=["level", *_GATHERED])


class Lookup:
    """Places of hashes in a sorted table, by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = keys, max(1, len(keys).bit_length())
        self.begin = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 for none."""
        out = np.full(len(h), -1, np.int64)
        bucket = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.begin[bucket], self.begin[bucket + 1]
        live = np.flatnonzero(at < end)
        at, end, want = at[live], end[live], h[live]
        while len(live):
            key = self.keys[at]
            hit = key == want
            out[live[hit]] = at[hit]
            more = (key < want) & (at + 1 < end)
            live, at, end, want = live[more], at[more] + 1, end[more], want[more]
        return out


@dataclass
class Model:
    table: Lookup  #: frequent words
    base: np.ndarray  #: log10 of their counts and one
    number: np.ndarray  #: their symbols; the escape for those that are not coded, and once more for words out of the table
    escape: int  #: the symbol of words that are not coded; the end is the next
    logs: np.ndarray  #: groups x hashed words
    prior: np.ndarray
    words: Mixer
    bytes: Mixer

    def told(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The group that the words before speak for, at each word and at each row's end."""
        n = np.diff(first)
        word, row = np.zeros(len(h), np.int8), np.zeros(len(n), np.int8)
        most, most_row = np.full(len(h), -np.inf), np.full(len(n), -np.inf)
        slot = (h & np.uint64(GROUPED - 1)).view(np.int64)
        sums = np.zeros(len(h) + 1)
        for g in range(len(self.prior)):
            np.cumsum(_at(self.logs[g], slot), out=sums[1:])
            here = sums[:-1] + np.repeat(self.prior[g] - sums[first[:-1]], n)
            better = here > most + 1e-6
            np.copyto(most, here, where=better)
            word[better] = g
            here = self.prior[g] + sums[first[1:]] - sums[first[:-1]]
            better = here > most_row + 1e-6
            most_row[better], row[better] = here[better], g
        return word, row

    def read(self, column: pa.Array, learning: bool = False) -> "Reading":
        """The symbols of a slice of texts, and the spelling of those that are not coded.

        In learning a word that training rows hold once is read as one that they do not hold: without itself it would be.
        """
        data, offsets = tx.buffers(column)
        data = tx._LOWER[data]
        starts, ends, first = tx.word_spans(data, offsets)
        h = tx.span_hashes(data, starts, ends)
        place = self.table.find(h)
        coded = self.number[place]  # -1 is the last
        if learning and len(self.base):
            coded[(self.base[place] < 0.4) & (place >= 0)] = self.escape
        rows = len(first) - 1
        close = first[1:] + np.arange(rows)
        total = len(h) + rows
        inner = np.ones(total, dtype=bool)
        inner[close] = False
        group, last = self.told(h, first)
        symbol, names, groups = np.full(total, self.escape + 1), np.full(total, _CLOSE), np.zeros(total, np.int8)
        symbol[inner], names[inner], groups[inner], groups[close] = coded, h, group, last
        opens = np.concatenate([[0], close[:-1] + 1])[:rows]
        before = np.concatenate([names[:1], names[:-1]])
        before[opens] = _START
        older = np.concatenate([before[:1], before[:-1]])
        older[opens] = _START
        one = tx.mix(before * np.uint64(3) + np.uint64(1))
        two = tx.mix(one + tx.mix(older + np.uint64(5)))
        row = np.repeat(np.arange(rows), np.diff(first) + 1)
        key = two + row.astype(np.uint64) * _NODE
        low = np.uint64(max(20, total.bit_length()))  # keys' leading bits with places below them: sorted at once, and in order of place
        key = np.sort(key >> low << low | np.arange(total, dtype=np.uint64))
        order = (key & (np.uint64(1) << low) - np.uint64(1)).astype(np.int64)
        again = np.flatnonzero(key[1:] >> low == key[:-1] >> low)
        expected = np.full(total, -1, np.int64)
        expected[order[again + 1]] = symbol[order[again]]
        lost = np.flatnonzero(coded == self.escape)
        return Reading(h, first, place, row, Stream(symbol, [one, two], groups, expected), *_spelled(data, starts[lost], ends[lost], h[lost]), lost)


@dataclass
class Reading:
    h: np.ndarray
    first: np.ndarray
    place: np.ndarray
    row: np.ndarray  #: of each symbol
    words: Stream
    bytes: Stream  #: of the distinct words that are spelled
    word: np.ndarray  #: the distinct word of each of its symbols
    back: np.ndarray  #: the distinct word of each spelled one
    lost: np.ndarray  #: the spelled words


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> tuple[Stream, np.ndarray, np.ndarray]:
    """The distinct words among the spans as streams of bytes, each closed by END_OF_WORD."""
    own, at, back, copies = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    size = ends[at] - starts[at] + 1
    edge = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(own)), size)
    off = np.arange(edge[-1]) - edge[word]
    symbol = np.full(edge[-1], END_OF_WORD, np.int64)
    inner = off < size[word] - 1
    symbol[inner] = data[(starts[at][word] + off)[inner]]
    history = np.zeros(len(symbol), np.uint64)
    contexts = []
    for k in range(1, max(SPELLED) + 1):
        previous = np.zeros(len(symbol), np.uint64)
        previous[k:] = symbol[:-k] if k < len(symbol) else 0
        history |= np.where(off >= k, previous + np.uint64(1), np.uint64(0)) << np.uint64(9 * (k - 1))
        if k in SPELLED:
            contexts.append(tx.mix(history + (np.uint64(k) << np.uint64(56))))
    return Stream(symbol, contexts, np.zeros(len(symbol), np.int8), np.full(len(symbol), -1, np.int64), copies[word]), word, back


def _words_with_counts(groups: int):
    """Distinct words of slices with their counts by group; and with b, counts of bytes."""

    def run(batches):
        names = ["h", "b", *[f"c{g}" for g in range(groups)]]
        seen = np.zeros(256, np.int64)
        for batch in batches:
            for i, j in tx.slices(batch.column(0)):
                part = batch.column(0).slice(i, j - i)
                h, first = tx.words(part)
                group = np.repeat(batch.column(1).slice(i, j - i).to_numpy(zero_copy_only=False), np.diff(first))
                for g in np.flatnonzero(np.bincount(group)) if len(h) else ():
                    own, n = np.unique(h[group == g], return_counts=True)
                    counts = [pa.array(n if c == g else np.zeros(len(own), np.int64)) for c in range(groups)]
                    yield pa.record_batch([pa.array(own.view(np.int64)), pa.nulls(len(own), pa.int32()), *counts], names=names)
                seen += np.bincount(tx._LOWER[tx.buffers(part)[0]], minlength=256)
        yield pa.record_batch([pa.nulls(256, pa.int64()), pa.array(np.arange(256, dtype=np.int32)), pa.array(seen), *[pa.array(np.zeros(256, np.int64))] * (groups - 1)], names=names)

    return run


def _gathered(shared, shards: int):
    """Counts of all slots, mixing weights and maps, learnt online on a shard's texts in order, with the number of bits behind each.

    Rows (shard, text) come sorted by shard; a learner begins anew with each. Texts are read SLICED bytes at a time from the
    shard's start on, however Arrow cuts them into batches.
    """

    def run(batches):
        m: Model = shared.value
        learners, at, held, size = None, None, [], 0

        def taught():
            r = m.read(pa.array(held, pa.large_string()), True)
            learners[0].learn(r.words)
            learners[1].learn(r.bytes)
            return len(r.row) + len(r.lost) * 64

        def ended():
            for level, learner in enumerate(learners):
                yield from learner.counts(level)
                yield learner.mixing(level)

        n = 0
        for batch in batches:
            for shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != at:
                    if learners is not None:
                        taught()
                        yield from ended()
                    learners, at, held, size, n = [_Learner(x, shards) for x in (m.words, m.bytes)], shard, [], 0, 0
                held.append(text)
                size += len(text)
                if size >= SLICED:
                    n += taught()
                    held, size = [], 0
                    if n > 1 << 28:  # before a count can run over
                        for level, learner in enumerate(learners):
                            yield from learner.counts(level)
                        n = 0
            tx.give_back()
        if learners is not None:
            taught()
            yield from ended()

    return run


def _added(batches):
    """Sums of the counts of each chunk; batches are sorted by level and chunk."""
    key, total = None, None
    for batch in batches:
        for level, chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            own = np.frombuffer(blob.as_buffer(), _WIDTHS[len(blob.as_buffer()) // (4 * CHUNK)])
            if (level, chunk) != key:
                if key is not None:
                    yield _chunk(key, total)
                key, total = (level, chunk), np.zeros(2 * CHUNK)
            total += own
    if key is not None:
        yield _chunk(key, total)


def _chunk(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["level", "chunk", "counts"])


def _scores(m: Model, r: Reading) -> np.ndarray:
    """log10 probability of each row of a slice."""
    out = np.bincount(r.row, weights=_costs(m.words, r.words), minlength=len(r.first) - 1)
    if len(r.lost):
        spelled = np.bincount(r.word, weights=_costs(m.bytes, r.bytes))
        np.add.at(out, np.searchsorted(r.first, r.lost, "right") - 1, spelled[r.back])
    return out


def _row_sums(shared):
    """For each row its score and the sums over frequent words (h is null), and its other distinct words with their numbers."""

    def run(batches):
        m: Model = shared.value
        names = ["row", "id", "bytes", "h", "n", "known", "base", "score"]
        for batch in batches:
            for i, j in tx.slices(batch.column(1)):
                n, text, ids = j - i, batch.column(1).slice(i, j - i), batch.column(0).slice(i, j - i)
                r = m.read(text)
                row = np.repeat(np.arange(n), np.diff(r.first))
                found = r.place >= 0
                base = np.bincount(row[found], weights=m.base[r.place[found]], minlength=n) if found.any() else np.zeros(n)
                known = np.bincount(row[found], minlength=n)
                yield pa.record_batch(
                    [ids, batch.column(2).slice(i, n), pa.array(np.diff(tx.buffers(text)[1])), pa.nulls(n, pa.int64()), pa.array(np.diff(r.first).astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(_scores(m, r))],
                    names=names,
                )
                own, back = np.unique(r.h[~found], return_inverse=True)
                pair, count = np.unique(row[~found] * np.int64(max(1, len(own))) + back, return_counts=True)
                n = len(pair)
                yield pa.record_batch(
                    [ids.take(pa.array(pair // max(1, len(own)))), pa.nulls(n, batch.column(2).type), pa.nulls(n, pa.int64()), pa.array(own[pair % max(1, len(own))].view(np.int64)), pa.array(count.astype(np.int64)), pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.float64())] * 2],
                    names=names,
                )

    return run


def _least_count(costs: DataFrame, most: int | None = None) -> int:
    """The least count that at most `most` words reach, from a histogram of counts by powers of two and their quarters."""
    most = FREQUENT if most is None else most
    bucket = F.floor(F.log2(F.col("c") + F.lit(0.0)) * 4)
    bins = costs.where("c > 0").groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("b")).collect()  # some hundred rows
    held, least = 0, 1 << 62
    for _, n, low in bins:
        held += n
        if held > most:
            break
        least = low
    return least


def train(rows: DataFrame, groups: int, words: DataFrame, costs: DataFrame, learnt_rows: list[int], scratch: Scratch) -> Model:
    """The model of training rows (text, g), from their words' counts by group (h, b, c0, c1, ...)."""
    spark = rows.sparkSession
    cols = [f"c{g}" for g in range(groups)]
    hashed = words.where("h is not null").groupBy(F.col("h").bitwiseAND(F.lit(GROUPED - 1)).cast("int").alias("k")).agg(*[F.sum(c).cast("double").alias(c) for c in cols]).toArrow()  # GROUPED rows
    told = np.full((GROUPED, groups), 0.05)
    told[hashed.column(0).to_numpy()] += np.stack([hashed.column(1 + g).to_numpy() for g in range(groups)], 1)
    n_ends = sum(learnt_rows)
    prior = np.array([math.log((e + 0.5) / (n_ends + 0.5 * groups)) for e in learnt_rows])

    least = _least_count(costs)
    top = costs.where(F.col("c") >= least).toArrow()  # FREQUENT rows
    keys, count = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(keys)
    keys, count = keys[order], count[order]
    least = max(least, _least_count(costs, CODED))
    coded = words.where("h is not null").where(sum(F.col(c) for c in cols) >= least).select("h", *cols).toArrow()  # CODED rows
    names = coded.column(0).to_numpy().view(np.uint64)
    order = np.argsort(names)
    names, own = names[order], np.stack([coded.column(1 + g).to_numpy()[order] for g in range(groups)])
    escape = len(names)
    number = np.full(len(keys) + 1, escape, np.int64)
    number[np.searchsorted(keys, names)] = np.arange(escape)
    every = np.array([x or 0 for x in words.where("h is not null").agg(*[F.sum(c) for c in cols]).first()])
    lost = np.maximum(every - own.sum(1), 0) + np.where(own.sum(0) == 1, own, 0).sum(1)
    own = np.concatenate([own * (1 - DISCOUNT / np.maximum(own.sum(0), 1)), lost[:, None], np.array(learnt_rows)[:, None]], 1)
    symbols = np.zeros(END_OF_WORD + 1)
    seen = words.where("b is not null").select("b", "c0").toArrow()
    symbols[seen.column(0).to_numpy()] = seen.column(1).to_numpy()
    symbols[END_OF_WORD] = symbols[0x20] + 1
    symbols[[0x20, *range(0x09, 0x0E)]] = 0  # no word holds them
    m = Model(
        Lookup(keys), np.log10(count + 1.0), number, escape, np.ascontiguousarray(np.log(told / told.sum(0)).T, np.float32), prior,
        fresh(own, WORD_BITS), fresh(symbols[None], BYTE_BITS),
    )

    # which texts a learner sees, and in which order, follows from the rows alone: not from partitions, batches or cores
    shards = max(1, -(-(int(every.sum()) + n_ends) // SHARD))
    mark = F.xxhash64("text", F.col("id").cast("string")) if "id" in rows.columns else F.xxhash64("text")
    texts = rows.select("text", mark.alias("mark")).withColumn("shard", F.pmod("mark", F.lit(shards)).cast("int"))
    texts = texts.repartition(4 * shards, "shard").sortWithinPartitions("shard", "mark", "text").select("shard", "text")
    schema = "level int, chunk int, counts binary, gate int, n double, weights array<double>, map array<double>"
    found = scratch.write(texts.mapInArrow(_gathered(spark.sparkContext.broadcast(m), shards), schema), "gathered")
    slots = found.where("counts is not null").select("level", "chunk", "counts").repartition("level", "chunk").sortWithinPartitions("level", "chunk")
    counts = [np.zeros(2 * x.first[-1], np.float32) for x in (m.words, m.bytes)]
    added = scratch.write(slots.mapInArrow(_added, "level int, chunk int, counts binary"), "slots")
    for level, chunk, blob in added.toLocalIterator():  # a row for each CHUNK slots
        into = counts[level][2 * chunk * CHUNK : 2 * (chunk + 1) * CHUNK]
        into[:] = np.frombuffer(blob, np.float32)[: len(into)]
    scratch.drop(added)
    for what in ("weights", "map"):
        parts = found.where("gate is not null").select("level", "gate", "n", F.posexplode(what).alias("k", "x"))
        exact = F.sum((F.col("x") * F.col("n")).cast("decimal(38,9)")).cast("double")  # the same in any order
        for level, gate, k, x in parts.groupBy("level", "gate", "k").agg((exact / F.sum("n")).alias("x")).collect():  # gates x inputs or buckets
            into = getattr((m.words, m.bytes)[level], what)
            into[(k, gate) if what == "weights" else (gate, k)] = x
    scratch.drop(found)
    for x, n in zip((m.words, m.bytes), counts):
        x.settle(n[::2], n[1::2])
    return m


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = "lang") -> DataFrame:
    """Scores every row of `docs` by a model of the rows where `learn` holds.

    Returns id_col, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte, a row for each input row.
    Null texts read as empty: one end. Ids are returned as they are, nulls too. Groups are the MOST_GROUPS - 1
    most frequent values of group_col in training rows, and the rest with nulls; they shape the model, a row's
    own group never enters its score. With group_col None, or naming no column, all rows are one group.
    Repeated rows are scored apiece; the order of words counts. A match looks back over the whole text. Without
    training rows contexts say nothing and each bit costs about as under even odds. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm", WIDE)
    label = F.col(group_col).cast("string") if group_col and group_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), label.alias("label"), F.coalesce(learn, F.lit(False)).alias("learn"))
    found = rows.where("learn and label is not null").groupBy("label").count().orderBy(F.desc("count"), "label").limit(MOST_GROUPS - 1).collect()
    number = F.lit(len(found))
    for k, r in enumerate(found):
        number = F.when(F.col("label") == r[0], k).otherwise(number)
    learns = rows.where("learn").select("id", "text", F.coalesce(number, F.lit(len(found))).cast("long").alias("g"))
    ends = {r[0]: r[1] for r in learns.groupBy("g").count().collect()}
    groups = max(1, len(found) + (len(found) in ends))
    learnt_rows = [ends.get(g, 0) for g in range(groups)]
    cols = [f"c{g}" for g in range(groups)]

    words = learns.select("text", "g").mapInArrow(_words_with_counts(groups), "h long, b int, " + ", ".join(f"{c} long" for c in cols))
    words = scratch.write(words.groupBy("h", "b").agg(*[F.sum(c).alias(c) for c in cols]), "words")
    costs = words.where("h is not null").select("h", sum(F.col(c) for c in cols).alias("c"))
    counts = costs.agg(F.sum("c"), F.count("*")).first()
    n_ends = sum(learnt_rows)
    n_train, n_types = (counts[0] or 0) + n_ends, counts[1] + (n_ends > 0)
    norm = math.log10(n_train + n_types + 1)
    model = train(learns, groups, words, costs, learnt_rows, scratch)

    rows = rows.select(F.monotonically_increasing_id().alias("row"), "text", F.col("id").alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, bytes long, h long, n long, known long, base double, score double"
    pieces = scratch.write(rows.mapInArrow(_row_sums(spark.sparkContext.broadcast(model)), schema), "sums")
    rare = pieces.where("h is not null").select("row", "h", "n").join(costs, "h")
    rare = rare.groupBy("row").agg(F.sum("n").alias("r_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("r_base"))
    whole = pieces.where("h is null").drop("h").join(rare, "row", "left").fillna(0, ["r_known", "r_base"])
    whole = whole.select(
        F.col("id").alias(id_col),
        "bytes",
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.col("r_known") + int(n_ends > 0)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("r_base") + F.lit(math.log10(n_ends + 1)) - (F.col("n") + 1) * F.lit(norm)).alias("base_score"),
        "score",
    )
    whole = whole.withColumn("bits_per_byte", -F.col("score") * F.lit(math.log2(10)) / F.greatest(F.col("bytes"), F.lit(1)))
    return whole.select(id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
