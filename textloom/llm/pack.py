"""Tokenises documents and packs them into sequences by the sum-of-squares rule.

Text is cut into pretokens by vectorised character classes, and only pretokens
not met before in a worker are tokenised. Packing deals the pieces into groups
of bounded size; each group places its pieces, longest first, where the sum of
the squared counts of open bins per residual gap becomes smallest.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .scratch import Scratch

CAPACITY, END_ID = 2048, 0
ROW = "__packed_row"
GROUP = 1 << 16  #: pieces of a packing group, about
CACHE_BITS, POOL = 19, 3_000_000  #: pretokens and ids that a worker remembers


@functools.cache
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, by code point."""
    import regex

    every = np.delete(np.arange(0x110000, dtype="<u4"), slice(0xD800, 0xE000)).tobytes().decode("utf-32-le")  # a list of its characters would take 90 MB
    out = np.zeros(0x110000, dtype=np.uint8)
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            for ch in (every[m.start()], every[m.end() - 1]):
                out[ord(ch)] = kind
            out[ord(every[m.start()]) : ord(every[m.end() - 1]) + 1] = kind
    out[0xD800:0xE000] = 0
    return out


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pretokens, and for each row the index of its first."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    row = np.searchsorted(lead, offsets)
    kind = _classes()[code]
    n = len(code)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    opens = np.zeros(n + 1, dtype=bool)
    opens[row] = True
    change = np.ones(n, dtype=bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= opens[:-1]
    space = kind == 3
    cut = change.copy()
    follows = np.zeros(n, dtype=bool)  # the next character is of the same row and no white space
    follows[:-1] = ~space[1:] & ~opens[1:-1]
    cut |= space & follows
    joined = np.zeros(n, dtype=bool)
    joined[1:] = code[:-1] == 0x20
    cut[~space & change & joined & ~opens[:-1]] = False
    for i in np.flatnonzero((code == 0x27) & change & ~(joined & ~opens[:-1])):
        rest = "".join(map(chr, code[i + 1 : i + 3][: 2 if i + 2 < n and not opens[i + 2] else 1])) if i + 1 < n and not opens[i + 1] else ""
        size = 2 if rest[:1] in ("s", "t", "m", "d") and rest else 3 if rest in ("re", "ve", "ll") else 0
        if size:
            cut[i + 1] = False
            if i + size < n:
                cut[i + size] |= kind[i + size] == 1
    starts = np.flatnonzero(cut)
    return lead[starts], np.searchsorted(starts, row)


class Encoder:
    """Ids of a byte-level BPE, of rows of an Arrow string column."""

    def __init__(self, path: str):
        import tiktoken

        vocab = json.load(open(path, encoding="utf-8"))
        special = {t["content"] for t in vocab.get("added_tokens", [])}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab["model"]["vocab"].items() if t not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << CACHE_BITS, np.uint64)
        self.slot = np.zeros(1 << CACHE_BITS, np.int32)
        self.begin, self.size, self.pool, self.filled = np.zeros(1, np.int64), np.zeros(1, np.int32), np.zeros(1 << 16, np.uint32), 0
        self.known, self.known_at, self.known_size, self.known_filled = np.zeros(1 << 18, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64), 0

    def _same(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Whether the bytes of each span are those remembered for its word."""
        size = ends - starts
        out = hit & (self.known_size[word] == size)
        some = np.flatnonzero(out)
        n = size[some]
        edge = np.concatenate([[0], np.cumsum(n)])
        step = np.arange(edge[-1]) - np.repeat(edge[:-1], n)
        differ = data[np.repeat(starts[some], n) + step] != self.known[np.repeat(self.known_at[word[some]], n) + step]
        if differ.any():
            out[some[np.searchsorted(edge, np.flatnonzero(differ), "right") - 1]] = False
        return out

    def _remember(self, blob: bytes, size: np.ndarray) -> None:
        total = len(blob)
        if self.known_filled + total > len(self.known):
            self.known = np.concatenate([self.known[: self.known_filled], np.zeros(max(total, len(self.known)), np.uint8)])
        self.known[self.known_filled : self.known_filled + total] = np.frombuffer(blob, np.uint8)
        self.known_at = np.concatenate([self.known_at, self.known_filled + np.concatenate([[0], np.cumsum(size)[:-1]])])
        self.known_size = np.concatenate([self.known_size, size])
        self.known_filled += total

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids with END_ID after each row, and each row's first."""
        data, offsets = tx.buffers(column)
        starts, first = pretoken_starts(data, offsets)
        ends = np.concatenate([starts[1:], [len(data)]]) if len(starts) else starts
        h = tx.span_hashes(data, starts, ends) | np.uint64(1)
        if self.filled > POOL or self.known_filled > 4 * POOL:
            self.clear()
        at = (h >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        word = self.slot[at].astype(np.int64)
        hit = self.keys[at] == h
        lost = np.flatnonzero(~hit | ~self._same(data, starts, ends, word, hit))
        if len(lost):
            blob = data.tobytes()
            spans = [blob[x:y] for x, y in zip(starts[lost].tolist(), ends[lost].tolist())]
            number: dict[bytes, int] = {}
            back = np.fromiter((number.setdefault(x, len(number)) for x in spans), np.int64, len(spans))
            where = np.zeros(len(number), np.int64)
            where[back[::-1]] = np.arange(len(spans))[::-1]
            new = h[lost[where]]
            ids = [self.bpe._encode_single_piece(x) for x in number]
            self._remember(b"".join(number), np.fromiter(map(len, number), np.int64, len(number)))
            size = np.fromiter(map(len, ids), np.int32, len(ids))
            total = int(size.sum())
            if self.filled + total > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.filled], np.zeros(max(total, len(self.pool)), np.uint32)])
            self.pool[self.filled : self.filled + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
            base = len(self.begin)
            self.begin = np.concatenate([self.begin, self.filled + np.concatenate([[0], np.cumsum(size)[:-1]])])
            self.size = np.concatenate([self.size, size])
            self.filled += total
            word[lost] = base + back
            slots = (new >> np.uint64(64 - CACHE_BITS)).astype(np.int64)  # of equal slots the last one stays, with its own bytes
            self.keys[slots], self.slot[slots] = new, base + np.arange(len(new))
        begin, size = np.insert(self.begin[word], first[1:], -1), np.insert(self.size[word], first[1:], 1)
        edge = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(begin - edge[:-1], size) + np.arange(edge[-1])
        tail = edge[first[1:] + np.arange(len(offsets) - 1) + 1] - 1
        place[tail] = 0
        out = self.pool[place]
        out[tail] = END_ID
        return out, np.concatenate([[0], tail + 1])


_ENCODERS: dict[str, Encoder] = {}


def _pieces(path: str, capacity: int):
    def run(batches):
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        for batch in batches:
            for i, j in tx.slices(batch.column(1)):
                ids, row = encoder.encode(batch.column(1).slice(i, j - i))
                length = np.diff(row)
                count = (length + capacity - 1) // capacity
                of = np.repeat(np.arange(j - i), count)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                head = length - (count - 1) * capacity
                start = np.where(piece == 0, 0, head[of] + (piece - 1) * capacity)
                size = np.where(piece == 0, head[of], capacity)
                flat = pa.py_buffer(np.ascontiguousarray(ids, "<u4").tobytes())
                places = pa.py_buffer(np.concatenate([(row[:-1][of] + start), [len(ids)]]).astype(np.int64).tobytes() if len(of) else np.zeros(1, np.int64).tobytes())
                blob = pa.Array.from_buffers(pa.large_binary(), len(of), [None, pa.py_buffer((np.frombuffer(places, np.int64) * 4).tobytes()), flat])
                yield pa.record_batch(
                    [batch.column(0).cast(pa.int64()).slice(i, j - i).take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), blob.cast(pa.binary())],
                    names=["id", "piece", "start", "length", "ids"],
                )

    return run


def tokenise(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every text: id_col, piece, start, length, ids (binary, little-endian unsigned 32-bit).

    A text's ids end with END_ID; null reads as empty. A text of more than `capacity` ids is cut into
    pieces of `capacity`, the first of which may be shorter. Each row is a document of its own.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_pieces(tokenizer, capacity), "id long, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("id", id_col)


def sum_of_squares(lengths: np.ndarray, capacity: int, weigh_new: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, taken in the order given, where the sum of the squared counts of open bins
    per gap becomes smallest; of equal choices the smallest gap.

    A new bin is opened only for a piece that fits no open one, which on lengths in falling order leaves fewer
    bins. With `weigh_new` a new bin is weighed as any other choice, and taken if the sum is smaller by it.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins per gap; a full bin isn't open
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offset, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max
    for k, s in enumerate(lengths.tolist()):
        here = count[s:]
        change = 2 * (count[: len(here)] - here) + 2
        change[:1] -= 1  # a filled bin is counted no more
        cost = np.where(here > 0, change, never)
        best = int(cost.argmin())
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        if cost[best] == never or (weigh_new and fresh < cost[best]):
            gap, b = capacity, n
            n += 1
        else:
            gap = s + best
            b = open_bins[gap].pop()
            count[gap] -= 1
        bins[k], offset[k] = b, capacity - gap
        if gap > s:
            count[gap - s] += 1
            open_bins[gap - s].append(b)
    return bins, offset


def _placed(capacity: int):
    from .ngram_join import _groups

    def run(batches):
        for (group, row, length), starts in _groups(batches, 1):
            for a, b in zip(starts[:-1], starts[1:]):
                bins, offset = sum_of_squares(length[a:b], capacity)
                yield pa.record_batch(
                    [pa.array(row[a:b]), pa.array((group[a] << 32) + bins), pa.array(offset)], names=["row", "sequence_id", "offset"]
                )

    return run


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """`pieces` with sequence_id and offset: sequences of at most `capacity`, gapless from 0.

    Pieces of the full capacity have a sequence each. Columns that clash with the two new ones are replaced.
    No rows give no sequences; a length under 1 or over `capacity` is an error.
    """
    scratch = Scratch(pieces.sparkSession, "pack")
    pieces = scratch.write(pieces.drop("sequence_id", "offset").withColumn(ROW, F.monotonically_increasing_id()), "pieces")
    found = pieces.agg(F.min(length_col), F.max(length_col), F.count(F.when(F.col(length_col) < capacity, 1))).first()
    if found[0] is not None and (found[0] < 1 or found[1] > capacity):
        raise ValueError(f"lengths are outside 1 to {capacity}")
    groups = -(-found[2] // group) or 1
    small = pieces.where(F.col(length_col) < capacity).select(F.pmod(F.xxhash64(ROW), F.lit(groups)).alias("grp"), F.col(ROW).alias("row"), F.col(length_col).cast("long").alias("len"))
    small = small.repartition("grp").sortWithinPartitions("grp", F.desc("len"), "row")
    placed = small.mapInArrow(_placed(capacity), "row long, sequence_id long, offset long").withColumnRenamed("row", ROW)
    joined = pieces.where(F.col(length_col) < capacity).join(placed, ROW)
    full = pieces.where(F.col(length_col) == capacity).withColumn("sequence_id", -1 - F.col(ROW)).withColumn("offset", F.lit(0).cast("long"))
    return joined.unionByName(full).drop(ROW)
