"""Which texts hold which pieces, by winnowed fingerprints instead of every short piece beside its text.

A fingerprint is the least hash of `window` neighbouring GRAM-byte grams, kept with its place. A piece of
GRAM + window - 1 bytes or more has a window of its own, which stands in every text that holds it, and so does
that window's fingerprint: one fingerprint a piece meets about 2 / (window + 1) a byte of text, and only
the texts where they meet are compared. Pieces shorter than the longest class use a
smaller window; no piece may be shorter than GRAM bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

GRAM = 8
CLASSES = ((8, 1), (12, 5), (20, 13))  #: bytes of a piece at least, and its window
SIFTED = 1_000_000  #: distinct fingerprints of pieces that are sent to the texts; beyond it the texts' fingerprints are shuffled
_NONE = np.uint64(2**64 - 1)
SLICE = 4 << 20  #: bytes hashed at a time, one text at least


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads near values apart."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The hash of the gram at each byte; grams that cross the end of a text get none."""
    out = np.full(len(data), _NONE, np.uint64)
    n = len(data) - GRAM + 1
    if n <= 0:
        return out
    own = np.ndarray((n,), "<u8", np.ascontiguousarray(data), 0, (1,))
    out[:n] = np.minimum(_mixed(own.astype(np.uint64)), _NONE - np.uint64(1))
    ends = offsets[1:]
    for k in range(1, GRAM):
        at = ends - k
        out[at[(at >= 0) & (at >= offsets[:-1])]] = _NONE
    return out


def _extreme(x: np.ndarray, width: int, f) -> np.ndarray:
    """f over x[i : i + width] for each i, by doubling; the end is cut."""
    out, reach = x.copy(), 1
    while reach < width:
        step = min(reach, width - reach)
        out = f(out[: len(out) - step], out[step:])
        reach += step
    return out


def selected(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are the least of some whole window of one text."""
    h = _grams(data, offsets)
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if window == 1:
        at = np.flatnonzero(h != _NONE)
        return at, h[at]
    least = _extreme(h, window, np.minimum)
    broken = _extreme(h, window, np.maximum) == _NONE  # not a whole window of one text
    least = np.where(broken, np.uint64(0), least)
    pad = np.zeros(window - 1, np.uint64)
    best = _extreme(np.concatenate([pad, least, pad]), window, np.maximum)  # the greatest least of the windows over a gram
    at = np.flatnonzero((best == h) & (h != _NONE))
    return at, h[at]


def _of_texts(window: int, keep: list[str], sift: np.ndarray | None):
    """Fingerprints (keep, __at, __print) of a `__text` column; with `sift` only those in it, and one a text."""

    def run(batches):
        for b in batches:
            column = b.column("__text")
            _, ends = _buffers(column)
            i = 0
            while i < len(column):
                j = min(len(column), max(i + 1, int(np.searchsorted(ends, ends[i] + SLICE, "right")) - 1))
                data, offsets = _buffers(column.slice(i, j - i))
                at, h = selected(data, offsets, window)
                row = np.searchsorted(offsets, at, "right") - 1
                if sift is not None:
                    place = np.minimum(np.searchsorted(sift, h), len(sift) - 1)
                    hit = sift[place] == h
                    at, h, row = at[hit], h[hit], row[hit]
                    _, first = np.unique(np.stack([row.astype(np.uint64), h]), axis=1, return_index=True) if len(h) else (None, np.zeros(0, np.int64))
                    at, h, row = at[first], h[first], row[first]
                taken = pa.array(row + i)
                yield pa.record_batch([b.column(c).take(taken) for c in keep] + [pa.array(at - offsets[row], pa.int32()), pa.array(h.view(np.int64))], names=[*keep, "__at", "__print"])
                i = j

    return run


def _of_pieces(keep: list[str]):
    """Each piece with its class's window and the first of its own fingerprints; pieces under GRAM bytes are left out."""

    def run(batches):
        for b in batches:
            column = b.column("__piece")
            data, offsets = _buffers(column)
            sizes = np.diff(offsets)
            windows, prints = np.zeros(len(column), np.int32), np.zeros(len(column), np.uint64)
            h = _grams(data, offsets)
            for least, window in CLASSES:
                rows = np.flatnonzero(sizes >= least)
                windows[rows] = window
                prints[rows] = [h[offsets[r] : offsets[r] + window].min() for r in rows]
            taken = pa.array(np.flatnonzero(windows))
            yield pa.record_batch([b.column(c).take(taken) for c in keep] + [pa.array(windows[windows > 0]), pa.array(prints[windows > 0].view(np.int64))], names=[*keep, "__window", "__print"])

    return run


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def contains_join(pieces: DataFrame, texts: DataFrame, piece: str, text: str, by: list[str], keys: list[str], sifted: int = SIFTED) -> DataFrame:
    """Pairs of `pieces` rows and `texts` keys whose text contains the piece, both of one `by`.

    pieces: `by`, `piece` and any others, which are returned; texts: `by`, `keys` (which tell its rows apart) and `text`.
    Pieces of under GRAM bytes and nulls give no pair. Up to `sifted` distinct fingerprints the pieces' are sent to the texts, and
    only texts that hold one leave their task; beyond, fingerprints without texts are shuffled, and a text is fetched by its keys
    where one matches.
    """
    pieces = pieces.where(F.col(piece).isNotNull())
    named = pieces.withColumn("__piece", F.col(piece))
    asked = written(named.mapInArrow(_of_pieces(pieces.columns), _ddl(pieces, pieces.columns) + ", __window int, __print long"), "pieces")
    found = None
    for _, window in CLASSES:
        own = asked.where(F.col("__window") == window)
        prints = own.select("__print").distinct()
        n = prints.count()
        if not n:
            continue
        sift = np.sort(np.array([r["__print"] for r in prints.collect()], np.int64).view(np.uint64)) if n <= sifted else None
        keep = [*by, *keys, text] if sift is not None else [*by, *keys]
        source = texts.select(*by, *keys, text, F.col(text).alias("__text")).where(F.octet_length("__text") >= GRAM)
        marks = source.mapInArrow(_of_texts(window, keep, sift), _ddl(texts, keep) + ", __at int, __print long")
        if sift is None:
            slim = own.select(*by, "__print").distinct()
            near = marks.join(slim, [*by, "__print"], "left_semi").select(*by, *keys, "__print").distinct()
            marks = near.join(texts.select(*by, *keys, text), [*by, *keys])
        pairs = own.join(marks.drop("__at"), [*by, "__print"]).where(F.contains(F.col(text), F.col(piece))).select(*pieces.columns, *keys).distinct()
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        return pieces.join(texts.select(*by, *keys), by).where("false").select(*pieces.columns, *keys)
    return found
