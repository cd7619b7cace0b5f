"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into overlapping passages of words. TF-IDF rows of the
benchmark's passages and of all corpus passages that hold a benchmark word go
through a distributed randomised SVD: products of each two terms' weights are
summed over all rows once, and the passes of the SVD read those sums. Corpus
passages near a benchmark passage in that space are candidates, confirmed by the longest common subsequence of words
with the item and by the share of the item's rarest terms (its answer) that
they hold. Items are searched in blocks of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .scratch import WIDE, Scratch, nothing

PASSAGE, STRIDE = 32, 16
RANK, OVERSAMPLE, POWER = 192, 16, 1
UNIT = 1 << 20  #: products of weights are summed as integers in parts of this, the same in any order
DENSE = 1 << 24  #: of no more pairs of terms a task sums one half (the other is equal) in one array of 32 bits each; of more it holds those that occur
TERMS, PAIRED = 64, 256  #: terms whose sums, and passages whose pairs are worked out at a time
LARGE, CARRY = 1 << 22, 1 << 30  #: products, and sums, that the array's 32 bits do not take: PAIRED of the one and one of the other stay below 2^31
HELD = 1 << 18  #: sums beside the array, about
FITTED = 1 << 21  #: passages that a task sums, about
BLOCK_CHARS = 4_000_000  #: of benchmark text searched in one go
LEAST_WORDS = 5  #: shorter items would accuse ordinary text: they match texts that are nothing else
COSINE, LCS, ANSWER = 0.3, 0.42, 0.35
CHUNK = 512  #: passages projected at a time
RICH = 0.15  #: share of an item passage's rare weight that a candidate must hold
_BREAKS = np.ones(256, dtype=bool)
_BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class Index:
    ids: list  #: item ids
    items: list[np.ndarray]  #: word hashes of each item
    terms: np.ndarray  #: sorted distinct word hashes of the items
    idf: np.ndarray
    sift: np.ndarray  #: 2^16 marks of low hash bits
    basis: np.ndarray | None = None  #: terms x rank
    owner: np.ndarray | None = None  #: item of each benchmark passage
    latent: np.ndarray | None = None  #: benchmark passages x rank, of unit length
    rare: np.ndarray | None = None  #: squared idf of the rarer terms, zero for the rest
    short: dict[tuple, list[int]] | None = None  #: places in ids of items under LEAST_WORDS words
    least: np.ndarray | None = None  #: rare weight that a passage must hold to be near each benchmark passage's item

    def places(self, words: np.ndarray) -> np.ndarray:
        """The term number of each word, -1 if no item has it."""
        out = np.full(len(words), -1, np.int64)
        some = np.flatnonzero(self.sift[(words & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, words[some]), max(0, len(self.terms) - 1))
        ok = self.terms[at] == words[some] if len(self.terms) else np.zeros(len(some), bool)
        out[some[ok]] = at[ok]
        return out


def _windows(n: int) -> np.ndarray:
    """Starts of the passages of n words; the last passage may be shorter."""
    return np.arange(0, max(1, n - PASSAGE + STRIDE), STRIDE)


def _row(terms: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a passage and their weights, of unit length."""
    t, n = np.unique(terms[terms >= 0], return_counts=True)
    w = (1 + np.log(n)) * idf[t]
    return t, w / max(np.sqrt((w * w).sum()), 1e-12)


def _lcs(a: np.ndarray, b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    mask: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        mask[x] = mask.get(x, 0) | 1 << i
    full, v = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        if x in mask:
            u = v & mask[x]
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and end of all passages of rows of words."""
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), np.where(n > 0, np.maximum(0, n - PASSAGE + STRIDE - 1) // STRIDE + 1, 0))
    start = first[:-1][rows] + (np.arange(len(rows)) - np.searchsorted(rows, rows)) * STRIDE
    return rows, start, np.minimum(start + PASSAGE, first[1:][rows])


def _statistics(index):
    """Texts that hold each term, and the terms of all passages that hold any."""

    def run(batches):
        ix: Index = index.value
        df, n = np.zeros(len(ix.terms), np.int64), 0
        for batch in batches:
            for i, j in tx.slices(batch.column(0)):
                h, first = tx.words(batch.column(0).slice(i, j - i), _BREAKS)
                at = ix.places(h)
                known = at[at >= 0]
                pair = np.unique(np.repeat(np.arange(j - i), np.diff(first))[at >= 0] * len(ix.terms) + known)
                df += np.bincount(pair % max(1, len(ix.terms)), minlength=len(df))
                n += j - i
                hits = np.concatenate([[0], np.cumsum(at >= 0)])
                _, start, end = _passages(first)
                lo, size = hits[start], hits[end] - hits[start]
                lo, size = lo[size > 0], size[size > 0]
                for c in range(0, len(lo), 1 << 14):
                    edge = np.concatenate([[0], np.cumsum(size[c : c + (1 << 14)])])
                    of = np.repeat(lo[c : c + (1 << 14)] - edge[:-1], np.diff(edge)) + np.arange(edge[-1])
                    rows = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(known[of].astype(np.int32)))
                    yield pa.record_batch([rows, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int64())], names=["row", "term", "n"])
        yield pa.record_batch([pa.nulls(len(df) + 1, pa.list_(pa.int32())), pa.array(np.arange(-1, len(df)).astype(np.int32)), pa.array(np.concatenate([[n], df]))], names=["row", "term", "n"])

    return run


class _Sums:
    """Sums by pair of terms, the first not after the second."""

    def __init__(self, n: int):
        self.n, self.held, self.size = n, [], 0
        self.edge = np.arange(n) * (2 * n - 1 - np.arange(n)) // 2  # a pair's place among all such, less the second term
        self.dense = np.zeros(n * (n + 1) // 2, np.int32) if n * n <= DENSE else None
        self.most = DENSE // 2 if self.dense is None else HELD

    def add(self, one: np.ndarray, two: np.ndarray, value: np.ndarray) -> None:
        """Adds PAIRED products of a pair at most."""
        if self.dense is None:
            self._hold(one * self.n + two, value)
            return
        large = value >= LARGE
        if large.any():
            self._hold(one[large] * self.n + two[large], value[large])
            value = np.where(large, 0, value)
        at = self.edge[one] + two
        np.add.at(self.dense, at, value.astype(np.int32))
        over = np.flatnonzero(self.dense[at] >= CARRY)
        if len(over):
            at, first = np.unique(at[over], return_index=True)
            self._hold(one[over[first]] * self.n + two[over[first]], self.dense[at].astype(np.int64))
            self.dense[at] = 0

    def _hold(self, key: np.ndarray, value: np.ndarray) -> None:
        self.held.append((key, value))
        self.size += len(key)
        if self.size > self.most:
            self.held = [self._sorted()]
            self.size = len(self.held[0][0])

    def full(self) -> bool:
        return self.size > self.most // 2

    def taken(self, whole: bool = True):
        """Pairs (first * n + second) in order and their sums, in parts; none is held then, and if `whole` none is left in the array."""
        yield self._sorted()
        if self.dense is None or not whole:
            return
        own = self.edge + np.arange(self.n)
        for i in range(0, self.n, TERMS):
            lo, hi = own[i], own[i + TERMS] if i + TERMS < self.n else len(self.dense)
            at = lo + np.flatnonzero(self.dense[lo:hi])
            one = np.searchsorted(own, at, "right") - 1
            yield one * self.n + at - self.edge[one], self.dense[at].astype(np.int64)
        self.dense[:] = 0

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        key, value = (np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 2
        self.held, self.size = [], 0
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[edge], np.add.reduceat(value, edge) if len(edge) else value


_PAIRS = "term int, other array<int>, total array<long>"


def _pairs(key: np.ndarray, value: np.ndarray, n: int):
    """Sums by pair, in order, as rows of a term."""
    term, other = np.divmod(key, n)
    edge = np.append(np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])), len(term)) if len(term) else np.zeros(1, np.int64)
    for i in range(0, len(edge) - 1, 256):
        own = edge[i : i + 257]
        lists = [pa.ListArray.from_arrays(pa.array((own - own[0]).astype(np.int32)), pa.array(x[own[0] : own[-1]])) for x in (other.astype(np.int32), value)]
        yield pa.record_batch([pa.array(term[own[:-1]].astype(np.int32)), *lists], names=["term", "other", "total"])


def _products(shared):
    """For each term and each other not before it, their weights' products summed over a task's TF-IDF rows."""

    def run(batches):
        idf = shared.value
        sums = _Sums(len(idf))
        for batch in batches:
            for c in range(0, len(batch), PAIRED):
                row, weight = batch.column(0).slice(c, PAIRED), batch.column(1).slice(c, PAIRED).to_numpy()
                own = np.repeat(np.arange(len(row)), row.value_lengths().to_numpy())
                pair, n = np.unique(own * len(idf) + row.flatten().to_numpy(), return_counts=True)
                own, t = np.divmod(pair, len(idf))
                w = (1 + np.log(n)) * idf[t]
                w /= np.sqrt(np.bincount(own, w * w, len(row)))[own]
                left = np.searchsorted(own, own, "right") - np.arange(len(own))
                a = np.repeat(np.arange(len(own)), left)
                b = a + np.arange(len(a)) - np.repeat(np.cumsum(left) - left, left)
                sums.add(t[a], t[b], np.rint((w * weight[own] * UNIT)[a] * w[b]).astype(np.int64))
                if sums.full():
                    for part in sums.taken(whole=False):
                        yield from _pairs(*part, len(idf))
        for part in sums.taken():
            yield from _pairs(*part, len(idf))
        del sums
        tx.give_back()

    return run


def _turned(n: int):
    """Each pair of different terms under the other term, too."""

    def run(batches):
        for batch in batches:
            yield batch
            term = np.repeat(batch.column(0).to_numpy().astype(np.int64), batch.column(1).value_lengths().to_numpy())
            other, total = batch.column(1).flatten().to_numpy().astype(np.int64), batch.column(2).flatten().to_numpy()
            key = other * n + term
            order = np.argsort(key)
            order = order[(other != term)[order]]
            yield from _pairs(key[order], total[order], n)

    return run


def _merged(n: int):
    """The sums of each term's rows; rows are sorted by term."""

    def run(batches):
        at, total = None, np.zeros(n, np.int64)

        def ended():
            other = np.flatnonzero(total)
            yield from _pairs(at * n + other, total[other], n)
            total[:] = 0

        for batch in batches:
            for k, term in enumerate(batch.column(0).to_pylist()):
                if term != at:
                    if at is not None:
                        yield from ended()
                    at = term
                total[batch.column(1)[k].values.to_numpy()] += batch.column(2)[k].values.to_numpy()
        if at is not None:
            yield from ended()

    return run


def _times(shared):
    """Rows of the product of a symmetric matrix and x."""

    def run(batches):
        x = shared.value
        for batch in batches:
            for c in range(0, len(batch), 64):
                part = batch.slice(c, 64)
                block = np.zeros((len(part), len(x)))
                block[np.repeat(np.arange(len(part)), part.column(1).value_lengths().to_numpy()), part.column(1).flatten().to_numpy()] = part.column(2).flatten().to_numpy() / UNIT
                yield pa.record_batch([part.column(0), pa.array([y.tobytes() for y in block @ x], pa.binary())], names=["term", "y"])

    return run


def _randomised_svd(rows: DataFrame, idf: np.ndarray, rank: int, scratch: Scratch) -> np.ndarray:
    """Right singular vectors of A, the TF-IDF rows (row array<int>, weight double), from the sums A'A."""
    context, n = rows.sparkSession.sparkContext, len(idf)
    sums = rows.mapInArrow(_products(context.broadcast(idf)), _PAIRS)
    for turn in (False, True):
        if turn:
            sums = sums.mapInArrow(_turned(n), _PAIRS)
        sums = scratch.write(sums.repartition("term").sortWithinPartitions("term").mapInArrow(_merged(n), _PAIRS), "products")
    width = min(n, rank + OVERSAMPLE)
    x = np.random.default_rng(3).standard_normal((n, width))
    for k in range(POWER + 2):
        if k:
            x, _ = np.linalg.qr(x)
        y = np.zeros(x.shape)
        for term, part in sums.mapInArrow(_times(context.broadcast(x)), "term int, y binary").toLocalIterator():  # a row for each term
            y[term] = np.frombuffer(part, np.float64)
        before, x = x, y
    # x = A'A q for orthonormal q: a small eigenproblem gives the singular directions
    value, turn = np.linalg.eigh(before.T @ x)
    top = np.argsort(value)[::-1][: min(rank, len(value))]
    return (before @ turn[:, top[value[top] > 1e-9]]).astype(np.float32)


def build(items: list[tuple], docs: DataFrame, text_col: str, scratch: Scratch, rank: int = RANK) -> Index:
    """The index of a block of items (id, text)."""
    spark: SparkSession = docs.sparkSession
    h, first = tx.words(pa.array([t for _, t in items], pa.string()), _BREAKS)
    seqs = [h[a:b] for a, b in zip(first[:-1], first[1:])]
    keep = [k for k, s in enumerate(seqs) if len(s) >= LEAST_WORDS]
    seqs = [seqs[k] for k in keep]
    terms = np.unique(np.concatenate(seqs)) if seqs else np.zeros(0, np.uint64)
    sift = np.zeros(1 << 16, dtype=bool)
    sift[(terms & np.uint64(0xFFFF)).astype(np.int64)] = True
    ix = Index([items[k][0] for k in keep], seqs, terms, np.ones(len(terms)), sift, short={})
    for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if 0 < b - a < LEAST_WORDS:
            ix.short.setdefault(tuple(h[a:b].tolist()), []).append(len(ix.ids))
            ix.ids.append(items[k][0])
    if not seqs:
        return ix
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = scratch.write(texts.mapInArrow(_statistics(spark.sparkContext.broadcast(ix)), "row array<int>, term int, n long"), "statistics")
    counts = found.where("term is not null").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms) + 1)
    df[counts.column(0).to_numpy() + 1] = counts.column(1).to_numpy()
    ix.idf = np.log((1 + df[0]) / (1 + df[1:])) + 0.05
    places, owner = [], []
    for k, s in enumerate(seqs):
        at = ix.places(s)
        for w in _windows(len(s)):
            places.append(at[w : w + PASSAGE].tolist())
            owner.append(k)
    corpus = found.where("row is not null").select("row", F.lit(1.0).alias("weight"))
    n = corpus.count()
    weight = max(1.0, n / len(places))  # the benchmark's side weighs no less than the corpus'
    own = spark.createDataFrame(pa.table({"row": pa.array(places, pa.list_(pa.int32())), "weight": pa.array(np.full(len(places), weight))}))
    ix.basis = _randomised_svd(own.union(corpus).coalesce(max(8, n // FITTED)), ix.idf, rank, scratch)
    scratch.drop(found)
    ix.owner = np.array(owner)
    ix.rare = np.where(ix.idf >= 0.5 * ix.idf.max(), ix.idf**2, 0.0)
    latent, mass = [], np.zeros(len(seqs))
    for p, k in zip(places, owner):
        t, w = _row(np.array(p), ix.idf)
        latent.append(w @ ix.basis[t])
        mass[k] = max(mass[k], ix.rare[np.unique(p)].sum())
    latent = np.array(latent, np.float32)
    ix.latent = latent / np.maximum(np.sqrt((latent**2).sum(1, keepdims=True)), 1e-9)
    ix.least = RICH * mass[ix.owner]
    return ix


def _project(ix: Index, at: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """TF-IDF rows of passages in the latent space."""
    k = np.arange(PASSAGE)
    place = np.minimum(start[:, None] + k, len(at) - 1)
    term = np.where((start[:, None] + k < end[:, None]), at[place], -1)
    row, col = np.nonzero(term >= 0)
    pair, n = np.unique(row * len(ix.terms) + term[row, col], return_counts=True)
    row, t = pair // len(ix.terms), pair % len(ix.terms)
    w = (1 + np.log(n)) * ix.idf[t]
    norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(start)))
    out = np.zeros((len(start), ix.basis.shape[1]), np.float32)
    if len(row):
        edge = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[edge]] = np.add.reduceat(ix.basis[t] * (w / norm[row])[:, None].astype(np.float32), edge, axis=0)
    return out


def _search(ix: Index, column: pa.Array, answers: list[list[int]]):
    """(row, item, cosine, lcs, answer, first word, last word) of the best confirmed passage of each row and item."""
    h, first = tx.words(column, _BREAKS)
    whole = _equal(ix, h, first)
    if not ix.items:
        return whole
    at = ix.places(h)
    mass = np.concatenate([[0.0], np.cumsum(np.where(at >= 0, ix.rare[at], 0.0))])
    rows, start, end = _passages(first)
    if not len(rows):
        return whole
    mass = mass[end] - mass[start]
    rich = np.flatnonzero(mass >= ix.least.min())
    out: dict[tuple[int, int], tuple] = {}
    for c in range(0, len(rich), CHUNK):
        some = rich[c : c + CHUNK]
        x = _project(ix, at, start[some], end[some])
        size = np.sqrt((x * x).sum(1, keepdims=True))
        near = (x / np.maximum(size, 1e-9)) @ ix.latent.T
        near[size[:, 0] < 0.05] = 0
        near[mass[some][:, None] < ix.least[None]] = 0
        for k, p in zip(*np.nonzero(near >= COSINE)):
            w, item = some[k], int(ix.owner[p])
            r = int(rows[w])
            seq = ix.items[item]
            spare = max(4, len(seq) // 4)
            # the item may reach out of the passage on either side
            a = max(int(first[r]), int(start[w]) - max(0, len(seq) - STRIDE) - spare)
            b = min(int(first[r + 1]), int(end[w]) + max(0, len(seq) - STRIDE) + spare)
            known = out.get((r, item))
            if known and known[4] <= start[w] and end[w] <= known[5] and known[1] >= 0.95:
                continue
            region = h[a:b].tolist()
            own = set(region)
            share = sum(t in own for t in answers[item]) / len(answers[item])
            if share < ANSWER:
                continue
            lcs = _lcs(seq, region) / len(seq)
            if lcs < LCS:
                continue
            if not known or (lcs, near[k, p]) > (known[1], known[0]):
                out[r, item] = (float(near[k, p]), lcs, share, lcs, a, b)
    return whole + [(r, i, c, l, s, int(a - first[r]), int(b - first[r])) for (r, i), (c, l, s, _, a, b) in sorted(out.items())]


def _equal(ix: Index, h: np.ndarray, first: np.ndarray) -> list[tuple]:
    """The rows whose words are those of a short item and no others, as _search returns them."""
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < LEAST_WORDS)) if ix.short else ()
    return [(int(r), i, 1.0, 1.0, 1.0, 0, int(n[r])) for r in short for i in ix.short.get(tuple(h[first[r] : first[r + 1]].tolist()), ())]


def _answers(ix: Index) -> list[list[int]]:
    """The rarest third of each item's distinct terms."""
    out = []
    for s in ix.items:
        t = np.unique(ix.places(s))
        out.append(ix.terms[t[np.argsort(-ix.idf[t], kind="stable")[: max(2, len(t) // 3)]]].tolist())
    return out


def _found(index):
    def run(batches):
        ix: Index = index.value
        answers = _answers(ix)
        for batch in batches:
            for i, j in tx.slices(batch.column(1)):
                hits = _search(ix, batch.column(1).slice(i, j - i), answers)
                if hits:
                    r, k, c, l, s, a, b = zip(*hits)
                    yield pa.record_batch(
                        [batch.column(0).take(pa.array([i + x for x in r])), pa.array([ix.ids[x] for x in k], pa.int64()), pa.array(c), pa.array(l), pa.array(s), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                        names=["id", "item", "cosine", "lcs_ratio", "answer_share", "first_word", "end_word"],
                    )

    return run


def _clean(index, text_col):
    def run(batches):
        ix: Index = index.value
        answers = _answers(ix)
        for batch in batches:
            text = batch.column(batch.schema.names.index(text_col)).cast(pa.string())
            keep = np.ones(len(batch), dtype=bool)
            for i, j in tx.slices(text):
                for hit in _search(ix, text.slice(i, j - i), answers):
                    keep[i + hit[0]] = False
            yield batch.filter(pa.array(keep))

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """Lists of (id, text) of at most about BLOCK_CHARS characters."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS) or 1
    for k in range(n):
        some = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield sorted(map(tuple, some.collect()))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """A row for each text and benchmark item that it holds: id_col, item_col, cosine, lcs_ratio, answer_share, first_word, end_word.

    Null and wordless texts hold nothing, null and wordless items are held by nothing; items of fewer than
    LEAST_WORDS words are held by texts of the same words and no others. Equal items are all reported. Repeated rows give repeated results. An empty table on either side gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "decontam", WIDE)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    schema = "id long, item long, cosine double, lcs_ratio double, answer_share double, first_word long, end_word long"
    out = nothing(docs.sparkSession, schema)
    for items in _blocks(benchmark, item_col, item_text_col):
        index = build(items, docs, text_col, scratch)
        if index.ids:
            out = out.union(rows.mapInArrow(_found(docs.sparkSession.sparkContext.broadcast(index)), schema))
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs`, unchanged, whose text holds no benchmark item."""
    scratch = Scratch(docs.sparkSession, "decontam")
    out = docs
    for items in _blocks(benchmark, item_col, item_text_col):
        index = build(items, docs, text_col, scratch)
        if index.ids:
            out = out.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(index), text_col), docs.schema)
    return out
