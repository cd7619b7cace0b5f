"""Toxicity scores of deobfuscated text.

A noisy channel restores words: the lattice of a suspicious token (leet
symbols, separators, repeats, letters spaced apart) is Viterbi-decoded under a
character trigram model of the corpus. A lexicon of word prefixes, chosen by
covering the toxic rows of a bounded labelled sample, scores the restored text.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx

# Letters that a symbol may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = set(".-_*~'`^:·​‌‍­ ")
COST_LEET, COST_DROP, COST_REPEAT, COST_KEEP = 1.0, 0.5, 0.4, 4.0
COST_EDGE, COST_MARK = 3.0, 1.0  #: of a symbol at a token's edge that is no letter, and of those that often stand around words

LABELLED = 24_000  #: labelled rows that are learnt from, at most; the smallest hashes of their ids
CANDIDATES = 200_000  #: word prefixes whose clean counts are looked at, at most; the most frequent in toxic rows
PREFIXES = (4, 5, 6, 7, 8, 10, 12)  #: bytes of a word prefix; whole words as well
LEAST_SUPPORT, LEAST_PRECISION, CERTAIN = 3, 0.8, 0.97
SYMBOLS = 28  #: word edge, a-z, any other


def _symbols() -> np.ndarray:
    out = np.full(256, 27, np.int64)
    out[97:123] = np.arange(1, 27)
    out[65:91] = np.arange(1, 27)
    out[[0x20, *range(0x09, 0x0E)]] = 0
    return out


_SYMBOL = _symbols()


def _letter_counts(batches):
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for i, j in tx.slices(batch.column(0)):
            data, _ = tx.buffers(batch.column(0).slice(i, j - i))
            s = _SYMBOL[data]
            if len(s) > 2:
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["g", "n"])


def letter_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Costs (negative logs) of a symbol after two others, from counts over all texts."""
    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    counts = rows.mapInArrow(_letter_counts, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    table = np.full(SYMBOLS**3, 0.02)
    table[counts.column(0).to_numpy()] += counts.column(1).to_numpy()
    table = table.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return -np.log(table / table.sum(2, keepdims=True))


def restore(token: str, costs: np.ndarray, split: bool = False) -> str:
    """The likeliest plain word behind a token, by Viterbi search over its lattice; ties go to the smaller string.

    With `split` a separator may also be a border of words, which is read as a space.
    """
    return _decoded(token, costs, split)[1]


def readings(token: str, costs: np.ndarray, split: bool = False) -> list[str]:
    """The restored token where symbols before or behind it may be letters, or marks around the word.

    What stands behind is read the likelier way. What stands before decides how the word begins, by which it is looked
    up, so that the word is given from each of those symbols on (of more than three, the first and the last two).
    """
    if not token or (token[0].isalnum() and token[-1].isalnum()):
        return [restore(token, costs, split)]
    a = next((k for k, c in enumerate(token) if c.isalnum()), 0)
    b = len(token) - next((k for k, c in enumerate(reversed(token)) if c.isalnum()), 0)
    out = []
    for i in sorted({0, a, *range(max(0, a - 2), a)}):
        ways = []
        for j in sorted({len(token), *range(b, min(b + 3, len(token)))}):
            cost, read = _decoded(token[i:j], costs, split)
            ways.append((cost + sum(COST_EDGE if c in LEET and c not in "(!" else COST_MARK for c in token[j:]), read))
        out.append(min(ways)[1])
    return list(dict.fromkeys(out))


def _decoded(token: str, costs: np.ndarray, split: bool) -> tuple[float, str]:

    def symbol(c: str) -> int:
        return ord(c) - 96 if "a" <= c <= "z" else 27

    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}  # last two symbols -> cost, linked output
    for c in token:
        choices = [(x, COST_LEET) for x in LEET.get(c, "")]
        drop = c in SEPARATORS
        if not drop:
            choices.append((c, 0.0 if c.isalpha() else COST_KEEP))
        after: dict[tuple[int, int], tuple[float, tuple]] = {}

        def offer(key, value):
            if key not in after or value[0] < after[key][0]:
                after[key] = value

        for (a, b), (cost, out) in best.items():
            if drop:
                offer((a, b), (cost + COST_DROP, out))
                if split and b:
                    offer((b, 0), (cost + COST_DROP + costs[a, b, 0], (out, " ")))
            for x, more in choices:
                s = symbol(x)
                offer((b, s), (cost + more + costs[a, b, s], (out, x)))
                if out and out[1] == x:
                    offer((a, b), (cost + more + COST_REPEAT, out))
        best = after or best
    cost, out = min(((cost + costs[a, b, 0], out) for (a, b), (cost, out) in best.items()), key=lambda v: v[0])
    found = []
    while out:
        out, x = out
        found.append(x)
    return cost, "".join(reversed(found))


_PLAIN = np.zeros(256, dtype=bool)  # letters, digits and bytes above ASCII
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ALPHA = np.zeros(256, dtype=bool)
_ALPHA[[*range(65, 91), *range(97, 123)]] = True
_ODD = np.zeros(256, dtype=bool)
_ODD[[ord(c) for c in [*LEET, *SEPARATORS] if ord(c) < 128 and c != " "]] = True
_LEET = np.zeros(256, dtype=bool)
_LEET[[ord(c) for c in LEET if ord(c) < 128]] = True
MARKS = "#%&?,;\"<>[]{}=/\\*.:)"  #: never letters at an edge
_OUTER, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_OUTER[[ord(c) for c in MARKS + "!("]] = True
_MARK[[ord(c) for c in MARKS]] = True
_ASIDE = bytes(c for c in range(128) if not _PLAIN[c])
LONGEST = 64  #: bytes of a token that can be one disguised word; longer ones are read as several


WIDE = [b"\xe2\x80", b"\xc2\xad", *[c.encode() for c in LEET if ord(c) > 127]]  #: zero-width marks, the soft hyphen and symbols above ASCII


def _suspicious(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, wide: bool) -> np.ndarray:
    """Words with symbols among letters or for their last one, or a letter thrice in a row.

    A word with one letter only counts if all of it can be read as letters, four of them at least; numbers have none.
    """
    n = len(data)
    odd, alpha = _ODD[data], _ALPHA[data]
    flag = np.zeros(n + 1, np.int64)
    hit = np.zeros(n, dtype=bool)
    if n > 2:
        near = _PLAIN[data] | odd
        hit[1:-1] = odd[1:-1] & near[:-2] & near[2:] & (alpha[:-2] | alpha[2:])
        hit[2:] |= alpha[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    if wide:
        hit |= (data == 0xE2) | (data == 0xC2)  # what WIDE starts with
    np.cumsum(hit, out=flag[1:])
    some = flag[ends] > flag[starts]
    letters, leet = np.concatenate([[0], np.cumsum(alpha)]), np.concatenate([[0], np.cumsum(_LEET[data])])
    n_letters, n_leet = letters[ends] - letters[starts], leet[ends] - leet[starts]
    if len(starts):
        last = np.maximum.accumulate(np.where(_OUTER[data], -1, np.arange(n)))[ends - 1]  # before what stands behind a word
        fore = np.minimum.accumulate(np.where(_MARK[data], n, np.arange(n))[::-1])[::-1][starts]  # behind what stands before it
        begun = np.flatnonzero(fore < ends - 1)
        some[begun] |= odd[fore[begun]] & alpha[fore[begun] + 1]
        inner = np.flatnonzero(last > starts)
        some[inner] |= _LEET[data[last[inner]]] & (alpha | _LEET[data])[last[inner] - 1]
        readable = (n_letters >= 1) & (n_letters + n_leet >= 4) & (n_letters + n_leet >= last - starts + 1)
    else:
        readable = n_letters > 0
    return np.flatnonzero(some & ((n_letters >= 2) | readable))


def _runs(one: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of three or more neighbouring words of one row that are one symbol each."""
    here = np.zeros(len(one), dtype=bool)
    here[first[:-1][first[:-1] < len(one)]] = True
    begin = np.flatnonzero(one & (here | ~np.concatenate([[False], one[:-1]])))
    end = np.flatnonzero(one & np.concatenate([here[1:] | ~one[1:], [True]])) + 1 if len(one) else begin
    return [(a, b) for a, b in zip(begin.tolist(), end.tolist()) if b - a >= 3]


_WORDS: dict[bytes, dict[bytes, bytes]] = {}  #: restored words under the last letter model, by its digest
REMEMBERED = 200_000  #: restored words that a worker remembers


def _restored(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, costs: np.ndarray) -> tuple[list[bytes], list[int]]:
    """Restored words that differ from what stands in the text, and the row of each."""
    model = hashlib.sha256(costs.tobytes()).digest()
    if model not in _WORDS or len(_WORDS[model]) > REMEMBERED:
        _WORDS.clear()
    cache = _WORDS.setdefault(model, {})
    blob = data.tobytes()
    words, at = [], []
    some = _suspicious(data, starts, ends, any(mark in blob for mark in WIDE))
    for k in some.tolist():
        token = blob[starts[k] : ends[k]]
        long = len(token) > LONGEST
        found = cache.get(token)
        if found is None:
            found = " ".join(readings(token.decode("utf-8", "replace").strip(MARKS), costs, long)).encode()
            if not long:
                cache[token] = found
        bare = token.lstrip(_ASIDE)
        own = found.split() if long else [w for w in found.split() if not bare.startswith(w)]  # what stands in the open counts as it is
        words += own
        at += [k] * len(own)
    one = (ends - starts == 1) & (_ALPHA[data[starts]] | _ODD[data[starts]]) if len(starts) else np.zeros(0, bool)
    for a, b in _runs(one, first):
        gaps = starts[a + 1 : b] - ends[a : b - 1]
        wide = np.flatnonzero(gaps > gaps.min()) + a + 1  # certain borders of words
        for i, j in zip([a, *wide.tolist()], [*wide.tolist(), b]):
            token = b" ".join(blob[starts[k] : ends[k]] for k in range(i, j))
            if token not in cache and j - i <= LONGEST:
                cache[token] = restore(token.decode("utf-8", "replace"), costs, True).encode()
            found = cache[token] if token in cache else restore(token.decode("utf-8", "replace"), costs, True).encode()
            own = found.split()
            words += own
            at += [i] * len(own)
    return words, (np.searchsorted(first, np.array(at, np.int64), "right") - 1).tolist()


def _feature_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each prefix length, word numbers and hashes; whole words, of letters only up to the first symbol, come as the longest."""
    out = []
    for k in PREFIXES:
        at = np.flatnonzero(ends - starts >= k)
        out.append((at, tx.span_hashes(data, starts[at], starts[at] + k) ^ np.uint64(k)))
    plain = _PLAIN[data]
    stop = np.concatenate([np.flatnonzero(~plain), [len(data)]])
    if len(starts):
        core = np.minimum(ends, stop[np.searchsorted(stop, starts)])
        at = np.flatnonzero(core - starts >= 3)
        out.append((at, tx.span_hashes(data, starts[at], core[at]) ^ np.uint64(255)))
    return out


def _row_features(column: pa.Array, costs: np.ndarray):
    """(row, hash) of all features of a slice, and the number of restored words of each row."""
    data, offsets = tx.buffers(column)
    data = tx._LOWER[data]
    starts, ends, first = tx.word_spans(data, offsets)
    for _ in range(3):  # opening marks are no part of a word
        starts = starts + (~_PLAIN[data[starts]] & (starts < ends - 1)) if len(starts) else starts
    rows, hashes = [], []
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    for at, h in _feature_hashes(data, starts, ends):
        rows.append(row_of[at])
        hashes.append(h)
    begin, end, _ = tx.word_spans(data, offsets)
    words, of = _restored(data, begin, end, first, costs)
    if words:
        blob = np.frombuffer(b" ".join(words), np.uint8)
        size = np.array([len(w) for w in words])
        s = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        of_row = np.array(of)
        for at, h in _feature_hashes(blob, s, s + size):
            rows.append(of_row[at])
            hashes.append(h)
    restored = np.bincount(np.array(of, np.int64), minlength=len(offsets) - 1) if of else np.zeros(len(offsets) - 1, np.int64)
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), restored


_TWICE = np.uint64(0xA0761D6478BD642F)  #: marks a feature that a row has more than once


def _distinct(rows: np.ndarray, hashes: np.ndarray, twice: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each row, and a second feature for each that it has more than once."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    edge = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])])) if len(rows) else np.zeros(0, np.int64)
    again = edge[np.diff(np.concatenate([edge, [len(rows)]])) > 1] if twice else edge[:0]
    return np.concatenate([rows[edge], rows[again]]), np.concatenate([hashes[edge], hashes[again] ^ _TWICE])


def _support(costs):
    def run(batches):
        for batch in batches:
            for i, j in tx.slices(batch.column(0)):
                rows, hashes, _ = _row_features(batch.column(0).slice(i, j - i), costs.value)
                f, n = np.unique(_distinct(rows, hashes)[1], return_counts=True)
                yield pa.record_batch([pa.array(f.view(np.int64)), pa.array(n)], names=["f", "n"])

    return run


def _among(costs, wanted, each_row: bool):
    """Counts of the wanted features over all rows, or the wanted features of each row."""

    def run(batches):
        keys = wanted.value
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for i, j in tx.slices(batch.column(0)):
                rows, hashes = _distinct(*_row_features(batch.column(0).slice(i, j - i), costs.value)[:2])
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                ok = keys[at] == hashes
                rows, at = rows[ok], at[ok]
                if each_row:
                    found = [at[rows == r].astype(np.int32) for r in np.unique(rows)]
                    yield pa.record_batch([pa.array([f.tolist() for f in found], pa.list_(pa.int32()))], names=["f"])
                else:
                    total += np.bincount(at.astype(np.int64), minlength=len(keys))
        if not each_row:
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["f", "n"])

    return run


@dataclass
class Model:
    costs: np.ndarray
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  #: sorted feature hashes
    chance: np.ndarray = field(default_factory=lambda: np.zeros(0))
    base: float = 0.01  #: of a text without any feature


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", allowed: Column | None = None, labelled: int = LABELLED
) -> Model:
    """Fits the character model on all texts and the lexicon on at most `labelled` labelled rows that `allowed` admits."""
    spark = docs.sparkSession
    costs = letter_model(docs, text_col)
    shared = spark.sparkContext.broadcast(costs)
    marks = labels.where(allowed) if allowed is not None else labels
    marks = marks.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)")
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(labelled)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(marks), "id").groupBy(F.xxhash64("text").alias("h"), F.length("text")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))  # `labelled` rows
    from .scratch import Scratch

    rows = Scratch(spark, "toxicity").write(rows.select("text", "toxic"), "labelled")
    toxic, clean = rows.where("toxic = 1").select("text"), rows.where("toxic = 0").select("text")
    n_toxic, n_clean = toxic.count(), clean.count()
    found = toxic.mapInArrow(_support(shared), "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_SUPPORT)
    found = found.orderBy(F.desc("n"), "f").limit(CANDIDATES).toArrow()
    keys, n = found.column(0).to_numpy().view(np.uint64), found.column(1).to_numpy().astype(float)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    if not len(keys):
        return Model(costs)
    c = np.zeros(len(keys))
    counts = clean.mapInArrow(_among(shared, spark.sparkContext.broadcast(keys), False), "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    c[counts.column(0).to_numpy()] = counts.column(1).to_numpy()
    rate = n_toxic / max(1, n_toxic + n_clean)
    precision = (n + 0.5 * rate) / (n + c + 0.5)
    # as likely by chance as one in all candidates at most
    sure = np.array([a * math.log(max(rate, 1e-6)) + b * math.log(1 - rate) + math.lgamma(a + b + 1) - math.lgamma(a + 1) - math.lgamma(b + 1) for a, b in zip(n, c)]) < -math.log(100)
    good = (precision >= LEAST_PRECISION) & sure
    keys, n, c, precision = keys[good], n[good], c[good], precision[good]
    if not len(keys):
        return Model(costs, base=rate)
    each = toxic.mapInArrow(_among(shared, spark.sparkContext.broadcast(keys), True), "f array<int>").toArrow().column(0).to_pylist()
    members: dict[int, set[int]] = {}
    for r, fs in enumerate(each):
        for f in fs:
            members.setdefault(f, set()).add(r)
    left, chosen = set(range(len(each))), []
    while members:
        f = max(members, key=lambda f: (len(members[f] & left), n[f] - 20 * c[f], f))
        gain = members.pop(f) & left
        if len(gain) < LEAST_SUPPORT:
            break
        chosen.append(f)
        left -= gain
        members = {g: m for g, m in members.items() if len(m & left) >= LEAST_SUPPORT}
    # what is certain by itself counts too, though others cover its rows
    certain = np.flatnonzero((precision >= CERTAIN) & (n * math.log(max(rate, 1e-6)) < -math.log(1e9)))
    chosen = sorted({*chosen, *certain.tolist()})
    uncovered = max(0, n_toxic - len(each)) + len(left)
    return Model(costs, keys[chosen], precision[chosen], base=min(0.1, (uncovered + 0.5) / (n_clean + uncovered + 1)))


def _scores(model):
    def run(batches):
        m: Model = model.value
        table = np.zeros(1 << 16, dtype=bool)  # a sieve of low bits: only what may be in the lexicon is counted
        for keys in (m.keys, m.keys ^ _TWICE):
            table[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            scores, restored = [], []
            for i, j in tx.slices(batch.column(1)):
                rows, hashes, n = _row_features(batch.column(1).slice(i, j - i), m.costs)
                some = table[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
                rows, hashes = _distinct(rows[some], hashes[some])
                clean = np.zeros(j - i) + math.log1p(-m.base)
                if len(m.keys):
                    at = np.minimum(np.searchsorted(m.keys, hashes), len(m.keys) - 1)
                    ok = m.keys[at] == hashes
                    np.add.at(clean, rows[ok], np.log1p(-np.minimum(m.chance[at[ok]], 0.999)))
                scores.append(-np.expm1(clean))
                restored.append(n)
            yield pa.record_batch(
                [batch.column(0), pa.array(np.concatenate(scores) if scores else np.zeros(0)), pa.array(np.concatenate(restored) if restored else np.zeros(0, np.int64))],
                names=["id", "score", "n_restored"],
            )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score (0 to 1), n_restored (words read behind a disguise), a row for each input row.

    Null and empty texts get the base score. Each row stands for itself; repeated ids are scored apiece.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scores(shared), "id long, score double, n_restored long").withColumnRenamed("id", id_col)
