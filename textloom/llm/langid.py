"""Language identification by error-correcting output codes.

Each bit of a language's codeword has a binary classifier on hashed byte
3-grams and 4-grams (log-odds of the two sides, from counts over all training
rows). A text gets the language whose codeword loses least, each bit weighted
by how well it tells that language; a small lead marks the text as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx

BUCKETS = 1 << 15  #: of each n-gram length
SIZES = (3, 4)
MOST_LANGUAGES = 1024
AMBIGUOUS = 0.6  #: scores below are flagged
UNKNOWN = "und"


def held_out(id_col: str, modulus: int, remainder: int = 2) -> Column:
    """True for rows that no model may learn from; a null id reads as the text 'null'."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))) % modulus == remainder


def _features(data: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams that start at each byte; the last few bytes have none."""
    b = tx._LOWER[data].astype(np.uint32)
    out = []
    for k, n in enumerate(SIZES):
        if len(b) < n:
            out.append(np.zeros(0, np.int64))
            continue
        g = np.zeros(len(b) - n + 1, dtype=np.uint32)
        for i in range(n):
            g |= b[i : len(b) - n + 1 + i] << np.uint32(8 * i)
        out.append(((g * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64) + k * BUCKETS)
    return out


def _chunks(data: np.ndarray, offsets: np.ndarray):
    """(row, bytes) of every row, long rows in pieces that overlap by the longest n-gram less one."""
    for r in range(len(offsets) - 1):
        a, b = int(offsets[r]), int(offsets[r + 1])
        while b - a > tx.SLICE:
            yield r, data[a : a + tx.SLICE]
            a += tx.SLICE - max(SIZES) + 1
        yield r, data[a:b]


def _counts(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = tx.buffers(batch.column(0))
        for (r, part), lang in ((c, batch.column(1)[c[0]].as_py()) for c in _chunks(data, offsets)):
            into = total.setdefault(lang, np.zeros(BUCKETS * len(SIZES), np.int64))
            for f in _features(part):
                if len(f) > 4096:
                    into += np.bincount(f, minlength=len(into))
                else:
                    np.add.at(into, f, 1)
    for lang, into in total.items():
        at = np.flatnonzero(into)
        yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(into[at])], names=["lang", "f", "n"])


def codewords(k: int) -> np.ndarray:
    """+1/-1 codewords of k classes: the exhaustive code up to 6, else columns drawn by a fixed seed."""
    if k < 2:
        return np.ones((k, 1), np.int8)
    if k <= 6:
        columns = [[1] + [1 if c >> i & 1 else -1 for i in range(k - 1)] for c in range(2 ** (k - 1) - 1)]
        return np.array(columns, np.int8).T
    rng, width = np.random.default_rng(7), int(np.ceil(10 * np.log2(k)))
    draws = [rng.choice(np.array([-1, 1], np.int8), (k, width)) for _ in range(64)]
    apart = [min((a != b).sum() for i, a in enumerate(d) for b in d[:i]) for d in draws]
    return draws[int(np.argmax(apart))]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  #: languages x bits
    odds: np.ndarray  #: buckets x bits
    trust: np.ndarray  #: languages x bits, rows add up to 1


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang") -> Model:
    """Learns from all rows with a label and a text; counts are added up on the executors."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = rows.mapInArrow(_counts, "lang string, f int, n long").groupBy("lang", "f").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counts.column(0).to_pylist()))
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"{len(names)} languages; at most {MOST_LANGUAGES} are supported")
    at = {x: i for i, x in enumerate(names)}
    table = np.zeros((len(names), BUCKETS * len(SIZES)))
    if len(names):
        table[[at[x] for x in counts.column(0).to_pylist()], counts.column(1).to_numpy()] = counts.column(2).to_numpy()
    code = codewords(len(names))
    share = (table + 0.5) / (table + 0.5).sum(1, keepdims=True) if len(names) else table
    odds = np.zeros((table.shape[1], code.shape[1]), np.float32)
    for b in range(code.shape[1] if len(names) > 1 else 0):
        odds[:, b] = np.log(share[code[:, b] > 0].mean(0)) - np.log(share[code[:, b] < 0].mean(0))
    trust = np.maximum((share @ odds) * code, 1e-6) if len(names) else np.zeros((0, code.shape[1]))
    return Model(names, code, odds, trust / trust.sum(1, keepdims=True) if len(names) else trust)


def _decode(model: Model, margin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its score of each row of summed log-odds."""
    mean = margin / np.maximum(n, 1)[:, None] * np.minimum(n, 60)[:, None]
    loss = np.zeros((len(mean), len(model.languages)))
    for l in range(len(model.languages)):
        loss[:, l] = np.logaddexp(0, -mean * model.code[l]) @ model.trust[l]
    chance = np.exp(-(loss - loss.min(1, keepdims=True)))
    chance /= chance.sum(1, keepdims=True)
    best = chance.argmax(1)
    return best, chance[np.arange(len(best)), best]


def _predicted(model):
    def run(batches):
        m: Model = model.value
        for batch in batches:
            column = batch.column(1)
            langs, scores = [], []
            for i, j in tx.slices(column):
                part = column.slice(i, j - i)
                data, offsets = tx.buffers(part)
                margin, n = np.zeros((j - i, m.odds.shape[1])), np.zeros(j - i)
                for r, piece in _chunks(data, offsets):
                    for f in _features(piece):
                        if len(f):
                            margin[r] += m.odds[f].sum(0, dtype=np.float64) if len(f) < 20_000 else np.bincount(f, minlength=len(m.odds)) @ m.odds
                            n[r] += len(f)
                best, score = _decode(m, margin, n) if m.languages else (None, np.zeros(j - i))
                ascii_letter = np.concatenate([[0], np.cumsum((data | 0x20) - np.uint8(97) < 26)])
                some = np.diff(ascii_letter[offsets]) > 0
                for r in np.flatnonzero(~some):
                    some[r] = regex.search(r"\p{L}", part[int(r)].as_py() or "") is not None
                langs += [m.languages[best[r]] if ok and m.languages else UNKNOWN for r, ok in enumerate(some)]
                scores += np.where(some, score, 0.0).tolist()
            yield pa.record_batch(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array([s < AMBIGUOUS for s in scores], pa.bool_())],
                names=["row_id", "lang_pred", "score", "ambiguous"],
            )

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score (0 to 1), ambiguous, a row for each input row.

    A text that is null or has no letter, and any text under a model without languages, is `und` with score 0.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predicted(shared), "row_id long, lang_pred string, score double, ambiguous boolean").withColumnRenamed("row_id", id_col)


def _kept(model, text_col):
    predicted = _predicted(model)

    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.names.index(text_col)).cast(pa.string())
            got = next(predicted([pa.record_batch([pa.nulls(len(batch), pa.int64()), text], names=["row_id", "text"])]))
            yield batch.filter(pc.not_equal(got.column(1), UNKNOWN))

    return run


def accept(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, unchanged, whose text has a language: `und` rows are rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_kept(shared, text_col), docs.schema)
